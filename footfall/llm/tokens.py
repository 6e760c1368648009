"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

A byte-level tokenizer never joins what stands before a lone space to what
follows it, so texts are cut there, each distinct piece is encoded once per
worker and the ids are gathered by numpy.  Texts where white space meets a
space are cut by rule instead, and tokenizers of another kind encode whole
texts.  A text that holds the string of one of the file's added tokens goes
through the library whole, which makes that token of it as the file says.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

KNOWN_PIECES = 1_000_000  # about 70 MB
KNOWN_BYTES = 16 << 20  # of their text, which bounds the ids too
SLICE_BYTES = 2 << 20  # of text encoded at a time
MERGE_PIECES = 8192  # new pieces given to the library at a time: it holds some hundred bytes for each
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: how byte-level tokenizers of this family cut a text into groups.
GROUPS = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in kept}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return out


def ragged_take(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """``flat[starts[i] : starts[i] + lens[i]]`` for all i, joined."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lens), lens) + np.arange(total)]


class PieceTable:
    """Ids of known pieces, found by hash and confirmed by their bytes."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(0, np.uint64)  # sorted
        self.met = np.zeros(0, bool)  # again, since the table was last cut down
        self.text_at = self.text_len = self.ids_at = self.ids_len = np.zeros(0, np.int64)
        self.text = np.zeros(0, np.uint8)
        self.ids = np.zeros(0, "<u4")

    @staticmethod
    def hashes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """64-bit hash of raw[at[i]:at[i+1]]; at least one byte each."""
        start = at[:-1]
        place = np.arange(len(raw)) - np.repeat(start - start[0], np.diff(at))
        power = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        h = np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * power[place], start - start[0])
        return h ^ (h >> np.uint64(29))

    def find(self, raw: np.ndarray, at: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Entry of each piece, -1 where unknown."""
        if not len(self.key):
            return np.full(len(h), -1)
        spot = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        size = np.diff(at)
        hit = np.flatnonzero((self.key[spot] == h) & (self.text_len[spot] == size))
        if len(hit):
            size = size[hit]
            same = ragged_take(self.text, self.text_at[spot[hit]], size) == ragged_take(raw, at[hit] - at[0], size)
            hit = hit[np.logical_and.reduceat(same, np.cumsum(size) - size)]
        out = np.full(len(h), -1)
        out[hit] = spot[hit]
        self.met[spot[hit]] = True
        return out

    def cut_down(self) -> None:
        """Forget what was not met again, or everything if that leaves more than half."""
        kept = np.flatnonzero(self.met)
        if 2 * len(kept) > KNOWN_PIECES or 2 * self.text_len[kept].sum() > KNOWN_BYTES:
            kept = kept[:0]
        text_at, text_len, ids_at, ids_len = (
            x[kept] for x in (self.text_at, self.text_len, self.ids_at, self.ids_len)
        )
        self.key, self.met = self.key[kept], np.zeros(len(kept), bool)
        self.text, self.ids = ragged_take(self.text, text_at, text_len), ragged_take(self.ids, ids_at, ids_len)
        self.text_at, self.text_len = np.cumsum(text_len) - text_len, text_len
        self.ids_at, self.ids_len = np.cumsum(ids_len) - ids_len, ids_len

    def add(self, h: np.ndarray, texts: list[bytes], ids: list[bytes]) -> None:
        size = sum(map(len, texts))
        if len(h) > KNOWN_PIECES or size > KNOWN_BYTES:  # of one very long text
            return
        if len(self.key) + len(h) > KNOWN_PIECES or len(self.text) + size > KNOWN_BYTES:
            self.cut_down()
        h, one = np.unique(h, return_index=True)
        spot = np.searchsorted(self.key, h)
        if len(self.key):
            fresh = self.key[np.minimum(spot, len(self.key) - 1)] != h
            h, one, spot = h[fresh], one[fresh], spot[fresh]
        one = one.tolist()
        text_len = np.fromiter((len(texts[i]) for i in one), np.int64, len(one))
        ids_len = np.fromiter((len(ids[i]) // 4 for i in one), np.int64, len(one))
        new = spot + np.arange(len(h))  # places in the longer table
        old = np.ones(len(self.key) + len(h), bool)
        old[new] = False

        def merged(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            out = np.empty(len(old), x.dtype)
            out[old], out[new] = x, y
            return out

        self.key = merged(self.key, h)
        self.met = merged(self.met, np.zeros(len(h), bool))
        self.text_at = merged(self.text_at, len(self.text) + np.cumsum(text_len) - text_len)
        self.ids_at = merged(self.ids_at, len(self.ids) + np.cumsum(ids_len) - ids_len)
        self.text_len = merged(self.text_len, text_len)
        self.ids_len = merged(self.ids_len, ids_len)
        self.text = np.concatenate([self.text, np.frombuffer(b"".join([texts[i] for i in one]), np.uint8)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join([ids[i] for i in one]), "<u4")])


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large_string array without nulls, and their offsets."""
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = "|".join(re.escape(t) for t in sorted(added) if t)
        self.by_piece = (
            self.tokenizer.normalizer is None
            and str(self.tokenizer.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False")
            and "use_regex=True" in str(self.tokenizer.pre_tokenizer)
        )
        self.merger = Tokenizer(self.tokenizer.model)  # takes groups that are cut already
        self.letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self.known = PieceTable()

    def _merge(self, groups: list[str]) -> list[bytes]:
        """Ids of each group: one call for all, cut by the bytes that tokens stand for."""
        if not groups:
            return []
        mapped = [g.encode().decode("latin-1").translate(self.letters) for g in groups]
        ids = np.array(
            self.merger.encode_batch_fast([mapped], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4"
        )
        ends = np.cumsum(np.fromiter(map(len, mapped), np.int64, len(mapped)))
        cuts = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, a leading space included where it stands."""
        out: list[bytes] = []
        for a in range(0, len(pieces), MERGE_PIECES):
            out += self._some_pieces(pieces[a : a + MERGE_PIECES])
        return out

    def _some_pieces(self, pieces: list[str]) -> list[bytes]:
        cut = [[p] if p[:1] == " " and p[1:].isalpha() else GROUPS.findall(p) for p in pieces]
        groups = list(dict.fromkeys(g for groups in cut for g in groups))
        ids = dict(zip(groups, self._merge(groups)))
        return [ids[g[0]] if len(g) == 1 else b"".join([ids[x] for x in g]) for g in cut]

    def _by_rule(self, text: str) -> bytes:
        first, *rest = LONE_SPACE.split(text)
        return b"".join(self.pieces([first, *(" " + p for p in rest)]))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and where each text's begin, one more than texts; null is empty.

        Done by slices of about ``SLICE_BYTES``: the memory needed beside the
        ids is that of a slice, or of one text that is longer.
        """
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (np.cumsum(size) - size) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
        flat, lens = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                ids, at = self._encode_slice(texts.slice(a, b - a))
                flat.append(ids)
                lens.append(np.diff(at))
        return np.concatenate(flat), np.cumsum(np.concatenate(lens))

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        if not self.by_piece:
            whole = [
                np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(
                    [t or "" for t in texts.to_pylist()], add_special_tokens=False
                )
            ]
            return np.frombuffer(b"".join(whole), "<u4"), np.cumsum([0, *(len(w) // 4 for w in whole)])
        texts = texts.fill_null("").cast(pa.large_string())
        split = pc.split_pattern(texts, " ")
        at = np.asarray(split.offsets).astype(np.int64)
        coded = split.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at -= at[0]
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary
        first = at[:-1]
        odd_word = pc.match_substring_regex(words, r"^$|^[\s\x0B\x1C-\x1F\x85]|[\s\x0B\x1C-\x1F\x85]$|^\pZ|\pZ$")
        odd_word = odd_word.to_numpy(zero_copy_only=False)
        odd = np.logical_or.reduceat(odd_word[codes], first) & (np.diff(at) > 1)
        added = np.zeros(n, bool)
        if self.added:
            added = pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False)
            odd |= added
        inner = np.ones(len(codes), bool)
        inner[first] = False
        if odd.any():
            inner &= ~np.repeat(odd, np.diff(at))

        # pieces after a space, once each
        used = np.bincount(codes[inner], minlength=len(words)) > 0
        spots = np.flatnonzero(used)
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        more: list[bytes] = []
        if len(spots):
            asked = words.take(pa.array(spots))
            raw, word_at = bytes_of(asked)
            h = PieceTable.hashes(raw, word_at)
            entry = self.known.find(raw, word_at, h)
            lost = np.flatnonzero(entry < 0)
            flat = self.known.ids
            start[spots] = self.known.ids_at[entry] if len(self.known.key) else 0
            size[spots] = self.known.ids_len[entry] if len(self.known.key) else 0
            if len(lost):
                texts_lost = asked.take(pa.array(lost)).to_pylist()
                more = self.pieces([" " + w for w in texts_lost])
                self.known.add(h[lost], [w.encode() for w in texts_lost], more)
        else:
            lost, flat = np.zeros(0, np.int64), np.zeros(0, "<u4")
        # then first pieces and texts cut by rule
        heads, head_of = np.unique(codes[first], return_inverse=True)
        more += self.pieces(words.take(pa.array(heads)).to_pylist())
        codes[first] = len(words) + head_of
        if odd.any():
            whole_at = np.flatnonzero(odd)
            codes[first[whole_at]] = len(words) + len(heads) + np.arange(len(whole_at))
            more += [(self._whole if added[i] else self._by_rule)(texts[int(i)].as_py()) for i in whole_at]
        more_len = np.fromiter(map(len, more), np.int64, len(more)) // 4
        more_at = len(flat) + np.cumsum(more_len) - more_len
        flat = np.concatenate([flat, np.frombuffer(b"".join(more), "<u4")])
        if len(lost):
            start[spots[lost]], size[spots[lost]] = more_at[: len(lost)], more_len[: len(lost)]
        start = np.concatenate([start, more_at[len(lost) :]])
        size = np.concatenate([size, more_len[len(lost) :]])

        inner[first] = True
        begin = np.concatenate([[0], np.cumsum(inner)[at[1:] - 1]])
        codes = codes[inner]
        lens = size[codes]
        return ragged_take(flat, start[codes], lens), np.concatenate([[0], np.cumsum(lens)])[begin]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    n = len(at) - 1
    new_at = at + np.arange(n + 1)
    out = np.full(len(ids) + n, end_id, "<u4")
    keep = np.ones(len(out), bool)
    keep[new_at[1:] - 1] = False
    out[keep] = ids
    return out, new_at
