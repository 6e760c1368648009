"""Token-id files in Simple-8b: whole 64-bit words, the selector in the top four bits.

A selector says how many ids of how many bits the other 60 bits hold.  An id
of more than 60 bits is an escape: selector 0 stands for the next value of the
file's escape list.  Ids are cut into blocks of ``BLOCK``; a block begins with
a new word and the footer holds where each begins, so blocks are coded and
decoded side by side by numpy and any of them can be read alone.

File: magic, words, escapes, then the footer arrays (little-endian int64):
first word of each block, first escape of each block, document ids, a byte per
document that tells null ids, lengths of documents; then their sizes, magic.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.common import column, gathered, quoted
from footfall.llm.files import new_file, opened
from footfall.llm.tokens import encoder, with_end
from footfall.session import workspace

MAGIC = b"S8BLOCK1"
BLOCK = 4096
READ_BLOCKS = 256
READ_IDS = 1 << 18  # to a task that reads files back; a larger file has a task of its own
TEXT_BYTES = 4 << 20
# Fixed values of the coding: ids per word for selectors 1..14; 60 // n bits each.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
BITS = np.array([0] + [60 // n for n in COUNTS[1:15].tolist()] + [60])
LAST = 14


WIDTH_16 = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def bit_widths(v: np.ndarray) -> np.ndarray:
    out = np.zeros(v.shape, np.uint8)
    rest, shift = v, 0
    while rest.max() > 0xFFFF:  # no pass more than the largest id needs
        low = WIDTH_16[rest & np.uint64(0xFFFF)]
        out = np.where(low > 0, low + np.uint8(shift), out)
        rest, shift = rest >> np.uint64(16), shift + 16
    low = WIDTH_16[rest]
    return np.where(low > 0, low + np.uint8(shift), out)


def encode_blocks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, words per block, escapes, escapes per block; the last block may be short."""
    n = len(values)
    if n == 0:
        none = np.zeros(0, np.uint64)
        return none, np.zeros(0, np.int64), none, np.zeros(0, np.int64)
    blocks = -(-n // BLOCK)
    span = BLOCK + int(COUNTS.max())
    v = np.zeros((blocks, span), np.uint64)
    full = n // BLOCK
    v[:full, :BLOCK] = values[: full * BLOCK].reshape(full, BLOCK)
    if n % BLOCK:
        v[full, : n % BLOCK] = values[full * BLOCK :]
    width = bit_widths(v).reshape(-1)
    # widest of the next k ids, for growing k; more ids in a word win
    best = np.zeros(len(width), np.uint8)
    widest = width.copy()
    k = 1
    for selector in range(LAST, 0, -1):
        while k < COUNTS[selector]:
            widest[:-k] = np.maximum(widest[:-k], width[k:])
            k += 1
        best[widest <= BITS[selector]] = selector
    # walk all blocks at once from word to word
    step = COUNTS[best]
    length = np.full(blocks, BLOCK)
    length[-1] = n - (blocks - 1) * BLOCK
    base = np.arange(blocks) * span
    at, starts = np.zeros(blocks, np.int64), np.zeros(len(width), bool)
    live = np.arange(blocks)
    while len(live):
        here = base[live] + at[live]
        starts[here] = True
        at[live] += step[here]
        live = live[at[live] < length[live]]
    first = np.flatnonzero(starts)
    chosen = best[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat = v.reshape(-1)
    for selector in np.unique(chosen).tolist():
        if selector == 0:
            continue
        rows = np.flatnonzero(chosen == selector)
        place = first[rows]
        word = words[rows]
        for j in range(COUNTS[selector]):
            word |= flat[place + j] << np.uint64(BITS[selector] * j)
        words[rows] = word
    escaped = first[chosen == 0]
    per_block = np.bincount(first // span, minlength=blocks)
    return words, per_block, flat[escaped], np.bincount(escaped // span, minlength=blocks)


def decode_blocks(words: np.ndarray, per_block: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of consecutive blocks."""
    if n == 0:
        return np.zeros(0, np.uint64)
    span = BLOCK + int(COUNTS.max())
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[selector]
    ends = np.cumsum(count)
    block = np.repeat(np.arange(len(per_block)), per_block)
    before = (ends - count)
    opening = np.cumsum(per_block) - per_block
    place = block * span + before - before[opening][block]
    out = np.zeros(len(per_block) * span, np.uint64)
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        if s == 0:
            out[place[rows]] = escapes
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for j in range(COUNTS[s]):
            out[place[rows] + j] = (words[rows] >> np.uint64(BITS[s] * j)) & mask
    return out.reshape(-1, span)[:, :BLOCK].reshape(-1)[:n]


class Writer:
    """Streams ids of documents into one file."""

    def __init__(self, out):
        self.out = out
        self.out.write(MAGIC)
        self.rest = np.zeros(0, np.uint64)
        self.words, self.escapes, self.escape_counts = [], [], []
        self.ids, self.nulls, self.lengths = [], [], []

    def add(self, doc_ids: list, lengths: np.ndarray, values: np.ndarray) -> None:
        self.ids.append(np.array([0 if i is None else i for i in doc_ids], "<i8"))
        self.nulls.append(np.array([i is None for i in doc_ids], np.uint8))
        self.lengths.append(lengths.astype("<i8"))
        values = np.concatenate([self.rest, values.astype(np.uint64)])
        whole = len(values) // BLOCK * BLOCK
        self._put(values[:whole])
        self.rest = values[whole:]

    def _put(self, values: np.ndarray) -> None:
        for a in range(0, len(values), READ_BLOCKS * BLOCK):
            words, counts, escapes, escape_counts = encode_blocks(values[a : a + READ_BLOCKS * BLOCK])
            self.out.write(words.astype("<u8").tobytes())
            self.words.append(counts)
            self.escapes.append(escapes)
            self.escape_counts.append(escape_counts)

    def close(self) -> tuple[int, int]:
        """Documents and ids in the file."""
        self._put(self.rest)
        join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        escapes = np.concatenate([np.zeros(0, np.uint64), *self.escapes])
        self.out.write(escapes.astype("<u8").tobytes())
        lengths, nulls = join(self.lengths), np.concatenate([np.zeros(0, np.uint8), *self.nulls])
        sizes = [join(self.words), join(self.escape_counts), join(self.ids), lengths]
        for part in sizes[:3]:
            self.out.write(part.astype("<i8").tobytes())
        self.out.write(nulls.tobytes())
        self.out.write(lengths.astype("<i8").tobytes())
        self.out.write(np.array([len(sizes[0]), len(lengths), int(lengths.sum())], "<i8").tobytes() + MAGIC)
        return len(lengths), int(lengths.sum())


class Reader:
    """Random access to one file; only the footer is held."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = source.read_at(32, size - 32)
        if tail[24:] != MAGIC:
            raise ValueError("not a token-id file, or an unfinished one")
        blocks, docs, self.n = np.frombuffer(tail[:24], "<i8").tolist()
        foot = 16 * blocks + 17 * docs
        raw = source.read_at(foot, size - 32 - foot)
        words, escapes = np.frombuffer(raw[: 16 * blocks], "<i8").reshape(2, blocks)
        raw = raw[16 * blocks :]
        self.nulls = np.frombuffer(raw[8 * docs : 9 * docs], np.uint8).astype(bool)
        self.doc_ids = np.frombuffer(raw[: 8 * docs], "<i8")
        self.lengths = np.frombuffer(raw[9 * docs :], "<i8")
        self.words = np.concatenate([[0], np.cumsum(words)])
        self.escapes = np.concatenate([[0], np.cumsum(escapes)])

    def read(self, first_block: int, blocks: int) -> np.ndarray:
        """The values of some blocks."""
        last = min(first_block + blocks, len(self.words) - 1)
        a, b = int(self.words[first_block]), int(self.words[last])
        words = np.frombuffer(self.source.read_at(8 * (b - a), len(MAGIC) + 8 * a), "<u8")
        c, d = int(self.escapes[first_block]), int(self.escapes[last])
        escapes = np.frombuffer(
            self.source.read_at(8 * (d - c), len(MAGIC) + 8 * (int(self.words[-1]) + c)) if d > c else b"", "<u8"
        )
        n = min(last * BLOCK, self.n) - first_block * BLOCK
        return decode_blocks(words, np.diff(self.words[first_block : last + 1]), escapes, n)

    def streamed(self) -> Iterator[np.ndarray]:
        for block in range(0, len(self.words) - 1, READ_BLOCKS):
            yield self.read(block, READ_BLOCKS)

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of one document after the other."""
        stream, held = self.streamed(), np.zeros(0, np.uint64)
        for length in self.lengths.tolist():
            parts, have = [held], len(held)
            while have < length:
                parts.append(next(stream))
                have += len(parts[-1])
            joined = parts[0] if len(parts) == 1 else np.concatenate(parts)
            yield joined[:length]
            held = joined[length:]


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all texts, in ascending order of id, to files in the shared folder.

    Returns one row per file: number (files stand in the order of ids), path,
    n_docs, n_ids.  Null ids come first; repeated ids are ordered by text; a
    null text is empty and has the end id alone.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "token-ids")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        path, done = f"{folder}/part-{number:06d}.s8b", None
        with _maybe_file(path) as start:
            for t in gathered(batches, TEXT_BYTES):
                ids, at = with_end(*encoder(tokenizer).encode(column(t, "text")), end_id)
                start().add(column(t, "doc_id").to_pylist(), np.diff(at), ids)
                pa.default_memory_pool().release_unused()
            done = start.finish()
        if done:
            yield pa.RecordBatch.from_pydict(
                {"number": [number], "path": [path], "n_docs": [done[0]], "n_ids": [done[1]]}, _MANIFEST
            )

    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), text.alias("text"))
    # The hash lets a range border fall between rows of one repeated id.
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    manifest = ordered.mapInArrow(write, "number int, path string, n_docs long, n_ids long")
    where = f"{folder}/manifest"
    # In one file: a row per token file is little, and a committed file costs its executor several processes.
    manifest.repartition(1).write.parquet(where)
    return spark.read.parquet(where)


_MANIFEST = pa.schema([("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


class _maybe_file:
    """A file that is made when the first rows come."""

    def __init__(self, path: str):
        self.path, self.context, self.writer, self.done = path, None, None, None

    def __enter__(self):
        return self

    def __call__(self) -> Writer:
        if self.writer is None:
            self.context = new_file(self.path)
            self.writer = Writer(self.context.__enter__())
        return self.writer

    def finish(self) -> tuple[int, int] | None:
        return self.writer.close() if self.writer else None

    def __exit__(self, *error):
        return self.context.__exit__(*error) if self.context else None


def read_ids(manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32, one row per document."""
    files, ids = manifest.agg(F.count("*"), F.coalesce(F.sum("n_ids"), F.lit(0))).first()
    order = W.orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("start"))
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(path) as source:
                    reader = Reader(source)
                    begin = start + np.cumsum(reader.lengths) - reader.lengths
                    docs = reader.documents()
                    for a in range(0, len(begin), 4096):
                        b = min(a + 4096, len(begin))
                        sums = [zlib.crc32(next(docs).astype("<u4").tobytes()) for _ in range(a, b)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[a:b], mask=reader.nulls[a:b]),
                                pa.array(begin[a:b]),
                                pa.array(reader.lengths[a:b]),
                                pa.array(sums, pa.int64()),
                            ],
                            schema=schema,
                        )

    tasks = min(files, -(-ids // READ_IDS))  # small files share one
    return placed.repartition(max(1, tasks)).mapInArrow(read, kind)
