import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from footfall.llm import packing, simple8b, tokens
from footfall.llm.files import opened
from footfall.llm.queries import tokenizer_file

ODD = [
    "", None, " ", "  a b", "a  b", "a\n b \n c", "a b  c d", "x \x1cfoo y", "don't  stop it's <|endoftext|> ok", "a\n\n b",
    " lead", "trail ", "  ", "\n", "a 　 b", "été 3rd x9 $$$ ##", "😀 a😀 b", "a \x85b c", "the quick brown fox " * 400,
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokenizer_file())


def library(encoder, texts):
    """By a tokenizer of its own, with no setting changed."""
    fresh = Tokenizer.from_file(tokenizer_file())
    return [e.ids for e in fresh.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def split(ids, at):
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_same_ids_as_the_library(encoder):
    rng = random.Random(5)
    parts = [" ", "\n", "a", "b", "é", "1", "!", "'s", "\t", " x", "\xa0", "Ünder", "中"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    for _ in range(2):  # unknown pieces, then known ones
        assert split(*encoder.encode(pa.array(texts))) == library(encoder, texts)
    assert encoder.encode(pa.array([], pa.string()))[0].size == 0


ADDED = "<|endoftext|>"


@pytest.mark.parametrize("text", [
    ADDED, f"{ADDED} then this", f"a {ADDED} b", f"a{ADDED}b", f"at the end {ADDED}", f"{ADDED}{ADDED}", f"x {ADDED}  y {ADDED}\n z",
    f"<|endoftext {ADDED[1:]} {ADDED.upper()}", f"  {ADDED} ", f"many words and {ADDED} " * 300,
])
def test_added_tokens(encoder, text):
    texts = ["plain words", text, None, "more plain words", text]
    ids = split(*encoder.encode(pa.array(texts)))
    assert ids == library(encoder, texts)
    assert ids[1].count(50256) == text.count(ADDED)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text(texts):
    e = tokens.encoder(tokenizer_file())
    assert split(*e.encode(pa.array(texts))) == library(e, texts)


def test_a_full_table_starts_anew(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_PIECES", 10)
    texts = [f"w{i} x{i} y{i} z" for i in range(50)]
    for t in (texts[:25], texts[25:], texts):
        assert split(*encoder.encode(pa.array(t))) == library(encoder, t)


def test_pieces_met_again_stay_known(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_PIECES", 40)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    texts = [f"a often{i % 3} often{i % 3} b rare{i} c" for i in range(200)]
    encoder.known.clear()
    assert split(*encoder.encode(pa.array(texts))) == library(encoder, texts)
    known = bytes(encoder.known.text)
    assert len(encoder.known.key) <= 40 and all(b"often%d" % i in known for i in range(3)) and b"rare0" not in known


def test_memory_of_many_texts_is_that_of_a_slice(encoder):
    import tracemalloc

    texts = pa.array(["the quick brown fox jumps over the lazy dog " * 50] * 5000)  # 11 MB
    tracemalloc.start()
    try:
        ids, at = encoder.encode(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(at) == 5001 and peak < 2 * ids.nbytes + (48 << 20)


def test_new_pieces_go_to_the_library_in_parts(encoder, monkeypatch):
    asked, merge = [], encoder._merge

    def counted(groups):
        asked.append(len(groups))
        return merge(groups)

    monkeypatch.setattr(encoder, "_merge", counted)
    encoder.known.clear()
    texts = [" ".join(f"n{i}" for i in range(a, a + 100)) + " it's,ok" for a in range(0, 30_000, 100)]
    assert split(*encoder.encode(pa.array(texts))) == library(encoder, texts)
    # a piece such as " n123" is of two groups
    assert sum(asked) > 30_000 and max(asked) <= 2 * 8192


def test_the_table_of_pieces_is_bounded_in_bytes(encoder):
    encoder.known.clear()
    for part in range(12):
        texts = [f"a {chr(97 + part)}{i}{'xyz' * 5000} b" for i in range(200)]  # 3 MB of long pieces
        ids = split(*encoder.encode(pa.array(texts)))
        assert len(encoder.known.text) <= 16 << 20 and len(encoder.known.ids) <= 16 << 20
    assert ids[:2] == library(encoder, texts[:2])
    encoder.known.clear()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 63).flatmap(lambda b: st.integers(0, 2**b)), max_size=300))
def test_simple8b_round_trip(values):
    v = np.array(values * 30, np.uint64)
    words, per_block, escapes, _ = simple8b.encode_blocks(v)
    assert (simple8b.decode_blocks(words, per_block, escapes, len(v)) == v).all()


def test_simple8b_holds_what_its_selectors_say():
    ones = np.ones(simple8b.BLOCK, np.uint64)
    assert len(simple8b.encode_blocks(ones)[0]) == -(-simple8b.BLOCK // 60)
    assert len(simple8b.encode_blocks(np.full(90, 50_000, np.uint64))[0]) == 30


ROWS = [(3, "c c"), (1, "a"), (None, "n"), (2, None), (2, "two"), (5, "x y " * 5000), (4, ""), (1, "a")]


def test_files_round_trip(make, encoder):
    manifest = simple8b.write_ids(make(ROWS), tokenizer_file(), 2)
    got = [tuple(r) for r in simple8b.read_ids(manifest).orderBy("start").collect()]
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g[0] for g in got] == [r[0] for r in order]
    want = {(i, t or ""): ids + [2] for (i, t), ids in zip(ROWS, library(encoder, [t for _, t in ROWS]))}
    sums = sorted((i is None, i or 0, len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for (i, t), v in
                  [((i, t or ""), want[i, t or ""]) for i, t in ROWS])
    assert sums == sorted((g[0] is None, g[0] or 0, g[2], g[3]) for g in got)
    assert [g[1] for g in got] == np.concatenate([[0], np.cumsum([g[2] for g in got])[:-1]]).tolist()
    with opened(manifest.orderBy("number").first()["path"]) as source:  # any block by itself
        reader = simple8b.Reader(source)
        whole = np.concatenate(list(reader.streamed()))
        last = len(reader.words) - 2
        assert (reader.read(last, 1) == whole[last * simple8b.BLOCK :]).all()


def test_many_small_files_are_few_tasks(ready, make, monkeypatch):
    rows = [(i, f"text number {i}") for i in range(200)]
    ready.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = simple8b.write_ids(make(rows), tokenizer_file(), 2)
    finally:
        ready.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(manifest.inputFiles()) == 1 and manifest.count() > 1
    got = simple8b.read_ids(manifest)
    assert got.rdd.getNumPartitions() == 1
    rows_of = lambda df: [tuple(r) for r in df.orderBy("start").collect()]
    few = rows_of(got)
    assert [r[0] for r in few] == list(range(200))
    monkeypatch.setattr(simple8b, "READ_IDS", 1)
    many = simple8b.read_ids(manifest)
    assert many.rdd.getNumPartitions() == manifest.count() and rows_of(many) == few


def test_no_documents(make):
    assert simple8b.read_ids(simple8b.write_ids(make([]), tokenizer_file(), 2)).count() == 0
    assert packing.pack(packing.cut(make([]), tokenizer_file(), 2, 1024), 1024).count() == 0


def smallest(lengths, capacity):
    """The least number of sequences, by trying all."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=7))
def test_bounds_hold(lengths):
    x = np.array(sorted(lengths, reverse=True))
    sequence, offset = packing.best_fit_decreasing(x, 20)
    bound, least = packing.lower_bound(x, 20), smallest(x.tolist(), 20)
    assert bound <= least <= sequence.max() + 1
    for s in range(sequence.max() + 1):
        own = np.argsort(offset[sequence == s])
        sizes = x[sequence == s][own]
        assert sizes.sum() <= 20 and (offset[sequence == s][own] == np.cumsum(sizes) - sizes).all()


def test_large_pieces_are_certified():
    x = np.full(100, 600)
    assert packing.lower_bound(x, 1024) == 100 == packing.best_fit_decreasing(x, 1024)[0].max() + 1


def test_pack_places_every_piece_once(make, encoder):
    rng = random.Random(1)
    rows = [(i, "word " * int(rng.paretovariate(0.8))) for i in range(3000)] + [(7, None), (7, ""), (None, "x"), (None, "x")]
    rows = [(i, t[:40_000] if t else t) for i, t in rows]
    cut = packing.cut(make(rows), tokenizer_file(), 2, 256)
    out = packing.pack(cut, 256, group=300).toPandas()
    assert out["length"].sum() == sum(len(x) + 1 for x in library(encoder, [t for _, t in rows]))
    assert len(out) == cut.count() and out["length"].between(1, 256).all()
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == (g["length"].cumsum() - g["length"]).tolist()
        assert g["length"].sum() <= 256
    bound = -(-out["length"].sum() // 256)
    assert out["sequence_id"].nunique() <= bound + 2
    assert (out["group_bound"] <= out["group_sequences"]).all() and out["round"].max() > 1
    long = out[out.groupby(["doc_id"])["piece"].transform("max") > 0]
    assert (long[long["piece"] > 0]["length"] == 256).all()


def test_lengths_that_pack_no_better_are_settled(make, ready, monkeypatch):
    """Few lengths whose area bound cannot be met: exchanges that save nothing come to an end."""
    rounds, run = [], packing._round

    def counted(*args):
        rounds.append(1)
        assert len(rounds) < 12
        return run(*args)

    monkeypatch.setattr(packing, "_round", counted)
    lengths = [(357, 328)[i % 2] for i in range(1200)]
    rows = [(i, 0, 0, n, i) for i, n in enumerate(lengths)]
    out = packing.pack(ready.createDataFrame(rows, packing.PIECES), 1024, group=300).toPandas()
    assert len(out) == 1200 and out["doc_id"].is_unique and out["length"].sum() == sum(lengths)
    assert out.groupby("sequence_id")["length"].sum().max() <= 1024
    whole = packing.best_fit_decreasing(np.array(lengths), 1024)[0].max() + 1
    assert out["sequence_id"].nunique() <= whole * 1.02 + 2


def test_each_round_hands_on_fewer_sequences():
    x = np.array([575] * 400 + [269] * 400 + [187] * 200)
    sequence = packing.best_fit_decreasing(x, 1024)[0]
    n, bound = sequence.max() + 1, packing.lower_bound(x, 1024)
    for before in (0.4, 1.0, 2.0, n - 1.0, float(n), n + 0.4, n + 1.0, 1000.0):
        given = packing.handed_on(sequence, x, bound, 1024, before)
        assert len(np.unique(sequence[given])) < before


def test_equal_rows_are_dealt_apart(ready):
    out = packing.pack(ready.createDataFrame([(7, 0, 0, 600, 1)] * 1200, packing.PIECES), 1024, group=300).toPandas()
    assert len(out) == 1200 and out["sequence_id"].is_unique and out["group_sequences"].max() < 600
