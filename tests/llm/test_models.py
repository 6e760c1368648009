"""The quality classifier and the language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm import lm, quality

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(1, None), (2, ""), (3, " \n"), (4, "word " * 30_000), (None, "x"), (5, "| | |"), (5, "| | |"), (6, "é")]


def test_features_by_hand():
    x = quality.features(pa.array(["Aa b! b b\n|", None, "", "aé é1"]))
    f = dict(zip(quality.FEATURES, x[0]))
    assert abs(f["log_words"] - math.log1p(5)) < 1e-12 and f["distinct"] == 4 / 5 and f["top"] == 2 / 5
    assert f["repeat"] == 1 / 5 and f["upper"] == 1 / 5 and f["bang"] == f["bar"] == f["lines"] == 1 / 5
    assert f["distinct_3"] == 1.0 and not x[1].any() and not x[2].any()
    one = quality.features(pa.array(["a b c a b c a b c"]))[0]
    assert abs(dict(zip(quality.FEATURES, one))["distinct_3"] - 3 / 7) < 1e-12


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs
    fresh = rng.random((1000, 3))
    right = (model.score(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))
    assert right.mean() > 0.9


def test_labels_of_one_kind_or_none():
    assert quality.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert quality.fit(np.zeros((4, 3)), np.ones(4)).score(np.zeros((1, 3)))[0] > 0.99


def test_held_out_labels(ready, small):
    docs = ready.read.parquet(f"{small.replace('0.001', '0.1')}/documents.parquet").filter("doc_id < 3000")
    labels = ready.read.parquet(f"{small.replace('0.001', '0.1')}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = quality.train(docs, labels, ~held, sample=1500)
    out = quality.score(docs, model).join(labels, "doc_id").filter(held).toPandas()
    good, bad = out[out["quality"] == 1]["score"], out[out["quality"] == 0]["score"]
    assert len(bad) > 5 and (good >= 0.3).mean() > 0.99 and (bad < 0.3).mean() > 0.8
    assert (good.to_numpy()[:, None] > bad.to_numpy()).mean() > 0.99


def test_odd_rows_are_scored_and_columns_kept(make, ready):
    docs = make(ODD)
    labels = ready.createDataFrame([(4, 0), (5, 1), (6, 1), (6, None), (None, 1), (4, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.lit(True))
    assert sorted(repr(r["doc_id"]) for r in quality.score(docs, model).collect()) == sorted(repr(i) for i, _ in ODD)
    kept = quality.keep_good(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    none = make([])
    empty = quality.train(none, labels.limit(0), F.lit(True))
    assert quality.score(none, empty).count() == 0 and empty.score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP)) + [None]


def check_base(rows, out, train):
    known = Counter(w for i, t in rows if train(i) for w in words(t))
    n, v = sum(known.values()), len(known)
    want = sorted(
        (
            (i, train(i), len(words(t)), sum(known[w] > 0 for w in words(t)), n,
             round(sum(math.log10((known[w] + 1) / (n + v + 1)) for w in words(t)), 6))
            for i, t in rows
        ),
        key=repr,
    )
    got = [(r["doc_id"], r["train"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out]
    assert sorted(got, key=repr) == want


def test_counts_and_base_score(make, monkeypatch):
    monkeypatch.setattr(lm, "TEXT_BYTES", 2000)  # many chunks
    rng = random.Random(2)
    rows = ODD + [(i, " ".join(rng.choice(["the", "Cat", "sat", f"w{rng.randrange(300)}"]) for _ in range(40))) for i in range(10, 200)]
    train = lambda i: i is None or i % 7 != 2
    out = lm.score_texts(make(rows), F.coalesce(F.col("doc_id") % 7 != 2, F.lit(True)), epochs=1).collect()
    check_base(rows, out, train)
    assert all(r["score"] < 0 for r in out)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    n = lm.TOP + 150
    model = lm.Model(rng.integers(0, 50, n))
    model.q *= 5
    for a, b in ((3, 9), (model.start, model.start), (model.start, 0)):
        p = model.log10(np.full(n, a), np.full(n, b), np.arange(n))
        assert abs((10.0**p).sum() - 1) < 1e-6


def test_contexts_stop_at_text_borders():
    s = 99
    two, one = lm._contexts(np.array([5, 6, 7, 8, 9, 4]), np.array([0, 3, 4, 6]), s)
    assert one.tolist() == [s, 5, 6, s, s, 9] and two.tolist() == [s, s, 5, s, s, s]


def test_it_learns_order(make):
    """Held-out texts of a fixed order are likelier than by counts alone."""
    rng = random.Random(4)
    cycle = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, " ".join(cycle[(s + k) % 8] for k in range(60))) for i in range(300) for s in [rng.randrange(8)]]
    out = lm.score_texts(make(rows), F.col("doc_id") % 7 != 2, epochs=2).filter("not train").toPandas()
    assert (out["score"] > out["base_score"] * 0.7).all()


def test_nothing_to_learn_from(make):
    out = lm.score_texts(make(ODD), F.lit(False)).collect()
    check_base(ODD, out, lambda i: False)
    assert lm.score_texts(make([]), F.lit(True)).count() == 0


def test_real_texts(ready, small):
    docs = ready.read.parquet(f"{small}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    out = lm.score_texts(docs, ~held).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_base(rows, out, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    assert sum(r["score"] for r in out if not r["train"]) > sum(r["base_score"] for r in out if not r["train"])


def test_words_of_a_class_sum_to_one():
    rng = np.random.default_rng(3)
    counts = np.sort(rng.integers(lm.OWN, 500, 150))[::-1].astype(float)
    out = (lm.own_start(counts, 7.0) + rng.normal(0, 1, (3 + 1 + 150, lm.SIZE + 1))).astype(np.float32)
    rank = np.arange(-1, 150)
    h = np.repeat(rng.normal(0, 1, (1, lm.SIZE + 1)).astype(np.float32), len(rank), axis=0)
    assert abs(np.exp(lm.in_class(h, rank, out, 150)[0]).sum() - 1) < 1e-4


def test_words_of_one_class_are_told_apart(make, monkeypatch):
    """Beyond the most frequent words, and of one ending: only vectors of their own can tell what follows."""
    monkeypatch.setattr(lm, "TEXT_BYTES", 20_000)
    rng = random.Random(6)
    filler = [f"top{i}" for i in range(lm.TOP)]
    pairs = [(f"{a}in", f"{a}zz") for a in "bcdfghjk"]
    text = lambda: " ".join(w for _ in range(10) for w in rng.choice(pairs))
    rows = [(i, " ".join(filler * 40)) for i in range(0, 140, 7)] + [(i, text()) for i in range(1, 140) if i % 7]
    def held_out(own):
        monkeypatch.setattr(lm, "OWN", own)
        return lm.score_texts(make(rows), F.col("doc_id") % 7 != 2, epochs=2).filter("not train").agg(F.sum("score")).first()[0]

    assert held_out(10) > held_out(10**9) + 20  # 20 texts


def test_a_chunk_that_holds_only_rarer_words_of_a_class(ready):
    """One partition has the words with vectors, another one only a rarer word of their class."""
    common = " ".join(f"w{i}xx" for i in range(300))
    rows = [(0, " ".join([common] * 12), 0), (1, "onceqxx plain", 1), (3, "plain w5xx onceqxx", 1)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, p int").repartitionByRange(2, "p")
    out = lm.score_texts(docs, F.lit(True), epochs=1).collect()
    check_base([r[:2] for r in rows], out, lambda i: True)


def test_groups_of_many_words_become_several_classes(make, monkeypatch):
    """The size of a class is bounded; tokens of all classes stay normalised and better than counts."""
    for name, value in (("SLAB", 3), ("TEXT_BYTES", 20_000)):
        monkeypatch.setattr(lm, name, value)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(words[(s + k) % 900] for k in range(200))) for i in range(210) for s in [rng.randrange(900)]]
    out = lm.score_texts(make(rows), F.col("doc_id") % 7 != 2, epochs=2)
    check_base(rows, out.collect(), lambda i: i % 7 != 2)
    held = out.filter("not train").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]
