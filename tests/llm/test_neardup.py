import random

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import neardup
from footfall.llm.components import components
from footfall.llm.words import Words

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = [x for x in (text or "").translate(UP).translate({c: " " for c in range(9, 14)}).split(" ") if x]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        low[i] = min(ids, default=None) if sets[i] else doc
    return sorted(((d, len(sets[i]), low[i], d == low[i]) for i, (d, _) in enumerate(rows)), key=repr)


def edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed):
    rng = random.Random(seed)
    rows = [(None, "null id text here now"), (500, None), (501, ""), (502, " \n\t"), (503, "a b"), (504, "A  b"), (505, "b a")]
    rows += [(506, "one two three four five"), (507, "One two\nthree four five"), (507, "one two three four six"), (503, "a b")]
    rows += [(508, "long text " * 9000), (509, "long text " * 9001), (510, "a\x1cb c\x85d e\xa0f")]
    for family in range(12):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(rng.randrange(60, 400))]
        for _ in range(rng.randrange(2, 14)):
            text = edited(rng, base, rng.randrange(0, max(2, len(base) // 25)))
            rows.append((rng.randrange(10_000), text))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(20_000 + i, passage + " " + " ".join(f"u{i}x{j}" for j in range(rng.randrange(10, 60)))) for i in range(30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [85, 80])
def test_as_by_trying_all_pairs(make, percent):
    rows = corpus(percent)
    got = neardup.near_duplicates(make(rows), percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, percent)


def test_chains_and_a_key_of_many_components(make, monkeypatch):
    """Neighbours of a chain are alike, its ends are not; keys hold more nodes than one block."""
    monkeypatch.setattr(neardup, "RUN", 8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(25):
        rows.append((1000 - i, " ".join(words[i * 6 : i * 6 + 200])))
    common = [f"c{i}" for i in range(200)]  # half shared: keys meet, links do not
    for i in range(60):
        rows.append((2000 + i, " ".join(common + [f"own{i}x{j}" for j in range(90 + i % 3)])))
    got = neardup.near_duplicates(make(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = brute(rows, 85)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert len({c for d, _, c, _ in want if d <= 1000}) == 1


def test_every_pair_within_reach_shares_its_first_key():
    rng = np.random.default_rng(0)
    for filing in (neardup.Filing(), neardup.Filing(16, 4), neardup.Filing(3, 2)):
        a = rng.integers(0, 1 << 16, (300, filing.places)).astype(np.uint16)
        b = a.copy()
        for row in b:
            gone = rng.choice(filing.places, rng.integers(0, filing.reach + 1), replace=False)
            row[gone] ^= 1
        shared = neardup.keys_of(a, filing) == neardup.keys_of(b, filing)
        assert shared.any(axis=1).all()
        assert (shared.argmax(axis=1) == neardup.first_slot(a == b, filing)).all()


def test_the_words_are_cut_as_stated():
    w = Words(pa.array(["  A b\nÉ ", None, "", "x\x0by\x1cz"]))
    words = w.words.to_pylist()
    assert [[words[c] for c in w.code[a:b]] for a, b in zip(w.at[:-1], w.at[1:])] == [["a", "b", "É"], [], [], ["x", "y\x1cz"]]


def thue_morse(a, b, doublings):
    """Sequences that sums of powers modulo 2^64 do not tell apart."""
    x, y = [a], [b]
    for _ in range(doublings):
        x, y = x + y, y + x
    return x, y


def test_texts_built_to_collide_stay_apart(make):
    letters = ["".join(t) for t in thue_morse("a", "b", 11)]
    words = [" ".join(t) for t in thue_morse("aa", "b", 11)]
    rows = [(1, letters[0]), (2, letters[1]), (3, words[0] + " x"), (4, words[1] + " y z z z z"), (5, words[0]), (6, words[1])]
    got = neardup.near_duplicates(make(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == brute(rows, 85)
    assert len(set(neardup.sequence_digests(pa.array(letters + words)))) == 4
    assert len(set(Words(pa.array(letters)).hashes().tolist())) == 2


def test_one_large_component_is_not_compared_with_itself(ready, monkeypatch):
    """Rows dealt to blocks grow with the rows, not with their square."""
    monkeypatch.setattr(neardup, "RUN", 16)
    rows = ready.range(4000).selectExpr("7 AS key", "id AS node", "IF(id < 3980, 0, id) AS label")
    met = neardup._meetings(rows.join(neardup._sides(rows, "key", neardup.F.lit(1 / 16)), "key"), "key")
    assert met.count() < 4000 * 4 + 20 * 400
    pairs = {(a, b) for r in met.groupBy("i", "j").agg(neardup.F.collect_list("node").alias("n")).collect() for a in r.n for b in r.n}
    assert {(a, b) for a in range(0, 4000, 97) for b in range(3980, 4000)} <= pairs


def test_one_of_each_keeps_all_columns(make):
    rows = corpus(3)
    docs = make(rows)
    kept = neardup.one_of_each(docs, 85)
    assert kept.columns == docs.columns
    want = sorted((d, n) for d, n, _, k in brute(rows, 85) if k and d is not None)
    assert sorted((r["doc_id"], len(shingles(r["text"]))) for r in kept.collect() if r["doc_id"] is not None) == want


def test_empty(make):
    assert neardup.near_duplicates(make([])).count() == 0
    assert neardup.one_of_each(make([]), 80).count() == 0
    assert [tuple(r)[2:] for r in neardup.near_duplicates(make([(1, None)])).collect()] == [(0, 1, True)]


def test_too_low_a_similarity_is_refused(make):
    with pytest.raises(ValueError):
        neardup.near_duplicates(make([]), 50)


def test_components(ready):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (102, 101)]
    first = components(ready.createDataFrame(links, "a long, b long"))
    label = {r["node"]: r["label"] for r in first.collect()}
    assert label == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    more = components(ready.createDataFrame([(50, 102), (60, 61), (5, 6)], "a long, b long"), first)
    label = {r["node"]: r["label"] for r in more.collect()}
    assert label == {i: 0 for i in range(41)} | {i: 50 for i in (50, 100, 101, 102)} | {60: 60, 61: 60}
    assert components(ready.createDataFrame([], "a long, b long")).count() == 0
