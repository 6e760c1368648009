"""Hard negatives against a search of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import negatives
from footfall.llm.negatives import Wanted


def brute(rows, is_anchor, wanted):
    good = [
        (i, [int(x) for x in v], c) for i, v, c in rows
        if i is not None and v is not None and c is not None
        and all(x is not None and abs(x) < negatives.COMPONENT_LIMIT for x in v)
    ]
    out = []
    for a, (anchor, q, label) in enumerate(good):
        if not is_anchor(anchor):
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, c) for b, (i, v, c) in enumerate(good) if b != a]
        positives = sorted((s, i) for s, i, c in scored if c == label)[: wanted.positives]
        others = sorted((s, i) for s, i, c in scored if c != label)
        for p, positive in positives:
            fit = [(s, i) for s, i in others if wanted.low * -p <= 100 * -s <= wanted.high * -p]
            out += [(anchor, positive, k + 1, i, -p, -s) for k, (s, i) in enumerate(fit[: wanted.negatives])]
    return sorted(out)


def mined(ready, rows, every=3, wanted=Wanted()):
    frame = ready.createDataFrame(rows, "vec_id long, vector array<long>, label int").selectExpr(
        "*", "1 AS cell", "2 AS id", "'x' AS times", "0 AS anchor"
    ).repartition(3)
    got = negatives.hard_negatives(frame, F.col("vec_id") % every == 0, wanted)
    return sorted(tuple(r) for r in got.collect())


def clustered(n, width, seed):
    rng = np.random.default_rng(seed)
    middle = rng.integers(-200, 200, (6, width))
    return [(i, (middle[rng.integers(6)] + rng.integers(-30, 30, width)).tolist(), int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("width", [1, 2, 7, 16])
def test_all_rows_are_covered(ready, monkeypatch, width):
    monkeypatch.setattr(negatives, "CELL_ROWS", 4)
    rows = clustered(300, width, width)
    assert mined(ready, rows) == brute(rows, lambda i: i % 3 == 0, Wanted())


def test_ties_copies_and_odd_rows(ready):
    rows = [(i, [i % 3, 2, -(i % 2)], i % 2) for i in range(120)]  # very many equal vectors
    rows += [(3, [5, 5, 5], 1)] * 14 + [(3, [5, 5, 4], 1)]  # an id that repeats
    rows += [(6, None, 1), (9, [1, None, 2], 0), (12, [1, 2, 3], None), (None, [1, 2, 3], 1), (15, [], 0), (18, [7], 1)]
    rows += [(21, [1 << 40, 0, 0], 0), (24, [1 << 25, 3, 1], 0), (27, [1 << 25, 0, 1], 1), (30, [-3, -3, -3], 2)]
    assert mined(ready, rows) == brute(rows, lambda i: i % 3 == 0, Wanted())


def test_other_numbers_of_rows(ready):
    rows, wanted = clustered(90, 5, 1), Wanted(positives=2, negatives=3, low=0, high=150)
    assert mined(ready, rows, 2, wanted) == brute(rows, lambda i: i % 2 == 0, wanted)


def test_nothing_to_find(ready):
    assert mined(ready, []) == []
    assert mined(ready, [(1, [1], 0)]) == []  # no anchor
    assert mined(ready, [(3, [1], 0)]) == []  # an anchor alone
    assert mined(ready, [(3, [1], 0), (6, [1], 0)]) == []  # nothing of another label


def test_a_third_of_all_rows_are_equal(ready):
    same = ready.range(3000).selectExpr("id AS vec_id", "array(3, 1, 2) AS vector", "1 AS label")
    rest = ready.range(3000, 9000).selectExpr("id AS vec_id", "array(id % 7, id % 5, id % 3) AS vector", "int(id % 3) AS label")
    got = negatives.hard_negatives(same.unionByName(rest), F.col("vec_id") == 30).collect()
    rows = [(r.vec_id, [int(x) for x in r.vector], r.label) for r in same.unionByName(rest).collect()]
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i == 30, Wanted())


def test_cells_come_by_falling_bound():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=9), rng.normal(size=13)
    got = list(negatives.by_bound(a, b))
    assert [x[0] for x in got] == sorted((x + y for x in a for y in b), reverse=True)
    assert len({x[1:] for x in got}) == len(a) * len(b)


def test_far_cells_are_not_read(ready, monkeypatch):
    """Two far groups: an anchor's search ends before it meets the other one."""
    books = negatives.Codebooks(1, np.array([[0.0], [1000.0]]), np.array([[0.0], [1000.0]]))
    seen = []

    class Held:
        directory, kind = {0: [(0, 0, 5000)], 3: [(1, 0, 5000)]}, "float32"

        def parts(self, cell):
            seen.append(cell)
            x = np.full((50, 2), 1000.0 if cell else 0.0, "float32")
            yield np.arange(50), np.ones(50, np.int32), np.arange(50) % 2, x

    search = negatives.Search(books, (np.zeros(2), np.zeros(2)), Held(), np.array([[9, 9]]))
    negatives._searched(search, np.array([0]), Wanted(high=100))
    assert set(seen) == {3}
