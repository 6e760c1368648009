import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from footfall.llm import exact

ROWS = [
    (1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "é" * 50_000), (7, "é" * 50_000), (8, "a "), (8, "a "),
    (None, "a"), (None, "zz"), (9, "A"),
]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_groups(make):
    assert got(exact.duplicate_groups(make(ROWS))) == brute(ROWS)


def test_colliding_hashes_are_told_apart(make):
    few = lambda c: F.pmod(F.length(c), F.lit(2))
    assert got(exact.duplicate_groups(make(ROWS), digest=few)) == brute(ROWS)


def test_one_row_stays_with_its_columns(make):
    docs = make(ROWS)
    kept = exact.unique_rows(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert rows == sorted(
        [(2, "a"), (3, "b"), (5, ""), (7, "é" * 50_000), (8, "a "), (None, "zz"), (9, "A")], key=repr
    )


def test_null_text_stays_null(make):
    assert [r["text"] for r in exact.unique_rows(make([(1, ""), (2, None)])).collect()] == [None]


def test_empty(make):
    assert exact.duplicate_groups(make([])).count() == 0
    assert exact.unique_rows(make([])).count() == 0


def test_a_large_group(ready):
    docs = ready.range(30_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', CAST(id AS STRING)) AS text")
    top = exact.duplicate_groups(docs).filter("text_sha256 = sha2('same', 256)").agg(
        F.count("*"), F.max("group_size"), F.min("keep_id"), F.sum(F.col("kept").cast("int"))
    ).first()
    assert tuple(top) == (10_000, 10_000, 29_997, 1)
