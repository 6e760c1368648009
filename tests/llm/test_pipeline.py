"""The registered corpus queries against their SQL, and the pipeline against plain Python."""

import pytest
from oracle_check import compare, connect
from test_decontaminate import brute as contaminated
from test_neardup import brute as near

import corpus_pipeline
from footfall.llm import queries


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "near_dedup", "decontaminate", "pack"
    ]


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_agrees_with_sql(ready, small, key):
    assert compare(connect(small), queries.ORACLES[key], queries.QUERIES[key](ready, small)) is None


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_returns_every_row(ready, small, key):
    rows = queries.QUERIES[key](ready, small)
    wanted = ready.read.parquet(f"{small}/documents.parquet").count()
    assert rows.select("doc_id").distinct().count() == wanted


def test_stages(ready, small, tmp_path):
    """Each stage keeps what plain Python keeps of the same input, with the columns of documents."""
    docs = ready.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in ready.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    sizes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        stage(ready, docs, small).write.parquet(f"{tmp_path}/{name}")
        docs = ready.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        after = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        sizes[name] = len(after)
        if name == "exact_dedup":
            assert after == sorted((i, t) for t, i in {t: i for i, t in sorted(before)}.items())
        if name == "near_dedup":
            assert [i for i, _ in after] == sorted(d for d, _, _, kept in near(before, 80) if kept)
        if name == "decontaminate":
            assert [i for i, _ in after] == sorted(d for d, _, hit, _ in contaminated(before, items) if not hit)
    packed = corpus_pipeline.STAGES[-1][1](ready, docs, small).toPandas()
    assert set(packed["doc_id"]) == {i for i, _ in after}
    assert (packed.groupby("sequence_id")["length"].sum() <= 1024).all()
    whole = corpus_pipeline.run(ready, small).toPandas()
    assert len(whole) == len(packed) and set(whole["doc_id"]) == set(packed["doc_id"])
    labels = ready.read.parquet(f"{small}/labels.parquet").filter("quality = 1").count()
    assert sizes["quality_classifier"] >= labels


def test_odd_rows_pass_all_stages(ready, small, tmp_path):
    """Null ids, texts and other columns, empty and very long texts, repeated rows, columns named like the operators' own."""
    for name in ("benchmark", "labels"):
        ready.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    good = ready.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = ready.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "a text without an id " * 9, None, None, 5),
         (9003, "said twice " * 30, "en", "s", 1), (9003, "said twice " * 30, "en", "s", 1), (9004, "long text goes on " * 20_000, "en", "s", 1)],
        good.schema,
    )
    docs = good.unionByName(odd).selectExpr("*", "1 AS kept", "'x' AS node", "2.5 AS score", "array(1) AS pieces", "0 AS `a.b`")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(ready, str(tmp_path)).toPandas()
    assert (out.groupby("sequence_id")["length"].sum() <= 1024).all() and len(out) > 0
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(ready, left, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        left = ready.read.parquet(f"{tmp_path}/{name}")
        assert left.columns == docs.columns
    assert left.where("doc_id = 9003").count() <= 1
    assert set(out["doc_id"].dropna()) == {r["doc_id"] for r in left.select("doc_id").collect() if r["doc_id"] is not None}


def test_no_documents(ready, small, tmp_path):
    for name in ("benchmark", "labels", "documents"):
        ready.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(ready, str(tmp_path)).count() == 0
