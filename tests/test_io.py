"""Readers, writers and merge rules."""

import os

import pytest
from pyspark.sql import functions as F

from footfall import schemas
from footfall.session import build_session, shared_root, workspace
from footfall.sinks import tables as sink
from footfall.sources import files


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_date():
    assert files.raw_log_path("/logs/", "2024-01-05") == "/logs/01/05/"
    assert files.raw_log_path("/logs").count("/") == 4  # yesterday
    for bad in ("2024-1-05", "20240105", "2024-01-05x"):
        with pytest.raises(ValueError):
            files.run_date(bad)


def test_missing_log_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.raw_log(spark, str(tmp_path), "2024-01-05").count()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == named.rstrip("/")
    assert workspace(spark, "x").startswith(named) and workspace(spark, "x") != workspace(spark, "x")


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert build_session("tests") is spark


def test_ctrl_a_keeps_quotes_and_nulls(spark, tmp_path):
    (tmp_path / "f").write_text('1\x01a "quoted" \x01\n2\x01\\N\n')
    got = files.ctrl_a(spark, str(tmp_path / "f"), schemas.KEY_VALUE)
    assert [(r["key"], r["value"]) for r in got.orderBy("key").collect()] == [(1, 'a "quoted" '), (2, None)]


def test_dimension_reader(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.createDataFrame([(1, "x", "A")], schemas.CITY_INFO).write.parquet(path)
    assert files.dimension(spark, "parquet", path, schemas.CITY_INFO).count() == 1
    with pytest.raises(Exception):
        files.dimension(spark, "jdbc", "t", url="jdbc:none:x").count()


@pytest.fixture
def stats(spark):
    return spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, x long, y long")


def test_upsert_replaces_only_its_columns(spark, stats):
    new = spark.createDataFrame([("b", None), ("c", 9)], "k string, x long")
    assert rows_of(sink.upsert_set(stats, new, ["k"]).fillna(-1)) == [("a", 1, 10), ("b", -1, 20), ("c", 9, -1)]


def test_publish_switches_versions(spark, stats, tmp_path):
    root = str(tmp_path / "table")
    assert sink.current(spark, root, stats.schema).count() == 0
    assert sink.publish(stats, root) == 0
    new = spark.createDataFrame([("b", 7)], "k string, x long")
    assert sink.publish(sink.upsert_set(sink.current(spark, root, stats.schema), new, ["k"]), root) == 1
    assert rows_of(sink.current(spark, root, stats.schema)) == [("a", 1, 10), ("b", 7, 20)]


def test_upsert_add(spark, stats):
    delta = spark.createDataFrame([("b", 5), ("c", 7)], "k string, x long")
    got = rows_of(sink.upsert_add(stats, delta, ["k"], "x").fillna(-1))
    assert got == [("a", 1, 10), ("b", 7, 20), ("c", 7, -1)]


def test_replace_group(spark):
    old = spark.createDataFrame([("d1", "p", 1), ("d1", "p", 2), ("d1", "q", 3)], "d string, p string, v int")
    new = spark.createDataFrame([("d1", "p", 9)], "d string, p string, v int")
    assert rows_of(sink.replace_group(old, new, ["d", "p"])) == [("d1", "p", 9), ("d1", "q", 3)]


def test_rerun_rewrites_only_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("m1", "2024-01-01"), ("m2", "2024-01-02")], "member_id string, created string")
    sink.overwrite(rows, path, ["created"])
    again = spark.createDataFrame([("m3", "2024-01-02")], rows.schema)
    for _ in range(2):
        sink.replace_partitions(again, path, ["created"])
    stored = spark.read.schema(rows.schema).parquet(path)
    assert rows_of(stored) == [("m1", "2024-01-01"), ("m3", "2024-01-02")]
    assert rows_of(sink.without_run(stored, "2024-01-02")) == [("m1", "2024-01-01")]


def test_a_repeated_insert_adds_nothing(spark, stats, tmp_path):
    path = str(tmp_path / "t")
    sink.insert(stats, path, ["k"])
    sink.insert(stats, path, ["k"])  # the same run again
    assert spark.read.parquet(path).count() == 2


def test_latest(spark):
    versions = spark.createDataFrame(
        [("a", "g1", 1, 0), ("a", "g1", 5, 2), ("b", "g1", 3, 1), ("b", "g2", 4, 0)],
        "k string, g string, v long, batch_id long")
    assert rows_of(sink.latest(versions, ["k", "g"])) == [("a", "g1", 5), ("b", "g1", 3), ("b", "g2", 4)]
    assert rows_of(sink.latest_groups(versions, ["g"])) == [("a", "g1", 5), ("b", "g2", 4)]


def test_known_events(spark):
    frame = spark.createDataFrame([("e_pv",), ("x",), (None,)], "en string")
    assert rows_of(files.only_known_events(frame)) == [("e_pv",)]


def test_numbered_relation(spark):
    frame = files.numbered_relation(spark, 100, F.col("id"), F.concat(F.lit("val_"), F.col("id")).alias("v"))
    assert frame.count() == 100 and frame.where("id = 100").first()["v"] == "val_100"


def _merge_counts(spark, root, rows, **options):
    from footfall.sinks import buckets
    from footfall.sinks import tables as sink

    new = spark.createDataFrame(rows, "k int, n long")
    return buckets.merge(new, root, ["k"], lambda old, d: sink.upsert_add(old, d, ["k"], "n"), new.schema, **options)


def _contents(spark, root, version=None):
    from footfall.sinks import buckets

    schema = spark.createDataFrame([], "k int, n long").schema
    return sorted(tuple(r) for r in buckets.content(spark, root, schema, version).collect())


def test_a_merge_writes_the_buckets_it_touches(spark, tmp_path):
    from footfall.sinks import buckets

    root = str(tmp_path / "t")
    assert _contents(spark, root) == []
    assert _merge_counts(spark, root, [(k, 1) for k in range(300)], buckets=16) == 0
    assert _merge_counts(spark, root, [(7, 5)], buckets=16) == 1
    assert len([f for f in os.listdir(f"{root}/data/version=1") if f.startswith("bucket=")]) == 1
    assert _contents(spark, root) == [(k, 6 if k == 7 else 1) for k in range(300)]
    assert _contents(spark, root, 0) == [(k, 1) for k in range(300)]  # a reader of the version before
    before = buckets.held_buckets(spark, root, 1)
    assert sorted(before.values()) == [0] * 15 + [1]
    _merge_counts(spark, root, [(7, 1), (None, 2)], buckets=16)
    _merge_counts(spark, root, [(7, 1)], buckets=16)
    assert dict(_contents_nulls(spark, root)) == {k: 8 if k == 7 else 1 for k in range(300)} | {None: 2}
    old = {b for b, v in before.items() if v == 1}
    assert not any(os.path.exists(f"{root}/data/version=1/bucket={b}") for b in old)  # no reader needs it
    assert not os.path.exists(f"{root}/lists/version=1")


def _contents_nulls(spark, root):
    from footfall.sinks import buckets

    return [tuple(r) for r in buckets.content(spark, root, spark.createDataFrame([], "k int, n long").schema).collect()]


def test_a_broken_merge_leaves_the_table_as_it_was(spark, tmp_path):
    from footfall.sinks import buckets

    root = str(tmp_path / "t")
    _merge_counts(spark, root, [(k, 1) for k in range(40)])
    new = spark.createDataFrame([(3, 1), (4, 1)], "k int, n long")

    def rule(old, delta):
        return old.selectExpr("k", "IF(k = 3, raise_error('broken'), n) AS n").unionByName(delta)

    with pytest.raises(Exception, match="broken"):
        buckets.merge(new, root, ["k"], rule, new.schema)
    assert _contents(spark, root) == [(k, 1) for k in range(40)] and buckets.newest(spark, root) == 0
    _merge_counts(spark, root, [(3, 1)])
    assert (3, 2) in _contents(spark, root)


def test_a_rule_may_empty_a_bucket(spark, tmp_path):
    from footfall.sinks import buckets

    root = str(tmp_path / "t")
    _merge_counts(spark, root, [(k, 1) for k in range(20)])
    gone = spark.createDataFrame([(k, 0) for k in range(20)], "k int, n long")
    buckets.merge(gone, root, ["k"], lambda old, d: old.where("false"), gone.schema)
    assert _contents(spark, root) == []


def test_totals_day_by_day(spark, tmp_path):
    from footfall.operators import kpi

    root, days = str(tmp_path / "totals"), {
        "2024-01-01": [("web", 3), (None, 1)], "2024-01-02": [("web", 2), ("app", 4)], "2024-01-03": [], "2024-01-04": [("app", 1)],
    }
    for day in ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-04"]:
        today = spark.createDataFrame(days[day], "platform string, new long")
        schema = kpi.add_day(today, root, day, ["platform"], "new", "total")
    got = {(r.date, r.platform): (r.new, r.total) for r in kpi.day_totals(spark, root, schema).collect()}
    assert got == {
        ("2024-01-01", "web"): (3, 3), ("2024-01-01", None): (1, 1),
        ("2024-01-02", "web"): (2, 5), ("2024-01-02", None): (0, 1), ("2024-01-02", "app"): (4, 4),
        ("2024-01-03", "web"): (0, 5), ("2024-01-03", None): (0, 1), ("2024-01-03", "app"): (0, 4),
        ("2024-01-04", "web"): (0, 5), ("2024-01-04", None): (0, 1), ("2024-01-04", "app"): (1, 5),
    }


def test_counters_of_the_writing_pass(spark, tmp_path):
    from footfall.operators import etl

    lines = spark.createDataFrame([("no fields",), ("1.1.1.1^A1704103200.1^Ah^A/p?en=e_pv&u_sd=s",), ("1.1.1.1^A1^Ah^A/p",)], "value string")
    parsed = etl.parse_lines(lines)
    seen = etl.store_counted(parsed, str(tmp_path / "out"))
    assert seen.collect() == etl.counters(parsed).collect() and seen.columns == etl.counters(parsed).columns
    assert spark.read.parquet(str(tmp_path / "out")).count() == seen.first()["output_records"]


def test_a_day_without_logs_is_an_error(spark, tmp_path):
    spark.range(3).selectExpr("CAST(id AS STRING) AS value").write.text(files.raw_log_path(str(tmp_path), "2024-01-15"))
    assert files.raw_log(spark, str(tmp_path), "2024-01-15").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.raw_log(spark, str(tmp_path), "2024-01-16").count()


def test_a_time_range_reads_a_small_part_of_its_days(spark, tmp_path):
    day, hour = 1_705_276_800_000, 3_600_000
    logs = spark.range(200_000).selectExpr(
        f"CAST({day} + (id * 7919) % 172800000 AS BIGINT) AS s_time", "uuid() AS u_sd", f"IF((id * 7919) % 172800000 < 86400000, '2024-01-15', '2024-01-16') AS dt"
    )
    path = sink.overwrite_clustered(logs, str(tmp_path / "logs"), ["dt"], ["s_time"], rows_per_group=2000)
    rows = files.event_log_range(spark, path, day + hour, day + 2 * hour, ["u_sd"], logs.schema)
    want = spark.read.parquet(path).where(f"s_time >= {day + hour} AND s_time < {day + 2 * hour}").count()
    assert rows.count() == want > 0
    plan = rows._jdf.queryExecution().executedPlan()
    rows.collect()
    assert "PartitionFilters: [isnotnull(dt" in plan.toString()
    assert "GreaterThanOrEqual(s_time" in plan.toString() and "LessThan(s_time" in plan.toString()
    # row groups that hold the hour, of those of the day
    import pyarrow.parquet as pq

    names = [f for f in os.listdir(f"{path}/dt=2024-01-15") if f.endswith(".parquet")]
    held = [pq.ParquetFile(f"{path}/dt=2024-01-15/{f}").metadata for f in names]
    groups = [m.row_group(i).column(0).statistics for m in held for i in range(m.num_row_groups)]
    touched = [g for g in groups if g.max >= day + hour and g.min < day + 2 * hour]
    assert len(touched) <= len(groups) / 8


def test_a_second_run_adds_no_id(spark, tmp_path):
    from footfall.operators import dims as D

    root, ids = str(tmp_path / "f"), {"p_id": ["p"], "b_id": ["b", "v"]}
    facts = lambda rows: spark.createDataFrame(rows, "p string, b string, v string, n long")
    first = [("web", "x", "1", 5), ("web", None, "1", 6), ("app", "x", "2", 7)]
    for rows in (first, first, first + [("tv", "x", "1", 8)]):
        D.store_facts(facts(rows), root, ids, "p_id")
    dim = sink.current(spark, f"{root}/p_id", D.T.StructType([D.T.StructField("id", D.T.LongType()), D.T.StructField("p", D.T.StringType())]))
    assert sorted(map(tuple, dim.collect())) == [(1, "app"), (2, "web"), (3, "tv")]
    assert sorted(tuple(r) for r in D.stored_facts(spark, root).select("p_id", "n").collect()) == [(1, 7), (2, 5), (2, 6), (3, 8)]
    assert len([f for f in os.listdir(f"{root}/p_id") if f.startswith("version=")]) == 2
