"""Skew-safe forms give the same rows as the plain ones."""

import __spark_entry__ as entry
import pytest
from oracle_check import compare
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.operators import skew
from footfall.sources import tables as src


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def steps(spark, skewed):
    logs = src.event_logs(spark, skewed)
    return logs.select("u_sd", "s_time", "event_id", (F.col("k") % 10).alias("v"))


@pytest.mark.parametrize("hot_rows", [1, 20, 10**9])
@pytest.mark.parametrize("forward", [False, True])
def test_neighbour(steps, hot_rows, forward):
    order = ["s_time", "event_id"]
    w = W.partitionBy("u_sd").orderBy(*order)
    plain = steps.withColumn("n", (F.lead if forward else F.lag)("v").over(w))
    sliced = skew.time_sliced(steps, ["u_sd"], F.col("s_time"), hot_rows=hot_rows)
    got = skew.sliced_neighbour(sliced, ["u_sd"], "_slice", order, {"v": "n"}, forward).drop("_slice")
    assert rows_of(got.fillna(-1)) == rows_of(plain.fillna(-1))


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_running_sum(steps, hot_rows):
    order = ["s_time", "event_id"]
    w = W.partitionBy("u_sd").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    plain = steps.withColumn("t", F.sum("v").over(w))
    sliced = skew.time_sliced(steps, ["u_sd"], F.col("s_time"), hot_rows=hot_rows)
    got = skew.sliced_running_sum(sliced, ["u_sd"], "_slice", order, F.col("v"), "t").drop("_slice")
    assert rows_of(got) == rows_of(plain)


def test_hot_group_is_sliced(steps):
    sliced = skew.time_sliced(steps, ["u_sd"], F.col("s_time"), hot_rows=50)
    total = steps.count()
    hot = steps.groupBy("u_sd").count().agg(F.max("count")).first()[0]
    fullest = sliced.groupBy("u_sd", "_slice").count().agg(F.max("count")).first()[0]
    assert hot > total / 4 and fullest < total / 20


@pytest.mark.parametrize("rows, distinct, hot_rows, items", [
    (200_000, 150_000, 900, 1024), (200_000, 150_000, 2000, 65_536), (5_000, 10, 400, 256), (5_000, 10, 10**6, 256),
])
def test_hot_keys_are_all_found(spark, rows, distinct, hot_rows, items):
    """Every key over the bound, with its exact count, and no other."""
    of = F.when(F.col("id") % 5 == 0, F.col("id") % 35).when(F.col("id") % 11 == 0, None).otherwise(F.hash("id") % distinct)
    df = spark.range(rows).repartition(7).select(of.alias("a"), (F.col("id") % 2).alias("b"), F.lit(1).alias("x"))
    for keys in (["a"], ["a", "b"]):
        limit = max(hot_rows, 7 * df.dropna(subset=keys).count() // items + 1)
        want = rows_of(df.dropna(subset=keys).groupBy(*keys).count().where(F.col("count") >= limit))
        got = skew.hot_keys(df, keys, hot_rows, items)
        assert (rows_of(got) if got is not None else []) == want


def test_no_rows_have_no_hot_key(spark):
    empty = spark.createDataFrame([], "k int, s_time long")
    assert skew.hot_keys(empty, ["k"], 1) is None
    assert skew.hot_keys(spark.createDataFrame([(None,)] * 9, "k int"), ["k"], 1) is None
    assert skew.time_sliced(empty, ["k"], F.col("s_time")).columns == ["k", "s_time"]


def test_looking_for_hot_keys_shuffles_no_key(spark):
    """The exchange of the sketch carries a row per task."""
    rows = spark.range(100_000).select((F.col("id") % 50_000).alias("k"))
    plain = rows.groupBy(F.spark_partition_id()).agg(F.expr("approx_top_k_accumulate(k, 1024)")).count()
    assert plain == rows.rdd.getNumPartitions()
    assert skew.hot_keys(rows, ["k"], 1000) is None


def test_numbered(spark):
    rows = [(None if i % 3 == 0 else i % 2, i * 7919 % 1000, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, v int, id int")
    w = W.partitionBy("g").orderBy(F.desc("v"), "id")
    want = df.withColumn("n", F.row_number().over(w).cast("bigint"))
    got = skew.numbered(df, [F.desc("v"), F.asc("id")], "n", ["g"])
    assert rows_of(got.fillna(-1)) == rows_of(want.fillna(-1))
    whole = skew.numbered(df, ["v", "id"], "n")
    assert [r["n"] for r in whole.orderBy("v", "id").collect()] == list(range(1, 501))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins(spark, how):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k int, x int")
    right = spark.createDataFrame([(i, f"r{i}") for i in range(0, 300, 2)] + [(1, "a"), (1, "b")], "k int, y string")
    want = rows_of(left.join(right, "k", how).fillna(""))
    assert rows_of(skew.salted_join(left, right, "k", 7, how).fillna("")) == want
    assert rows_of(skew.skew_split_join(left, right, "k", hot_rows=30, how=how).fillna("")) == want


def test_null_keys_in_split_join(spark):
    left = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, x int")
    right = spark.createDataFrame([(1, "a")], "k int, y string")
    got = skew.skew_split_join(left, right, "k", hot_rows=1, how="left")
    assert rows_of(got.fillna(-1).fillna("")) == rows_of(left.join(right, "k", "left").fillna(-1).fillna(""))


def test_three_million_rows_of_one_session_are_cut(spark, tmp_path):
    """Columns compress a hot key best, so no size tells how many rows there are."""
    path = str(tmp_path / "hot")
    spark.range(3_000_000).selectExpr("'s' AS u_sd", "1704103200000 + id div 50 AS s_time").write.option(
        "compression", "zstd"
    ).parquet(path)
    rows = spark.read.parquet(path)
    sliced = skew.time_sliced(rows, ["u_sd"], F.col("s_time"), hot_rows=100_000)
    per = sliced.groupBy("_slice").count().agg(F.max("count"), F.sum("count")).first()
    assert per[0] < 100_000 and per[1] == 3_000_000


def test_equal_rows_are_numbered_by_many_tasks(spark):
    rows = spark.range(60_000).select(F.lit(1).alias("g"), F.lit("same").alias("v"))
    out = skew.numbered(rows, ["v"], "n", ["g"])
    assert out.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (60_000, 1, 60_000)
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(8, "g", "v", "_tie")
    assert spread.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_top_beyond_the_limit_of_the_optimizer(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("k"), "id")
    got = skew.top_per_group(rows, ["k"], [F.desc("id")], 1500)
    assert got.count() == 4500 and got.agg(F.min("id")).first()[0] == 20_000 - 4500


def test_ip_region_as_by_trying_all_ranges(spark):
    import random

    from footfall import schemas
    from footfall.operators import joins
    from footfall.sources.files import literal_relation

    rng = random.Random(3)
    dotted = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    ranges = [(0, 2**32 - 1), (5 << 24, (7 << 24) - 1), (5 << 24, 5 << 24), ((5 << 24) + 65535, (5 << 24) + 65536)]
    for size in (3, 300, 70_000, 200_000, 1 << 24, 40 << 20):
        for _ in range(12):
            lo = rng.randrange(4 << 24, 9 << 24)
            ranges.append((lo, lo + rng.randrange(size)))
    ranges += [(a // 65536 * 65536, b // 65536 * 65536 + 65535) for a, b in ranges[-20:]]
    probes = [x + d for a, b in ranges for x in (a, b) for d in (-1, 0, 1) if 0 <= x + d < 2**32]
    probes += [rng.randrange(3 << 24, 10 << 24) for _ in range(500)]
    named = literal_relation(spark, [(dotted(a), dotted(b), f"{a}-{b}") for a, b in ranges], schemas.IP_RANGE)
    rows = [(i, dotted(n)) for i, n in enumerate(probes)] + [(-1, None), (-2, "x")]
    got = joins.ip_region(spark.createDataFrame(rows, "i int, ip string"), named).collect()
    want = {-1: None, -2: None}
    for i, n in enumerate(probes):
        a, b = min((r for r in ranges if r[0] <= n <= r[1]), key=lambda r: (r[1] - r[0], r[0]))
        want[i] = f"{a}-{b}"
    assert len(got) == len(rows) and {r["i"]: r["region"] for r in got} == want


def test_patterns_of_all_kinds(spark):
    import re

    from footfall.operators import joins

    hosts = [f"h{i}.example" for i in range(30)] + ["x.h3.example", "hh", "other", "a.b", "aXb", "ab", "a", "q1", "z|z"]
    patterns = [(100 + i, f"h{i}.example") for i in range(0, 30, 2)] + [
        (50, "h1"), (200, "h[35].example"), (201, "a.b"), (202, "ab?"), (203, ".*her"), (204, "q1|hh"), (205, "(x).+"), (206, "a{1}b")]
    rows = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)] + [(99, None)], "i int, p_ref string")
    got = joins.inbound_of(rows, spark.createDataFrame(patterns, "id int, url string"), [])
    hit = lambda h: min((i for i, p in patterns if h.startswith(p) or re.fullmatch(p, h)), default=2)
    assert {r["i"]: r["inbound"] for r in got.collect()} == {i: hit(h) for i, h in enumerate(hosts)} | {99: 0}


def test_two_phase_count(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    assert rows_of(skew.two_phase_count(df, ["k"])) == rows_of(df.groupBy("k").agg(F.count(F.lit(1)).alias("n")))


def test_chunked_lists(spark):
    df = spark.createDataFrame([("a", i) for i in range(25)] + [("b", 1)], "k string, v int")
    got = {(r["k"], r["chunk"]): r["values"] for r in skew.chunked_lists(df, "k", "v", ["v"], 10).collect()}
    assert got == {("a", 0): list(range(10)), ("a", 1): list(range(10, 20)), ("a", 2): list(range(20, 25)), ("b", 0): [1]}


SKEWED_QUERIES = [
    "page_transitions", "page_convert_rate", "kpi_inbound_bounce", "session_landing_segments", "kpi_fact_export",
    "kpi_location", "kpi_hourly_sessions", "first_seen_running_blacklist", "stratified_session_extract",
    "skew_split_join", "salted_expand_join", "join_session_user", "semi_session_detail", "order_total_revenue",
    "top10_sessions_per_category", "grade_rank", "event_rollup", "stream_province_top3", "category_click_order_pay",
]


@pytest.mark.parametrize("key", SKEWED_QUERIES)
def test_queries_on_skewed_tables(spark, skewed, key):
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{skewed}/{t}.parquet/*.parquet'")
    con.execute("SET TimeZone = 'UTC'")
    assert compare(con, entry.oracle_sql()[key], entry.queries()[key](spark, skewed)) is None


def test_very_many_ranges_in_one_network(spark):
    """65,536 nested and touching ranges of one /16 network: rows grow with the ranges."""
    from footfall.operators import joins

    dotted = "concat_ws('.', '10', '1', CAST({0} div 256 AS STRING), CAST({0} % 256 AS STRING))"
    lo, hi = "(id % 65536)", "least(65535, id % 65536 + CAST(id div 65536 AS INT) * 500)"
    ranges = spark.range(131_072).selectExpr(f"{dotted.format(lo)} AS begin_ip", f"{dotted.format(hi)} AS end_ip", "CAST(id AS STRING) AS region")
    probes = spark.range(0, 65_536, 13).selectExpr(f"{dotted.format('id')} AS ip", "id")
    out = joins.ip_region(probes, ranges)
    assert out.where("region <> CAST(id AS STRING)").count() == 0 and out.count() == probes.count()


@pytest.mark.parametrize("remainders", [False, True])
def test_sample_follows_the_hours(spark, remainders):
    from footfall.operators import sessions as S

    hours = {0: 50, 1: 30, 2: 17, 5: 3}
    rows = [(f"s{h}-{i}", f"2024-01-0{d} {h:02d}:10:00") for d in (1, 2) for h, n in hours.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "session_id string, start string").selectExpr(
        "session_id", "CAST(start AS TIMESTAMP_NTZ) AS start_time"
    )
    got = S.extract_sessions(frame, total=22, remainders=remainders).groupBy("date", "hour").count().collect()
    counts = {(r["date"], r["hour"]): r["count"] for r in got}
    want = {0: 6, 1: 3, 2: 2} if remainders else {0: 5, 1: 3, 2: 1}  # of 11 a day: 5.5, 3.3, 1.87, 0.33
    assert counts == {(f"2024-01-0{d}", h): n for d in (1, 2) for h, n in want.items()}


PATTERNS = [
    r"www\.site-1\.com", r"(www|m)\.site-2\.com", r"site-3\.(com|org)", r"^shop[0-9]+\.example$", "www.", "site-4.com", r"a+b\.c",
    r"colou?r\.net", r"x{2,3}y\.org", r".*", r"\d+\.\d+\.1\.1", r"(?i)CASE\.com", r"one\.com|two\.com", r"one\.com|.*three", r"[a-z]+\.io",
]
HOSTS = [
    "www.site-1.com", "www-site-1.com", "m.site-2.com", "www.site-2.com", "site-2.com", "site-3.org", "site-3.net", "shop12.example",
    "shop.example", "www.anything", "site-4.com.au", "site-4xcom", "aaab.c", "b.c", "color.net", "colour.net", "xxy.org", "xy.org", "9.8.1.1",
    "case.com", "one.com", "two.com", "xthree", "abc.io", "www.site-n.com",
]


@pytest.mark.parametrize("k", range(len(PATTERNS)))
def test_patterns_meet_the_hosts_that_hold_their_text(spark, k):
    import re

    from footfall.operators import joins

    rows = spark.createDataFrame([(h, f"http://{h}/x") for h in HOSTS], "h string, p_ref string")
    patterns = spark.createDataFrame([(7, PATTERNS[k])], "id int, url string")
    got = {r["h"]: r["inbound"] == 7 for r in joins.inbound_of(rows, patterns, []).collect()}
    plain = not re.search(r"[.*+?^$|(){}\[\]\\]", PATTERNS[k])
    want = {h: h.startswith(PATTERNS[k]) or (not plain and bool(re.fullmatch(PATTERNS[k], h))) for h in HOSTS}
    assert got == want


def test_required_texts(spark):
    from footfall.operators import joins

    want = [["www.site-1.com"], [".site-2.com"], ["site-3."], [".example"], ["www"], ["site-4"], ["b.c"], ["r.net"], ["y.org"], [],
            ["."], [], ["one.com", "two.com"], ["one.com", "three"], [".io"]]
    rows = spark.createDataFrame(list(enumerate(PATTERNS)), "i int, p string")
    got = rows.select("i", joins._required_texts(F.col("p")).alias("t")).orderBy("i").collect()
    assert [sorted(r["t"]) for r in got[:10]] == [sorted(w) for w in want[:10]] and [r["t"] for r in got[11:]] == want[11:]
