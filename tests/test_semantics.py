"""Small hand-made inputs for rules the SQL could get wrong in the same way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions import numbers, predicates, text, times, web
from footfall.operators import ads, dims, etl, funnel, kpi, orders, products, relational
from footfall.operators import sessions as S

BASE = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC
PATTERNS = [(5, "five.example"), (7, "seven.example")]
OWN = ["own.example"]
REF = {5: "http://five.example/", 7: "http://seven.example/x", 0: "http://own.example/", 2: "http://else.example"}


def logs(spark, rows):
    """Event records from partial dicts."""
    full = []
    for i, r in enumerate(rows):
        base = dict(
            event_id=i, s_time=BASE + i, en="e_pv", pl="web", u_ud="u", u_mid=None, u_sd="s", browser="B",
            browser_v="1", p_url="/p", p_ref=None, country="CN", province="P", city="C", ca=None, ac=None,
        )
        base.update(r)
        full.append(base)
    schema = (
        "event_id long, s_time long, en string, pl string, u_ud string, u_mid string, u_sd string, browser string, "
        "browser_v string, p_url string, p_ref string, country string, province string, city string, ca string, ac string"
    )
    return spark.createDataFrame(full, schema)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "steps, expected",
    [
        ([5], {5: 1, 1: 1}),
        ([5, 0], {5: 0, 1: 0}),
        ([5, 7, 0], {5: 1, 7: 0, 1: 1}),
        ([5, 0, 7], {5: 0, 7: 1, 1: 1}),
        ([5, 7], {5: 1, 7: 1, 1: 1}),
        ([0, 0], {1: 0}),
        ([0, 5, 5, 0], {5: 1, 1: 1}),
    ],
)
def test_bounces(spark, steps, expected):
    frame = logs(spark, [dict(p_ref=REF[s], s_time=BASE + i * 1000) for i, s in enumerate(steps)])
    for hot_rows in (1, 1_000_000):
        rows = kpi.inbound_bounce(frame, PATTERNS, OWN, hot_rows=hot_rows).where("platform = 'all'").collect()
        assert {r["inbound"]: r["bounces"] for r in rows} == expected


def test_segments(spark):
    steps = [0, 5, 0, 0, 7, 0]
    frame = logs(spark, [dict(p_ref=REF[s], s_time=BASE + i * 1000) for i, s in enumerate(steps)])
    rows = kpi.landing_segments(frame, PATTERNS, OWN, hot_rows=2).orderBy("segment").collect()
    assert [(r["segment"], r["inbound"], r["steps"]) for r in rows] == [(0, 0, 1), (1, 5, 3), (2, 7, 2)]


def test_session_length_is_rounded_up_once(spark):
    frame = logs(spark, [
        dict(u_sd="A", s_time=BASE), dict(u_sd="A", s_time=BASE + 1500),
        dict(u_sd="B", s_time=BASE), dict(u_sd="B", s_time=BASE + 1),
    ])
    row = kpi.sessions(frame).where("platform = 'all'").first()
    assert (row["sessions"], row["sessions_length"]) == (2, 2)


def test_hourly_session_length_leaves_out_nothing_within_the_hour(spark):
    hour = 3_600_000
    frame = logs(spark, [dict(u_sd="A", s_time=BASE), dict(u_sd="A", s_time=BASE + hour - 1),
                         dict(u_sd="A", s_time=BASE + hour)])
    row = kpi.hourly_sessions_length(frame).where("platform = 'all'").first()
    assert (row["hour_00"], row["hour_01"], row["hour_02"]) == (3600, 0, 0)


def test_unusable_records_count_nowhere(spark):
    frame = logs(spark, [dict(pl=""), dict(pl="  "), dict(u_ud=""), dict(s_time=None), dict(u_ud="x")])
    rows = kpi.active_users(frame).collect()
    assert {r["platform"]: r["active_users"] for r in rows} == {"web": 1, "all": 1}


def test_platform_total_is_a_true_distinct(spark):
    frame = logs(spark, [dict(pl="a", u_ud="x"), dict(pl="b", u_ud="x"), dict(pl="b", u_ud="y")])
    rows = kpi.active_users(frame).collect()
    assert {r["platform"]: r["active_users"] for r in rows} == {"a": 1, "b": 2, "all": 2}


def test_order_total_is_additive(spark):
    events = spark.createDataFrame(
        [("o1", "e_crt", BASE, "a", "RMB", "card", 10), ("o1", "e_crt", BASE, "b", "RMB", "card", 12),
         ("o1", "e_crt", BASE + 1, "b", "RMB", "card", 11)],
        "oid string, en string, s_time long, pl string, cut string, pt string, cua long",
    )
    counts = {(r["pl"], r["cut"], r["pt"]): r["orders"] for r in orders.order_counts(events).collect()}
    assert counts[("a", "RMB", "card")] == counts[("b", "RMB", "card")] == 1
    assert counts[("all", "all", "all")] == 2
    amounts = {(r["pl"], r["cut"], r["pt"]): r["amount"] for r in orders.order_amounts(events).collect()}
    assert amounts[("b", "RMB", "card")] == 12 and amounts[("all", "all", "all")] == 22


@pytest.mark.parametrize(
    "n, bucket",
    [(4, "pv4"), (5, "pv5_10"), (9, "pv5_10"), (10, "pv10_30"), (29, "pv10_30"), (30, "pv30_60"),
     (59, "pv30_60"), (60, "pv60_plus")],
)
def test_view_depth_buckets(spark, n, bucket):
    row = orders.view_depth(logs(spark, [{}] * n), "u_ud").where("pl = 'all'").first()
    assert {c for c in orders.VIEW_DEPTH if row[c]} == {bucket}


@pytest.mark.parametrize(
    "seconds, bucket",
    [(0, None), (3, "visit_length_1s_3s"), (9, "visit_length_7s_9s"), (10, "visit_length_10s_30s"),
     (30, "visit_length_10s_30s"), (31, "visit_length_30s_60s"), (60, "visit_length_30s_60s"),
     (61, "visit_length_1m_3m"), (1800, "visit_length_10m_30m"), (1801, "visit_length_30m")],
)
def test_visit_length_buckets(spark, seconds, bucket):
    one = spark.createDataFrame([(seconds, 1)], "visit_length long, step_length long")
    row = S.bucket_ratios(one).first()
    assert {c for c in S.VISIT_SECONDS if row[f"{c}_ratio"]} == ({bucket} if bucket else set())
    assert row["step_length_1_3_ratio"] == 1.0


def actions(spark, rows):
    schema = (
        "session_id string, user_id long, page_id long, action_time timestamp_ntz, event_id long, search_keyword string, "
        "click_category_id long, click_product_id long, order_category_ids string, pay_category_ids string, city_id long"
    )
    full = []
    for i, r in enumerate(rows):
        base = dict(session_id="s", user_id=1, page_id=1, event_id=i, search_keyword=None, click_category_id=None,
                    click_product_id=None, order_category_ids=None, pay_category_ids=None, city_id=1,
                    action_time=dt.datetime(2024, 1, 15) + dt.timedelta(seconds=i))
        base.update(r)
        full.append(base)
    return spark.createDataFrame(full, schema)


def test_session_aggregate_keeps_whole_ids(spark):
    frame = actions(spark, [
        dict(click_category_id=12), dict(click_category_id=1), dict(click_category_id=12),
        dict(search_keyword="b"), dict(search_keyword="a"),
    ])
    row = S.session_aggregate(frame).first()
    assert (row["click_category_ids"], row["search_keywords"]) == ("1,12", "a,b")
    assert (row["step_length"], row["visit_length"]) == (5, 4)


def test_category_counts_with_missing_kinds(spark):
    frame = actions(spark, [dict(click_category_id=1), dict(order_category_ids="1,2"), dict(pay_category_ids="3")])
    for fn in (S.category_counts, S.category_counts_by_joins):
        got = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"]) for r in fn(frame).collect()}
        assert got == {1: (1, 1, 0), 2: (0, 1, 0), 3: (0, 0, 1)}


def test_top_categories_order(spark):
    counts = spark.createDataFrame(
        [(1, 5, 1, 1), (2, 5, 2, 0), (3, 6, 0, 0), (4, 5, 2, 1), (5, 5, 2, 1)],
        "category_id long, click_count long, order_count long, pay_count long",
    )
    assert [r["category_id"] for r in S.top_categories(counts, 4).collect()] == [3, 4, 5, 2]


def test_extraction_quota(spark):
    """Two days: 50 a day; an hour gets its share, rounded down."""
    rows = []
    for day, hour, n in ((1, 9, 30), (1, 10, 69), (1, 11, 1), (2, 9, 10)):
        rows += [(f"{day}-{hour}-{i}", dt.datetime(2024, 1, day, hour, 0, i % 60)) for i in range(n)]
    sessions = spark.createDataFrame(rows, "session_id string, start_time timestamp_ntz")
    picked = S.extract_sessions(sessions)
    got = {(r["date"][-1], r["hour"]): r["count"] for r in picked.groupBy("date", "hour").count().collect()}
    assert got == {("1", 9): 15, ("1", 10): 34, ("2", 9): 10}
    assert picked.select("session_id").distinct().count() == 59


def test_funnel(spark):
    frame = actions(spark, [dict(page_id=p) for p in (1, 2, 1, 2, 3, 2, 3)])
    for hot_rows in (1, 1_000_000):
        steps = funnel.transitions(frame, hot_rows).orderBy("event_id").collect()
        assert [(r["prev_page"], r["page_id"]) for r in steps] == [(1, 2), (2, 1), (1, 2), (2, 3), (3, 2), (2, 3)]
        rates = funnel.conversion_rates(frame, [1, 2, 3, 9, 1], hot_rows)
        got = [(r["page_split"], r["pv"], r["rate"]) for r in rates.orderBy("step").collect()]
        assert got == [("1_2", 2, 1.0), ("2_3", 2, 1.0), ("3_9", 0, 0.0), ("9_1", 0, None)]
    assert funnel.rates_text(rates.limit(3)).first()["convert_rate"].startswith("1_2=1.0|2_3=1.0")


def test_session_filter_lets_missing_parameters_pass(spark):
    row = [("s", 30, "p", "c", "male", "kw1,kw2", "1,12")]
    frame = spark.createDataFrame(
        row, "session_id string, age int, professional string, city string, sex string, "
        "search_keywords string, click_category_ids string")
    assert S.filter_sessions(frame).count() == 1
    assert S.filter_sessions(frame, start_age=31).count() == 1
    assert S.filter_sessions(frame, start_age=31, end_age=40).count() == 0
    assert S.filter_sessions(frame, category_ids=["2"]).count() == 0
    assert S.filter_sessions(frame, category_ids=["12"], keywords=["kw2"], sex="male").count() == 1


def test_area_levels(spark):
    areas = spark.createDataFrame([("China East",), ("China South",), ("West North",), ("East North",)], "area string")
    got = [r["l"] for r in areas.select(products.area_level(F.col("area")).alias("l")).collect()]
    assert got == ["A Level", "B Level", "C Level", "D Level"]


def test_log_line(spark):
    line = (
        "203.0.113.9^A1704103200.250^Alogs.example.com^A/pixel?oid=A-17&en=e_cr&pl=website&zz=a%20b"
        "&u_mid=m7&zz=c%2Bd&bad=%zz&noeq&=v&e="
    )
    lines = spark.createDataFrame(
        [(line,), ("a^Ab",), ("1.2.3.4^A1.0^Ah^A/x",), ("1.2.3.4^Ax^Ah^A/x?en=e_pv",), ("1.2.3.4^A1.0^Ah^A/x?en=no",),
         ("",)],
        "value string",
    )
    parsed = etl.parse_lines(lines)
    row = etl.accepted(parsed).first()
    assert (row["ip"], row["s_time"], row["en"], row["oid"]) == ("203.0.113.9", 1704103200250, "e_cr", "A-17")
    assert row["extra"] == {"zz": "c+d"}
    reasons = sorted(r["reject"] for r in etl.rejected(parsed).collect())
    assert reasons == ["field_count", "field_count", "no_query", "server_time", "unknown_event"]
    counters = etl.counters(parsed).first()
    assert (counters["input_records"], counters["output_records"], counters["filtered_records"]) == (6, 1, 5)


def test_row_key(spark):
    frame = logs(spark, [dict(u_ud="a", u_mid="b", en="e_l", s_time=1), dict(u_ud="", u_mid="ab", en="e_l", s_time=1),
                         dict(u_ud="ab", u_mid=None, en="e_l", s_time=2)])
    import zlib

    keys = [r["row_key"] for r in frame.withColumn("row_key", etl.row_key()).orderBy("event_id").collect()]
    crc = zlib.crc32(b"abe_l") % 100000000
    assert keys == [f"1_{crc}", f"1_{crc}", f"2_{crc}"]
    # a shared row key deletes nothing; a repeated record goes
    assert etl.dedupe(frame.unionByName(frame), [F.asc("event_id")]).count() == 3


@pytest.mark.parametrize(
    "url, expected",
    [
        ("http://a.example/x?y", "a.example"), ("a.example/x", "a.example"), (" https://a.example ", "a.example"),
        ("http://a.example:8080/", "a.example"), ("http://u:p@a.example/", "a.example"),
        ("http://a.example/中文|{x}?q= y", "a.example"), ("http://a.example:bad/", None), ("http:x", ""),
        ("https:/x", ""), (None, None),
    ],
)
def test_host(spark, url, expected):
    assert value(spark, web.host(F.lit(url).cast("string"))) == expected


def test_inbound_pattern_kinds(spark):
    from footfall.operators.joins import inbound_of

    rows = spark.createDataFrame(
        [(1, "http://a.example/"), (2, "http://a.example.org/"), (3, "http://x9.example/"), (4, "http://other/"),
         (5, "http://own.example/"), (6, None)], "i int, p_ref string")
    patterns = spark.createDataFrame([(9, r"x[0-9]\.example"), (4, "a.example"), (3, "a.exam")], "id int, url string")
    got = {r["i"]: r["inbound"] for r in inbound_of(rows, patterns, OWN).collect()}
    assert got == {1: 3, 2: 3, 3: 9, 4: 2, 5: 0, 6: 0}


@pytest.mark.parametrize(
    "region, expected",
    [
        ("广东省广州市天河区", ("中国", "广东省", "广州市")),
        ("湖南省", ("中国", "湖南省", "unknown")),
        ("上海市浦东新区", ("中国", "上海市", "浦东新区")),
        ("重庆市开县", ("中国", "重庆市", "开县")),
        ("北京市", ("中国", "北京市", "unknown")),
        ("内蒙古呼和浩特市", ("中国", "内蒙古自治区", "呼和浩特市")),
        ("广西南宁市", ("中国", "广西", "南宁市")),
        ("新疆", ("中国", "新疆", "unknown")),
        ("香港", ("中国", "香港特别行政区", "unknown")),
        ("局域网", ("中国", "上海市", "unknown")),
        ("美国", ("unknown", "unknown", "unknown")),
        ("", ("unknown", "unknown", "unknown")),
    ],
)
def test_region(spark, region, expected):
    assert tuple(value(spark, web.region_parts(F.lit(region)))) == expected


@pytest.mark.parametrize(
    "ip, expected",
    [("1.2.3.4", 16909060), ("255.255.255.255", 4294967295), ("1.2.3", None), ("1.2.3.256", None), ("a.b.c.d", None)],
)
def test_ip_number(spark, ip, expected):
    assert value(spark, web.ip_number(F.lit(ip))) == expected


def test_packed_fields(spark):
    packed = F.lit("a=1|b=|c=x")
    assert value(spark, text.get_field(packed, "a")) == "1"
    assert value(spark, text.get_field(packed, "b")) is None
    assert value(spark, text.get_field(packed, "z")) is None
    assert value(spark, text.set_field(packed, "a", F.lit("9"))) == "a=9|b=|c=x"
    assert value(spark, text.trim_comma(F.lit(",a,,"))) == "a,"
    assert value(spark, text.pad2(F.lit("7"))) == "07"


def test_numbers(spark):
    assert value(spark, numbers.ratio2(F.lit(1), F.lit(8))) == 0.13
    assert value(spark, numbers.ratio2(F.lit(1), F.lit(3))) == 0.33
    assert value(spark, numbers.ratio2(F.lit(0), F.lit(0))) is None
    assert value(spark, text.parse_or_zero(F.lit("x"))) == 0.0
    assert value(spark, times.nginx_ms(F.lit("1449410796.976"))) == 1449410796976
    assert value(spark, times.nginx_ms(F.lit("now"))) == -1


def test_member_ids(spark):
    for text_id, ok in (("abc1", True), ("a b", False), ("", False), ("x" * 32, True), ("x" * 33, False)):
        assert value(spark, predicates.valid_member_id(F.lit(text_id))) is ok


def test_week_numbers(spark):
    span = spark.createDataFrame([(dt.date(2023, 12, 30), dt.date(2024, 1, 7))], "first date, last date")
    rows = {(r["type"], r["calendar"]): r for r in dims.date_dimension(span).collect()}
    assert rows[("day", "2023-12-30")]["week"] == 52
    assert rows[("day", "2023-12-31")]["week"] == 53  # December day in week 1 of 2024
    assert rows[("day", "2024-01-01")]["week"] == 1
    assert rows[("day", "2024-01-07")]["week"] == 2
    week = rows[("week", "2023-12-31")]
    assert (week["year"], week["season"], week["month"], week["week"]) == (2023, 4, 12, 53)


def test_calendar(spark):
    span = spark.createDataFrame([(dt.date(2024, 1, 30), dt.date(2024, 3, 1))], "first date, last date")
    rows = {r["day"]: r for r in dims.calendar_days(span).collect()}
    assert min(rows) == "2024-01-31" and max(rows) == "2024-03-01" and len(rows) == 31
    assert rows["2024-02-29"]["month_last_day"] == "2024-02-29" and rows["2024-02-29"]["last_month"] == "2024-01"
    assert rows["2024-03-01"]["last_season"] == "2023-12" and rows["2024-03-01"]["last_half_year"] == "2023-12"
    assert rows["2024-02-03"]["is_weekend"] and rows["2024-02-03"]["week_monday"] == "2024-01-29"
    assert rows["2024-03-01"]["next_season"] == "2024-06" and rows["2024-03-01"]["next_half_year"] == "2024-12"
    assert rows["2024-02-03"]["season_months"] == "2024-01,2024-02,2024-03"
    months = [r["month"] for r in dims.calendar_months(span).orderBy("month").collect()]
    assert months == ["2024-02", "2024-03"]


def test_running_total_carries_missing_days(spark):
    daily = spark.createDataFrame(
        [("2024-01-01", "a", 2), ("2024-01-04", "a", 3), ("2024-01-03", "b", 1)], "date string, k string, n long")
    rows = kpi.dense_running_total(daily, ["k"], "n", "total").orderBy("k", "date").collect()
    assert [(r["k"], r["date"][-1], r["n"], r["total"]) for r in rows] == [
        ("a", "1", 2, 2), ("a", "2", 0, 2), ("a", "3", 0, 2), ("a", "4", 3, 5), ("b", "3", 1, 1), ("b", "4", 0, 1)]


def test_new_ids_continue(spark):
    known = spark.createDataFrame([(4, "x"), (9, "y")], "id long, v string")
    values = spark.createDataFrame([("x",), ("b",), ("a",), ("b",)], "v string")
    got = {r["v"]: r["id"] for r in dims.with_new_ids(known, values, ["v"]).collect()}
    assert got == {"x": 4, "y": 9, "a": 10, "b": 11}


def test_ban_point(spark):
    lines = spark.createDataFrame(
        [(i, f"{BASE + i} P C 1 {ad}") for i, ad in enumerate([1, 2, 1, 2, 1])] + [(9, f"{BASE} P C 2 1")],
        "event_id long, value string")
    clicks = ads.parse_clicks(lines)
    kept = sorted(r["event_id"] for r in ads.clicks_before_ban(clicks, 2).collect())
    assert kept == [0, 1, 2, 9]


def test_bad_click_lines_are_dropped(spark):
    lines = spark.createDataFrame([("1 P C 1 2",), ("x P C 1 2",), ("1 P C 1",), ("1 P C 1 2 3",)], "value string")
    assert ads.parse_clicks(lines).count() == 1


def test_split_check(spark):
    ids = spark.range(100).withColumnRenamed("id", "k")
    row = relational.split_check(ids.randomSplit([1.0, 2.0], 3), "k").first()
    assert (row["rows_in_parts"], row["distinct_keys"], row["keys_in_two_parts"]) == (100, 100, 0)
