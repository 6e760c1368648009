"""Order, event and view-depth reports."""

from itertools import product

from pyspark.sql import functions as F

from footfall.functions.times import ms_day
from footfall.operators import orders
from footfall.operators.joins import with_order_info
from footfall.plans.kpis import _dense_sql
from footfall.plans.oracle_views import with_views
from footfall.plans.registry import query
from footfall.sources import tables as src

# The order table and the records of one kind with its dimensions.
_INFO = """
, info AS (SELECT oid AS order_id, pl, cut, pt, cua AS amount FROM oe WHERE en='e_crt'
  QUALIFY row_number() OVER (PARTITION BY oid ORDER BY s_time DESC) = 1),
paid AS (SELECT e.en, e.date, e.oid, coalesce(i.pl,'unknown') AS pl, coalesce(i.cut,'unknown') AS cut,
  coalesce(i.pt,'unknown') AS pt, coalesce(i.amount,0) AS cua
  FROM oe e LEFT JOIN info i ON e.oid = i.order_id)"""


def _cube_select(value: str) -> str:
    selects = []
    for kept in product([True, False], repeat=3):
        dims = [c if keep else f"'all' AS {c}" for c, keep in zip(("pl", "cut", "pt"), kept)]
        selects.append(f"SELECT date, {', '.join(dims)}, CAST(sum({value}) AS BIGINT) AS {value} FROM base GROUP BY ALL")
    return " UNION ALL ".join(selects)


def _base(en: str, own: bool, amount: bool) -> str:
    source = "oe" if own else "paid"
    if amount:
        return f"""base AS (SELECT date, pl, cut, pt, sum(a) AS amount FROM (
  SELECT date, pl, cut, pt, oid, max(cua) AS a FROM {source} WHERE en='{en}' GROUP BY ALL) GROUP BY ALL)"""
    return f"base AS (SELECT date, pl, cut, pt, count(DISTINCT oid) AS orders FROM {source} WHERE en='{en}' GROUP BY ALL)"


def count_cube(en: str, own: bool = False) -> str:
    return with_views("oe", f"{_INFO}, {_base(en, own, False)} {_cube_select('orders')}")


def amount_cube(en: str, own: bool = False) -> str:
    return with_views("oe", f"{_INFO}, {_base(en, own, True)} {_cube_select('amount')}")


def _to_date(en: str, name: str) -> str:
    return with_views(
        "oe", f"{_INFO}, {_base(en, False, True)}" + _dense_sql(_cube_select("amount"), "pl, cut, pt", "amount", name)
    )


def _events_and_info(spark, sf):
    events = src.order_events(spark, sf)
    return events, orders.order_info_rows(events)


@query(
    "order_info_extract",
    with_views("oe", """
SELECT oid AS order_id, pl AS platform, s_time, cut AS currency_type, pt AS payment_type, cua AS amount
FROM oe WHERE en='e_crt' QUALIFY row_number() OVER (PARTITION BY oid ORDER BY s_time DESC) = 1"""),
)
def order_info_extract(spark, sf):
    return orders.order_info_rows(src.order_events(spark, sf))


@query(
    "order_info_lookup",
    with_views("oe", _INFO + "SELECT oid, date, pl, cut, pt, cua AS amount FROM paid WHERE en='e_cs'"),
)
def order_info_lookup(spark, sf):
    events, info = _events_and_info(spark, sf)
    paid = events.where("en = 'e_cs'").select("oid", ms_day(F.col("s_time")).alias("date"))
    return with_order_info(paid, info)


@query("order_count_cube", count_cube("e_crt", own=True))
def order_count_cube(spark, sf):
    return orders.order_counts(src.order_events(spark, sf))


@query("order_amount_cube", amount_cube("e_crt", own=True))
def order_amount_cube(spark, sf):
    return orders.order_amounts(src.order_events(spark, sf))


@query("paid_order_count_cube", count_cube("e_cs"))
def paid_order_count_cube(spark, sf):
    events, info = _events_and_info(spark, sf)
    return orders.order_counts(events, orders.PAID, info)


@query("paid_order_amount_cube", amount_cube("e_cs"))
def paid_order_amount_cube(spark, sf):
    events, info = _events_and_info(spark, sf)
    return orders.order_amounts(events, orders.PAID, info)


@query("refund_order_count_cube", count_cube("e_cr"))
def refund_order_count_cube(spark, sf):
    events, info = _events_and_info(spark, sf)
    return orders.order_counts(events, orders.REFUNDED, info)


@query("refund_order_amount_cube", amount_cube("e_cr"))
def refund_order_amount_cube(spark, sf):
    events, info = _events_and_info(spark, sf)
    return orders.order_amounts(events, orders.REFUNDED, info)


@query("order_total_revenue", _to_date("e_cs", "total_revenue"))
def order_total_revenue(spark, sf):
    events, info = _events_and_info(spark, sf)
    return orders.amount_to_date(events, orders.PAID, info, "total_revenue")


@query("order_total_refund", _to_date("e_cr", "total_refund"))
def order_total_refund(spark, sf):
    events, info = _events_and_info(spark, sf)
    return orders.amount_to_date(events, orders.REFUNDED, info, "total_refund")


@query(
    "event_rollup",
    with_views("el", """
, t AS (SELECT pl, dt AS date, ca, ac FROM el WHERE en='e_e')
SELECT pl, date, ca, ac, count(*) AS times FROM t GROUP BY ALL
UNION ALL SELECT 'all', date, ca, ac, count(*) FROM t GROUP BY ALL
UNION ALL SELECT pl, date, ca, 'all', count(*) FROM t GROUP BY ALL
UNION ALL SELECT 'all', date, ca, 'all', count(*) FROM t GROUP BY ALL
UNION ALL SELECT pl, date, 'all', 'all', count(*) FROM t GROUP BY ALL
UNION ALL SELECT 'all', date, 'all', 'all', count(*) FROM t GROUP BY ALL"""),
)
def event_rollup(spark, sf):
    return orders.event_counts(src.event_logs(spark, sf))


def _depth_sql(id_col: str) -> str:
    buckets = [
        ("pv1", "n = 1"), ("pv2", "n = 2"), ("pv3", "n = 3"), ("pv4", "n = 4"),
        ("pv5_10", "n >= 5 AND n < 10"), ("pv10_30", "n >= 10 AND n < 30"),
        ("pv30_60", "n >= 30 AND n < 60"), ("pv60_plus", "n >= 60"),
    ]
    counts = ", ".join(f"count(*) FILTER ({cond}) AS {name}" for name, cond in buckets)
    sums = ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name, _ in buckets)
    return with_views("el", f"""
, per AS (SELECT pl, dt AS date, {id_col}, count(p_url) AS n FROM el WHERE en='e_pv' GROUP BY ALL),
b AS (SELECT pl, date, {counts} FROM per GROUP BY ALL)
SELECT * FROM b UNION ALL SELECT 'all' AS pl, date, {sums} FROM b GROUP BY ALL""")


@query("view_depth_user", _depth_sql("u_ud"))
def view_depth_user(spark, sf):
    return orders.view_depth(src.event_logs(spark, sf), "u_ud")


@query("view_depth_session", _depth_sql("u_sd"))
def view_depth_session(spark, sf):
    return orders.view_depth(src.event_logs(spark, sf), "u_sd")
