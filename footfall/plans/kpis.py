"""Web KPIs."""

import datetime

from pyspark.sql import functions as F

from footfall.operators import dims as D
from footfall.operators import kpi
from footfall.operators.joins import with_previous_day
from footfall.plans import params
from footfall.plans.oracle_views import with_views
from footfall.plans.registry import query
from footfall.session import workspace
from footfall.sinks import buckets
from footfall.sinks import tables as sink
from footfall.sources import tables as src

HISTORY_SQL = """SELECT concat('m', CAST(c_custkey AS VARCHAR)) AS member_id, '2023-12-31' AS last_visit_date,
  '2023-12-01' AS created FROM customer WHERE c_nationkey < 10"""

_INBOUND = """CASE WHEN p_ref LIKE '%www.search-a.example%' THEN 3 WHEN p_ref LIKE '%m.search-b.example%' THEN 4
  WHEN p_ref LIKE '%shop.example.com%' THEN 0 ELSE 2 END"""


def history(spark, sf):
    """Members known before the logs begin."""
    return src.table(spark, sf, "customer").where("c_nationkey < 10").select(
        F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("member_id"),
        F.lit("2023-12-31").alias("last_visit_date"),
        F.lit("2023-12-01").alias("created"),
    )


def kpi_ctes() -> str:
    """Usable records at every platform, browser and location level."""
    return f"""
, rec AS (SELECT event_id, dt AS date, pl AS platform0, en, u_ud, u_mid, u_sd, s_time, (s_time//3600000)%24 AS hour,
  p_url, p_ref, {_INBOUND} AS inbound,
  CASE WHEN browser='' THEN 'unknown' ELSE browser END AS browser0,
  CASE WHEN browser='' THEN 'unknown' ELSE browser_v END AS version0,
  CASE WHEN country='unknown' THEN 'unknown' ELSE country END AS country0,
  CASE WHEN country='unknown' THEN 'unknown' ELSE province END AS province0,
  CASE WHEN country='unknown' THEN 'unknown' ELSE city END AS city0
  FROM el WHERE pl <> ''),
both_pl AS (SELECT *, platform0 AS platform FROM rec UNION ALL SELECT *, 'all' AS platform FROM rec),
both_br AS (SELECT *, browser0 AS browser, version0 AS browser_version FROM both_pl
  UNION ALL SELECT *, browser0, 'all' FROM both_pl),
both_loc AS (SELECT *, country0 AS country, province0 AS province, city0 AS city FROM both_pl
  UNION ALL SELECT *, country0, province0, 'all' FROM both_pl
  UNION ALL SELECT *, country0, 'all', 'all' FROM both_pl)"""


def _distinct_sql(id_col, name, where, by=None, extra=""):
    dims = "date, platform" + (", browser, browser_version" if by else "")
    return with_views("el", kpi_ctes() + extra + f"""
SELECT {dims}, count(DISTINCT {id_col}) AS {name} FROM {'both_br' if by else 'both_pl'}
WHERE {id_col} IS NOT NULL AND {where} GROUP BY ALL""")


_NOT_SEEN = "u_mid NOT IN (SELECT member_id FROM hist)"
_HIST = f", hist AS ({HISTORY_SQL})"


@query("kpi_new_install_users", _distinct_sql("u_ud", "new_install_users", "en='e_l'"))
def kpi_new_install_users(spark, sf):
    return kpi.new_install_users(src.event_logs(spark, sf))


@query("kpi_browser_new_install_users", _distinct_sql("u_ud", "new_install_users", "en='e_l'", "browser"))
def kpi_browser_new_install_users(spark, sf):
    return kpi.new_install_users(src.event_logs(spark, sf), "browser")


@query("kpi_active_users", _distinct_sql("u_ud", "active_users", "TRUE"))
def kpi_active_users(spark, sf):
    return kpi.active_users(src.event_logs(spark, sf))


@query("kpi_browser_active_users", _distinct_sql("u_ud", "active_users", "TRUE", "browser"))
def kpi_browser_active_users(spark, sf):
    return kpi.active_users(src.event_logs(spark, sf), "browser")


@query("kpi_active_members", _distinct_sql("u_mid", "active_members", "en='e_pv'"))
def kpi_active_members(spark, sf):
    return kpi.active_members(src.event_logs(spark, sf))


@query("kpi_browser_active_members", _distinct_sql("u_mid", "active_members", "en='e_pv'", "browser"))
def kpi_browser_active_members(spark, sf):
    return kpi.active_members(src.event_logs(spark, sf), "browser")


@query("kpi_new_members", _distinct_sql("u_mid", "new_members", _NOT_SEEN, extra=_HIST))
def kpi_new_members(spark, sf):
    return kpi.new_members(src.event_logs(spark, sf), history(spark, sf))


@query("kpi_browser_new_members", _distinct_sql("u_mid", "new_members", _NOT_SEEN, "browser", _HIST))
def kpi_browser_new_members(spark, sf):
    return kpi.new_members(src.event_logs(spark, sf), history(spark, sf), "browser")


@query(
    "member_info_upsert",
    with_views("el", f"""
, hist AS ({HISTORY_SQL}),
fresh AS (SELECT DISTINCT u_mid AS member_id FROM el WHERE u_mid IS NOT NULL AND pl <> ''
  AND u_mid NOT IN (SELECT member_id FROM hist))
SELECT member_id, last_visit_date, created FROM hist
UNION ALL SELECT member_id, '{params.RUN_DATE}', '{params.RUN_DATE}' FROM fresh"""),
)
def member_info_upsert(spark, sf):
    known = history(spark, sf)
    fresh = kpi.member_info_rows(src.event_logs(spark, sf), known, params.RUN_DATE)
    root, keys = workspace(spark, "member-info"), ["member_id"]
    for rows in (known, fresh):
        buckets.merge(rows, root, keys, lambda stored, r: sink.upsert_set(stored, r, keys), known.schema)
    return buckets.content(spark, root, known.schema)


_HOURS = [f"hour_{h:02d}" for h in range(24)]


@query(
    "kpi_hourly_active_users",
    with_views("el", kpi_ctes() + "SELECT date, platform, " + ", ".join(
        f"count(DISTINCT u_ud) FILTER (hour = {h}) AS {name}" for h, name in enumerate(_HOURS)
    ) + " FROM both_pl GROUP BY ALL"),
)
def kpi_hourly_active_users(spark, sf):
    return kpi.hourly_active_users(src.event_logs(spark, sf))


def _sessions_sql(by=None):
    dims = "date, platform" + (", browser, browser_version" if by else "")
    return with_views("el", kpi_ctes() + f"""
, sp AS (SELECT {dims}, u_sd, max(s_time)-min(s_time) AS span FROM {'both_br' if by else 'both_pl'} GROUP BY ALL)
SELECT {dims}, count(*) AS sessions,
  CAST((sum(CASE WHEN span BETWEEN 0 AND 86400000 THEN span ELSE 0 END) + 999)//1000 AS BIGINT) AS sessions_length
FROM sp GROUP BY ALL""")


@query("kpi_sessions", _sessions_sql())
def kpi_sessions(spark, sf):
    return kpi.sessions(src.event_logs(spark, sf))


@query("kpi_browser_sessions", _sessions_sql("browser"))
def kpi_browser_sessions(spark, sf):
    return kpi.sessions(src.event_logs(spark, sf), "browser")


@query(
    "kpi_hourly_sessions",
    with_views("el", kpi_ctes() + "SELECT date, platform, " + ", ".join(
        f"count(DISTINCT u_sd) FILTER (hour = {h}) AS {name}" for h, name in enumerate(_HOURS)
    ) + " FROM both_pl GROUP BY ALL"),
)
def kpi_hourly_sessions(spark, sf):
    return kpi.hourly_sessions(src.event_logs(spark, sf))


@query(
    "kpi_hourly_sessions_length",
    with_views("el", kpi_ctes() + """
, sp AS (SELECT date, platform, hour, u_sd, max(s_time)-min(s_time) AS span FROM both_pl GROUP BY ALL)
SELECT date, platform, """ + ", ".join(
        f"CAST((coalesce(sum(span) FILTER (hour = {h} AND span BETWEEN 0 AND 3600000), 0) + 999)//1000 AS BIGINT) AS {name}"
        for h, name in enumerate(_HOURS)
    ) + " FROM sp GROUP BY ALL"),
)
def kpi_hourly_sessions_length(spark, sf):
    return kpi.hourly_sessions_length(src.event_logs(spark, sf))


@query(
    "kpi_pageviews",
    with_views("el", kpi_ctes() + """
SELECT date, platform, browser, browser_version, count(*) AS pv FROM both_br
WHERE en='e_pv' AND p_url <> '' GROUP BY ALL"""),
)
def kpi_pageviews(spark, sf):
    return kpi.page_views(src.event_logs(spark, sf))


@query(
    "kpi_location",
    with_views("el", kpi_ctes() + """
, loc AS (SELECT * FROM both_loc WHERE en='e_pv'),
uv AS (SELECT date, platform, country, province, city, count(DISTINCT u_ud) AS visitors FROM loc GROUP BY ALL),
ps AS (SELECT date, platform, country, province, city, u_sd, count(*) AS n FROM loc GROUP BY ALL),
vs AS (SELECT date, platform, country, province, city, count(*) AS sessions,
  count(*) FILTER (n = 1) AS bounce_sessions FROM ps GROUP BY ALL)
SELECT * FROM uv JOIN vs USING (date, platform, country, province, city)"""),
)
def kpi_location(spark, sf):
    return kpi.location(src.event_logs(spark, sf))


@query(
    "kpi_inbound",
    with_views("el", kpi_ctes() + """
, inb AS (SELECT * FROM both_pl WHERE en='e_pv' AND p_ref IS NOT NULL AND inbound > 0)
SELECT date, platform, CAST(inbound AS BIGINT) AS inbound, count(DISTINCT u_ud) AS visitors,
  count(DISTINCT u_sd) AS sessions FROM inb GROUP BY ALL
UNION ALL SELECT date, platform, 1, count(DISTINCT u_ud), count(DISTINCT u_sd) FROM inb GROUP BY ALL"""),
)
def kpi_inbound(spark, sf):
    return kpi.inbound(src.event_logs(spark, sf), params.INBOUND_PATTERNS, params.OWN_HOSTS)


@query(
    "kpi_inbound_bounce",
    with_views("el", kpi_ctes() + """
, steps AS (SELECT date, platform, u_sd, inbound, inbound <> 0 AND coalesce(lead(inbound) OVER (
    PARTITION BY date, platform, u_sd ORDER BY s_time, event_id) <> 0, TRUE) AS bounced
  FROM both_pl WHERE p_ref IS NOT NULL)
SELECT date, platform, CAST(inbound AS BIGINT) AS inbound, count(*) FILTER (bounced) AS bounces
FROM steps WHERE inbound <> 0 GROUP BY ALL
UNION ALL
SELECT date, platform, 1, count(*) FILTER (b) FROM (
  SELECT date, platform, u_sd, bool_or(bounced) AS b FROM steps GROUP BY ALL) GROUP BY ALL"""),
)
def kpi_inbound_bounce(spark, sf):
    return kpi.inbound_bounce(src.event_logs(spark, sf), params.INBOUND_PATTERNS, params.OWN_HOSTS)


@query(
    "session_landing_segments",
    with_views("el", kpi_ctes() + """
, seg AS (SELECT date, u_sd, inbound, CAST(sum(CASE WHEN inbound <> 0 THEN 1 ELSE 0 END) OVER (
    PARTITION BY date, u_sd ORDER BY s_time, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
  FROM rec WHERE p_ref IS NOT NULL)
SELECT date, u_sd, segment, CAST(max(inbound) AS BIGINT) AS inbound, count(*) AS steps FROM seg GROUP BY ALL"""),
)
def session_landing_segments(spark, sf):
    return kpi.landing_segments(src.event_logs(spark, sf), params.INBOUND_PATTERNS, params.OWN_HOSTS)


@query(
    "dim_expand_all",
    with_views("el", kpi_ctes() + """
, x AS (SELECT *, country0 AS country, province0 AS province, city0 AS city FROM both_br
  UNION ALL SELECT *, country0, province0, 'all' FROM both_br
  UNION ALL SELECT *, country0, 'all', 'all' FROM both_br)
SELECT date, platform, browser, browser_version, country, province, city, count(*) AS n_rows FROM x GROUP BY ALL"""),
)
def dim_expand_all(spark, sf):
    return kpi.expanded_levels(src.event_logs(spark, sf))


def _dense_sql(daily: str, keys: str, value: str, name: str) -> str:
    """Running totals over a dense day grid, for a CTE ``daily(date, keys, value)``."""
    on = " AND ".join(f"g.{k} = d.{k}" for k in keys.split(", "))
    out = ", ".join(f"g.{k}" for k in keys.split(", "))
    return f"""
, daily AS ({daily}),
grid AS (SELECT {keys}, CAST(unnest(generate_series(CAST(min(date) AS DATE),
  (SELECT max(CAST(date AS DATE)) FROM daily), INTERVAL 1 DAY)) AS DATE) AS day FROM daily GROUP BY {keys})
SELECT CAST(g.day AS VARCHAR) AS date, {out}, CAST(coalesce(d.{value}, 0) AS BIGINT) AS {value},
  CAST(sum(coalesce(d.{value}, 0)) OVER (PARTITION BY {out} ORDER BY g.day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {name}
FROM grid g LEFT JOIN daily d ON CAST(d.date AS DATE) = g.day AND {on}"""


@query(
    "kpi_total_install_users",
    with_views("el", kpi_ctes() + _dense_sql(
        "SELECT date, platform, count(DISTINCT u_ud) AS new_install_users FROM both_pl WHERE en='e_l' GROUP BY ALL",
        "platform", "new_install_users", "total_install_users")),
)
def kpi_total_install_users(spark, sf):
    daily = kpi.new_install_users(src.event_logs(spark, sf))
    return kpi.dense_running_total(daily, ["platform"], "new_install_users", "total_install_users")


@query(
    "kpi_total_members",
    with_views("el", kpi_ctes() + _HIST + _dense_sql(
        f"""SELECT date, platform, browser, browser_version, count(DISTINCT u_mid) AS new_members FROM both_br
            WHERE u_mid IS NOT NULL AND {_NOT_SEEN} GROUP BY ALL""",
        "platform, browser, browser_version", "new_members", "total_members")),
)
def kpi_total_members(spark, sf):
    daily = kpi.new_members(src.event_logs(spark, sf), history(spark, sf), "browser")
    return kpi.dense_running_total(
        daily, ["platform", "browser", "browser_version"], "new_members", "total_members"
    )


@query(
    "kpi_browser_total_install_users",
    with_views("el", kpi_ctes() + _dense_sql(
        """SELECT date, platform, browser, browser_version, count(DISTINCT u_ud) AS new_install_users FROM both_br
            WHERE en='e_l' GROUP BY ALL""",
        "platform, browser, browser_version", "new_install_users", "total_install_users")),
)
def kpi_browser_total_install_users(spark, sf):
    daily = kpi.new_install_users(src.event_logs(spark, sf), "browser")
    return kpi.dense_running_total(
        daily, ["platform", "browser", "browser_version"], "new_install_users", "total_install_users"
    )


@query(
    "kpi_platform_total_members",
    with_views("el", kpi_ctes() + _HIST + _dense_sql(
        f"""SELECT date, platform, count(DISTINCT u_mid) AS new_members FROM both_pl
            WHERE u_mid IS NOT NULL AND {_NOT_SEEN} GROUP BY ALL""",
        "platform", "new_members", "total_members")),
)
def kpi_platform_total_members(spark, sf):
    daily = kpi.new_members(src.event_logs(spark, sf), history(spark, sf))
    return kpi.dense_running_total(daily, ["platform"], "new_members", "total_members")


def _by_day(spark, sf, name, daily, keys, value, total):
    """The totals of the scan days, one run after the other over logs laid out by day; the last run is repeated."""
    logs = src.event_logs(spark, sf, params.SCAN_DAYS)
    stored = sink.overwrite(logs, workspace(spark, "event-logs"), ["dt"])
    root = workspace(spark, name)
    first, last = (datetime.date.fromisoformat(d) for d in params.SCAN_DAYS)
    days = [str(first + datetime.timedelta(i)) for i in range((last - first).days + 1)]
    for day in [*days, days[-1]]:
        today = daily(spark.read.schema(logs.schema).parquet(stored).where(F.col("dt") == day))
        schema = kpi.add_day(today.drop("date"), root, day, keys, value, total)
    return kpi.day_totals(spark, root, schema).select("date", *keys, value, total)


_DAYS = f"date BETWEEN '{params.SCAN_DAYS[0]}' AND '{params.SCAN_DAYS[1]}'"


@query(
    "kpi_total_install_users_by_day",
    with_views("el", kpi_ctes() + _dense_sql(
        f"""SELECT date, platform, count(DISTINCT u_ud) AS new_install_users FROM both_pl
            WHERE en='e_l' AND {_DAYS} GROUP BY ALL""",
        "platform", "new_install_users", "total_install_users")),
)
def kpi_total_install_users_by_day(spark, sf):
    return _by_day(
        spark, sf, "install-totals", kpi.new_install_users, ["platform"], "new_install_users", "total_install_users"
    )


@query(
    "kpi_browser_total_members_by_day",
    with_views("el", kpi_ctes() + _HIST + _dense_sql(
        f"""SELECT date, platform, browser, browser_version, count(DISTINCT u_mid) AS new_members FROM both_br
            WHERE u_mid IS NOT NULL AND {_NOT_SEEN} AND {_DAYS} GROUP BY ALL""",
        "platform, browser, browser_version", "new_members", "total_members")),
)
def kpi_browser_total_members_by_day(spark, sf):
    daily = lambda logs: kpi.new_members(logs, history(spark, sf), "browser")
    keys = ["platform", "browser", "browser_version"]
    return _by_day(spark, sf, "member-totals", daily, keys, "new_members", "total_members")


@query(
    "running_total",
    with_views("el", kpi_ctes() + _dense_sql(
        "SELECT date, platform, count(*) AS pv FROM both_pl WHERE en='e_pv' GROUP BY ALL",
        "platform", "pv", "pv_to_date")),
)
def running_total(spark, sf):
    views = kpi.page_views(src.event_logs(spark, sf))
    daily = views.where(F.col("browser_version") == "all").groupBy("date", "platform").agg(F.sum("pv").alias("pv"))
    return kpi.dense_running_total(daily, ["platform"], "pv", "pv_to_date")


@query(
    "prev_period_join",
    with_views("el", kpi_ctes() + """
, daily AS (SELECT date, platform, count(DISTINCT u_ud) AS active_users FROM both_pl GROUP BY ALL)
SELECT t.date, t.platform, t.active_users, coalesce(p.active_users, 0) AS prev_active_users
FROM daily t LEFT JOIN daily p ON p.platform = t.platform
  AND CAST(p.date AS DATE) = CAST(t.date AS DATE) - INTERVAL 1 DAY"""),
)
def prev_period_join(spark, sf):
    return with_previous_day(kpi.active_users(src.event_logs(spark, sf)), ["platform"], "active_users")


@query(
    "kpi_fact_ids",
    with_views("el", kpi_ctes() + """
, f AS (SELECT date, platform, browser, browser_version, count(DISTINCT u_ud) AS active_users FROM both_br GROUP BY ALL),
d AS (SELECT date, row_number() OVER (ORDER BY date) AS date_id FROM (SELECT DISTINCT date FROM f)),
p AS (SELECT platform, row_number() OVER (ORDER BY platform) AS platform_id FROM (SELECT DISTINCT platform FROM f)),
b AS (SELECT browser, browser_version, row_number() OVER (ORDER BY browser, browser_version) AS browser_id
  FROM (SELECT DISTINCT browser, browser_version FROM f))
SELECT date_id, platform_id, browser_id, active_users FROM f JOIN d USING (date) JOIN p USING (platform)
  JOIN b USING (browser, browser_version)"""),
)
def kpi_fact_ids(spark, sf):
    """Facts by the ids of stored dimensions, in two runs: the second finds all of its ids."""
    root = workspace(spark, "facts")
    facts = kpi.distinct_count(src.event_logs(spark, sf), "u_ud", "active_users", by="browser")
    for _ in range(2):
        D.store_facts(facts, root, {"date_id": ["date"], "platform_id": ["platform"], "browser_id": ["browser", "browser_version"]}, "date_id")
    return D.stored_facts(spark, root).select("date_id", "platform_id", "browser_id", "active_users")


@query(
    "browser_fact_export",
    with_views("el", kpi_ctes() + f"""{_HIST},
dims AS (SELECT DISTINCT date, platform, browser, browser_version FROM both_br),
m AS (SELECT date, platform, browser, browser_version, count(DISTINCT u_ud) AS active_users,
  count(DISTINCT u_ud) FILTER (en='e_l') AS new_install_users,
  count(DISTINCT u_mid) FILTER (en='e_pv') AS active_members,
  count(DISTINCT u_mid) FILTER ({_NOT_SEEN}) AS new_members,
  count(*) FILTER (en='e_pv') AS pv FROM both_br GROUP BY ALL),
sp AS (SELECT date, platform, browser, browser_version, u_sd, max(s_time)-min(s_time) AS span FROM both_br GROUP BY ALL),
se AS (SELECT date, platform, browser, browser_version, count(*) AS sessions,
  CAST((sum(CASE WHEN span BETWEEN 0 AND 86400000 THEN span ELSE 0 END) + 999)//1000 AS BIGINT) AS sessions_length
  FROM sp GROUP BY ALL)
SELECT *, CAST(sum(new_install_users) OVER w AS BIGINT) AS total_install_users,
  CAST(sum(new_members) OVER w AS BIGINT) AS total_members
FROM m JOIN se USING (date, platform, browser, browser_version)
WINDOW w AS (PARTITION BY platform, browser, browser_version ORDER BY date)"""),
)
def browser_fact_export(spark, sf):
    return kpi.browser_facts(src.event_logs(spark, sf), history(spark, sf))
