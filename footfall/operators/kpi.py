"""Web KPIs by date, platform, browser, location and referrer.

One shape for all of them: keep the rows a KPI counts, reduce them to one row
per (finest dimension values, id), and only then expand to the dimension
levels.  The expansion and its shuffle see pre-aggregated rows, and an id or a
dimension value that holds a third of all rows is folded on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import predicates as P
from footfall.functions.numbers import ceil_div
from footfall.functions.text import is_blank
from footfall.functions.times import DAY_MS, HOUR_MS, ms_date, ms_hour
from footfall.functions.web import INBOUND_ALL, INBOUND_INTERNAL, inbound_id, with_external_host
from footfall.operators import dims as D
from footfall.operators.skew import HOT_ROWS, sliced_neighbour, sliced_running_sum, time_sliced
from footfall.sinks.tables import replace_partitions

LAUNCH, PAGE_VIEW = "e_l", "e_pv"
HOURS = range(24)


def records(logs: DataFrame, *required: str, event: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Usable records of one KPI with cleaned dimension columns.

    Only the named columns leave the scan.
    """
    kept = logs if event is None else logs.where(F.col("en") == event)
    kept = kept.where(P.usable_record("pl", *required))
    out: list[Column] = [ms_date(F.col("s_time")).alias("date"), D.clean_platform()]
    if "browser" in keep:
        out += D.clean_browser()
    if "location" in keep:
        out += D.clean_location()
    return kept.select(*out, *[c for c in keep if c not in ("browser", "location")])


def reported(df: DataFrame, day: str = "date") -> DataFrame:
    """The finished report: days as text.  Everything before groups by DATE."""
    return df.withColumn(day, F.col(day).cast("string"))


def _sets(by: str | None) -> tuple[list[list[str]], list[str], list[str]]:
    """Grouping sets, columns that can read 'all', and the finest columns."""
    if by == "browser":
        return D.level_sets(D.PLATFORM, D.BROWSER, always=["date"]), ["platform", "browser_version"], [
            "platform", "browser", "browser_version",
        ]
    if by == "location":
        return D.level_sets(D.PLATFORM, D.LOCATION, always=["date"]), ["platform", "province", "city"], [
            "platform", "country", "province", "city",
        ]
    return D.level_sets(D.PLATFORM, always=["date"]), ["platform"], ["platform"]


def distinct_count(
    logs: DataFrame, id_col: str, name: str, event: str | None = None, by: str | None = None
) -> DataFrame:
    """Distinct ids per date and dimension level (true distincts at each level)."""
    sets, rolled, finest = _sets(by)
    rows = records(logs, id_col, event=event, keep=[id_col] + ([by] if by else []))
    unique = rows.select("date", *finest, id_col).distinct()
    return reported(D.rolled_up(unique, sets, rolled, F.count_distinct(id_col).alias(name)))


def new_install_users(logs: DataFrame, by: str | None = None) -> DataFrame:
    return distinct_count(logs, "u_ud", "new_install_users", LAUNCH, by)


def active_users(logs: DataFrame, by: str | None = None) -> DataFrame:
    return distinct_count(logs, "u_ud", "active_users", None, by)


def active_members(logs: DataFrame, by: str | None = None) -> DataFrame:
    return distinct_count(logs, "u_mid", "active_members", PAGE_VIEW, by)


def new_member_records(logs: DataFrame, member_info: DataFrame) -> DataFrame:
    """Records of valid member ids that the history does not hold."""
    valid = logs.where(P.valid_member_id(F.col("u_mid")))
    return valid.join(member_info.select(F.col("member_id").alias("u_mid")), "u_mid", "left_anti")


def new_members(logs: DataFrame, member_info: DataFrame, by: str | None = None) -> DataFrame:
    return distinct_count(new_member_records(logs, member_info), "u_mid", "new_members", None, by)


def member_info_rows(logs: DataFrame, member_info: DataFrame, run_date: str) -> DataFrame:
    """New member ids with both dates set to the run date."""
    return (
        new_member_records(logs, member_info)
        .where(P.usable_record("pl"))
        .select(F.col("u_mid").alias("member_id"))
        .distinct()
        .select("member_id", F.lit(run_date).alias("last_visit_date"), F.lit(run_date).alias("created"))
    )


def hour_columns(per_hour: DataFrame, value: str) -> DataFrame:
    """Rows (date, platform, hour, value) as 24 columns, missing hours 0."""
    hours = [
        F.coalesce(F.max(F.when(F.col("hour") == h, F.col(value))), F.lit(0).cast("bigint")).alias(
            f"hour_{h:02d}"
        )
        for h in HOURS
    ]
    return reported(per_hour.groupBy("date", "platform").agg(*hours))


def _hour_sets() -> list[list[str]]:
    return D.level_sets(D.PLATFORM, always=["date", "hour"])


def hourly_active_users(logs: DataFrame) -> DataFrame:
    rows = records(logs, "u_ud", keep=["u_ud", "s_time"])
    unique = rows.select("date", "platform", ms_hour(F.col("s_time")).alias("hour"), "u_ud").distinct()
    counted = D.rolled_up(unique, _hour_sets(), ["platform"], F.count_distinct("u_ud").alias("n"))
    return hour_columns(counted, "n")


def _session_spans(logs: DataFrame, by: str | None, hourly: bool) -> tuple[DataFrame, list[list[str]], list[str]]:
    """First and last time of a session per dimension level."""
    sets, rolled, finest = _sets(by)
    keep = ["u_sd", "s_time"] + ([by] if by else [])
    rows = records(logs, "u_sd", keep=keep).withColumn("u_sd", F.trim("u_sd"))
    extra = []
    if hourly:
        rows = rows.withColumn("hour", ms_hour(F.col("s_time")))
        extra = ["hour"]
        sets = [s + extra for s in sets]
    finest_spans = rows.groupBy("date", *finest, *extra, "u_sd").agg(
        F.min("s_time").alias("lo"), F.max("s_time").alias("hi")
    )
    spans = D.rolled_up(
        finest_spans, [s + ["u_sd"] for s in sets], rolled, F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    return spans, sets, finest


def _length(limit_ms: int) -> Column:
    """Summed session length in seconds, rounded up once on the sum."""
    span = F.col("hi") - F.col("lo")
    total = F.coalesce(F.sum(F.when(span.between(0, limit_ms), span)), F.lit(0).cast("bigint"))
    return ceil_div(total, 1000)


def sessions(logs: DataFrame, by: str | None = None) -> DataFrame:
    """Sessions and their summed length; spans over a day are left out."""
    spans, _, finest = _session_spans(logs, by, hourly=False)
    return reported(
        spans.groupBy("date", *finest).agg(
            F.count(F.lit(1)).alias("sessions"), _length(DAY_MS).alias("sessions_length")
        )
    )


def hourly_sessions(logs: DataFrame) -> DataFrame:
    spans, _, _ = _session_spans(logs, None, hourly=True)
    counted = spans.groupBy("date", "platform", "hour").agg(F.count(F.lit(1)).alias("n"))
    return hour_columns(counted, "n")


def hourly_sessions_length(logs: DataFrame) -> DataFrame:
    spans, _, _ = _session_spans(logs, None, hourly=True)
    summed = spans.groupBy("date", "platform", "hour").agg(_length(HOUR_MS).alias("n"))
    return hour_columns(summed, "n")


def page_views(logs: DataFrame) -> DataFrame:
    """Page views by platform and browser."""
    sets, rolled, finest = _sets("browser")
    rows = records(logs, "p_url", event=PAGE_VIEW, keep=["browser"])
    base = rows.groupBy("date", *finest).agg(F.count(F.lit(1)).alias("_n"))
    return reported(D.rolled_up(base, sets, rolled, F.sum("_n").alias("pv")))


def tagged_ids(base: DataFrame, dims: Sequence[str], ids: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per (dims, kind, id) with its count and time span.

    ``ids`` maps the kinds of ids a report counts to the id and how much a row
    of ``base`` adds to its count; rows without the id are left out.  ``base``
    has one row per combination of ids (columns ``lo``, ``hi``), so the copies
    are made from far fewer rows than the log has.  Kinds are numbered in order.
    """
    copies = F.array(*[
        F.struct(F.lit(i).alias("kind"), c.alias("id"), n.cast("bigint").alias("n"))
        for i, (c, n) in enumerate(ids.values())
    ])
    tagged = base.select(*dims, "lo", "hi", F.explode(copies).alias("_t")).select(
        *dims, "lo", "hi", "_t.kind", "_t.id", "_t.n"
    )
    return (
        tagged.where(~is_blank(F.col("id")))
        .groupBy(*dims, "kind", "id")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    )


def leveled_ids(tagged: DataFrame, sets: Sequence[Sequence[str]], rolled: Sequence[str]) -> DataFrame:
    """The rows of ``tagged_ids`` merged at every dimension level."""
    return D.rolled_up(
        tagged,
        [[*s, "kind", "id"] for s in sets],
        rolled,
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum("n").alias("n"),
    )


def _by_ids(rows: DataFrame, dims: Sequence[str], ids: Sequence[str], *counts: Column) -> DataFrame:
    """One row per combination of dimension values and ids."""
    return rows.groupBy(*dims, *ids).agg(
        F.min("s_time").alias("lo"), F.max("s_time").alias("hi"), *counts
    )


def location(logs: DataFrame) -> DataFrame:
    """Visitors, sessions and one-view sessions by platform and location."""
    sets, rolled, finest = _sets("location")
    rows = records(logs, "u_ud", "u_sd", event=PAGE_VIEW, keep=["location", "u_ud", "u_sd", "s_time"])
    dims = ["date", *finest]
    base = _by_ids(rows, dims, ["u_ud", "u_sd"], F.count(F.lit(1)).alias("views"))
    views = F.col("views")
    ids = tagged_ids(base, dims, {"visitor": (F.col("u_ud"), views), "session": (F.col("u_sd"), views)})
    visitor, session = F.col("kind") == 0, F.col("kind") == 1
    return reported(
        leveled_ids(ids, sets, rolled)
        .groupBy(*dims)
        .agg(
            F.count_if(visitor).alias("visitors"),
            F.count_if(session).alias("sessions"),
            F.count_if(session & (F.col("n") == 1)).alias("bounce_sessions"),
        )
    )


def _referred(logs: DataFrame, *required: str, event=None, keep=()) -> DataFrame:
    """Records with a referrer."""
    return records(logs, "p_ref", *required, event=event, keep=["p_ref", *keep])


def inbound(logs: DataFrame, patterns: Sequence[tuple[int, str]], own_hosts: Sequence[str]) -> DataFrame:
    """Visitors and sessions by platform and inbound (1 = all inbounds)."""
    referred = _referred(logs, "u_ud", "u_sd", event=PAGE_VIEW, keep=["u_ud", "u_sd"])
    external = with_external_host(referred, "p_ref", "_host", own_hosts).where(F.col("_host").isNotNull())
    rows = external.withColumn("inbound", inbound_id(F.col("_host"), patterns)).drop("_host", "p_ref")
    base = rows.groupBy("date", "platform", F.col("inbound").cast("string").alias("inbound"), "u_ud", "u_sd").agg(
        F.lit(0).alias("lo"), F.lit(0).alias("hi")
    )
    one = F.lit(1)
    ids = tagged_ids(base, ["date", "platform", "inbound"], {"visitor": (F.col("u_ud"), one), "session": (F.col("u_sd"), one)})
    sets = D.level_sets(D.PLATFORM, [["inbound"], []], always=["date"])
    counted = leveled_ids(ids, sets, ["platform", "inbound"]).groupBy("date", "platform", "inbound").agg(
        F.count_if(F.col("kind") == 0).alias("visitors"), F.count_if(F.col("kind") == 1).alias("sessions")
    )
    number = F.when(F.col("inbound") == D.ALL, INBOUND_ALL).otherwise(F.col("inbound")).cast("bigint")
    return reported(counted.withColumn("inbound", number))


# the session id first: it tells rows apart soonest when they are sorted
SESSION = ["u_sd", "date"]


def _visits(logs: DataFrame, patterns, own_hosts, hot_rows: int) -> DataFrame:
    """Session steps with their time slice and inbound id."""
    rows = _referred(logs, "u_sd", keep=["u_sd", "s_time", "event_id"])
    sliced = time_sliced(rows, SESSION, F.col("s_time"), hot_rows=hot_rows)
    hosted = with_external_host(sliced, "p_ref", "_host", own_hosts).drop("p_ref")
    return hosted.withColumn("inbound", inbound_id(F.col("_host"), patterns)).drop("_host")


def inbound_bounce(
    logs: DataFrame,
    patterns: Sequence[tuple[int, str]],
    own_hosts: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Bounced landings by inbound.

    A landing (inbound not 0) bounces unless an internal step follows before
    the next landing or the end of the session, that is unless the very next
    step is internal.  The row of all inbounds (1) counts sessions with at
    least one bounced landing.
    """
    visits = _visits(logs, patterns, own_hosts, hot_rows)
    order = ["s_time", "event_id"]
    # the next step of the session, and the next one on the same platform: the
    # rows are exchanged once and sorted twice
    steps = sliced_neighbour(visits, SESSION, "_slice", order, {"inbound": "next_any"}, forward=True)
    steps = sliced_neighbour(steps, [*SESSION, "platform"], "_slice", order, {"inbound": "next_own"}, forward=True)
    landing = F.col("inbound") != INBOUND_INTERNAL
    bounced = lambda after: landing & F.coalesce(F.col(after) != INBOUND_INTERNAL, F.lit(True))
    each = steps.groupBy(*SESSION, "platform", "inbound").agg(
        F.count_if(bounced("next_own")).alias("own"), F.count_if(bounced("next_any")).alias("any")
    )
    # whether the session bounced at all stands on the first of its rows
    session, here = W.partitionBy(*SESSION), W.partitionBy(*SESSION, "platform")
    first = lambda w, *by: F.row_number().over(w.orderBy(*by)) == 1
    some = lambda w, n: (F.sum(n).over(w) > 0).cast("bigint")
    each = each.withColumns({
        "first_any": first(session, "platform", "inbound"), "some_any": some(session, "any"),
        "first_own": first(here, "inbound"), "some_own": some(here, "own"),
    })
    entry = lambda when, platform, inbound, n: F.when(
        when, F.struct(platform.alias("platform"), inbound.cast("bigint").alias("inbound"), n.alias("n"))
    )
    platform, every, inbound_all = F.col("platform"), F.lit(D.ALL), F.lit(INBOUND_ALL)
    entries = F.array(
        entry(landing, platform, F.col("inbound"), F.col("own")),
        entry(landing, every, F.col("inbound"), F.col("any")),
        entry(F.col("first_own"), platform, inbound_all, F.col("some_own")),
        entry(F.col("first_any"), every, inbound_all, F.col("some_any")),
    )
    rows = each.select("date", F.explode(entries).alias("e")).where("e IS NOT NULL").select("date", "e.*")
    return reported(rows.groupBy("date", "platform", "inbound").agg(F.sum("n").alias("bounces")))


def landing_segments(
    logs: DataFrame,
    patterns: Sequence[tuple[int, str]],
    own_hosts: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Segments of a session, each opened by a landing, with their sizes.

    Segment 0 holds the steps before the first landing.
    """
    landing = F.when(F.col("inbound") != INBOUND_INTERNAL, 1).otherwise(0).cast("bigint")
    steps = sliced_running_sum(
        _visits(logs, patterns, own_hosts, hot_rows).drop("platform"),
        SESSION,
        "_slice",
        ["s_time", "event_id"],
        landing,
        "segment",
    )
    return reported(
        steps.groupBy("u_sd", "date", "segment").agg(
            F.max("inbound").cast("bigint").alias("inbound"), F.count(F.lit(1)).alias("steps")
        )
    )


def dense_running_total(
    daily: DataFrame, keys: Sequence[str], value: str, name: str, day: str = "date", last: Column | None = None
) -> DataFrame:
    """Running total per key and day; days without a row carry the total on.

    ``daily`` holds one row per key and day.  Each row is repeated for the days
    up to the next one of its key (the last one up to the last day of the whole
    frame), so no day grid has to be built and joined.  A caller that can name
    the ``last`` day more cheaply than from ``daily`` passes it.
    """
    d = daily.withColumn("_d", F.col(day).cast("date"))
    if last is None:
        last = d.agg(F.max(F.when(F.col(value).isNotNull(), F.col("_d")))).scalar()
    w = W.partitionBy(*keys).orderBy("_d")
    until = w.rowsBetween(W.unboundedPreceding, 0)
    summed = d.withColumns({
        name: F.sum(value).over(until),
        "_until": F.coalesce(F.date_sub(F.lead("_d").over(w), 1), last),
    })
    dense = summed.withColumn("_day", F.explode(F.sequence("_d", "_until")))
    own = F.when(F.col("_day") == F.col("_d"), F.col(value)).otherwise(F.lit(0).cast("bigint"))
    return dense.select(F.col("_day").cast("string").alias(day), *keys, own.alias(value), name)


def add_day(today: DataFrame, root: str, day: str, keys: Sequence[str], value: str, name: str) -> T.StructType:
    """Store the totals of ``day``: those of the newest day before it plus the values of ``today``.

    ``today`` has one row per key.  A run reads today's rows and one stored day,
    however long the history is; a key without a row today carries its total
    on.  A repeated run writes its day again.  Days are run in order, and a
    day that is run anew is followed by those after it.  Returns the schema of
    the stored table.
    """
    spark = today.sparkSession
    keys = list(keys)
    own = today.select(*keys, F.col(value).cast("bigint").alias(value))
    stored = T.StructType([
        *own.schema.fields, T.StructField(name, T.LongType()), T.StructField("date", T.StringType())
    ])
    earlier = [d for d in stored_days(spark, root) if d < day]
    if earlier:
        last = spark.read.schema(stored).parquet(root).where(F.col("date") == max(earlier))
        before = last.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(name).alias("_before"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        both = own.join(before, same, "full_outer").select(
            *[F.coalesce(k, f"_{k}").alias(k) for k in keys], value, "_before"
        )
    else:
        both = own.withColumn("_before", F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    total = F.coalesce("_before", zero) + F.coalesce(value, zero)
    rows = both.select(*keys, F.coalesce(value, zero).alias(value), total.alias(name), F.lit(day).alias("date"))
    replace_partitions(rows, root, ["date"])
    return stored


def stored_days(spark: SparkSession, root: str) -> list[str]:
    """Days that have totals: names of folders, no data is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return sorted(n.removeprefix("date=") for n in names if n.startswith("date="))


def day_totals(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The totals of all days that were run."""
    return spark.read.schema(schema).parquet(root)


def _facts(logs: DataFrame, member_info: DataFrame, by: str | None, with_views: bool) -> DataFrame:
    """All KPIs of one dimension as columns of one row, from one scan of the logs."""
    sets, rolled, finest = _sets(by)
    keep = ["en", "u_ud", "u_mid", "u_sd", "s_time"] + (["p_url"] if with_views else []) + ([by] if by else [])
    rows = records(logs, keep=keep)
    dims = ["date", *finest]
    is_view = F.col("en") == PAGE_VIEW
    read = is_view & P.not_blank("p_url") if with_views else F.lit(False)
    base = _by_ids(
        rows,
        dims,
        ["u_ud", "u_mid", "u_sd"],
        F.count_if(F.col("en") == LAUNCH).alias("launches"),
        F.count_if(is_view).alias("views"),
        F.count_if(read).alias("reads"),
    )
    one = F.lit(1)
    ids = {
        "user": (F.col("u_ud"), one),
        "launch": (F.when(F.col("launches") > 0, F.col("u_ud")), one),
        "member": (F.when(F.col("views") > 0, F.col("u_mid")), one),
        "new": (F.when(P.valid_member_id(F.col("u_mid")), F.col("u_mid")), one),
        "session": (F.trim("u_sd"), one),
    }
    if with_views:
        ids["view"] = (F.when(F.col("reads") > 0, "view"), F.col("reads"))
    is_kind = {k: F.col("kind") == i for i, k in enumerate(ids)}
    # Members already known are no new ones.  The other kinds take part under a
    # key that matches nothing, which also spreads them over the join.
    key = F.when(is_kind["new"], F.col("id")).otherwise(F.concat_ws("\x01", "kind", "id"))
    known = member_info.select(F.col("member_id").alias("_key"))
    fresh = tagged_ids(base, dims, ids).withColumn("_key", key).join(known, "_key", "left_anti").drop("_key")

    span = F.col("hi") - F.col("lo")
    length = F.sum(F.when(is_kind["session"] & span.between(0, DAY_MS), span).otherwise(0))
    measures = [
        F.count_if(is_kind["user"]).alias("active_users"),
        F.count_if(is_kind["launch"]).alias("new_install_users"),
        F.count_if(is_kind["member"]).alias("active_members"),
        F.count_if(is_kind["new"]).alias("new_members"),
        F.count_if(is_kind["session"]).alias("sessions"),
        ceil_div(length, 1000).alias("sessions_length"),
    ]
    if with_views:
        measures.append(F.sum(F.when(is_kind["view"], F.col("n")).otherwise(0)).alias("pv"))
    daily = reported(leveled_ids(fresh, sets, rolled).groupBy(*dims).agg(*measures))
    # one row per day and dimension values: a few thousand days at most in a window
    to_date = W.partitionBy(*finest).orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    return daily.withColumns({
        "total_install_users": F.sum("new_install_users").over(to_date),
        "total_members": F.sum("new_members").over(to_date),
    })


def user_facts(logs: DataFrame, member_info: DataFrame) -> DataFrame:
    """All platform-level KPIs as columns of one row per (date, platform)."""
    return _facts(logs, member_info, None, with_views=False)


def browser_facts(logs: DataFrame, member_info: DataFrame) -> DataFrame:
    """All browser-level KPIs, page views included, as columns of one row."""
    return _facts(logs, member_info, "browser", with_views=True)


def expanded_levels(logs: DataFrame) -> DataFrame:
    """Row counts of every platform x browser x location level."""
    rows = records(logs, keep=["browser", "location"])
    finest = ["platform", "browser", "browser_version", "country", "province", "city"]
    base = rows.groupBy("date", *finest).agg(F.count(F.lit(1)).alias("_n"))
    sets = D.level_sets(D.PLATFORM, D.BROWSER, D.LOCATION, always=["date"])
    return reported(
        D.rolled_up(
            base, sets, ["platform", "browser_version", "province", "city"], F.sum("_n").alias("n_rows")
        )
    )
