"""Raw access log to event records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import predicates as P
from footfall.functions import web
from footfall.functions.text import is_blank
from footfall.functions.times import nginx_ms
from footfall.functions.web import computed_once
from footfall.operators.joins import ip_region
from footfall.operators.skew import spread_nulls, top_per_group
from footfall.schemas import EVENT_LOG_COLUMNS
from footfall.sources.files import literal_relation

# The two characters '^A' between the fields of a log line, and
# the parameter that holds the user agent.
FIELD_MARK = r"\^A"
USER_AGENT = "b_iev"

BAD_FIELDS, NO_QUERY, BAD_EVENT, BAD_TIME = "field_count", "no_query", "unknown_event", "server_time"


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Log lines ``ip^Atime^Ahost^A/path?query`` as columns.

    ``reject`` names why a line is not an event record (null if it is one).
    Known parameters become columns, the others go to the map ``extra``.
    """
    # empty fields at the end do not count
    text = F.regexp_replace(F.trim(F.col(line)), rf"({FIELD_MARK})+$", "")
    fields = F.split(text, FIELD_MARK)
    staged = computed_once(lines, "_f", fields).withColumn(
        "_target", F.when(F.size("_f") == 4, F.get("_f", 3))
    )
    params = F.col("_params")
    columns = web.with_query_map(staged, "_target", "_params").select(
        *lines.columns,
        F.trim(F.get("_f", 0)).alias("ip"),
        nginx_ms(F.trim(F.get("_f", 1))).alias("s_time"),
        F.size("_f").alias("_n"),
        "_target",
        *[params[c].alias(c) for c in EVENT_LOG_COLUMNS],
        F.map_filter(params, lambda k, _: ~k.isin(EVENT_LOG_COLUMNS)).alias("extra"),
    )
    reject = (
        F.when(F.col("_n") != 4, BAD_FIELDS)
        .when(F.instr("_target", "?") == 0, NO_QUERY)
        .when(~P.known_event(F.col("en")), BAD_EVENT)
        .when(F.col("s_time") < 0, BAD_TIME)
    )
    return columns.withColumn("reject", reject).drop("_n", "_target")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject").isNull()).drop("reject")


def rejected(parsed: DataFrame, line: str = "value") -> DataFrame:
    """Side table of refused lines with the reason."""
    return parsed.where(F.col("reject").isNotNull()).select(line, "reject")


def with_user_agent(events: DataFrame, column: str = USER_AGENT) -> DataFrame:
    """Browser and system columns; the raw user agent is dropped.

    Each distinct agent is taken apart once, however many records have it, and
    its parts are joined to the records.  Records without one are spread over
    the tasks.
    """
    named = F.when(~is_blank(F.col(column)), F.col(column))
    agents = events.select(named.alias(column)).where(F.col(column).isNotNull()).distinct()
    parsed = web.with_user_agent(agents, column).withColumnRenamed(column, "_key")
    kept = events.withColumn(column, named)
    return spread_nulls(kept, column, "_key").join(parsed, "_key", "left").drop(column, "_key")


def with_location(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Country, province and city of the address; ``unknown`` outside all ranges.

    The region text is taken apart once per range, not once per record.
    """
    placed = ranges.withColumn("_r", web.region_parts(F.col("region"))).select(
        "begin_ip", "end_ip", "_r.country", "_r.province", "_r.city"
    )
    columns = ["country", "province", "city"]
    located = ip_region(events.drop(*columns), placed, columns=columns)
    return located.fillna(web.UNKNOWN, columns)


def row_key(uuid: str = "u_ud", member: str = "u_mid", event: str = "en", time: str = "s_time") -> Column:
    """``time_checksum``: a short key of a record for storage.  Different records may share it."""
    part = lambda c: F.when(is_blank(F.col(c)), "").otherwise(F.col(c))
    checksum = F.crc32(F.concat(part(uuid), part(member), F.col(event)).cast("binary"))
    return F.concat_ws("_", F.col(time).cast("string"), (checksum % 100000000).cast("string"))


RECORD = ["s_time", "u_ud", "u_mid", "en"]


def dedupe(events: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One row per record, the first in ``order``, with its row key.

    Records are the same if time, user, member and event are, blank like null.
    The checksum in the row key is too short to tell them apart.
    """
    parts = {f"_same_{c}": F.when(is_blank(F.col(c).cast("string")), "").otherwise(F.col(c).cast("string")) for c in RECORD}
    kept = top_per_group(events.withColumns(parts), list(parts), order, 1, "_rn").drop("_rn", *parts)
    return kept.withColumn("row_key", row_key())


def _counters() -> list[Column]:
    """Input, output and filtered records, and the filtered ones by reason."""
    reason = F.col("reject")
    return [
        F.count(F.lit(1)).alias("input_records"),
        F.count_if(reason.isNull()).alias("output_records"),
        F.count_if(reason.isNotNull()).alias("filtered_records"),
        *[
            F.count_if(F.coalesce(reason == r, F.lit(False))).alias(f"filtered_{r}")
            for r in (BAD_FIELDS, NO_QUERY, BAD_EVENT, BAD_TIME)
        ],
    ]


def counters(parsed: DataFrame) -> DataFrame:
    """The counters of a pass of their own."""
    return parsed.agg(*_counters())


def store_counted(parsed: DataFrame, path: str) -> DataFrame:
    """Write the accepted records; returns the counters, collected in the same pass."""
    seen = Observation()
    accepted(parsed.observe(seen, *_counters())).write.mode("overwrite").parquet(path)
    found = seen.get
    schema = T.StructType([T.StructField(name, T.LongType()) for name in found])
    return literal_relation(parsed.sparkSession, [tuple(found.values())], schema)
