"""Access-log lines written out from event records (input of the ETL queries)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "^A"

# User agents the lines carry, by the record's ``k % 6``.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64; rv:115.0) Gecko/20100101 Firefox/115.0",
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 6.1; Trident/4.0)",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.6 Safari/605.1.15",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/118.0.0.0 Safari/537.36 Edg/118.0.2088.46",
    "curl/8.1.2",
]


def user_agent_of(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(u) for u in USER_AGENTS]), (k % len(USER_AGENTS) + 1).cast("int"))


def _param(name: str, c: Column) -> Column:
    return F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"{name}="), F.url_encode(c)))


def good_lines(logs: DataFrame) -> DataFrame:
    """The given records plus their log line in ``value``."""
    seconds = F.concat_ws(
        ".",
        F.call_function("div", F.col("s_time"), F.lit(1000)).cast("string"),
        F.lpad((F.col("s_time") % 1000).cast("string"), 3, "0"),
    )
    params = F.concat_ws(
        "&",
        *[_param(c, F.col(c)) for c in ("en", "pl", "u_ud", "u_mid", "u_sd", "p_url", "p_ref", "ca", "ac")],
        _param("b_iev", user_agent_of(F.col("k"))),
        _param("kv_page", (F.col("k") % 10).cast("string")),
    )
    target = F.concat(F.lit("/log.gif?"), params)
    return logs.withColumn("value", F.concat_ws(MARK, "ip", seconds, F.lit("log.example.com"), target))


def mixed_lines(logs: DataFrame) -> DataFrame:
    """Like ``good_lines``, but some lines are broken in each known way."""
    i = F.col("event_id")
    v = F.col("value")
    broken = (
        F.when(i % 97 == 0, F.concat(F.col("ip"), F.lit(MARK), F.lit("no more fields")))
        .when(i % 89 == 0, F.substring_index(v, "?", 1))
        .when(i % 83 == 0, F.regexp_replace(v, "en=e_[a-z]+", "en=e_zz"))
        .when(i % 79 == 0, F.regexp_replace(v, r"\^A[0-9]+\.[0-9]+\^A", "^Aday one^A"))
        .when(i % 73 == 0, F.concat(v, F.lit("&noise&=x&bad=%zz&en=")))
        .otherwise(v)
    )
    return good_lines(logs).withColumn("value", broken)
