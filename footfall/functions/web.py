"""URLs, query strings, referrers, user agents, addresses and regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.text import is_blank

UNKNOWN = "unknown"

def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for a costly value.

    The optimizer copies a projected expression into every filter and
    expression above it.  It does not copy through a generator, and the
    explode of a one-element array is free of extra rows.
    """
    return df.withColumn(name, F.explode(F.array(value)))


# Inbound ids that are not in the dimension table.
INBOUND_INTERNAL = 0
INBOUND_ALL = 1
INBOUND_OTHER = 2


# After the scheme: user part, host (group 1), port and the rest; or, without
# the two slashes, no host at all.
_HOST = r"^https?:(?://(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]*)(?::[0-9]*)?(?:[/?#]|$)|(?!//))"


def host(url: Column) -> Column:
    """Host of a URL; ``http://`` is assumed when there is no scheme.

    Null only for a broken authority.  Characters that do not belong into a
    path or query are common in referrers and do no harm here, unlike in a
    strict URI parser.
    """
    u = F.trim(url)
    full = F.when(u.startswith("http:") | u.startswith("https:"), u).otherwise(
        F.concat(F.lit("http://"), u)
    )
    return F.get(F.regexp_extract_all(full, F.lit(_HOST), F.lit(1)), 0)


def with_external_host(df: DataFrame, url: str, name: str, own_hosts: Sequence[str]) -> DataFrame:
    """Adds the host of a referrer, null if it is unparsable or one of our own.

    The URL is parsed once per row, however often the host is used afterwards.
    """
    h = F.col(name)
    return computed_once(df, name, host(F.col(url))).withColumn(
        name, F.when(~h.isin(list(own_hosts)), h)
    )


def inbound_id(host: Column, patterns: Sequence[tuple[int, str]]) -> Column:
    """Inbound id of an external host for a bounded list of job patterns.

    Patterns are literals of the plan: compiled once per task, no join and no
    shuffle.  The smallest matching id wins; a null host is internal.
    """
    hits = [
        F.when((host == p) | host.startswith(p) | host.rlike(f"^(?:{p})$"), F.lit(i))
        for i, p in sorted(patterns)
    ]
    return F.when(host.isNull(), F.lit(INBOUND_INTERNAL)).otherwise(
        F.coalesce(*hits, F.lit(INBOUND_OTHER))
    )


def query_pairs(target: Column) -> Column:
    """Parameters after the first ``?`` as an array of (key, value).

    Values are URL-decoded; pairs without ``=``, with a broken escape or with a
    blank key or value are left out.
    """
    body = F.when(F.instr(target, "?") > 0, F.substr(target, F.instr(target, "?") + 1))
    pairs = F.transform(
        F.filter(F.split(body, "&"), lambda p: F.instr(p, "=") > 0),
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"),
            F.try_url_decode(F.substr(p, F.instr(p, "=") + 1)).alias("value"),
        ),
    )
    return F.filter(pairs, lambda p: ~is_blank(p["key"]) & ~is_blank(p["value"]))


def with_query_map(df: DataFrame, target: str, name: str) -> DataFrame:
    """Adds the parameters of a request target as a map.  Each line is taken apart once.

    The last value of a repeated parameter wins (``mapKeyDedupPolicy`` in
    ``session.SETTINGS``).
    """
    return computed_once(df, name, F.map_from_entries(query_pairs(F.col(target))))


def ip_number(ip: Column) -> Column:
    """Dotted IPv4 text as a number, null when it is not one."""
    parts = F.split(F.trim(ip), "\\.")
    octet = [F.get(parts, i).try_cast("bigint") for i in range(4)]
    value = octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]
    in_range = octet[0].between(0, 255)
    for o in octet[1:]:
        in_range = in_range & o.between(0, 255)
    return F.when((F.size(parts) == 4) & in_range, value)


# Browser and system rules, first match wins: (name, pattern whose first group
# is the version).
BROWSER_RULES = [
    ("Bot", r"(?i)(?:bot|spider|crawler)[/ -]?([0-9]+(?:\.[0-9]+)?)?"),
    ("Samsung Internet", r"SamsungBrowser/([0-9]+(?:\.[0-9]+)?)"),
    ("Opera Mini", r"Opera Mini/([0-9]+(?:\.[0-9]+)?)"),
    ("Chrome Mobile", r"CriOS/([0-9]+(?:\.[0-9]+)?)"),
    ("Firefox Mobile", r"FxiOS/([0-9]+(?:\.[0-9]+)?)"),
    ("Edge", r"Edg(?:A|iOS)/([0-9]+(?:\.[0-9]+)?)"),
    ("Edge", r"Edge?/([0-9]+(?:\.[0-9]+)?)"),
    ("Opera", r"(?:OPR|Opera)/([0-9]+(?:\.[0-9]+)?)"),
    ("Chrome", r"Chrome/([0-9]+(?:\.[0-9]+)?)"),
    ("Firefox", r"Firefox/([0-9]+(?:\.[0-9]+)?)"),
    ("IE", r"MSIE ([0-9]+(?:\.[0-9]+)?)"),
    ("IE", r"Trident/.*rv:([0-9]+(?:\.[0-9]+)?)"),
    ("Safari", r"Version/([0-9]+(?:\.[0-9]+)?).*Safari/"),
]
SYSTEM_RULES = [
    ("Android", r"Android ([0-9]+(?:\.[0-9]+)?)"),
    ("iOS", r"(?:iPhone|CPU) OS ([0-9]+(?:_[0-9]+)?)"),
    ("Chrome OS", r"CrOS [a-z0-9_]+ ([0-9]+(?:\.[0-9]+)?)"),
    ("Windows", r"Windows NT ([0-9]+\.[0-9]+)"),
    ("macOS", r"Mac OS X ([0-9]+(?:[._][0-9]+)?)"),
    ("Linux", r"(Linux)"),
]


def _first_rule(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(name, version) by the first rule that matches, in one chain of tests."""

    def found(name: Column, version: Column) -> Column:
        return F.struct(name.alias("name"), version.alias("version"))

    picks = [F.when(text.rlike(p), found(F.lit(n), F.regexp_extract(text, p, 1))) for n, p in rules]
    return F.coalesce(*picks, found(F.lit(UNKNOWN), F.lit(UNKNOWN)))


def with_user_agent(df: DataFrame, column: str) -> DataFrame:
    """Adds browser, browser_v, os and os_v; all null for a blank user agent."""
    text = F.col(column)
    parsed = computed_once(df, "_b", F.when(~is_blank(text), _first_rule(text, BROWSER_RULES)))
    parsed = computed_once(parsed, "_o", F.when(~is_blank(text), _first_rule(text, SYSTEM_RULES)))
    return parsed.select(
        *df.columns,
        F.col("_b.name").alias("browser"),
        F.col("_b.version").alias("browser_v"),
        F.col("_o.name").alias("os"),
        F.col("_o.version").alias("os_v"),
    )


# Names the region text of an address range may begin with.
CHINA = "中国"
LOCAL_NETWORK = "局域网"
LOCAL_PROVINCE = "上海市"
INNER_MONGOLIA = "内蒙"
INNER_MONGOLIA_FULL = "内蒙古自治区"
AUTONOMOUS_REGIONS = ["广西", "西藏", "宁夏", "新疆"]
MUNICIPALITIES = ["上海", "北京", "天津", "重庆"]
SPECIAL_REGIONS = ["香港", "澳门"]
SPECIAL_SUFFIX = "特别行政区"


def region_parts(region: Column) -> Column:
    """Region text of an address range as struct(country, province, city)."""
    r = F.trim(region)
    head = F.substring(r, 1, 2)
    has_province = r.rlike("^.+?省")
    municipality = head.isin(MUNICIPALITIES)
    special = head.isin(SPECIAL_REGIONS)
    autonomous = head.isin(AUTONOMOUS_REGIONS)
    inner = head == INNER_MONGOLIA
    local = r == LOCAL_NETWORK

    province = (
        F.when(local, F.lit(LOCAL_PROVINCE))
        .when(has_province, F.regexp_extract(r, "^(.+?省)", 1))
        .when(inner, F.lit(INNER_MONGOLIA_FULL))
        .when(autonomous, head)
        .when(municipality, F.concat(head, F.lit("市")))
        .when(special, F.concat(head, F.lit(SPECIAL_SUFFIX)))
    )
    district = F.regexp_extract(r, "^..市?(.+?区)", 1)
    county = F.regexp_extract(r, "^..市?(.+?县)", 1)
    city = (
        F.when(has_province, F.regexp_extract(r, "^.+?省(.*?市)", 1))
        .when(inner, F.regexp_extract(r, "^内蒙古(.+?市)", 1))
        .when(autonomous, F.regexp_extract(r, "^..(.+?市)", 1))
        .when(municipality, F.when(district != "", district).otherwise(county))
    )
    return F.struct(
        F.when(province.isNotNull(), F.lit(CHINA)).otherwise(UNKNOWN).alias("country"),
        F.coalesce(province, F.lit(UNKNOWN)).alias("province"),
        F.when(F.coalesce(city, F.lit("")) == "", F.lit(UNKNOWN)).otherwise(city).alias("city"),
    )
