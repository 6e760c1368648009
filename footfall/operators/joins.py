"""Joins with domain meaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions.web import INBOUND_INTERNAL, INBOUND_OTHER, ip_number, with_external_host
from footfall.operators.skew import checked_broadcast, spread_nulls


def session_with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with the attributes of their user.

    The plain equi-join: the planner broadcasts a small user table, and
    adaptive execution splits the partition of a very active user.
    """
    return sessions.join(users, "user_id")


def click_with_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    return clicks.join(checked_broadcast(cities), "city_id")


def with_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Adds the product name and who sells it (decoded from the JSON field)."""
    status = F.get_json_object("extend_info", "$.product_status")
    info = products.select(
        "product_id",
        "product_name",
        F.when(status == "0", "Self").otherwise("Third Party").alias("product_status"),
    )
    return rows.join(info, "product_id")


def without_users(rows: DataFrame, blacklist: DataFrame, key: str = "user_id") -> DataFrame:
    return rows.join(blacklist.select(key), key, "left_anti")


def unseen(rows: DataFrame, history: DataFrame, key: str, history_key: str | None = None) -> DataFrame:
    """Rows whose key is not in the history."""
    seen = history.select(F.col(history_key or key).alias(key))
    return rows.join(seen, key, "left_anti")


def detail_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Detail rows of the given sessions."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def _covers(ranges: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Address ranges as three tables: whole /8 networks, whole /16 networks, disjoint rest.

    Where ranges overlap the narrowest wins, then the lower start, then the
    columns.  A range covers at most 256 networks of size /8, twice 255 of size
    /16 beside them, and a part of two more.
    """
    info = F.struct(
        (F.col("_hi") - F.col("_lo")).alias("width"), F.col("_lo").alias("lo"), F.struct(*columns).alias("of")
    ).alias("info")
    r = (
        ranges.withColumn("_lo", ip_number(F.col("begin_ip")))
        .withColumn("_hi", ip_number(F.col("end_ip")))
        .where(F.col("_lo") <= F.col("_hi"))
        .select(F.col("_lo").alias("lo"), (F.col("_hi") + 1).alias("end"), info)
    )

    def whole(bits: int) -> tuple[Column, Column]:
        """First network of this size inside the range, and the one after the last."""
        size = 1 << bits
        first = F.floor((F.col("lo") + size - 1) / size).cast("int")
        return first, F.greatest(first, F.floor(F.col("end") / size).cast("int"))

    def numbers(a: Column, b: Column) -> Column:
        return F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))

    a8, b8 = whole(24)
    a16, b16 = whole(16)
    # /16 networks outside the whole /8 ones
    outer = F.when(a8 < b8, F.concat(numbers(a16, a8 * 256), numbers(b8 * 256, b16))).otherwise(numbers(a16, b16))
    net8 = r.select(F.explode(numbers(a8, b8)).alias("net"), "info").groupBy("net").agg(F.min("info").alias("i8"))
    net16 = r.select(F.explode(outer).alias("net"), "info").groupBy("net").agg(F.min("info").alias("i16"))
    # what is left lies in the first and the last /16 network
    edges = F.filter(
        F.array(
            F.struct(F.col("lo"), F.least(F.col("end"), F.when(a16 < b16, a16.cast("bigint") * 65536).otherwise(F.col("end"))).alias("end")),
            F.struct(F.greatest(F.col("lo"), b16.cast("bigint") * 65536).alias("lo"), F.col("end")),
        ),
        lambda e: e["lo"] < e["end"],
    )
    # a range without a whole /16 may cross one border
    parts = r.select(F.explode(F.array_distinct(edges)).alias("e"), "info").select("e.lo", "e.end", "info")
    border = (F.floor(F.col("lo") / 65536) + 1).cast("bigint") * 65536
    split = F.when(
        F.col("end") > border,
        F.array(F.struct("lo", border.alias("end")), F.struct(border.alias("lo"), F.col("end"))),
    ).otherwise(F.array(F.struct("lo", "end")))
    parts = parts.select(F.explode(split).alias("e"), "info").select(
        F.shiftright("e.lo", 16).cast("int").alias("net"), "e.lo", "e.end", "info"
    )
    return net8, net16, _disjoint(parts)


def _block_list() -> Column:
    """Blocks of 2^level addresses, aligned, that make up [lo, end): two of each size at most."""
    first = lambda k: f"shiftright(lo + shiftleft(1L, {k}) - 1, {k})"  # noqa: E731  whole ones from lo on
    after = lambda k: f"shiftright(end, {k})"  # noqa: E731  and up to this one
    inside = f"x.block >= {first('k')} AND x.block < {after('k')}"
    larger = f"x.block >= 2 * {first('k + 1')} AND x.block < 2 * {after('k + 1')}"  # a block of twice the size has it
    ends = f"array(struct(k AS level, {first('k')} AS block), struct(k AS level, {after('k')} - 1 AS block))"
    blocks = f"transform(sequence(0, 16), k -> filter({ends}, x -> {inside} AND (k = 16 OR NOT ({larger}))))"
    return F.expr(f"array_distinct(flatten({blocks}))")


def _disjoint(parts: DataFrame) -> DataFrame:
    """net, lo, end, i: disjoint ranges inside /16 networks, with the best ``info`` that covers each.

    Between two neighbouring borders of a network the same ranges apply, so
    the first address of a piece stands for it.  Ranges are cut into aligned
    blocks, two of each size at most; an address lies in one block of each of
    17 sizes, so a piece finds its ranges by equi-joins.  Rows grow with the
    ranges, not with ranges times borders.
    """
    best = parts.select(F.explode(_block_list()).alias("b"), "info").groupBy("b.level", "b.block").agg(F.min("info").alias("info"))
    borders = parts.select("net", F.explode(F.array("lo", "end")).alias("lo")).distinct()
    after = F.lead("lo").over(W.partitionBy("net").orderBy("lo"))  # 65,537 borders at most
    pieces = borders.withColumn("end", after).where("end IS NOT NULL")
    level = F.explode(F.sequence(F.lit(0), F.lit(16)))
    asked = pieces.withColumn("level", level).withColumn("block", F.expr("shiftright(lo, level)"))
    return asked.join(best, ["level", "block"]).groupBy("net", "lo", "end").agg(F.min("info").alias("i"))


def ip_region(rows: DataFrame, ranges: DataFrame, ip: str = "ip", columns: Sequence[str] = ("region",)) -> DataFrame:
    """Adds ``columns`` of the narrowest address range that holds ``ip`` (null if none).

    One row out for each row in, however ranges overlap.  The tables of whole
    networks have at most 256 and 65,536 rows, so they are broadcast; the rest
    is joined by /16 network, and its ranges are disjoint there.
    """
    net8, net16, rest = _covers(ranges, list(columns))
    n = F.col("_n")
    best = F.col("_best.of")
    return (
        rows.withColumn("_n", ip_number(F.col(ip)))
        .withColumns({"_n8": F.shiftright("_n", 24).cast("int"), "_n16": F.shiftright("_n", 16).cast("int")})
        .join(F.broadcast(net8.withColumnRenamed("net", "_k8")), F.col("_n8") == F.col("_k8"), "left")
        .join(F.broadcast(net16.withColumnRenamed("net", "_k16")), F.col("_n16") == F.col("_k16"), "left")
        .join(
            checked_broadcast(rest.toDF("_kr", "_lo", "_end", "_ir")),
            (F.col("_n16") == F.col("_kr")) & (n >= F.col("_lo")) & (n < F.col("_end")),
            "left",
        )
        .withColumn("_best", F.least("i8", "i16", "_ir"))
        .select(*rows.columns, *[best[c].alias(c) for c in columns])
    )


META = r"[.*+?^$|(){}\[\]\\]"


GAP = "\x01"  # where anything may stand
DOT = "\x02"  # a dot that is meant


def _required_texts(pattern: Column) -> Column:
    """For each alternative of a regular expression, the longest text that all its matches contain.

    Escapes of signs are read; classes, groups and whatever may be missing or
    repeated are gaps.  An expression with flags, deep groups or an alternative
    without any plain text gives an empty array.
    """
    def cut(c: Column, what: str, to: str = GAP) -> Column:
        return F.regexp_replace(c, F.lit(what), F.lit(to))

    c = cut(pattern, r"\\\.", DOT)
    c = cut(c, r"\\([^A-Za-z0-9.|(){}\[\]*+?^$\\])", "$1")
    c = cut(c, r"\\.")  # other escapes
    c = cut(c, r"\[[^\]]*\]([*+?]|\{[^}]*\})?")
    for _ in range(3):
        c = cut(c, r"\([^()]*\)([*+?]|\{[^}]*\})?")
    c = cut(c, r"[^\x01]([*?]|\{[^}]*\})[+?]?")  # the character before need not be there
    c = cut(c, r"[.^$+*?]")
    parts = F.transform(
        F.split(c, r"\|"), lambda x: F.array_max(F.transform(F.split(x, GAP), lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))
    )
    texts = F.transform(parts, lambda p: F.translate(p["t"], DOT, "."))
    unread = F.contains(pattern, F.lit("(?")) | c.rlike(r"[(){}\[\]]") | F.exists(texts, lambda t: t == "")
    return F.when(unread, F.array().cast("array<string>")).otherwise(texts)


LOOSE_SALTS = 64


def inbound_of(rows: DataFrame, patterns: DataFrame, own_hosts: Sequence[str], url: str = "p_ref") -> DataFrame:
    """Adds ``inbound`` by matching the referrer host with a pattern table.

    A pattern may be a host, a prefix or a regular expression.  All it matches
    contains its longest plain text (of each alternative), so distinct hosts
    and patterns meet in an equi-join of those texts and the parts of the hosts
    of the same lengths, and only there the expression is tried.  Expressions
    without plain text meet every host, dealt out by ``LOOSE_SALTS`` numbers.
    The smallest matching id wins.  0 = internal or unparsable, 2 = none of the
    patterns.
    """
    hosted = with_external_host(rows, url, "_host", own_hosts)
    hosts = hosted.where(F.col("_host").isNotNull()).select("_host").distinct()
    h, u = F.col("_host"), F.col("url")
    number = lambda c: F.concat(F.lit(GAP), c.cast("string"))
    is_plain = ~u.rlike(META)
    required = _required_texts(u)
    # an expression may also be meant as it is written
    texts = F.when(is_plain, F.array(u)).otherwise(F.array_append(required, u))
    loose = F.transform(F.sequence(F.lit(0), F.lit(LOOSE_SALTS - 1)), number)
    unknown = (~is_plain & (F.size(required) == 0)) | (u == "")
    known = patterns.where(u.isNotNull()).select(
        F.col("id").alias("_id"), "url", F.explode(F.array_distinct(F.when(unknown, loose).otherwise(texts))).alias("_part")
    )
    # as many lengths as the longest pattern has characters, at most
    lengths = known.where(~F.startswith("_part", F.lit(GAP))).agg(F.array_sort(F.collect_set(F.length("_part"))).alias("_lengths"))
    size = F.length(h)
    parts = F.flatten(
        F.transform(
            F.filter("_lengths", lambda n: n <= size),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.substr(h, at, n)),
        )
    )
    salt = number(F.pmod(F.xxhash64(h), F.lit(LOOSE_SALTS)))
    matches = F.startswith(h, u) | (~is_plain & F.rlike(h, F.concat(F.lit("^(?:"), u, F.lit(")$"))))
    found = (
        hosts.join(F.broadcast(lengths))  # one row
        .select("_host", F.explode(F.array_append(F.array_distinct(parts), salt)).alias("_part"))
        .join(known, "_part")
        .where(matches)
        .groupBy("_host")
        .agg(F.min("_id").alias("_id"))
    )
    # internal and missing referrers have no host; they may well be the most rows
    keyed = spread_nulls(hosted, "_host", "_key")
    inbound = F.when(h.isNull(), INBOUND_INTERNAL).otherwise(F.coalesce("_id", F.lit(INBOUND_OTHER)))
    return keyed.join(found.withColumnRenamed("_host", "_key"), "_key", "left").select(
        *rows.columns, h.alias("host"), inbound.alias("inbound")
    )


def with_order_info(rows: DataFrame, order_info: DataFrame, order_id: str = "oid") -> DataFrame:
    """Platform, currency, payment type and amount of an order.

    Missing or blank text becomes ``unknown``, a missing amount 0.  Rows without
    an order id are spread over the tasks.  ``order_info`` has one row per order.
    """
    info = order_info.select(
        F.col("order_id").alias("_key"),
        F.col("platform").alias("_pl"),
        F.col("currency_type").alias("_cut"),
        F.col("payment_type").alias("_pt"),
        F.col("amount").alias("_amount"),
    )

    def filled(c: str):
        return F.when(F.trim(F.col(c)) != "", F.col(c)).otherwise("unknown")

    keep = [c for c in rows.columns if c not in ("pl", "cut", "pt", "amount")]
    return spread_nulls(rows.select(*keep), order_id, "_key").join(info, "_key", "left").select(
        *keep,
        filled("_pl").alias("pl"),
        filled("_cut").alias("cut"),
        filled("_pt").alias("pt"),
        F.coalesce("_amount", F.lit(0).cast("bigint")).alias("amount"),
    )


def with_previous_day(totals: DataFrame, keys: Sequence[str], value: str, day: str = "date") -> DataFrame:
    """Each day's value next to the value of the day before (0 if missing).

    ``totals`` holds one row per key and day, so looking back inside the key
    replaces a self-join that would compute the totals twice.
    """
    w = W.partitionBy(*keys).orderBy(day)
    is_next = F.date_add(F.lag(day).over(w).cast("date"), 1) == F.col(day).cast("date")
    before = F.when(is_next, F.lag(value).over(w))
    return totals.withColumn(f"prev_{value}", F.coalesce(before, F.lit(0).cast("bigint")))
