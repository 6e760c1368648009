"""Quality rules: lines that many documents of a host share, and documents left with little else.

A line is normalised (A-Z lower-cased, digit runs to 0, white space runs to one
space) and hashed to 128 bits.  For every host and line the distinct documents
that hold it are counted, copies of one text as one document.  A line in more
than ``min_docs`` documents and more than ``share`` of its host's is removed; a
document with fewer than ``min_words`` words or ``min_left`` of its words left
is rejected.  Basic rules come first: too few words, or too many words in
repeated windows.

One pass reads the texts and writes numbers and line hashes; all later steps
read those.  Distinct documents are counted in two steps, so neither a host nor
a line with a third of all rows gathers in one task.

Null texts are empty; a null host is a host of its own.  Rows that repeat id and
text are verdicts of their own.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import column, fresh, gathered, quoted
from footfall.llm.tokens import bytes_of
from footfall.session import materialize

WINDOW = 8
TEXT_BYTES = 8 << 20
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Basic rules, then line frequency; shares are in percent."""

    base_words: int = 20
    base_repeat: int = 30
    min_docs: int = 10
    share: int = 5
    min_words: int = 5
    min_left: int = 30


def _counted(raw: np.ndarray, at: np.ndarray, members: bytes) -> np.ndarray:
    """How many bytes of each text are among ``members``."""
    flag = np.zeros(256, np.int64)
    flag[list(members)] = 1
    return np.diff(np.concatenate([[0], np.cumsum(flag[raw])])[at])


def _lists(split: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct values of a list array, the code of each value, and where lists begin."""
    at = np.asarray(split.offsets).astype(np.int64)
    coded = split.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), at - at[0]


def _ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs only."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def repeated_words(codes: np.ndarray, at: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text inside windows that it holds twice or more.

    Windows are told apart by ranks of ranks (1, 2, 4, 8 words), never by hash.
    """
    sizes = np.diff(at)
    text = np.repeat(np.arange(len(sizes)), sizes)
    here = np.flatnonzero(np.arange(len(codes)) + window <= np.repeat(at[1:], sizes))
    if not len(here):
        return np.zeros(len(sizes), np.int64)
    rank, width = codes, 1
    while 2 * width <= window:
        rank = _ranked(rank[:-width], rank[width:])
        width *= 2
    own = rank[here]
    for extra in range(width, window):  # windows that are no power of two
        own = _ranked(own, codes[here + extra])
    _, of, n = np.unique(_ranked(text[here], own), return_inverse=True, return_counts=True)
    start = here[n[of] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    inside = np.cumsum(edge[:-1]) > 0
    return np.bincount(text[inside], minlength=len(sizes))


def _normal(lines: pa.Array) -> pa.Array:
    lines = pc.replace_substring_regex(pc.ascii_lower(lines), "[0-9]+", "0")
    return pc.utf8_trim(pc.replace_substring_regex(lines, r"[\x20\x09-\x0D]+", " "), " ")


def _measured(texts: pa.Array) -> dict[str, pa.Array]:
    """Of each text: the numbers, its hash, and its lines as (hash, number, words)."""
    texts = texts.fill_null("").cast(pa.large_string())
    raw, byte_at = bytes_of(texts)
    words, code, at = _lists(pc.ascii_split_whitespace(texts))
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    kept = real[code] if len(code) else np.zeros(0, bool)
    word_at = np.concatenate([[0], np.cumsum(kept)])[at]
    lines, line, line_at = _lists(pc.split_pattern(texts, "\n"))
    split = pc.ascii_split_whitespace(lines)
    full = pc.binary_length(split.values).to_numpy(zero_copy_only=False) > 0
    line_words = np.diff(np.concatenate([[0], np.cumsum(full)])[np.asarray(split.offsets)])
    text_of = np.repeat(np.arange(len(texts)), np.diff(line_at))
    number = np.arange(len(line)) - line_at[text_of]
    shown = np.flatnonzero(line_words[line] > 0)
    line, text_of, number = line[shown], text_of[shown], number[shown]
    distinct = np.bincount(np.unique(text_of * (len(lines) + 1) + line) // (len(lines) + 1), minlength=len(texts))
    n_lines = np.bincount(text_of, minlength=len(texts))
    digests = [hashlib.blake2b(x.as_py().encode(), digest_size=16).digest() for x in _normal(lines)]
    each = pa.StructArray.from_arrays(
        [
            pa.array(digests, pa.binary()).take(pa.array(line)),
            pa.array(number, pa.int32()),
            pa.array(line_words[line], pa.int32()),
        ],
        ["line", "number", "words"],
    )
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    numbers = (
        np.diff(word_at),
        chars - _counted(raw, byte_at, SPACES),
        _counted(raw, byte_at, SYMBOLS),
        n_lines - distinct,
        repeated_words(code[kept], word_at),
    )
    out = {name: pa.array(x.astype(np.int64)) for name, x in zip(NUMBERS, numbers)}
    view = memoryview(raw)
    ends = byte_at.tolist()
    out["digest"] = pa.array(
        [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(ends, ends[1:])], pa.binary()
    )
    at = np.concatenate([[0], np.cumsum(n_lines)])
    out["lines"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), each)
    return out


MEASURED = (
    ", ".join(f"{n} long" for n in NUMBERS)
    + ", digest binary, lines array<struct<line: binary, number: int, words: int>>"
)


def _measure(docs: DataFrame, text_col: str, host_col: str, kept: dict[str, str]) -> DataFrame:
    """Written rows of ``kept`` (new name: column), host, row, and what ``_measured`` gives."""
    rows = docs.select(
        *[quoted(old).alias(new) for new, old in kept.items()],
        quoted(host_col).cast("string").alias("host"),
        F.monotonically_increasing_id().alias("row"),
        quoted(text_col).alias("text"),
    )
    carried = [c for c in rows.columns if c != "text"]
    kind = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried), MEASURED])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            new = _measured(column(t, "text"))
            whole = pa.Table.from_arrays(
                [*(t.column(c) for c in carried), *new.values()], names=[*carried, *new]
            )
            yield from whole.to_batches()

    return materialize(rows.mapInArrow(run, kind), "lines")


def frequent_lines(measured: DataFrame, limits: Limits) -> DataFrame:
    """host, line: in more documents of the host than the limits allow; a null host is marked by ``no_host``."""
    host = (F.coalesce("host", F.lit("")).alias("host"), F.col("host").isNull().alias("no_host"))
    key = ["host", "no_host"]
    size = measured.select(*host, "digest").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("docs"))
    held = measured.select(*host, "digest", F.explode("lines").alias("l")).select(*key, "digest", "l.line").distinct()
    held = held.groupBy(*key, "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limits.min_docs)
    return held.join(size, key).where(F.col("n") * 100 > F.col("docs") * limits.share).select(*key, "line")


def line_verdicts(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    keep_columns: bool = False,
) -> DataFrame:
    """Per row: doc_id, the numbers, removed (line numbers from 0), left_words, base_failed, kept.

    With ``keep_columns``: all columns of the rows kept instead, their texts
    without the removed lines.
    """
    held = {"doc_id": id_col}
    if keep_columns:
        names = fresh(["host", "row", *NUMBERS, "digest", "lines", "text"], *(f"c{i}" for i in range(len(docs.columns))))
        held = dict(zip(names, docs.columns))
    measured = _measure(docs, text_col, host_col, held)
    found = measured.select(
        "row", F.coalesce("host", F.lit("")).alias("host"), F.col("host").isNull().alias("no_host"), F.explode("lines").alias("l")
    ).select("row", "host", "no_host", "l.*")
    gone = (
        found.join(frequent_lines(measured, limits), ["host", "no_host", "line"])
        .groupBy("row")
        .agg(F.sum("words").alias("lost"), F.sort_array(F.collect_list("number")).alias("removed"))
    )  # as many numbers as the document has lines
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    base_failed = (F.col("n_words") < limits.base_words) | (
        100 * F.col("n_repeat_words") > limits.base_repeat * F.col("n_words")
    )
    depleted = (left < limits.min_words) | (100 * left < limits.min_left * F.col("n_words"))
    out = measured.join(gone, "row", "left")
    if not keep_columns:
        return out.select(
            "doc_id",
            *NUMBERS,
            F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
            left.alias("left_words"),
            base_failed.alias("base_failed"),
            (~base_failed & ~depleted).alias("kept"),
        )
    text = names[docs.columns.index(text_col)]
    whole = F.split(F.col(text), "\n", -1)
    clean = F.array_join(F.filter(whole, lambda _, i: ~F.array_contains("removed", i)), "\n")
    shown = F.when(F.col("removed").isNull(), F.col(text)).otherwise(clean)
    return out.where(~base_failed & ~depleted).select(
        *[(shown if new == text else F.col(new)).alias(old) for new, old in held.items()]
    )
