"""Phrases of words that stand together more often than their parts suggest.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
pieces into words at spaces and tabs.  Everything is per language, a null
language being ``und``.  A phrase of 2 to ``max_words`` words that occurs
``min_count`` times or more is a candidate; cut after its first k words it has

    score = floor(10^6 a a / (l r)),

a, l, r being the occurrences of the phrase and of the two parts, and its
lowest cut counts.  A candidate that lies inside a longer one with at least
``contained`` percent of its occurrences is dropped.

1. Tasks cut texts into chunks, write the words of a chunk as numbers, and hand
   on each distinct word with its count, once per chunk.
2. Words that occur often enough get numbers by falling count; every chunk gets
   back those of its own words, and others end a sequence: no phrase with a
   rarer word is a candidate.
3. Each task counts the phrases of its chunks in a HAT-trie, which hands out
   whole subtrees as sorted runs when it is full.  Runs are dealt by prefix - the
   first word and a share of the second ones, so that no common word gathers in
   one task - and added up there.  Pairs come first, then longer phrases, of
   which only those are counted whose two shorter phrases stand in a bitmap of
   the frequent ones.  The bitmap has a fixed size: phrases that share a bit are
   counted in vain, none is lost.
4. Scores, containment and ranks are joins of candidates and counts; products are
   decimals of 38 digits.

Null and empty texts have no words.  Repeated rows count once each.  Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import column, gathered, quoted
from footfall.llm.files import new_file, opened
from footfall.llm.hattrie import HatTrie
from footfall.llm.tokens import bytes_of
from footfall.operators.skew import numbered, top_per_group
from footfall.session import materialize, workspace

BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
TEXT_BYTES = 16 << 20
GRAMS = 2_000_000  # in memory of a task
ROWS = 500_000  # windows counted at a time
SHARES = 64  # of the second words of a prefix
FILTER_BITS = 1 << 26  # 8 MB at any size of input
NO_LANG = "und"

KIND = np.zeros(256, np.uint8)
KIND[list(SPACES)] = 1
KIND[list(BREAKS)] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words, the piece each stands in (ascending), and its text."""
    raw, at = bytes_of(texts.fill_null("").cast(pa.large_string()))
    kind = KIND[raw]
    inner = kind == 0
    first = inner.copy()
    first[1:] &= kind[:-1] != 0
    begin = at[:-1][np.diff(at) > 0]
    first[begin] = inner[begin]
    start = np.flatnonzero(first)
    text = np.searchsorted(at, start, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), start) + text
    offsets = np.append(np.flatnonzero(first[inner]), np.count_nonzero(inner)).astype(np.int64)
    data = LOWER[raw[inner]]
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))
    return words, piece, text


def _chunks(docs: DataFrame, folder: str) -> DataFrame:
    """Write the chunk files; per chunk and distinct word of a language: chunk, idx, lang, word, n."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, t in enumerate(gathered(batches, TEXT_BYTES)):
            chunk = (task << 20) + k
            words, piece, text = words_of(column(t, "text"))
            if not len(words):
                continue
            langs = column(t, "lang").dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
            coded = words.dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False) * len(langs.dictionary) + lang
            distinct, code, n = np.unique(code, return_inverse=True, return_counts=True)
            sequence = np.full(len(code) + int(np.count_nonzero(np.diff(piece))), -1, np.int32)
            sequence[np.arange(len(code)) + np.cumsum(np.diff(piece, prepend=piece[0]) > 0)] = code
            with new_file(f"{folder}/words-{chunk}") as out:
                out.write(sequence.tobytes())
            word, lang = np.divmod(distinct, len(langs.dictionary))
            table = pa.Table.from_arrays(
                [
                    pa.array(np.full(len(n), chunk)), pa.array(np.arange(len(n)), pa.int32()),
                    langs.dictionary.take(pa.array(lang)), coded.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(n),
                ],
                ["chunk", "idx", "lang", "word", "n"],
            )
            yield from table.to_batches(max_chunksize=65_536)

    return docs.mapInArrow(run, "chunk long, idx int, lang string, word string, n long")


def slots(words: list[np.ndarray]) -> np.ndarray:
    """The place of each phrase in the bitmap."""
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = (h ^ w.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.int64) % FILTER_BITS


def windows(sequence: np.ndarray, n: int, bitmap: np.ndarray | None) -> Iterator[np.ndarray]:
    """Rows of ``n`` words in a row, whose first and last n - 1 the bitmap knows, some at a time."""
    for start in range(0, len(sequence) - n + 1, ROWS):
        part = sequence[start : start + ROWS + n - 1]
        count = len(part) - n + 1
        columns = [part[c : c + count] for c in range(n)]
        whole = np.logical_and.reduce([c >= 0 for c in columns])
        if bitmap is not None:
            slot = slots([part[c : c + count + 1] for c in range(n - 1)])
            known = (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
            whole &= known[:-1] & known[1:]
        spots = np.flatnonzero(whole)
        yield np.stack([c[spots] for c in columns], axis=1)


def _counted(chunks: DataFrame, folder: str, n: int, bitmap: np.ndarray | None) -> DataFrame:
    """w0, w1, ..., n: runs of all tasks, for phrases of ``n`` words."""
    names = [f"w{c}" for c in range(n)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(n, GRAMS)

        def shown(runs):
            for rows, counts in runs:
                for a in range(0, len(counts), 65_536):
                    b = slice(a, a + 65_536)
                    columns = [pa.array(np.ascontiguousarray(rows[b, c])) for c in range(n)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[b])], [*names, "n"])

        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                with opened(f"{folder}/ids-{chunk}") as source:
                    sequence = np.frombuffer(source.read(), np.int32)
                for rows in windows(sequence, n, bitmap):
                    yield from shown(trie.add(rows))
        yield from shown(trie.rest())

    return chunks.mapInArrow(run, ", ".join(f"{w} int" for w in names) + ", n long")


def _bitmap(grams: DataFrame, n: int) -> np.ndarray:
    """The places of these phrases, ``FILTER_BITS`` bits however many they are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = slots([batch.column(c).to_numpy() for c in range(n)])
            yield pa.RecordBatch.from_arrays([pa.array(place)], ["place"])

    places = grams.select(*[f"w{c}" for c in range(n)]).mapInArrow(run, "place long")
    # the functions count buckets and places of 32,768 bits from 1
    bucket, bit = F.expr("bitmap_bucket_number(place + 1) - 1"), F.expr("bitmap_bit_position(place + 1)")
    placed = places.select(bucket.alias("bucket"), bit.alias("bit"))
    parts = placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts.collect():  # 4 KB each
        out[r["bucket"] * 4096 : (r["bucket"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def phrase_counts(
    docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: (lang, n) of all words; (id, lang, word, n) of words and (gram, n) of
    phrases - arrays of ids, single words too - that occur ``min_count`` times or more."""
    spark = docs.sparkSession
    folder = workspace(spark, "phrases")
    rows = docs.select(
        F.coalesce(quoted(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), quoted(text_col).alias("text")
    )
    found = materialize(_chunks(rows, folder), "chunk-words")
    totals = found.groupBy("lang").agg(F.sum("n").alias("n"))
    often = found.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    words = materialize(numbered(often, [F.desc("n"), "lang", "word"], "id"), "words")
    words = words.select((F.col("id") - 1).cast("int").alias("id"), "lang", "word", "n")
    known = found.select("chunk", "idx", "lang", "word").join(words.select("id", "lang", "word"), ["lang", "word"])

    def annotate(key, t):
        chunk = key[0].as_py()
        with opened(f"{folder}/words-{chunk}") as source:
            code = np.frombuffer(source.read(), np.int32)
        number = np.full(int(code.max()) + 2, -1, np.int32)  # its last place stands for -1
        number[column(t, "idx").to_numpy()] = column(t, "id").to_numpy()
        ids = number[code]
        ids = ids[(ids >= 0) | (np.append(-1, ids[:-1]) >= 0)]  # one end is enough
        with new_file(f"{folder}/ids-{chunk}") as out:
            out.write(ids.tobytes())
        return pa.table({"chunk": [chunk]})

    # a group holds the distinct words of one chunk
    chunks = materialize(known.select("chunk", "idx", "id").groupBy("chunk").applyInArrow(annotate, "chunk long"), "chunks")
    files = chunks.count()
    tasks = max(1, min(files, max(4 * spark.sparkContext.defaultParallelism, files // 4)))
    counts, bitmap = words.select(F.array("id").alias("gram"), "n"), None
    for size in range(2, max_words + 1):
        names = [f"w{c}" for c in range(size)]
        runs = _counted(chunks.repartition(tasks), folder, size, bitmap)
        prefix = F.pmod(F.hash("w1"), F.lit(SHARES))
        merged = (
            runs.withColumn("share", prefix).repartition("w0", "share")  # the sum needs no other exchange
            .groupBy("w0", "share", *names[1:]).agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
        )
        merged = materialize(merged.drop("share"), f"phrases-of-{size}")
        counts = counts.unionByName(merged.select(F.array(*names).alias("gram"), "n"))
        if size < max_words:
            bitmap = _bitmap(merged, size)
    return totals, words, counts


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def mine_phrases(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    top: int = 2000,
    contained: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` of each language by score, a, phrase."""
    totals, words, counts = phrase_counts(docs, max_words, min_count, text_col, lang_col)
    candidates = counts.where(F.size("gram") > 1).select("gram", F.col("n").alias("a"))
    cuts = candidates.select("gram", "a", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k"))
    cuts = cuts.withColumns({
        "left": F.slice("gram", 1, F.col("k")),
        "right": F.slice("gram", F.col("k") + 1, F.size("gram") - F.col("k")),
    })
    part = lambda name, n: counts.select(F.col("gram").alias(name), F.col("n").alias(n))
    scored = cuts.join(part("left", "l"), "left").join(part("right", "r"), "right")
    a = _wide(F.col("a"))
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), _wide(F.col("l")) * _wide(F.col("r")))
    lowest = scored.groupBy("gram").agg(
        F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    inner = candidates.where(F.size("gram") > 2)
    size = F.size("gram")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.slice("gram", at, n)),
        )
    )
    longer = inner.select(F.explode(spans).alias("gram"), "a").groupBy("gram").agg(F.max("a").alias("longest"))
    kept = lowest.join(longer, "gram", "left").where(
        F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * contained)
    )
    spelled = (
        kept.select("gram", F.posexplode("gram").alias("at", "id"))
        .join(words.select("id", "lang", "word"), "id")
        .groupBy("gram")
        .agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    )  # as many words as a phrase has
    out = kept.join(spelled, "gram").select(
        "lang", F.array_join("words.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"
    )
    best = top_per_group(out, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
