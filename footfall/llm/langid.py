"""Language identification by rank-order profiles of character n-grams.

Words are runs of letters, lower-cased, with a space at each end; n-grams of
one to ``LONGEST`` characters are taken inside them.  A language's profile is
its ``SIZE`` most frequent n-grams over all labelled texts; a document's is
made the same way.  The distance of the two sums, over the document's n-grams,
how far the ranks lie apart, and ``SIZE`` for one that the language lacks.
Ties in frequency go to the smaller code points, ties in distance to the first
language in alphabetical order.

Per batch every distinct word is cut once; counting is numpy throughout.
Texts that are null or hold no letter are ``und`` with score 0.  Without any
labelled text every prediction is ``und``.  Repeated rows count once each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.common import column, gathered, quoted
from footfall.llm.tokens import ragged_take

SIZE = 400
LONGEST = 3
TEXT_BYTES = 6 << 20
TOGETHER = 96  # documents counted in one dense table
UNKNOWN = "und"


class Cut:
    """Words and n-grams of some texts.

    ``word`` holds the distinct-word number of every word, ``at`` where each
    text's begin; distinct word w has the n-grams ``gram[gram_at[w]:gram_at[w+1]]``,
    numbers into ``codes``, which are sorted.
    """

    def __init__(self, texts: pa.Array, longest: int):
        texts = pc.utf8_lower(texts.fill_null("").cast(pa.large_string()))
        texts = pc.replace_substring_regex(texts, r"\PL+", " ")
        split = pc.ascii_split_whitespace(texts)
        at = np.asarray(split.offsets).astype(np.int64)
        coded = split.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at -= at[0]
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        real = np.fromiter(map(len, words), np.int64, len(words)) > 0
        kept = real[word] if len(word) else np.zeros(0, bool)
        self.at = np.concatenate([[0], np.cumsum(kept)])[at]
        self.word = word[kept]
        # characters of all distinct words, a space before, between and after
        chars = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), "<u4").astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(size + 1) - size - 1  # of the space before each word
        parts, owner = [], []
        for n in range(1, longest + 1):
            if n == 1:
                first, many = begin + 1, size
            else:
                first, many = begin, np.maximum(size + 3 - n, 0) * (size > 0)
            place = ragged_take(np.arange(len(chars)), first, many)
            code = np.zeros(len(place), np.int64)
            for k in range(n):
                code |= chars[place + k] << (21 * k)
            parts.append(code)
            owner.append(np.repeat(np.arange(len(words)), many))
        codes = np.concatenate(parts)
        owner = np.concatenate(owner)
        self.codes, number = np.unique(codes, return_inverse=True)
        order = np.argsort(owner, kind="stable")
        self.gram = number[order]
        self.gram_at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]).astype(np.int64)

    def tallies(self, group: np.ndarray, groups: int) -> np.ndarray:
        """How often each n-gram occurs in the texts of each group (negative: in none)."""
        size = np.diff(self.gram_at)
        out = np.zeros((groups, len(self.codes)), np.int64)
        of_word = np.repeat(group, np.diff(self.at))
        for g in range(groups):
            per_word = np.bincount(self.word[of_word == g], minlength=len(size))
            out[g] = np.bincount(self.gram, weights=np.repeat(per_word, size), minlength=len(self.codes))
        return out

    def tops(self, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Blocks of texts: (first, n-grams by rank, how many of them count)."""
        n, grams = len(self.at) - 1, len(self.codes)
        lens = np.diff(self.gram_at)
        for a in range(0, n, TOGETHER):
            b = min(a + TOGETHER, n)
            words = self.word[self.at[a] : self.at[b]]
            row = np.repeat(np.arange(b - a), np.diff(self.at[a : b + 1]))
            key = ragged_take(self.gram, self.gram_at[words], lens[words]) + np.repeat(row * grams, lens[words])
            count = np.bincount(key, minlength=(b - a) * grams).reshape(b - a, grams)
            many = np.minimum((count > 0).sum(axis=1), size)
            # the more frequent first, then the smaller code
            weight = count * grams + (grams - 1 - np.arange(grams))
            k = min(size, grams)
            top = np.argpartition(weight, grams - k, axis=1)[:, grams - k :] if k else np.zeros((b - a, 0), np.int64)
            order = np.argsort(-np.take_along_axis(weight, top, axis=1), axis=1)
            yield a, np.take_along_axis(top, order, axis=1), many


def learn_profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SIZE, longest: int = LONGEST
) -> DataFrame:
    """The profiles, a row per language and rank: lang, rank, gram.  Rows of null language are left out."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            cut = Cut(column(t, "text"), longest)
            langs = column(t, "lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            tally = cut.tallies(langs.indices.to_numpy(zero_copy_only=False), len(names))
            for name, row in zip(names, tally):
                used = np.flatnonzero(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used), pa.string()), pa.array(cut.codes[used]), pa.array(row[used])],
                    ["lang", "gram", "n"],
                )

    labelled = docs.select(quoted(text_col).alias("text"), quoted(lang_col).cast("string").alias("lang")).filter(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    total = labelled.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = total.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < size)
    return ranked.select("lang", "rank", "gram")


def identify(
    docs: DataFrame,
    profiles: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    longest: int = LONGEST,
) -> DataFrame:
    """Per document: doc_id, lang_pred, score (1 at distance 0, 0 at the largest possible)."""
    # ``size`` rows for each label value: the whole model
    learned: dict[str, dict[int, int]] = {}
    for row in profiles.collect():
        learned.setdefault(row["lang"], {})[row["gram"]] = row["rank"]
    langs = sorted(learned)
    model = []
    for lang in langs:
        grams = np.array(sorted(learned[lang]), np.int64)
        model.append((grams, np.array([learned[lang][g] for g in grams.tolist()], np.int64)))

    def guess(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            cut = Cut(column(t, "text"), longest)
            ranks = []
            for grams, rank in model:
                spot = np.minimum(np.searchsorted(grams, cut.codes), len(grams) - 1)
                ranks.append(np.where(grams[spot] == cut.codes, rank[spot], -1))
            names, scores = [], []
            for _, top, many in cut.tops(size):
                place = np.arange(top.shape[1])
                counts = place < many[:, None]
                far = np.empty((len(langs), len(top)))
                for i, rank in enumerate(ranks):
                    r = rank[top]
                    far[i] = (np.where(r < 0, size, np.abs(r - place)) * counts).sum(axis=1)
                best = far.argmin(axis=0) if langs else np.zeros(len(top), np.int64)
                for j, n in enumerate(many.tolist()):
                    known = n > 0 and bool(langs)
                    names.append(langs[best[j]] if known else UNKNOWN)
                    scores.append(1.0 - float(far[best[j], j]) / (size * n) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [column(t, "doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    return rows.mapInArrow(guess, "doc_id long, lang_pred string, score double")


def train_and_identify(docs: DataFrame, train: Column, **names) -> DataFrame:
    text, lang = names.get("text_col", "text"), names.pop("lang_col", "lang")
    return identify(docs, learn_profiles(docs.filter(train), text, lang), **names)
