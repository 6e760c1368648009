"""Benchmark decontamination with an Aho-Corasick automaton.

Texts are normalised to words: A-Z lower-cased, everything else in ASCII but
digits and letters taken as a break.  A window is ``width`` consecutive words
of a benchmark item; an item of fewer words, but not none, is one window.  The
automaton of all windows reads a normalised document once; a window has a
space at both ends, so it matches whole words only.  Hits are mapped back to
places in the original text.

Windows are kept in a table in the shared folder in blocks of about
``BLOCK_BYTES``; a task holds the automaton of one block at a time and reads
its documents with each.  So neither the benchmark nor anything made of it
passes through the driver, whatever its size.

Null or empty texts have no words and are not hit.  Items with a null id count
for hits under the id ``null``; repeated items count once.  Rows that repeat a
document are reported once each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import column, gathered, keep_where, quoted
from footfall.llm.files import file_system
from footfall.session import workspace

WIDTH = 10
BLOCK_BYTES = 8 << 20
TEXT_BYTES = 16 << 20
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def normal(text: str) -> bytes:
    """The words of a text, one space between and around them."""
    words = text.encode("utf-8", "surrogatepass").translate(FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows_of(text: str, width: int) -> Iterator[bytes]:
    words = normal(text).split()
    for i in range(max(1, len(words) - width + 1) if words else 0):
        yield b" " + b" ".join(words[i : i + width]) + b" "


def write_windows(benchmark: DataFrame, width: int, id_col: str, text_col: str, block_bytes: int) -> tuple[str, int]:
    """A folder with one parquet folder ``block=k`` per block, and the number of blocks."""
    schema = pa.schema([("item", pa.string()), ("pattern", pa.binary())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                patterns = sorted(set(windows_of(text, width)))
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(patterns), pa.string()), patterns], schema=schema)

    rows = benchmark.select(
        F.coalesce(quoted(id_col).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(quoted(text_col), F.lit("")).alias("text"),
    ).mapInArrow(cut, "item string, pattern binary")
    patterns = rows.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))
    folder = workspace(benchmark.sparkSession, "benchmark-windows")
    patterns.write.parquet(f"{folder}/all")
    stored = benchmark.sparkSession.read.parquet(f"{folder}/all")
    size = stored.agg(F.sum(F.length("pattern"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    (
        stored.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(blocks)))
        .repartition(min(blocks, 1000), "block")
        .write.partitionBy("block")
        .parquet(f"{folder}/blocks")
    )
    return f"{folder}/blocks", blocks


class Block:
    """The automaton of one block."""

    def __init__(self, folder: str, number: int):
        import ahocorasick

        fs, path = file_system(f"{folder}/block={number}")
        self.automaton = ahocorasick.Automaton()
        self.items: list[list[str]] = []
        self.words: list[int] = []
        if fs.get_file_info(path).type.name == "Directory":
            got = pq.read_table(path, filesystem=fs, columns=["pattern", "items"], partitioning=None)
            for pattern, items in zip(got.column(0).to_pylist(), got.column(1).to_pylist()):
                self.automaton.add_word(pattern.decode("latin-1"), len(self.items))
                self.items.append(items)
                self.words.append(pattern.count(b" ") - 1)
        if self.items:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int]]:
        """(place of the last character, pattern) of all matches."""
        return list(self.automaton.iter(text)) if self.items else []


_HELD: dict[tuple[str, int], Block] = {}


def block(folder: str, number: int) -> Block:
    """The automaton asked for; only the last one stays in memory."""
    if (folder, number) not in _HELD:
        _HELD.clear()
        _HELD[folder, number] = Block(folder, number)
    return _HELD[folder, number]


def spans_of(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as character places [start, end) of the original text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate([[False], np.frombuffer(raw.tobytes().translate(FOLD), np.uint8) != 32, [False]])
    edges = np.flatnonzero(np.diff(inside.astype(np.int8)))
    char = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    begin, end = char[edges[::2]], char[edges[1::2]]
    runs = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"start": int(begin[a]), "end": int(end[b - 1])} for a, b in zip(runs[::2], runs[1::2])]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    keep_columns: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted as strings), spans in the original text.

    With ``keep_columns`` instead the columns of ``docs``, of documents that
    hold no window.
    """
    folder, blocks = write_windows(benchmark, width, item_col, item_text_col, block_bytes)
    found = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def scan(texts: list[str | None]):
        """Per text: words, hit mask or None, items."""
        folded = [normal(t or "").decode("latin-1") for t in texts]
        masks: list[np.ndarray | None] = [None] * len(texts)
        items: list[set[str]] = [set() for _ in texts]
        for k in range(blocks):
            held = block(folder, k)
            for i, text in enumerate(folded):
                matches = held.hits(text)
                if not matches:
                    continue
                breaks = np.cumsum(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
                last, pattern = np.array(matches, np.int64).T
                end = breaks[last] - 1  # words up to and with the last one of the match
                steps = np.zeros(breaks[-1], np.int64)
                np.add.at(steps, end - np.array(held.words)[pattern], 1)
                np.add.at(steps, end, -1)
                hit = np.cumsum(steps)[:-1] > 0
                masks[i] = hit if masks[i] is None else masks[i] | hit
                for p in np.unique(pattern).tolist():
                    items[i].update(held.items[p])
        return [max(t.count(" ") - 1, 0) for t in folded], masks, items

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            texts = column(t, "text").to_pylist()
            n, masks, items = scan(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    column(t, "doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array([0 if m is None else int(m.sum()) for m in masks], pa.int64()),
                    pa.array([sorted(i) for i in items], found.field("items").type),
                    pa.array([[] if m is None else spans_of(x, m) for x, m in zip(texts, masks)], found.field("spans").type),
                ],
                schema=found,
            )

    if keep_columns:
        return keep_where(docs, text_col, TEXT_BYTES, lambda texts: [m is None for m in scan(texts.to_pylist())[1]])
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    return rows.mapInArrow(
        report,
        "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>",
    )

