"""Hard negatives by an inverted multi-index with certified windows.

Vectors hold whole numbers and a score is their inner product.  For an anchor
the first ``positives`` other rows of its label come by falling score, ties by
smaller id; for each of them the first ``negatives`` rows of other labels whose
score lies between ``low`` and ``high`` percent of the positive's.

The index: vectors are cut into two halves with a codebook each, fitted on at
most ``SAMPLE`` rows; every row belongs to the cell of its two code words, and
cells lie one after the other in files of the shared folder.  An anchor's score
with a row is at most

    q1 . c1 + |q1| R1 + q2 . c2 + |q2| R2,

R being how far rows of a code word stray from it.  A heap over the two sorted
lists of half bounds yields cells by falling bound; the search of a window ends
when the next cell's bound is below the last score it would take.  Cells whose
lower bound lies above every window are passed over.  So the answer is that of
a search of all rows, however many cells that takes.

Tasks hold a block of anchors near each other and one cell of the index at a
time; scores are matrix products of whole numbers that the number type holds
exactly.  Of equal vectors with one label only as many as a result can show, by
id, enter the index; they are told apart by their bytes, after aggregation on
the map side.  The driver sees the sample, the codebooks and one line for each
cell and file.

Rows with a null id, label or vector, a null component or one of 2^26 or more
take no part.  A shorter vector counts as filled up with zeros.  Rows that
repeat an id are rows of their own: a repeated anchor is an anchor twice, and
each is a positive of the other.  Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.llm.common import column, gathered, quoted
from footfall.llm.files import new_file, opened
from footfall.session import materialize, workspace

SAMPLE = 20_000
CELL_ROWS = 512  # wanted on average
MAX_CODES = 256  # of a half, so cells are 65,536 at most
ROUNDS = 8  # of k-means
COMPONENT_LIMIT = 1 << 26
BLOCK = 1024  # anchors searched together
TASK_ANCHORS = 4096
PART_BYTES = 32 << 20
READ_ROWS = 8192  # of a cell at a time
CACHE_BYTES = 192 << 20
FIRST_STEP, LAST_STEP = 1024, 65_536  # rows an anchor asks for in a turn


@dataclass(frozen=True)
class Wanted:
    positives: int = 5
    negatives: int = 10
    low: int = 30  # percent of the positive's score
    high: int = 90


@dataclass(frozen=True)
class Codebooks:
    """Code words of the halves; the first half has ``cut`` components."""

    cut: int
    first: np.ndarray
    second: np.ndarray

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell of each row, and how far its halves are from their code words."""
        i, r1 = _nearest(x[:, : self.cut], self.first)
        j, r2 = _nearest(x[:, self.cut :], self.second)
        return i * len(self.second) + j, r1, r2


def _nearest(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = ((words * words).sum(axis=1) - 2 * (x @ words.T)).argmin(axis=1)
    return code, np.sqrt(((x - words[code]) ** 2).sum(axis=1))


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` code words of the distinct rows of ``x``."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(7)
    words = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(ROUNDS):
        code, _ = _nearest(x, words)
        n = np.bincount(code, minlength=len(words))
        sums = np.stack([np.bincount(code, x[:, c], len(words)) for c in range(x.shape[1])], axis=1) if x.shape[1] else words
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs (i, j) by falling first[i] + second[j]: a heap over the two sorted sequences."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y, a, b = first[a].tolist(), second[b].tolist(), a.tolist(), b.tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, a[i], b[j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


def _numbers(vectors: pa.Array, width: int, item: str) -> np.ndarray:
    """Rows of packed whole numbers as a matrix."""
    raw = b"".join(v.as_buffer() for v in vectors)
    return np.frombuffer(raw, item).reshape(len(vectors), width)


class Index:
    """Reads cells from the index files, the last ones from memory."""

    def __init__(self, folder: str, directory: dict[int, list], width: int, item: str, kind: str):
        self.folder, self.directory, self.width, self.item, self.kind = folder, directory, width, item, kind
        self.held: OrderedDict = OrderedDict()
        self.bytes = 0
        self.files: dict[int, pa.NativeFile] = {}

    def parts(self, cell: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """ids, times, labels and vectors of a cell, in parts."""
        for part, at, n in self.directory.get(cell, ()):
            for start in range(0, n, READ_ROWS):
                yield self._read(part, at, n, start, min(READ_ROWS, n - start))

    def _read(self, part: int, at: int, n: int, start: int, rows: int):
        key = part, at, start
        if key in self.held:
            self.held.move_to_end(key)
            return self.held[key]
        if part not in self.files:
            self.files[part] = opened(f"{self.folder}/part-{part}")
        out = []
        for item, width in (("<i8", 1), ("<i4", 1), ("<i8", 1), (self.item, self.width)):
            size = np.dtype(item).itemsize * width
            out.append(np.frombuffer(self.files[part].read_at(rows * size, at + start * size), item))
            at += n * size
        out[3] = out[3].reshape(rows, self.width).astype(self.kind)
        self.held[key] = tuple(out)
        self.bytes += out[3].nbytes
        while self.bytes > CACHE_BYTES and len(self.held) > 1:
            self.bytes -= self.held.popitem(last=False)[1][3].nbytes
        return tuple(out)


class Search:
    """One block of distinct anchors: all of them visit cells in turns."""

    def __init__(self, books: Codebooks, radii: tuple[np.ndarray, np.ndarray], index: Index, q: np.ndarray):
        self.books, self.index, self.q = books, index, q.astype(index.kind)
        x = q.astype(np.float64)
        self.up, self.down = [], []
        for half, words, radius in ((x[:, : books.cut], books.first, radii[0]), (x[:, books.cut :], books.second, radii[1])):
            middle = half @ words.T
            reach = np.sqrt((half * half).sum(axis=1))[:, None] * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-3  # rounding errors stay far below
            self.up.append(middle + reach + slack)
            self.down.append(middle - reach - slack)

    def visit(self, least: np.ndarray, most: np.ndarray, take) -> None:
        """Show every anchor the cells that may hold scores from ``least`` to ``most``, by falling bound.

        ``take(anchors, scores, part)`` gets a matrix of scores; ``least`` may
        rise between turns.
        """
        n = len(self.q)
        heaps = [by_bound(self.up[0][a], self.up[1][a]) for a in range(n)]
        codes, step, active = len(self.books.second), FIRST_STEP, list(range(n))
        sizes = {cell: sum(x[2] for x in parts) for cell, parts in self.index.directory.items()}
        while active:
            asked: dict[int, list[int]] = {}
            still = []
            for a in active:
                rows = 0
                for bound, i, j in heaps[a]:
                    if bound < least[a]:
                        break
                    cell = i * codes + j
                    if cell in sizes and self.down[0][a, i] + self.down[1][a, j] <= most[a]:
                        asked.setdefault(cell, []).append(a)
                        rows += sizes[cell]
                        if rows >= step:
                            still.append(a)
                            break
            for cell in sorted(asked):
                anchors = np.array(asked[cell])
                for part in self.index.parts(cell):
                    take(anchors, (self.q[anchors] @ part[3].T), part)
            take(None, None, None)  # the turn ends
            active, step = still, min(2 * step, LAST_STEP)


class Best:
    """The first ``k`` found of every slot: by falling score, then id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.least = np.full(slots, -np.inf)  # score of the k-th
        self.found = [np.zeros(0, np.int64)] * 4  # slot, score, id, times
        self.fresh: list[tuple] = []

    def add(self, slot, score, ids, times) -> None:
        self.fresh.append((slot, score, ids, times))

    def settle(self) -> None:
        if not self.fresh:
            return
        slot, score, ids, times = (np.concatenate(x) for x in zip(self.found, *self.fresh))
        order = np.lexsort((ids, -score, slot))
        first = np.searchsorted(slot[order], slot[order])
        order = order[np.arange(len(order)) - first < self.k]
        self.found = [x[order] for x in (slot, score, ids, times)]
        self.fresh = []
        n = np.bincount(self.found[0], minlength=len(self.least))
        full = n >= self.k
        ends = np.cumsum(n) - 1
        self.least[full] = self.found[1][ends[full]]

    def rows(self) -> list[list[tuple[int, int]]]:
        """(score, id) of each slot, copies as often as they are there."""
        out: list[list[tuple[int, int]]] = [[] for _ in self.least]
        for s, score, i, times in zip(*(x.tolist() for x in self.found)):
            out[s].extend([(score, i)] * min(times, self.k))
        return [x[: self.k] for x in out]


def _searched(search: Search, labels: np.ndarray, wanted: Wanted) -> tuple[list, list[dict]]:
    """Of each anchor: its first rows of the same label (one more than wanted), and negatives by positive score."""
    n = len(labels)
    same = Best(n, wanted.positives + 1)

    def near(anchors, scores, part):
        if anchors is None:
            return same.settle()
        a, row = np.nonzero((part[2][None, :] == labels[anchors][:, None]) & (scores >= same.least[anchors][:, None]))
        same.add(anchors[a], scores[a, row].astype(np.int64), part[0][row], part[1][row])

    search.visit(same.least, np.full(n, np.inf), near)
    positives = same.rows()

    # One slot per anchor and score of a positive; whole numbers, so bounds are exact.
    slots = sorted({(a, p) for a, rows in enumerate(positives) for p, _ in rows if p >= 0})
    of = np.array([a for a, _ in slots], np.int64)
    score = np.array([p for _, p in slots], np.int64)
    low, high = -((-wanted.low * score) // 100), wanted.high * score // 100
    best = Best(len(slots), wanted.negatives)
    least, most = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(least, of, low)
    np.maximum.at(most, of, high)
    begin = np.searchsorted(of, np.arange(n + 1))
    widest = int(np.diff(begin).max(initial=0))

    def apart(anchors, scores, part):
        if anchors is None:
            best.settle()
            low_now = np.maximum(low, best.least)
            least[:] = np.inf
            np.minimum.at(least, of, low_now)
            return
        other = part[2][None, :] != labels[anchors][:, None]
        for k in range(widest):
            own = np.flatnonzero(begin[anchors] + k < begin[anchors + 1])
            slot = begin[anchors[own]] + k
            s = scores[own]
            least_now = np.maximum(low[slot], best.least[slot])[:, None]
            a, row = np.nonzero(other[own] & (s >= least_now) & (s <= high[slot][:, None]))
            best.add(slot[a], s[a, row].astype(np.int64), part[0][row], part[1][row])

    if slots:
        search.visit(least, most, apart)
    negatives: list[dict] = [{} for _ in range(n)]
    for (a, p), rows in zip(slots, best.rows()):
        negatives[a][p] = rows
    return positives, negatives


RESULT = pa.schema([
    ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
    ("positive_score", pa.int64()), ("negative_score", pa.int64()),
])


def _answered(ids: np.ndarray, labels: np.ndarray, q: np.ndarray, wanted: Wanted, search_of) -> pa.RecordBatch:
    """All rows of a block of anchors; equal anchors are searched once."""
    key = np.concatenate([labels[:, None].astype(np.int64), q.astype(np.int64)], axis=1)
    _, one, which = np.unique(key, axis=0, return_index=True, return_inverse=True)
    positives, negatives = _searched(search_of(q[one]), labels[one], wanted)
    own_score = (q.astype(object) * q.astype(object)).sum(axis=1) if q.shape[1] else np.zeros(len(q), np.int64)
    out: list[tuple] = []
    for anchor, u, own in zip(ids.tolist(), which.ravel().tolist(), own_score.tolist()):
        rows = list(positives[u])
        if (own, anchor) in rows:
            rows.remove((own, anchor))  # the anchor itself, or an equal row in its place
        for p, positive in rows[: wanted.positives]:
            for k, (s, negative) in enumerate(negatives[u].get(p, ())):
                out.append((anchor, positive, k + 1, negative, p, s))
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out) if out else [()] * 6, RESULT)], schema=RESULT)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    wanted: Wanted = Wanted(),
    id_col: str = "vec_id",
    vector_col: str = "vector",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vector_col`` is an array of whole numbers; ``anchors`` tells which rows
    are searched for.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    fits = lambda x: F.coalesce((x < COMPONENT_LIMIT) & (x > -COMPONENT_LIMIT), F.lit(False))
    taken = rows.select(
        quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("long").alias("label"),
        quoted(vector_col).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", fits))
    largest = F.aggregate("vector", F.lit(0).cast("long"), lambda m, x: F.greatest(m, F.abs(x).cast("long")))
    facts = taken.agg(F.max(F.size("vector")), F.max(largest), F.count(F.lit(1)), F.count(F.when(F.col("anchor"), 1))).first()
    width, top, total, n_anchors = (x or 0 for x in facts)
    if not n_anchors:
        return empty
    item = "<i2" if top < 1 << 15 else "<i4"
    exact = next((k for k, bits in (("float32", 24), ("float64", 53)) if width * top * top < 1 << bits), "object")

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            at = np.asarray(lists.offsets).astype(np.int64)
            flat = lists.values.slice(at[0], at[-1] - at[0]).to_numpy(zero_copy_only=False)
            n = np.diff(at)
            full = np.zeros((len(n), width), item)
            full[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], n)] = flat
            data = pa.array([r.tobytes() for r in full], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data, batch.column(3)], ["id", "label", "vector", "anchor"])

    ready = materialize(taken.mapInArrow(packed, "id long, label long, vector binary, anchor boolean"), "vectors")

    # of equal vectors of one label, the ids that a result may show
    shown = max(wanted.positives + 1, wanted.negatives)
    each = ready.groupBy("label", "vector", "id").agg(F.least(F.count(F.lit(1)), F.lit(shown)).cast("int").alias("times"))
    place = F.row_number().over(W.partitionBy("label", "vector").orderBy("id"))
    few = each.withColumn("place", place).where(F.col("place") <= shown).drop("place")

    mixed = F.xxhash64("vector", "id")
    sample = ready.select("vector", mixed.alias("h")).orderBy("h", "vector").limit(SAMPLE).toPandas()["vector"]
    x = _numbers(pa.array(sample.tolist(), pa.binary()), width, item).astype(np.float64)
    codes = int(min(MAX_CODES, max(1, round((total / CELL_ROWS) ** 0.5))))
    books = Codebooks(width // 2, k_means(x[:, : width // 2], codes), k_means(x[:, width // 2 :], codes))

    def celled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, PART_BYTES):
            cell, r1, r2 = books.cells(_numbers(column(t, "vector"), width, item).astype(np.float64))
            for name, value in (("cell", cell.astype(np.int32)), ("r1", r1), ("r2", r2)):
                t = t.append_column(name, pa.array(value))
            yield from t.to_batches()

    folder = workspace(spark, "multi-index")
    placed = few.select("id", "times", "label", "vector").mapInArrow(
        celled, "id long, times int, label long, vector binary, cell int, r1 double, r2 double"
    )

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of a sorted partition into one file; one line for each cell and part of it in memory."""
        part, at, lines = TaskContext.get().partitionId(), 0, []
        tables = gathered(batches, PART_BYTES)
        first = next(tables, None)
        if first is None:
            return
        with new_file(f"{folder}/part-{part}") as out:
            for t in chain([first], tables):
                cell = column(t, "cell").to_numpy()
                edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    rows = t.slice(a, b - a)
                    fields = (("id", "<i8"), ("times", "<i4"), ("label", "<i8"))
                    data = [column(rows, name).to_numpy().astype(kind).tobytes() for name, kind in fields]
                    data.append(b"".join(v.as_buffer() for v in column(rows, "vector")))
                    far = [float(column(rows, r).to_numpy().max()) for r in ("r1", "r2")]
                    lines.append((int(cell[a]), part, at, b - a, *far))
                    for d in data:
                        out.write(d)
                        at += len(d)
        names = ["cell", "part", "at", "n", "r1", "r2"]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*lines)], names)

    order = ["cell", F.xxhash64("vector", "id"), "id"]
    files = placed.repartitionByRange(*order).sortWithinPartitions(*order, "label", "vector")
    lines = files.mapInArrow(written, "cell long, part long, at long, n long, r1 double, r2 double")
    directory: dict[int, list] = {}
    radii = np.zeros(len(books.first)), np.zeros(len(books.second))
    for r in materialize(lines, "directory").orderBy("cell", "part", "at").collect():
        directory.setdefault(r["cell"], []).append((r["part"], r["at"], r["n"]))
        for radius, code, far in zip(radii, divmod(r["cell"], len(books.second)), (r["r1"], r["r2"])):
            radius[code] = max(radius[code], far)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, directory, width, item, exact)
        for t in gathered(batches, BLOCK * (width * np.dtype(item).itemsize + 24)):
            q = _numbers(column(t, "vector"), width, item)
            ids, labels = (column(t, name).to_numpy() for name in ("id", "label"))
            yield _answered(ids, labels, q, wanted, lambda distinct: Search(books, radii, index, distinct))

    asked = ready.where("anchor").select("id", F.lit(1).alias("times"), "label", "vector")
    asked = asked.mapInArrow(celled, "id long, times int, label long, vector binary, cell int, r1 double, r2 double")
    spread = spark.sparkContext.defaultParallelism
    tasks = max(min(-(-n_anchors // 64), 2 * spread), -(-n_anchors // TASK_ANCHORS))
    near = asked.repartitionByRange(tasks, "cell", "vector", "id").sortWithinPartitions("cell", "vector", "label", "id")
    return near.select("id", "label", "vector").mapInArrow(search, empty.schema)
