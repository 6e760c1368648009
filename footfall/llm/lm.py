"""Log-bilinear language model, trained by noise-contrastive estimation.

Tokens are the words of a text (A-Z lower-cased, cut at ASCII white space) and
an end.  The ``TOP`` most frequent tokens are classes
of their own; all other words share ``TAILS`` groups by their last two characters.
A group is one class for every ``SLAB`` of its words that have vectors, by falling
count, so the number of classes follows the corpus and the size of a class is
bounded.  The model predicts the class of a token from those of the two before it,

    score(class | a, b) = (C1 r_b + C2 r_a) . q_class + bias_class,

and a word inside its class from its own vector.  Every word of ``OWN`` training
tokens or more (of a hundredth of the root of all, in large corpora) has one as a
target and one as a context, so their number grows with the training counts.  Words of a class stand in buckets of ``WIDTH`` by
falling count; the bucket among those of the class and the word among those of
the bucket are log-bilinear in the vectors of the two tokens before.  All of it
is trained by noise-contrastive estimation, with noise that a minibatch shares:
noise classes by their counts, noise buckets and words by theirs.  Scores come
from matrix products and are normalised over classes, buckets and words.  The
class itself is told from the classes before, not from the words' vectors.
Rarer words have no vector; they share a place beside the buckets of their
group's last class by their add-one counts, with room for unseen ones, so a
token's probability is normalised over all words.

1. Tasks cut texts into chunks, number the words of a chunk and write the
   numbers to a file.  Only the distinct words of a chunk travel: a window over
   each word adds up its training counts and brings the sum back.  A word has
   one row per chunk, so its rows are as many as chunks, however common it is.
2. Chunks get classes and counts and are written anew, as 16-bit classes.
3. Training of classes goes over all training texts: tasks run minibatches over the
   context counts of their chunks, and the parameters of all tasks are averaged
   by Spark, ``EPOCHS`` times.  Only parameters reach the driver.
4. Vectors of words are a table in the shared folder, one file per class, of
   bounded size.  A task reads the contexts' vectors that its chunk needs, then
   goes through the file of one class after the other and hands on what it
   changed of it.  Changes are added up in two steps, by class and share of the
   chunks and then by class, so no task gets those of all chunks.
5. Scoring computes, for the distinct contexts of a chunk, a block of
   normalised log-probabilities of classes by one matrix product, and goes
   through the files of the classes for the words inside.

Null and empty texts consist of the end.  Without training texts counts are
zero, no word has a vector and the model is uniform over classes.  Repeated rows count once each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.common import column, gathered, quoted
from footfall.llm.files import new_file, opened
from footfall.llm.words import Words
from footfall.operators.skew import numbered
from footfall.session import materialize, workspace

TOP, TAILS = 256, 128
END = ""  # no word is empty
SIZE = 24
NOISE = 64
BATCH = 4096
EPOCHS = 1
STEP = 0.05
TRAIN_TASKS = 128
TEXT_BYTES = 32 << 20
CONTEXTS = 8192
OWN = 10  # training tokens of a word with a vector, at least
OWN_ROOT = 100  # and the root of all training tokens, divided by this
WIDTH = 64
SLAB = 4096  # words with vectors in a class
OWN_NOISE = 16
OWN_BATCH = 1024
DAMPING = 8.0

CODES = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("codes", pa.list_(pa.int32()))])
TOKENS = pa.schema([
    ("doc_id", pa.int64()), ("train", pa.bool_()), ("n_known", pa.int64()), ("base", pa.float64()),
    ("inside", pa.float64()), ("classes", pa.list_(pa.uint16())), ("ranks", pa.list_(pa.int32())),
])
# Of one class: a row of SIZE + 1 for each bucket, for all rarer words and for each word; a row of SIZE for each word.
OWNED = pa.schema([("out", pa.list_(pa.float32())), ("ctx", pa.list_(pa.float32()))])


def _save(uri: str, schema: pa.Schema, columns: list[pa.Array]) -> None:
    with new_file(uri) as out:
        with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))


def _load(uri: str) -> pa.RecordBatch:
    with opened(uri) as source:
        return pa.ipc.open_stream(source).read_next_batch()


def _ragged(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


def _cut(docs: DataFrame, train: Column, folder: str, id_col: str, text_col: str) -> DataFrame:
    """Write the chunk files; per chunk and distinct word: chunk, idx, word, n (training count)."""
    kind = "chunk long, idx int, word string, n long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, t in enumerate(gathered(batches, TEXT_BYTES)):
            chunk = (task << 20) + k
            words = Words(column(t, "text"))
            n = np.diff(words.at)
            # the end of every text is one more word
            at = words.at + np.arange(len(words.at))
            codes = np.full(at[-1], len(words.words), np.int64)
            inner = np.ones(len(codes), bool)
            inner[at[1:] - 1] = False
            codes[inner] = words.code
            train = column(t, "train").to_numpy(zero_copy_only=False).astype(bool)
            counts = np.bincount(codes[np.repeat(train, n + 1)], minlength=len(words.words) + 1)
            _save(f"{folder}/codes-{chunk}", CODES, [column(t, "doc_id"), pa.array(train), _ragged(codes, at, pa.int32())])
            idx = np.append(np.flatnonzero(words.real), len(words.words))
            text = pa.concat_arrays([words.words.cast(pa.string()), pa.array([END])]).take(pa.array(idx))
            table = pa.Table.from_arrays(
                [pa.array(np.full(len(idx), chunk)), pa.array(idx, pa.int32()), text, pa.array(counts[idx])],
                ["chunk", "idx", "word", "n"],
            )
            yield from table.to_batches(max_chunksize=65536)

    rows = docs.select(
        quoted(id_col).cast("long").alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"), train.alias("train")
    )
    return rows.mapInArrow(run, kind)


def tail_of(word: Column) -> Column:
    return (F.crc32(F.substring(word, -2, 2).cast("binary")) % TAILS).cast("int")


class Model:
    """The parameters of the classes; class ``start`` stands before the first token and is never predicted."""

    NAMES = ("r", "q", "bias", "c1", "c2")

    def __init__(self, counts: np.ndarray):
        rng = np.random.default_rng(7)
        n = self.start = len(counts)
        self.noise = (counts + 1.0) / (counts + 1.0).sum()
        self.r = rng.normal(0, 0.1, (n + 1, SIZE)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (n, SIZE)).astype(np.float32)
        self.bias = np.log(self.noise).astype(np.float32)
        self.c1 = np.eye(SIZE, dtype=np.float32)
        self.c2 = 0.5 * np.eye(SIZE, dtype=np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def take(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def context(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.r[b] @ self.c1 + self.r[a] @ self.c2

    def log10(self, a: np.ndarray, b: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 P(class of the token | the two before it), normalised over all classes."""
        context, of = _numbered(a.astype(np.int64) * (self.start + 1) + b, (self.start + 1) ** 2)
        order = _order(of)
        ends = np.searchsorted(of[order], np.arange(0, len(context) + CONTEXTS, CONTEXTS))
        out = np.empty(len(target))
        for k, (x, y) in enumerate(zip(ends[:-1], ends[1:])):
            own = context[k * CONTEXTS : (k + 1) * CONTEXTS]
            # a column per context: reductions over rows are the fast ones
            score = self.q @ self.context(own // (self.start + 1), own % (self.start + 1)).T + self.bias[:, None]
            top = score.max(axis=0)
            norm = np.log(np.exp(score - top).sum(axis=0, dtype=np.float64)) + top
            rows = order[x:y]
            local = of[rows] - k * CONTEXTS
            out[rows] = (score[target[rows], local] - norm[local]) / np.log(10.0)
        return out

    def train(self, a: np.ndarray, b: np.ndarray, target: np.ndarray, weight: np.ndarray, rng, state: dict) -> None:
        """One pass over context counts; noise words are shared within a minibatch."""
        order = rng.permutation(len(target))
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            x, y, z = a[rows], b[rows], target[rows]
            w = (weight[rows] / weight[rows].sum()).astype(np.float32)
            noise = rng.choice(self.start, NOISE, p=self.noise)
            rx, ry = self.r[x], self.r[y]
            h = ry @ self.c1 + rx @ self.c2
            true = (h * self.q[z]).sum(axis=1) + self.bias[z] - log_noise[z]
            false = h @ self.q[noise].T + self.bias[noise] - log_noise[noise]
            gt = w / (1.0 + np.exp(np.clip(true, -30, 30)))
            gf = -w[:, None] / (1.0 + np.exp(np.clip(-false, -30, 30)))
            dh = gt[:, None] * self.q[z] + gf @ self.q[noise]
            dq = _summed(z, gt[:, None] * h, self.start) + _summed(noise, gf.T @ h, self.start)
            db = np.bincount(z, gt, self.start) + np.bincount(noise, gf.sum(axis=0), self.start)
            dr = _summed(y, dh @ self.c1.T, self.start + 1) + _summed(x, dh @ self.c2.T, self.start + 1)
            for name, grad in (("r", dr), ("q", dq), ("bias", db), ("c1", ry.T @ dh), ("c2", rx.T @ dh)):
                seen = state.setdefault(name, np.full(grad.shape, 1e-8))
                seen += grad * grad
                getattr(self, name)[...] += (STEP * grad / np.sqrt(seen)).astype(np.float32)


def _summed(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, rows[:, j], n) for j in range(rows.shape[1])], axis=1)


def _order(index: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 on, by 16 bits at a time."""
    order = np.argsort((index & 0xFFFF).astype(np.uint16), kind="stable")
    most, shift = int(index.max(initial=0)), 16
    while most >> shift:
        order = order[np.argsort((index[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
        shift += 16
    return order


def _numbered(key: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the place of each key among them; keys are below ``bound``."""
    if bound > 8 * len(key):  # a table of all keys would be larger than what it numbers
        return np.unique(key, return_inverse=True)
    there = np.zeros(bound, bool)
    there[key] = True
    return np.flatnonzero(there), (np.cumsum(there, dtype=np.int32) - 1)[key]


def _contexts(classes: np.ndarray, at: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes two places and one place before every token."""
    before = np.concatenate([[start], classes[:-1]]).astype(np.int64)
    two = np.concatenate([[start, start], classes[:-2]])[: len(classes)].astype(np.int64)
    first = at[:-1]
    before[first] = start
    two[first] = start
    second = first + 1
    two[second[second < at[1:]]] = start
    return two, before


def _save_own(uri: str, out: np.ndarray, ctx: np.ndarray) -> None:
    _save(uri, OWNED, [_ragged(x.astype(np.float32).ravel(), np.array([0, x.size]), pa.float32()) for x in (out, ctx)])


def _load_own(uri: str) -> tuple[np.ndarray, np.ndarray]:
    t = _load(uri)
    out, ctx = (t.column(name).values.to_numpy() for name in ("out", "ctx"))
    return out.reshape(-1, SIZE + 1).copy(), ctx.reshape(-1, SIZE).copy()


def own_start(counts: np.ndarray, rest: float) -> np.ndarray:
    """Rows of a class whose words have these falling counts: shares by count whatever the context."""
    first = np.arange(0, len(counts), WIDTH)
    buckets = np.append(np.add.reduceat(counts, first), rest)
    out = np.zeros((len(buckets) + len(counts), SIZE + 1))
    out[:, SIZE] = np.log(np.concatenate([buckets / buckets.sum(), counts / buckets[np.arange(len(counts)) // WIDTH]]))
    return out


def _softmax(h: np.ndarray, target: np.ndarray, w: np.ndarray) -> np.ndarray:
    """log P(target | h) under the rows ``w``."""
    logs = np.zeros(len(h))
    for a in range(0, len(h) if len(w) > 1 else 0, CONTEXTS):
        z = target[a : a + CONTEXTS]
        score = w @ h[a : a + CONTEXTS].T
        score -= score.max(axis=0)
        own = score[z, np.arange(len(z))]
        np.exp(score, out=score)
        logs[a : a + CONTEXTS] = own - np.log(score.sum(axis=0))
    return logs


def _contrasted(h: np.ndarray, target: np.ndarray, w: np.ndarray, share: np.ndarray, seen: np.ndarray, seed: int) -> np.ndarray:
    """Train the rows ``w`` against shared noise drawn by ``share``; the gradients of ``h``.

    ``seen`` adds up how hard vectors and biases were pulled either way; steps shrink with it.
    """
    back = np.zeros((len(h), SIZE), np.float32)
    if len(w) == 1:
        return back
    rng = np.random.default_rng([len(h), seed])
    log_noise = np.log(OWN_NOISE * share).astype(np.float32)
    drawn = np.cumsum(share)
    order = rng.permutation(len(h))
    # each row with how hard it pulls at a vector and at a bias
    rows = np.ones((len(h), SIZE + 3), np.float32)
    np.take(h, order, axis=0, out=rows[:, : SIZE + 1])
    rows[:, SIZE + 1] = np.einsum("ij,ij->i", rows[:, :SIZE], rows[:, :SIZE]) / SIZE
    target = target[order]
    turned = np.empty_like(back)
    with np.errstate(over="ignore"):
        for a in range(0, len(h), OWN_BATCH):
            x, z = rows[a : a + OWN_BATCH], target[a : a + OWN_BATCH]
            noise = np.minimum(np.searchsorted(drawn, rng.random(OWN_NOISE)), len(w) - 1)
            wz, wn = w[z], w[noise]
            up = 1 / (1 + np.exp(np.einsum("ij,ij->i", x[:, : SIZE + 1], wz) - log_noise[z]))
            down = 1 / (1 + np.exp(log_noise[noise][:, None] - wn @ x[:, : SIZE + 1].T))
            turned[a : a + OWN_BATCH] = up[:, None] * wz[:, :SIZE] - down.T @ wn[:, :SIZE]
            pull = np.zeros((len(w), len(z)), np.float32)
            pull[z, np.arange(len(z))] = up
            total, away = pull @ x, down @ x
            seen += total[:, SIZE + 1 :]
            np.add.at(seen, noise, away[:, SIZE + 1 :])
            np.subtract.at(total, noise, away)
            rate = 1 / (1 + DAMPING * seen)
            w[:, :SIZE] += total[:, :SIZE] * rate[:, :1]
            w[:, SIZE] += total[:, SIZE] * rate[:, 1]
    back[order] = turned
    return back


def in_class(
    h: np.ndarray, rank: np.ndarray, out: np.ndarray, words: int, seen: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray | None]:
    """log P(word | its class, h) for ascending ``rank`` (-1: rarer words).

    With ``seen``, the rows ``out`` learn instead, and the gradients of ``h`` come along.
    """
    buckets = -(-words // WIDTH)
    target = np.where(rank < 0, buckets, rank // WIDTH)
    learn = seen is not None
    shares = np.exp(out[:, SIZE].astype(np.float64)) if learn else None  # of the start, where biases are log shares
    top = slice(0, buckets + 1)

    def at(rows, target, own, seed):
        if learn:
            share = shares[own] / shares[own].sum()
            return _contrasted(h[rows], target, out[own], share, seen[own], seed)
        return _softmax(h[rows], target, out[own])

    every = slice(0, len(rank))
    total = at(every, target, top, 0)
    ends = np.searchsorted(rank, np.arange(0, words + WIDTH, WIDTH)[: buckets + 1])
    for k in np.flatnonzero(np.diff(ends)).tolist():
        rows = slice(int(ends[k]), int(ends[k + 1]))
        own = slice(buckets + 1 + k * WIDTH, buckets + 1 + min(words, (k + 1) * WIDTH))
        total[rows] += at(rows, rank[rows] - k * WIDTH, own, k + 1)
    return (np.zeros(len(rank)), total) if learn else (total, None)


def _grouped(index: np.ndarray, *rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct numbers, and the sums of their rows."""
    order = _order(index)
    index = index[order]
    at = np.flatnonzero(np.diff(index, prepend=-1))
    return index[at], *(np.add.reduceat(r[order], at, axis=0) for r in rows)


def _own_pass(folder: str, version: int, model: Model, owned: np.ndarray, t: pa.RecordBatch, learn: bool):
    """Log-probabilities of all tokens of a chunk inside their classes; or, learning, what changed of each class."""
    lists, ranks = t.column("classes"), t.column("ranks")
    at = np.asarray(lists.offsets).astype(np.int64)
    key = lists.values.to_numpy()[at[0] : at[-1]].astype(np.int64) * (SLAB + 1)
    at_ranks = np.asarray(ranks.offsets)
    key += ranks.values.to_numpy()[at_ranks[0] : at_ranks[-1]] + 1
    # Distinct words by class and rank, rank 0 for the rarer ones; contexts as their places, 0 before the first token.
    distinct, place = _numbered(key, model.start * (SLAB + 1))
    del key
    of, rank = distinct // (SLAB + 1), distinct % (SLAB + 1) - 1
    two, one = (x.astype(np.int32) for x in _contexts(place + 1, at - at[0], 0))
    vectors = np.concatenate([model.r[model.start :], model.r[of]])
    edges = np.searchsorted(of, np.arange(model.start + 1))
    kinds = [c for c in range(TOP, model.start) if owned[c] and edges[c] < edges[c + 1]]
    for c in kinds:
        own = np.arange(edges[c], edges[c + 1])
        own = own[rank[own] >= 0]
        if len(own):
            vectors[own + 1] = _load_own(f"{folder}/own-{version}-{c}")[1][rank[own]]
    first, second = vectors @ model.c1, vectors @ model.c2
    order = _order(place)
    bounds = np.searchsorted(place[order], edges)
    logs, changed = np.zeros(len(place)), {}
    slope, square = np.zeros(vectors.shape if learn else (0, SIZE), np.float32), np.zeros(len(vectors), np.float32)
    for c in kinds:
        rows = order[bounds[c] : bounds[c + 1]]
        a, b = two[rows], one[rows]
        h = np.ones((len(rows), SIZE + 1), np.float32)
        h[:, :SIZE] = first[b] + second[a]
        out = _load_own(f"{folder}/own-{version}-{c}")[0]
        seen = np.zeros((len(out), 2), np.float32) if learn else None
        old = out.copy() if learn else out
        logs[rows], back = in_class(h, rank[place[rows]], out, int(owned[c]), seen)
        if learn:
            force = np.einsum("ij,ij->i", back, back)
            for spots, turn in ((b, model.c1), (a, model.c2)):
                spot, total, squares = _grouped(spots, back, force)
                slope[spot] += total @ turn.T
                square[spot] += squares * (turn * turn).sum() / SIZE  # as if the gradients had all directions
            weight = seen.sum(axis=1)
            spot = np.flatnonzero(weight)
            changed[c] = [(0, spot, (out - old)[spot], weight[spot])]
    for c in kinds if learn else []:
        own = np.arange(edges[c], edges[c + 1])
        own = own[rank[own] >= 0]  # none, if the chunk holds only rarer words of the class
        weight = 1 + square[own + 1] / SIZE
        changed[c].append((1, rank[own], slope[own + 1] / weight[:, None], weight))
    return logs / np.log(10.0), changed


PARTS = "class long, part long, which long, spot binary, slope binary, weight binary"


def _packed(c: int, part: int, which: int, spot: np.ndarray, slope: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    raw = [spot.astype("<i4").tobytes(), slope.astype("<f2").tobytes(), weight.astype("<f4").tobytes()]
    numbers = [pa.array([c]), pa.array([part]), pa.array([which])]
    names = ["class", "part", "which", "spot", "slope", "weight"]
    return pa.RecordBatch.from_arrays([*numbers, *(pa.array([x], pa.binary()) for x in raw)], names)


def _added_up(words: int, batches: Iterable[pa.RecordBatch]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of targets and contexts of a class: the weighted sums of some parts, and their weights."""
    rows = -(-words // WIDTH) + 1 + words, words
    sums = [(np.zeros((rows[k], SIZE + 1 - k)), np.zeros(rows[k])) for k in range(2)]
    for r in batches:
        for which, spot, slope, weight in zip(*(r.column(n) for n in ("which", "spot", "slope", "weight"))):
            spot, weight = np.frombuffer(spot.as_buffer(), "<i4"), np.frombuffer(weight.as_buffer(), "<f4")
            total, weights = sums[which.as_py()]
            total[spot] += weight[:, None] * np.frombuffer(slope.as_buffer(), "<f2").reshape(len(spot), total.shape[1])
            weights[spot] += weight
    return sums


def _own_fitted(folder: str, chunks: DataFrame, model: Model, owned: np.ndarray, tasks: int) -> int:
    """Train the words' vectors from version 0 of the table; the version to use."""
    if not owned.any():
        return 0
    shares = max(1, int(tasks**0.5))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                t = _load(f"{folder}/tokens-{chunk}")
                t = t.filter(t.column("train"))
                if t.num_rows:
                    for c, parts in _own_pass(folder, 0, model, owned, t, True)[1].items():
                        for which, spot, slope, weight in parts:
                            if len(spot):
                                yield _packed(c, chunk % shares, which, spot, slope, weight)

    def some(key, t):
        c, part = (k.as_py() for k in key)
        sums = enumerate(_added_up(int(owned[c]), t.to_batches()))
        spots = [(which, np.flatnonzero(weight), total, weight) for which, (total, weight) in sums]
        return pa.Table.from_batches([
            _packed(c, part, which, spot, total[spot] / weight[spot, None], weight[spot])
            for which, spot, total, weight in spots
        ])

    def merge(key, t):
        c = key[0].as_py()
        out, ctx = _load_own(f"{folder}/own-0-{c}")
        (change, weight), (turn, square) = _added_up(int(owned[c]), t.to_batches())
        out, ctx = out + change / np.maximum(weight, 1e-12)[:, None], ctx + turn / (1 + DAMPING * square)[:, None]
        _save_own(f"{folder}/own-1-{c}", out, ctx)
        return pa.table({"class": [c]})

    parts = chunks.repartition(tasks).mapInArrow(run, PARTS)
    if shares > 1:
        parts = parts.groupBy("class", "part").applyInArrow(some, PARTS)
    merged = {r["class"] for r in parts.groupBy("class").applyInArrow(merge, "class long").collect()}
    for c in set(np.flatnonzero(owned).tolist()) - merged:
        raise ValueError(f"class {c} was not trained")
    return 1


def _fitted(spark, folder: str, chunks: DataFrame, counts: np.ndarray, tasks: int, epochs: int) -> Model:
    """Train on the chunk files that ``chunks`` names."""
    model = Model(counts)
    if not counts.sum():
        model.q[:] = 0
        return model
    for epoch in range(epochs):
        start = model.flat()

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, state, trained = Model(counts), {}, 0
            own.take(start)
            for chunk in sorted(c for batch in batches for c in batch.column(0).to_pylist()):
                rng = np.random.default_rng([chunk, epoch])
                t = _load(f"{folder}/tokens-{chunk}")
                t = t.filter(t.column("train"))
                if not t.num_rows:
                    continue
                lists = t.column("classes")
                at = np.asarray(lists.offsets).astype(np.int64)
                classes = lists.values.to_numpy()[at[0] : at[-1]].astype(np.int64)
                two, one = _contexts(classes, at - at[0], model.start)
                key = (two * (model.start + 1) + one) * model.start + classes
                key, weight = np.unique(key, return_counts=True)
                context = key // model.start
                own.train(context // (model.start + 1), context % (model.start + 1), key % model.start, weight, rng, state)
                trained += int(weight.sum())
            if trained:
                flat = own.flat()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(flat.astype(np.float64) * trained), pa.array(np.full(len(flat), trained))],
                    ["place", "value", "n"],
                )

        parts = chunks.repartition(tasks).mapInArrow(run, "place long, value double, n long")
        mean = parts.groupBy("place").agg((F.sum("value") / F.sum("n")).alias("value")).toPandas()
        flat = start.astype(np.float64)
        flat[mean["place"].to_numpy()] = mean["value"].to_numpy()
        model.take(flat)
    return model


def score_texts(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", epochs: int = EPOCHS
) -> DataFrame:
    """Per row: doc_id, train, n_tokens, n_known, train_tokens, base_score, score (log10 of the text)."""
    spark = docs.sparkSession
    folder = workspace(spark, "language-model")
    same = W.partitionBy("word")
    words = _cut(docs, F.coalesce(train, F.lit(False)), folder, id_col, text_col)
    words = words.withColumns({"c": F.sum("n").over(same), "first": F.min("chunk").over(same) == F.col("chunk")})
    words = materialize(words.drop("n"), "word-counts")
    # one row per word
    distinct = words.filter("first").select("word", "c")
    totals = distinct.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = totals["n"] or 0, totals["v"] or 0
    slots = float(n + v + 1)
    common = [(r["word"], r["c"]) for r in distinct.filter(F.col("word") != END).orderBy(F.desc("c"), "word").limit(TOP - 1).collect()]
    ends = distinct.filter(F.col("word") == END).first()
    tops = [(END, ends["c"] if ends else 0), *common]  # ``TOP`` words at most
    # of an Arrow table, as of rows it would go through Python workers each time it is read
    ranks = spark.createDataFrame(pa.table({"word": pa.array([w for w, _ in tops], pa.string()), "top": pa.array(range(len(tops)), pa.int32())}))
    named = words.join(F.broadcast(ranks), "word", "left").withColumn("tail", tail_of(F.col("word")))
    least = max(OWN, int(n**0.5 / OWN_ROOT))
    # words with vectors, numbered inside their group; then slabs of a group become classes
    own = named.filter(f"first AND top IS NULL AND c >= {least}").select("word", "tail", "c")
    own = materialize(numbered(own, [F.desc("c"), "word"], "place", ["tail"]), "own-words")
    own = own.select("word", "tail", (F.col("place") - 1).alias("place"), "c")
    slabs = np.ones(TAILS, np.int64)
    for r in own.groupBy("tail").agg(F.count(F.lit(1)).alias("n")).collect():
        slabs[r["tail"]] = -(-r["n"] // SLAB)
    bases = TOP + np.cumsum(slabs) - slabs
    classes = TOP + int(slabs.sum())
    base, last = (F.array(*[F.lit(int(x)) for x in v])[F.col("tail")] for v in (bases, bases + slabs - 1))
    classed = named.join(own.select("word", "place"), "word", "left").withColumns({
        "class": F.coalesce("top", base + F.floor(F.col("place") / SLAB).cast("int"), last),
        "rank": F.coalesce((F.col("place") % SLAB).cast("int"), F.lit(-1)),
    })
    tails = classed.filter("first AND top IS NULL").groupBy("class").agg(
        F.sum(F.when((F.col("c") > 0) & (F.col("c") < least), F.col("c") + 1)).alias("mass"), F.sum("c").alias("c"),
        F.count(F.when(F.col("c") >= least, 1)).alias("own"),
    ).collect()
    # Mass of each class's rarer words in slots; the last class of a group has one for unseen words.
    mass = np.zeros(classes)
    mass[bases + slabs - 1] = 1.0
    counts = np.zeros(classes)
    for i, (_, c) in enumerate(tops):
        counts[i] = c
    owned = np.zeros(classes, np.int64)  # words with vectors
    for r in tails:
        mass[r["class"]] += r["mass"] or 0
        counts[r["class"]], owned[r["class"]] = r["c"], r["own"]
    own = own.withColumns({"class": base + F.floor(F.col("place") / SLAB).cast("int"), "rank": F.col("place") % SLAB})

    def annotate(key, t):
        chunk = key[0].as_py()
        codes = _load(f"{folder}/codes-{chunk}")
        lists = codes.column("codes")
        at = np.asarray(lists.offsets).astype(np.int64)
        code = lists.values.to_numpy()[at[0] : at[-1]]
        at -= at[0]
        idx = column(t, "idx").to_numpy()
        count, kinds, rank = np.zeros(int(code.max()) + 1), *(np.zeros(int(code.max()) + 1, np.int64) for _ in range(2))
        count[idx], kinds[idx], rank[idx] = (column(t, name).to_numpy() for name in ("c", "class", "rank"))
        base = np.log10((count + 1.0) / slots)
        # A rarer word's share of those of its class; others are what the model says.
        rare = (kinds >= TOP) & (rank < 0)
        inside = np.where(rare, np.log10((count + 1.0) / np.where(rare, mass[kinds], 1.0)), 0.0)
        begin = at[:-1]
        _save(
            f"{folder}/tokens-{chunk}",
            TOKENS,
            [
                codes.column("doc_id"),
                codes.column("train"),
                pa.array(np.add.reduceat((count > 0)[code].astype(np.int64), begin)),
                pa.array(np.add.reduceat(base[code], begin)),
                pa.array(np.add.reduceat(inside[code], begin)),
                _ragged(kinds[code].astype(np.uint16), at, pa.uint16()),
                _ragged(rank[code].astype(np.int32), at, pa.int32()),
            ],
        )
        return pa.table({"chunk": [chunk]})

    chunks = classed.select("chunk", "idx", "c", "class", "rank").groupBy("chunk").applyInArrow(annotate, "chunk long")
    chunks = materialize(chunks, "chunks")
    files = chunks.count()
    model = _fitted(spark, folder, chunks, counts, max(1, min(files, TRAIN_TASKS)), epochs)

    def begin(key, t):
        c = key[0].as_py()
        count = column(t, "c").to_numpy()[np.argsort(column(t, "rank").to_numpy())].astype(np.float64)
        # Words of a class must differ from the first, or they would all learn the same.
        context = model.r[c] + np.random.default_rng([7, c]).normal(0, 0.3, (len(count), SIZE))
        _save_own(f"{folder}/own-0-{c}", own_start(count, max(mass[c], 1e-3)), context)
        return pa.table({"class": [c]})

    own.groupBy("class").applyInArrow(begin, "class long").count()
    version = _own_fitted(folder, chunks, model, owned, max(1, files))

    out = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                t = _load(f"{folder}/tokens-{chunk}")
                lists = t.column("classes")
                at = np.asarray(lists.offsets).astype(np.int64)
                classes = lists.values.to_numpy()[at[0] : at[-1]].astype(np.int64)
                at -= at[0]
                two, one = _contexts(classes, at, model.start)
                each = model.log10(two, one, classes)
                each += _own_pass(folder, version, model, owned, t, False)[0]
                total = np.add.reduceat(each, at[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        t.column("doc_id"), t.column("train"), pa.array(np.diff(at)), t.column("n_known"),
                        pa.array(np.full(t.num_rows, n)), t.column("base"),
                        pa.array(total + t.column("inside").to_numpy()),
                    ],
                    ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return chunks.repartition(max(1, files)).mapInArrow(score, out)
