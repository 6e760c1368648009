"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A document's set is its distinct shingles of ``SHINGLE`` words.  Its signature
is ``chunks * parts`` MinHash values of 16 bits; the distance of two signatures
is the number of places where they differ.  Two signatures at a distance of at
most ``reach`` = 2 * chunks - 1 have, by the pigeonhole principle, a chunk with
at most one error.  So a document is filed under every chunk with every one of
its places left out, and every pair within reach meets under some key.  With 12
chunks of 5 places a pair of similarity 0.85 lies beyond reach with a
probability of about two in a million, less the more alike the two are.

At 0.8 the default filing has 16 chunks of 4 places and a like probability.

1. Documents of equal word sequence are one node: texts with words lower-cased and
   one space between them, told apart by a cryptographic digest of 256 bits.
2. All keys are sorted; a run of equal keys is streamed, so a key of any size
   is spread over tasks.  In each run a node is tried with the run's first
   node, if their sizes allow the similarity and the low bits of their
   signatures, which travel along, do not rule it out.
3. Tried pairs whose signatures are within reach are confirmed on their full
   shingle sets; links make components.
4. Keys that still hold several components are compared, in blocks of ``RUN``
   nodes, by signature; the nodes of a key's largest component meet only others.  What lies within reach forms groups; a task
   hands on the links of a spanning forest, not the pairs.
5. Inside a group nodes are compared likewise, and pairs within reach of
   different components are confirmed on their full sets, unless the task
   has linked their components already.  After that no link within reach is
   missing between components, and no copies were expanded into pairs.

Null or empty texts and those without words have no shingles and link with
nothing.  Rows with one id but different texts are documents of their own;
repeated rows get the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import column, fresh, gathered, quoted
from footfall.llm.components import components
from footfall.llm.exact import hash128
from footfall.llm.tokens import bytes_of
from footfall.llm.words import U, Words, mixed
from footfall.session import materialize

SHINGLE = 5
RUN = 256
BLOCK_CHARS = 8 << 20  # and so much text, whatever comes first
TEXT_BYTES = 8 << 20

def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1 << 62, 1 << 63, n, dtype=np.uint64) * U(2) + U(1)


FACTORS, OFFSETS, KEY_FACTORS = _odd(1, 256), _odd(2, SHINGLE), _odd(3, 16)


@dataclass(frozen=True)
class Filing:
    """How a signature is cut."""

    chunks: int = 12
    parts: int = 5

    @property
    def places(self) -> int:
        return self.chunks * self.parts

    @property
    def reach(self) -> int:
        return 2 * self.chunks - 1


def sequence_digests(texts: pa.Array) -> list[bytes]:
    """256 bits of each text's sequence of words: A-Z lower-cased, cut at ASCII white space."""
    raw, at = bytes_of(texts.fill_null("").cast(pa.large_string()))
    data, ends = raw.tobytes(), at.tolist()
    return [hashlib.blake2b(b" ".join(data[a:b].lower().split()), digest_size=32).digest() for a, b in zip(ends, ends[1:])]


def shingle_hashes(word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, and where each text's begin."""
    rolled = np.zeros(max(len(word) - SHINGLE + 1, 0), np.uint64)
    for j in range(SHINGLE):
        rolled += word[j : j + len(rolled)] * OFFSETS[j]
    rolled = mixed(rolled)
    parts, size = [], []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= SHINGLE:
            part = np.unique(rolled[a : b - SHINGLE + 1])
        elif b > a:  # the whole sequence is one
            part = mixed((word[a:b] * OFFSETS[: b - a]).sum(keepdims=True) + U(b - a))
        else:
            part = rolled[:0]
        parts.append(part)
        size.append(len(part))
    return np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


def signatures(shingles: np.ndarray, at: np.ndarray, places: int) -> np.ndarray:
    """Values of 16 bits, ``places`` per text; the texts must have shingles."""
    n = len(at) - 1
    out = np.empty((n, places), np.uint16)
    a = 0
    while a < n:  # about 64k shingles at a time stay in the cache
        b = max(int(np.searchsorted(at, at[a] + 65536, "right")) - 1, a + 1)
        x, starts = shingles[at[a] : at[b]], at[a:b] - at[a]
        for k in range(places):
            out[a:b, k] = mixed(np.minimum.reduceat(x * FACTORS[k], starts)) >> U(48)
        a = b
    return out


def keys_of(signature: np.ndarray, filing: Filing) -> np.ndarray:
    """(texts, places): a key per chunk and place left out; the low byte says which."""
    wide = signature.astype(np.uint64).reshape(-1, filing.chunks, filing.parts)
    out = np.empty(wide.shape, np.uint64)
    for gone in range(filing.parts):
        kept = [p for p in range(filing.parts) if p != gone]
        out[:, :, gone] = sum((wide[:, :, p] + U(1)) * KEY_FACTORS[p] for p in kept)
    out = out.reshape(-1, filing.places)
    slot = np.arange(filing.places, dtype=np.uint64)
    return (mixed(out + slot * U(0x9E3779B97F4A7C15)) & ~U(0xFF)) | slot


def low_bits(signature: np.ndarray) -> np.ndarray:
    """(texts, 2): the two lowest bits of up to 64 places; they differ in no more places than the signatures."""
    two = (signature & 3).astype(np.uint64)
    two = np.pad(two, ((0, 0), (0, 64 - two.shape[1]))).reshape(len(two), 2, 32)
    return (two << (U(2) * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)


def low_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return np.bitwise_count((x | (x >> U(1))) & U(0x5555555555555555)).sum(axis=1, dtype=np.int64)


def sketch(docs: DataFrame, id_col: str, text_col: str, filing: Filing) -> DataFrame:
    """Per row: doc_id, text_key, node_key (of the word sequence), n_shingles, signature."""
    kind = "doc_id long, text_key binary, node_key binary, n_shingles long, signature binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            words = Words(column(t, "text"))
            word = words.hashes()
            shingles, at = shingle_hashes(word, words.at)
            n = np.diff(at)
            some = np.flatnonzero(n)
            sig = np.zeros((len(n), filing.places), np.uint16)
            if len(some):
                sig[some] = signatures(shingles, np.concatenate([at[:-1][some], at[-1:]]), filing.places)
            yield pa.RecordBatch.from_arrays(
                [
                    column(t, "doc_id"),
                    column(t, "text_key").cast(pa.binary()),
                    pa.array(sequence_digests(column(t, "text")), pa.binary()),
                    pa.array(n),
                    pa.array([r.tobytes() for r in sig], pa.binary()),
                ],
                ["doc_id", "text_key", "node_key", "n_shingles", "signature"],
            )

    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), text.alias("text"), hash128(text).alias("text_key"))
    return rows.mapInArrow(run, kind)


def _file_keys(nodes: DataFrame, filing: Filing) -> DataFrame:
    """key, node, n (shingles), s, t (low bits): one row per node and key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, filing.places)
            low = low_bits(sig).view(np.int64)
            each = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), low[:, 0], low[:, 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys_of(sig, filing).reshape(-1).view(np.int64)),
                    *(pa.array(np.repeat(x, filing.places)) for x in each),
                ],
                ["key", "node", "n", "s", "t"],
            )

    return nodes.select("node", "n_shingles", "signature").mapInArrow(
        run, "key long, node long, n long, s long, t long"
    )


def _fits(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can reach the similarity."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _tried(filed: DataFrame, percent: int, reach: int) -> DataFrame:
    """From keys sorted within tasks: rows of keys that more nodes share (b null), and the pairs to try.

    A key that ends or begins a task's rows is kept in any case, since a
    neighbouring task may hold more of it.
    """
    kind = "key long, node long, n long, b long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        tail = (none,) * 5  # the first row of the run that may go on
        opening = True
        for t in gathered(batches, 4 << 20):
            key, node, n, *low = (
                np.concatenate([h, t.column(c).to_numpy()]) for h, c in zip(tail, ("key", "node", "n", "s", "t"))
            )
            bits = np.stack(low, axis=1).view(np.uint64)
            carried = len(tail[0])
            new = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            size = np.diff(np.concatenate([first, [len(key)]]))
            shared = (size > 1)[run_of]
            shared[key == key[-1]] = True  # may go on
            if opening:
                shared[key == key[0]] = True
                opening = False
            head = first[run_of]
            place = np.arange(len(key))
            fresh_row = place >= carried
            rows = shared & fresh_row
            # rows carried over were sent already, or wait for this batch
            out_key, out_node, out_n, out_b = [key[rows]], [node[rows]], [n[rows]], [np.full(int(rows.sum()), -1)]
            use = np.flatnonzero(fresh_row & (head < place) & (node != node[head]) & _fits(n, n[head], percent))
            use = use[low_distance(bits[use], bits[head[use]]) <= reach]
            pair = np.stack([node[use], node[head[use]]], axis=1)
            pairs = np.unique(np.sort(pair, axis=1), axis=0)
            out_key.append(np.zeros(len(pairs), np.int64))
            out_node.append(pairs[:, 0])
            out_n.append(np.zeros(len(pairs), np.int64))
            out_b.append(pairs[:, 1])
            b = np.concatenate(out_b)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(out_key)),
                    pa.array(np.concatenate(out_node)),
                    pa.array(np.concatenate(out_n)),
                    pa.array(b, mask=b < 0),
                ],
                ["key", "node", "n", "b"],
            )
            tail = tuple(x[first[-1] : first[-1] + 1] for x in (key, node, n, *low))

    return filed.mapInArrow(run, kind)


def _distance_within(pairs: DataFrame, nodes: DataFrame, filing: Filing) -> DataFrame:
    """The pairs (a, b) whose signatures are within reach."""
    side = nodes.select("node", "signature")
    both = pairs.join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, filing.places)
                    for c in (2, 3)
                )
                near = pa.array((x != y).sum(axis=1) <= filing.reach)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def shingle_set(text: str) -> set:
    words = text.translate(ASCII_LOWER).split(" ")
    words = [w for w in words if w]
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(SHINGLE))))


ASCII_LOWER = {c: c + 32 for c in range(65, 91)} | {c: " " for c in range(9, 14)}


class Forest:
    """Sets of numbers that grow together."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, i: int) -> int:
        while (up := self.root.get(i, i)) != i:
            self.root[i] = self.root.get(up, up)
            i = up
        return i

    def join(self, i: int, j: int) -> bool:
        """Whether the two were apart."""
        i, j = self.find(i), self.find(j)
        self.root[max(i, j)] = min(i, j)
        return i != j


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links among the pairs (a, b), by their full sets; pairs that a task has connected already are left out."""
    side_b = pairs.join(texts.toDF("b", "tb"), "b")
    both = side_b.join(texts.toDF("a", "ta"), "a").select("a", "b", "ta", "tb")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_set, forest = None, set(), Forest()  # rows come sorted by a
        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in (0, 1)), batch.column(2), batch.column(3)):
                if forest.find(a) == forest.find(b):
                    keep.append(False)
                    continue
                if a != held:
                    held, held_set = a, shingle_set(ta.as_py())
                other = shingle_set(tb.as_py())
                both = len(held_set & other)
                keep.append(100 * both >= percent * (len(held_set) + len(other) - both))
                if keep[-1]:
                    forest.join(a, b)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _sides(rows: DataFrame, by: str, weight: Column) -> DataFrame:
    """For every ``by`` with several labels: ``main``, its heaviest one, and how many
    blocks its rows (``main_blocks``) and those of all others (``rest_blocks``) fill.

    ``weight`` is a row's share of a block.
    """
    each = rows.groupBy(by, "label").agg(F.sum(weight).alias("weight"))
    whole = each.groupBy(by).agg(
        F.max(F.struct("weight", "label")).alias("most"), F.sum("weight").alias("all"), F.count(F.lit(1)).alias("labels")
    )
    blocks = lambda w: F.ceil(F.greatest(w, F.lit(0.01))).cast("int")
    return whole.where("labels > 1").select(
        by,
        F.col("most.label").alias("main"),
        blocks(F.col("most.weight")).alias("main_blocks"),
        blocks(F.col("all") - F.col("most.weight")).alias("rest_blocks"),
    )


def _meetings(rows: DataFrame, by: str) -> DataFrame:
    """Rows with their ``_sides``, dealt to blocks and sorted so that blocks that must meet stand together.

    Rows of the main label have blocks of their own, which meet all other
    blocks but not each other: what is one component needs no comparing, so a
    group of n rows, all but a few of one component, makes some n rows here and
    not n * n.  The columns ``i``, ``j`` name the two blocks and ``block`` the
    row's own.
    """
    first = F.col("main_blocks")  # blocks of other labels have the numbers from here
    own = F.col("label") == F.col("main")
    spot = F.xxhash64("node")
    block = F.when(own, F.pmod(spot, first)).otherwise(first + F.pmod(spot, F.col("rest_blocks"))).cast("int")
    others = F.sequence(F.when(own, first).otherwise(F.lit(0)), first + F.col("rest_blocks") - 1)
    rows = rows.withColumn("block", block).withColumn("other", F.explode(others))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    rows = rows.drop("other", "main", "main_blocks", "rest_blocks")
    # a number of its own: work goes by rows compared, not by bytes, which adaptive execution would go by
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, by, "i", "j").sortWithinPartitions(by, "i", "j")


def _runs(batches: Iterable[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """The rows of one meeting after the other."""
    held: list[pa.Table] = []
    name = None
    for t in gathered(batches, 4 << 20):
        parts = [t.column(c).to_numpy() for c in (by, "i", "j")]
        new = np.zeros(t.num_rows, bool)
        for p in parts:
            new[1:] |= p[1:] != p[:-1]
        edges = [0, *np.flatnonzero(new).tolist(), t.num_rows]
        for x, y in zip(edges[:-1], edges[1:]):
            here = tuple(int(p[x]) for p in parts)
            if held and here != name:
                yield pa.concat_tables(held)
                held = []
            name = here
            held.append(t.slice(x, y - x))
    if held:
        yield pa.concat_tables(held)


def _near_rows(t: pa.Table, filing: Filing, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row by row, the later rows of other components within reach, and where the signatures agree."""
    n, label, block = (t.column(c).to_numpy() for c in ("n", "label", "block"))
    crossing = t.column("i")[0].as_py() != t.column("j")[0].as_py()
    sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint16).reshape(-1, filing.places)
    for x in range(t.num_rows - 1):
        ok = (label[x + 1 :] != label[x]) & _fits(n[x + 1 :], n[x], percent)
        if crossing:  # two blocks meet; each meets itself elsewhere
            ok &= block[x + 1 :] != block[x]
        y = np.flatnonzero(ok) + x + 1
        if len(y):
            same = sig[y] == sig[x]
            near = same.sum(axis=1) >= filing.places - filing.reach
            if near.any():
                yield x, y[near], same[near]


def _grouped(shared: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, filing: Filing) -> DataFrame:
    """Links (a, b) that hold together the nodes within reach of each other that share a key but no component."""
    label = F.coalesce("label", "node").alias("label")
    rows = shared.join(labels, "node", "left").select("key", "node", "n", label)
    open_keys = _sides(rows, "key", F.lit(1 / RUN))
    rows = rows.join(open_keys, "key").join(nodes.select("node", "signature"), "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()  # of all that the task sees
        for t in _runs(batches, "key"):
            node, slot, found = t.column("node").to_pylist(), t.column("key")[0].as_py() & 0xFF, []
            for x, ys, same in _near_rows(t, filing, percent):
                # a pair counts under the first key it shares
                for y in ys[first_slot(same, filing) == slot].tolist():
                    if forest.join(node[x], node[y]):
                        found.append((node[x], node[y]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["a", "b"])

    return _meetings(rows, "key").mapInArrow(run, "a long, b long").distinct()


def _linked(
    groups: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, filing: Filing
) -> DataFrame:
    """Links (a, b) between components: all nodes of a group (node, label) are compared."""
    rows = (
        groups.withColumnRenamed("label", "g")
        .join(labels, "node", "left")
        .join(nodes.select("node", F.col("n_shingles").alias("n"), "signature"), "node")
        .join(texts, "node")
        .select("g", "node", "n", F.coalesce("label", "node").alias("label"), "signature", "text")
    )
    weight = F.greatest(F.lit(1 / RUN), F.length("text") / BLOCK_CHARS)
    rows = rows.join(_sides(rows, "g", weight), "g")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, "g"):
            node, label, text = t.column("node").to_numpy(), t.column("label").to_pylist(), t.column("text")
            sets: dict[int, set] = {}
            known, found = Forest(), []

            def words(row: int) -> set:
                if row not in sets:
                    sets[row] = shingle_set(text[row].as_py())
                return sets[row]

            for x, ys, _ in _near_rows(t, filing, percent):
                for y in ys.tolist():
                    if known.find(label[x]) == known.find(label[y]):
                        continue
                    both = len(words(x) & words(y))
                    if 100 * both >= percent * (len(words(x)) + len(words(y)) - both):
                        known.join(label[x], label[y])
                        found.append((x, y))
            if found:
                ends = node[np.array(found)]
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return _meetings(rows, "g").mapInArrow(run, "a long, b long")


def first_slot(same: np.ndarray, filing: Filing) -> np.ndarray:
    """The first key that pairs share, from where their signatures agree."""
    wide = same.reshape(-1, filing.chunks, filing.parts)
    others = wide.sum(axis=2, keepdims=True) - wide
    return (others.reshape(-1, filing.places) == filing.parts - 1).argmax(axis=1)


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id, kept."""
    if percent < 80:
        raise ValueError("signatures are made for a similarity of 0.8 or more")
    filing = Filing() if percent >= 85 else Filing(16, 4)
    rows = materialize(sketch(docs, id_col, text_col, filing), "sketches")
    nodes = rows.filter("n_shingles > 0").groupBy("node_key").agg(
        F.min("doc_id").alias("low_id"),
        F.min(F.struct("doc_id", "text_key")).alias("shown"),  # a row whose text stands for all
        F.any_value("n_shingles").alias("n_shingles"),
        F.any_value("signature").alias("signature"),
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    filed = _file_keys(nodes, filing).repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    found = materialize(_tried(filed, percent, filing.reach), "keys")
    shared = found.filter("b IS NULL").select("key", "node", "n")
    tried = found.filter("b IS NOT NULL").select(F.col("node").alias("a"), "b").distinct()
    texts = _texts(docs, nodes, shared, id_col, text_col)
    tried = materialize(_distance_within(tried, nodes, filing), "pairs")
    # A hot key may lie in several tasks, each with a first node of its own:
    # whole keys are compared below, so nothing depends on it.
    labels = components(materialize(_confirmed(tried, texts, percent), "links"))
    groups = components(materialize(_grouped(shared, labels, nodes, percent, filing), "groups"))
    labels = components(materialize(_linked(groups, labels, nodes, texts, percent, filing), "links"), labels)

    named = nodes.join(labels, "node", "left").select(
        "node_key", "low_id", F.coalesce("label", "node").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("low_id").alias("component_id"))
    named = named.join(smallest, "label").select("node_key", "component_id")
    out = rows.join(named, "node_key", "left").select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _texts(docs: DataFrame, nodes: DataFrame, shared: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, text for the nodes that share a key with another."""
    wanted = nodes.join(shared.select("node").distinct(), "node").select("node", "shown.doc_id", "shown.text_key")
    text = F.coalesce(quoted(text_col), F.lit(""))
    bodies = docs.select(
        quoted(id_col).cast("long").alias("id"), hash128(text).alias("key"), text.alias("text")
    )
    one_row = (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))
    joined = wanted.join(bodies, one_row).groupBy("node").agg(F.any_value("text").alias("text"))
    return materialize(joined, "texts")


def one_of_each(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs`` and nothing else."""
    kept = near_duplicates(docs, percent, id_col, text_col).filter("kept").select("doc_id", "text_key").distinct()
    key, kid, ktext = fresh([*docs.columns], "text_key_", "kept_id_", "kept_key_")
    kept = kept.toDF(kid, ktext)
    rows = docs.withColumn(key, hash128(F.coalesce(quoted(text_col), F.lit(""))))
    same = (quoted(key) == quoted(ktext)) & quoted(id_col).cast("long").eqNullSafe(quoted(kid))
    return rows.join(kept, same, "left_semi").drop(key)
