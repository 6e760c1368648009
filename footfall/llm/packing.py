"""Best-fit packing of tokenised documents, certified by lower bounds.

Only a document longer than a sequence is cut: its first piece takes the
remainder, all others are full and need no partner.  Short pieces are spread
over partitions of about ``GROUP`` pieces.  Each partition packs its pieces by
best fit in decreasing order and computes a lower bound of its number of
sequences with dual feasible functions.  Partitions whose count meets the
bound are certified; they hand on only a last sequence that is not nearly full.
Partitions with a gap hand on their emptiest sequences, as many as hold the
room of the gap.  What was handed on is dealt out again in the next round,
until one partition holds all of it.  A piece brings along its share of the
sequence it was in: a partition that saves no sequence against the sum of its
shares is settled like a certified one, so every round hands on fewer
sequences than the one before.

Every row of the result carries its partition's figures: ``group_sequences``
against ``group_bound``.  Pieces of no token do not exist; repeated documents
are packed once for each row; null ids are ids like others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import column, gathered, quoted
from footfall.llm.tokens import encoder, with_end
from footfall.session import materialize

GROUP = 8192
TEXT_BYTES = 4 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long, round int, group_sequences long, group_bound long"


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of two families of dual feasible functions."""
    sizes, counts = np.unique(lengths, return_counts=True)
    total = int((sizes * counts).sum())
    best = -(-total // capacity)
    for low in np.unique(np.minimum(sizes, capacity - sizes)):
        if 0 < low <= capacity // 2:  # large ones fill a sequence, those below ``low`` count nothing
            worth = np.where(sizes > capacity - low, capacity, np.where(sizes >= low, sizes, 0))
            best = max(best, -(-int((worth * counts).sum()) // capacity))
    for k in range(1, 21):  # rounded down to multiples of 1/k, except where (k + 1) x / C is whole
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        worth = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((worth * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; each goes where the least room that suffices is left."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a sequence with room r is open
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            place = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, place = capacity, made
            made += 1
        sequence[i], offset[i] = place, capacity - room
        left = room - size
        if left:
            open_by_room[left].append(place)
            rooms |= 1 << left
    return sequence, offset


def handed_on(sequence: np.ndarray, lengths: np.ndarray, bound: int, capacity: int, before: float) -> np.ndarray:
    """Of each piece, whether it goes to the next round; always of fewer sequences than ``before``, the shares' sum."""
    used = np.bincount(sequence, weights=lengths).astype(np.int64)
    room = capacity - used
    order = np.argsort(-room, kind="stable")
    gap = len(used) - bound
    if before < 1.5:
        given = order[:0]
    elif gap <= 0 or len(used) > before - 0.5:
        given = order[:1] if room[order[0]] * 16 > capacity else order[:0]
    else:
        enough = np.searchsorted(np.cumsum(room[order]), (gap + 1) * capacity) + 1
        given = order[:enough]
        given = given[room[given] > 0]
    return np.isin(sequence, given)


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col="doc_id", text_col="text") -> DataFrame:
    """The pieces of all documents."""
    names = [f.split()[0] for f in PIECES.split(", ")]

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            ids, at = with_end(*encoder(tokenizer).encode(column(t, "text")), end_id)
            n = np.diff(at)
            first = np.where(n % capacity > 0, n % capacity, np.minimum(n, capacity))
            many = 1 + (n - first) // capacity
            doc = np.repeat(np.arange(len(n)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            start = np.where(piece > 0, first[doc] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[doc])
            raw = memoryview(ids.astype("<u4").tobytes())
            begin = (at[:-1][doc] + start) * 4
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    column(t, "doc_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array(sums, pa.int64()),
                ],
                names,
            )

    rows = docs.select(
        quoted(id_col).cast("long").alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text")
    )
    return rows.mapInArrow(pieces, PIECES)


def pack(pieces: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """Place every piece: the columns of ``PLACED``, one row per piece."""
    spark = pieces.sparkSession
    # Numbered before they are written: equal rows are dealt apart.
    pieces = materialize(pieces.withColumn("number", F.monotonically_increasing_id()), "pack-pieces")
    # A sequence of its own; negative numbers are left to these.
    full = (
        pieces.filter(F.col("length") == capacity)
        .drop("number")
        .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
        .withColumns({
            "offset": F.lit(0).cast("long"), "round": F.lit(0),
            "group_sequences": F.lit(1).cast("long"), "group_bound": F.lit(1).cast("long"),
        })
    )
    done = [full]
    left = pieces.filter(F.col("length") < capacity).withColumn("share", F.lit(1.0))  # a sequence each
    turn = first = 0
    while True:
        n = left.count()
        if n == 0:
            break
        groups = -(-n // group)
        turn += 1
        placed = materialize(_round(left, groups, turn, first, capacity), "pack-round")
        first += groups
        done.append(placed.filter("NOT again").drop("again", "share", "number"))
        if groups == 1:
            break
        left = placed.filter("again").select("doc_id", "piece", "start", "length", "ids_crc32", "share", "number")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _round(left: DataFrame, groups: int, turn: int, first: int, capacity: int) -> DataFrame:
    """``first``: how many groups earlier rounds had; sequences are numbered inside their group."""
    last = groups == 1

    def run(key, rows):
        # The same order in a repeated task, so the same packing.
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32", "number"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        sequence, offset = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        before = float(rows["share"].sum())
        again = np.zeros(len(rows), bool) if last else handed_on(sequence, lengths, bound, capacity, before)
        used = np.bincount(sequence, weights=lengths)
        return rows.drop(columns="deal").assign(
            sequence_id=((first + int(key[0])) << 24) + sequence,
            offset=offset,
            round=turn,
            group_sequences=int(sequence.max()) + 1,
            group_bound=bound,
            share=lengths / used[sequence],
            again=again,
        )

    key = F.pmod(F.xxhash64("number", F.lit(turn)), F.lit(groups))
    return left.withColumn("deal", key).groupBy("deal").applyInPandas(run, f"{PLACED}, share double, number long, again boolean")
