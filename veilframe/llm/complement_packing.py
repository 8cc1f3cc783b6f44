"""Best-fit packing with exact-complement hashing.

Documents are tokenised once; only lengths take part in packing. There are at
most ``capacity`` different lengths, so the packing problem is a histogram,
whatever the number of documents, and is solved on the driver: sums of one, two
and three lengths are looked up as complements of a gap and consumed as often as
their counts allow; what is left goes best-fit into the fullest bin it fits.
The answer is a list of *slots*: "the documents ranked a to b of this length
take this offset of consecutive sequences". Spark ranks the pieces per length
(counts per task and running offsets, no sort of the documents) and looks its
slot up. Nothing that grows with the documents reaches the driver or one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm import textbytes as tb
from veilframe.llm import tokens as tk
from veilframe.session import materialize

CAPACITY = 2048
_RANK_BITS = 44


class _Counts:
    """How many pieces of each length are left, and which lengths those are."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def times(self, combination: tuple[int, ...]) -> int:
        """How often the combination is available."""
        return min(int(self.left[x]) // combination.count(x) for x in set(combination))

    def take(self, combination: tuple[int, ...], times: int) -> None:
        for x in combination:
            self.left[x] -= times

    def pair_for(self, gap: int, without: tuple[int, ...]) -> tuple[int, int] | None:
        """The most plentiful two lengths that sum to the gap, beside what is already taken."""
        left = self.left[1:gap].copy()
        for x in without:
            if x < gap:
                left[x - 1] -= 1
        a = np.arange(1, gap // 2 + 1)
        if not len(a) or gap < 2:
            return None
        can = np.minimum(left[a - 1], left[gap - a - 1])
        if gap % 2 == 0:
            can[-1] = left[gap // 2 - 1] // 2
        best = int(np.argmax(can))
        return (int(a[best]), gap - int(a[best])) if can[best] > 0 else None


def _complements(counts: _Counts, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Combinations of up to four lengths that fill a sequence exactly, longest length first."""
    for length in range(capacity, 0, -1):
        while counts.left[length] > 0:
            gap, found = capacity - length, None
            if gap == 0:
                found = (length,)
            else:
                one = (length, gap)
                if gap <= length and counts.times(one) > 0:
                    found = one
                if found is None and (pair := counts.pair_for(gap, (length,))):
                    found = (length, *pair)
                if found is None:
                    for third in np.flatnonzero(counts.left[: min(length, gap - 1)])[::-1].tolist():
                        if third and counts.times((length, third)) > 0 and (pair := counts.pair_for(gap - third, (length, third))):
                            found = (length, third, *pair)
                            break
            times = counts.times(found) if found else 0
            if times <= 0:
                break
            counts.take(found, times)
            yield found, times


def _best_fit(counts: _Counts, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """What no combination fills: longest first, into the fullest kind of open sequence it fits."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, pattern: tuple[int, ...], times: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((pattern, times))

    for length in range(capacity, 0, -1):
        todo = int(counts.left[length])
        while todo:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                if todo >= per:
                    put(capacity - per * length, (length,) * per, todo // per)
                    todo %= per
                else:
                    put(capacity - todo * length, (length,) * todo, 1)
                    todo = 0
                continue
            room = rooms[at]
            pattern, times = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            used = min(times, todo)
            if times > used:
                put(room, pattern, times - used)
            put(room - length, (*pattern, length), used)
            todo -= used
        counts.left[length] = 0
    for groups in open_.values():
        yield from groups


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots for a histogram of lengths: (length, from rank, first sequence, offset), sorted."""
    left = _Counts(counts, capacity)
    used = np.zeros(capacity + 1, np.int64)
    sequence, slots = 0, []
    for patterns in (_complements, _best_fit):
        for pattern, times in patterns(left, capacity):
            offset = 0
            for length in pattern:
                slots.append((length, int(used[length]), sequence, offset))
                used[length] += times
                offset += length
            sequence += times
    slots.sort()
    columns = np.array(slots, np.int64).reshape(-1, 4).T
    return {"key": (columns[0] << _RANK_BITS) | columns[1], "rank": columns[1], "sequence": columns[2], "offset": columns[3], "sequences": np.array([sequence])}


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("part", pa.int64()), ("nth", pa.int64()),
])


def _tokenise(vocabulary: str, capacity: int, end_id: int):
    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64).tolist()
        for batch in batches:
            for piece in tb.slices(batch, "text", 8 << 20):
                rows: list[list] = [[] for _ in range(6)]
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    ids = np.append(tk.document_ids(vocabulary, text or ""), np.array([end_id], "<u4")).astype("<u4", copy=False)
                    for number, (start, length) in enumerate(tk.pieces(len(ids), capacity)):
                        for into, value in zip(rows, (doc, number, start, length, zlib.crc32(ids[start : start + length].tobytes()), seen[length])):
                            into.append(value)
                        seen[length] += 1
                columns = [pa.array(v, f.type) for v, f in zip(rows[:5], _PIECES)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(rows[0]), part)), pa.array(rows[5], pa.int64())], schema=_PIECES)

    return run


def _assign(slots: dict[str, np.ndarray]):
    names = ("doc_id", "piece", "start", "length", "ids_crc32")

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(slots["key"], (length << _RANK_BITS) | rank, "right") - 1
            sequence = slots["sequence"][at] + rank - slots["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence), pa.array(slots["offset"][at])], names=[*names, "sequence_id", "offset"]
            )

    return run


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
         capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and the end id. One longer than a sequence is cut
    into whole sequences, of which the first may be shorter. Null text counts as
    empty (the end id alone); repeated rows and null ids are packed each; other
    columns are ignored; an empty table packs into nothing.
    """
    if not 1 <= capacity <= 1 << 18:
        raise ValueError("capacity must be between 1 and 262144 tokens")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
    pieces = materialize(texts.mapInArrow(_tokenise(vocabulary, capacity, end_id), schema), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_task = materialize(per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "offsets")
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = pieces.join(per_task.drop("n"), ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before"))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_assign(plan(counts, capacity)), out)
