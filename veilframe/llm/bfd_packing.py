"""Token-id output: best-fit-decreasing packing with a segment tree over free room.

Each task tokenises its documents and packs them shard by shard (a bounded
number of tokens), so no token crosses the network and a lost task is simply
run again. Overlong documents are cut without loss. The sequences come out as
fixed-width rows of ids with cumulative segment lengths and position ids that
start again at every segment, ready to be written as Parquet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm import textbytes as tb
from veilframe.llm import tokens as tk

CAPACITY = 2048
SHARD_TOKENS = 4 << 20


class RoomTree:
    """Counts of open sequences by free room; finds the least room that is enough."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, room: int, by: int) -> None:
        at = room + self.base
        while at:
            self.count[at] += by
            at >>= 1

    def least(self, wanted: int) -> int | None:
        """The smallest room of at least ``wanted`` that an open sequence has."""
        count, at = self.count, wanted + self.base
        if count[at]:
            return wanted
        while at > 1:
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.base:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.base
            at >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the lengths, by sequence; each length goes where it leaves the least room."""
    tree, open_, out = RoomTree(capacity), {}, []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.least(lengths[i])
        if room is None:
            room, sequence = capacity, len(out)
            out.append([])
        else:
            sequence = open_[room].pop()
            tree.add(room, -1)
        out[sequence].append(i)
        if left := room - lengths[i]:
            open_.setdefault(left, []).append(sequence)
            tree.add(left, 1)
    return out


_SCHEMA = pa.schema([
    ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ("cu_seqlens", pa.list_(pa.int32())), ("input_ids", pa.binary()), ("position_ids", pa.binary()),
])
_SQL = "sequence_id long, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, input_ids binary, position_ids binary"


def _packed(docs: list, starts: list[int], parts: list[np.ndarray], capacity: int, first: int, width: str):
    """Batches of packed rows of a shard."""
    lengths = [len(p) for p in parts]
    rows: list[list] = [[] for _ in _SCHEMA]
    for number, members in enumerate(best_fit_decreasing(lengths, capacity), first):
        cu = np.append(0, np.cumsum([lengths[i] for i in members]))
        ids, places = np.zeros(capacity, width), np.zeros(capacity, width)
        used = int(cu[-1])
        ids[:used] = np.concatenate([parts[i] for i in members])
        places[:used] = np.arange(used) - np.repeat(cu[:-1], np.diff(cu))
        values = (number, used, [docs[i] for i in members], [starts[i] for i in members], cu.tolist(), ids.tobytes(), places.tobytes())
        for into, value in zip(rows, values):
            into.append(value)
        if len(rows[0]) == 512:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, _SCHEMA)], schema=_SCHEMA)
            rows = [[] for _ in _SCHEMA]
    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, _SCHEMA)], schema=_SCHEMA)


def packed_sequences(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
                     capacity: int = CAPACITY, end_id: int = 50256, id_bytes: int = 2) -> DataFrame:
    """One row per sequence: ids and position ids as little-endian rows of ``capacity``, cumulative segment lengths.

    ``doc_ids`` and ``starts`` say which document, from which of its tokens on,
    each segment holds; positions begin at 0 in every segment. Behind the last
    segment the rows are zero (``n_tokens`` tells where). Every document ends
    with the end id. Null text counts as empty, repeated rows and null ids are
    packed each, other columns are ignored, an empty table gives no rows.
    ``id_bytes`` is 2 for vocabularies of up to 65,536 ids and capacities of as
    many tokens, else 4.
    """
    if id_bytes not in (2, 4) or (id_bytes == 2 and capacity > 1 << 16):
        raise ValueError("id_bytes must be 2 or 4, and 4 for capacities over 65536")
    width = f"<u{id_bytes}"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        following = TaskContext.get().partitionId() << 33
        owners, starts, parts, held = [], [], [], 0
        for batch in batches:
            for piece in tb.slices(batch, "text", 8 << 20):
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    ids = np.append(tk.document_ids(vocabulary, text or ""), np.uint32(end_id))
                    if id_bytes == 2 and ids.max() >= 1 << 16:
                        raise ValueError("ids need four bytes")
                    ids = ids.astype(width)
                    for start, length in tk.pieces(len(ids), capacity):
                        owners.append(doc), starts.append(start), parts.append(ids[start : start + length])
                    held += len(ids)
                    if held >= SHARD_TOKENS:
                        for out in _packed(owners, starts, parts, capacity, following, width):
                            following += out.num_rows
                            yield out
                        owners, starts, parts, held = [], [], [], 0
        yield from _packed(owners, starts, parts, capacity, following, width)

    return texts.mapInArrow(run, _SQL)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; the id matrices are the fixed-width ``input_ids`` and ``position_ids`` cells."""
    packed.write.mode("overwrite").parquet(path)
