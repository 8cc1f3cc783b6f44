"""Line dedup: one occurrence of each group of equal or nearly equal lines stays.

A line's normal form is its words: letters A-Z lowered, digits folded to one,
punctuation and white space left out. Lines with the same normal form are one
node. Two nodes link when at most a tenth of the words of the longer one is
edited; verified links make connected groups, and of each group's occurrences
the first (document, line) stays. Candidates come from one of two indexes:

* *Every pair* (``distance=None``; the queries use it). Lines at most k word edits
  apart have all but k words in common, so of each node only its k + 1 rarest
  words (with their number of occurrence in the line) are indexed: any two that
  link share one of them. How rare a word is decides the cost, never the result.
  Pairs are left early by length and 128 word parities, true lower bounds of the
  edits; the parities travel with the index, so far pairs are never written.
* *SimHash* (``distance`` bits). Only nodes whose 64-bit SimHashes are that close
  are compared at all, so pairs that the edit similarity would accept are lost.
  Such nodes agree on at least one of ``distance + 1`` blocks (pigeonhole), and
  within a block's bucket the other bits are split into blocks again.

In a run of a bucket each node is paired with its next neighbours only. A node
that has candidates further on is kept with its run; what of a run then still
lies in different groups is joined exactly. Occurrences are only ever counted with
partial aggregation, so a line that a third of all documents hold is no problem.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm import textbytes as tb
from veilframe.llm.common import KeyFilter, components, is_empty, merged, met_before, with_earlier
from veilframe.session import materialize

MIN_WORDS = 5
DISTANCE = 3
SIMILARITY = 0.9
NEIGHBOURS = 4  # next ones of a run that a node is paired with at once
WINDOW = 64  # next ones of a run that are looked at for further candidates
REACH = 1024  # the same in a run of a word, where only nodes of like size are looked at
WIDE = 224  # words from which 128 parities are too few to tell lines apart
SLOT_BITS = 18  # word counts are kept per slot of their hashes, one megabyte whatever the input
PIECE = 1 << 12  # slots whose counts travel in one row
_LANE = 1 << 15

FOLDED = tb.LOWER.copy()
FOLDED[48:58] = 48  # every digit is 0


def _nibble_lanes() -> np.ndarray:
    """Four bits as four 16-bit lanes of one word."""
    out = np.zeros(16, np.uint64)
    for value in range(16):
        for bit in range(4):
            if value >> bit & 1:
                out[value] |= np.uint64(1 << (16 * bit))
    return out


_LANES = _nibble_lanes()


def simhash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per line (words ``bounds[i]`` to ``bounds[i + 1]``) the majority of each bit over its word hashes."""
    lines = len(bounds) - 1
    out = np.zeros(lines, np.uint64)
    counts = np.diff(bounds)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # Lanes hold up to 65,535, so longer lines are summed in stretches.
    pieces = -(-counts[full] // _LANE)
    owner = np.repeat(np.arange(len(full)), pieces)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = bounds[full][owner] + inner * _LANE
    half = counts[full]
    for nibble in range(16):
        lanes = np.add.reduceat(_LANES[(hashes >> np.uint64(4 * nibble) & np.uint64(15)).astype(np.int64)], starts)
        for bit in range(4):
            ones = (lanes >> np.uint64(16 * bit) & np.uint64(0xFFFF)).astype(np.int64)
            total = np.bincount(owner, ones, len(full)).astype(np.int64)
            out[full] |= (2 * total > half).astype(np.uint64) << np.uint64(4 * nibble + bit)
    return out


def parities(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per line (words ``bounds[i]`` to ``bounds[i + 1]``) of which of 128 classes of words it has an odd number, in two longs; an edit changes at most two."""
    half, slot = hashes >> np.uint64(57) & np.uint64(1), np.uint64(1) << (hashes >> np.uint64(58))
    out = []
    for which in (0, 1):
        sums = np.append(np.uint64(0), np.bitwise_xor.accumulate(np.where(half == which, slot, np.uint64(0))))
        out.append(sums[bounds[1:]] ^ sums[bounds[:-1]])
    return out[0], out[1]


def _lines(part: pa.RecordBatch):
    """(document, line number, node, word hashes, word bounds, first byte, end byte, size, bytes) of every line of a slice.

    The size is the number of words.
    """
    data, offsets = tb.flat(part.column("text"))
    begins = np.append(False, data == 10)
    begins[offsets] = False
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    # A text that ends in a line break has one more, empty line; it never counts as a line with words.
    edges = np.append(starts, len(data))
    doc = np.searchsorted(offsets, starts, "right") - 1
    number = np.arange(len(starts)) - np.searchsorted(doc, doc)
    hashes, words, _ = tb.words(FOLDED[data], edges if len(starts) else np.zeros(1, np.int64), tb.NOT_ALNUM, lower=False)
    bounds = tb.word_bounds(words, edges)
    order = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    placed = tb.mix(hashes + order.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sums = np.append(np.uint64(0), np.cumsum(placed))
    node = tb.mix(sums[bounds[1:]] - sums[bounds[:-1]])
    return doc, number, node.view(np.int64), hashes, bounds, starts, edges[1:], np.diff(bounds), data


_PARITIES = [f"s{i}" for i in range(4)]
_OCCURRENCES = pa.schema([*[(n, pa.int64()) for n in ("id", "line", "node", "sim", "size", *_PARITIES)], ("counts", pa.binary())])


def _occurrences(min_words: int, sketch, wide: int, least: int | None = None):
    """A row per line, with its SimHash if ``sketch`` makes one; lines of ``wide`` words or more have a sketch of parities too.

    With ``least``, rows without a node follow: how many words of lines of so many
    words or more fell into the slots of piece ``line``.
    """

    def run(batches):
        total = np.zeros(1 << SLOT_BITS if least is not None else 0, np.int64)
        for batch in batches:
            for part in tb.slices(batch, "text"):
                doc, number, node, hashes, bounds, _, _, size, _ = _lines(part)
                sim = sketch(hashes, bounds) if sketch else np.zeros(len(node), np.uint64)
                use = np.flatnonzero(np.diff(bounds) >= min_words)
                ids = part.column("id").take(pa.array(doc[use]))
                short = size[use] < wide
                odd = np.zeros((len(use), 4), np.int64)
                odd[~short] = sketches(hashes, bounds, use[~short])
                columns = [ids, pa.array(number[use]), pa.array(node[use]), pa.array(sim[use].view(np.int64)), pa.array(size[use])]
                columns += [*[pa.array(odd[:, j], mask=short) for j in range(4)], pa.nulls(len(use), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=_OCCURRENCES)
                if least is not None:
                    counted = hashes[np.repeat(size >= least, size)]
                    total += np.bincount((counted >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(total))
        pieces = [(i, x.astype(np.min_scalar_type(x.max())).tobytes()) for i, x in enumerate(total.reshape(-1, PIECE)) if x.any()]
        columns = {"line": pa.array([i for i, _ in pieces], pa.int64()), "counts": pa.array([x for _, x in pieces], pa.binary())}
        yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(pieces), f.type)) for f in _OCCURRENCES], schema=_OCCURRENCES)

    return run


def blocks_of(sim: np.ndarray, width: int, many: int, count: int) -> list[np.ndarray]:
    """``count`` blocks of the ``many`` low bits, each ``width`` bits wide (the last takes the rest)."""
    out = []
    for i in range(count):
        bits = width if i < count - 1 else many - width * (count - 1)
        out.append(sim >> np.uint64(width * i) & np.uint64((1 << bits) - 1))
    return out


def _deal(distance: int):
    """A row per block of each node: (block number and value, node, simhash, size)."""
    count = distance + 1
    width = 64 // count
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("sim", pa.int64()), ("size", pa.int64())])

    def run(batches):
        for batch in batches:
            node, sim = batch.column("node").to_numpy(), batch.column("sim").to_numpy().view(np.uint64)
            bucket = np.concatenate([v.astype(np.int64) | (i << 40) for i, v in enumerate(blocks_of(sim, width, 64, count))])
            columns = [bucket, *[np.tile(c, count) for c in (node, sim.view(np.int64), batch.column("size").to_numpy())]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _add_up(batches):
    """(piece, counts) of whole pieces, each piece's counts in one row."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch.column("line").to_pylist(), batch.column("counts").to_pylist()):
            total[piece] = total.get(piece, 0) + np.frombuffer(counts, f"u{len(counts) // PIECE}").astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["line", "counts"])


def word_counts(occurrences: DataFrame, width: int) -> np.ndarray:
    """How many words fall into each slot; a fixed number of counts reaches the driver."""
    out = np.zeros(1 << SLOT_BITS, np.int32)
    pieces = occurrences.where("counts is not null").select("line", "counts").repartition(min(width, (1 << SLOT_BITS) // PIECE), "line")
    for row in pieces.mapInArrow(_add_up, "line long, counts binary").collect():
        out[row.line * PIECE : (row.line + 1) * PIECE] = np.minimum(np.frombuffer(bytes(row.counts), np.int64), np.iinfo(np.int32).max)
    return out


def rarest(hashes: np.ndarray, counts: np.ndarray, held: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the rarest words of lines of ``counts`` words: one more than the edits allowed to each.

    A word's second occurrence in a line is another word than its first.
    """
    # One order of words for all lines: how often, about, then the hash; the same words of a line come together.
    often = (held.astype(np.float32).view(np.uint32) >> np.uint32(15))[(hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = owner << np.uint64(48) | often << np.uint64(32) | hashes >> np.uint64(32)
    order = np.argsort(key)
    twin = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if len(counts) > 1 << 16 or (hashes[order[twin]] != hashes[order[twin + 1]]).any():  # the key does not tell all words and lines apart
        order = np.lexsort((hashes, often, owner))
    rank = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)  # each line has its words in the same places
    chosen = order[rank <= np.repeat(allowed(counts, similarity), counts)]
    line, words = owner[chosen].astype(np.int64), hashes[chosen]
    fresh = np.append(True, (words[1:] != words[:-1]) | (line[1:] != line[:-1]))[: len(words)]
    nth = np.arange(len(words)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(words) else np.zeros(0, np.int64)
    return line, tb.mix(words + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_DEALT = pa.schema([(n, pa.int64()) for n in ("bucket", "node", "sim", "odd", "size")])


def _deal_rarest(held: np.ndarray, similarity: float, min_words: int):
    """A row per indexed word of each node, once per task: (word, node, parities, size)."""

    def run(batches):
        seen = set()
        for batch in batches:
            for part in tb.slices(batch, "text"):
                _, _, node, hashes, bounds, *_ = _lines(part)
                size = np.diff(bounds)
                use = np.flatnonzero(size >= min_words)
                use = use[np.unique(node[use], return_index=True)[1]]
                use = use[np.array([n not in seen for n in node[use].tolist()], bool)]
                seen.update(node[use].tolist())
                if not len(use):
                    continue
                counts = size[use]
                inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                line, keys = rarest(hashes[np.repeat(bounds[use], counts) + inner], counts, held, similarity)
                even, odd = (x[use].view(np.int64)[line] for x in parities(hashes, bounds))
                columns = [keys.view(np.int64), node[use][line], even, odd, counts[line]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_DEALT)

    return run


# A pair (a, b, bits apart), or with ``long`` a node with candidates further on in its run: (run, node, simhash or parities, more parities, size).
_PAIRS = pa.schema([*[(n, pa.int64()) for n in ("a", "b", "apart", "odd", "size")], ("long", pa.bool_())])


def _rows(a, b, apart, odd, size, long: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, apart, odd, size)] + [pa.array(np.full(len(a), long))], schema=_PAIRS)


def _compare(bucket, node, sim, size, distance: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours within the distance, and nodes with candidates further on: split the other bits again, sort, look ahead.

    Forms whose lengths differ by more than the edits allowed cannot be similar;
    different forms need at least one edit.
    """
    count = distance + 1
    width = 64 // count
    first = bucket >> 40
    shift = (first * width).astype(np.uint64)
    own = np.where(first < count - 1, width, 64 - width * (count - 1)).astype(np.uint64)
    low = sim & ((np.uint64(1) << shift) - np.uint64(1))
    above = shift + own
    high = np.where(above < 64, sim >> np.minimum(above, np.uint64(63)), np.uint64(0))
    other = low | (high << shift)
    inner = max(1, (64 - width) // count)
    for i, value in enumerate(blocks_of(other, inner, 64 - width, count)):
        key = tb.mix(bucket.astype(np.uint64) * np.uint64(4 * count) + np.uint64(i) + (value + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
        order = np.argsort(key)
        together = key[order[1:]] == key[order[:-1]]
        order = order[np.append(together, False) | np.append(False, together)]  # alone in a run: no pair
        if not len(order):
            continue
        order = order[np.lexsort((node[order], size[order], key[order]))]
        k, n, s, z = key[order], node[order], sim[order], size[order]
        far = np.zeros(len(k), bool)
        same = np.arange(len(k))
        for d in range(1, min(WINDOW, len(k) - 1) + 1):
            same = same[: np.searchsorted(same, len(k) - d)]
            same = at = same[k[same + d] == k[same]]
            if not len(at):
                break
            apart = np.bitwise_count(s[at] ^ s[at + d])
            most = allowed(z[at + d], similarity)
            ok = (apart <= distance) & (z[at + d] - z[at] <= most) & (most >= 1)
            at, apart = at[ok], apart[ok]
            if d <= NEIGHBOURS:
                a, b, none = n[at], n[at + d], np.zeros(len(at))
                yield _rows(np.minimum(a, b), np.maximum(a, b), apart, none, none, False)
            else:
                far[at] = far[at + d] = True
        far |= _beyond(k, z, similarity)
        if far.any():
            yield _rows(k[far].view(np.int64), n[far], s[far].view(np.int64), np.zeros(far.sum()), z[far], True)


def _compare_rarest(bucket, node, even, odd, size, similarity: float) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours that may be similar, and nodes with candidates further on: sort by size, look ahead.

    Forms whose lengths differ by more than the edits allowed cannot be similar;
    different forms need at least one edit, and an edit changes two parities.
    """
    order = np.lexsort((node, size, bucket))
    k, n, z = bucket[order], node[order], size[order]
    once = np.append(True, (k[1:] != k[:-1]) | (n[1:] != n[:-1]))  # tasks may have dealt the same node
    together = k[once][1:] == k[once][:-1]
    paired = np.append(together, False) | np.append(False, together)  # alone in a list: no pair
    order = order[once][paired]
    if not len(order):
        return
    k, n, s, o, z = bucket[order], node[order], even[order], odd[order], size[order]
    edits = allowed(z, similarity)
    far = np.zeros(len(k), bool)
    same = np.arange(len(k))
    for d in range(1, min(REACH, len(k) - 1) + 1):
        same = same[: np.searchsorted(same, len(k) - d)]
        # A node that the size rules out rules out all after it.
        same = at = same[(k[same + d] == k[same]) & (z[same + d] - z[same] <= edits[same + d])]
        if not len(at):
            break
        apart = np.bitwise_count(s[at] ^ s[at + d]) + np.bitwise_count(o[at] ^ o[at + d])
        ok = (apart <= 2 * edits[at + d]) & (edits[at + d] >= 1)
        at, apart = at[ok], apart[ok]
        if d <= NEIGHBOURS:
            a, b, none = n[at], n[at + d], np.zeros(len(at))
            yield _rows(np.minimum(a, b), np.maximum(a, b), apart, none, none, False)
        else:
            far[at] = far[at + d] = True
    far |= _beyond(k, z, similarity, REACH)
    if far.any():
        yield _rows(k[far], n[far], s[far].view(np.int64), o[far].view(np.int64), z[far], True)


def _beyond(run, size, similarity: float, window: int | None = None) -> np.ndarray:
    """Nodes, sorted by run and size, whose sizes let them pair with one more than ``window`` (``WINDOW``) places away."""
    window = window or WINDOW
    out = np.zeros(len(run) + 1, np.int64)
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    last = np.append(first[1:], len(run))
    wide = last - first > window + 1
    for i, j in zip(first[wide].tolist(), last[wide].tolist()):
        # Nodes up to this place are short enough to reach; sizes less their edits never fall.
        reach = i + np.searchsorted(size[i:j] - allowed(size[i:j], similarity), size[i:j], "right")
        here = np.flatnonzero(reach > np.arange(i, j) + window + 1) + i
        out[here] += 1
        out[here + 1] -= 1
        np.add.at(out, here + window + 1, 1)
        np.add.at(out, reach[here - i], -1)
    return np.cumsum(out)[:-1] > 0


def allowed(size, similarity: float):
    """Edits that two strings may be apart, the longer one being so long."""
    return np.floor((1 - similarity) * size + 1e-9)


def least_size(similarity: float) -> int:
    """Words of the shortest form that can be similar to a different one."""
    if similarity >= 1:
        return 1 << 62
    longer = int(np.ceil(1 / (1 - similarity) - 1e-9))
    return longer - int(allowed(longer, similarity))


def _buckets(distance: int | None, similarity: float, most: int = 1 << 16):
    """Rows sorted by bucket, handed on as whole buckets, many small ones at once."""
    names = tuple(_DEALT.names) if distance is None else ("bucket", "node", "sim", "size")

    def compare(columns):
        if distance is None:
            bucket, node, even, odd, size = columns
            return _compare_rarest(bucket, node, even.view(np.uint64), odd.view(np.uint64), size, similarity)
        bucket, node, sim, size = columns
        return _compare(bucket, node, sim.view(np.uint64), size, distance, similarity)

    def run(batches):
        for columns in _whole(batches, names, most):
            yield from compare(columns)

    return run


def _whole(batches, names: tuple[str, ...], most: int = 1 << 16) -> Iterator[list[np.ndarray]]:
    """These columns of rows sorted by the first of them, which never has one value in two yields; many values at once."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(n).to_numpy() for n in names))
        rows += batch.num_rows
        if rows < most:
            continue
        whole = [np.concatenate(x) for x in zip(*held)]
        cut = int(np.searchsorted(whole[0], whole[0][-1]))
        if cut:
            yield [c[:cut] for c in whole]
        held, rows = [tuple(c[cut:] for c in whole)], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def edit_distance(a: list, b: list, most: int) -> int | None:
    """Edits between two sequences, or None if more than ``most``.

    What differs is a table of edits with a column per item of ``b``; of a column
    only where it goes up and down is kept, as bits of two integers (Myers).
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    low, short = 0, min(n, m)
    while low < short and a[low] == b[low]:
        low += 1
    high = 0
    while high < short - low and a[n - 1 - high] == b[m - 1 - high]:
        high += 1
    a, b = a[low : n - high], b[low : m - high]
    places, bit = {}, 1
    for item in a:
        places[item] = places.get(item, 0) | bit
        bit <<= 1
    every, last, score = bit - 1, bit >> 1, len(a)
    up, down, left = every, 0, len(b)
    for item in b:
        at = places.get(item, 0)
        same = (((at & up) + up) ^ up) | at | down
        more, less = down | every & ~(same | up), up & same
        score += 1 if more & last or not a else -1 if less & last else 0
        left -= 1
        if score - left > most:  # a column lowers it by one at most
            return None
        more, less = more << 1 | 1, less << 1
        up, down = every & (less | ~(same | more)), more & same & every
    return score if score <= most else None


def similar(a: list[str], b: list[str], at_least: float) -> bool:
    """Edit similarity, in words, of at least that much.

    Words to replace in place are enough edits, and each word that only one of
    the two has needs one; most pairs are decided by that.
    """
    most = int(allowed(max(len(a), len(b)), at_least))
    if len(a) == len(b) and sum(map(ne, a, b)) <= most:
        return True
    left, right = set(a), set(b)
    if max(len(left - right), len(right - left)) > most:
        return False
    return edit_distance(a, b, most) is not None


def normal_form(line: bytes) -> str:
    folded = FOLDED[np.frombuffer(line, np.uint8)]
    return " ".join(np.where(tb.NOT_ALNUM[folded], 32, folded).astype(np.uint8).tobytes().decode("utf-8", "replace").split())


def sketches(hashes: np.ndarray, bounds: np.ndarray, use: np.ndarray) -> np.ndarray:
    """256 parities per line of ``use``, as four longs: which of 256 classes of words it has an odd number of.

    An edit changes at most two of them, so similar lines differ in few.
    """
    out = np.empty((len(use), 4), np.int64)
    for at in range(0, len(use), 4096):
        some = use[at : at + 4096]
        counts = bounds[some + 1] - bounds[some]
        owner = np.repeat(np.arange(len(some)), counts)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        slot = (hashes[bounds[some][owner] + inner] >> np.uint64(56)).astype(np.int64)
        odd = (np.bincount(owner * 256 + slot, minlength=len(some) * 256) & 1).astype(np.uint8)
        out[at : at + len(some)] = np.packbits(odd.reshape(len(some), 256), axis=1).view(np.int64)
    return out


def _wanted_lines(docs: KeyFilter, wanted: KeyFilter, min_words: int):
    """(node, normal form) of the nodes that may be wanted, each once per task; only chosen documents are cut into words."""
    schema = pa.schema([("node", pa.int64()), ("form", pa.string())])

    def run(batches):
        seen = set()
        for batch in batches:
            batch = batch.filter(pa.array(docs.holds(batch.column("id").to_numpy())))
            for part in tb.slices(batch, "text"):
                _, _, node, _, bounds, starts, ends, _, data = _lines(part)
                use = []
                for i in np.flatnonzero((np.diff(bounds) >= min_words) & wanted.holds(node)).tolist():
                    if (n := int(node[i])) not in seen:
                        seen.add(n)
                        use.append(i)
                texts = [normal_form(data[starts[i] : ends[i]].tobytes()) for i in use]
                yield pa.RecordBatch.from_arrays([pa.array(node[np.array(use, np.int64)]), pa.array(texts, pa.string())], schema=schema)

    return run


def _verify(similarity: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b = [], []
            for x, y, p, q in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "p", "q"))):
                if similar(p.split(" "), q.split(" "), similarity):
                    a.append(x), b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b)], schema=schema)

    return run


def _read_lines(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, min_words: int) -> DataFrame:
    """(node, form) of the wanted nodes.

    Only documents that are the first of a wanted node are cut into words again.
    """
    docs = KeyFilter.of(nodes.join(wanted, "node", "left_semi"), "id")
    found = texts.mapInArrow(_wanted_lines(docs, KeyFilter.of(wanted, "node"), min_words), "node long, form string")
    return materialize(found.groupBy("node").agg(F.min("form").alias("form")), "forms")


def _apart(left: str, right: str):
    """Parities in which two sketches differ; null if a line has none."""
    return sum(F.bit_count(F.col(f"{left}{n}").bitwiseXOR(F.col(f"{right}{n}"))) for n in _PARITIES)


def _in_reach(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose sketches differ in at most twice the edits allowed; short lines have none and stay."""
    side = lambda p, end: nodes.where("s0 is not null").select(F.col("node").alias(end), *[F.col(c).alias(f"{p}{c}") for c in ("size", *_PARITIES)])
    both = pairs.join(side("l_", "a"), "a", "left").join(side("r_", "b"), "b", "left")
    most = F.floor((1 - similarity) * F.greatest("l_size", "r_size") + 1e-9)
    both = both.where(F.coalesce(_apart("l_", "r_") <= 2 * most, F.lit(True)))
    return both.select("a", "b", F.coalesce(_apart("l_", "r_").cast("long"), "apart").alias("apart"))


def _verified(forms: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    both = pairs.select("a", "b").join(forms.select(F.col("node").alias("a"), F.col("form").alias("p")), "a")
    both = both.join(forms.select(F.col("node").alias("b"), F.col("form").alias("q")), "b")
    return both.select("a", "b", "p", "q").mapInArrow(_verify(similarity), "a long, b long")


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet known to be in one group."""
    left = groups.select(F.col("node").alias("a"), F.col("component").alias("ga"))
    right = groups.select(F.col("node").alias("b"), F.col("component").alias("gb"))
    return pairs.join(left, "a", "left").join(right, "b", "left").where(F.coalesce("ga", "a") != F.coalesce("gb", "b")).select("a", "b")


def line_groups(texts: DataFrame, occurrences: DataFrame, nodes: DataFrame, distance: int | None, similarity: float, min_words: int) -> DataFrame:
    """(node, component) of those ``nodes`` (node, sim, size, sketch, id of a text that has it) that link to another.

    Each node is verified against its closest candidate and one at random first.
    That joins most groups, and only candidates between different groups are
    verified then.
    """
    spark = texts.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    if distance is None:
        least = max(min_words, least_size(similarity))
        dealt = texts.mapInArrow(_deal_rarest(word_counts(occurrences, width), similarity, least), "bucket long, node long, sim long, odd long, size long")
    else:
        dealt = nodes.select("node", "sim", "size").mapInArrow(_deal(distance), "bucket long, node long, sim long, size long")
    found = dealt.repartition(width, "bucket").sortWithinPartitions("bucket")
    found = materialize(found.mapInArrow(_buckets(distance, similarity), "a long, b long, apart long, odd long, size long, long boolean"), "candidates")
    pairs = found.where("not long").groupBy("a", "b").agg(F.min("apart").alias("apart"))
    pairs = materialize(_in_reach(pairs, nodes, similarity), "pairs")
    long = found.where("long").select(F.col("a").alias("run"), F.col("b").alias("node"), F.col("apart").alias("sim"), "odd", "size").distinct()
    # The nodes of long runs are read as well, so that no text is cut into words for them once more.
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(long.select("node"))
    forms = _read_lines(texts, nodes, ends, min_words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    any_one = F.struct(F.xxhash64("a", "b").alias("hash"), "b")
    best = both.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("near"), F.min(any_one).alias("any"))
    best = best.select("a", F.explode(F.array("near.b", "any.b")).alias("b"))
    best = materialize(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "closest")
    edges = materialize(_verified(forms, best, similarity), "links")
    groups = components(edges, "line-groups")
    rest = materialize(_across(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), groups), "rest")
    if not is_empty(rest):
        groups = merged(groups, _verified(forms, rest, similarity), "line-groups")
    if not is_empty(long):
        rest = materialize(_long_pairs(long, nodes, groups, distance, similarity).join(pairs, ["a", "b"], "left_anti"), "rest")
        if not is_empty(rest):
            groups = merged(groups, _verified(forms, rest, similarity), "line-groups")
    return groups


def _long_pairs(long: DataFrame, sketched: DataFrame, groups: DataFrame, distance: int | None, similarity: float) -> DataFrame:
    """Exact rest of runs: pairs between groups beyond the next neighbours, joined per band of sizes.

    Sketches that differ in more than twice the edits allowed rule a pair out. Two
    nodes meet in every run they share; a run leaves out those known to meet in
    an earlier one.
    """
    rows = materialize(long.join(groups, "node", "left").withColumn("g", F.coalesce("component", "node")).drop("component"), "runs")
    open_runs = materialize(rows.groupBy("run").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low <> high").select("run"), "open-runs")
    band = F.floor(F.log(F.greatest("size", F.lit(1)).cast("double")) / float(np.log(1 / similarity)) + 1e-9).cast("int")
    rows = with_earlier(rows.join(open_runs, "run", "left_semi"), "run", "run", "node").withColumn("band", band)
    rows = rows.join(sketched.where("s0 is not null").select("node", *_PARITIES), "node", "left")
    kept = ("node", "sim", "odd", "size", "g", "earlier", *_PARITIES)
    left = rows.select("run", "band", *[F.col(c).alias(f"l_{c}") for c in kept])
    right = rows.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    right = right.select("run", "band", *[F.col(c).alias(f"r_{c}") for c in kept])
    most = F.floor((1 - similarity) * F.greatest("l_size", "r_size") + 1e-9)
    bits = [F.bit_count(F.col(f"l_{n}").bitwiseXOR(F.col(f"r_{n}"))) for n in ("sim", "odd")]
    near = bits[0] + bits[1] <= (2 * most if distance is None else distance)
    near &= (F.abs(F.col("l_size") - F.col("r_size")) <= most) & (F.col("l_g") != F.col("r_g")) & (F.col("l_node") < F.col("r_node"))
    near &= F.coalesce(_apart("l_", "r_") <= 2 * most, F.lit(True)) & ~met_before("l_earlier", "r_earlier")
    joined = left.join(right, ["run", "band"]).where(near)
    return joined.select(F.col("l_node").alias("a"), F.col("r_node").alias("b")).distinct()


def _again(batches):
    """(id, lines) from (id, component, first, line) in this order: all lines but the first document's first one."""
    for doc, component, first, line in _whole(batches, ("id", "component", "first", "line")):
        fresh = np.append(True, (doc[1:] != doc[:-1]) | (component[1:] != component[:-1]))
        twice = ~fresh & np.append(False, line[1:] == line[:-1])  # rows that share an id
        gone = ~twice & ~(fresh & (doc == first))
        doc, line = doc[gone], line[gone]
        line = line[np.lexsort((line, doc))]  # documents stay as they are: each has its lines in the same places
        starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])[: len(doc)])
        lines = pa.ListArray.from_arrays(pa.array(np.append(starts, len(doc)), pa.int32()), pa.array(line))
        yield pa.RecordBatch.from_arrays([pa.array(doc[starts]), lines], names=["id", "lines"])


def _without(text_col: str, chars_col: str | None, fields: pa.Schema):
    counted = chars_col in fields.names

    def run(batches):
        for batch in batches:
            columns = {n: c for n, c in zip(batch.schema.names, batch.columns)}
            gone = columns.pop("__gone")
            if gone.null_count < len(gone):
                texts, sizes = columns[text_col].to_pylist(), columns[chars_col].to_pylist() if counted else []
                for i, numbers in enumerate(gone.to_pylist()):
                    if numbers:
                        drop = set(numbers)
                        texts[i] = "\n".join(line for j, line in enumerate(texts[i].split("\n")) if j not in drop)
                        if counted:
                            sizes[i] = len(texts[i])
                columns[text_col] = pa.array(texts, fields.field(text_col).type)
                if counted:
                    columns[chars_col] = pa.array(sizes, fields.field(chars_col).type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in fields.names], names=fields.names)

    return run


def removed_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", distance: int | None = DISTANCE,
                  similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, lines): the 0-based numbers of lines of a document that repeat an earlier one, near or exact."""
    if distance is not None and not 1 <= distance <= 7:
        raise ValueError("distance must be between 1 and 7 bits")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    read = _occurrences(min_words, None, WIDE, max(min_words, least_size(similarity))) if distance is None else _occurrences(min_words, simhash, min_words)
    fields = ", ".join(f"{f.name} {'binary' if f.name == 'counts' else 'long'}" for f in _OCCURRENCES)
    occurrences = materialize(texts.mapInArrow(read, fields), "occurrences")
    nodes = occurrences.where("node is not null").groupBy("node", "sim", "size").agg(F.min("id").alias("id"), F.count("*").alias("held"), *[F.max(n).alias(n) for n in _PARITIES])
    nodes = materialize(nodes, "nodes")
    groups = line_groups(texts, occurrences, nodes.where(F.col("size") >= least_size(similarity)).drop("held"), distance, similarity, min_words)
    alone = nodes.where("held > 1").join(groups, "node", "left_anti").select("node", F.col("node").alias("component"), F.col("id").alias("first"))
    linked = groups.join(nodes.select("node", "id"), "node")
    linked = groups.join(linked.groupBy("component").agg(F.min("id").alias("first")), "component").select("node", "component", "first")
    repeated = materialize(alone.unionByName(linked), "repeated")
    seen = occurrences.select("id", "line", "node").join(repeated, "node").select("id", "component", "first", "line")
    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return seen.repartition(width, "id").sortWithinPartitions("id", "component", "line").mapInArrow(_again, "id long, lines array<long>")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                distance: int | None = DISTANCE, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, lines_col: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``; repeated lines, near or exact, are gone from the texts.

    With ``distance=None`` every two lines within ``similarity`` link; a number
    compares only lines whose SimHashes differ in at most so many bits.

    Lines under ``min_words`` words stay, empty ones too. The first occurrence
    by (id, line number) stays, in a document as across documents. Two rows with
    one id and the same text are one document and keep the same lines; if their
    texts differ, line numbers removed from one are removed from both. A null id
    or null text is left as it is. ``chars_col``, if the table has it, follows
    the new text. ``lines_col`` adds the removed line numbers.
    """
    gone = removed_lines(docs, id_col=id_col, text_col=text_col, distance=distance, similarity=similarity, min_words=min_words)
    joined = docs.join(gone.select(F.col("id").alias("__id"), F.col("lines").alias("__gone")), F.col(id_col).cast("long") == F.col("__id"), "left").drop("__id")
    if lines_col:
        joined = joined.withColumn(lines_col, F.coalesce("__gone", F.array().cast("array<bigint>")))
    schema = joined.drop("__gone").schema
    from pyspark.sql.pandas.types import to_arrow_schema

    return joined.mapInArrow(_without(text_col, chars_col, to_arrow_schema(schema)), schema)
