"""Benchmark decontamination with an FM-index per training shard.

Each task reads its documents shard by shard (a bounded run of texts). Words
become symbols of the benchmark's alphabet; a word outside it can be in no
window, so it is only a break, and a run between breaks that is shorter than the
shortest window is left out. Over the rest the task builds a suffix array, its
Burrows-Wheeler transform as a wavelet matrix with rank tables, and sampled
suffix positions. All windows of the benchmark are searched backwards at once;
their occurrences are located by walking to the next sample; spans that touch
are merged.

The benchmark is the query set. It goes through the driver and to the tasks in
blocks of at most ``BLOCK_WORDS`` words (one block, unless the benchmark is
very large); every block is searched in every document in the same pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm import textbytes as tb

WINDOW_WORDS = 10
BLOCK_WORDS = 1 << 20
SHARD_BYTES = 16 << 20
SHARD_SYMBOLS = 1 << 19
SAMPLE_EVERY = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling. The last symbol must be the smallest and unique."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.zeros(n, np.int64)
    step = 1
    sorted_ = text[order]
    rank[order] = np.cumsum(np.append(0, sorted_[1:] != sorted_[:-1]))
    while rank[order[-1]] < n - 1:
        later = np.zeros(n, np.int64)
        later[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank[order] = np.cumsum(np.append(0, sorted_[1:] != sorted_[:-1]))
        step *= 2
    return order


class WaveletRanks:
    """A wavelet matrix with a rank table per level; all questions are answered for whole arrays."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.width, self.zeros, self.ranks = width, [], []
        for level in range(width - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ranks.append(np.append(0, np.cumsum(bit)).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        low, high = np.zeros_like(end), end
        for i, (ones, zeros) in enumerate(zip(self.ranks, self.zeros)):
            up = ((symbol >> (self.width - 1 - i)) & 1).astype(bool)
            low_ones, high_ones = ones[low], ones[high]
            low = np.where(up, zeros + low_ones, low - low_ones)
            high = np.where(up, zeros + high_ones, high - high_ones)
        return high - low

    def symbol_at(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ranks, self.zeros):
            here = ones[at]
            bit = ones[at + 1] - here
            out = out * 2 + bit
            at = np.where(bit == 1, zeros + here, at - here)
        return out


class FMIndex:
    """Backward search and location over a text of symbols 1..top (0 is added as its end)."""

    def __init__(self, symbols: np.ndarray, top: int):
        text = np.append(symbols, 0).astype(np.int64)
        suffixes = suffix_array(text)
        last = text[suffixes - 1]
        self.ranks = WaveletRanks(last, max(1, int(top).bit_length()))
        self.before = np.append(0, np.cumsum(np.bincount(text, minlength=top + 1)))
        self.size = len(text)
        sampled = suffixes % SAMPLE_EVERY == 0
        self.sampled, self.sample_rank = sampled, np.append(0, np.cumsum(sampled))
        self.samples = suffixes[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of the phrases (rows, padded on the left)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        columns = phrases.shape[1]
        for back in range(1, columns + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, columns - back]
            low[live] = self.before[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.ranks.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks: step back through the text to the next sample."""
        rows, out, todo, steps = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            here = rows[todo]
            done = self.sampled[here]
            out[todo[done]] = self.samples[self.sample_rank[here[done]]] + steps
            todo, here = todo[~done], here[~done]
            symbol = self.ranks.symbol_at(here)
            rows[todo] = self.before[symbol] + self.ranks.rank(symbol, here)
            steps += 1
        return out


class Phrases:
    """Distinct windows of benchmark items over an alphabet of word hashes."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        data, offsets = tb.flat(pa.array([text for _, text in items], pa.string()))
        hashes, starts, _ = tb.words(data, offsets, tb.NOT_ALNUM)
        bounds = tb.word_bounds(starts, offsets)
        self.words = np.unique(hashes)
        symbols = np.searchsorted(self.words, hashes) + 2  # 0 ends the text, 1 breaks it
        holders: dict[tuple[int, ...], set[str]] = {}
        for (item, _), a, b in zip(items, bounds[:-1].tolist(), bounds[1:].tolist()):
            row = symbols[a:b].tolist()
            for i in range(max(1, len(row) - window + 1) if row else 0):
                holders.setdefault(tuple(row[i : i + window]), set()).update([] if item is None else [item])
        self.lengths = np.array([len(w) for w in holders], np.int64)
        self.rows = np.zeros((len(holders), window), np.int64)
        for i, w in enumerate(holders):
            self.rows[i, window - len(w) :] = w
        self.holders = [sorted(h) for h in holders.values()]
        self.shortest = int(self.lengths.min()) if len(holders) else 0
        self.quick = np.zeros(1 << 16, bool)
        self.quick[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of the words; 1 for a word that no window has."""
        out = np.ones(len(hashes), np.int64)
        maybe = np.flatnonzero(self.quick[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.words, hashes[maybe])
        at[at == len(self.words)] = 0
        found = self.words[at] == hashes[maybe]
        out[maybe[found]] = at[found] + 2
        return out


def phrase_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Phrases]:
    """The benchmark's windows, at most about ``BLOCK_WORDS`` words of items at a time."""
    rows, held = [], 0
    chosen = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    for row in chosen.toLocalIterator():
        rows.append((row.id, row.text))
        held += 1 + len(row.text) // 5
        if held >= BLOCK_WORDS:
            yield Phrases(rows, window)
            rows, held = [], 0
    if rows:
        yield Phrases(rows, window)


class _Shard:
    """Words of a run of documents, reduced to what may hold a window of each block."""

    def __init__(self, blocks: list[Phrases]):
        self.blocks, self.docs, self.bytes = blocks, 0, 0
        self.parts: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in blocks]
        self.symbols = 0
        self.word_counts: list[np.ndarray] = []
        self.batches: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, part: pa.RecordBatch, text_col: str) -> None:
        data, offsets = tb.flat(part.column(text_col))
        hashes, starts, ends = tb.words(data, offsets, tb.NOT_ALNUM)
        bounds = tb.word_bounds(starts, offsets)
        doc = np.repeat(np.arange(part.num_rows), np.diff(bounds))
        kept = []
        for block, into in zip(self.blocks, self.parts):
            symbol = block.symbols(hashes)
            inside = np.flatnonzero(symbol > 1)
            if len(inside):
                # Runs of neighbouring words of one document that are all in the alphabet.
                new_run = np.append(True, (np.diff(inside) != 1) | (doc[inside][1:] != doc[inside][:-1]))
                run = np.cumsum(new_run) - 1
                inside = inside[np.bincount(run)[run] >= block.shortest]
            into.append((symbol[inside], inside - bounds[doc[inside]], doc[inside] + self.docs))
            self.symbols += len(inside)
            kept.append(inside)
        wanted = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
        # Byte places of the words that may be hit, relative to their text.
        places = np.stack([starts[wanted] - offsets[doc[wanted]], ends[wanted] - offsets[doc[wanted]]]) if len(wanted) else np.zeros((2, 0), np.int64)
        self.batches.append((part, doc[wanted] + self.docs, wanted - bounds[doc[wanted]] if len(wanted) else wanted, places))
        self.word_counts.append(np.diff(bounds))
        self.docs += part.num_rows
        self.bytes += len(data)

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or self.symbols >= SHARD_SYMBOLS

    def hits(self) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """(document, word) of every hit word, in order, and the items of each document."""
        docs, words = [], []
        items: list[set[str]] = [set() for _ in range(self.docs)]
        for block, parts in zip(self.blocks, self.parts):
            if not parts:
                continue
            symbol, word, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
            if not len(symbol):
                continue
            cut = np.flatnonzero((np.diff(word) != 1) | (np.diff(doc) != 0)) + 1
            place = np.arange(len(symbol)) + np.searchsorted(cut, np.arange(len(symbol)), "right")
            text = np.ones(len(symbol) + len(cut), np.int64)
            text[place] = symbol
            back = np.full(len(text), -1, np.int64)
            back[place] = np.arange(len(symbol))
            index = FMIndex(text, len(block.words) + 1)
            low, high = index.search(block.rows, block.lengths)
            count = high - low
            phrase = np.repeat(np.arange(len(count)), count)
            if not len(phrase):
                continue
            first = np.cumsum(count) - count
            at = index.locate(np.arange(len(phrase)) - np.repeat(first, count) + np.repeat(low, count))
            cover = np.zeros(len(text) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + block.lengths[phrase], -1)
            hit = back[np.flatnonzero(np.cumsum(cover)[:-1] > 0)]
            docs.append(doc[hit]), words.append(word[hit])
            pairs = np.unique(np.stack([doc[back[at]], phrase]), axis=1)
            for d, p in pairs.T.tolist():
                items[d].update(block.holders[p])
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), items
        both = np.unique(np.stack([np.concatenate(docs), np.concatenate(words)]), axis=1)
        return both[0], both[1], items

    def results(self, text_col: str) -> Iterator[tuple[pa.RecordBatch, list, list, list, list]]:
        """Per batch: n_words, n_hit, sorted items, merged spans (code points) of each row."""
        doc, word, items = self.hits()
        at = 0
        for (part, held_doc, held_word, places), counts in zip(self.batches, self.word_counts):
            low, high = np.searchsorted(doc, [at, at + part.num_rows])
            n_hit = np.bincount(doc[low:high] - at, minlength=part.num_rows)
            spans: list[list[tuple[int, int]]] = [[] for _ in range(part.num_rows)]
            if high > low:
                # Places of the hit words: held words are in (document, word) order, so are the hits.
                width = int(held_word.max()) + 2
                where = np.searchsorted(held_doc * width + held_word, doc[low:high] * width + word[low:high])
                begin, end = places[0][where], places[1][where]
                d, w = doc[low:high], word[low:high]
                new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (w[1:] != w[:-1] + 1)))
                last = np.append(new[1:], len(d)) - 1
                data, offsets = tb.flat(part.column(text_col))
                for row, a, b in zip((d[new] - at).tolist(), begin[new].tolist(), end[last].tolist()):
                    raw = data[offsets[row] : offsets[row] + b]
                    head = (raw & 0xC0) != 0x80
                    spans[row].append((int(head[:a].sum()), int(head.sum())))
            yield part, counts.tolist(), n_hit.tolist(), [sorted(s) for s in items[at : at + part.num_rows]], spans
            at += part.num_rows


def _passes(blocks: list[Phrases], text_col: str, emit):
    def run(batches):
        shard = _Shard(blocks)
        for batch in batches:
            for part in tb.slices(batch, text_col):
                shard.add(part, text_col)
                if shard.full():
                    yield from (emit(*found) for found in shard.results(text_col))
                    shard = _Shard(blocks)
        yield from (emit(*found) for found in shard.results(text_col))

    return run


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) for every row of ``docs``.

    ``items`` are the ids, as sorted strings, of benchmark items with a window
    in the text; ``spans`` the merged hit passages in code points. A null or
    empty text has no words. Repeated rows get the same answer each. Items
    without text or words match nothing; a null item id still marks words but is
    not listed. An empty benchmark hits nothing. Other columns are ignored.
    """
    blocks = [b for b in phrase_blocks(benchmark, item_col, item_text_col, window) if b.shortest]
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", SPANS),
    ])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def emit(part, n_words, n_hit, items, spans):
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
             pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span)],
            names=[id_col, "n_words", "n_hit", "items", "spans"],
        )

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(_passes(blocks, "__text", emit), schema)


def cut(text: str, spans: list[tuple[int, int]], filler: str = "\n") -> str:
    """The text without the spans; what stood around one is kept apart by the filler."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return filler.join(part.strip() for part in out if part.strip())


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", chars_col: str | None = "n_chars",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with the benchmark's passages cut from the text.

    A text without a hit, null included, is left as it is. A text that is
    nothing but benchmark passages becomes empty. ``chars_col``, if the table
    has it, follows the new text.
    """
    blocks = [b for b in phrase_blocks(benchmark, item_col, item_text_col, window) if b.shortest]
    counted = chars_col in docs.columns

    def emit(part, n_words, n_hit, items, spans):
        if not any(n_hit):
            return part
        columns = dict(zip(part.schema.names, part.columns))
        texts = [cut(t, s) if s else t for t, s in zip(columns[text_col].to_pylist(), spans)]
        columns[text_col] = pa.array(texts, part.schema.field(text_col).type)
        if counted:
            old = columns[chars_col].to_pylist()
            columns[chars_col] = pa.array([len(t) if s else o for t, s, o in zip(texts, spans, old)], part.schema.field(chars_col).type)
        return pa.RecordBatch.from_arrays([columns[n] for n in part.schema.names], schema=part.schema)

    return docs.mapInArrow(_passes(blocks, text_col, emit), docs.schema)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
