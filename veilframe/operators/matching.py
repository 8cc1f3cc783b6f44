"""Rewriting texts with a dictionary of any size, in one pass over each text.

Entries are kept in a trie over their words. A text is cut into words once; from
each word the trie is walked along the words that follow, so the work grows with
the text and not with the number of entries. Of the entries that stand at a place
the leftmost counts, then the longest. Han entries have no word bounds and are
found by an Aho-Corasick automaton over characters.

A dictionary of bounded size goes to every task as a whole, and texts are not
moved at all. Of a larger one each text first gets the entries whose words it
holds, by the equi-join of ``dictionary.found_entries``, and a trie of those.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions import text as X
from veilframe.operators import dictionary as D

# The largest dictionary that every task holds: entries, and characters of entries and fakes.
MOST_ENTRIES, MOST_CHARS = 200_000, 8 << 20
OUT_CHARS = 4 << 20  # of texts given back at once
REWRITTEN = "text string, count int, used array<string>"


def case_like(original: str, fake: str) -> str:
    """What ``functions.text.case_like`` does, for one string."""
    letters = "".join(c for c in original if "a" <= c <= "z" or "A" <= c <= "Z")
    if not letters:
        return fake
    if letters == letters.upper():
        return fake.upper()
    if letters == letters.lower():
        return fake.lower()
    if letters[0].isupper():
        return "".join(run[:1].upper() + run[1:].lower() for run in re.split("(?<=[^A-Za-z])(?=[A-Za-z])", fake))
    return fake


def _fold(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Matcher:
    """A dictionary ``entry_key -> fake`` ready to rewrite texts."""

    def __init__(self, entries: Iterable[tuple[str, str]], match: D.Match):
        import regex

        self.match = match
        self.words = regex.compile(match.token)
        self.tags = regex.compile(X.HTML_TAG) if match.avoid_tags else None
        self.fakes = dict(entries)
        self.root: dict = {}
        self.han = None
        han = regex.compile(X.HAN)
        loose = []
        for entry in self.fakes:
            if han.search(entry):
                loose.append(entry)
                continue
            spans = [m.span() for m in self.words.finditer(entry)]
            if not spans:
                continue
            node = self.root
            for a, b in spans:
                node = node.setdefault(entry[a:b], {})
            # By the characters before the first and behind the last word.
            node.setdefault(None, {})[entry] = (spans[0][0], len(entry) - spans[-1][1])
        if loose:
            import ahocorasick

            self.han = ahocorasick.Automaton()
            for entry in loose:
                self.han.add_word(entry, entry)
            self.han.make_automaton()

    def _tagged(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.tags.finditer(text)] if self.tags is not None else []

    def found(self, text: str) -> list[tuple[int, int, int, str]]:
        """``start, kind, -length, entry`` of every entry that may be replaced, in order."""
        folded = _fold(text) if self.match.ignore_case else text
        spans = [m.span() for m in self.words.finditer(folded)]
        out = []
        for at, (begin, _) in enumerate(spans):
            node, i = self.root, at
            while i < len(spans):
                node = node.get(folded[spans[i][0] : spans[i][1]])
                if node is None:
                    break
                for entry, (lead, trail) in node.get(None, {}).items():
                    start, end = begin - lead, spans[i][1] + trail
                    if start < 0 or folded[start:end] != entry:
                        continue
                    if (at and spans[at - 1][1] == start) or (i + 1 < len(spans) and spans[i + 1][0] == end):
                        continue
                    if self.match.avoid_at and (folded[start - 1 : start] == "@" or folded[end : end + 1] == "@"):
                        continue
                    out.append((start, 0, start - end, entry))
                i += 1
        if self.han is not None:
            out += [(last + 1 - len(entry), 1, -len(entry), entry) for last, entry in self.han.iter(folded)]
        return sorted(out)

    def rewrite(self, text: str, protect: frozenset[str] = frozenset()) -> tuple[str, list[str]]:
        """The new text, and the fakes that were put in."""
        tags, tag = self._tagged(text), 0
        pieces, used, done = [], [], 0
        for start, _, size, entry in self.found(text):
            while tag < len(tags) and tags[tag][1] <= start:
                tag += 1
            if start < done or entry.lower() in protect or tag < len(tags) and tags[tag][0] <= start:
                continue
            hit, fake = text[start : start - size], self.fakes[entry]
            fake = case_like(hit, fake) if self.match.case_adapt else fake
            pieces += [text[done:start], fake]
            used.append(fake)
            done = start - size
        return "".join([*pieces, text[done:]]), used


def is_bounded(prepared: DataFrame) -> bool:
    """Whether every task may hold the dictionary; its size is counted, not guessed."""
    size = prepared.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("entry_key") + F.length("fake")), F.lit(0)).alias("c")).first()
    return size["n"] <= MOST_ENTRIES and size["c"] <= MOST_CHARS


def _rewriter(matcher_of: Callable[[], Callable[[dict], Matcher | None]], key: str, kind: pa.DataType):
    schema = pa.schema([(key, kind), ("text", pa.string()), ("count", pa.int32()), ("used", pa.list_(pa.string()))])

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        choose, out, chars = matcher_of(), [], 0
        for rows in batches:
            for i in range(rows.num_rows):
                row = {name: rows.column(name)[i].as_py() for name in rows.schema.names}
                matcher, text = choose(row), row["_text"]
                new, used = (text, []) if matcher is None or text is None else matcher.rewrite(text, frozenset(row.get("_protect") or ()))
                out.append((row[key], new, len(used), used))
                chars += len(new or "")
                if chars > OUT_CHARS or len(out) >= 4096:
                    yield batch(out)
                    out, chars = [], 0
        if out:
            yield batch(out)

    return run


def rewritten(texts: DataFrame, key: str, text: str, prepared: DataFrame, match: D.Match, protect: str | None = None) -> DataFrame:
    """``key, text, count, used`` of every row: the text with its entries replaced, how many, and by what.

    ``prepared`` is what ``dictionary.prepare`` makes of a dictionary; ``protect``
    names an array column of folded texts that must not be replaced. A null text
    stays null. Every text is read whole and in one pass.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = texts.schema[key].dataType
    more = [F.col(protect).alias("_protect")] if protect else []
    rows = texts.select(key, F.col(text).alias("_text"), *more)
    if is_bounded(prepared):
        entries = [(r["entry_key"], r["fake"]) for r in prepared.select("entry_key", "fake").collect()]  # of proven size
        shared = texts.sparkSession.sparkContext.broadcast(entries)

        def whole():
            matcher = Matcher(shared.value, match)
            return lambda row: matcher

        chosen, matcher_of = rows, whole
    else:
        found = D.found_entries(texts.select(key, text), key, text, prepared, match).select(key, "entry_key", "fake").distinct()
        own = found.groupBy(key).agg(F.collect_list(F.struct("entry_key", "fake")).alias("_entries"))  # no more than the text holds
        chosen = rows.join(own, key, "left")

        def per_text():
            return lambda row: Matcher([(e["entry_key"], e["fake"]) for e in row["_entries"]], match) if row["_entries"] else None

        matcher_of = per_text
    return chosen.mapInArrow(_rewriter(matcher_of, key, to_arrow_type(kind)), f"{key} {kind.simpleString()}, {REWRITTEN}")
