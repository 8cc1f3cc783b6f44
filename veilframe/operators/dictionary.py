"""Finding and replacing dictionary entries in text.

Which entries a text contains is found by an equi-join on n-grams of words. The
n-grams pass a fixed-size bitmap of the dictionary's keys before they leave the
map side, so what is shuffled is about as much as there is to find. The texts
are then rewritten by ``matching``, with a trie over words; maps of a few entries,
such as those of one text or of the configuration, are applied as expressions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions import text as X
from veilframe.session import materialize

MAX_WORDS = 6
# The bitmap grows with the dictionary up to four million bits, then it only gets less selective.
LEAST_BITMAP, MOST_BITMAP = 1 << 10, 1 << 16
HAN_RUN = "[\\u4e00-\\u9fff]+"
HAN_LENGTHS = (1, 2, 3, 4, 5, 6)


@dataclass(frozen=True)
class Match:
    """How an entry must stand in the text."""

    bounds: str = "A-Za-z0-9"
    ignore_case: bool = True
    avoid_tags: bool = False
    avoid_at: bool = False
    case_adapt: bool = False
    min_length: int = 1

    @property
    def token(self) -> str:
        return f"[{self.bounds}]+"


# Literal maps in free text: ASCII word bounds, prose only, never next to an @.
LITERAL = Match(avoid_tags=True, avoid_at=True, case_adapt=True, min_length=3)
EXACT_CODES = Match(avoid_tags=True, avoid_at=True, min_length=3)
# Whole-map scrub: letters and digits of any script bound a match.
MAP_SCRUB = Match(bounds="\\p{L}\\p{N}")
# Known names: exact spelling between non-letters.
KNOWN = Match(bounds="A-Za-z", ignore_case=False)


def fold(value: Column, match: Match) -> Column:
    return F.lower(value) if match.ignore_case else value


def _keys(text: Column, match: Match) -> Column:
    return F.regexp_extract_all(fold(text, match), F.lit(match.token), F.lit(0))


def prepare(dictionary: DataFrame, match: Match) -> DataFrame:
    """``entry, fake -> key, words, entry_key``; one row per folded entry, the smallest fake wins.

    ``key`` is the first ``MAX_WORDS`` words; longer entries are told apart when
    the text is rewritten, which compares them whole. Han entries have no word
    bounds: their key is the entry, or its first characters.
    """
    rows = dictionary.where(F.length("entry") >= match.min_length).withColumn("entry_key", fold(F.col("entry"), match))
    rows = rows.groupBy("entry_key").agg(F.min(F.struct("entry", "fake")).alias("r")).select("entry_key", "r.entry", "r.fake")
    han = X.is_han(F.col("entry"))
    tokens = _keys(F.col("entry"), match)
    run = F.regexp_extract(F.col("entry"), HAN_RUN, 0)
    keyed = rows.withColumn("words", F.when(han, -F.least(F.length(run), F.lit(max(HAN_LENGTHS)))).otherwise(F.least(F.size(tokens), F.lit(MAX_WORDS))))
    return keyed.withColumn(
        "key",
        F.when(han, F.substr(run, F.lit(1), -F.col("words"))).otherwise(F.array_join(F.slice(tokens, 1, MAX_WORDS), " ")),
    ).where(F.col("words") != 0)


def _bit(parts: list[Column], words: int) -> Column:
    """Bit of a key, hashed from its parts so that no key text has to be built."""
    return F.pmod(F.xxhash64(*parts), F.lit(words * 64))


def _words_at(tokens: Column, start: Column, count: int) -> list[Column]:
    return [F.element_at(tokens, (start + i).cast("int")) for i in range(count)]


def _prepared_bit(size: int, lengths: list[int]) -> Column:
    tokens = F.split("key", " ")
    out = F.when(F.col("words") < 0, _bit([F.col("key")], size))
    for count in (n for n in lengths if n > 0):
        out = out.when(F.col("words") == count, _bit(_words_at(tokens, F.lit(1), count), size))
    return out


def bitmap(prepared: DataFrame) -> tuple[list[int], list[int]]:
    """Key bitmap and the n-gram lengths in use; bounded, whatever the dictionary."""
    lengths = {r["words"]: r["n"] for r in prepared.groupBy("words").agg(F.count("*").alias("n")).collect()}
    size = LEAST_BITMAP
    while size < MOST_BITMAP and size * 8 < sum(lengths.values()):
        size *= 2
    bits = (
        prepared.select(_prepared_bit(size, list(lengths)).alias("b"))
        .groupBy(F.floor(F.col("b") / 64).cast("int").alias("w"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("b", F.lit(64)).cast("int"))).alias("v"))
        .collect()
    )
    words = [0] * size
    for row in bits:
        words[row["w"]] = row["v"]
    return words, sorted(lengths)


def candidate_keys(text: Column, match: Match, filter_words: list[int], lengths: list[int]) -> Column:
    """Distinct n-grams of the text that the bitmap lets through."""
    table = F.from_json(F.lit(json.dumps(filter_words)), "array<bigint>")

    def passes(parts: list[Column]) -> Column:
        bit = _bit(parts, len(filter_words))
        return F.bit_get(F.element_at(table, (F.floor(bit / 64) + 1).cast("int")), F.pmod(bit, F.lit(64)).cast("int")) == 1

    def of_words(tokens: Column, count: int) -> Column:
        if count == 1:
            return F.filter(F.array_distinct(tokens), lambda t: passes([t]))
        starts = F.filter(
            F.sequence(F.lit(1), F.size(tokens) - (count - 1)), lambda i: passes(_words_at(tokens, i, count))
        )
        grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, count), " "))
        return F.when(F.size(tokens) >= count, grams).otherwise(F.array().cast("array<string>"))

    def of_characters(runs: Column, count: int) -> Column:
        grams = F.flatten(
            F.transform(
                F.filter(runs, lambda r: F.length(r) >= count),
                lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - (count - 1)), lambda i: F.substr(r, i, F.lit(count))),
            )
        )
        return F.filter(grams, lambda g: passes([g]))

    wanted = [n for n in lengths if n > 0]
    han = [-n for n in lengths if n < 0]
    parts = []
    if wanted:
        parts.append(X.let(_keys(text, match), lambda t: F.concat(*[of_words(t, n) for n in wanted])))
    if han:
        runs = F.regexp_extract_all(text, F.lit(HAN_RUN), F.lit(0))
        parts.append(X.let(runs, lambda r: F.concat(*[of_characters(r, n) for n in han])))
    if not parts:
        return F.array().cast("array<string>")
    return F.array_distinct(F.concat(*parts))


def found_entries(texts: DataFrame, key: str, text: str, prepared: DataFrame, match: Match) -> DataFrame:
    """``key, entry_key, entry, fake`` for entries whose words occur in a text."""
    filter_words, lengths = bitmap(prepared)
    grams = texts.select(key, F.explode(candidate_keys(F.col(text), match, filter_words, lengths)).alias("key_gram"))
    entries = prepared.select(F.col("key").alias("key_gram"), "entry_key", "entry", "fake")
    return grams.join(entries, "key_gram").select(key, "entry_key", "entry", "fake")


def entry_map(found: DataFrame, key: str) -> DataFrame:
    """One map per text, ``key -> entries``; a map holds no more than its text does."""
    return found.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("entry_key", "fake"))).alias("entries")
    )


def _pattern(entries: Column, match: Match) -> Column:
    """Alternation of a text's entries, longest first, with their bounds."""
    ordered = F.array_sort(
        F.map_keys(entries),
        lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0),
    )
    at = "@" if match.avoid_at else ""
    han = F.filter(ordered, X.is_han)
    worded = F.filter(ordered, lambda e: ~X.is_han(e))

    def joined(entries_: Column) -> Column:
        return F.array_join(F.transform(entries_, X.quote_pattern), "|")

    # The bounds stand around the whole group, so they are tested once per position.
    open_, close = F.lit(f"(?<![{match.bounds}{at}])(?:"), F.lit(f")(?![{match.bounds}{at}])")
    body = F.concat_ws(
        "|",
        F.when(F.size(worded) > 0, F.concat(open_, joined(worded), close)),
        F.when(F.size(han) > 0, joined(han)),
    )
    flags = "(?iu)" if match.ignore_case else ""
    tags = f"{X.HTML_TAG}|" if match.avoid_tags else ""
    return F.concat(F.lit(flags + tags), F.lit("(?:"), body, F.lit(")"))


def rewrite_entries(text: Column, entries: Column, match: Match, protect: Column | None = None) -> Column:
    """``struct(text, count)``: one text rewritten with its own entries, leftmost, then longest.

    Markup is consumed as whole tags first, so nothing inside a tag is touched.
    ``protect`` lists folded fakes that must not be faked again.
    """
    usable = entries
    if protect is not None:
        usable = F.map_filter(entries, lambda k, v: ~F.array_contains(protect, F.lower(k)))
    unchanged = F.struct(text.alias("text"), F.lit(0).alias("count"))

    def rewritten(p: Column) -> Column:
        table, pattern = p["table"], p["pattern"]

        def fakes(hits: Column) -> Column:
            def one(hit: Column) -> Column:
                fake = F.try_element_at(table, fold(hit, match))
                return X.case_like(hit, fake) if match.case_adapt else fake

            return F.zip_with(hits, F.transform(hits, one), lambda h, f: F.struct(h.alias("hit"), f.alias("fake")))

        def put(pairs: Column) -> Column:
            pieces = F.zip_with(
                F.split(text, pattern, -1), pairs,
                lambda gap, p_: F.concat(gap, F.coalesce(p_["fake"], p_["hit"], F.lit(""))),
            )
            return F.struct(
                F.array_join(pieces, "").alias("text"),
                F.size(F.filter(pairs, lambda p_: p_["fake"].isNotNull())).alias("count"),
            )

        hits = F.regexp_extract_all(text, pattern, F.lit(0))
        return X.let(fakes(hits), put)

    def run(table: Column) -> Column:
        bound = F.struct(table.alias("table"), _pattern(table, match).alias("pattern"))
        return F.when(F.size(table) > 0, X.let(bound, rewritten)).otherwise(unchanged)

    return F.when(F.coalesce(F.size(entries), F.lit(0)) <= 0, unchanged).otherwise(X.let(usable, run))


def replace_entries(text: Column, entries: Column, match: Match, protect: Column | None = None) -> Column:
    """The rewritten text of :func:`rewrite_entries`."""
    return rewrite_entries(text, entries, match, protect)["text"]


def count_entries(text: Column, entries: Column, match: Match) -> Column:
    """Number of occurrences :func:`rewrite_entries` would replace."""

    def run(table: Column) -> Column:
        hits = F.regexp_extract_all(text, _pattern(table, match), F.lit(0))
        return F.size(F.filter(hits, lambda h: F.map_contains_key(table, fold(h, match))))

    return F.when(F.coalesce(F.size(entries), F.lit(0)) <= 0, F.lit(0)).otherwise(X.let(entries, run))


def scrub_with_map(
    df: DataFrame,
    column: str,
    dictionary: DataFrame,
    match: Match = MAP_SCRUB,
    width: int | None = None,
    rounds: int = 1,
) -> DataFrame:
    """Replace every dictionary entry in a text column; adds ``replacements`` and ``skipped``.

    Each distinct text is searched and rewritten once a round, in one pass. A text that would
    outgrow the column stays as it is and is marked ``skipped``. More ``rounds``
    catch entries that only appear in the rewritten text.
    """
    from veilframe.operators.matching import is_bounded, rewritten

    prepared = materialize(prepare(dictionary, match), "prepared")
    out = df.withColumn("_rid", F.sha2(F.col(column), 256))
    texts = out.where(F.col(column).isNotNull()).groupBy("_rid").agg(F.min(column).alias("_new")).withColumn("_count", F.lit(0))
    current = materialize(texts, "texts") if rounds > 1 or not is_bounded(prepared) else texts
    for turn in range(rounds):
        done = rewritten(current, "_rid", "_new", prepared, match).select("_rid", F.col("text").alias("_new"), F.col("count").alias("_more"))
        if turn == 0:
            current = done.withColumnRenamed("_more", "_count")
        else:
            current = done.join(current.select("_rid", "_count"), "_rid").select("_rid", "_new", (F.col("_count") + F.col("_more")).alias("_count"))
        if turn + 1 < rounds:
            current = materialize(current, "round")
    changed = current.where("_count > 0").select("_rid", "_new", "_count")
    joined = out.join(changed, "_rid", "left")
    fits = F.lit(True) if width is None else F.length("_new") <= width
    hit = F.col("_count").isNotNull()
    return joined.select(
        *[
            F.when(hit & fits, F.col("_new")).otherwise(F.col(column)).alias(column) if c == column else F.col(c)
            for c in df.columns
        ],
        F.when(hit & fits, F.col("_count")).otherwise(0).alias("replacements"),
        (hit & ~fits).alias("skipped"),
    )


def map_dictionary(entity_map: DataFrame, phones: bool = False) -> DataFrame:
    """Entries of the map that are safe to replace blindly: full names, companies, addresses."""
    from veilframe.sources.entity_map import clean

    rows = clean(entity_map).where(F.col("fake_cf") != F.lower(F.trim("original")))
    size = F.length("original")
    safe = (
        ((F.col("label_cf") == "names") & F.contains("original", F.lit(" ")) & (size >= 6))
        | ((F.col("label_cf") == "companyname") & (size >= 5))
        | (F.col("label_cf") == "email")
    )
    if phones:
        safe = safe | ((F.col("label_cf") == "phone") & (size >= 7))
    first = rows.where(safe).groupBy(F.lower("original").alias("_k")).agg(F.min_by(F.struct("original", "fake"), "id").alias("r"))
    return first.select(F.col("r.original").alias("entry"), F.col("r.fake").alias("fake"))


def scrub_statistics(scrubbed: DataFrame) -> DataFrame:
    """Cells changed, replacements made, cells skipped because they would not fit."""
    return scrubbed.agg(
        F.count(F.when(F.col("replacements") > 0, 1)).alias("cells_changed"),
        F.coalesce(F.sum("replacements"), F.lit(0)).cast("bigint").alias("replacements"),
        F.count(F.when(F.col("skipped"), 1)).alias("skipped_overflow"),
    )
