"""Places in address cells: recognition, typing and replacement."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators.detector import Detector, detect, keep_span
from veilframe.operators.generators import fake_postal
from veilframe.operators.ledger import Ledger
from veilframe.operators.people import HINT_TYPE
from veilframe.operators.resolve import Resolution, resolve
from veilframe.operators.spans import priority_merge, splice_spans
from veilframe.session import materialize
from veilframe.sources.entity_map import clean

POSTAL_US = "(?<![0-9\\-])[0-9]{5}-[0-9]{4}(?![0-9\\-])|(?<![0-9\\-])[0-9]{5}(?![0-9\\-])"
POSTAL_UK = "\\b[A-Za-z]{1,2}[0-9][A-Za-z0-9]?\\s?[0-9][A-Za-z]{2}\\b"
POSTAL_SIX = "(?<![0-9\\-])[0-9]{6}(?:-[0-9]{3})?(?![0-9\\-])"
WORD = "[A-Za-z][A-Za-z'.\\-]*"
MAP_TYPES = {"country": "country", "location": "city", "region": "state_province", "address": "city"}
SPANS = "array<struct<start:int,end:int,type:string>>"


def match_spans(text: Column, pattern: str, ptype: str) -> Column:
    """All matches of a pattern as spans; offsets add up from gap and match lengths."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.coalesce(F.length(h), F.lit(0)).alias("hit")))
    none = F.array().cast(SPANS)
    walked = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["hit"]).cast("int").alias("at"),
            F.when(
                s["hit"] > 0,
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + s["gap"]).cast("int").alias("start"),
                            (acc["at"] + s["gap"] + s["hit"]).cast("int").alias("end"),
                            F.lit(ptype).alias("type"),
                        )
                    ),
                ),
            ).otherwise(acc["out"]).cast(SPANS).alias("out"),
        ),
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), walked["out"]).otherwise(none)


def postal_spans(text: Column) -> Column:
    """Postal codes: five digits with an optional four, British, six digits."""
    return F.concat(*[match_spans(text, p, "postal_code") for p in (POSTAL_US, POSTAL_UK, POSTAL_SIX)])


def world_places(spark: SparkSession, subdivisions: dict | None = None) -> DataFrame:
    """``nk, ptype`` of the bundled countries and subdivisions; a bounded table."""
    rows = [(form, "country") for c in (*C.COUNTRIES, *C.OTHER_COUNTRIES) for form in c]
    for places in (subdivisions or C.SUBDIVISIONS).values():
        for code, name in places:
            rows.append((name, "state_province"))
            if len(code) >= 2 and code.isalpha():
                rows.append((code, "state_province"))
    frame = spark.createDataFrame(rows, "name string, ptype string")
    return frame.select(X.normalize(F.col("name")).alias("nk"), "ptype").distinct()


def ambiguous_keys(world: DataFrame) -> DataFrame:
    """Keys that name both a country and a subdivision."""
    countries = world.where("ptype = 'country'").select("nk")
    return countries.intersect(world.where("ptype = 'state_province'").select("nk"))


def gazetteer(world: DataFrame, entity_map: DataFrame | None = None) -> DataFrame:
    """``nk, ptype, ambiguous``; pairs of the map win over the world, countries over subdivisions."""
    both = ambiguous_keys(world).withColumn("ambiguous", F.lit(True))
    ranked = world.withColumn("rank", F.when(F.col("ptype") == "country", 1).otherwise(2)).withColumn("id", F.lit(0).cast("bigint"))
    if entity_map is not None:
        types = X.literal_map(MAP_TYPES)
        own = clean(entity_map).where(~F.col("excluded") & F.col("label_cf").isin(*MAP_TYPES))
        ranked = ranked.unionByName(
            own.select("nk", F.element_at(types, F.col("label_cf")).alias("ptype"), F.lit(0).alias("rank"), -F.col("id")).toDF(
                "nk", "ptype", "rank", "id"
            )
        )
    best = ranked.groupBy("nk").agg(F.min_by("ptype", F.struct("rank", "id", "ptype")).alias("ptype"))
    return best.join(both, "nk", "left").select("nk", "ptype", F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"))


def short_code_ok(text: Column, start: Column, end: Column, tokens: Column) -> Column:
    """A short code counts only in an address-like place.

    The sole word of the cell, alone on its line, right after a comma, or right
    before a number of four to six digits.
    """
    before = F.substr(text, F.lit(1), start)
    after = F.substr(text, end + 1)
    alone = before.rlike("(?:^|\\n)[ \\t\\r]*$") & after.rlike("^[ \\t\\r]*(?:\\n|$)")
    return (tokens == 1) | alone | before.rlike(",\\s?$") | after.rlike("^\\s?[0-9]{4,6}\\b")


# The largest gazetteer that every task holds.
MOST_PLACES = 200_000
_FOUND = pa.schema([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string()), ("ambiguous", pa.bool_())])


@lru_cache(maxsize=1 << 16)
def _plain(char: str) -> str:
    """One character for one: without accent, lower case, any white space a space."""
    if char.isspace():
        return " "
    bare = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)).lower()
    return bare if len(bare) == 1 else char


class PlaceFinder:
    """Places in a trie over their words, as long as they are; ``found`` reads a text once."""

    def __init__(self, places: Iterable[tuple[str, str, bool]]):
        self.words, self.number = re.compile(WORD), re.compile(r"\s?[0-9]{4,6}(?!\w)")
        self.root: dict = {}
        for nk, ptype, ambiguous in places:
            spans = [m.span() for m in self.words.finditer(nk)]
            if spans and spans[0][0] == 0 and spans[-1][1] == len(nk):
                node = self.root
                for a, b in spans:
                    node = node.setdefault(nk[a:b], {})
                node.setdefault(None, {})[nk] = (ptype, ambiguous)

    def _trusted(self, text: str, start: int, end: int, lone: bool) -> bool:
        """Short codes count only where ``short_code_ok`` says so."""
        span = text[start:end]
        if len(span) > 3 or " " in span or lone or self.number.match(text, end):
            return True
        before, after = start, end
        if text[start - 1 : start] == "," or start > 1 and text[start - 1].isspace() and text[start - 2] == ",":
            return True
        while before and text[before - 1] in " \t\r":
            before -= 1
        while after < len(text) and text[after] in " \t\r":
            after += 1
        return (before == 0 or text[before - 1] == "\n") and (after == len(text) or text[after] == "\n")

    def found(self, text: str) -> list[tuple[int, int, str, bool]]:
        """``start, end, type, ambiguous``: the longest place from the left, then on behind it."""
        folded = "".join(map(_plain, text))
        spans = [m.span() for m in self.words.finditer(folded)]
        lone, out, done = len(spans) == 1, [], 0
        for at, (start, _) in enumerate(spans):
            if start < done:
                continue
            node, best, i = self.root, None, at
            while i < len(spans):
                a, end = spans[i]
                node = node.get(folded[a:end])
                if node is None:
                    break
                here = node.get(None)
                if here and (hit := here.get(" ".join(folded[start:end].split()))) and self._trusted(text, start, end, lone):
                    best = (start, end, *hit)
                i += 1
            if best:
                out.append(best)
                done = best[1]
        return out


def gazetteer_spans(texts: DataFrame, key: str, text: str, places: DataFrame) -> DataFrame:
    """``key, start, end, type, ambiguous``: runs of words that are known places; longest runs from the left win.

    A run may have as many words as a place of the gazetteer has. A gazetteer of
    bounded size goes to every task; of a larger one each text first gets the
    places whose first two words it holds, by an equi-join of slim rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = texts.schema[key].dataType
    schema = pa.schema([(key, to_arrow_type(kind)), *_FOUND])
    rows = texts.select(key, F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    known = places.select("nk", "ptype", "ambiguous")
    shared = None
    if known.limit(MOST_PLACES + 1).count() <= MOST_PLACES:
        shared = texts.sparkSession.sparkContext.broadcast([tuple(r) for r in known.collect()])  # of proven size
    else:
        known = known.withColumn("gram", F.array_join(F.slice(F.regexp_extract_all("nk", F.lit(WORD), F.lit(0)), 1, 2), " "))
        words = F.regexp_extract_all(X.normalize(F.col("_text")), F.lit(WORD), F.lit(0))
        pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
        grams = rows.select(key, F.explode(F.array_distinct(F.concat(words, pairs))).alias("gram"))
        held = grams.join(known, "gram").groupBy(key).agg(F.collect_set(F.struct("nk", "ptype", "ambiguous")).alias("_places"))
        rows = rows.join(held, key)

    def run(batches):
        finder, out = PlaceFinder(shared.value) if shared is not None else None, []
        for batch in batches:
            for i in range(batch.num_rows):
                use = finder
                if use is None:
                    use = PlaceFinder([(p["nk"], p["ptype"], p["ambiguous"]) for p in batch.column("_places")[i].as_py()])
                own = batch.column(key)[i].as_py()
                out += [(own, *hit) for hit in use.found(batch.column("_text")[i].as_py())]
                if len(out) >= 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, f"{key} {kind.simpleString()}, start int, end int, type string, ambiguous boolean")


def resolve_ambiguous(spans: Column, text: Column, ambiguous: Column, column: str | None, country: Column | None) -> Column:
    """Settle spans that may be a country or a subdivision.

    A country right behind it, a country in the row, or a state-like column name
    make it a subdivision; otherwise it is a country. Other spans keep their type.
    """
    state_column = bool(column and re.search(C.HINTS["state"], column, re.I))

    def typed(s: Column) -> Column:
        key = X.normalize(F.substr(text, s["start"] + 1, s["end"] - s["start"]))
        doubtful = s["type"].isin("country", "state_province") & F.array_contains(ambiguous, key)

        def follows(o: Column) -> Column:
            between = F.substr(text, s["end"] + 1, o["start"] - s["end"])
            return (o["type"] == "country") & (o["start"] >= s["end"]) & (o["start"] - s["end"] <= 3) & ~between.rlike("[A-Za-z0-9]")

        state = F.exists(spans, follows) | F.lit(state_column)
        if country is not None:
            state = state | F.coalesce(F.length(country) > 0, F.lit(False))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.when(doubtful, F.when(state, "state_province").otherwise("country")).otherwise(s["type"]).alias("type"),
        )

    return F.transform(spans, typed)


def reject_short(spans: Column, text: Column) -> Column:
    """Drop street suffixes and codes of up to three letters outside an address-like place."""
    tokens = F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))

    def fine(s: Column) -> Column:
        span = F.trim(F.substr(text, s["start"] + 1, s["end"] - s["start"]))
        short = s["type"].isin("city", "country", "state_province") & (
            F.lower(span).isin(*C.STREET_SUFFIXES) | (F.length(span) <= 3)
        )
        return ~short | short_code_ok(text, s["start"], s["end"], tokens)

    return F.filter(spans, fine)


STREET = (
    "(?is)^([0-9]+(?:st|nd|rd|th)?\\s+(?:(?:N|S|E|W|NE|NW|SE|SW)\\s+)?)(.*\\S)(\\s+[,.;:]*(?:"
    + "|".join(sorted(C.STREET_SUFFIXES, key=len, reverse=True))
    + ")[,.;:]*(?:\\s.*)?)$"
)


def street_parts(span: Column) -> Column:
    """``struct(head, name, tail)`` of a street address, null when it cannot be told apart.

    Head is house number and direction, tail the last street suffix and what follows.
    """
    parts = F.struct(
        F.regexp_extract(span, STREET, 1).alias("head"),
        F.regexp_extract(span, STREET, 2).alias("name"),
        F.regexp_extract(span, STREET, 3).alias("tail"),
    )
    return F.when(span.rlike(STREET), parts)


def geo_spans(
    texts: DataFrame,
    key: str,
    text: str,
    places: DataFrame,
    column: str | None = None,
    country: str | None = None,
    make_detector: Callable[[], Detector] | None = None,
) -> DataFrame:
    """``key, spans``: postal codes, then places, then detected spans, merged and typed."""
    located = gazetteer_spans(texts, key, text, places)
    grouped = located.groupBy(key).agg(
        F.collect_list(F.struct("start", "end", "type")).alias("g"),
    )
    frame = texts.join(grouped, key, "left")
    groups = [postal_spans(F.col(text)), F.coalesce("g", F.array().cast(SPANS))]
    if make_detector is not None:
        found = detect(texts, [key], text, make_detector, C.GEO_FLOORS, C.GEO_CALL_FLOOR)
        model = found.groupBy(key).agg(F.collect_list(F.struct("start", "end", "type")).alias("m"))
        frame = frame.join(model, key, "left")
        groups.append(F.coalesce("m", F.array().cast(SPANS)))
    # The ambiguous keys come from the bundled lists, so they fit a literal-sized array.
    doubtful = places.where("ambiguous").agg(F.collect_set("nk").alias("a")).scalar()
    merged = frame.withColumn("_doubtful", doubtful).withColumn("spans", priority_merge(groups, F.col(text)))
    merged = merged.withColumn("spans", reject_short(F.col("spans"), F.col(text)))
    merged = merged.withColumn(
        "spans", resolve_ambiguous(F.col("spans"), F.col(text), F.col("_doubtful"), column, F.col(country) if country else None)
    )
    return merged.select(key, "spans")


@dataclass
class Cells:
    """Address cells of a column: the distinct ones, and the pieces found in them."""

    texts: DataFrame
    pieces: DataFrame
    rid: Column

    def values(self) -> DataFrame:
        """The pieces in the shape ``resolve`` takes."""
        wanted = self.pieces.where("ptype <> 'postal_code'")
        grouped = wanted.groupBy("ptype", "original", "country").agg(F.count("*").alias("n"))
        role = F.when(F.col("ptype") == "person", "full").otherwise("")
        return grouped.select("ptype", role.alias("role"), "original", "country", F.array().cast(HINT_TYPE).alias("hints"), "n")


def read_composite(
    df: DataFrame,
    column: str,
    places: DataFrame,
    config: Config = DEFAULT,
    country: str | None = None,
    make_detector: Callable[[], Detector] | None = None,
    make_geo_detector: Callable[[], Detector] | None = None,
    value: Column | None = None,
) -> Cells:
    """What the address cells of a column hold.

    Standard entities win over places. A state goes with the country named in
    its cell, else with the row's. ``value`` stands in for the column.
    """
    from veilframe.operators.freetext import EMAIL

    value = F.col(column).cast("string") if value is None else value
    by = [value] + ([F.col(country).cast("string")] if country else [])
    rid = F.when(value.isNotNull(), F.sha2(F.concat_ws("\u0001", *by), 256))
    texts = df.where(value.isNotNull()).groupBy(rid.alias("_rid")).agg(
        F.any_value(value).alias("text"), F.count("*").alias("copies"),
        *([F.any_value(F.col(country).cast("string")).alias("_country")] if country else []),
    )
    texts = materialize(texts, "cells")
    geo = geo_spans(texts, "_rid", "text", places, column, "_country" if country else None, make_geo_detector)
    standard = match_spans(F.col("text"), EMAIL, "email")
    frame = texts.join(geo, "_rid", "left")
    if make_detector is not None:
        found = detect(texts, ["_rid"], "text", make_detector)
        located = found.join(texts.select("_rid", "text"), "_rid")
        before = F.when(F.col("start") > 0, F.substr("text", F.col("start"), F.lit(1))).otherwise("")
        after = F.substr("text", F.col("end") + 1, F.lit(1))
        kept = located.where(
            keep_span(F.col("span"), F.col("type"), config.generic_words, before=before, after=after) | (F.col("type") == "email")
        )
        grouped = kept.groupBy("_rid").agg(F.collect_list(F.struct("start", "end", "type")).alias("e"))
        frame = frame.join(grouped, "_rid", "left")
        standard = F.concat(standard, F.coalesce("e", F.array().cast(SPANS)))
    merged = frame.select(
        "_rid", "text", *(["_country"] if country else []),
        priority_merge([standard, F.coalesce("spans", F.array().cast(SPANS))], F.col("text")).alias("spans"),
    )
    # The first country behind a state names its country, else the last one before it, else the row's.
    named = F.filter("spans", lambda s: s["type"] == "country")

    def within(s: Column) -> Column:
        behind, ahead = F.filter(named, lambda c: c["start"] >= s["end"]), F.filter(named, lambda c: c["end"] <= s["start"])
        span = F.coalesce(F.try_element_at(F.array_sort(behind), F.lit(1)), F.try_element_at(F.array_sort(ahead), F.lit(-1)))
        own = F.substr("text", span["start"] + 1, span["end"] - span["start"])
        return F.coalesce(own, F.col("_country")) if country else own

    pieces = merged.select("_rid", F.explode("spans").alias("s"), "text", *(["_country"] if country else []), "spans").select(
        "_rid", "s.start", "s.end", "s.type", F.substr("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("span"),
        F.when(F.col("s.type") == "state_province", within(F.col("s"))).alias("country"),
    )
    pieces = pieces.withColumn("street", F.when(F.col("type") == "street_address", street_parts(F.col("span"))))
    pieces = pieces.withColumn(
        "ptype",
        F.when(F.col("street").isNotNull(), "street_name").when(F.col("type").isin("street_address", "city"), "location").otherwise(F.col("type")),
    ).withColumn("original", F.when(F.col("street").isNotNull(), F.col("street.name")).otherwise(F.col("span")))
    return Cells(texts, materialize(pieces, "pieces"), rid)


def rewrite_composite(df: DataFrame, cells: Cells, values: DataFrame, target: str, config: Config = DEFAULT) -> DataFrame:
    """``df`` with the scrubbed cells in ``target``; ``values`` holds the resolved pieces."""
    from veilframe.operators.joins import lookup

    wanted = F.coalesce("country", F.lit(""))
    table = values.groupBy("original", "ptype", wanted.alias("_within")).agg(F.min("fake").alias("_fake"), F.sum("n").alias("n"))
    pieces = cells.pieces.withColumn("_within", wanted)
    joined = lookup(pieces, table, ["original", "ptype", "_within"], weight="n")
    fake = (
        F.when(F.col("ptype") == "postal_code", fake_postal(F.col("span"), config))
        .when(F.col("street").isNotNull(), F.concat("street.head", F.coalesce("_fake", "original"), "street.tail"))
        .otherwise(F.coalesce("_fake", "span"))
    )
    spans = joined.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("start", "end", fake.alias("fake")))).alias("r"))
    spliced = cells.texts.join(spans, "_rid", "left").select(
        "_rid", F.when(F.col("r").isNull(), F.col("text")).otherwise(splice_spans(F.col("text"), F.col("r"))).alias("_scrubbed"), "copies"
    )
    back = lookup(df.withColumn("_rid", cells.rid), spliced, ["_rid"], weight="copies")
    out = X.apply_forced(F.col("_scrubbed"), config.forced_words, config.forced_word_boundary)
    return back.withColumn(target, out).drop("_rid", "_scrubbed")


def scrub_composite(
    df: DataFrame,
    column: str,
    places: DataFrame,
    entity_map: DataFrame | None = None,
    tokens: DataFrame | None = None,
    config: Config = DEFAULT,
    country: str | None = None,
    make_detector: Callable[[], Detector] | None = None,
    make_geo_detector: Callable[[], Detector] | None = None,
    ledger: Ledger | None = None,
) -> tuple[DataFrame, list[Resolution]]:
    """Address cells that mix places with names, companies, phones and addresses, replaced in one splice."""
    cells = read_composite(df, column, places, config, country, make_detector, make_geo_detector)
    answer = resolve(cells.values(), config=config, ledger=Ledger(entity_map, tokens) if ledger is None else ledger)
    answer.values = materialize(answer.values, "placed")
    return rewrite_composite(df, cells, answer.values, column, config).select(*df.columns), [answer]
