"""Organisation names and coded organisation values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.functions.seeds import _byte, _stream, characters, let, pick, seed
from veilframe.operators import chinese
from veilframe.operators.allocate import disambiguate, nowhere, word_tail
from veilframe.operators.generators import fake_acronym

RUN = "\\p{L}+"
CODE_RUN = "[A-Za-z]+"


def is_acronym(value: Column, config: Config = DEFAULT) -> Column:
    """A lone all-caps code of two to eight letters and digits."""
    core = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    lone = ~value.rlike("[ _]")
    cased = core.rlike("[A-Z]") & ~core.rlike("[a-z]")
    forced = [w.lower() for w in config.forced_words]
    open_ = ~X.word_key(value).isin(*forced) if forced else F.lit(True)
    return lone & cased & F.length(core).between(2, 8) & open_


def _caps_code(run: Column, *key) -> Column:
    """Random capitals of the same length; never the run itself."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    def spell(stream: Column) -> Column:
        # Each letter moves by 1 to 25, so none is kept.
        return F.array_join(
            F.transform(
                characters(run),
                lambda c, i: F.substr(
                    letters, F.pmod(F.instr(letters, c) + F.pmod(_byte(stream, i), F.lit(25)), F.lit(26)) + 1, F.lit(1)
                ),
            ),
            "",
        )

    return let(_stream(F.concat_ws("|", *key), F.length(run)), spell)


def _kept_word(word: Column) -> Column:
    return word.isin(*C.LEGAL_SUFFIXES, *C.FILLER_WORDS)


def _brand(run: Column, draw: Column) -> Column:
    """A head word that is not the run itself."""
    first = pick(draw, C.ORG_HEADS)
    return F.when(F.lower(first) == F.lower(run), pick(draw + 1, C.ORG_HEADS)).otherwise(first)


def org_candidate(value: Column, config: Config = DEFAULT) -> Column:
    """Structure-preserving fake of a Latin organisation name; not unique yet."""
    forced = {k.lower(): v for k, v in config.forced_words.items()}
    table = X.literal_map(forced) if forced else None

    def build(p: Column) -> Column:
        runs, nk = p["runs"], p["nk"]
        single = F.size(runs) <= 1

        def one(run: Column, at: Column) -> Column:
            low = F.lower(run)
            draw = seed(config.salt, "org", nk, at.cast("string"))
            head = _brand(run, draw)
            named = F.when(single, F.concat_ws(" ", head, pick(F.floor(draw / 7), C.ORG_TAILS))).otherwise(head)
            out = F.when(_kept_word(low), run).when(
                run.rlike("^[A-Z]{1,4}$"), _caps_code(run, F.lit(config.salt), F.lit("org"), nk, at.cast("string"))
            ).otherwise(X.case_like(run, named))
            if table is None:
                return out
            return F.when(
                F.map_contains_key(table, low), X.case_like(run, F.try_element_at(table, low))
            ).otherwise(out)

        fakes = F.transform(runs, one)
        pieces = F.zip_with(F.split(value, RUN, -1), fakes, lambda g, r: F.concat(g, F.coalesce(r, F.lit(""))))
        return F.array_join(pieces, "")

    # Bound once: the key is part of every draw.
    return let(F.struct(F.regexp_extract_all(value, F.lit(RUN), F.lit(0)).alias("runs"), X.normalize(value).alias("nk")), build)


def org_fakes(
    values: DataFrame,
    used: DataFrame | None = None,
    marks: DataFrame | None = None,
    config: Config = DEFAULT,
    with_han: bool = True,
    hot: bool = True,
) -> DataFrame:
    """``nk -> fake, placed`` for distinct organisations ``nk, canon``.

    Han names draw from their own pool, acronyms go through a bijection, all
    others are rebuilt run by run and then made unique. ``with_han`` is false
    when no value has Han text.
    """
    trimmed = values.withColumn("canon", F.trim("canon"))
    han = trimmed.where(X.is_han(F.col("canon")))
    rest = trimmed.where(~X.is_han(F.col("canon"))).withColumn("_acronym", is_acronym(F.col("canon"), config))
    acronyms = rest.where("_acronym").select("nk", fake_acronym(F.col("canon"), config).alias("fake"), nowhere().alias("placed"))
    drafted = rest.where(~F.col("_acronym")).select("nk", "canon", org_candidate(F.col("canon"), config).alias("fake"))
    # Names made of kept words only have nothing to hide and stay as they are.
    moved = F.lower("fake") != F.lower("canon")
    plain = disambiguate(drafted.where(moved).select("nk", "fake"), "fake", "nk", word_tail, used, marks, hot)
    kept = drafted.where(~moved).select("nk", "fake", nowhere().alias("placed"))
    out = acronyms.unionByName(plain).unionByName(kept)
    return out.unionByName(chinese.han_orgs(han, used, marks)) if with_han else out


def segment_fake(word: Column, config: Config = DEFAULT) -> Column:
    """Fake of one word of a coded value, seeded on the word, so it repeats with it."""
    forced = {k.lower(): v for k, v in config.forced_words.items()}
    table = X.literal_map(forced) if forced else None

    def build(p: Column) -> Column:
        run, nk, low = p["word"], p["nk"], F.lower(p["word"])
        draw = seed(config.salt, "segment", nk)
        out = (
            F.when(_kept_word(low), run)
            .when(run.rlike("^[A-Z]{1,4}$"), _caps_code(run, F.lit(config.salt), F.lit("segment"), nk))
            .otherwise(X.case_like(run, _brand(run, draw)))
        )
        if table is None:
            return out
        return F.when(F.map_contains_key(table, low), X.case_like(run, F.try_element_at(table, low))).otherwise(out)

    return let(F.struct(word.alias("word"), X.normalize(word).alias("nk")), build)


def match_code_prefix(words: DataFrame, codes: DataFrame) -> DataFrame:
    """Longest known code that starts an all-caps word: ``word -> code, code_fake``.

    Prefixes of four to eight letters are looked up with one equi-join.
    """
    prefixes = words.where(F.col("word").rlike("^[A-Z]{4,}$")).select(
        "word",
        F.explode(
            F.transform(F.sequence(F.lit(4), F.least(F.length("word"), F.lit(8))), lambda n: F.substr("word", F.lit(1), n))
        ).alias("code"),
    )
    hits = prefixes.join(codes.select("code", F.col("fake").alias("code_fake")), "code")
    best = hits.groupBy("word").agg(F.max_by(F.struct("code", "code_fake"), F.length("code")).alias("r"))
    return best.select("word", "r.code", "r.code_fake")


def org_code_fakes(
    values: DataFrame, codes: DataFrame | None, used: DataFrame | None = None, config: Config = DEFAULT, marks: DataFrame | None = None
) -> DataFrame:
    """``nk -> fake, placed`` for coded values with several letter runs.

    A repeated word gets the same fake wherever it stands, and a known code at
    the start of an all-caps word keeps its fake.
    """
    pieces = values.select("nk", F.posexplode(F.regexp_extract_all("canon", F.lit(CODE_RUN), F.lit(0))).alias("pos", "word"))
    words = pieces.groupBy("word").agg(F.count("*").alias("n"))
    if codes is not None:
        known = words.join(match_code_prefix(words, codes), "word", "left")
        rest = F.substr("word", F.length("code") + 1)
        start = X.case_like(F.col("code"), F.col("code_fake"))
        fake = (
            F.when(F.col("code").isNull(), segment_fake(F.col("word"), config))
            .when(rest == "", start)
            .otherwise(F.concat(start, segment_fake(rest, config)))
        )
    else:
        known, fake = words, segment_fake(F.col("word"), config)
    from veilframe.operators.joins import lookup

    table = known.select("word", fake.alias("_f"), "n")
    joined = lookup(pieces, table, ["word"], weight="n")
    grouped = joined.groupBy("nk").agg(F.array_sort(F.collect_list(F.struct("pos", "_f"))).alias("fakes"))
    drafted = values.join(grouped, "nk").select(
        "nk",
        F.array_join(
            F.zip_with(F.split("canon", CODE_RUN, -1), F.col("fakes"), lambda g, f: F.concat(g, F.coalesce(f["_f"], F.lit("")))),
            "",
        ).alias("fake"),
    )
    return disambiguate(drafted, "fake", "nk", word_tail, used, marks)


def is_coded(value: Column) -> Column:
    """Several letter runs and no Han text."""
    return (F.size(F.regexp_extract_all(value, F.lit(CODE_RUN), F.lit(0))) > 1) & ~X.is_han(value)


