"""Injective allocation without a global order.

Nothing here ranks all values in one task. Values are numbered inside hash
buckets, and ``rank * buckets + bucket`` is a number no other value has. Numbers
are spelled as words, so a fake is a function of a slot and slots never meet.
Pairs that exist already are never moved: *marks* keep, per family of slots and
bucket, the rank the next value gets, and every later call or run goes on there.
What a call hands out is told in a column ``placed`` beside its fakes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.functions.seeds import literal_array, seed
from veilframe.functions.text import literal_map
from veilframe.operators.joins import bucket_of, lookup

BUCKETS = 1024


def dense_ids(df: DataFrame, key: str, start: Column | int = 0, name: str = "id", buckets: int = 256) -> DataFrame:
    """Consecutive numbers after ``start`` in the order of ``(bucket, digest)``.

    Only the bucket counts (at most ``buckets`` rows) are ordered globally.
    """
    filed = df.withColumn("_b", bucket_of(F.col(key), buckets)).withColumn("_h", F.sha2(F.col(key), 256))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        filed.groupBy("_b").agg(F.count("*").alias("_n"))
        .select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    base = start if isinstance(start, Column) else F.lit(start)
    return (
        filed.join(F.broadcast(offsets), "_b")
        .withColumn(name, (base + F.col("_offset") + rank).cast("bigint"))
        .drop("_b", "_h", "_offset")
    )


PLACED = "array<struct<family:string,slot:bigint>>"
MARKS = "family string, bucket int, next bigint"


def nowhere() -> Column:
    """``placed`` of a fake that used no slot."""
    return F.array().cast(PLACED)


def placed_at(family: Column, slot: Column) -> Column:
    return F.array(F.struct(family.alias("family"), slot.cast("bigint").alias("slot"))).cast(PLACED)


def marks_of(placed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``family, bucket, next`` behind all slots of a ``placed`` column."""
    each = placed.select(F.explode("placed").alias("p")).select("p.family", "p.slot")
    rank = (F.col("slot") - F.pmod("slot", F.lit(buckets))) / buckets
    return each.groupBy("family", F.pmod("slot", F.lit(buckets)).cast("int").alias("bucket")).agg(
        (F.max(rank).cast("bigint") + 1).alias("next")
    )


def counted_marks(rows: DataFrame, family: Column, by: list[str], key: str, buckets: int = BUCKETS) -> DataFrame:
    """Marks behind values of which only the keys are known: no bucket has used more ranks than it has keys."""
    return rows.groupBy(family.alias("family"), bucket_of(F.concat_ws("|", *by, key), buckets).alias("bucket")).agg(
        F.count_distinct(key).cast("bigint").alias("next")
    )


def merged_marks(*parts: DataFrame | None) -> DataFrame | None:
    """The furthest mark of each family and bucket."""
    known = [p for p in parts if p is not None]
    if not known:
        return None
    out = known[0]
    for part in known[1:]:
        out = out.unionByName(part)
    return out.groupBy("family", "bucket").agg(F.max("next").alias("next")) if len(known) > 1 else out


def slots(
    df: DataFrame, by: list[str], key: str, marks: DataFrame | None = None, family: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Add ``slot``, unique per group ``by``, and ``placed``.

    ``marks`` (``family, bucket, next``) say where earlier calls ended; ``family``
    is the name of the row's group there, the values of ``by`` by default.
    """
    filed = df.withColumn("_b", bucket_of(F.concat_ws("|", *by, key), buckets)).withColumn(
        "_h", F.sha2(F.concat_ws("|", F.lit("slot"), *by, key), 256)
    ).withColumn("_family", F.concat_ws("|", *by) if family is None else family)
    rank = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h", key)) - 1
    if marks is None:
        used = F.lit(0)
    else:
        before = marks.select(F.col("family").alias("_family"), F.col("bucket").alias("_b"), F.col("next").alias("_used"))
        filed = filed.join(before, ["_family", "_b"], "left")
        used = F.coalesce(F.col("_used"), F.lit(0))
    placed = filed.withColumn("slot", ((rank + used) * buckets + F.col("_b")).cast("bigint"))
    return placed.withColumn("placed", placed_at(F.col("_family"), F.col("slot"))).drop("_b", "_h", "_used", "_family")


def _whole(a: Column, size: int) -> Column:
    """Whole-number quotient of a non-negative number; exact for every long."""
    return ((a - F.pmod(a, F.lit(size))).cast("decimal(20,0)") / size).cast("bigint")


def digits(number: Column, size: int) -> Column:
    """Bijective digits of a number, least significant first; none below zero.

    There are ``size`` one-digit numbers, then ``size ** 2`` of two digits and so
    on; the length follows the number, so no long is too large.
    """
    start = F.struct(number.cast("bigint").alias("rest"), F.array().cast("array<bigint>").alias("out"))

    def step(state: Column, _: Column) -> Column:
        rest, out = state["rest"], state["out"]
        more = rest >= 0
        return F.struct(
            F.when(more, _whole(rest, size) - 1).otherwise(rest).alias("rest"),
            F.when(more, F.array_append(out, F.pmod(rest, F.lit(size)).cast("bigint"))).otherwise(out).alias("out"),
        )

    most = next(n for n in range(1, 65) if sum(size**i for i in range(1, n + 1)) >= 1 << 63)
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda state: state["out"])


def words_of(number: Column, words: Sequence[str], joiner: str) -> Column:
    """Spell a non-negative number with words, least significant first.

    Bijective numeration: 0 is the first word, ``n`` words give ``n`` one-word
    spellings, then the two-word ones follow. No two numbers share a spelling.
    """
    pool = literal_array(words)
    return F.array_join(F.transform(digits(number, len(words)), lambda d: F.element_at(pool, (d + 1).cast("int"))), joiner)


def syllable(number: Column) -> Column:
    """One of 80 consonant-vowel syllables, for a number from 0 to 79."""
    onset = F.substr(F.lit(C.ONSETS), (F.floor(number / 5) + 1).cast("int"), F.lit(1))
    vowel = F.substr(F.lit(C.VOWELS), (F.pmod(number, F.lit(5)) + 1).cast("int"), F.lit(1))
    return F.concat(onset, vowel)


SHORT_NAMES = 80 * 80 * 8


def spelled_name(slot: Column, endings: Sequence[str]) -> Column:
    """An invented name for a slot: two syllables and an ending, more syllables beyond 51,200 slots.

    Endings start with a consonant that no vowel follows, so a name can be read
    back in one way only and different slots give different names.
    """
    # A multiplier coprime to the block size scatters neighbouring slots.
    inner = F.pmod(F.pmod(slot, F.lit(SHORT_NAMES)) * 26347 + 9173, F.lit(SHORT_NAMES))
    first = F.pmod(inner, F.lit(80))
    pieces = [
        F.upper(F.substr(F.lit(C.ONSETS), (F.floor(first / 5) + 1).cast("int"), F.lit(1))),
        F.substr(F.lit(C.VOWELS), (F.pmod(first, F.lit(5)) + 1).cast("int"), F.lit(1)),
        syllable(F.pmod(F.floor(inner / 80), F.lit(80))),
    ]
    beyond = F.transform(digits(_whole(slot, SHORT_NAMES) - 1, 80), syllable)
    pieces.append(F.when(slot < SHORT_NAMES, F.lit("")).otherwise(F.array_join(beyond, "")))
    pieces.append(F.element_at(literal_array(endings), (F.floor(inner / 6400) + 1).cast("int")))
    return F.concat(*pieces)


def free_words(pool: DataFrame, used: DataFrame | None, words: Sequence[str], word: str = "word") -> DataFrame:
    """Rows whose pool word no earlier pair has taken.

    The ledger is cut down to the words of the pool first, so the side that is
    broadcast has at most as many rows as the pool has words.
    """
    if used is None:
        return pool
    lowered = sorted({w.lower() for w in words})
    blocked = used.where(F.col("fake_cf").isin(lowered)).select(F.col("fake_cf").alias("_cf")).distinct()
    return pool.join(F.broadcast(blocked), F.lower(F.col(word)) == F.col("_cf"), "left_anti")


CHOICES = 4


def pool_pick(
    values: DataFrame, pools: dict[str, Sequence[str]], tag: str, used: DataFrame | None = None
) -> DataFrame:
    """Give values words of a small pool, each word to at most one value.

    ``values`` has ``nk`` (unique) and ``pool`` (a key of ``pools``). Each value
    names a few words it would take, in order. The keenest claim on a word wins
    it, and a value keeps the first word it won. Both steps are plain aggregates
    with map-side combine. Returns ``values`` with ``word``, null for those that
    won none.
    """
    table = F.from_json(F.lit(json.dumps({k: list(w) for k, w in pools.items()}, ensure_ascii=False)), "map<string,array<string>>")

    def choice(words: Column, number: int) -> Column:
        draw = seed(tag, str(number), F.col("pool"), F.col("nk"))
        return F.element_at(words, (F.pmod(draw, F.size(words)) + 1).cast("int"))

    wishes = values.select("nk", "pool", F.element_at(table, F.col("pool")).alias("words")).select(
        "nk",
        "pool",
        F.posexplode(F.array(*[choice(F.col("words"), n) for n in range(CHOICES)])).alias("choice", "word"),
    ).where(F.lower("word") != F.col("nk"))
    wishes = free_words(wishes, used, [w for words in pools.values() for w in words])
    won = wishes.groupBy(F.lower("word").alias("_w")).agg(
        F.min_by(
            F.struct("nk", "pool", "word", "choice"),
            F.struct("choice", F.sha2(F.concat_ws("|", F.lit(tag), "pool", "nk"), 256)),
        ).alias("r")
    )
    best = won.groupBy("r.nk", "r.pool").agg(F.min_by("r.word", "r.choice").alias("word"))
    return values.join(best, ["nk", "pool"], "left")


def pool_allocate(
    values: DataFrame,
    pools: dict[str, Sequence[str]],
    compound: dict[str, str],
    tag: str,
    used: DataFrame | None = None,
    marks: DataFrame | None = None,
    joiner: str = "-",
) -> DataFrame:
    """Pool words first, then compounds of pool words spelled from slots.

    ``compound`` names, per pool, the pool whose words make the compounds; pools
    that share one draw their slots together, so their compounds never meet.
    Compounds have two words at least, so they cannot meet a single word. Adds
    ``word`` and ``placed``; ``tag`` also names the families of ``marks``.
    """
    picked = pool_pick(values, pools, tag, used)
    family = literal_map(compound)
    lost = picked.where(F.col("word").isNull()).withColumn("family", F.element_at(family, F.col("pool")))
    placed = slots(lost, ["family"], "nk", marks, F.concat(F.lit(f"{tag}|"), "family"))
    spelled = None
    for name in sorted(set(compound.values())):
        # Slot numbers start behind the one-word spellings.
        text = words_of(F.col("slot") + len(pools[name]), pools[name], joiner)
        spelled = F.when(F.col("family") == name, text) if spelled is None else spelled.when(F.col("family") == name, text)
    filled = placed.withColumn("word", spelled).drop("slot", "family")
    return picked.where(F.col("word").isNotNull()).withColumn("placed", nowhere()).unionByName(filled)


def disambiguate(
    df: DataFrame,
    candidate: str,
    key: str,
    tail,
    used: DataFrame | None = None,
    marks: DataFrame | None = None,
    hot: bool = True,
) -> DataFrame:
    """Make ``candidate`` unique over distinct ``key`` values.

    A candidate nobody else has stays. Among several, the smallest digest keeps
    the short form unless the ledger holds it, and every other value gets
    ``tail(candidate, number)`` with a number unique under that candidate. The
    groups are counted with partial aggregation and numbered inside hash
    buckets, so a candidate shared by very many values is spread over tasks.
    ``marks`` number on behind the tails of earlier calls; ``hot`` is false when
    there are too few values for any candidate to be frequent. Adds ``placed``.
    """
    digest = F.sha2(F.concat_ws("|", F.lit("claim"), F.col(key)), 256)
    claims = (
        df.groupBy(F.lower(candidate).alias("_cf"))
        .agg(F.min_by(F.col(key), digest).alias("_owner"), F.count("*").alias("_n"))
    )
    if used is not None:
        # Few candidates are held against many fakes in use: those are only read, the hits are joined.
        hits = used.select(F.col("fake_cf").alias("_cf")).join(claims.select("_cf"), "_cf", "left_semi").distinct()
        claims = claims.join(hits.withColumn("_taken", F.lit(True)), "_cf", "left")
    else:
        claims = claims.withColumn("_taken", F.lit(None).cast("boolean"))
    marked = lookup(df.withColumn("_cf", F.lower(candidate)), claims, ["_cf"], weight="_n" if hot else None)
    keeps = F.col("_taken").isNull() & (F.col("_owner") == F.col(key))
    kept = marked.where(keeps).drop("_owner", "_taken", "_cf", "_n")
    lost = marked.where(~keeps).drop("_owner", "_taken", "_n")
    numbered = slots(lost, ["_cf"], key, marks, tail_family(F.col("_cf")))
    return kept.withColumn("placed", nowhere()).unionByName(
        numbered.withColumn(candidate, tail(F.col(candidate), F.col("slot"))).drop("slot", "_cf")
    )


def tail_family(folded: Column) -> Column:
    return F.concat(F.lit("tail|"), folded)


def word_tail(candidate: Column, number: Column) -> Column:
    """Clean, digit-free tail for names of organisations."""
    return F.concat(candidate, F.lit(f" {C.OVERFLOW_WORD} "), words_of(number, C.ORG_HEADS, " "))


def email_tail(candidate: Column, number: Column) -> Column:
    """The same for the local part of an address."""
    heads = [h.lower() for h in C.ORG_HEADS]
    local = F.regexp_extract(candidate, "^([^@]*)@", 1)
    domain = F.regexp_extract(candidate, "@(.*)$", 1)
    extra = F.concat(F.lit(f".{C.OVERFLOW_WORD.lower()}."), words_of(number, heads, "."))
    return F.concat(local, extra, F.lit("@"), domain)
