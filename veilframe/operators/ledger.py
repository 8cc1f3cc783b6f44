"""What later calls and runs must know of earlier ones.

A ledger holds the entity map as it stands, the name tokens, the marks of the
slot families and this run's answers. Each call of ``resolve`` takes one and
returns the next, so a value met again gets the fake it has, whatever column,
text or address cell it stands in, and a new value never gets a fake that is in
use. All four are tables that grow with the distinct values; nothing of them
reaches the driver.

A map that comes without marks (written by an older run, or by hand) has them
counted: of every family, as many slots as the map has keys that may have used
one. That can leave numbers out, never use one twice.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators import people, places
from veilframe.operators.allocate import BUCKETS, counted_marks, marks_of, merged_marks, tail_family
from veilframe.operators.joins import bucket_of
from veilframe.session import materialize
from veilframe.sources import entity_map as em

TOKENS = "role string, nk string, fake string"
ANSWERS = "etype string, role string, nk string, country string, fake string"
KEYS = ["etype", "role", "nk", "country"]


def _family(name: Column, by: Column, key: Column) -> Column:
    """One key that may have used a slot of a family."""
    return F.struct(name.alias("family"), bucket_of(F.concat_ws("|", by, key), BUCKETS).alias("bucket"), key.alias("key"))


def map_marks(entity_map: DataFrame, config: Config = DEFAULT, subdivisions: dict | None = None) -> DataFrame:
    """Marks behind everything the pairs of a map may have used, from one pass over it."""
    rows = people.read_person(em.clean(entity_map), "original")
    nk, label, fake = F.col("nk"), F.col("label_cf"), F.col("fake_cf")
    salt = config.salt
    elements = F.transform(places._elements(nk), X.normalize)

    def city(part: Column) -> Column:
        kind = F.when(X.is_han(part), F.lit("han")).otherwise(F.lit("latin"))
        return _family(F.concat(F.lit(f"{salt}:city|"), kind), kind, part)

    states, _ = places.subdivision_pools(subdivisions)
    state_pools = F.array(*[F.lit(p) for p in sorted(states)])
    word = f" {C.OVERFLOW_WORD.lower()} "
    dotted = f"\\.{C.OVERFLOW_WORD.lower()}\\.[^@]*@"
    # Tails lie behind the first overflow word; a candidate never holds one itself.
    named = F.regexp_replace(fake, f"^(.*?){word}.*$", "$1")
    mailed = F.regexp_replace(fake, f"^(.*?){dotted}(.*)$", "$1@$2")
    tailed = F.when(F.contains(fake, F.lit("@")), mailed).otherwise(named)
    identity = F.when(
        F.col("shape") == "bilingual", F.concat_ws("|", F.lower("bilingual.latin"), "bilingual.han")
    ).otherwise(F.col("body"))
    none = F.array().cast("array<struct<family:string,bucket:int,key:string>>")
    used = F.concat(
        F.when(label.isin("location", "other"), F.transform(elements, city)).otherwise(none),
        F.when(label == "other", F.array(_family(F.lit(f"{salt}:street|street"), F.lit("street"), nk))).otherwise(none),
        F.when(label == "stateprovince", F.transform(state_pools, lambda p: _family(F.concat(F.lit(f"{salt}:state|"), p), p, nk))).otherwise(none),
        F.when(X.is_han(nk), F.array(_family(F.lit("org|han"), F.lit("han"), nk), _family(F.lit("han"), F.lit("han"), identity))).otherwise(none),
        F.when(tailed != fake, F.array(_family(tail_family(tailed), tailed, nk))).otherwise(none),
    )
    each = rows.select(F.explode(used).alias("u")).select("u.*")
    return each.groupBy("family", "bucket").agg(F.count_distinct("key").cast("bigint").alias("next"))


@dataclass(frozen=True)
class Ledger:
    """State of the fakes in use: any part may be missing at the start."""

    entity_map: DataFrame | None = None
    tokens: DataFrame | None = None
    marks: DataFrame | None = None
    answers: DataFrame | None = None

    def used(self) -> DataFrame | None:
        """``fake_cf, nk``: fakes in use and the keys that have them."""
        parts = []
        if self.entity_map is not None:
            parts.append(em.clean(self.entity_map).select("fake_cf", "nk"))
        if self.answers is not None:
            parts.append(self.answers.select(F.lower(F.trim("fake")).alias("fake_cf"), "nk"))
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def owners(self, fakes: DataFrame) -> DataFrame | None:
        """``_cf, low, high``: of these fakes (``_cf``) the ones in use, with the least and greatest key that has each."""
        used = self.used()
        if used is None:
            return None
        hits = used.withColumnRenamed("fake_cf", "_cf").join(fakes.select("_cf"), "_cf", "left_semi")
        return hits.groupBy("_cf").agg(F.min("nk").alias("low"), F.max("nk").alias("high"))

    def ready(self, config: Config = DEFAULT, subdivisions: dict | None = None) -> Ledger:
        """The same with marks, counted from the map and the tokens where none were kept."""
        if self.marks is not None or (self.entity_map is None and self.tokens is None):
            return self
        names = [] if self.tokens is None else [self.tokens.select("role", "nk")]
        counted = None
        if self.entity_map is not None:
            counted = map_marks(self.entity_map, config, subdivisions)
            names.append(em.learned_tokens(self.entity_map).select("role", "nk"))
        rows = names[0] if len(names) == 1 else names[0].unionByName(names[1])
        tokens = counted_marks(rows, F.concat(F.lit("token|"), "role"), ["role"], "nk")
        return replace(self, marks=materialize(merged_marks(counted, tokens), "marks"))

    def after(self, pairs: DataFrame, answers: DataFrame, placed: DataFrame, tokens: DataFrame | None) -> Ledger:
        """With a call's new pairs (``ptype, original, fake``), answers, slots and name tokens."""
        known = em.empty_map(pairs.sparkSession) if self.entity_map is None else self.entity_map
        rows = em.new_rows(pairs, known)
        if "nk" in known.columns:
            known = known.unionByName(em.clean(rows))
        else:
            known = em.append(known, rows)
        known_tokens = self.tokens
        if tokens is not None:
            fresh = tokens.select("role", "nk", "fake")
            if known_tokens is not None:
                old = known_tokens.select("role", "nk", "fake")
                fresh = old.unionByName(fresh.join(old, ["role", "nk"], "left_anti"))
            known_tokens = fresh
        given = answers.select(*KEYS, "fake")
        if self.answers is not None:
            given = self.answers.unionByName(given.join(self.answers, KEYS, "left_anti"))
        return Ledger(
            known, known_tokens, merged_marks(self.marks, marks_of(placed)), given
        )

    def settled(self) -> Ledger:
        """The same, written to the checkpoint folder, so that the next call does not work it out again."""
        parts = {n: getattr(self, n) for n in ("entity_map", "tokens", "marks", "answers")}
        return Ledger(**{n: None if df is None else materialize(df, n) for n, df in parts.items()})

