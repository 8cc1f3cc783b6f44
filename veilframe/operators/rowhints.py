"""Hints that come from other columns of the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators.generators import fake_id_with_hints
from veilframe.operators.people import HINT_TYPE, local_clean


def email_hints(email: Column, people: list[tuple[Column, str]]) -> Column:
    """Name tokens of the row's person columns that the address contains.

    ``people`` lists ``(column, role)``. First route: one column whose first and
    last token are exactly the two parts of the local part. Second route: every
    token of at least three letters of a first- or last-name column that the
    cleaned local part contains; ``whole`` says that it is the entire value.
    """
    empty = F.array().cast(HINT_TYPE)
    local = F.split(F.trim(email), "@")[0]
    parts = F.array_distinct(
        F.filter(
            F.transform(F.split(local, "[._\\-]+"), lambda p: F.lower(F.regexp_replace(p, "^\\.+|\\.+$", ""))), lambda p: p != ""
        )
    )
    exact = []
    for column, _ in people:
        tokens = X.person_tokens(column)
        same = F.array_sort(F.array_distinct(F.array(F.lower(tokens["first"]), F.lower(tokens["last"])))) == F.array_sort(parts)
        pair = F.array(
            F.struct(tokens["first"].alias("token"), F.lit("first").alias("role"), F.lit(False).alias("whole")),
            F.struct(tokens["last"].alias("token"), F.lit("last").alias("role"), F.lit(False).alias("whole")),
        )
        exact.append(F.when(tokens.isNotNull() & same & (F.size(parts) >= 2), pair.cast(HINT_TYPE)))
    cleaned = local_clean(local)

    def inside(column: Column, role: str) -> Column:
        tokens = F.filter(F.split(F.trim(column), "\\s+"), lambda t: t != "")
        hits = F.filter(tokens, lambda t: (F.length(local_clean(t)) >= 3) & F.contains(cleaned, local_clean(t)))
        found = F.transform(
            hits,
            lambda t: F.struct(t.alias("token"), F.lit(role).alias("role"), (F.size(tokens) == 1).alias("whole")),
        )
        return F.coalesce(found.cast(HINT_TYPE), empty)

    contained = [inside(column, role) for column, role in people if role in ("first", "last")]
    second = F.concat(*contained) if contained else empty
    hints = F.coalesce(*exact, second) if exact else second
    return F.when(email.isNotNull() & F.contains(email, F.lit("@")), hints).otherwise(empty)


def union_hints(df: DataFrame, email: str, hints: str) -> DataFrame:
    """``email -> hints`` over all rows that share the address.

    Hints are made distinct before they are grouped. A hint is part of the
    address it belongs to, so a group is as small as the address is short.
    """
    rows = df.where(F.col(email).isNotNull()).select(
        F.trim(email).alias("email"), F.explode(hints).alias("h")
    )
    single = rows.groupBy("email", "h.role", "h.token").agg(F.max("h.whole").alias("whole"))
    return single.groupBy("email").agg(
        F.array_sort(F.collect_list(F.struct("token", "role", "whole"))).cast(HINT_TYPE).alias("hints")
    )


def atomic_ids(columns: list[tuple[Column, Column]]) -> Column:
    """Map of the row's undelimited id values to their fakes; ``columns`` lists ``(raw, fake)``."""
    pairs = F.filter(
        F.array(*[F.struct(raw.alias("k"), fake.alias("v")) for raw, fake in columns]),
        lambda p: p["k"].isNotNull() & (F.length(p["k"]) >= 2) & ~p["k"].rlike("[_\\-]"),
    )
    return F.aggregate(
        pairs,
        F.create_map().cast("map<string,string>"),
        lambda acc, p: F.when(F.map_contains_key(acc, p["k"]), acc).otherwise(F.map_concat(acc, F.create_map(p["k"], p["v"]))),
    )


def compound_id(raw: Column, fake: Column, atoms: Column, config: Config = DEFAULT) -> Column:
    """Rebuild a delimited id around the segments that repeat an atomic id of the row."""
    segments = F.split(raw, "[_\\-]")
    shared = raw.rlike("[_\\-]") & F.exists(segments, lambda s: F.map_contains_key(atoms, s))
    return F.when(F.coalesce(shared, F.lit(False)), fake_id_with_hints(raw, atoms, config)).otherwise(fake)


def name_fragments(pairs: list[tuple[Column, Column]]) -> Column:
    """Map of name words to fake words, from the row's own person columns only."""
    arrays = [
        F.coalesce(X.zip_name_tokens(raw, fake), F.array().cast("array<struct<o:string,f:string>>")) for raw, fake in pairs
    ]
    usable = F.filter(
        F.concat(*arrays),
        lambda p: (F.length(p["o"]) >= 2) & ~F.lower(p["o"]).isin(*C.HARVEST_STOP) & (p["f"] != "") & (p["f"] != p["o"]),
    )
    return F.aggregate(
        usable,
        F.create_map().cast("map<string,string>"),
        lambda acc, p: F.when(F.map_contains_key(acc, p["o"]), acc).otherwise(F.map_concat(acc, F.create_map(p["o"], p["f"]))),
    )


def apply_fragments(text: Column, fragments: Column) -> Column:
    """Replace the row's name words in its text, longest first.

    Latin words are bounded by non-letters and take the case of the occurrence,
    Han words match anywhere.
    """
    keys = F.array_sort(
        F.map_keys(fragments),
        lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0),
    )

    def by_kind(han: bool) -> Column:
        kept = F.filter(keys, lambda k: X.is_han(k) if han else ~X.is_han(k))
        return F.array_join(F.transform(kept, X.quote_pattern), "|")

    lowered = F.transform_keys(fragments, lambda k, v: F.lower(k))

    def run(p: Column) -> Column:
        latin, han = p["latin"], p["han"]
        pattern = F.concat_ws(
            "|",
            F.when(latin != "", F.concat(F.lit("(?i:(?<![A-Za-z])(?:"), latin, F.lit(")(?![A-Za-z]))"))),
            F.when(han != "", F.concat(F.lit("(?:"), han, F.lit(")"))),
        )
        replaced = X.splice(
            text,
            pattern,
            lambda m: F.when(X.is_han(m), F.try_element_at(fragments, m)).otherwise(
                X.case_like(m, F.try_element_at(lowered, F.lower(m)))
            ),
        )
        return F.when(pattern == "", text).otherwise(replaced)

    bound = F.struct(by_kind(False).alias("latin"), by_kind(True).alias("han"))
    return F.when(F.coalesce(F.size(fragments), F.lit(0)) <= 0, text).otherwise(X.let(bound, run))
