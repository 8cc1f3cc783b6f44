"""Chinese names and organisations, spelled from slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.functions.seeds import literal_array
from veilframe.operators.allocate import _whole, digits, nowhere, pool_pick, slots

PERSON_SPACE = len(C.HAN_SURNAMES) * len(C.HAN_GIVEN) ** 2


def _given(number: Column, column: int) -> Column:
    return F.element_at(literal_array([g[column] for g in C.HAN_GIVEN]), (number + 1).cast("int"))


def han_identities(keys: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """``identity -> han, given_latin, surname_latin, placed``, a different person per identity.

    A slot picks surname and two given characters; slots beyond that space add
    given characters, so names stay distinct however many there are.
    """
    placed = slots(keys.withColumn("_g", F.lit("han")), ["_g"], "identity", marks)
    slot, size = F.col("slot"), len(C.HAN_GIVEN)
    inner = F.pmod(F.pmod(slot, F.lit(PERSON_SPACE)) * 7919 + 101, F.lit(PERSON_SPACE))
    surname_at = F.pmod(inner, F.lit(len(C.HAN_SURNAMES)))
    rest = F.floor(inner / len(C.HAN_SURNAMES))
    one, two = F.pmod(rest, F.lit(size)), F.floor(rest / size)
    beyond = digits(_whole(slot, PERSON_SPACE) - 1, size)

    def more(column: int) -> Column:
        return F.when(slot < PERSON_SPACE, F.lit("")).otherwise(F.array_join(F.transform(beyond, lambda d: _given(d, column)), ""))

    han, latin = [_given(one, 0), _given(two, 0), more(0)], [_given(one, 1), _given(two, 1), more(1)]
    surname = F.element_at(literal_array([s[0] for s in C.HAN_SURNAMES]), (surname_at + 1).cast("int"))
    surname_latin = F.element_at(literal_array([s[1] for s in C.HAN_SURNAMES]), (surname_at + 1).cast("int"))
    joined = F.concat(*latin)
    return placed.select(
        "identity",
        F.concat(surname, *han).alias("han"),
        F.concat(F.upper(F.substring(joined, 1, 1)), F.substr(joined, F.lit(2))).alias("given_latin"),
        surname_latin.alias("surname_latin"),
        "placed",
    )


def han_org_words() -> list[str]:
    return [head + tail for head in C.HAN_ORG_HEADS for tail in C.HAN_ORG_TAILS]


def han_orgs(values: DataFrame, used: DataFrame | None = None, marks: DataFrame | None = None) -> DataFrame:
    """``nk -> fake, placed`` company names: head and tail, then head with two or more tails."""
    picked = pool_pick(values.select("nk").withColumn("pool", F.lit("han")), {"han": han_org_words()}, "han-org", used)
    lost = picked.where(F.col("word").isNull())
    placed = slots(lost, ["pool"], "nk", marks, F.concat(F.lit("org|"), "pool"))
    slot, heads, tails = F.col("slot"), len(C.HAN_ORG_HEADS), len(C.HAN_ORG_TAILS)
    pool = literal_array(C.HAN_ORG_TAILS)

    def tail(number: Column) -> Column:
        return F.element_at(pool, (F.pmod(number, F.lit(tails)) + 1).cast("int"))

    rest = F.floor(slot / heads)
    pieces = [
        F.element_at(literal_array(C.HAN_ORG_HEADS), (F.pmod(slot, F.lit(heads)) + 1).cast("int")),
        tail(rest),
        tail(F.floor(rest / tails)),
    ]
    beyond = F.array_join(F.transform(digits(_whole(rest, tails**2) - 1, tails), tail), "")
    pieces.append(F.when(rest < tails**2, F.lit("")).otherwise(beyond))
    spelled = placed.select("nk", F.concat(*pieces).alias("fake"), "placed")
    return picked.where(F.col("word").isNotNull()).select("nk", F.col("word").alias("fake"), nowhere().alias("placed")).unionByName(spelled)
