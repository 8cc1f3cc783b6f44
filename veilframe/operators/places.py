"""Cities, states and provinces, street names: real places in, other real places out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators.allocate import nowhere, pool_allocate


def city_fakes(
    values: DataFrame, used: DataFrame | None = None, marks: DataFrame | None = None, config: Config = DEFAULT
) -> DataFrame:
    """``nk -> fake, placed``. Han lists are faked element by element, work-mode words stay."""
    pools = {"han": C.HAN_CITIES, "latin": C.CITIES}
    compound = {"han": "han", "latin": "latin"}
    parted = values.select("nk", "canon", _elements(F.col("canon")).alias("parts"))
    pieces = parted.select("nk", F.posexplode("parts").alias("pos", "part"))
    cities = (
        pieces.where(~F.trim("part").isin(*C.HAN_LOCATION_SKIP) & (F.trim("part") != ""))
        .groupBy(X.normalize(F.col("part")).alias("nk"))
        .agg(F.min("part").alias("part"), F.count("*").alias("n"))
        .withColumn("pool", F.when(X.is_han(F.col("part")), "han").otherwise("latin"))
    )
    placed = pool_allocate(cities.select("nk", "pool"), pools, compound, f"{config.salt}:city", used, marks)
    table = placed.select(F.col("nk").alias("cnk"), "word", "placed")
    joined = pieces.withColumn("cnk", X.normalize(F.col("part"))).join(table, "cnk", "left")
    faked = joined.select(
        "nk", "pos", F.coalesce(X.case_like(F.col("part"), F.col("word")), F.col("part")).alias("fake"), F.coalesce("placed", nowhere()).alias("placed")
    )
    return faked.groupBy("nk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "fake"))), lambda s: s["fake"]), ",").alias("fake"),
        F.flatten(F.collect_list("placed")).alias("placed"),
    )


def _elements(value: Column) -> Column:
    listed = X.is_han(value) & F.contains(value, F.lit(","))
    return F.when(listed, F.split(value, ",")).otherwise(F.array(value))


def street_fakes(
    values: DataFrame, used: DataFrame | None = None, marks: DataFrame | None = None, config: Config = DEFAULT
) -> DataFrame:
    """``nk -> fake, placed`` street names from a small curated pool."""
    keyed = values.select("nk", "canon").withColumn("pool", F.lit("street"))
    placed = pool_allocate(keyed.select("nk", "pool"), {"street": C.STREET_NAMES}, {"street": "street"}, f"{config.salt}:street", used, marks)
    return keyed.join(placed, ["nk", "pool"]).select("nk", X.case_like(F.trim("canon"), F.col("word")).alias("fake"), "placed")


def subdivision_pools(subdivisions: dict | None = None) -> tuple[dict, dict]:
    """Pools ``code:XX`` and ``name:XX`` per country, ``code:`` and ``name:`` over all."""
    subdivisions = subdivisions or C.SUBDIVISIONS
    allowed = {c[1] for c in C.COUNTRIES}
    pools: dict[str, tuple[str, ...]] = {}
    codes: list[str] = []
    names: list[str] = []
    for country, rows in sorted(subdivisions.items()):
        if country not in allowed:
            continue
        own_codes = [code for code, _ in rows if len(code) == 2 and code.isalpha()]
        own_names = [name for _, name in rows]
        if own_codes:
            pools[f"code:{country}"] = tuple(own_codes)
        pools[f"name:{country}"] = tuple(own_names)
        codes += own_codes
        names += own_names
    pools["code:"] = tuple(dict.fromkeys(codes))
    pools["name:"] = tuple(dict.fromkeys(names))
    # Compounds stay within the country too.
    return pools, {key: key for key in pools}


def country_alpha2(value: Column) -> Column:
    """Alpha-2 of a pool country given as name or code."""
    table = {form.lower(): c[1] for c in C.COUNTRIES for form in c}
    return F.try_element_at(X.literal_map(table), F.lower(F.trim(value)))


def state_fakes(
    values: DataFrame,
    used: DataFrame | None = None,
    marks: DataFrame | None = None,
    config: Config = DEFAULT,
    subdivisions: dict | None = None,
) -> DataFrame:
    """``nk, country -> fake, placed``: code for code, name for name, of the faked country when it is given.

    ``values`` has ``nk, canon`` and optionally ``country``, the fake country. A
    subdivision is handed out once, so two states of a country never share one;
    when a country's own run out, two of them are joined, never another's taken.
    """
    pools, compound = subdivision_pools(subdivisions)
    known = F.array(*[F.lit(k) for k in sorted(pools)])
    rows = values if "country" in values.columns else values.withColumn("country", F.lit(None).cast("string"))
    letters = F.regexp_replace("canon", "[^A-Za-z]", "")
    form = F.when(F.length(letters) == 2, F.lit("code:")).otherwise(F.lit("name:"))
    wanted = F.concat(form, F.coalesce(country_alpha2(F.col("country")), F.lit("")))
    rows = rows.withColumn("pool", F.when(F.array_contains(known, wanted), wanted).otherwise(form))
    placed = pool_allocate(rows.select("nk", "pool").distinct(), pools, compound, f"{config.salt}:state", used, marks)
    return rows.join(placed, ["nk", "pool"]).select("nk", "country", X.case_like(F.trim("canon"), F.col("word")).alias("fake"), "placed")
