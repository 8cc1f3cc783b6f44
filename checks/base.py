"""Shared inputs of the checked queries: the given tables and columns derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fragments as Q
from veilframe import config as C
from veilframe.sources.tables import scan

QUERIES: dict[str, object] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its oracle when there is one."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


SMALL = ("region", "nation", "supplier", "benchmark", "labels")


def table(spark: SparkSession, sf_dir: str, name: str, tasks_per_split: int = 1) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", spread=name not in SMALL, tasks_per_split=tasks_per_split)


# Invented names spelled from a key: the same expression in both dialects.
GIVEN, FAMILY = "first", "last"


def name_expr(key: Column, salt: int) -> Column:
    """A short pronounceable word for a number; many keys share one."""
    n = F.pmod(key * 7 + salt, F.lit(997))
    return F.concat(
        F.upper(F.substr(F.lit(C.ONSETS), (n % 16 + 1).cast("int"), F.lit(1))),
        F.substr(F.lit(C.VOWELS), (F.floor(n / 16) % 5 + 1).cast("int"), F.lit(1)),
        F.substr(F.lit(C.ONSETS), (F.floor(n / 80) % 16 + 1).cast("int"), F.lit(1)),
        F.substr(F.lit(C.VOWELS), (F.floor(n / 5) % 5 + 1).cast("int"), F.lit(1)),
    )


def name_sql(key: str, salt: int) -> str:
    n = f"(({key} * 7 + {salt}) % 997)"
    return (
        f"(upper(substr('{C.ONSETS}', ({n} % 16 + 1)::INT, 1)) || substr('{C.VOWELS}', ({n} // 16 % 5 + 1)::INT, 1) || "
        f"substr('{C.ONSETS}', ({n} // 80 % 16 + 1)::INT, 1) || substr('{C.VOWELS}', ({n} // 5 % 5 + 1)::INT, 1))"
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as contacts: names, address, phone and company."""
    k = F.col("c_custkey")
    first, last = name_expr(k, 3), name_expr(F.floor(k / 3), 11)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        first.alias("firstname"), last.alias("lastname"), F.concat_ws(" ", first, last).alias("fullname"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@mail"), (k % 9).cast("string"), F.lit(".example.com")).alias("email"),
        F.concat(F.lit("+1 ("), F.lpad((k % 800 + 100).cast("string"), 3, "0"), F.lit(") "), F.lpad((k * 7919 % 10000000).cast("string"), 7, "0")).alias("phone"),
        F.concat_ws(" ", name_expr(F.floor(k / 5), 17), F.element_at(F.array(*[F.lit(x) for x in ("Global", "Trade", "Corex")]), (k % 3 + 1).cast("int")), F.lit("Ltd")).alias("company"),
        F.concat(name_expr(F.floor(k / 7), 29), F.lit("ville")).alias("city"),
    )


CONTACTS_SQL = f"""(SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, {name_sql('c_custkey', 3)} AS firstname,
  {name_sql('(c_custkey // 3)', 11)} AS lastname, {name_sql('c_custkey', 3)} || ' ' || {name_sql('(c_custkey // 3)', 11)} AS fullname,
  lower({name_sql('c_custkey', 3)}) || '.' || lower({name_sql('(c_custkey // 3)', 11)}) || '@mail' || (c_custkey % 9) || '.example.com' AS email,
  '+1 (' || lpad((c_custkey % 800 + 100)::VARCHAR, 3, '0') || ') ' || lpad((c_custkey * 7919 % 10000000)::VARCHAR, 7, '0') AS phone,
  {name_sql('(c_custkey // 5)', 17)} || ' ' || (['Global', 'Trade', 'Corex'])[(c_custkey % 3 + 1)::INT] || ' Ltd' AS company,
  {name_sql('(c_custkey // 7)', 29)} || 'ville' AS city FROM customer)"""


def entity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map derived from customers: duplicates under several labels, reviewed rows, odd spellings."""
    k = F.col("c_custkey")
    label = F.element_at(F.array(*[F.lit(x) for x in ("Names", "CompanyName", "Other", "names ")]), (k % 4 + 1).cast("int"))
    first, last = name_expr(k, 3), name_expr(F.floor(k / 3), 11)
    return table(spark, sf_dir, "customer").select(
        (k + 1).alias("id"),
        label.alias("label"),
        F.when(k % 5 == 0, F.upper(first)).when(k % 5 == 1, F.concat(F.lit(" "), first)).when(k % 5 == 2, F.concat_ws(" ", first, last)).otherwise(first).alias("original"),
        F.when(k % 11 == 0, F.concat(F.lit("FakeCompany_"), k.cast("string"))).otherwise(F.concat_ws(" ", F.lit("Fake"), last, name_expr(k, 5))).alias("fake"),
        F.lit(None).cast("string").alias("comment"),
        F.when(k % 13 == 0, "N").alias("is_pii"),
    )


MAP_SQL = f"""(SELECT c_custkey + 1 AS id, (['Names', 'CompanyName', 'Other', 'names '])[(c_custkey % 4 + 1)::INT] AS label,
  CASE c_custkey % 5 WHEN 0 THEN upper({name_sql('c_custkey', 3)}) WHEN 1 THEN ' ' || {name_sql('c_custkey', 3)}
    WHEN 2 THEN {name_sql('c_custkey', 3)} || ' ' || {name_sql('(c_custkey // 3)', 11)} ELSE {name_sql('c_custkey', 3)} END AS original,
  CASE WHEN c_custkey % 11 = 0 THEN 'FakeCompany_' || c_custkey
    ELSE 'Fake ' || {name_sql('(c_custkey // 3)', 11)} || ' ' || {name_sql('c_custkey', 5)} END AS fake,
  NULL::VARCHAR AS comment, CASE WHEN c_custkey % 13 = 0 THEN 'N' END AS is_pii FROM customer)"""
MAP_CLEAN_SQL = f"""(SELECT *, {Q.normalize('original')} AS nk, lower(trim(coalesce(label, ''))) AS label_cf,
  lower(trim(fake)) AS fake_cf, upper(trim(coalesce(is_pii, ''))) = 'N' AS excluded FROM {MAP_SQL})"""
