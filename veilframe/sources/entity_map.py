"""The entity map: one table of ``original -> fake`` pairs shared by all runs.

Columns: ``id, label, original, fake, comment, is_pii``. Reading derives the
reuse key ``nk``; every lookup is an equi-join on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.functions import text as X
from veilframe.operators.allocate import dense_ids

SCHEMA = "id bigint, label string, original string, fake string, comment string, is_pii string"
LEGACY_FAKE = "(^FakeCompany_|^FakeOrg_|_[0-9a-fA-F]{8}$|_[0-9]{3,}$)"
GEO_LABELS = ("country", "location", "region", "address")


def empty_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def clean(entity_map: DataFrame) -> DataFrame:
    """Usable rows with their reuse key, folded label and folded fake; kept as they are if they have them already."""
    if "nk" in entity_map.columns:
        return entity_map
    return (
        entity_map.where(
            F.col("original").isNotNull()
            & F.col("fake").isNotNull()
            & (F.col("original") != "")
            & (F.col("fake") != "")
        )
        .withColumn("nk", X.normalize(F.col("original")))
        .withColumn("label_cf", F.lower(F.trim(F.coalesce("label", F.lit("")))))
        .withColumn("fake_cf", F.lower(F.trim("fake")))
        .withColumn("excluded", F.upper(F.trim(F.coalesce("is_pii", F.lit("")))) == "N")
    )


def relevant(entity_map: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose reuse key is among ``keys`` (``nk``).

    A map is read once for that and neither shuffled nor grouped when the keys
    are few enough to be broadcast; views of the rest need not be made at all.
    """
    return clean(entity_map).join(keys.select("nk").distinct(), "nk", "left_semi")


def typed_view(entity_map: DataFrame) -> DataFrame:
    """``label_cf, nk -> fake``; the last row by id wins."""
    rows = clean(entity_map).where(~F.col("excluded") & (F.col("label_cf") != ""))
    return rows.groupBy("label_cf", "nk").agg(F.max_by("fake", "id").alias("fake"))


def any_view(entity_map: DataFrame) -> DataFrame:
    """``nk -> fake, map_id`` whatever the label; the first row by id wins."""
    rows = clean(entity_map).where(~F.col("excluded"))
    return rows.groupBy("nk").agg(F.min_by("fake", "id").alias("fake"), F.min("id").alias("map_id"))


def non_pii_view(entity_map: DataFrame) -> DataFrame:
    """``nk -> label_cf, fake`` of rows reviewed as not personal; the last one wins."""
    rows = clean(entity_map).where("excluded")
    last = rows.groupBy("nk").agg(F.max_by(F.struct("label_cf", "fake"), "id").alias("r"))
    return last.select("nk", "r.label_cf", "r.fake")


def used_view(entity_map: DataFrame) -> DataFrame:
    """Ledger of fakes in use, of any type, reviewed rows included."""
    return clean(entity_map).select("fake_cf").distinct()


def label_of(ptype: Column) -> Column:
    table = X.literal_map(C.LABELS)
    return F.coalesce(F.try_element_at(table, ptype), F.lit(C.DEFAULT_LABEL))


def lookup_label(ptype: Column) -> Column:
    """Folded label a lookup is tried under; null for types without one of their own."""
    return F.lower(F.try_element_at(X.literal_map(C.LABELS), ptype))


def lookup_pairs(values: DataFrame, entity_map: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``map_fake`` and ``map_id`` to values with ``ptype``, ``nk`` and ``canon``.

    The pair of the value's own label comes first, then any pair of the text.
    ``strict`` leaves the second step out. Originals too long for the map are
    never looked up. Both views are unique per key, so rows never multiply.
    """
    typed = typed_view(entity_map).select(
        F.col("label_cf").alias("_label"), "nk", F.col("fake").alias("_typed")
    )
    keyed = values.withColumn("_label", lookup_label(F.col("ptype")))
    out = keyed.join(typed, ["_label", "nk"], "left")
    anyway = any_view(entity_map).select("nk", F.col("fake").alias("_any"), F.col("map_id").alias("_id"))
    out = out.join(anyway, "nk", "left")
    found = F.col("_typed") if strict else F.coalesce("_typed", "_any")
    fits = F.length("canon") <= C.MAX_ORIGINAL
    return out.select(
        *values.columns,
        F.when(fits, found).alias("map_fake"),
        F.when(fits & found.isNotNull(), F.col("_id")).alias("map_id"),
    )


def storable(ptype: Column, original: Column, fake: Column) -> Column:
    """A pair worth keeping: a stored type, a real change, and within the width."""
    return (
        ~ptype.isin(*C.UNSTORED_TYPES)
        & original.isNotNull()
        & fake.isNotNull()
        & (F.lower(F.trim(fake)) != F.lower(F.trim(original)))
        & (F.length(original) <= C.MAX_ORIGINAL)
        & (F.length(fake) <= C.MAX_ORIGINAL)
    )


def new_rows(pairs: DataFrame, entity_map: DataFrame) -> DataFrame:
    """Rows to append for ``ptype, original, fake`` pairs the map does not know.

    One row per reuse key, also against rows reviewed as not personal. Ids go on
    after the highest one, numbered without a global sort.
    """
    known = clean(entity_map).select("nk").distinct()
    fresh = (
        pairs.where(storable(F.col("ptype"), F.col("original"), F.col("fake")))
        .withColumn("nk", X.normalize(F.col("original")))
        .groupBy("nk")
        .agg(F.min(F.struct("original", "fake", "ptype")).alias("r"))
        .join(known, "nk", "left_anti")
        .select("nk", "r.original", "r.fake", label_of(F.col("r.ptype")).alias("label"))
    )
    numbered = dense_ids(fresh, "nk", 0, "_rank")
    return numbered.select(
        (highest_id(entity_map).scalar() + F.col("_rank")).alias("id"),
        "label",
        "original",
        "fake",
        F.lit(None).cast("string").alias("comment"),
        F.lit(None).cast("string").alias("is_pii"),
    )


def append(entity_map: DataFrame, rows: DataFrame) -> DataFrame:
    return entity_map.select("id", "label", "original", "fake", "comment", "is_pii").unionByName(rows)


def rewrite(entity_map: DataFrame, updates: DataFrame) -> DataFrame:
    """New version of the map with the fakes of ``updates`` (``original, fake``) put in."""
    new = (
        updates.withColumn("_nk", X.normalize(F.col("original")))
        .groupBy("_nk")
        .agg(F.min("fake").alias("_fake"))
    )
    keyed = entity_map.withColumn("_nk", X.normalize(F.col("original")))
    return keyed.join(new, "_nk", "left").select(
        "id", "label", "original", F.coalesce("_fake", "fake").alias("fake"), "comment", "is_pii"
    )


def is_legacy_fake(fake: Column) -> Column:
    """Machine-looking fakes of old runs, to be replaced by clean ones."""
    return fake.rlike(LEGACY_FAKE)


def highest_id(entity_map: DataFrame) -> DataFrame:
    return entity_map.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("highest"))


def known_codes(entity_map: DataFrame) -> DataFrame:
    """``code -> fake`` for short all-caps codes with exactly one fake."""
    rows = clean(entity_map).where(
        F.col("original").rlike("^[A-Z]{4,8}$") & ~F.col("label_cf").isin(*GEO_LABELS)
    )
    return (
        rows.groupBy(F.col("original").alias("code"))
        .agg(F.count_distinct("fake").alias("n"), F.min("fake").alias("fake"))
        .where("n = 1")
        .select("code", "fake")
    )


def name_order_key(nk: Column) -> Column:
    """Same for ``a b``, ``b a`` and ``b, a``."""
    tokens = F.filter(F.split(nk, "[\\s,]+"), lambda t: t != "")
    return F.array_join(F.array_sort(tokens), " ")


def injectivity_report(entity_map: DataFrame) -> DataFrame:
    """Fakes shared by several originals and originals with several fakes.

    Spellings of one name in another order count as one original.
    """
    rows = clean(entity_map).where(~F.col("excluded"))
    shared = (
        rows.groupBy(F.col("fake_cf").alias("value"))
        .agg(F.count_distinct(name_order_key(F.col("nk"))).alias("n"))
        .where("n > 1")
        .select(F.lit("fake_with_many_originals").alias("problem"), "value", "n")
    )
    split = (
        rows.groupBy(F.col("nk").alias("value"))
        .agg(F.count_distinct("fake_cf").alias("n"))
        .where("n > 1")
        .select(F.lit("original_with_many_fakes").alias("problem"), "value", "n")
    )
    return shared.unionByName(split)


def learned_tokens(entity_map: DataFrame) -> DataFrame:
    """``role, nk -> fake`` tokens of whole person names already in the map.

    Only plain names with the same number of words on both sides teach a pair;
    Han names and annotated ones do not.
    """
    names = clean(entity_map).where(
        ~F.col("excluded") & (F.col("label_cf") == C.LABELS["person"].lower())
    )
    plain = (
        ~X.is_han(F.col("original")) & ~X.is_han(F.col("fake"))
        & ~F.col("original").rlike("[(\\[]") & ~F.col("fake").rlike("[(\\[]")
    )

    def words(column: str) -> Column:
        return F.filter(F.split(F.trim(F.regexp_replace(column, X.TITLE, "$2")), "\\s+"), lambda t: t != "")

    pairs = (
        names.where(plain)
        .select("id", words("original").alias("o"), words("fake").alias("f"))
        .where((F.size("o") == F.size("f")) & (F.size("o") > 0))
        .select("id", F.size("o").alias("count"), F.posexplode(F.arrays_zip("o", "f")).alias("pos", "pair"))
        .select(
            "id",
            F.when((F.col("count") > 1) & (F.col("pos") == F.col("count") - 1), "last").otherwise("first").alias("role"),
            X.normalize(F.col("pair.o")).alias("nk"),
            F.col("pair.f").alias("fake"),
        )
        .where("nk <> ''")
    )
    return pairs.groupBy("role", "nk").agg(F.min_by("fake", "id").alias("fake"))
