"""Entity map, lookups, guards and row hints."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fragments as Q
from checks.base import CONTACTS_SQL, MAP_CLEAN_SQL, MAP_SQL, contacts, entity_map, query
from veilframe import config as C
from veilframe.config import Config
from veilframe.functions import text as X
from veilframe.operators import orgs, resolve as R, rowhints
from veilframe.operators.people import HINT_TYPE
from veilframe.sources import entity_map as em

_ptype = "(['person', 'org', 'phone', 'id'])[(c_custkey % 4 + 1)::INT]"
_canon = "CASE c_custkey % 3 WHEN 0 THEN firstname WHEN 1 THEN lower(fullname) ELSE lastname || '  ' END"
VALUES_SQL = f"(SELECT DISTINCT {_ptype} AS ptype, {_canon} AS canon FROM {CONTACTS_SQL})"
_label = "CASE ptype " + " ".join(f"WHEN {Q.text(k)} THEN {Q.text(v.lower())}" for k, v in C.LABELS.items()) + " END"


def values(spark, sf_dir):
    k = F.col("c_custkey")
    ptype = F.element_at(F.array(*[F.lit(x) for x in ("person", "org", "phone", "id")]), (k % 4 + 1).cast("int"))
    canon = F.when(k % 3 == 0, F.col("firstname")).when(k % 3 == 1, F.lower("fullname")).otherwise(F.concat("lastname", F.lit("  ")))
    return contacts(spark, sf_dir).select(ptype.alias("ptype"), canon.alias("canon")).distinct()


def _lookup_sql(strict: bool) -> str:
    found = "t.fake" if strict else "coalesce(t.fake, a.fake)"
    return f"""WITH m AS (SELECT * FROM {MAP_CLEAN_SQL}),
t AS (SELECT label_cf, nk, arg_max(fake, id) AS fake FROM m WHERE NOT excluded AND label_cf <> '' GROUP BY 1, 2),
a AS (SELECT nk, arg_min(fake, id) AS fake, min(id) AS map_id FROM m WHERE NOT excluded GROUP BY 1),
v AS (SELECT *, {Q.normalize('canon')} AS nk, {_label} AS label FROM {VALUES_SQL})
SELECT v.ptype, v.canon, {found} AS map_fake, CASE WHEN {found} IS NOT NULL THEN a.map_id END AS map_id
FROM v LEFT JOIN t ON t.label_cf = v.label AND t.nk = v.nk LEFT JOIN a ON a.nk = v.nk"""


@query("map_lookup", _lookup_sql(False))
def map_lookup(spark, sf_dir):
    """Pair of the own label first, then of any label, with the map id."""
    v = values(spark, sf_dir).withColumn("nk", X.normalize(F.col("canon")))
    return em.lookup_pairs(v, entity_map(spark, sf_dir)).drop("nk")


@query("map_lookup_strict", _lookup_sql(True))
def map_lookup_strict(spark, sf_dir):
    v = values(spark, sf_dir).withColumn("nk", X.normalize(F.col("canon")))
    return em.lookup_pairs(v, entity_map(spark, sf_dir), strict=True).drop("nk")


@query(
    "map_views",
    f"""WITH m AS (SELECT * FROM {MAP_CLEAN_SQL})
SELECT 'non_pii' AS view, nk AS key, arg_max(fake, id) AS fake FROM m WHERE excluded GROUP BY nk
UNION ALL SELECT DISTINCT 'used', fake_cf, NULL FROM m
UNION ALL SELECT 'any', nk, arg_min(fake, id) FROM m WHERE NOT excluded GROUP BY nk""",
)
def map_views(spark, sf_dir):
    m = entity_map(spark, sf_dir)
    none = F.lit(None).cast("string")
    return (
        em.non_pii_view(m).select(F.lit("non_pii").alias("view"), F.col("nk").alias("key"), "fake")
        .unionByName(em.used_view(m).select(F.lit("used").alias("view"), F.col("fake_cf").alias("key"), none.alias("fake")))
        .unionByName(em.any_view(m).select(F.lit("any").alias("view"), F.col("nk").alias("key"), "fake"))
    )


_pairs = f"""(SELECT DISTINCT CASE WHEN c_custkey % 7 = 0 THEN 'id' WHEN c_custkey % 2 = 0 THEN 'person' ELSE 'location' END AS ptype,
  CASE WHEN c_custkey % 2 = 0 THEN lastname ELSE city END AS original,
  CASE WHEN c_custkey % 10 = 1 THEN upper(city) ELSE firstname || 'x' END AS fake FROM {CONTACTS_SQL})"""
_storable = (
    f"ptype NOT IN ({', '.join(Q.text(t) for t in C.UNSTORED_TYPES)}) AND lower(trim(fake)) <> lower(trim(original)) "
    "AND length(original) <= 256 AND length(fake) <= 256"
)


@query(
    "map_append",
    f"""WITH m AS (SELECT * FROM {MAP_CLEAN_SQL}), p AS (SELECT *, {Q.normalize('original')} AS nk FROM {_pairs} WHERE {_storable}),
f AS (SELECT nk, min({{'original': original, 'fake': fake, 'ptype': ptype}}) AS r FROM p WHERE nk NOT IN (SELECT nk FROM m) GROUP BY nk)
SELECT (SELECT max(id) FROM m) + row_number() OVER (ORDER BY {Q.bucket('nk', 256)}, sha256(nk), nk) AS id,
  CASE r.ptype WHEN 'person' THEN 'Names' WHEN 'location' THEN 'location' ELSE 'Other' END AS label, r.original AS original, r.fake AS fake FROM f""",
)
def map_append(spark, sf_dir):
    """Rows to append: new keys only, no no-ops, no unstored types, consecutive ids."""
    k = F.col("c_custkey")
    pairs = contacts(spark, sf_dir).select(
        F.when(k % 7 == 0, "id").when(k % 2 == 0, "person").otherwise("location").alias("ptype"),
        F.when(k % 2 == 0, F.col("lastname")).otherwise(F.col("city")).alias("original"),
        F.when(k % 10 == 1, F.upper("city")).otherwise(F.concat("firstname", F.lit("x"))).alias("fake"),
    ).distinct()
    return em.new_rows(pairs, entity_map(spark, sf_dir)).select("id", "label", "original", "fake")


@query(
    "map_rewrite",
    f"""WITH u AS (SELECT nk, min(fake || ' Clean') AS fake FROM {MAP_CLEAN_SQL}
  WHERE regexp_matches(fake, '(^FakeCompany_|^FakeOrg_|_[0-9a-fA-F]{{8}}$|_[0-9]{{3,}}$)') GROUP BY nk)
SELECT m.id, m.label, m.original, coalesce(u.fake, m.fake) AS fake FROM (SELECT *, {Q.normalize('original')} AS nk FROM {MAP_SQL}) m LEFT JOIN u USING (nk)""",
)
def map_rewrite(spark, sf_dir):
    """Legacy fakes replaced by clean ones in a new version of the map."""
    m = entity_map(spark, sf_dir)
    dirty = m.where(em.is_legacy_fake(F.col("fake"))).select("original", F.concat("fake", F.lit(" Clean")).alias("fake"))
    return em.rewrite(m, dirty).select("id", "label", "original", "fake")


_codes = f"""SELECT original AS code, min(fake) AS fake FROM {MAP_CLEAN_SQL}
WHERE regexp_matches(original, '^[A-Z]{{4,8}}$') AND label_cf NOT IN ('country', 'location', 'region', 'address') GROUP BY original HAVING count(DISTINCT fake) = 1"""


@query("known_codes", _codes)
def known_codes(spark, sf_dir):
    return em.known_codes(entity_map(spark, sf_dir))


@query(
    "code_prefix_match",
    f"""WITH c AS ({_codes}), w AS (SELECT DISTINCT upper(firstname || lastname) AS word FROM {CONTACTS_SQL})
SELECT word, arg_max(code, length(code)) AS code, arg_max(c.fake, length(code)) AS code_fake FROM w JOIN c ON starts_with(word, code) GROUP BY word""",
)
def code_prefix_match(spark, sf_dir):
    words = contacts(spark, sf_dir).select(F.upper(F.concat("firstname", "lastname")).alias("word")).distinct()
    return orgs.match_code_prefix(words, em.known_codes(entity_map(spark, sf_dir)))


@query(
    "injectivity_report",
    f"""WITH m AS (SELECT *, array_to_string(list_sort(list_filter(regexp_split_to_array(nk, '[\\s,]+'), lambda t: t <> '')), ' ') AS ok
  FROM {MAP_CLEAN_SQL} WHERE NOT excluded)
SELECT 'fake_with_many_originals' AS problem, fake_cf AS value, count(DISTINCT ok) AS n FROM m GROUP BY fake_cf HAVING count(DISTINCT ok) > 1
UNION ALL SELECT 'original_with_many_fakes', nk, count(DISTINCT fake_cf) FROM m GROUP BY nk HAVING count(DISTINCT fake_cf) > 1""",
)
def injectivity_report(spark, sf_dir):
    return em.injectivity_report(entity_map(spark, sf_dir))


@query(
    "learned_tokens",
    f"""WITH m AS (SELECT id, list_filter(regexp_split_to_array(trim(original), '\\s+'), lambda t: t <> '') AS o,
  list_filter(regexp_split_to_array(trim(fake), '\\s+'), lambda t: t <> '') AS f FROM {MAP_CLEAN_SQL} WHERE NOT excluded AND label_cf = 'names'),
p AS (SELECT id, len(o) AS n, o, f, unnest(range(1, len(o) + 1)) AS i FROM m WHERE len(o) = len(f) AND len(o) > 0)
SELECT CASE WHEN n > 1 AND i = n THEN 'last' ELSE 'first' END AS role, {Q.normalize('o[i]')} AS nk, arg_min(f[i], id) AS fake FROM p GROUP BY 1, 2""",
)
def learned_tokens(spark, sf_dir):
    m = entity_map(spark, sf_dir)
    shorter = m.withColumn("fake", F.regexp_replace("fake", "^Fake ", ""))
    return em.learned_tokens(shorter)


# The oracle reads the same shortened fakes.
from checks.base import ORACLES  # noqa: E402

ORACLES["learned_tokens"] = ORACLES["learned_tokens"].replace("trim(fake), '\\s+'", "trim(regexp_replace(fake, '^Fake ', '')), '\\s+'")


@query("highest_map_id", f"SELECT max(id) AS highest, count(*) AS pairs FROM {MAP_SQL}")
def highest_map_id(spark, sf_dir):
    m = entity_map(spark, sf_dir)
    return m.agg(F.max("id").alias("highest"), F.count("*").alias("pairs")).select(em.highest_id(m).scalar().alias("highest"), "pairs")


_guard_values = f"""(SELECT DISTINCT (['person', 'org', 'phone', 'id'])[(c_custkey % 4 + 1)::INT] AS ptype,
  CASE c_custkey % 8 WHEN 0 THEN upper(firstname) WHEN 1 THEN lastname || ', ' || firstname WHEN 2 THEN 'admin' || (c_custkey % 30)
   WHEN 3 THEN email WHEN 4 THEN 'P' || lpad(c_custkey::VARCHAR, 7, '0') WHEN 5 THEN fullname || '.docx' WHEN 6 THEN substr(city, 1, 1)
   ELSE company || ' Qzreserved' END AS original FROM {CONTACTS_SQL})"""
_stop = ", ".join(Q.text(w) for w in C.HARVEST_STOP)


@query(
    "value_guards",
    f"""WITH r AS (SELECT nk, arg_max(label_cf, id) AS label, arg_max(fake, id) AS fake FROM {MAP_CLEAN_SQL} WHERE excluded GROUP BY nk),
v AS (SELECT *, regexp_replace(original, '(?i)\\.docx$', '') AS stem FROM {_guard_values}),
g AS (SELECT v.*, r.label AS rlabel, r.fake AS rfake, {_label} AS own FROM v LEFT JOIN r ON r.nk = {Q.normalize('v.stem')}),
o AS (SELECT *, CASE WHEN length(trim(stem)) <= 1 THEN 'KEPT-SHORT' WHEN rlabel IS NOT NULL AND own = rlabel THEN 'NOT-PII-SKIPPED'
  WHEN rlabel IS NOT NULL THEN 'REUSE-CROSS-TYPE' WHEN contains(lower(stem), 'qzreserved') THEN 'GENERATED-NOT-STORED'
  WHEN ptype IN ('person', 'org') AND NOT contains(trim(stem), ' ') AND (lower(stem) IN ({_stop}) OR regexp_replace(lower(stem), '[0-9]+$', '') IN ({_stop}))
  THEN 'GENERATED-NOT-STORED' END AS outcome,
  CASE WHEN regexp_matches(trim(stem), '^[A-Za-z]{{1,3}}[0-9]{{4,}}$') THEN 'id'
    WHEN ptype <> 'id' AND regexp_matches(trim(stem), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') THEN 'email' ELSE ptype END AS etype FROM g)
SELECT ptype, original, outcome, etype, CASE outcome WHEN 'REUSE-CROSS-TYPE' THEN rfake WHEN NULL THEN NULL ELSE CASE WHEN outcome IS NOT NULL THEN stem END END AS kept_as,
  CASE WHEN etype = 'person' AND contains(stem, ', ') THEN string_split(stem, ', ')[2] || ' ' || string_split(stem, ', ')[1] ELSE stem END AS canon FROM o""",
)
def value_guards(spark, sf_dir):
    """Kept values, effective types and canonical text, before any fake is made."""
    k = F.col("c_custkey")
    original = (
        F.when(k % 8 == 0, F.upper("firstname")).when(k % 8 == 1, F.concat_ws(", ", "lastname", "firstname"))
        .when(k % 8 == 2, F.concat(F.lit("admin"), (k % 30).cast("string"))).when(k % 8 == 3, F.col("email"))
        .when(k % 8 == 4, F.concat(F.lit("P"), F.lpad(k.cast("string"), 7, "0"))).when(k % 8 == 5, F.concat("fullname", F.lit(".docx")))
        .when(k % 8 == 6, F.substring("city", 1, 1)).otherwise(F.concat("company", F.lit(" Qzreserved")))
    )
    ptype = F.element_at(F.array(*[F.lit(x) for x in ("person", "org", "phone", "id")]), (k % 4 + 1).cast("int"))
    v = contacts(spark, sf_dir).select(ptype.alias("ptype"), original.alias("original")).distinct()
    guarded = R.guard(v, entity_map(spark, sf_dir), Config(forced_words={"vexil": "qzreserved"}))
    return guarded.select("ptype", "original", "outcome", "etype", "kept_as", "canon")


@query(
    "email_hints",
    f"""WITH c AS (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN email ELSE replace(string_split(email, '@')[1], '.', '') || '@' || string_split(email, '@')[2] END AS e FROM {CONTACTS_SQL}),
h AS (SELECT e AS email, unnest([{{'token': firstname, 'role': 'first'}}, {{'token': lastname, 'role': 'last'}}]) AS h, c_custkey % 2 = 1 OR firstname = lastname AS whole FROM c)
SELECT email, h.role AS role, h.token AS token, bool_or(whole) AS whole FROM h GROUP BY 1, 2, 3""",
)
def email_hints(spark, sf_dir):
    """Name tokens of the person columns that an address contains, united per address."""
    local, domain = F.split("email", "@")[0], F.split("email", "@")[1]
    glued = F.concat(F.replace(local, F.lit("."), F.lit("")), F.lit("@"), domain)
    rows = contacts(spark, sf_dir).withColumn("e", F.when(F.col("c_custkey") % 2 == 0, F.col("email")).otherwise(glued))
    # Odd rows have no separator and therefore no full match, so only the split name columns count.
    hints = rowhints.email_hints(
        F.col("e"), [(F.col("firstname"), "first"), (F.col("lastname"), "last"), (F.col("fullname"), "full")]
    )
    united = rowhints.union_hints(rows.withColumn("h", hints), "e", "h")
    return united.select("email", F.explode("hints").alias("h")).select("email", "h.role", "h.token", "h.whole")


def _cased(word: str, fake: str) -> str:
    return f"CASE WHEN upper({word}) = {word} THEN upper({fake}) WHEN lower({word}) = {word} THEN lower({fake}) ELSE {fake} END"


# A name of one letter, a stop word or a name that is its own fake is left alone; any other stands for itself wherever it is a
# whole word, also as a word of the sentence or as the last name.
_used = f"length(firstname) >= 2 AND lower(firstname) NOT IN ({_stop}) AND firstname <> w"
_piece = f"CASE WHEN {_used} AND lower(p) = lower(firstname) THEN {_cased('p', 'w')} ELSE p END"


@query(
    "row_fragments",
    f"""SELECT c_custkey, string_agg({_piece}, ' ' ORDER BY i) AS text FROM (
  SELECT *, string_split(company, ' ')[1] AS w, unnest(['File', firstname, 'of', upper(firstname), 'and', lastname, lastname || 'x']) AS p, unnest(range(7)) AS i FROM {CONTACTS_SQL})
GROUP BY c_custkey""",
)
def row_fragments(spark, sf_dir):
    """Words of the row's own names replaced in its text, whole words only."""
    rows = contacts(spark, sf_dir)
    fragments = rowhints.name_fragments([(F.col("firstname"), F.split("company", " ")[0])])
    text = F.concat_ws(" ", F.lit("File"), "firstname", F.lit("of"), F.upper("firstname"), F.lit("and"), "lastname", F.concat("lastname", F.lit("x")))
    return rows.select("c_custkey", rowhints.apply_fragments(text, fragments).alias("text"))


@query("resolve_outcomes", None)
def resolve_outcomes(spark, sf_dir):
    """Audit of a resolve run against the map: which value got what, and why."""
    people = contacts(spark, sf_dir)
    none, hints = F.lit(None).cast("string"), F.array().cast(HINT_TYPE)

    def typed(column, ptype, role):
        return people.select(
            F.lit(ptype).alias("ptype"), F.lit(role).alias("role"), F.col(column).alias("original"), none.alias("country"), hints.alias("hints")
        )

    rows = typed("fullname", "person", "full").unionByName(typed("company", "org", "")).unionByName(typed("phone", "phone", ""))
    v = rows.groupBy("ptype", "role", "original", "country").agg(F.any_value("hints").alias("hints"), F.count("*").alias("n"))
    answer = R.resolve(v, entity_map(spark, sf_dir))
    return R.audit("contact", answer.values)
