"""Plans, profiles, keys, sinks and verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fragments as Q
from checks.base import CONTACTS_SQL, contacts, query, table
from checks.expressions import _share
from veilframe import config as C
from veilframe.operators import verify as V
from veilframe.operators.allocate import dense_ids
from veilframe.operators.apply import anonymize
from veilframe.operators.detector import detector_sample
from veilframe.plans import keys as K
from veilframe.plans import plan as P
from veilframe.plans import profile as PR
from veilframe.plans.plan import ColumnPlan, RowFilter
from veilframe.session import materialize
from veilframe.sources import tables as S

CUSTOMER_PLAN = [ColumnPlan("c_name", "id"), ColumnPlan("c_acctbal", "amount")]
_cte, _cn = Q.permute_ctes("customer", "c_name", "veil:id")


@query(
    "customer_copy",
    f"""WITH {_cte} SELECT c_custkey, fake AS c_name, c_nationkey, round(c_acctbal * (1.0::DOUBLE + {_share("'customer'", "'c_acctbal'", 'c_custkey::VARCHAR')}), 6) AS c_acctbal, c_mktsegment
FROM customer JOIN {_cn} ON c_name = v""",
)
def customer_copy(spark, sf_dir):
    """A whole table by its plan: ids resolved and joined back, amounts jittered, the rest untouched."""
    customer = table(spark, sf_dir, "customer")
    copy = anonymize(customer, CUSTOMER_PLAN, "customer", ["c_custkey"]).df
    return copy.withColumn("c_acctbal", F.round("c_acctbal", 6))


CONTACT_PLAN = [
    ColumnPlan("firstname", "person"), ColumnPlan("lastname", "person"), ColumnPlan("fullname", "person"),
    ColumnPlan("email", "email"), ColumnPlan("phone", "phone"), ColumnPlan("company", "org"), ColumnPlan("city", "location"),
]


@query("contact_copy")
def contact_copy(spark, sf_dir):
    """Contacts by their plan; names, addresses and companies agree across columns."""
    return anonymize(contacts(spark, sf_dir), CONTACT_PLAN, "contact", ["c_custkey"]).df


_stops = ", ".join(Q.text(w) for w in C.HARVEST_STOP)
_first_stop, _last_stop = f"lower(firstname) IN ({_stops})", f"lower(lastname) IN ({_stops})"


@query(
    "contact_copy_check",
    f"""SELECT count(*) AS rows, count(*) FILTER (WHERE NOT {_first_stop} AND NOT {_last_stop}) AS same_shape,
  (count(*) FILTER (WHERE {_first_stop}) + count(*) FILTER (WHERE {_last_stop}))::BIGINT AS residual, 0::BIGINT AS shared FROM {CONTACTS_SQL}""",
)
def contact_copy_check(spark, sf_dir):
    """Properties of the contact copy: full name made of first and last, only stop words kept, no fake shared."""
    source = contacts(spark, sf_dir)
    copy = contact_copy(spark, sf_dir)
    both = source.select("c_custkey", *[F.col(p.column).alias(f"o_{p.column}") for p in CONTACT_PLAN]).join(copy, "c_custkey")
    both = materialize(both, "copied")  # read by eight counts
    kept = sum((F.col(f"o_{p.column}") == F.col(p.column)).cast("int") for p in CONTACT_PLAN if p.column != "phone")
    shape = (F.concat_ws(" ", "firstname", "lastname") == F.col("fullname")) & F.contains("email", F.lit("@"))
    shared = [
        both.groupBy(F.lower(p.column)).agg(F.count_distinct(F.lower(f"o_{p.column}")).alias("n")).agg(F.count_if(F.col("n") > 1)).scalar()
        for p in CONTACT_PLAN
    ]
    total = shared[0]
    for s in shared[1:]:
        total = total + s
    counts = both.agg(
        F.count("*").alias("rows"), F.count_if(shape).alias("same_shape"), F.sum(kept).cast("bigint").alias("residual")
    )
    return counts.select("rows", "same_shape", "residual", total.alias("shared"))


def _profile_sql(table_name: str, column: str) -> str:
    c = column
    counted = f"{c} IS NOT NULL AND length({c}) > 1"

    def hits(pattern: str) -> str:
        return f"count(*) FILTER (WHERE {counted} AND regexp_matches(trim({c}), '{pattern}'))"

    idlike = "^(?:[A-Za-z0-9_.\\-]+:)?(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|[0-9a-fA-F]{20,40}|[A-Za-z]{1,3}[0-9]{4,})$"
    return (
        f"SELECT '{column}' AS \"column\", count(*) FILTER (WHERE {counted}) AS n, coalesce(sum(length({c})) FILTER (WHERE {counted}), 0)::BIGINT AS total_len, "
        + hits("^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$") + " AS emails, " + hits("^[+()0-9][0-9\\s\\-()]{5,}$") + " AS phones, "
        + hits(idlike) + " AS idlike, " + hits("^[A-Za-z][A-Za-z0-9+.\\-]*://\\S+$") + f" AS urllike FROM {table_name}"
    )


_profiled = [("customer", ["c_name", "c_mktsegment"]), ("orders", ["o_orderstatus", "o_orderpriority"]), ("documents", ["text", "lang", "source"]),
             ("pages", ["url", "html"]), (CONTACTS_SQL, ["firstname", "lastname", "fullname", "email", "phone", "company", "city"])]
_profile_all = " UNION ALL ".join(_profile_sql(t, c) for t, columns in _profiled for c in columns)


def _frames(spark, sf_dir):
    return [
        table(spark, sf_dir, "customer").select("c_name", "c_mktsegment"), table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"),
        contacts(spark, sf_dir).select("firstname", "lastname", "fullname", "email", "phone", "company", "city"),
    ]


@query("profile_columns", _profile_all)
def profile_columns(spark, sf_dir):
    """One pass per table over all text columns."""
    frames = [PR.profile_columns(f) for f in _frames(spark, sf_dir)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _hint(kind: str) -> str:
    return f"regexp_matches(\"column\", {Q.text('(?i)' + C.HINTS[kind])})"


_rules = [
    (_hint("reference"), "skip", "structured", "0.0"), (_hint("country"), "country", "structured", "0.7"),
    (_hint("location"), "location", "structured", "0.6"),
    (f"{_hint('email')} OR emails / n > 0.3", "email", "structured", "greatest(0.6, emails / n)"),
    (f"{_hint('phone')} OR phones / n > 0.3", "phone", "structured", "greatest(0.6, phones / n)"),
    ("idlike / n > 0.5", "id", "structured", "0.3"), ("urllike / n > 0.5", "url", "structured", "0.3"),
    ("total_len / n > 80", "freetext", "freetext", "0.5"), (_hint("name"), "person", "structured", "0.7"),
    (_hint("org"), "org", "structured", "0.6"), (_hint("skip"), "skip", "structured", "0.0"),
]


def _case(i: int, other: str) -> str:
    return "CASE " + " ".join(f"WHEN {r[0]} THEN {r[i] if i == 3 else Q.text(r[i])}" for r in _rules) + f" ELSE {other} END"


_text_rows = f"""SELECT "column", {_case(1, "'org'")} AS type, {_case(2, "'structured'")} AS mode,
  ({_case(3, '0.0')})::DOUBLE >= 0.55 AS enabled, round(({_case(3, '0.0')})::DOUBLE, 2) AS confidence FROM ({_profile_all}) WHERE n > 0"""
_amounts = " UNION ALL ".join(f"SELECT '{c}', 'amount', 'structured', false, 0.5::DOUBLE" for c in ("o_totalprice",))


@query("analyze_plan", f"{_text_rows} UNION ALL {_amounts}")
def analyze_plan(spark, sf_dir):
    """Proposed plans of five tables, by column names and value shapes."""
    plans = [PR.analyze(f, samples=0) for f in _frames(spark, sf_dir)]
    out = plans[0]
    for p in plans[1:]:
        out = out.unionByName(p)
    return out.select("column", "type", "mode", "enabled", "confidence")


@query("analyze_detected")
def analyze_detected(spark, sf_dir):
    """Plan of the documents with the rule detector run on a few values per column."""
    docs = table(spark, sf_dir, "documents")
    seen = detector_sample(docs, ["text", "lang", "source"])
    return PR.analyze(docs, seen, samples=3).select("column", "type", "enabled", "confidence", F.size("samples").alias("shown"))


@query(
    "set_plan",
    f"""SELECT "column", CASE lower("column") WHEN 'c_mktsegment' THEN 'org_code' WHEN 'text' THEN 'freetext' WHEN 'city' THEN 'org' ELSE type END AS type,
  CASE lower("column") WHEN 'text' THEN 'freetext' WHEN 'c_mktsegment' THEN 'structured' WHEN 'city' THEN 'structured' ELSE mode END AS mode,
  lower("column") IN ('c_mktsegment', 'text', 'city') AS enabled FROM ({_text_rows} UNION ALL {_amounts})""",
)
def set_plan(spark, sf_dir):
    """Exactly the named columns enabled, with their types."""
    edited = P.set_plan(analyze_plan(spark, sf_dir), {"C_MKTSEGMENT": "org_code", "text": "freetext", "City": None})
    return edited.select("column", "type", "mode", "enabled")


@query(
    "person_roles",
    """SELECT "column", CASE WHEN "column" IN ('firstname') THEN 'first' WHEN "column" IN ('lastname') THEN 'last' ELSE 'full' END AS role FROM
 (SELECT unnest(['firstname', 'lastname', 'fullname', 'email', 'phone', 'company', 'city']) AS "column" FROM (SELECT count(*) FROM customer))""",
)
def person_roles(spark, sf_dir):
    profile = PR.profile_columns(_frames(spark, sf_dir)[4])
    return profile.select("column", P.person_role_expr(F.col("column")).alias("role"))


@query(
    "value_samples",
    """SELECT "column", rank, value FROM (SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY sha256(value), value) AS rank FROM (
  SELECT 'text' AS "column", text AS value FROM documents UNION ALL SELECT 'source', source FROM documents) WHERE length(value) > 1)
WHERE rank <= 20""",
)
def value_samples(spark, sf_dir):
    """The same twenty values per column every time."""
    return PR.sample_values(table(spark, sf_dir, "documents"), ["text", "source"], 20, 1 << 30).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@query(
    "detector_majority",
    "SELECT event_type AS \"column\", arg_min(k, lpad((100000000 - n)::VARCHAR, 12, '0') || k) AS majority FROM (SELECT event_type, (user_id % 7)::VARCHAR AS k, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1",
)
def detector_majority(spark, sf_dir):
    """Most frequent label per group."""
    e = table(spark, sf_dir, "events")
    return PR.detector_majority(e.select(F.col("event_type").alias("column"), (F.col("user_id") % 7).cast("string").alias("type")))


@query(
    "row_filter",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O', 'P') THEN round(o_totalprice * (1.0::DOUBLE + {_share("'orders'", "'o_totalprice'", 'o_orderkey::VARCHAR')}), 6) ELSE round(o_totalprice, 6) END AS o_totalprice
FROM orders""",
)
def row_filter(spark, sf_dir):
    """Only rows whose status is listed are changed."""
    plan = [ColumnPlan("o_totalprice", "amount", row_filter=RowFilter("O_ORDERSTATUS", ("O", "P")))]
    copy = anonymize(table(spark, sf_dir, "orders"), plan, "orders", ["o_orderkey"]).df
    return copy.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"))


@query(
    "key_uniqueness",
    """SELECT 'orders' AS t, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders
UNION ALL SELECT 'lineitem', sum(n)::BIGINT, count(*), sum(n) = count(*) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'labels', sum(n)::BIGINT, count(*), sum(n) = count(*) FROM (SELECT count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality, lang)""",
)
def key_uniqueness(spark, sf_dir):
    """Key proofs with composite and null key parts."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    parts = [("orders", table(spark, sf_dir, "orders"), ["o_orderkey"]), ("lineitem", table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
             ("labels", labelled, ["quality", "lang"])]
    frames = [K.key_uniqueness(df, keys).withColumn("t", F.lit(t)) for t, df, keys in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return K.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("key_choice", "SELECT o_orderkey, n FROM (SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderkey) AS n FROM orders)")
def key_choice(spark, sf_dir):
    """Rows under the key that was chosen and proven for the table."""
    orders = table(spark, sf_dir, "orders")
    key = K.choose_key(orders, source_key=["o_orderkey"])
    from pyspark.sql import Window

    return orders.select("o_orderkey", F.count("*").over(Window.partitionBy(*key)).alias("n"))


_sources = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    "conversations": ["role", "turn", "conv_id"],
}
_pairs = [(t, a, b, i) for t, c in _sources.items() for i, (a, b) in enumerate((a, b) for n, a in enumerate(c) for b in c[n + 1 :])]
_pair_sql = " UNION ALL ".join(
    f"SELECT '{t}' AS t, '{a},{b}' AS key, {i} AS i, count(*) AS rows, count(DISTINCT (coalesce({a}::VARCHAR, '-'), coalesce({b}::VARCHAR, '-'))) AS d FROM {t}" for t, a, b, i in _pairs
)


@query("key_search", f"SELECT t, arg_min(key, i) AS key, min(rows) AS rows FROM ({_pair_sql}) WHERE rows = d GROUP BY t")
def key_search(spark, sf_dir):
    """The first smallest set of columns that identifies the rows, found among all columns and proven."""
    frames = []
    for name, columns in _sources.items():
        rows = table(spark, sf_dir, name).select(*columns)
        key = K.find_key(rows)
        frames.append(K.key_uniqueness(rows, key).where("is_unique").select(F.lit(name).alias("t"), F.lit(",".join(key)).alias("key"), "rows"))
    return frames[0].unionByName(frames[1])


@query("scan_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500")
def scan_sample(spark, sf_dir):
    """A stable sample of a scan: projection, order and row budget."""
    top = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return S.scan(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"], 500, top)


@query(
    "schema_columns",
    """SELECT position::INT AS position, name AS "column", n FROM (SELECT unnest(['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice']) AS name, unnest(range(6)) AS position),
 (SELECT count(*) AS n FROM part)""",
)
def schema_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return S.describe(part).select("position", "column", part.agg(F.count("*").alias("n")).scalar().alias("n"))


@query("empty_copy", "SELECT * FROM customer WHERE false")
def empty_copy(spark, sf_dir):
    return S.empty_copy(table(spark, sf_dir, "customer"))


@query(
    "merge_columns",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN d.source || ':' || l.quality ELSE d.source END AS source, d.lang
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def merge_columns(spark, sf_dir):
    """One column of an existing copy replaced by key; the others stay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    changed = docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", F.concat_ws(":", "source", F.col("quality").cast("string")).alias("source"), F.lit("xx").alias("lang")
    )
    return S.merge_columns(docs, changed, ["doc_id"], ["source"])


@query(
    "null_safe_keys",
    """WITH d AS (SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT lang, quality, count(*) AS n FROM d WHERE EXISTS (SELECT 1 FROM d w WHERE w.quality IS DISTINCT FROM 1 AND w.lang IS NOT DISTINCT FROM d.lang AND w.quality IS NOT DISTINCT FROM d.quality) GROUP BY 1, 2""",
)
def null_safe_keys(spark, sf_dir):
    """Keyed fetch where a key part may be null."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "lang", "quality")
    wanted = docs.where("quality is null or quality <> 1").select("lang", "quality").distinct()
    return S.fetch_keys(docs, wanted, ["lang", "quality"]).groupBy("lang", "quality").agg(F.count("*").alias("n"))


@query(
    "text_write_back",
    """SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND length(text) + 2 <= 500 THEN '<' || text || '>' ELSE text END AS text FROM documents""",
)
def text_write_back(spark, sf_dir):
    """Exchanged texts put back by row id; those that do not fit are skipped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    updates = docs.where("doc_id % 2 = 0").select(
        F.col("doc_id").cast("string").alias("row_id"), F.concat(F.lit("<"), F.col("text"), F.lit(">")).alias("text")
    )
    return S.write_back(docs, updates, "doc_id", "text", 500)


@query(
    "dense_ids",
    f"SELECT c_name, 1000 + row_number() OVER (ORDER BY {Q.bucket('c_name', 256)}, sha256(c_name), c_name) AS id FROM customer",
)
def dense_ids_query(spark, sf_dir):
    """Consecutive ids without a global sort."""
    return dense_ids(table(spark, sf_dir, "customer").select("c_name"), "c_name", 1000)


# --- verification: a copy that keeps every third name ---------------------------


def _copied(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.col("c_name")).otherwise(F.concat(F.lit("X"), F.col("c_name")))
    segment = F.when(k % 5 == 0, F.col("c_mktsegment")).otherwise(F.lit("FURNITURE"))
    return customer, customer.withColumn("c_name", name).withColumn("c_mktsegment", segment).where(k % 50 != 7)


VERIFY_PLAN = [ColumnPlan("c_name", "id"), ColumnPlan("c_mktsegment", "org", row_filter=RowFilter("c_nationkey", ("1", "2", "3")))]
_copy = """(SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'X' || c_name END AS c_name,
  CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE 'FURNITURE' END AS c_mktsegment FROM customer WHERE c_custkey % 50 <> 7)"""
_residual = f"""SELECT 'c_name' AS "column", 'id' AS type, 'structured' AS mode, count(*) FILTER (WHERE s.c_name = t.c_name) AS residual FROM customer s JOIN {_copy} t USING (c_custkey)
UNION ALL SELECT 'c_mktsegment', 'org', 'structured', count(*) FILTER (WHERE s.c_mktsegment = t.c_mktsegment AND s.c_nationkey IN (1, 2, 3)) FROM customer s JOIN {_copy} t USING (c_custkey)"""


@query("verify_residual", _residual)
def verify_residual(spark, sf_dir):
    source, copy = _copied(spark, sf_dir)
    return V.residual_rows(source, copy, ["c_custkey"], VERIFY_PLAN)


@query(
    "verify_without_key",
    f"""SELECT 'c_name' AS "column", 'id' AS type, 'structured' AS mode, count(*) AS residual FROM (SELECT DISTINCT c_name FROM {_copy}) WHERE c_name IN (SELECT c_name FROM customer)
UNION ALL SELECT 'c_mktsegment', 'org', 'structured', count(*) FROM (SELECT DISTINCT c_mktsegment FROM {_copy}) WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_nationkey IN (1, 2, 3))""",
)
def verify_without_key(spark, sf_dir):
    source, copy = _copied(spark, sf_dir)
    return V.residual_values(source, copy, VERIFY_PLAN)


@query(
    "verify_verdict",
    f"""SELECT s AS source_rows, t AS target_rows, s = t AS matches, (SELECT count(*) FROM ({_residual}) WHERE residual > 0) AS residual_columns,
  CASE WHEN s = t AND (SELECT count(*) FROM ({_residual}) WHERE residual > 0) = 0 THEN 'PASS' ELSE 'REVIEW' END AS verdict
FROM (SELECT count(*) AS s FROM customer), (SELECT count(*) AS t FROM {_copy})""",
)
def verify_verdict(spark, sf_dir):
    source, copy = _copied(spark, sf_dir)
    checks = V.verify(source, copy, VERIFY_PLAN, ["c_custkey"])
    verdict = checks["verdict"]
    return checks["counts"].select(
        "source_rows", "target_rows", "matches",
        verdict.select("residual_columns").scalar().alias("residual_columns"), verdict.select("verdict").scalar().alias("verdict"),
    )


@query(
    "word_residue",
    """SELECT c AS "column", w AS word, count(*) FILTER (WHERE contains(lower(v), w)) AS cells FROM (
  SELECT 'text' AS c, text AS v FROM documents UNION ALL SELECT 'source', source FROM documents), (SELECT unnest(['eau', 'web', 'tion']) AS w) GROUP BY 1, 2""",
)
def word_residue(spark, sf_dir):
    return V.word_residue(table(spark, sf_dir, "documents"), ["eau", "web", "tion"], ["text", "source"])


@query("plan_status", f"SELECT count(*) FILTER (WHERE enabled) AS enabled_columns, (SELECT count(*) FROM {_copy}) AS rows_done FROM ({_text_rows})")
def plan_status(spark, sf_dir):
    plan = analyze_plan(spark, sf_dir)
    return V.status(plan, _copied(spark, sf_dir)[1])


