"""Value expressions and pure generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fragments as Q
from checks.base import CONTACTS_SQL, contacts, query, table
from veilframe import config as C
from veilframe.config import Config
from veilframe.functions import text as X
from veilframe.functions.seeds import seed
from veilframe.operators import generators as G
from veilframe.operators.allocate import spelled_name
from veilframe.sources import tables

from pyspark.sql import types as T

_ids, _id = Q.permute_ctes("(SELECT c_name AS x FROM customer UNION SELECT s_name FROM supplier)", "x", "veil:id")


@query("id_class_preserving", f"WITH {_ids} SELECT v AS original, fake FROM {_id}")
def id_class_preserving(spark, sf_dir):
    """Class-preserving identifiers of customers and suppliers."""
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("original")).unionByName(
        table(spark, sf_dir, "supplier").select(F.col("s_name").alias("original"))
    )
    return names.distinct().select("original", G.fake_id(F.col("original")).alias("fake"))


_orders = "(SELECT 'ORD-' || lpad(o_orderkey::VARCHAR, 8, '0') || '-A1B2' AS x FROM orders)"
_octe, _on = Q.permute_ctes(_orders, "x", "veil:id")


@query("id_order_numbers", f"WITH {_octe} SELECT v AS original, fake FROM {_on}")
def id_order_numbers(spark, sf_dir):
    """Order numbers with letters, hex letters and digits."""
    number = F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit("-A1B2"))
    return table(spark, sf_dir, "orders").select(number.alias("original")).select(
        "original", G.fake_id(F.col("original")).alias("fake")
    )


_pcte, _pn = Q.permute_ctes(CONTACTS_SQL, "phone", "veil:phone", (Q.DIGITS,))


@query("phone_mask", f"WITH {_pcte} SELECT c_custkey, phone, fake FROM {CONTACTS_SQL} c JOIN {_pn} ON phone = v")
def phone_mask(spark, sf_dir):
    return contacts(spark, sf_dir).select("c_custkey", "phone", G.fake_phone(F.col("phone")).alias("fake"))


_acr = "(SELECT upper(substr(p_type, 1, 3)) || p_size || '-' || upper(substr(p_brand, 1, 2)) AS x FROM part)"
_acte, _an = Q.permute_ctes(_acr, "x", "veil:acronym", Q.PLAIN)


@query("acronym_mask", f"WITH {_acte} SELECT v AS original, fake FROM {_an}")
def acronym_mask(spark, sf_dir):
    code = F.concat(F.upper(F.substring("p_type", 1, 3)), F.col("p_size").cast("string"), F.lit("-"), F.upper(F.substring("p_brand", 1, 2)))
    return table(spark, sf_dir, "part").select(code.alias("original")).distinct().select(
        "original", G.fake_acronym(F.col("original")).alias("fake")
    )


def _share(*parts: str) -> str:
    return f"({Q.seed(Q.text('veil'), Q.text('amount'), *parts)} / 4503599627370496.0::DOUBLE * 0.3::DOUBLE - 0.15::DOUBLE)"


_line = "l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR"


@query(
    "amount_jitter",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(l_extendedprice * (1.0::DOUBLE + {_share("'lineitem'", "'l_extendedprice'", _line)}), 6) AS price,
  round(l_quantity * (1.0::DOUBLE + {_share("'lineitem'", "'l_quantity'", _line)}), 6) AS quantity FROM lineitem""",
)
def amount_jitter(spark, sf_dir):
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]

    def moved(c):
        return F.round(G.fake_amount(F.col(c), T.DoubleType(), F.lit("lineitem"), F.lit(c), *key), 6)

    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        moved("l_extendedprice").alias("price"), moved("l_quantity").alias("quantity"),
    )


@query(
    "amount_decimal_scale",
    f"""SELECT o_orderkey, (p + (p::DOUBLE * {_share("'orders'", "'p'", "o_orderkey::VARCHAR")})::DECIMAL(18, 2))::DOUBLE AS p
FROM (SELECT o_orderkey, o_totalprice::DECIMAL(18, 2) AS p FROM orders)""",
)
def amount_decimal_scale(spark, sf_dir):
    """Decimals keep their scale."""
    priced = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    moved = G.fake_amount(F.col("p"), T.DecimalType(18, 2), F.lit("orders"), F.lit("p"), F.col("o_orderkey").cast("string"))
    return priced.select("o_orderkey", moved.cast("double").alias("p"))


_heads = [h.lower() for h in C.ORG_HEADS]
_host = "regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)"
_labels = f"string_split({_host}, '.')"
_draw = Q.seed(Q.text("veil"), "'host'", "lower(label)")


@query(
    "url_relabel",
    f"""SELECT page_id, url, regexp_extract(url, '^([a-z]+://)', 1)
  || array_to_string(list_transform(labels, lambda l, i: CASE WHEN i = len(labels) - 1 THEN word ELSE l END), '.')
  || substr(url, length(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)) + 1) AS fake
FROM (SELECT *, CASE WHEN {Q.pick(_draw, _heads)} = lower(label) THEN {Q.pick(_draw + ' + 1', _heads)} ELSE {Q.pick(_draw, _heads)} END AS word
  FROM (SELECT page_id, url, {_labels} AS labels, ({_labels})[-2] AS label FROM pages))""",
)
def url_relabel(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", G.fake_url(F.col("url")).alias("fake"))


@query("url_domains", f"SELECT DISTINCT host AS domain, {Q.domain('host')} AS fake FROM (SELECT {_host} AS host FROM pages)")
def url_domains(spark, sf_dir):
    """Domain policy applied to the hosts of pages."""
    hosts = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#:]*)", 1).alias("domain"))
    return hosts.distinct().select("domain", G.fake_domain(F.col("domain")).alias("fake"))


def _country_sql(value: str) -> str:
    n = len(C.COUNTRIES)
    start = f"{Q.seed(Q.text('veil'), Q.text('country'), Q.normalize(value))} % {n}"
    forms = [Q.array([c[i] for c in C.COUNTRIES]) for i in range(3)]
    itself = " OR ".join(f"lower(({f})[start + 1]) = {Q.normalize(value)}" for f in forms)
    at = f"(CASE WHEN {itself} THEN (start + 1) % {n} ELSE start END + 1)"
    letters = f"length(regexp_replace({value}, '[^A-Za-z]', '', 'g'))"
    out = f"CASE {letters} WHEN 2 THEN ({forms[1]})[{at}] WHEN 3 THEN ({forms[2]})[{at}] ELSE ({forms[0]})[{at}] END"
    return start, out


_start, _out = _country_sql("v")


@query(
    "country_swap",
    f"""SELECT v AS original, {Q.case_like('v', 'out')} AS fake FROM (SELECT v, {_out} AS out FROM (SELECT v, {_start} AS start FROM (
  SELECT n_name AS v FROM nation UNION SELECT substr(n_name, 1, 2) FROM nation UNION SELECT lower(substr(r_name, 1, 3)) FROM region
  UNION SELECT r_name FROM region)))""",
)
def country_swap(spark, sf_dir):
    """Names, alpha-2 and alpha-3 shaped values."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    values = (
        n.select(F.col("n_name").alias("original"))
        .unionByName(n.select(F.substring("n_name", 1, 2).alias("original")))
        .unionByName(r.select(F.lower(F.substring("r_name", 1, 3)).alias("original")))
        .unionByName(r.select(F.col("r_name").alias("original")))
        .distinct()
    )
    return values.select("original", G.fake_country(F.col("original")).alias("fake"))


def _draw_sql(tag: str, low: int, span: int) -> str:
    return f"({Q.seed(Q.text('veil'), Q.text('birth'), Q.text(tag), 'v')} % {span} + ({low}))::INT"


@query(
    "birth_shift",
    f"""SELECT v AS original, CASE WHEN has_day THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%Y.%m') END AS fake FROM (
  SELECT v, has_day, (f + to_days(least(CASE WHEN has_day THEN substr(v, 9, 2)::INT ELSE 1 END, day(last_day(f)))::INT - 1
      + CASE WHEN has_day THEN {_draw_sql('d', -5, 11)} ELSE 0 END))::DATE AS d FROM (
    SELECT v, length(v) = 10 AS has_day, (make_date(substr(v, 1, 4)::INT + ([-3, -2, 2, 3])[{_draw_sql('y', 1, 4)}],
      substr(v, 6, 2)::INT, 1) + to_months({_draw_sql('m', -2, 5)}))::DATE AS f FROM (
      SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y.%m') END AS v
      FROM orders)))""",
)
def birth_shift(spark, sf_dir):
    """Text dates with and without a day."""
    orders = table(spark, sf_dir, "orders")
    day, month = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy.MM")
    values = orders.select(F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(month).alias("original")).distinct()
    return values.select("original", G.fake_birth(F.col("original")).alias("fake"))


_zip = "lpad((c_custkey * 7919 % 100000)::VARCHAR, 5, '0') || CASE WHEN c_custkey % 2 = 0 THEN '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') ELSE '' END"


@query(
    "postal_shift",
    f"""SELECT c_custkey, v AS original, array_to_string(list_transform(string_split(v, ''), lambda c, i:
  CASE WHEN c BETWEEN '0' AND '9' THEN ((c::INT + 1 + {Q.byte('s', 'i - 1')} % 8) % 10)::VARCHAR ELSE c END), '') AS fake
FROM (SELECT c_custkey, v, {Q.stream("'veil|zip|' || v", 'length(v)')} AS s FROM (SELECT c_custkey, {_zip} AS v FROM customer))""",
)
def postal_shift(spark, sf_dir):
    k = F.col("c_custkey")
    code = F.concat(
        F.lpad((k * 7919 % 100000).cast("string"), 5, "0"),
        F.when(k % 2 == 0, F.concat(F.lit("-"), F.lpad((k % 10000).cast("string"), 4, "0"))).otherwise(""),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", code.alias("original")).select(
        "c_custkey", "original", G.fake_postal(F.col("original")).alias("fake")
    )


_pool = """SELECT r_name AS country, CASE WHEN c_custkey % 17 = 0 THEN 'ZZZ' ELSE substr(r_name, 1, 3) END || '-' || (c_custkey % 23) AS code
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _observed(spark, sf_dir):
    k = F.col("c_custkey")
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    prefix = F.when(k % 17 == 0, "ZZZ").otherwise(F.substring("r_name", 1, 3))
    return joined.select(F.col("r_name").alias("country"), F.concat(prefix, F.lit("-"), (k % 23).cast("string")).alias("code"))


_pool_rows = f"""WITH d AS (SELECT DISTINCT country, code, string_split(code, '-')[1] AS prefix FROM ({_pool})),
n AS (SELECT country, prefix, count(*) AS n FROM d GROUP BY 1, 2),
m AS (SELECT country, arg_min(prefix, lpad((1000000 - n)::VARCHAR, 8, '0') || prefix) AS prefix, max(n) AS top FROM n GROUP BY 1),
k AS (SELECT d.country, d.code FROM d JOIN m USING (country) WHERE m.top <= 1 OR d.prefix = m.prefix)"""


@query("region_pool", f"{_pool_rows} SELECT country, code FROM k")
def region_pool(spark, sf_dir):
    """Observed codes per country without misfiled ones."""
    return G.region_pool(_observed(spark, sf_dir), ("country", "code")).select("country", "code")


_rdraw = Q.seed(Q.text("veil"), Q.text("region"), "country", Q.normalize("code"))


@query(
    "region_swap",
    f"""{_pool_rows}, p AS (SELECT country, list_sort(list(code)) AS codes FROM k GROUP BY 1)
SELECT country, code, CASE WHEN len(others) > 0 THEN others[{_rdraw} % len(others) + 1] ELSE code END AS fake FROM (
  SELECT d.country, d.code, list_filter(codes, lambda c: lower(c) <> lower(d.code)) AS others FROM d JOIN p USING (country))""",
)
def region_swap(spark, sf_dir):
    observed = _observed(spark, sf_dir)
    values = observed.distinct().withColumnRenamed("code", "canon")
    return G.region_fakes(values, G.region_pool(observed, ("country", "code"))).withColumnRenamed("canon", "code")


FORCED = {"ation": "yzzor", "ou": "ix"}


def _forced_sql(value: str) -> str:
    out = value
    for word, fake in sorted(FORCED.items(), key=lambda p: -len(p[0])):
        for shaped, new in ((word.upper(), fake.upper()), (word.capitalize(), fake.capitalize()), (word, fake)):
            out = f"replace({out}, {Q.text(shaped)}, {Q.text(new)})"
    return out


@query(
    "forced_words",
    f"SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)oU|aT[iI]|At[iI]|atI|ati[oO]N|atiO') AND false THEN text ELSE {_forced_sql('text')} END AS text FROM documents",
)
def forced_words(spark, sf_dir):
    """Words replaced anywhere, in the case of each occurrence."""
    return table(spark, sf_dir, "documents").select("doc_id", X.apply_forced(F.col("text"), FORCED, False).alias("text"))


# Forms of other scripts, their plain letters, and their key: one for each document in turn.
_FORMS = (
    ("ΆΈΉ Σίσυφος", "ΑΕΗ Σισυφος", "αεη σισυφοσ"), ("ﬁne ﬂow", "fine flow", "fine flow"), ("ｶﾞｷﾞ ﾃﾚﾋﾞ", "カキ テレヒ", "カキ テレヒ"), ("５㎏ Ⅳ½", "5kg IV1⁄2", "5kg iv1⁄2"),
    ("İz ẞen Weiß", "Iz ẞen Weiß", "iz ssen weiss"), ("Ёлка Й", "Елка И", "елка и"), ("𝐁𝐨𝐥𝐝 ⑩", "Bold 10", "bold 10"),
)


def _form(at: int) -> str:
    return f"({Q.array([f[at] for f in _FORMS])})[doc_id % {len(_FORMS)} + 1]"


@query(
    "normalize_text",
    f"SELECT doc_id, trim({Q.normalize('text')} || ' ' || {_form(2)}) AS nk, strip_accents(text) || ' ' || {_form(1)} AS plain, regexp_matches(text, '[一-龥]') AS han FROM documents",
)
def normalize_text(spark, sf_dir):
    """Normal form and plain letters of whole texts, with forms of many scripts."""
    form = F.element_at(F.array(*[F.lit(f[0]) for f in _FORMS]), (F.col("doc_id") % len(_FORMS) + 1).cast("int"))
    t = F.concat_ws(" ", "text", form)
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.normalize(t).alias("nk"), X.strip_diacritics(t).alias("plain"), X.is_han(t).alias("han")
    )


@query(
    "fit_width",
    """SELECT doc_id, w, CASE WHEN length(text) <= w THEN text WHEN regexp_matches(substr(text, 1, w), '(?s)^.+ [^ ]*$')
  THEN regexp_replace(regexp_extract(substr(text, 1, w), '(?s)^(.+) [^ ]*$', 1), '\\s+$', '') ELSE substr(text, 1, w) END AS clamped
FROM (SELECT doc_id, text, (doc_id % 60 + 1)::INT AS w FROM documents)""",
)
def fit_width(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % 60 + 1).cast("int").alias("w"))
    return docs.select("doc_id", "w", X.fit_width(F.col("text"), F.col("w")).alias("clamped"))


_cased = "CASE c_custkey % 4 WHEN 0 THEN upper(fullname) WHEN 1 THEN lower(fullname) WHEN 2 THEN fullname ELSE lower(fullname) || 'X' END"


@query("case_like", f"SELECT c_custkey, o, {Q.case_like('o', 'f')} AS shaped FROM (SELECT c_custkey, {_cased} AS o, lower(company) || '-' || city AS f FROM {CONTACTS_SQL})")
def case_like(spark, sf_dir):
    k = F.col("c_custkey") % 4
    o = F.when(k == 0, F.upper("fullname")).when(k == 1, F.lower("fullname")).when(k == 2, F.col("fullname")).otherwise(F.concat(F.lower("fullname"), F.lit("X")))
    rows = contacts(spark, sf_dir).select("c_custkey", o.alias("o"), F.concat(F.lower("company"), F.lit("-"), F.col("city")).alias("f"))
    return rows.select("c_custkey", "o", X.case_like(F.col("o"), F.col("f")).alias("shaped"))


_name_form = "CASE c_custkey % 3 WHEN 0 THEN lastname || ', ' || firstname WHEN 1 THEN fullname ELSE firstname END"


@query(
    "person_tokens",
    f"""SELECT c_custkey, v, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE firstname END AS first, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE lastname END AS last,
  CASE c_custkey % 3 WHEN 0 THEN fullname ELSE v END AS ordered,
  CASE c_custkey % 3 WHEN 2 THEN firstname || '=' || lastname WHEN 0 THEN v || '=' || lastname || ' ' || firstname END AS dropme
FROM (SELECT *, {_name_form} AS v FROM {CONTACTS_SQL})""".replace(
        ",\n  CASE c_custkey % 3 WHEN 2 THEN firstname || '=' || lastname WHEN 0 THEN v || '=' || lastname || ' ' || firstname END AS dropme", ""
    ),
)
def person_tokens(spark, sf_dir):
    """First and last token, and the canonical order of ``Last, First``."""
    k = F.col("c_custkey") % 3
    v = F.when(k == 0, F.concat_ws(", ", "lastname", "firstname")).when(k == 1, F.col("fullname")).otherwise(F.col("firstname"))
    rows = contacts(spark, sf_dir).select("c_custkey", v.alias("v"))
    tokens = X.person_tokens(F.col("v"))
    return rows.select("c_custkey", "v", tokens["first"].alias("first"), tokens["last"].alias("last"), X.first_last(F.col("v")).alias("ordered"))


@query(
    "zip_name_tokens",
    f"""SELECT c_custkey, i AS pos, o[i] AS o, f[i] AS f FROM (SELECT c_custkey, string_split(fullname, ' ') AS o, string_split(company, ' ') AS f,
  unnest(range(1, 3)) AS i FROM {CONTACTS_SQL})""",
)
def zip_name_tokens(spark, sf_dir):
    rows = contacts(spark, sf_dir).select("c_custkey", F.posexplode(X.zip_name_tokens(F.col("fullname"), F.col("company"))).alias("pos", "p"))
    return rows.select("c_custkey", (F.col("pos") + 1).cast("bigint").alias("pos"), "p.o", "p.f")


@query(
    "email_local_parts",
    f"""SELECT c_custkey, regexp_extract(l, '^([^.]*)\\.([A-Za-z]+)([0-9]*)$', 1) AS given, regexp_extract(l, '^([^.]*)\\.([A-Za-z]+)([0-9]*)$', 2) AS surname,
  regexp_extract(l, '^([^.]*)\\.([A-Za-z]+)([0-9]*)$', 3) AS digits, lower(regexp_replace(l, '[^\\p{{L}}\\p{{N}}_.]', '', 'g')) AS wk
FROM (SELECT c_custkey, string_split(email, '@')[1] || CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 50)::VARCHAR ELSE '' END AS l FROM {CONTACTS_SQL})""",
)
def email_local_parts(spark, sf_dir):
    local = F.concat(F.split("email", "@")[0], F.when(F.col("c_custkey") % 2 == 0, (F.col("c_custkey") % 50).cast("string")).otherwise(""))
    rows = contacts(spark, sf_dir).select("c_custkey", local.alias("l"))
    parts = X.split_email_local(F.col("l"))
    return rows.select("c_custkey", parts["given"].alias("given"), parts["surname"].alias("surname"), parts["digits"].alias("digits"), X.word_key(F.col("l")).alias("wk"))


_shapes = """(SELECT c_name AS v FROM customer UNION SELECT 'P' || lpad(c_custkey::VARCHAR, 7, '0') FROM customer
UNION SELECT 'admin' || (c_custkey % 40) FROM customer UNION SELECT c_mktsegment || '.docx' FROM customer
UNION SELECT url FROM pages UNION SELECT substr(sha256(c_name), 1, 24) FROM customer UNION SELECT substr(c_name, 1, 1) FROM customer
UNION SELECT email FROM __C__ UNION SELECT phone FROM __C__ UNION SELECT lastname || ', ' || firstname FROM __C__)""".replace("__C__", CONTACTS_SQL)
_idre = "^(?:[A-Za-z0-9_.\\-]+:)?(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|[0-9a-fA-F]{20,40}|[A-Za-z]{1,3}[0-9]{4,})$"
_stop = ", ".join(Q.text(w) for w in C.HARVEST_STOP)


def _shape_values(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    people = contacts(spark, sf_dir)
    parts = [
        c.select(F.col("c_name").alias("v")),
        c.select(F.concat(F.lit("P"), F.lpad(k.cast("string"), 7, "0")).alias("v")),
        c.select(F.concat(F.lit("admin"), (k % 40).cast("string")).alias("v")),
        c.select(F.concat("c_mktsegment", F.lit(".docx")).alias("v")),
        table(spark, sf_dir, "pages").select(F.col("url").alias("v")),
        c.select(F.substring(F.sha2("c_name", 256), 1, 24).alias("v")),
        c.select(F.substring("c_name", 1, 1).alias("v")),
        people.select(F.col("email").alias("v")),
        people.select(F.col("phone").alias("v")),
        people.select(F.concat_ws(", ", "lastname", "firstname").alias("v")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


@query(
    "class_predicates",
    f"""SELECT v, regexp_matches(trim(v), '{_idre}') AS idlike, regexp_matches(trim(v), '^[A-Za-z][A-Za-z0-9+.\\-]*://\\S+$') AS urllike,
  regexp_matches(trim(v), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') AS email, regexp_matches(trim(v), '^[+()0-9][0-9\\s\\-()]{{5,}}$') AS phone,
  regexp_matches(v, '(?i)^(.+)(\\.(?:{C.FILE_EXTENSIONS}))$') AS filename,
  regexp_replace(v, '(?i)(\\.(?:{C.FILE_EXTENSIONS}))$', '') AS stem,
  (NOT contains(trim(v), ' ')) AND (lower(v) IN ({_stop}) OR regexp_replace(lower(v), '[0-9]+$', '') IN ({_stop})) AS stop FROM {_shapes}""",
)
def class_predicates(spark, sf_dir):
    v = F.col("v")
    return _shape_values(spark, sf_dir).select(
        "v", X.looks_like_id(v).alias("idlike"), X.looks_like_url(v).alias("urllike"), X.looks_like_email(v).alias("email"),
        X.looks_like_phone(v).alias("phone"), X.looks_like_filename(v).alias("filename"), X.file_parts(v)["stem"].alias("stem"),
        X.is_harvest_stop(v).alias("stop"),
    )


@query(
    "seed_values",
    f"SELECT c_custkey, {Q.seed('c_name')} AS s, {Q.spelled_name(Q.seed('c_name') + ' % 51200', C.GIVEN_ENDINGS)} AS spelled FROM customer",
)
def seed_values(spark, sf_dir):
    s = seed(F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", s.alias("s"), spelled_name(s % 51200, C.GIVEN_ENDINGS).alias("spelled"))


@query(
    "ethnicity_hints",
    f"""SELECT DISTINCT w AS nk, CASE WHEN regexp_matches(w, '\\b({'|'.join(C.IND_HINTS)})\\b') THEN 'ind'
  WHEN regexp_matches(w, '\\b({'|'.join(C.CHI_HINTS)})\\b') THEN 'chi' ELSE 'other' END AS ethnicity,
  CASE WHEN w IN ({', '.join(Q.text(x) for x in C.MALE_GIVEN)}) THEN 'male' WHEN w IN ({', '.join(Q.text(x) for x in C.FEMALE_GIVEN)}) THEN 'female' ELSE 'unknown' END AS gender
FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM conversations)""",
)
def ethnicity_hints(spark, sf_dir):
    from veilframe.operators.people import ethnicity, name_gender

    words = table(spark, sf_dir, "conversations").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("nk")
    ).distinct()
    return words.select("nk", ethnicity(F.col("nk")).alias("ethnicity"), name_gender(F.col("nk")).alias("gender"))


_generic = Config(extra_generic_words=("est", "the", "der")).generic_words
_brands = ("ation", "ing", "eau")


@query(
    "span_word_filters",
    f"""SELECT doc_id, len(list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: w IN ({', '.join(Q.text(w) for w in _generic)}))) > 0 AS generic,
  contains(lower(text), 'ation') OR contains(lower(text), 'ing') OR contains(lower(text), 'eau') AS brand,
  lower(trim(text)) IN ({', '.join(Q.text(w) for w in C.PRONOUNS)}) AS pronoun FROM documents""",
)
def span_word_filters(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.has_generic_word(t, _generic).alias("generic"), X.has_known_brand(t, list(_brands)).alias("brand"), X.is_pronoun(t).alias("pronoun")
    )


_acust, _ac = Q.permute_ctes("(SELECT 'CU' || lpad(o_custkey::VARCHAR, 6, '0') AS x FROM orders)", "x", "veil:id", prefix="a")
_bnum, _bn = Q.permute_ctes("(SELECT 'PO' || o_orderkey AS x FROM orders)", "x", "veil:id", prefix="b")


@query(
    "compound_ids",
    f"""WITH {_acust}, {_bnum} SELECT o_orderkey, {_ac}.fake AS customer_fake, {_ac}.fake || '_' || {_bn}.fake AS number_fake
FROM orders JOIN {_ac} ON {_ac}.v = 'CU' || lpad(o_custkey::VARCHAR, 6, '0') JOIN {_bn} ON {_bn}.v = 'PO' || o_orderkey""",
)
def compound_ids(spark, sf_dir):
    """Compound ids that embed another id of the row keep that id's fake."""
    from veilframe.operators.rowhints import atomic_ids, compound_id

    rows = table(spark, sf_dir, "orders", tasks_per_split=8).select(
        "o_orderkey", F.concat(F.lit("CU"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("customer")
    ).withColumn("number", F.concat_ws("_", "customer", F.concat(F.lit("PO"), F.col("o_orderkey").cast("string"))))
    faked = rows.withColumn("customer_fake", G.fake_id(F.col("customer")))
    atoms = atomic_ids([(F.col("customer"), F.col("customer_fake"))])
    return faked.select("o_orderkey", "customer_fake", compound_id(F.col("number"), G.fake_id(F.col("number")), atoms).alias("number_fake"))


@query("schema_restore", "SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus = 'O' END AS open FROM orders")
def schema_restore(spark, sf_dir):
    """Types given back to a table that was flattened to text."""
    k = F.col("o_orderkey")
    flat = table(spark, sf_dir, "orders").select(
        k.cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.when(k % 10 == 0, "").otherwise((F.col("o_orderstatus") == "O").cast("string")).alias("open"),
    )
    target = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()), T.StructField("open", T.BooleanType()),
    ])
    return tables.restore_types(flat, target)


