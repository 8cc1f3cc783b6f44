"""Free text: windows, patterns, dictionaries, JSON, places and the incremental copy."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import functions as F

from checks import fragments as Q
from checks.allocation import DOC_MAILS, mail_fakes
from checks.base import CONTACTS_SQL, contacts, query, table
from checks.tables import CUSTOMER_PLAN
from veilframe.functions import text as X
from veilframe.operators import detector, dictionary as D, freetext as FT, geo, spans as S, verify as V
from veilframe.session import scratch_path
from veilframe.functions.seeds import literal_array
from veilframe.streaming.incremental import IncrementalAnonymizer


@query(
    "text_windows",
    """SELECT doc_id, (i * 700)::INT AS "offset", substr(text, i * 700 + 1, 800) AS piece FROM (
  SELECT doc_id, text, unnest(range(0, greatest(0, ceil((length(text) - 800) / 700.0))::INT + 1)) AS i FROM documents WHERE length(text) > 0)""",
)
def text_windows(spark, sf_dir):
    """Overlapping windows over whole texts."""
    return S.explode_windows(table(spark, sf_dir, "documents"), ["doc_id"], "text")


# The names of HTML as a table, and references that pages rarely have, one for each page in turn.
_names = ", ".join(f"({Q.text('&' + n)}, {Q.text(c)})" for n, c in sorted(html5.items()) if n.endswith(";"))
_rare = ("&eacute;&Omega; caf&eacute;", "&#233;&#xE9;", "&hearts;&#128640;", "&NotEqualTilde; &fjlig;", "&unknown; &#8364;", "&#x20AC;&lt;b&gt;")
_number = "CASE WHEN p LIKE '&#x%' THEN ('0x' || regexp_extract(p, '[0-9A-Fa-f]+', 0))::INT ELSE regexp_extract(p, '[0-9]+', 0)::INT END"


@query(
    "html_strip",
    f"""WITH names(name, char) AS (VALUES {_names}), t AS (SELECT page_id, regexp_replace(regexp_replace(html || ({Q.array(_rare)})[page_id % {len(_rare)} + 1], '(?i)&nbsp;|&#160;', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages),
piece AS (SELECT page_id, unnest(regexp_extract_all(t, '&#?[A-Za-z0-9]+;|[^&]+|&')) AS p, unnest(range(len(regexp_extract_all(t, '&#?[A-Za-z0-9]+;|[^&]+|&')))) AS i FROM t)
SELECT page_id, trim(regexp_replace(string_agg(CASE WHEN p LIKE '&#%;' THEN chr({_number}) ELSE coalesce(char, p) END, '' ORDER BY i), '\\s+', ' ', 'g')) AS text
FROM piece LEFT JOIN names ON p = name GROUP BY page_id""",
)
def html_strip(spark, sf_dir):
    """Visible text of pages, every kind of character reference decoded."""
    rare = F.element_at(literal_array(_rare), (F.col("page_id") % len(_rare) + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", X.strip_html(F.concat("html", rare)).alias("text"))


@query("json_escape", "SELECT doc_id, substr(to_json(text)::VARCHAR, 2, length(to_json(text)::VARCHAR) - 2) AS escaped FROM documents")
def json_escape(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.json_escape(F.col("text")).alias("escaped"))


@query(
    "json_safety",
    """SELECT event_id, CASE WHEN event_id % 4 IN (1, 2) THEN 'safe' ELSE scrubbed END AS out, 'k,u' AS keys FROM (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"k": 1, "u": "x"}' WHEN 1 THEN '{"k": x}' WHEN 2 THEN '{"q": 1, "u": 2}' ELSE '{"u": "y", "k": [1]}' END AS scrubbed FROM events)""",
)
def json_safety(spark, sf_dir):
    """Text that stops being JSON, or changes its keys, falls back to the safe version."""
    k = F.col("event_id") % 4
    original = F.concat(F.regexp_replace("props", "\\}$", ""), F.lit(', "u": "a \\" b"}'))
    scrubbed = (
        F.when(k == 0, '{"k": 1, "u": "x"}').when(k == 1, '{"k": x}').when(k == 2, '{"q": 1, "u": 2}').otherwise('{"u": "y", "k": [1]}')
    )
    return table(spark, sf_dir, "events").select(
        "event_id", FT.json_safe(original, scrubbed, F.lit("safe")).alias("out"), F.array_join(X.json_keys(original), ",").alias("keys")
    )


@query("email_harvest", f"SELECT e AS original, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '{Q.EMAIL_PATTERN}')) AS e FROM documents) GROUP BY 1")
def email_harvest(spark, sf_dir):
    """Distinct addresses of the documents with the number of documents that mention each."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.explode(FT.emails_in(F.col("text"))).alias("original")).groupBy("original").agg(F.count("*").alias("n"))


@query(
    "email_scrub",
    f"""WITH {mail_fakes(DOC_MAILS)},
p AS (SELECT doc_id, text, regexp_split_to_array(text, '{Q.EMAIL_PATTERN}') AS gaps, regexp_extract_all(text, '{Q.EMAIL_PATTERN}') AS hits FROM documents),
x AS (SELECT doc_id, gaps, unnest(hits) AS hit, unnest(range(1, len(hits) + 1)) AS i FROM p WHERE len(hits) > 0)
SELECT doc_id, min(gaps)[1] || string_agg(fake || gaps[i + 1], '' ORDER BY i) AS text FROM x JOIN mf ON mf.nk = lower(hit) GROUP BY doc_id
UNION ALL SELECT doc_id, text FROM p WHERE len(hits) = 0""",
)
def email_scrub(spark, sf_dir):
    """Documents scrubbed end to end; what they hold to find are addresses."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scrubbed, _ = FT.scrub_columns(docs, ["text"])
    return scrubbed


# --- dictionaries ---------------------------------------------------------------

_token = "[\\p{L}\\p{N}]+"
_three = f"list_transform(regexp_extract_all(lower(text), '{_token}'), lambda t: t)"


def _phrases(spark, sf_dir):
    """The first three words of every benchmark item, as it spells them."""
    head = F.regexp_extract("text", f"({_token}[^\\p{{L}}\\p{{N}}]+{_token}[^\\p{{L}}\\p{{N}}]+{_token})", 1)
    return table(spark, sf_dir, "benchmark").select(head.alias("entry")).distinct().withColumn("fake", F.upper(F.reverse("entry")))


_phrase_sql = f"(SELECT DISTINCT regexp_extract(text, '({_token}[^\\p{{L}}\\p{{N}}]+{_token}[^\\p{{L}}\\p{{N}}]+{_token})', 1) AS entry FROM benchmark)"


@query(
    "dictionary_entries",
    f"""WITH d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '{_token}'), ' ') || ' ' AS t FROM documents),
e AS (SELECT DISTINCT lower(entry) AS entry_key, ' ' || array_to_string(regexp_extract_all(lower(entry), '{_token}'), ' ') || ' ' AS k FROM {_phrase_sql})
SELECT doc_id, entry_key FROM d JOIN e ON contains(t, k)""",
)
def dictionary_entries(spark, sf_dir):
    """Which dictionary phrases occur in which document, by a join on word n-grams."""
    prepared = D.prepare(_phrases(spark, sf_dir), D.MAP_SCRUB)
    found = D.found_entries(table(spark, sf_dir, "documents"), "doc_id", "text", prepared, D.MAP_SCRUB)
    return found.select("doc_id", "entry_key").distinct()


_dict_words = f"(SELECT DISTINCT w AS entry, 'Q' || reverse(w) AS fake FROM (SELECT unnest(regexp_extract_all(lower(text), '{_token}')) AS w FROM benchmark) WHERE length(w) >= 5)"


def _words(spark, sf_dir):
    w = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_token), F.lit(0)))
    words = table(spark, sf_dir, "benchmark").select(w.alias("entry")).where(F.length("entry") >= 5).distinct()
    return words.withColumn("fake", F.concat(F.lit("Q"), F.reverse("entry")))


_scrubbed = f"""SELECT doc_id, string_agg(coalesce(fake, piece), '' ORDER BY i) AS text, count(fake) AS c, min(old) AS old FROM (
  SELECT doc_id, text AS old, unnest(regexp_extract_all(text, '{_token}|[^\\p{{L}}\\p{{N}}]+')) AS piece,
    unnest(range(1, len(regexp_extract_all(text, '{_token}|[^\\p{{L}}\\p{{N}}]+')) + 1)) AS i FROM documents) p LEFT JOIN {_dict_words} w ON w.entry = lower(p.piece) GROUP BY doc_id"""


@query(
    "map_scrub",
    f"""SELECT doc_id, CASE WHEN c > 0 AND length(text) <= 15000 THEN text ELSE old END AS text, CASE WHEN length(text) <= 15000 THEN c ELSE 0 END AS replacements,
  c > 0 AND length(text) > 15000 AS skipped FROM ({_scrubbed})""",
)
def map_scrub(spark, sf_dir):
    """Every dictionary word replaced in every document, texts that would not fit left alone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scrubbed = D.scrub_with_map(docs, "text", _words(spark, sf_dir), D.MAP_SCRUB, 15000)
    return scrubbed.withColumn("replacements", F.col("replacements").cast("bigint"))


@query(
    "scrub_statistics",
    f"""SELECT count(*) FILTER (WHERE c > 0 AND length(text) <= 15000) AS cells_changed, coalesce(sum(c) FILTER (WHERE length(text) <= 15000), 0)::BIGINT AS replacements,
  count(*) FILTER (WHERE c > 0 AND length(text) > 15000) AS skipped_overflow FROM ({_scrubbed})""",
)
def scrub_statistics(spark, sf_dir):
    return D.scrub_statistics(map_scrub(spark, sf_dir))


@query(
    "leak_report",
    f"""WITH t AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{_token}'))) AS w FROM documents),
h AS (SELECT doc_id FROM t JOIN {_dict_words} d ON d.entry = t.w),
s AS (SELECT count(*) AS n FROM documents WHERE source IN (SELECT DISTINCT source FROM documents)),
k AS (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id % 4 = 0) AS kept FROM documents)
SELECT 'embedded' AS kind, count(*) AS pii, count(*) FILTER (WHERE doc_id % 4 = 0) AS leaked FROM h
UNION ALL SELECT 'whole_cell', n, kept FROM k""",
)
def leak_report(spark, sf_dir):
    """Originals that survive in a copy in which only every fourth document was left as it was."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    words = _words(spark, sf_dir)
    scrubbed = D.scrub_with_map(docs, "text", words, D.MAP_SCRUB).select("doc_id", F.col("text").alias("new"))
    copy = docs.join(scrubbed, "doc_id").select(
        F.when(F.col("doc_id") % 4 == 0, F.col("text")).otherwise(F.col("new")).alias("text"),
        F.when(F.col("doc_id") % 4 == 0, F.col("source")).otherwise(F.lit("-")).alias("source"),
    )
    known = words.unionByName(docs.select(F.col("source").alias("entry")).distinct().withColumn("fake", F.lit("x")))
    return V.leak_report(docs, copy, ["text", "source"], known).select("kind", "pii", "leaked")


_literals = {"nav": "Harbor", "the": "Onyx", "que": "sable", "body": "TITAN", "article": "Quill", "und": "vireo"}
_lit_case = "CASE lower(w) " + " ".join(f"WHEN {Q.text(k)} THEN {Q.text(v)}" for k, v in _literals.items()) + " END"


def _literal_sql(fake: str, shown: str) -> str:
    """Pages with words outside of tags and away from an @ replaced; ``fake`` is null for the others, ``shown`` what is put in."""
    return f"""WITH s AS (SELECT page_id, unnest(regexp_extract_all(html, '<[^>]+>|[^<]+|<')) AS seg, unnest(range(1, len(regexp_extract_all(html, '<[^>]+>|[^<]+|<')) + 1)) AS i FROM pages),
w AS (SELECT page_id, i, seg, unnest(CASE WHEN regexp_matches(seg, '^<[^>]+>$') THEN [seg] ELSE regexp_extract_all(seg, '[A-Za-z0-9]+|[^A-Za-z0-9]+') END) AS w,
  unnest(range(1, len(CASE WHEN regexp_matches(seg, '^<[^>]+>$') THEN [seg] ELSE regexp_extract_all(seg, '[A-Za-z0-9]+|[^A-Za-z0-9]+') END) + 1)) AS j FROM s),
n AS (SELECT *, lag(w) OVER (PARTITION BY page_id ORDER BY i, j) AS before, lead(w) OVER (PARTITION BY page_id ORDER BY i, j) AS after, {fake} AS f FROM w)
SELECT page_id, string_agg(CASE WHEN f IS NOT NULL AND NOT coalesce(ends_with(before, '@'), false) AND NOT coalesce(starts_with(after, '@'), false)
  THEN {shown} ELSE w END, '' ORDER BY i, j) AS html FROM n GROUP BY page_id"""


@query("literal_map_tag_safe", _literal_sql(_lit_case, Q.case_like("w", "f")))
def literal_map_tag_safe(spark, sf_dir):
    """Words replaced in the prose of pages; markup stays byte for byte."""
    entries = X.literal_map(_literals)
    return table(spark, sf_dir, "pages").select("page_id", D.replace_entries(F.col("html"), entries, D.LITERAL).alias("html"))


# Codes are put in as they are, companies in the case of the word.
_curated = "CASE lower(w) WHEN 'article' THEN 'Vertex Labs' WHEN 'est' THEN 'C_TKH' END"


@query("curated_companies", _literal_sql(_curated, f"CASE WHEN lower(w) = 'est' THEN f ELSE {Q.case_like('w', 'f')} END"))
def curated_companies(spark, sf_dir):
    """Company and exact-code dictionaries applied to pages before and after detection."""
    from veilframe.config import Config

    config = Config(company_map={"article": "Vertex Labs"}, exact_code_map={"est": "C_TKH"})
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", FT.curated(F.col("html"), config).alias("html"))


# --- spans ------------------------------------------------------------------------

_spans = "(SELECT DISTINCT l_orderkey AS k, (l_partkey % 100)::INT AS s, (l_partkey % 100 + l_quantity)::INT AS e, l_returnflag AS t FROM lineitem)"


@query(
    "span_select",
    f"""WITH RECURSIVE n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s, e DESC, t) AS rn FROM {_spans}),
x AS (SELECT a.k, a.rn, min(b.rn) AS nxt FROM n a JOIN n b ON a.k = b.k AND b.rn > a.rn AND b.s >= a.e GROUP BY a.k, a.rn),
r AS (SELECT k, rn FROM n WHERE rn = 1 UNION ALL SELECT r.k, x.nxt FROM r JOIN x ON x.k = r.k AND x.rn = r.rn)
SELECT n.k, n.s, n.e, n.t FROM r JOIN n ON n.k = r.k AND n.rn = r.rn""",
)
def span_select(spark, sf_dir):
    """Leftmost, then longest, non-overlapping."""
    start = (F.col("l_partkey") % 100).cast("int")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.struct(start.alias("start"), (start + F.col("l_quantity")).cast("int").alias("end"), F.col("l_returnflag").alias("type")).alias("span")
    )
    grouped = rows.groupBy("k").agg(F.collect_set("span").alias("spans"))
    chosen = grouped.select("k", F.explode(S.leftmost_longest(F.col("spans"))).alias("x"))
    return chosen.select("k", F.col("x.start").alias("s"), F.col("x.end").alias("e"), F.col("x.type").alias("t"))


@query("span_priority_merge")
def span_priority_merge(spark, sf_dir):
    """Two groups of spans per order merged, the second trimmed around the first."""
    start = (F.col("l_partkey") % 100).cast("int")
    span = F.struct(start.alias("start"), (start + F.col("l_quantity")).cast("int").alias("end"), F.col("l_returnflag").alias("type"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linestatus").alias("g"), span.alias("span"))
    grouped = rows.groupBy("k").agg(
        F.collect_set(F.when(F.col("g") == "O", F.col("span"))).alias("a"), F.collect_set(F.when(F.col("g") == "F", F.col("span"))).alias("b")
    )
    merged = S.priority_merge([F.col("a"), F.col("b")], F.lit("x" * 160))
    return grouped.select("k", F.explode(merged).alias("s")).select("k", "s.start", "s.end", "s.type")


@query("detected_spans")
def detected_spans(spark, sf_dir):
    """Rule detector over the windows of every document."""
    docs = table(spark, sf_dir, "documents")
    return detector.detect(docs, ["doc_id"], "text").select("doc_id", "start", "end", "type", "span")


@query(
    "span_filters",
    """SELECT doc_id, type, span, NOT (contains(span, '@') OR (type IN ('person', 'org') AND len(list_filter(regexp_extract_all(lower(span), '[a-z]+'), lambda w: w IN ('the', 'die'))) > 0)
  OR (type = 'person' AND lower(trim(span)) IN ('we', 'us', 'me')) OR (type = 'email' AND NOT contains(span, '@')) OR (type = 'phone' AND NOT regexp_matches(span, '[0-9]')) OR length(span) < 3) AS kept
FROM (SELECT DISTINCT doc_id, (['person', 'org', 'email', 'phone'])[length(w) % 4 + 1] AS type, w AS span FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9@.]+')) AS w FROM documents))""",
)
def span_filters(spark, sf_dir):
    """Which of the words of all documents would pass as detected spans."""
    w = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9@.]+"), F.lit(0)))
    rows = table(spark, sf_dir, "documents").select("doc_id", w.alias("span")).distinct()
    types = F.element_at(F.array(*[F.lit(t) for t in ("person", "org", "email", "phone")]), (F.length("span") % 4 + 1).cast("int"))
    typed = rows.withColumn("type", types)
    return typed.select("doc_id", "type", "span", detector.keep_span(F.col("span"), F.col("type"), ["the", "die"], min_length=3).alias("kept"))


# --- entities in tables --------------------------------------------------------------

_mail_json = "'{\"from\": {\"name\": \"' || fullname || '\", \"address\": \"' || email || '\"}, \"file\": {\"name\": \"' || lastname || '.pdf\"}}'"


def _mail_rows(spark, sf_dir):
    body = F.concat(
        F.lit('{"from": {"name": "'), F.col("fullname"), F.lit('", "address": "'), F.col("email"), F.lit('"}, "file": {"name": "'),
        F.col("lastname"), F.lit('.pdf"}}'),
    )
    return contacts(spark, sf_dir).withColumn("body", body)


@query(
    "known_entities",
    f"""SELECT 'person' AS ptype, original, count(*) AS n FROM (SELECT firstname AS original FROM {CONTACTS_SQL} UNION ALL SELECT fullname FROM {CONTACTS_SQL}) GROUP BY 2
UNION ALL SELECT 'email', email, 2 * count(*) FROM {CONTACTS_SQL} GROUP BY 2""",
)
def known_entities(spark, sf_dir):
    """People and addresses of columns and of JSON text, file names left out."""
    return FT.known_entities(_mail_rows(spark, sf_dir), ["firstname"], ["email"], ["body"])


@query(
    "json_scrub_check",
    f"SELECT count(*) AS rows, count(*) AS valid, count(*) AS same_keys, 0::BIGINT AS leaked FROM {CONTACTS_SQL}",
)
def json_scrub_check(spark, sf_dir):
    """JSON cells scrubbed: still valid, same keys, no name or address left."""
    rows = _mail_rows(spark, sf_dir).select("c_custkey", "fullname", "email", "body")
    scrubbed, _ = FT.scrub_columns(rows.select("c_custkey", "body"), ["body"])
    both = scrubbed.select("c_custkey", F.col("body").alias("new")).join(rows, "c_custkey")
    leaked = F.contains("new", F.concat(F.lit('"'), F.col("fullname"), F.lit('"'))) | F.contains("new", F.col("email"))
    return both.agg(
        F.count("*").alias("rows"), F.count_if(X.is_json(F.col("new"))).alias("valid"),
        F.count_if(X.json_keys(F.col("new")) == X.json_keys(F.col("body"))).alias("same_keys"), F.count_if(leaked).alias("leaked"),
    )


# --- places --------------------------------------------------------------------------


def _world(spark, sf_dir):
    region = table(spark, sf_dir, "region").select(X.normalize(F.col("r_name")).alias("nk"), F.lit("country").alias("ptype"))
    states = contacts(spark, sf_dir).select(F.lower("city").alias("nk"), F.lit("state_province").alias("ptype"))
    both = table(spark, sf_dir, "region").where("r_regionkey < 2").select(F.lower("r_name").alias("nk"), F.lit("state_province").alias("ptype"))
    return region.unionByName(states).unionByName(both).distinct()


_world_sql = f"""(SELECT DISTINCT lower(r_name) AS nk, 'country' AS ptype FROM region UNION SELECT DISTINCT lower(city), 'state_province' FROM {CONTACTS_SQL}
UNION SELECT lower(r_name), 'state_province' FROM region WHERE r_regionkey < 2)"""
_geo_map = f"(SELECT c_custkey AS id, 'location' AS label, city AS original FROM {CONTACTS_SQL} WHERE c_custkey % 2 = 0)"


def _places(spark, sf_dir):
    m = contacts(spark, sf_dir).where("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("id"), F.lit("location").alias("label"), F.col("city").alias("original"), F.lit("x").alias("fake"),
        F.lit(None).cast("string").alias("comment"), F.lit(None).cast("string").alias("is_pii"),
    )
    return geo.gazetteer(_world(spark, sf_dir), m)


_gazetteer = f"""SELECT nk, CASE WHEN nk IN (SELECT lower(original) FROM {_geo_map}) THEN 'city' WHEN bool_or(ptype = 'country') THEN 'country' ELSE 'state_province' END AS ptype,
  bool_or(ptype = 'country') AND bool_or(ptype = 'state_province') AS ambiguous FROM {_world_sql} GROUP BY nk"""


@query("gazetteer_build", _gazetteer)
def gazetteer_build(spark, sf_dir):
    """Map rows win over the world list, countries over subdivisions."""
    return _places(spark, sf_dir)


@query("ambiguous_places", f"SELECT nk FROM {_world_sql} WHERE ptype = 'country' INTERSECT SELECT nk FROM {_world_sql} WHERE ptype = 'state_province'")
def ambiguous_places(spark, sf_dir):
    return geo.ambiguous_keys(_world(spark, sf_dir))


def _addresses(spark, sf_dir):
    c = contacts(spark, sf_dir).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    zip_code = F.lpad((F.col("c_custkey") * 7919 % 100000).cast("string"), 5, "0")
    text = F.concat(F.lit("12 NE "), F.col("lastname"), F.lit(" Street, "), F.col("city"), F.lit(", "), F.initcap("r_name"), F.lit(" "), zip_code)
    return c.select("c_custkey", text.alias("text"))


_head = "(6 + length(lastname) + 9)"
_after = f"({_head} + length(city) + 2)"


@query(
    "address_spans",
    f"""WITH g AS ({_gazetteer}), a AS (SELECT c_custkey, lastname, city, r_name FROM {CONTACTS_SQL} JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, {_head}::INT AS start, ({_head} + length(city))::INT AS "end", g.ptype AS type FROM a JOIN g ON g.nk = lower(city)
UNION ALL SELECT c_custkey, {_after}::INT, ({_after} + length(r_name))::INT, 'country' FROM a
UNION ALL SELECT c_custkey, ({_after} + length(r_name) + 1)::INT, ({_after} + length(r_name) + 6)::INT, 'postal_code' FROM a""",
)
def address_spans(spark, sf_dir):
    """Postal codes and known places of addresses, with their offsets and types."""
    cells = _addresses(spark, sf_dir)
    found = geo.geo_spans(cells, "c_custkey", "text", _places(spark, sf_dir))
    return found.select("c_custkey", F.explode("spans").alias("s")).select("c_custkey", "s.start", "s.end", "s.type")


@query(
    "street_parts",
    f"""SELECT c_custkey, '12 NE ' AS head, lastname || CASE WHEN c_custkey % 2 = 0 THEN ' ' || city ELSE '' END AS name, ' Street, Suite 2' AS tail FROM {CONTACTS_SQL}""".replace(
        "' Street, Suite 2' AS tail", "' Suite 2' AS tail"
    ).replace("AS name", "|| ' Street,' AS name"),
)
def street_parts(spark, sf_dir):
    """House number and direction, name, and the last suffix with what follows."""
    name = F.concat(F.col("lastname"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" "), F.col("city"))).otherwise(""))
    span = F.concat(F.lit("12 NE "), name, F.lit(" Street, Suite 2"))
    parts = contacts(spark, sf_dir).select("c_custkey", geo.street_parts(span).alias("p"))
    return parts.select("c_custkey", "p.head", "p.name", "p.tail")


@query("address_scrub")
def address_scrub(spark, sf_dir):
    """Address cells with every place, code and street name replaced in one splice."""
    cells = _addresses(spark, sf_dir)
    scrubbed, _ = geo.scrub_composite(cells, "text", _places(spark, sf_dir), make_geo_detector=detector.StreetRuleDetector)
    return scrubbed


# --- incremental --------------------------------------------------------------------


@query("incremental_copy", None)
def incremental_copy(spark, sf_dir):
    """Customers anonymised as a stream of files, one batch at a time."""
    state = scratch_path(spark, "incremental")
    job = IncrementalAnonymizer(spark, CUSTOMER_PLAN, state, table="customer", keys=["c_custkey"])
    schema = table(spark, sf_dir, "customer").schema
    job.start(f"{sf_dir}/customer*.parquet", schema).awaitTermination()
    return spark.read.parquet(job.output()).drop("batch").withColumn("c_acctbal", F.round("c_acctbal", 6))




from checks.base import ORACLES  # noqa: E402

# The stream must end where the batch job ends.
ORACLES["incremental_copy"] = ORACLES["customer_copy"]
