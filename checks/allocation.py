"""Generators that hand out unique fakes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fragments as Q
from checks.base import CONTACTS_SQL, contacts, query, table
from veilframe import config as C
from veilframe.functions import text as X
from veilframe.operators import chinese, orgs, people, places
from veilframe.operators import resolve as R
from veilframe.operators.allocate import pool_pick, slots
from veilframe.operators.people import HINT_TYPE

_words = "(SELECT DISTINCT 'w' AS g, lower(p_name || ' ' || p_partkey) AS nk FROM part)"


@query("slot_numbers", f"SELECT nk, slot FROM ({Q.slots(_words, 'g', 'nk')})")
def slot_numbers(spark, sf_dir):
    """Unique numbers without a global order."""
    nk = F.lower(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")))
    words = table(spark, sf_dir, "part").select(F.lit("w").alias("g"), nk.alias("nk")).distinct()
    return slots(words, ["g"], "nk").select("nk", "slot")


_cities = f"(SELECT DISTINCT lower(city) AS nk, 'latin' AS pool FROM {CONTACTS_SQL})"


@query("pool_words", Q.pool_pick(_cities, {"latin": C.CITIES}, "t"))
def pool_words(spark, sf_dir):
    """Each pool word goes to one value at most."""
    values = contacts(spark, sf_dir).select(F.lower("city").alias("nk"), F.lit("latin").alias("pool")).distinct()
    return pool_pick(values, {"latin": C.CITIES}, "t").where(F.col("word").isNotNull())


def _compound(source: str, pool: str, words, tag: str) -> str:
    """Pool words, else compounds, for distinct ``nk`` of ``source``."""
    return f"""base AS (SELECT nk, '{pool}' AS pool FROM {source}),
won AS ({Q.pool_pick('base', {pool: words}, tag)}),
lost AS (SELECT nk, '{pool}' AS family FROM base WHERE nk NOT IN (SELECT nk FROM won)),
filled AS (SELECT nk, word FROM won UNION ALL SELECT nk, {Q.words_of(f'(slot + {len(words)})', words, '-')} FROM ({Q.slots('lost', 'family', 'nk')}))"""


_city_src = f"(SELECT lower(city) AS nk, min(city) AS canon FROM {CONTACTS_SQL} GROUP BY 1)"


@query(
    "city_alloc",
    f"WITH s AS (SELECT * FROM {_city_src}), {_compound('s', 'latin', C.CITIES, 'veil:city')} SELECT nk, {Q.case_like('canon', 'word')} AS fake FROM filled JOIN s USING (nk)",
)
def city_alloc(spark, sf_dir):
    values = contacts(spark, sf_dir).groupBy(X.normalize(F.col("city")).alias("nk")).agg(F.min("city").alias("canon"))
    return places.city_fakes(values).drop("placed")


_street_src = f"(SELECT lower(lastname) AS nk, min(lastname) AS canon FROM {CONTACTS_SQL} GROUP BY 1)"


@query(
    "street_alloc",
    f"WITH s AS (SELECT * FROM {_street_src}), {_compound('s', 'street', C.STREET_NAMES, 'veil:street')} SELECT nk, {Q.case_like('trim(canon)', 'word')} AS fake FROM filled JOIN s USING (nk)",
)
def street_alloc(spark, sf_dir):
    values = contacts(spark, sf_dir).groupBy(X.normalize(F.col("lastname")).alias("nk")).agg(F.min("lastname").alias("canon"))
    return places.street_fakes(values).drop("placed")


_states, _ = places.subdivision_pools()
_alpha = " ".join(f"WHEN {Q.text(c[0])} THEN {Q.text(c[1])}" for c in C.COUNTRIES)
_state_word = " ".join(f"WHEN {Q.text(p)} THEN {Q.words_of(f'(slot + {len(w)})', w, '-', 7)}" for p, w in sorted(_states.items()))


@query(
    "state_alloc",
    f"""WITH r AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN upper(substr(city, 1, 2)) ELSE city END AS canon, ({Q.array([c[0] for c in C.COUNTRIES])})[c_custkey % 20 + 1] AS country FROM {CONTACTS_SQL}),
v AS (SELECT *, CASE WHEN length(regexp_replace(canon, '[^A-Za-z]', '', 'g')) = 2 THEN 'code:' ELSE 'name:' END AS form FROM (SELECT lower(canon) AS nk, min(canon) AS canon, country FROM r GROUP BY lower(canon), country)),
p AS (SELECT *, CASE WHEN form || CASE country {_alpha} END IN ({', '.join(Q.text(p) for p in _states)}) THEN form || CASE country {_alpha} END ELSE form END AS pool FROM v),
base AS (SELECT DISTINCT nk, pool FROM p), won AS ({Q.pool_pick('base', _states, 'veil:state')}),
lost AS (SELECT nk, pool AS family FROM base WHERE (nk, pool) NOT IN (SELECT (nk, pool) FROM won)),
filled AS (SELECT nk, pool, word FROM won UNION ALL SELECT nk, family, CASE family {_state_word} END FROM ({Q.slots('lost', 'family', 'nk')}))
SELECT nk, country, {Q.case_like('trim(canon)', 'word')} AS fake FROM p JOIN filled USING (nk, pool)""",
)
def state_alloc(spark, sf_dir):
    """Codes for codes, names for names, of the faked country where it is known."""
    k = F.col("c_custkey")
    rows = contacts(spark, sf_dir).select(
        F.when(k % 2 == 0, F.upper(F.substring("city", 1, 2))).otherwise(F.col("city")).alias("canon"),
        F.element_at(F.array(*[F.lit(c[0]) for c in C.COUNTRIES]), (k % 20 + 1).cast("int")).alias("country"),
    )
    values = rows.groupBy(X.normalize(F.col("canon")).alias("nk"), "country").agg(F.min("canon").alias("canon"))
    return places.state_fakes(values).drop("placed")


# --- organisations ------------------------------------------------------------


def _caps(run: str, key: str) -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    s = Q.stream(key, f"length({run})")
    at = f"(instr('{letters}', c) + {Q.byte(s, 'j - 1')} % 25) % 26 + 1"
    return f"array_to_string(list_transform(string_split({run}, ''), lambda c, j: substr('{letters}', ({at})::INT, 1)), '')"


_kept = ", ".join(Q.text(w) for w in (*C.LEGAL_SUFFIXES, *C.FILLER_WORDS))
_odraw = Q.seed(Q.text("veil"), "'org'", "nk", "(i - 1)::VARCHAR")
_ohead = f"CASE WHEN lower({Q.pick(_odraw, C.ORG_HEADS)}) = lower(r) THEN {Q.pick(_odraw + ' + 1', C.ORG_HEADS)} ELSE {Q.pick(_odraw, C.ORG_HEADS)} END"
_oword = f"CASE WHEN single THEN ({_ohead}) || ' ' || {Q.pick(_odraw + ' // 7', C.ORG_TAILS)} ELSE ({_ohead}) END"
_capskey = "'veil|org|' || nk || '|' || (i - 1)"
_orun = f"CASE WHEN lower(r) IN ({_kept}) THEN r WHEN regexp_matches(r, '^[A-Z]{{1,4}}$') THEN {_caps('r', _capskey)} ELSE word END"
ORG_DRAFT = f"""runs AS (SELECT nk, canon, regexp_extract_all(canon, '\\p{{L}}+') AS rs, regexp_split_to_array(canon, '\\p{{L}}+') AS gaps FROM orgs),
piece AS (SELECT nk, canon, gaps, unnest(rs) AS r, unnest(range(1, len(rs) + 1)) AS i, len(rs) <= 1 AS single FROM runs),
worded AS (SELECT *, {_oword} AS w FROM piece),
shaped AS (SELECT *, {Q.case_like('r', 'w')} AS word FROM worded),
draft AS (SELECT nk AS key, min(canon) AS canon, min(gaps)[1] || string_agg(({_orun}) || gaps[i + 1], '' ORDER BY i) AS fake FROM shaped GROUP BY nk)"""


@query(
    "org_alloc",
    f"""WITH orgs AS (SELECT lower(company) AS nk, min(company) AS canon FROM (SELECT company FROM {CONTACTS_SQL} UNION ALL SELECT p_name || ' ' || p_type FROM part) GROUP BY 1),
{ORG_DRAFT} SELECT key AS nk, fake FROM ({Q.disambiguate('draft', Q.WORD_TAIL)})""",
)
def org_alloc(spark, sf_dir):
    """Structure kept, brand words in, no two companies alike."""
    names = contacts(spark, sf_dir).select("company").unionByName(
        table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("company"))
    )
    values = names.groupBy(X.normalize(F.col("company")).alias("nk")).agg(F.min("company").alias("canon"))
    return orgs.org_fakes(values).drop("placed")


@query("org_code_alloc")
def org_code_alloc(spark, sf_dir):
    """Coded values: a word keeps its fake wherever it stands, known codes too."""
    from checks.base import entity_map
    from veilframe.sources import entity_map as em

    code = F.concat_ws("_", F.substring(F.upper("company"), 1, 1), F.upper("firstname"), "city", F.upper("firstname"))
    values = contacts(spark, sf_dir).select(code.alias("canon")).distinct().withColumn("nk", X.normalize(F.col("canon")))
    return orgs.org_code_fakes(values, em.known_codes(entity_map(spark, sf_dir))).drop("placed")


# --- people ---------------------------------------------------------------------

_pools = people.token_pools()
_chi = "\\b(" + "|".join(C.CHI_HINTS) + ")\\b"
_ind = "\\b(" + "|".join(C.IND_HINTS) + ")\\b"
_male, _female = (", ".join(Q.text(w) for w in g) for g in (C.MALE_GIVEN, C.FEMALE_GIVEN))


def token_ctes(source: str) -> str:
    """``tok`` with ``role, nk, fake`` for distinct ``role, nk`` of ``source``, plus its inputs."""
    gender = f"CASE WHEN nk IN ({_male}) THEN 'male' WHEN nk IN ({_female}) THEN 'female' ELSE 'unknown' END"
    pool = (
        f"CASE WHEN regexp_matches(nk, '{_ind}') THEN CASE role WHEN 'first' THEN 'first:ind:' || {gender} ELSE 'last:ind' END "
        f"WHEN regexp_matches(nk, '{_chi}') THEN role || ':chi' END"
    )
    spelled = (
        f"CASE role WHEN 'first' THEN {Q.spelled_name('slot', C.GIVEN_ENDINGS)} ELSE {Q.spelled_name('slot', C.SURNAME_ENDINGS)} END"
    )
    return f"""tin AS (SELECT DISTINCT role, nk, {pool} AS pool FROM {source}),
ethnic AS (SELECT role, nk, pool FROM tin WHERE pool IS NOT NULL),
epick AS ({Q.pool_pick('ethnic', _pools, 'veil:token')}),
plain AS (SELECT role, nk FROM tin WHERE pool IS NULL UNION ALL SELECT role, nk FROM ethnic WHERE (nk, pool) NOT IN (SELECT (nk, pool) FROM epick)),
tok AS (SELECT split_part(pool, ':', 1) AS role, nk, word AS fake FROM epick UNION ALL SELECT role, nk, {spelled} FROM ({Q.slots('plain', 'role', 'nk')}))"""


_tokens = """(SELECT DISTINCT CASE WHEN conv_id % 2 = 0 THEN 'first' ELSE 'last' END AS role, w AS nk FROM (
  SELECT conv_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM conversations))"""


@query("name_tokens", f"WITH {token_ctes(_tokens)} SELECT role, nk, fake FROM tok")
def name_tokens(spark, sf_dir):
    """Ethnic pools first, spelled names for the rest, one fake per role and token."""
    role = F.when(F.col("conv_id") % 2 == 0, "first").otherwise("last")
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    tokens = table(spark, sf_dir, "conversations").select(role.alias("role"), words.alias("nk"))
    return people.allocate_tokens(tokens.groupBy("role", "nk").agg(F.count("*").alias("n"))).select("role", "nk", "fake")


_names_src = f"""names AS (SELECT nk, role, min(canon) AS canon FROM (
  SELECT lower(fullname) AS nk, 'full' AS role, fullname AS canon FROM {CONTACTS_SQL} UNION ALL SELECT lower(firstname), 'first', firstname FROM {CONTACTS_SQL}
  UNION ALL SELECT lower(lastname) || '-' || lower(firstname), 'last', lastname || '-' || firstname FROM {CONTACTS_SQL}) GROUP BY 1, 2),
nt AS (SELECT nk AS pnk, role AS prole, unnest(regexp_extract_all(canon, '[^\\s\\-]+')) AS token, unnest(range(1, len(regexp_extract_all(canon, '[^\\s\\-]+')) + 1)) AS i,
  len(regexp_extract_all(canon, '[^\\s\\-]+')) AS c, regexp_split_to_array(canon, '[^\\s\\-]+') AS gaps FROM names),
nr AS (SELECT *, CASE WHEN prole <> 'full' THEN prole WHEN c > 1 AND i = c THEN 'last' ELSE 'first' END AS role, lower(token) AS nk FROM nt)"""


@query(
    "person_alloc",
    f"""WITH {_names_src}, {token_ctes('nr')}
SELECT pnk AS nk, prole AS role, min(gaps)[1] || string_agg({Q.case_like('token', 'fake')} || gaps[i + 1], '' ORDER BY i) AS fake
FROM nr JOIN tok USING (role, nk) GROUP BY pnk, prole""",
)
def person_alloc(spark, sf_dir):
    """Names rebuilt token by token; a token has the same fake in every name."""
    c = contacts(spark, sf_dir)
    parts = [
        c.select(F.lit("full").alias("role"), F.col("fullname").alias("canon")),
        c.select(F.lit("first").alias("role"), F.col("firstname").alias("canon")),
        c.select(F.lit("last").alias("role"), F.concat_ws("-", "lastname", "firstname").alias("canon")),
    ]
    names = parts[0].unionByName(parts[1]).unionByName(parts[2])
    keyed = names.groupBy(X.normalize(F.col("canon")).alias("nk"), "role").agg(F.min("canon").alias("canon"))
    read = people.read_person(keyed)
    rows = people.explode_tokens(read, "body", "role", ["nk", "role"])
    tokens = people.allocate_tokens(people.distinct_tokens(rows))
    return people.assemble(read, rows, tokens, "body", ["nk", "role"]).select("nk", "role", "fake")


# --- e-mail without hints: addresses found in documents ---------------------------

DOC_MAILS = f"SELECT unnest(regexp_extract_all(text, '{Q.EMAIL_PATTERN}')) AS e FROM documents"


def _mail_parts(source: str) -> str:
    return f"""mails AS (SELECT DISTINCT lower(e) AS nk, e FROM ({source})),
mp AS (SELECT nk, min(e) AS e, list_filter(regexp_split_to_array(string_split(min(e), '@')[1], '[._\\-]+'), lambda p: p <> '') AS parts FROM mails GROUP BY nk),
mt AS (SELECT 'first' AS role, lower(parts[1]) AS nk FROM mp WHERE len(parts) >= 1 UNION SELECT 'last', lower(parts[-1]) FROM mp WHERE len(parts) >= 2)"""


_clean = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"
_sep = "CASE WHEN contains(string_split(e, '@')[1], '.') THEN '.' WHEN contains(string_split(e, '@')[1], '_') THEN '_' ELSE '' END"


def mail_fakes(source: str) -> str:
    """CTEs up to ``mf``: ``nk -> fake`` of the addresses ``source`` yields."""
    return f"""{_mail_parts(source)}, {token_ctes('mt')},
md AS (SELECT mp.nk AS key, CASE WHEN len(parts) >= 2 THEN
    (CASE WHEN length(parts[1]) = 1 THEN substr({_clean.format('f.fake')}, 1, 1) ELSE {_clean.format('f.fake')} END) || {_sep} || {_clean.format('l.fake')}
    ELSE {_clean.format('f.fake')} END || '@' || {Q.domain("regexp_extract(e, '@([^@\\s]+)$', 1)")} AS fake
  FROM mp LEFT JOIN tok f ON f.role = 'first' AND f.nk = lower(parts[1]) LEFT JOIN tok l ON l.role = 'last' AND l.nk = lower(parts[-1])),
mf AS (SELECT key AS nk, fake FROM ({Q.disambiguate('md', Q.EMAIL_TAIL)}))"""


def mail_values(spark, sf_dir):
    from veilframe.operators.freetext import EMAIL, find_all

    docs = table(spark, sf_dir, "documents").select(F.explode(find_all(F.col("text"), EMAIL)).alias("original"))
    own = contacts(spark, sf_dir).select(F.col("email").alias("original"))
    return docs.unionByName(own)


_all_mails = f"{DOC_MAILS} UNION ALL SELECT c.email FROM {CONTACTS_SQL} c"


@query("email_alloc", f"WITH {mail_fakes(_all_mails)} SELECT DISTINCT mails.e AS original, mf.fake AS fake FROM mails JOIN mf USING (nk)")
def email_alloc(spark, sf_dir):
    """Addresses built from name tokens and masked domains, unique over all of them."""
    from veilframe.operators.freetext import as_values

    rows = mail_values(spark, sf_dir).select(F.lit("email").alias("ptype"), "original").withColumn("hints", F.array().cast(HINT_TYPE))
    return R.resolve(as_values(rows)).values.select("original", "fake")


_surnames, _surnames_latin = Q.array([x[0] for x in C.HAN_SURNAMES]), Q.array([x[1] for x in C.HAN_SURNAMES])
_given, _given_latin = Q.array([x[0] for x in C.HAN_GIVEN]), Q.array([x[1] for x in C.HAN_GIVEN])
_ns, _ng = len(C.HAN_SURNAMES), len(C.HAN_GIVEN)
_space = _ns * _ng * _ng


@query(
    "han_names",
    f"""WITH b AS (SELECT 'han' AS g, c_name AS identity FROM customer), s AS ({Q.slots('b', 'g', 'identity')}),
i AS (SELECT identity, ((slot % {_space}) * 7919 + 101) % {_space} AS x, slot // {_space} - 1 AS beyond FROM s),
p AS (SELECT *, x // {_ns} % {_ng} + 1 AS one, x // {_ns} // {_ng} + 1 AS two FROM i)
SELECT identity, ({_surnames})[x % {_ns} + 1] || ({_given})[one] || ({_given})[two] || CASE WHEN beyond >= 0 THEN ({_given})[beyond % {_ng} + 1] ELSE '' END AS han,
  upper(substr(({_given_latin})[one], 1, 1)) || substr(({_given_latin})[one], 2) || ({_given_latin})[two] || CASE WHEN beyond >= 0 THEN ({_given_latin})[beyond % {_ng} + 1] ELSE '' END AS given_latin,
  ({_surnames_latin})[x % {_ns} + 1] AS surname_latin FROM p""",
)
def han_names(spark, sf_dir):
    """A different invented Chinese person per identity, in both scripts."""
    identities = table(spark, sf_dir, "customer").select(F.col("c_name").alias("identity"))
    return chinese.han_identities(identities).drop("placed")


_oh, _ot = Q.array(C.HAN_ORG_HEADS), Q.array(C.HAN_ORG_TAILS)
_nh, _nt = len(C.HAN_ORG_HEADS), len(C.HAN_ORG_TAILS)


@query(
    "han_orgs",
    f"""WITH b AS (SELECT lower(c_name) AS nk, 'han' AS pool FROM customer), won AS ({Q.pool_pick('b', {'han': tuple(chinese.han_org_words())}, 'han-org')}),
lost AS (SELECT nk, pool FROM b WHERE nk NOT IN (SELECT nk FROM won)), s AS (SELECT *, slot // {_nh} // {_nt * _nt} - 1 AS beyond FROM ({Q.slots('lost', 'pool', 'nk')}))
SELECT nk, word AS fake FROM won UNION ALL
SELECT nk, ({_oh})[slot % {_nh} + 1] || ({_ot})[slot // {_nh} % {_nt} + 1] || ({_ot})[slot // {_nh} // {_nt} % {_nt} + 1]
  || CASE WHEN beyond >= 0 THEN ({_ot})[beyond % {_nt} + 1] ELSE '' END FROM s""",
)
def han_orgs(spark, sf_dir):
    return chinese.han_orgs(table(spark, sf_dir, "customer").select(F.lower("c_name").alias("nk"))).drop("placed")


@query(
    "uniqueness_of_fakes",
    """SELECT 'names' AS kind, count(*) AS fakes, count(*) AS distinct_fakes FROM customer
UNION ALL SELECT 'orgs', count(*), count(*) FROM customer""",
)
def uniqueness_of_fakes(spark, sf_dir):
    """As many fakes as originals."""
    names, companies = han_names(spark, sf_dir), han_orgs(spark, sf_dir)

    def counted(df, column, kind):
        return df.agg(F.count("*").alias("fakes"), F.count_distinct(column).alias("distinct_fakes")).select(
            F.lit(kind).alias("kind"), "fakes", "distinct_fakes"
        )

    return counted(names, "han", "names").unionByName(counted(companies, "fake", "orgs"))
