"""Scrubbing free text, HTML and JSON cells.

Two phases, so that fakes stay consistent over the whole table: collect what
the cells mention, resolve the distinct values once, then rewrite each text
with its own small map of fakes. Texts that occur many times are rewritten once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators import dictionary as D
from veilframe.operators.detector import Detector, detect, keep_span
from veilframe.operators.generators import fake_birth, fake_id
from veilframe.operators.ledger import Ledger
from veilframe.operators.matching import rewritten
from veilframe.operators.people import HINT_TYPE
from veilframe.operators.resolve import Resolution, resolve
from veilframe.operators.rowhints import apply_fragments
from veilframe.session import materialize

# --- fixed values: what is recognised ----------------------------------------
# An address does not start inside a word. The letter of a JSON escape such as
# ``\\n`` directly before it is no part of a word.
EMAIL = (
    "(?:(?<=\\\\[nrt])|(?<!\\\\)(?<![\\p{L}\\p{N}]))"
    "[A-Za-z0-9](?:[A-Za-z0-9._%+\\-]*[A-Za-z0-9])?@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"
)
AT_ENTITY = "(?i)&(?:amp;)?#(?:64|x40);"
EMAIL_ENTITY = "(?i)(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._+\\-]*[A-Za-z0-9])?&(?:amp;)?#(?:64|x40);[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"
PROFILE = (
    "(?i)(?<=linkedin\\.com/)(?!(?:" + "|".join(C.NON_PROFILE_PATHS) + ")(?:/|$))"
    "(?:in/|pub/)?[A-Za-z0-9][A-Za-z0-9\\-]{0,100}"
)
JSON_NAME = '"name"\\s*:\\s*"([^"]{2,80})"'
JSON_ADDRESS = '(?i)"(?:address|emailAddress|userUpn|upn)"\\s*:\\s*"([^"\\s]+@[^"\\s]+)"'
JSON_BIRTH = '"birth"\\s*:\\s*"([^"]{4,20})"'
JSON_LOCATION = '"location"\\s*:\\s*"([^"]{0,80})"'
JSON_PHONE = '"phone"\\s*:\\s*"([^"]{0,40})"'
JSON_RESOURCE = '"ResourceName"\\s*:\\s*"([^"]+)-([A-Za-z0-9_.+%\\-]+@[A-Za-z0-9_.\\-]+\\.[A-Za-z]{2,})"'
HAN_TOKEN = "[\\u4e00-\\u9fff]+"
# --- end of fixed values ------------------------------------------------------


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


# An encoded address that follows a ``%XX`` escape starts behind it, not inside it.
_LOCAL = "[A-Za-z0-9](?:[A-Za-z0-9._+\\-]*[A-Za-z0-9])?"
_AFTER = "[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"
ENCODED_ANY = f"(?i)(?:(?<=%[0-9a-f]{{2}})|(?<!%)(?<!%[0-9a-f])(?<![A-Za-z0-9])){_LOCAL}%40{_AFTER}"


def decoded(email: Column) -> Column:
    """Address behind a ``%40`` or HTML-entity spelling."""
    return F.regexp_replace(F.regexp_replace(email, "(?i)%40", "@"), AT_ENTITY, "@")


def found_if(condition: Column, found: Column) -> Column:
    """Run a pattern only where a cheap test says it can match."""
    return F.when(condition, found).otherwise(F.array().cast("array<string>"))


def has_at(text: Column) -> Column:
    return F.contains(text, F.lit("@"))


def has_entity(text: Column) -> Column:
    return F.contains(text, F.lit("#64;")) | F.contains(F.lower(text), F.lit("#x40;"))


def emails_in(text: Column) -> Column:
    """Distinct addresses a text mentions, in any spelling."""
    return F.array_distinct(
        F.concat(
            found_if(has_at(text), find_all(text, EMAIL)),
            found_if(F.contains(text, F.lit("%40")), F.transform(find_all(text, ENCODED_ANY), decoded)),
            found_if(has_entity(text), F.transform(find_all(text, EMAIL_ENTITY), decoded)),
            found_if(has_at(text) & F.contains(text, F.lit('"')), F.transform(find_all(text, JSON_ADDRESS, 1), F.trim)),
        )
    )


def han_tokens(text: Column) -> Column:
    """Isolated Han runs of two to six characters that are no known vocabulary."""
    stop = X.literal_array([*C.HAN_HARVEST_STOP, *C.HAN_GENERIC_STOP, *C.HAN_COUNTRY_STOP])
    return F.filter(
        F.array_distinct(find_all(text, HAN_TOKEN)), lambda r: F.length(r).between(2, 6) & ~F.array_contains(stop, r)
    )


VALUE = f"struct<ptype:string,original:string,hints:{HINT_TYPE}>"


def mentioned(text: Column, han: bool = True) -> Column:
    """Everything the key-anchored and pattern passes will replace: ``array<VALUE>``."""
    none = F.array().cast(HINT_TYPE)

    def typed(values: Column, ptype: str) -> Column:
        return F.transform(
            values, lambda v: F.struct(F.lit(ptype).alias("ptype"), v.alias("original"), none.alias("hints"))
        )

    def filled(key: str, pattern: str, group: int = 1) -> Column:
        there = F.contains(text, F.lit(f'"{key}"'))
        return found_if(there, F.filter(find_all(text, pattern, group), lambda v: F.trim(v) != ""))

    names = F.filter(filled("name", JSON_NAME), lambda v: ~v.rlike(X.ATTACHMENT_SHAPE))
    compounds = F.arrays_zip(
        filled("ResourceName", JSON_RESOURCE, 1).alias("name"), filled("ResourceName", JSON_RESOURCE, 2).alias("email")
    )

    def resource(p: Column) -> Column:
        tokens = F.filter(F.split(F.trim(p["name"]), "\\s+"), lambda t: t != "")
        hints = F.transform(
            tokens,
            lambda t, i: F.struct(
                t.alias("token"),
                F.when((F.size(tokens) > 1) & (i == F.size(tokens) - 1), "last").otherwise("first").alias("role"),
                F.lit(False).alias("whole"),
            ),
        )
        return F.array(
            F.struct(F.lit("person").alias("ptype"), p["name"].alias("original"), none.alias("hints")),
            F.struct(F.lit("email").alias("ptype"), p["email"].alias("original"), hints.cast(HINT_TYPE).alias("hints")),
        )

    parts = [
        typed(emails_in(text), "email").cast(f"array<{VALUE}>"),
        typed(names, "person").cast(f"array<{VALUE}>"),
        typed(filled("location", JSON_LOCATION), "location").cast(f"array<{VALUE}>"),
        typed(filled("phone", JSON_PHONE), "phone").cast(f"array<{VALUE}>"),
        F.flatten(F.transform(F.filter(compounds, lambda p: F.trim(p["name"]) != ""), resource)).cast(f"array<{VALUE}>"),
    ]
    if han:
        parts.append(typed(found_if(X.is_han(text), han_tokens(text)), "org").cast(f"array<{VALUE}>"))
    return F.concat(*parts)


def harvest(texts: DataFrame, text: str, han: bool = True) -> DataFrame:
    """Distinct values mentioned in texts, in the shape :func:`resolve` takes.

    Hints of one address are united, values are counted before the shuffle.
    """
    rows = texts.select(F.explode(mentioned(F.col(text), han)).alias("v")).select("v.ptype", "v.original", "v.hints")
    return as_values(rows)


def as_values(rows: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    grouped = rows.groupBy("ptype", "original").agg(
        F.max_by("hints", F.size("hints")).alias("hints"), F.count("*").alias("n")
    )
    return grouped.select(
        "ptype", F.when(F.col("ptype") == "person", "full").otherwise("").alias("role"), "original",
        none.alias("country"), "hints", "n",
    )


def text_id(text: Column) -> Column:
    return F.sha2(text, 256)


def collect_mentions(df: DataFrame, texts: list[Column]) -> DataFrame:
    """``tid, ptype, original, hints, n`` of all texts, written down; equal mentions of a text are united before the shuffle."""
    cells = df.select(F.explode(F.array(*texts)).alias("text")).where(F.col("text").isNotNull())
    found = cells.select(text_id(F.col("text")).alias("tid"), F.explode(mentioned(F.col("text"))).alias("v")).select("tid", "v.*")
    grouped = found.groupBy("tid", "ptype", "original").agg(F.max_by("hints", F.size("hints")).alias("hints"), F.count("*").alias("n"))
    return materialize(grouped, "mentions")


def known_entities(df: DataFrame, people: list[str], emails: list[str], texts: list[str]) -> DataFrame:
    """``ptype, original`` of participants anywhere in a table.

    Person and address columns, and names and addresses inside JSON text. Latin
    names need three characters, Han names two; file names are left out.
    """
    def typed(values: Column, ptype: str) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(ptype).alias("ptype"), F.trim(v).alias("original")))

    cells = [typed(F.array(F.col(c).cast("string")), ptype) for names, ptype in ((people, "person"), (emails, "email")) for c in names]
    cells += [typed(find_all(F.col(c), pattern, 1), ptype) for c in texts for pattern, ptype in ((JSON_NAME, "person"), (JSON_ADDRESS, "email"))]
    none = F.array().cast("array<struct<ptype:string,original:string>>")
    rows = df.select(F.explode(F.concat(*[F.coalesce(c, none) for c in cells])).alias("v")).select("v.*")
    value = F.col("original")
    is_name = (
        (F.length(value) >= F.when(X.is_han(value), 2).otherwise(3))
        & (F.length(value) <= 80)
        & (value.rlike("[A-Za-z]") | X.is_han(value))
        & ~value.rlike(X.ATTACHMENT_SHAPE)
    )
    usable = value.isNotNull() & (
        ((F.col("ptype") == "person") & is_name) | ((F.col("ptype") == "email") & F.contains(value, F.lit("@")))
    )
    return rows.where(usable).groupBy("ptype", "original").agg(F.count("*").alias("n"))


def sweep_dictionary(known: DataFrame, config: Config = DEFAULT, brands: list[str] | None = None) -> DataFrame:
    """``entry, fake`` of known entities that may be swept through every text.

    A name that is an ordinary word, generic vocabulary or a brand would hit
    text that is about something else, so it is left out; addresses also enter
    in their ``%40`` spelling.
    """
    low = F.lower(F.trim("original"))
    stop = sorted({*config.generic_words, *(w.lower() for w in config.common_words), *(brands or ())})
    blocked = (F.col("ptype") != "email") & low.isin(*stop)
    rows = known.where(~blocked & (F.col("original") != F.col("fake")))
    encoded = rows.where("ptype = 'email'").select(
        F.replace("original", F.lit("@"), F.lit("%40")).alias("entry"), F.replace("fake", F.lit("@"), F.lit("%40")).alias("fake")
    )
    return rows.select(F.col("original").alias("entry"), "fake").unionByName(encoded).groupBy("entry").agg(F.min("fake").alias("fake"))


# --- rewriting ----------------------------------------------------------------


def _json_value(text: Column, pattern: str, fake_of: Callable[[Column], Column]) -> Column:
    """Replace the captured value of a key-anchored pattern, escaped for JSON."""
    head = '(?s)^("[^"]*"\\s*:\\s*")(.*)(")$'

    def one(match: Column) -> Column:
        value = F.regexp_extract(match, head, 2)
        fake = fake_of(value)
        return F.when((F.trim(value) == "") | fake.isNull(), match).otherwise(
            F.concat(F.regexp_extract(match, head, 1), X.json_escape(fake), F.lit('"'))
        )

    return X.splice(text, pattern, one)


def precise_pass(text: Column, fakes: Column, config: Config = DEFAULT) -> Column:
    """All pattern and key-anchored replacements; ``fakes`` maps ``ptype|original`` to the fake."""

    def fake_of(ptype: str, value: Column) -> Column:
        return F.try_element_at(fakes, F.concat(F.lit(f"{ptype}|"), value))

    def resource(match: Column) -> Column:
        shape = '(?s)^("ResourceName"\\s*:\\s*")([^"]+)-([A-Za-z0-9_.+%\\-]+@[^"]+)"$'
        name, email = F.regexp_extract(match, shape, 2), F.regexp_extract(match, shape, 3)
        return F.coalesce(
            F.concat(
                F.regexp_extract(match, shape, 1), X.json_escape(fake_of("person", name)), F.lit("-"),
                X.json_escape(fake_of("email", email)), F.lit('"'),
            ),
            match,
        )

    def same(ptype: str, match: Column) -> Column:
        return F.coalesce(fake_of(ptype, match), match)

    def entity(match: Column) -> Column:
        at = F.regexp_extract(match, AT_ENTITY, 0)
        return F.coalesce(F.replace(fake_of("email", decoded(match)), F.lit("@"), at), match)

    def encoded(match: Column) -> Column:
        return F.coalesce(F.replace(fake_of("email", decoded(match)), F.lit("@"), F.lit("%40")), match)

    def slug(match: Column) -> Column:
        shape = "(?i)^((?:in/|pub/)?)(.*)$"
        return F.concat(F.regexp_extract(match, shape, 1), fake_id(F.regexp_extract(match, shape, 2), config))

    def keyed(key: str, pattern: str, fake: Callable[[Column], Column]) -> Callable[[Column], Column]:
        there = F.lit(f'"{key}"')
        return lambda t: F.when(F.contains(t, there), _json_value(t, pattern, fake)).otherwise(t)

    steps: list[Callable[[Column], Column]] = [
        lambda t: F.when(F.contains(t, F.lit('"ResourceName"')), X.splice(t, JSON_RESOURCE, resource)).otherwise(t),
        lambda t: F.when(has_at(t), X.splice(t, EMAIL, lambda m: same("email", m))).otherwise(t),
        lambda t: F.when(F.contains(t, F.lit("%40")), X.splice(t, ENCODED_ANY, encoded)).otherwise(t),
        lambda t: F.when(has_entity(t), X.splice(t, EMAIL_ENTITY, entity)).otherwise(t),
        lambda t: F.when(F.contains(F.lower(t), F.lit("linkedin.com/")), X.splice(t, PROFILE, slug)).otherwise(t),
        keyed("birth", JSON_BIRTH, lambda v: fake_birth(v, config)),
        keyed("location", JSON_LOCATION, lambda v: fake_of("location", v)),
        keyed("phone", JSON_PHONE, lambda v: fake_of("phone", v)),
        keyed("name", JSON_NAME, lambda v: fake_of("person", v)),
    ]

    def chain(current: Column, rest: list) -> Column:
        if not rest:
            return current
        return X.let(rest[0](current), lambda t: chain(t, rest[1:]))

    return chain(text, steps)


def needs_precise_pass(text: Column) -> Column:
    """Cheap test that spares most cells the passes."""
    return (
        has_at(text)
        | F.contains(text, F.lit("%40"))
        | has_entity(text)
        | F.contains(F.lower(text), F.lit("linkedin.com/"))
        | (F.contains(text, F.lit('"')) & text.rlike('"(?:name|birth|location|phone|ResourceName)"'))
    )


def json_safe(original: Column, scrubbed: Column, fallback: Column) -> Column:
    """Valid JSON must stay valid with the same keys; otherwise the safe text is used."""
    broken = X.is_json(original) & (~X.is_json(scrubbed) | (X.json_keys(original) != X.json_keys(scrubbed)))
    return F.when(F.contains(original, F.lit('"')) & broken, fallback).otherwise(scrubbed)


def han_backstop(text: Column, fakes: Column) -> Column:
    """Replace isolated Han runs that have an organisation fake."""

    def one(match: Column) -> Column:
        fake = F.try_element_at(fakes, F.concat(F.lit("org|"), match))
        return F.when(F.length(match).between(2, 6), F.coalesce(fake, match)).otherwise(match)

    return F.when(X.is_han(text), X.splice(text, HAN_TOKEN, one)).otherwise(text)


def fake_maps(mentions: DataFrame, resolved: DataFrame, key: str, weight: str | None = "n") -> DataFrame:
    """``key -> fakes`` map per text from its ``key, ptype, original`` mentions."""
    from veilframe.operators.joins import lookup

    table = resolved.groupBy("original", "ptype").agg(F.min("fake").alias("_fake"), F.sum("n").alias("n"))
    joined = lookup(mentions.select(key, "original", "ptype").distinct(), table, ["original", "ptype"], weight=weight)
    return joined.where(F.col("_fake").isNotNull()).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "ptype", "original"), "_fake"))).alias("fakes")
    )


def curated(text: Column, config: Config, protect: Column | None = None) -> Column:
    """Company dictionary and exact code dictionary, both small and bounded."""
    out = text
    for pairs, match in ((config.company_map, D.LITERAL), (config.exact_code_map, D.EXACT_CODES)):
        if not pairs:
            continue
        folded = {k.strip().lower(): v for k, v in pairs.items() if k.strip()}
        usable = {k: v for k, v in folded.items() if len(k) >= match.min_length}
        if usable:
            out = D.replace_entries(out, X.literal_map(usable), match, protect)
    return out


def scrub_texts(
    texts: DataFrame,
    key: str = "rid",
    text: str = "text",
    fragments: str | None = None,
    entity_map: DataFrame | None = None,
    tokens: DataFrame | None = None,
    known: DataFrame | None = None,
    config: Config = DEFAULT,
    domain: str = "general",
    make_detector: Callable[[], Detector] | None = None,
    raw_first: bool = False,
    ledger: Ledger | None = None,
    answered: tuple[DataFrame, Resolution] | None = None,
) -> tuple[DataFrame, list[Resolution]]:
    """``key, scrubbed`` for distinct texts, and the calls of ``resolve`` that were made, in order.

    ``answered`` holds the texts' mentions (``collect_mentions``) and the call that
    resolved them, with written values, when the caller has done that already.

    Order: patterns, known entities, row fragments, curated words, detection on
    stripped text (and on the raw text before it with ``raw_first``), Han runs,
    forced words, curated words again, JSON check.
    """
    calls: list[Resolution] = []
    brands = list(config.known_brands) if domain == "resume" else []
    base = texts.select(key, F.col(text).alias("_text"), *([F.col(fragments).alias("_fragments")] if fragments else []))
    if answered is None:
        mentions = base.select(key, F.explode(mentioned(F.col("_text"))).alias("v")).select(key, "v.ptype", "v.original", "v.hints")
        mentions = materialize(mentions, "mentions")
        answer = resolve(as_values(mentions), config=config, ledger=Ledger(entity_map, tokens) if ledger is None else ledger)
        answer.values = materialize(answer.values, "resolved")
        calls.append(answer)
    else:
        told, answer = answered
        ids = base.select(key, text_id(F.col("_text")).alias("tid"))
        mentions = ids.join(told.select("tid", "ptype", "original"), "tid")
    maps = fake_maps(mentions, answer.values, key, answer.weight)
    joined = base.join(maps, key, "left").withColumn("fakes", F.coalesce("fakes", F.create_map().cast("map<string,string>")))
    precise = F.when(needs_precise_pass(F.col("_text")), precise_pass(F.col("_text"), F.col("fakes"), config)).otherwise(F.col("_text"))
    current = joined.withColumn("pre", precise)
    protect = F.transform(F.map_values("fakes"), F.lower)
    current = current.withColumn(
        "protect",
        F.array_distinct(F.concat(protect, F.transform(F.filter(protect, lambda f: F.contains(f, F.lit("@"))), lambda f: F.split(f, "@")[0]))),
    )
    if known is not None:
        entries = materialize(D.prepare(sweep_dictionary(known, config, brands), D.KNOWN), "known")
        current = materialize(current, "precise")
        swept = rewritten(current, key, "pre", entries, D.KNOWN, "protect").select(key, F.col("text").alias("_swept"), "used")
        current = current.join(swept, key).withColumn("pre", F.col("_swept"))
        put = F.transform("used", F.lower)
        current = current.withColumn("protect", F.array_distinct(F.concat("protect", put))).drop("_swept", "used")
    if fragments:
        current = current.withColumn("pre", apply_fragments(F.col("pre"), F.col("_fragments")))
        own = F.transform(F.map_values(F.coalesce("_fragments", F.create_map().cast("map<string,string>"))), F.lower)
        current = current.withColumn("protect", F.array_distinct(F.concat("protect", own)))
    current = current.withColumn("pre", curated(F.col("pre"), config, F.col("protect")))
    set_fakes = [v.lower() for v in (*config.company_map.values(), *config.exact_code_map.values())]
    if set_fakes:
        current = current.withColumn("protect", F.array_distinct(F.concat("protect", X.literal_array(sorted(set(set_fakes))))))
    current = current.withColumn("out", F.col("pre"))
    if make_detector is not None:
        for stripped in ([False, True] if raw_first else [True]):
            current, used = _detected_pass(
                current, key, stripped, make_detector, answer, config, brands, domain if raw_first else None
            )
            calls += used
            answer = used[-1] if used else answer
    done = han_backstop(F.col("out"), F.col("fakes"))
    done = X.apply_forced(done, config.forced_words, config.forced_word_boundary)
    done = curated(done, config, F.col("protect"))
    safe_pre = X.apply_forced(F.col("pre"), config.forced_words, config.forced_word_boundary)
    result = current.withColumn("scrubbed", done).select(
        key, json_safe(F.col("_text"), F.col("scrubbed"), safe_pre).alias("scrubbed")
    )
    return result, calls


def _detected_pass(
    current: DataFrame, key: str, stripped: bool, make_detector, before: Resolution, config: Config, brands: list[str],
    raw_domain: str | None,
) -> tuple[DataFrame, list[Resolution]]:
    """Detect on (stripped) text, resolve the spans after all that was answered before, write them back as literals."""
    if stripped and raw_domain == "resume":
        return current, []
    current = materialize(current, "scanned")
    surface = X.strip_html(F.col("out")) if stripped else F.col("out")
    scanned = current.select(key, surface.alias("surface"))
    spans = detect(scanned, [key], "surface", make_detector)
    good = spans.where(
        keep_span(F.col("span"), F.col("type"), config.generic_words, brands, min_length=3)
    ).join(current.select(key, "protect"), key).where(~F.array_contains("protect", F.lower("span")))
    good = materialize(good.select(key, F.col("type").alias("ptype"), F.col("span").alias("original")), "spans")
    none = F.array().cast(HINT_TYPE)
    answer = resolve(as_values(good.withColumn("hints", none)), config=config, ledger=before.ledger.settled())
    answer.values = materialize(answer.values, "spanned")
    from veilframe.operators.joins import lookup

    table = answer.values.groupBy("original", "ptype").agg(F.min("fake").alias("_fake"), F.sum("n").alias("n"))
    pairs = lookup(good, table, ["original", "ptype"], weight="n").where(F.col("_fake") != F.col("original"))
    literal = (
        pairs.groupBy(key, F.lower("original").alias("entry_key")).agg(F.min("_fake").alias("fake"))
        .groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("entry_key", "fake"))).alias("entries"))
    )
    joined = current.join(literal, key, "left")
    out = D.replace_entries(F.col("out"), F.col("entries"), D.LITERAL, F.col("protect"))
    return joined.withColumn("out", out).drop("entries"), [answer]


def scrub_columns(
    df: DataFrame, columns: list[str], fragments: str | None = None, **options
) -> tuple[DataFrame, list[Resolution]]:
    """Scrub text columns of a table in place; every distinct text is worked on once.

    ``fragments`` names a map column with the row's own name words; a text is
    then distinct together with them.
    """
    from veilframe.operators.joins import lookup

    def rid(c: str) -> Column:
        parts = [F.col(c)] + ([F.to_json(fragments)] if fragments else [])
        return F.when(F.col(c).isNotNull(), F.sha2(F.concat_ws("\u0001", *parts), 256))

    keyed = df.withColumns({f"_rid{i}": rid(c) for i, c in enumerate(columns)})
    own = [F.col(fragments).alias("fragments")] if fragments else []
    cells = keyed.select(
        *own, F.explode(F.array(*[F.struct(F.col(f"_rid{i}").alias("rid"), F.col(c).alias("text")) for i, c in enumerate(columns)])).alias("c")
    ).where(F.col("c.rid").isNotNull())
    extra = [F.any_value("fragments").alias("fragments")] if fragments else []
    texts = cells.groupBy(F.col("c.rid").alias("rid")).agg(
        F.any_value("c.text").alias("text"), F.count("*").alias("copies"), *extra
    )
    texts = materialize(texts, "texts")
    scrubbed, used = scrub_texts(texts.drop("copies"), "rid", "text", "fragments" if fragments else None, **options)
    table = materialize(scrubbed.join(texts.select("rid", "copies"), "rid"), "scrubbed")
    out = keyed
    for i, c in enumerate(columns):
        answers = table.select(F.col("rid").alias(f"_rid{i}"), F.col("scrubbed").alias(f"_new{i}"), "copies")
        out = lookup(out, answers, [f"_rid{i}"], weight="copies")
    place = {c: i for i, c in enumerate(columns)}
    return out.select(*[F.col(f"_new{place[c]}").alias(c) if c in place else F.col(c) for c in df.columns]), used
