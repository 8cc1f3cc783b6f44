"""Person names, name tokens and e-mail addresses.

A person's first name, surname, full name and address all draw on one token
table, so they agree wherever they occur. Token fakes come from slots, so two
tokens of one role never share a fake.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators import chinese
from veilframe.operators.allocate import (
    counted_marks,
    disambiguate,
    email_tail,
    nowhere,
    pool_pick,
    slots,
    spelled_name,
)
from veilframe.operators.generators import fake_domain
from veilframe.operators.joins import lookup

TOKEN = "[^\\s\\-]+"
LOCAL_SEPARATOR = "[._\\-]"
ANNOTATED = "^(.+?)\\s*(?:\\(([^()]+)\\)|\\[([^\\[\\]]+)\\])\\s*$"


def ethnicity(nk: Column) -> Column:
    """``ind``, ``chi`` or ``other`` by surname hints."""
    return (
        F.when(nk.rlike("\\b(" + "|".join(C.IND_HINTS) + ")\\b"), "ind")
        .when(nk.rlike("\\b(" + "|".join(C.CHI_HINTS) + ")\\b"), "chi")
        .otherwise("other")
    )


def name_gender(nk: Column) -> Column:
    """``male``, ``female`` or ``unknown`` from the given-name lookup."""
    return F.when(nk.isin(*C.MALE_GIVEN), "male").when(nk.isin(*C.FEMALE_GIVEN), "female").otherwise("unknown")


def token_pools() -> dict[str, tuple[str, ...]]:
    """Ethnic pools by ``role:ethnicity:gender``."""
    chinese_given = tuple(
        first.capitalize() + second for first in [g[1] for g in C.HAN_GIVEN] for second in ("hao", "ning", "lan", "wen", "yu")
    )
    return {
        "first:ind:male": C.IND_GIVEN_MALE,
        "first:ind:female": C.IND_GIVEN_FEMALE,
        "first:ind:unknown": C.IND_GIVEN_MALE + C.IND_GIVEN_FEMALE,
        "last:ind": C.IND_SURNAMES,
        "first:chi": chinese_given,
        "last:chi": tuple(s[1] for s in C.HAN_SURNAMES),
    }


def token_pool_key(role: Column, nk: Column) -> Column:
    eth = ethnicity(nk)
    return (
        F.when(eth == "other", None)
        .when((eth == "ind") & (role == "first"), F.concat_ws(":", role, eth, name_gender(nk)))
        .otherwise(F.concat_ws(":", role, eth))
    )


def allocate_tokens(
    tokens: DataFrame,
    known: DataFrame | None = None,
    used: DataFrame | None = None,
    config: Config = DEFAULT,
    marks: DataFrame | None = None,
) -> DataFrame:
    """One fake per ``(role, nk)``, with ``placed``.

    ``tokens`` has distinct ``role, nk`` and the count ``n``; ``known`` holds
    ``role, nk, fake`` pairs that win. New tokens try their ethnic pool, all
    others are spelled from slots behind the ``marks``; without marks, behind those
    the known tokens may occupy.
    """
    if known is None:
        fresh, reused = tokens, None
    else:
        pairs = known.select("role", "nk", "fake")
        reused = tokens.join(pairs, ["role", "nk"], "inner").select("role", "nk", "n", "fake", nowhere().alias("placed"))
        fresh = tokens.join(pairs, ["role", "nk"], "left_anti")
    keyed = fresh.withColumn("pool", token_pool_key(F.col("role"), F.col("nk")))
    ethnic = keyed.where(F.col("pool").isNotNull())
    picked = pool_pick(ethnic, token_pools(), f"{config.salt}:token", used)
    chosen = picked.where(F.col("word").isNotNull()).select("role", "nk", "n", F.col("word").alias("fake"), nowhere().alias("placed"))
    plain = keyed.where(F.col("pool").isNull()).drop("pool")
    plain = plain.unionByName(picked.where(F.col("word").isNull()).drop("pool", "word"))
    family = F.concat(F.lit("token|"), "role")
    if marks is None and known is not None:
        marks = counted_marks(known, family, ["role"], "nk")
    placed = slots(plain, ["role"], "nk", marks, family)
    slot = F.col("slot")

    def name_at(number: Column) -> Column:
        return F.when(F.col("role") == "first", spelled_name(number, C.GIVEN_ENDINGS)).otherwise(
            spelled_name(number, C.SURNAME_ENDINGS)
        )

    # A name that happens to equal the token moves to a block no first pass uses.
    spelled = placed.select(
        "role",
        "nk",
        "n",
        X.let(name_at(slot), lambda f: F.when(F.lower(f) == F.col("nk"), name_at(slot + (1 << 40))).otherwise(f)).alias("fake"),
        "placed",
    )
    out = chosen.unionByName(spelled)
    return out if reused is None else reused.unionByName(out)


def person_parts(body: Column) -> Column:
    """Tokens of a name with the text around them: ``struct(gaps, tokens)``."""
    return F.struct(
        F.split(body, TOKEN, -1).alias("gaps"), F.regexp_extract_all(body, F.lit(TOKEN), F.lit(0)).alias("tokens")
    )


def read_person(df: DataFrame, canon: str = "canon") -> DataFrame:
    """Split names into title, shape and parts.

    Shapes: ``bilingual``, ``annotated`` (a company or mark in brackets), ``han``
    (one Han token) and ``plain``.
    """
    text = F.trim(canon)
    titled = text.rlike(X.TITLE)
    df = df.withColumn(
        "title", F.when(titled, F.concat(F.regexp_extract(text, X.TITLE, 1), F.lit(" "))).otherwise(F.lit(""))
    ).withColumn("body", F.when(titled, F.regexp_extract(text, X.TITLE, 2)).otherwise(text))
    body = F.col("body")
    note = F.concat(F.regexp_extract(body, ANNOTATED, 2), F.regexp_extract(body, ANNOTATED, 3))
    return (
        df.withColumn("bilingual", X.split_bilingual(body))
        .withColumn("note", F.when(body.rlike(ANNOTATED) & ~X.is_han(note), F.trim(note)))
        .withColumn("named", F.when(F.col("note").isNotNull(), F.trim(F.regexp_extract(body, ANNOTATED, 1))))
        .withColumn(
            "shape",
            F.when(F.col("bilingual").isNotNull(), "bilingual")
            .when(F.col("note").isNotNull() & (F.length("named") > 0), "annotated")
            .when(X.is_han(body) & ~body.rlike("[\\s\\-]") & (F.length(body) >= 2), "han")
            .otherwise("plain"),
        )
    )


def explode_tokens(people: DataFrame, text: str, role: str, keys: list[str]) -> DataFrame:
    """``keys.., pos, token, trole, nk`` of plain names."""
    parts = people.select(*keys, F.col(role).alias("_role"), F.posexplode(person_parts(F.col(text))["tokens"]).alias("pos", "token"),
                          F.size(person_parts(F.col(text))["tokens"]).alias("_count"))
    trole = (
        F.when(F.col("_role") == "first", "first")
        .when(F.col("_role") == "last", "last")
        .when((F.col("_count") > 1) & (F.col("pos") == F.col("_count") - 1), "last")
        .otherwise("first")
    )
    return parts.select(*keys, "pos", "token", trole.alias("trole"), X.normalize(F.col("token")).alias("tnk"))


def distinct_tokens(rows: DataFrame) -> DataFrame:
    """``role, nk, n`` from exploded tokens; counts are combined before the shuffle."""
    return (
        rows.where("tnk <> ''")
        .groupBy(F.col("trole").alias("role"), F.col("tnk").alias("nk"))
        .agg(F.count("*").alias("n"))
    )


def assemble(
    people: DataFrame, rows: DataFrame, tokens: DataFrame, text: str, keys: list[str], weight: str | None = "n"
) -> DataFrame:
    """Put token fakes back between the separators of each name; adds ``fake``."""
    table = tokens.select(F.col("role").alias("trole"), F.col("nk").alias("tnk"), F.col("fake").alias("_f"), "n")
    joined = lookup(rows, table, ["tnk", "trole"], weight=weight)
    worded = joined.select(
        *keys, "pos", F.coalesce(X.case_like(F.col("token"), F.col("_f")), F.col("token")).alias("word")
    )
    # One group is the words of one name.
    grouped = worded.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("words"))
    back = people.join(grouped, keys, "left")
    pieces = F.zip_with(
        person_parts(F.col(text))["gaps"], F.col("words"), lambda g, w: F.concat(g, F.coalesce(w["word"], F.lit("")))
    )
    return back.withColumn("fake", F.when(F.col("words").isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))).drop("words")


# --- e-mail -----------------------------------------------------------------

HINT_TYPE = "array<struct<token:string,role:string,whole:boolean>>"


def local_clean(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def read_email(df: DataFrame, canon: str = "canon") -> DataFrame:
    """``local, domain, parts`` of an address; a value without ``@`` gets a stand-in domain."""
    text = F.trim(canon)
    domain = F.regexp_extract(text, "@([^@\\s]+)$", 1)
    local = F.split(text, "@")[0]
    return (
        df.withColumn("local", local)
        .withColumn("domain", F.when(domain == "", F.lit("example.com")).otherwise(domain))
        .withColumn("parts", F.filter(F.split(local, f"{LOCAL_SEPARATOR}+"), lambda p: p != ""))
    )


def email_tokens(emails: DataFrame, keys: list[str]) -> DataFrame:
    """Token rows an address needs: its first and last part, and its hints."""
    own = F.when(
        F.size("parts") >= 2,
        F.array(
            F.struct(F.element_at("parts", 1).alias("token"), F.lit("first").alias("trole")),
            F.struct(F.element_at("parts", -1).alias("token"), F.lit("last").alias("trole")),
        ),
    ).when(
        F.size("parts") == 1,
        F.array(F.struct(F.element_at("parts", 1).alias("token"), F.lit("first").alias("trole"))),
    ).otherwise(F.array().cast("array<struct<token:string,trole:string>>"))
    hinted = F.transform(
        F.coalesce("hints", F.array().cast(HINT_TYPE)),
        lambda h: F.struct(h["token"].alias("token"), h["role"].alias("trole")),
    )
    rows = emails.select(*keys, F.explode(F.array_distinct(F.concat(own, hinted))).alias("t"))
    return rows.select(*keys, "t.token", "t.trole", X.normalize(F.col("t.token")).alias("tnk"))


def email_candidate(fakes: Column, config: Config = DEFAULT) -> Column:
    """Fake address from ``local, domain, parts, hints`` and ``fakes``: map ``role|nk -> fake``."""

    def fake_of(role: Column | str, token: Column, default: str) -> Column:
        role = F.lit(role) if isinstance(role, str) else role
        found = F.try_element_at(fakes, F.concat(role, F.lit("|"), X.normalize(token)))
        cleaned = F.nullif(local_clean(F.coalesce(found, F.lit(""))), F.lit(""))
        return F.coalesce(cleaned, F.lit(default))

    parts, local = F.col("parts"), F.col("local")
    separator = (
        F.when(F.contains(local, F.lit(".")), ".").when(F.contains(local, F.lit("_")), "_").otherwise("")
    )
    only = F.length(F.element_at(parts, 1)) == 1
    first = X.let(fake_of("first", F.element_at(parts, 1), "user"), lambda f: F.when(only, F.substring(f, 1, 1)).otherwise(f))
    plain = (
        F.when(F.size(parts) >= 2, F.concat(first, separator, fake_of("last", F.element_at(parts, -1), "x")))
        .when(F.size(parts) == 1, fake_of("first", F.element_at(parts, 1), "user"))
        .otherwise(F.lit("user"))
    )

    cleaned_local = local_clean(local)
    hits = F.filter(
        F.transform(
            F.coalesce("hints", F.array().cast(HINT_TYPE)),
            lambda h: F.struct(
                F.length(local_clean(h["token"])).alias("size"),
                local_clean(h["token"]).alias("key"),
                fake_of(F.when(h["role"] == "last", "last").otherwise("first"), h["token"], "x").alias("fake"),
                # Surnames are tried before given names.
                F.when(h["role"] == "last", 0).otherwise(1).alias("order"),
            ),
        ),
        lambda h: (h["key"] != "") & F.contains(cleaned_local, h["key"]),
    )
    unique_hits = F.aggregate(
        F.array_sort(hits, lambda a, b: F.when(a["order"] != b["order"], a["order"] - b["order"])
                     .when(a["size"] != b["size"], b["size"] - a["size"])
                     .when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)),
        F.create_map().cast("map<string,string>"),
        lambda acc, h: F.when(F.map_contains_key(acc, h["key"]), acc).otherwise(
            F.map_concat(acc, F.create_map(h["key"], h["fake"]))
        ),
    )

    def with_hints(table: Column) -> Column:
        segments = F.split(local, f"(?<={LOCAL_SEPARATOR})|(?={LOCAL_SEPARATOR})")
        whole = F.forall(
            segments, lambda s: (local_clean(s) == "") | F.map_contains_key(table, local_clean(s))
        )
        by_segment = F.array_join(F.transform(segments, lambda s: F.coalesce(F.try_element_at(table, local_clean(s)), s)), "")
        longest_first = F.array_sort(
            F.map_keys(table),
            lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0),
        )
        combined = X.splice(cleaned_local, F.array_join(longest_first, "|"), lambda m: F.element_at(table, m))
        return F.when(F.size(table) == 0, cleaned_local).when(whole, by_segment).otherwise(combined)

    hinted = F.size(F.coalesce("hints", F.array().cast(HINT_TYPE))) > 0
    new_local = F.when(hinted, X.let(unique_hits, with_hints)).otherwise(plain)
    return F.concat(new_local, F.lit("@"), fake_domain(F.col("domain"), config))


def assemble_emails(
    emails: DataFrame,
    rows: DataFrame,
    tokens: DataFrame,
    wholes: DataFrame | None,
    used: DataFrame | None,
    keys: list[str],
    config: Config = DEFAULT,
    weight: str | None = "n",
    marks: DataFrame | None = None,
) -> DataFrame:
    """Fake addresses, unique over all originals; adds ``fake`` and ``placed``.

    ``wholes`` holds ``role, nk, fake`` of one-word person values, which win
    over the token table for hints that are a whole column value.
    """
    table = tokens.select(F.col("role").alias("trole"), F.col("nk").alias("tnk"), F.col("fake").alias("_f"), "n")
    if wholes is not None:
        better = wholes.select(F.col("role").alias("trole"), F.col("nk").alias("tnk"), F.col("fake").alias("_w"))
        table = table.join(better, ["tnk", "trole"], "left").select(
            "trole", "tnk", F.coalesce("_w", "_f").alias("_f"), "n"
        )
    joined = lookup(rows, table, ["tnk", "trole"], weight=weight)
    grouped = joined.where(F.col("_f").isNotNull()).groupBy(*keys).agg(
        F.map_from_entries(
            F.array_distinct(F.collect_list(F.struct(F.concat_ws("|", "trole", "tnk").alias("k"), F.col("_f").alias("v"))))
        ).alias("fakes")
    )
    back = emails.join(grouped, keys, "left").withColumn(
        "fakes", F.coalesce("fakes", F.create_map().cast("map<string,string>"))
    )
    drafted = back.withColumn("fake", email_candidate(F.col("fakes"), config)).drop("fakes")
    return disambiguate(drafted, "fake", keys[-1], email_tail, used, marks, weight is not None)


def bilingual_fakes(people: DataFrame, names: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Both halves of a bilingual name, and its e-mail, from one invented identity."""
    joined = people.join(names, "identity")
    bi, given_surname = F.col("bilingual"), F.concat_ws(" ", "given_latin", "surname_latin")
    local = X.split_email_local(F.split(bi["email"], "@")[0])
    digits = F.coalesce(local["digits"], F.lit(""))
    email = F.concat(
        F.lower("given_latin"), F.lit("."), F.lower("surname_latin"), digits, F.lit("@"),
        fake_domain(F.element_at(F.split(bi["email"], "@"), 2), config),
    )
    shown = F.concat(F.col("title"), given_surname, F.lit(" "), bi["open"], F.col("han"), bi["close"])
    return joined.withColumn("fake", F.when(bi["email"] != "", F.concat(shown, email)).otherwise(shown)).drop(
        "given_latin", "surname_latin", "han"
    )


