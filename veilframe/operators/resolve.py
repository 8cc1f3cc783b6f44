"""Resolve distinct values to fakes.

``resolve`` takes the distinct values of all columns at once and returns one
row per value with its fake and the reason for it. Guards and lookups are
expressions and equi-joins; each generator then runs once over the distinct
keys of its type.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators import chinese, generators, orgs, people, places
from veilframe.operators.allocate import email_tail, marks_of, merged_marks, nowhere, slots, tail_family, word_tail
from veilframe.operators.joins import HOT_ROWS
from veilframe.operators.ledger import KEYS, Ledger
from veilframe.session import materialize
from veilframe.sources import entity_map as em

VALUE_SCHEMA = f"ptype string, role string, original string, country string, hints {people.HINT_TYPE}, n bigint"


@dataclass
class Context:
    """What a generator may use besides its values."""

    config: Config = DEFAULT
    entity_map: DataFrame | None = None
    used: DataFrame | None = None
    marks: DataFrame | None = None
    subdivisions: dict | None = None
    extra: dict = field(default_factory=dict)


@dataclass
class Resolution:
    """``values`` has one row per input value; ``tokens`` is the name-token table used."""

    values: DataFrame
    tokens: DataFrame | None = None
    hot: bool = True
    before: Ledger = field(default_factory=Ledger)
    answers: DataFrame | None = None
    placed: DataFrame | None = None

    @property
    def weight(self) -> str | None:
        """Weight column for joining fakes back; none when no value is frequent."""
        return "n" if self.hot else None

    def new_pairs(self) -> DataFrame:
        """Pairs generated in this run, as input of :func:`entity_map.new_rows`."""
        fresh = self.values.where(F.col("outcome") == "NEW")
        return fresh.select(F.col("etype").alias("ptype"), F.col("target").alias("original"), F.col("target_fake").alias("fake"))

    def new_marks(self) -> DataFrame:
        """Marks behind the slots this call handed out."""
        return marks_of(self.placed)

    @cached_property
    def ledger(self) -> Ledger:
        """The ledger a later call goes on with."""
        return self.before.after(self.new_pairs(), self.answers, self.placed, self.tokens)


def effective_type(ptype: Column, value: Column) -> Column:
    """The declared type unless the value's own shape says otherwise."""
    return (
        F.when(X.looks_like_id(value), "id")
        .when(X.looks_like_url(value), "url")
        .when(~ptype.isin("email", "freetext", "url", "id") & X.looks_like_email(value), "email")
        .otherwise(ptype)
    )


def settled_type(ptype: Column, stem: Column) -> Column:
    """The type a value is resolved under."""
    etype = effective_type(ptype, stem)
    etype = F.when((etype == "url") & ~generators.url_shaped(stem), "org").otherwise(etype)
    etype = F.when((etype == "org_code") & ~orgs.is_coded(stem), "org").otherwise(etype)
    return F.when(etype == "city", "location").otherwise(etype)


def is_short(stem: Column) -> Column:
    return F.length(F.trim(stem)) <= 1


def is_reserved(stem: Column, config: Config) -> Column:
    """Text that holds a reserved fake word is taken for a fake already."""
    return F.lower(stem).rlike(X.alternation(config.reserved_fakes)) if config.reserved_fakes else F.lit(False)


# Types whose fake is a function of the very text: never stored, and the same in every table and run.
PURE = {
    "id": generators.fake_id, "url": generators.fake_url, "birth": generators.fake_birth, "postal_code": generators.fake_postal,
}


def is_pure(ptype: str, value: Column, config: Config = DEFAULT) -> Column:
    """Whether a value of the type has a fake that no table is needed for."""

    def told(stem: Column) -> Column:
        return is_short(stem) | is_reserved(stem, config) | settled_type(F.lit(ptype), stem).isin(*PURE)

    return X.let(X.file_parts(value)["stem"], told)


def pure_fake(ptype: str, value: Column, config: Config = DEFAULT) -> Column:
    """The fake of a value for which ``is_pure`` holds."""

    def made(parts: Column) -> Column:
        stem = parts["stem"]
        kind = settled_type(F.lit(ptype), stem)
        fake = F.when(is_short(stem) | is_reserved(stem, config), stem)
        for t in dict.fromkeys((ptype, "id", "url")):
            fake = fake.when(kind == t, X.apply_forced(PURE[t](stem, config), config.forced_words, config.forced_word_boundary))
        return F.concat(fake, parts["ext"])

    return F.when(value.isNotNull(), X.let(X.file_parts(value), made))


def guard(values: DataFrame, entity_map: DataFrame | None = None, config: Config = DEFAULT) -> DataFrame:
    """Decide per value whether it is kept, and under which type and text it is resolved.

    Adds ``stem``/``ext`` (file names are resolved without their extension),
    ``kept_as`` and ``outcome`` for values settled here, ``etype``, ``canon``
    and ``nk`` for the others.
    """
    parts = X.file_parts(F.col("original"))
    df = values.withColumn("stem", parts["stem"]).withColumn("ext", parts["ext"])
    stem = F.col("stem")
    nk = X.normalize(stem)
    if entity_map is not None:
        reviewed = em.non_pii_view(entity_map).select(
            F.col("nk").alias("_rnk"), F.col("label_cf").alias("_rlabel"), F.col("fake").alias("_rfake")
        )
        df = df.join(reviewed, nk == F.col("_rnk"), "left")
    else:
        df = df.withColumn("_rnk", F.lit(None).cast("string")).withColumn("_rlabel", F.lit(None).cast("string")).withColumn(
            "_rfake", F.lit(None).cast("string")
        )
    short = is_short(stem)
    same_label = em.lookup_label(F.col("ptype")) == F.col("_rlabel")
    reserved = is_reserved(stem, config)
    stop = F.col("ptype").isin("person", "org", "org_code") & X.is_harvest_stop(stem, config.system_labels)
    settled = (
        F.when(short, F.struct(stem.alias("fake"), F.lit("KEPT-SHORT").alias("outcome")))
        .when(
            F.col("_rnk").isNotNull() & F.coalesce(same_label, F.lit(False)),
            F.struct(stem.alias("fake"), F.lit("NOT-PII-SKIPPED").alias("outcome")),
        )
        .when(F.col("_rnk").isNotNull(), F.struct(F.col("_rfake").alias("fake"), F.lit("REUSE-CROSS-TYPE").alias("outcome")))
        .when(reserved | stop, F.struct(stem.alias("fake"), F.lit("GENERATED-NOT-STORED").alias("outcome")))
    )
    etype = settled_type(F.col("ptype"), stem)
    df = df.withColumn("_settled", settled).withColumn("etype", etype).drop("_rnk", "_rlabel", "_rfake")
    canon = F.when(F.col("etype") == "person", X.first_last(stem)).otherwise(stem)
    return df.withColumn("canon", canon).withColumns(
        {
            "kept_as": F.col("_settled")["fake"],
            "outcome": F.col("_settled")["outcome"],
            "nk": key_of(F.col("etype"), F.col("canon")),
        }
    ).drop("_settled")


def key_of(etype: Column, canon: Column) -> Column:
    """What makes two values one: the exact text of pure types, else the text without case and odd spaces."""
    return F.when(etype.isin(*PURE), canon).otherwise(X.normalize(canon))


# --- generators by type -----------------------------------------------------

Generator = Callable[[DataFrame, Context], DataFrame]


def _expression(build) -> Generator:
    def run(keys: DataFrame, ctx: Context) -> DataFrame:
        return keys.select("etype", "role", "nk", "country", build(F.col("canon"), ctx.config).alias("fake"))

    return run


def _by_key(build) -> Generator:
    """Wrap a generator over distinct ``nk`` values that returns ``nk, fake, placed``."""

    def run(keys: DataFrame, ctx: Context) -> DataFrame:
        once = keys.groupBy("nk").agg(F.min("canon").alias("canon"))
        return keys.select(*KEYS).join(build(once, ctx), "nk")

    return run


def _orgs(keys: DataFrame, ctx: Context) -> DataFrame:
    return orgs.org_fakes(keys, ctx.used, ctx.marks, ctx.config, ctx.extra.get("han", True), ctx.extra.get("weight", "n") is not None)


def _org_codes(keys: DataFrame, ctx: Context) -> DataFrame:
    codes = em.known_codes(ctx.entity_map) if ctx.entity_map is not None else None
    return orgs.org_code_fakes(keys, codes, ctx.used, ctx.config, ctx.marks)


def _cities(keys: DataFrame, ctx: Context) -> DataFrame:
    return places.city_fakes(keys, ctx.used, ctx.marks, ctx.config)


def _streets(keys: DataFrame, ctx: Context) -> DataFrame:
    return places.street_fakes(keys, ctx.used, ctx.marks, ctx.config)


def _states(keys: DataFrame, ctx: Context) -> DataFrame:
    """Per country, within the country that stands for it."""
    where = keys.where("country <> ''").select(F.col("country").alias("canon")).distinct()
    named = where.withColumn("ptype", F.lit("country")).withColumn("nk", X.normalize(F.col("canon")))
    if ctx.entity_map is not None:
        named = em.lookup_pairs(named, em.relevant(ctx.entity_map, named), ctx.config.strict_labels)
    else:
        named = named.withColumn("map_fake", F.lit(None).cast("string"))
    within = named.select(
        F.col("canon").alias("country"), F.coalesce("map_fake", generators.fake_country(F.col("canon"), ctx.config)).alias("within")
    )
    rows = keys.join(within, "country", "left")
    once = rows.groupBy("nk", "within").agg(F.min("canon").alias("canon")).withColumnRenamed("within", "country")
    made = places.state_fakes(once, ctx.used, ctx.marks, ctx.config, ctx.subdivisions)
    made = made.select(F.col("nk").alias("_nk"), F.col("country").alias("_within"), "fake", "placed")
    return rows.join(made, (F.col("nk") == F.col("_nk")) & F.col("within").eqNullSafe(F.col("_within"))).select(*KEYS, "fake", "placed")


def _regions(keys: DataFrame, ctx: Context) -> DataFrame:
    pool = ctx.extra.get("region_pool")
    if pool is None:
        return keys.select("etype", "role", "nk", "country", F.col("canon").alias("fake"))
    return generators.region_fakes(keys, pool, ctx.config).select(*KEYS, "fake")


GENERATORS: dict[str, Generator] = {
    **{ptype: _expression(build) for ptype, build in PURE.items()},
    "phone": _expression(generators.fake_phone),
    "country": _expression(generators.fake_country),
    "region": _regions,
    "state_province": _states,
    "location": _by_key(_cities),
    "street_name": _by_key(_streets),
    "org": _by_key(_orgs),
    "org_code": _by_key(_org_codes),
}


def register(ptype: str, generator: Generator) -> None:
    """Add or replace the generator of a type."""
    GENERATORS[ptype] = generator


# Types whose fakes are names: no two originals may share one, whatever their types. Unknown types count as companies.
WITHIN = ("region", "state_province")  # types that depend on the row's country
SHAPED = ("id", "phone", "url", "birth", "postal_code", "country", "region", "state_province", "amount")
NAMED = ("person", "email", "location", "street_name", "org", "org_code")


def _rank(etype: Column) -> Column:
    """The order in which types get a name that two of them want."""
    return F.coalesce(F.array_position(F.array(*[F.lit(t) for t in NAMED]), etype), F.lit(0)) + F.when(etype.isin(*NAMED), 0).otherwise(len(NAMED) + 1)


def _people(
    persons: DataFrame, emails: DataFrame, ctx: Context, present: dict[str, bool]
) -> tuple[list[DataFrame], DataFrame]:
    """Persons and e-mails together: both draw on one token table."""
    made: list[DataFrame] = []
    weight = ctx.extra.get("weight", "n")
    read = people.read_person(persons).where("shape <> 'annotated'")
    plain = read.where("shape = 'plain'")
    rows = people.explode_tokens(plain, "body", "role", KEYS)
    addressed = people.read_email(emails)
    email_rows = people.email_tokens(addressed, KEYS)
    sources = []
    if present.get("person"):
        sources.append(rows.select("trole", "tnk"))
    if present.get("email"):
        sources.append(email_rows.select("trole", "tnk"))
    wanted = people.distinct_tokens(sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1]))
    known = ctx.extra.get("tokens")
    if ctx.entity_map is not None:
        learned = em.learned_tokens(ctx.entity_map)
        known = learned if known is None else known.select("role", "nk", "fake").unionByName(
            learned.join(known.select("role", "nk"), ["role", "nk"], "left_anti")
        )
    tokens = materialize(people.allocate_tokens(wanted, known, ctx.used, ctx.config, ctx.marks), "tokens")
    if present.get("person"):
        made.append(
            people.assemble(plain, rows, tokens, "body", KEYS, weight).select(*KEYS, F.concat("title", "fake").alias("fake"), nowhere().alias("placed"))
        )
    if present.get("person") and (ctx.extra["bilingual"] or ctx.extra["han"]):
        bilingual = read.where("shape = 'bilingual'").withColumn(
            "identity", F.concat_ws("|", F.lower("bilingual.latin"), "bilingual.han")
        )
        han = read.where("shape = 'han'").withColumn("identity", F.col("body"))
        identities = chinese.han_identities(bilingual.select("identity").unionByName(han.select("identity")).distinct(), ctx.marks)
        made.append(people.bilingual_fakes(bilingual, identities, ctx.config).select(*KEYS, "fake", "placed"))
        made.append(han.join(identities, "identity").select(*KEYS, F.concat("title", "han").alias("fake"), "placed"))
    if present.get("email"):
        # One-word values of first- and last-name columns decide hints that are a whole value.
        reused = ctx.extra.get("reused_people")
        wholes = reused.where("role in ('first', 'last')").select("role", "nk", "fake") if reused is not None else None
        addresses = people.assemble_emails(
            addressed.withColumn("_id", F.col("nk")), email_rows.withColumn("_id", F.col("nk")), tokens, wholes,
            ctx.used, [*KEYS, "_id"], ctx.config, weight, ctx.marks,
        )
        made.append(addresses.select(*KEYS, "fake", "placed"))
    return made, tokens


def _followers(todo: DataFrame, present: dict[str, bool]) -> DataFrame | None:
    """``etype, role, nk, country, leader``: keys met under several types of names, but for the type that names them."""
    kinds = [t for t, is_open in present.items() if is_open and t not in SHAPED and t != "email"]
    if len(kinds) < 2:
        return None
    rows = todo.where(F.col("etype").isin(*kinds) & F.col("role").isin("", "full"))
    leaders = rows.groupBy("nk").agg(F.min_by("etype", F.struct(_rank(F.col("etype")), F.col("etype"))).alias("leader"), F.count_distinct("etype").alias("c"))
    led = materialize(rows.join(leaders.where("c > 1"), "nk").where("etype <> leader").select(*KEYS, "leader"), "followers")
    return led if led.take(1) else None


def _apart(fresh: DataFrame, ledger: Ledger, marks: DataFrame | None) -> DataFrame:
    """Fresh names that another original has, of any type, get a tail; repeated until none has."""
    name = F.lower(F.trim("fake"))
    while True:
        rows = fresh.where(~F.col("etype").isin(*SHAPED)).withColumn("_cf", name)
        order = F.struct(_rank(F.col("etype")), F.sha2(F.concat_ws("|", F.lit("claim"), "nk"), 256), F.col("nk"))
        claims = rows.groupBy("_cf").agg(F.min("nk").alias("a"), F.max("nk").alias("b"), F.min_by("nk", order).alias("_owner"))
        taken, owners = F.lit(False), ledger.owners(claims)
        if owners is not None:
            claims = claims.join(owners, "_cf", "left")
            taken = F.coalesce((F.col("low") != F.col("a")) | (F.col("high") != F.col("b")), F.lit(False))
        shared = claims.where((F.col("a") != F.col("b")) | taken).select("_cf", F.when(~taken, F.col("_owner")).alias("_owner"))
        shared = materialize(shared, "shared")
        if not shared.take(1):
            return fresh
        losers = rows.join(shared, "_cf").where(F.col("_owner").isNull() | (F.col("_owner") != F.col("nk")))
        once = losers.groupBy("_cf", "nk").agg(F.min(F.trim("fake")).alias("_short"))
        placed = slots(once, ["_cf"], "nk", merged_marks(marks, marks_of(fresh)), tail_family(F.col("_cf")))
        longer = F.when(F.contains("_short", F.lit("@")), email_tail(F.col("_short"), F.col("slot"))).otherwise(word_tail(F.col("_short"), F.col("slot")))
        renamed = placed.select(F.col("_cf"), F.col("nk"), longer.alias("_new"), F.col("placed").alias("_at"))
        shaped = F.col("etype").isin(*SHAPED)
        joined = fresh.withColumn("_cf", F.when(~shaped, name)).join(renamed, ["_cf", "nk"], "left")
        fresh = materialize(joined.select(*KEYS, F.coalesce("_new", "fake").alias("fake"), F.concat("placed", F.coalesce("_at", nowhere())).alias("placed")), "apart")


def resolve(
    values: DataFrame,
    entity_map: DataFrame | None = None,
    tokens: DataFrame | None = None,
    region_pool: DataFrame | None = None,
    config: Config = DEFAULT,
    prefer_clean: bool = False,
    subdivisions: dict | None = None,
    ledger: Ledger | None = None,
) -> Resolution:
    """Fakes for distinct values.

    ``values`` has ``ptype, role, original, country, hints, n`` (see
    ``VALUE_SCHEMA``). What the ledger answered in this run comes first, then
    reuse from the map, then generation; tokens of earlier runs come before new
    ones. A text met under several types of names is named under one of them and
    the others follow, unless labels are strict. The guarded values, the distinct
    keys and the token table are written to the checkpoint folder, since several
    generators read each of them.
    """
    ledger = Ledger(entity_map, tokens) if ledger is None else ledger
    ledger = ledger.ready(config, subdivisions)
    entity_map, tokens = ledger.entity_map, ledger.tokens
    used = ledger.used()
    ctx = Context(config, entity_map, used, ledger.marks, subdivisions, {"region_pool": region_pool, "tokens": tokens})
    pairs = entity_map
    if entity_map is not None:
        # Both spellings a value is looked up under; the views are made of these rows alone.
        stem = X.file_parts(F.col("original"))["stem"]
        asked = values.select(F.explode(F.array(stem, X.first_last(stem))).alias("text")).select(X.normalize(F.col("text")).alias("nk"))
        pairs = materialize(em.relevant(entity_map, asked), "pairs")
    guarded = people.read_person(guard(values, pairs, config)).withColumn(
        "shape", F.when(F.col("etype") == "person", F.col("shape"))
    )
    guarded = materialize(guarded, "guarded")
    open_ = guarded.where(F.col("outcome").isNull())
    # One row per type tells which branches have work to do and whether any value is frequent.
    facts = {
        r["etype"]: r
        for r in open_.groupBy("etype").agg(
            F.max(F.col("shape") == "annotated").alias("annotated"),
            F.max(F.col("shape") == "bilingual").alias("bilingual"),
            F.max(X.is_han(F.col("canon"))).alias("han"),
            F.max("n").alias("most"),
            F.count("*").alias("values"),
        ).collect()
    }
    hot = any(r["most"] >= HOT_ROWS or r["values"] >= HOT_ROWS for r in facts.values())
    noted = any(r["annotated"] for r in facts.values())
    ctx.extra["bilingual"] = any(r["bilingual"] for r in facts.values()) or noted
    ctx.extra["han"] = any(r["han"] for r in facts.values())
    ctx.extra["weight"] = "n" if hot else None

    nothing = F.lit(None).cast("string")
    no_hints = F.array().cast(people.HINT_TYPE)
    wanted = open_.select("etype", "role", "canon", "nk", "country", "hints", "n")
    annotated = open_.where("shape = 'annotated'").select(
        "role", "canon", "nk", "title", "body", "named", "note"
    ).dropDuplicates(["role", "nk"])
    if noted:
        # Annotated names bring two more values: the name and the note.
        extra = annotated.select(
            F.explode(
                F.array(
                    F.struct(F.lit("person").alias("etype"), F.col("role"), F.col("named").alias("canon")),
                    F.struct(F.lit("org").alias("etype"), F.lit("").alias("role"), F.col("note").alias("canon")),
                )
            ).alias("v")
        ).select("v.etype", "v.role", X.first_last(F.col("v.canon")).alias("canon"))
        extra = extra.where((F.length(F.trim("canon")) > 1) & ~X.is_harvest_stop(F.col("canon"), config.system_labels))
        wanted = wanted.unionByName(
            extra.select(
                "etype", "role", "canon", X.normalize(F.col("canon")).alias("nk"),
                nothing.alias("country"), no_hints.alias("hints"), F.lit(1).cast("bigint").alias("n"),
            )
        )
    # Region and state depend on the country, persons on the role; nothing else does.
    keys = (
        wanted.withColumn("role", F.when(F.col("etype") == "person", F.col("role")).otherwise(F.lit("")))
        .withColumn("country", F.when(F.col("etype").isin(*WITHIN), F.coalesce("country", F.lit(""))).otherwise(F.lit("")))
        .groupBy(*KEYS)
        .agg(
            F.min("canon").alias("canon"),
            F.max_by("hints", F.size(F.coalesce("hints", no_hints))).alias("hints"),
            F.sum("n").alias("n"),
        )
    )
    if entity_map is not None:
        keyed = keys.withColumns({"ptype": F.col("etype"), "_key": F.col("nk"), "nk": X.normalize(F.col("canon"))})
        # The halves of annotated names are looked up as well, so the whole map is needed then.
        looked = em.lookup_pairs(keyed, entity_map if noted else pairs, config.strict_labels).withColumn("nk", F.col("_key")).drop("ptype", "_key")
    else:
        looked = keys.withColumn("map_fake", F.lit(None).cast("string")).withColumn("map_id", F.lit(None).cast("bigint"))
    reuse = F.col("map_fake").isNotNull()
    if prefer_clean:
        reuse = reuse & ~em.is_legacy_fake(F.col("map_fake"))
    looked = looked.withColumn("reuse", reuse)
    if tokens is not None:
        # A lone first or last name keeps the fake it has in that role; the map knows no roles.
        lone = (F.col("etype") == "person") & F.col("role").isin("first", "last") & ~F.trim("canon").rlike("[\\s\\-]")
        own = tokens.select(F.col("role").alias("_role"), F.col("nk").alias("_nk"), F.col("fake").alias("_own"))
        looked = looked.join(own, lone & (F.col("role") == F.col("_role")) & (F.col("nk") == F.col("_nk")), "left")
        looked = looked.withColumn("map_fake", F.when(F.col("_own").isNull(), F.col("map_fake")).otherwise(X.case_like(F.trim("canon"), F.col("_own"))))
        looked = looked.drop("_role", "_nk", "_own")
    looked = looked.withColumn("answered", F.lit(False))
    if ledger.answers is not None:
        looked = looked.join(ledger.answers.withColumnRenamed("fake", "_given"), KEYS, "left")
        looked = looked.withColumn("answered", F.col("_given").isNotNull() & (~F.col("reuse") if not prefer_clean else F.lit(True)))
        looked = looked.withColumn("map_fake", F.coalesce("_given", "map_fake")).withColumn("reuse", F.col("reuse") | F.col("_given").isNotNull()).drop("_given")
    looked = materialize(looked, "keys")
    # One row per type: which generators have work to do.
    present = {r["etype"]: r["open"] for r in looked.groupBy("etype").agg(F.max(~F.col("reuse")).alias("open")).collect()}
    reused = looked.where("reuse").select(
        *KEYS, F.col("map_fake").alias("fake"), "map_id", F.when(F.col("answered") & F.col("map_id").isNull(), "GIVEN").otherwise("REUSE").alias("source")
    )
    ctx.extra["reused_people"] = reused.where("etype = 'person'") if "person" in present else None
    todo = looked.where("not reuse")

    followers = None if config.strict_labels else _followers(todo, present)
    if followers is not None:
        todo = todo.join(followers.select(*KEYS), KEYS, "left_anti")
    made: list[DataFrame] = []
    token_table = None
    if present.get("person") or present.get("email"):
        made_people, token_table = _people(todo.where("etype = 'person'"), todo.where("etype = 'email'"), ctx, present)
        made += made_people
    others = [t for t, is_open in present.items() if is_open and t not in GENERATORS and t not in ("person", "email")]
    for ptype, generator in GENERATORS.items():
        # Unknown types are companies, and named together with them.
        types = [ptype, *others] if ptype == "org" else [ptype]
        if any(present.get(t) for t in types):
            part = generator(todo.where(F.col("etype").isin(*types)), ctx)
            made.append(part if "placed" in part.columns else part.withColumn("placed", nowhere()))
    if not made:
        made.append(todo.where("false").select(*KEYS, F.col("canon").alias("fake"), nowhere().alias("placed")))
    fresh = materialize([part.select(*KEYS, "fake", "placed") for part in made], "fresh")
    fresh = fresh.withColumn("fake", X.apply_forced(F.col("fake"), config.forced_words, config.forced_word_boundary))
    fresh = _apart(fresh, ledger, ledger.marks)
    placed = fresh.select("placed")
    if token_table is not None:
        placed = placed.unionByName(token_table.select("placed"))
    fresh = fresh.drop("placed")
    if followers is not None:
        names = fresh.where(F.col("role").isin("", "full")).select(F.col("etype").alias("leader"), "nk", "fake")
        fresh = fresh.unionByName(followers.join(names, ["leader", "nk"]).select(*KEYS, "fake"))
    fresh = fresh.withColumn("map_id", F.lit(None).cast("bigint")).withColumn("source", F.lit("NEW"))
    if prefer_clean:
        fresh = fresh.drop("map_id", "source").join(todo.select(*KEYS, "map_id"), KEYS, "left").withColumn(
            "source", F.when(F.col("map_id").isNotNull(), "REWRITE").otherwise("NEW")
        )
    found = reused.unionByName(fresh)
    if noted:
        found = _compose_annotated(found, annotated)
    settled = guarded.where(F.col("outcome").isNotNull()).select(
        "ptype", "role", "original", "country", "etype", F.col("stem").alias("target"),
        F.col("kept_as").alias("target_fake"), F.concat("kept_as", "ext").alias("fake"), "outcome",
        F.lit(None).cast("bigint").alias("map_id"), "n",
    )
    keyed = open_.withColumn("_role", F.when(F.col("etype") == "person", F.col("role")).otherwise(F.lit(""))).withColumn(
        "_country", F.when(F.col("etype").isin(*WITHIN), F.coalesce("country", F.lit(""))).otherwise(F.lit(""))
    )
    table = found.select(
        F.col("etype").alias("etype"), F.col("role").alias("_role"), "nk", F.col("country").alias("_country"),
        F.col("fake").alias("_fake"), "map_id", "source",
    )
    answered = keyed.join(table, ["etype", "_role", "nk", "_country"], "left")
    target_fake = F.coalesce("_fake", "stem")
    stored = em.storable(F.col("etype"), F.col("canon"), target_fake)
    outcome = (
        F.when(F.col("source") == "REUSE", F.concat(F.lit("REUSE:"), F.col("map_id").cast("string")))
        .when(F.col("source") == "REWRITE", F.concat(F.lit("REUSE:"), F.col("map_id").cast("string")))
        .when(F.col("_fake").isNotNull() & (F.col("source") != "GIVEN") & stored, "NEW")
        .otherwise("GENERATED-NOT-STORED")
    )
    answered = answered.select(
        "ptype", "role", "original", "country", "etype", F.col("canon").alias("target"),
        target_fake.alias("target_fake"), F.concat(target_fake, F.col("ext")).alias("fake"),
        outcome.alias("outcome"), "map_id", "n",
    )
    return Resolution(settled.unionByName(answered), token_table, hot, ledger, found.select(*KEYS, "fake"), placed)


def _compose_annotated(found: DataFrame, annotated: DataFrame) -> DataFrame:
    """Names with a note in brackets from the fakes of their two halves."""
    names = found.where("etype = 'person'").select(F.col("role").alias("_r"), F.col("nk").alias("_n"), F.col("fake").alias("_name"))
    notes = found.where("etype = 'org'").select(F.col("nk").alias("_o"), F.col("fake").alias("_note"))
    half = annotated.withColumn("_n", X.normalize(X.first_last(F.col("named")))).withColumn(
        "_o", X.normalize(X.first_last(F.col("note")))
    )
    joined = half.join(names.withColumnRenamed("_r", "role"), ["role", "_n"], "left").join(notes, "_o", "left")
    square = F.col("body").rlike("\\]\\s*$")
    fake = F.concat(
        F.col("title"), F.coalesce("_name", "named"), F.when(square, " [").otherwise(" ("),
        F.coalesce("_note", "note"), F.when(square, "]").otherwise(")"),
    )
    composed = joined.select(
        F.lit("person").alias("etype"), "role", "nk", F.lit("").alias("country"), fake.alias("fake"),
        F.lit(None).cast("bigint").alias("map_id"), F.lit("NEW").alias("source"),
    )
    # A reused whole value wins over the composed one.
    fresh = composed.join(found.where("etype = 'person'").select("role", "nk"), ["role", "nk"], "left_anti")
    return found.unionByName(fresh.select(*found.columns))


def audit(column: str, resolution: DataFrame, known_ids: DataFrame | None = None) -> DataFrame:
    """One record per decision: ``column, original, fake, outcome``.

    With ``known_ids`` (the appended map rows) new pairs show their id.
    """
    rows = resolution.withColumn("column", F.lit(column))
    if known_ids is None:
        return rows.select("column", "original", "fake", "outcome")
    ids = known_ids.select(X.normalize(F.col("original")).alias("_nk"), F.col("id").alias("_id"))
    joined = rows.withColumn("_nk", X.normalize(F.col("target"))).join(ids, "_nk", "left")
    outcome = F.when(
        (F.col("outcome") == "NEW") & F.col("_id").isNotNull(), F.concat(F.lit("NEW:"), F.col("_id").cast("string"))
    ).otherwise(F.col("outcome"))
    return joined.select("column", "original", "fake", outcome.alias("outcome"))
