"""Anonymise a table by its plan.

Everything a table mentions is collected first: the values of its columns, what
its texts name, and the pieces of its address cells. All of it is resolved in one
call, so a value has one fake wherever it stands. Only what a detector finds in
texts already rewritten comes later; those calls go on with the ledger.

Identifiers, URLs, dates of birth and postal codes have fakes that need no table,
so they are rewritten in the scan. The other columns are told apart by their
*tuple*, the values a row holds in them: tuples are counted once, their fakes are
looked up value by value, and rows meet the fakes of their tuple in one join,
however many columns there are. Rows without any such value take no part in it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.operators import freetext, geo, rowhints
from veilframe.operators.detector import Detector
from veilframe.operators.generators import fake_amount, region_pool
from veilframe.operators.joins import lookup
from veilframe.operators.ledger import Ledger
from veilframe.operators.people import HINT_TYPE
from veilframe.operators.resolve import PURE, WITHIN, Resolution, is_pure, is_short, pure_fake, resolve
from veilframe.plans.plan import ColumnPlan, enabled, filter_condition, person_role, table_domain
from veilframe.session import materialize
from veilframe.sources import entity_map as em
from veilframe.sources.tables import merge_columns, width_of, write_copy


@dataclass
class Anonymised:
    """A rebuilt table and what was learned while building it."""

    df: DataFrame
    calls: list[Resolution] = field(default_factory=list)
    audit: DataFrame | None = None

    @property
    def tokens(self) -> DataFrame | None:
        """The name tokens after this run, those of earlier runs included."""
        return self.ledger.tokens if self.calls else None

    @property
    def ledger(self) -> Ledger:
        """The ledger for the next run."""
        return self.calls[-1].ledger if self.calls else Ledger()

    def new_pairs(self) -> DataFrame | None:
        """Pairs generated in this run, distinct."""
        parts = [call.new_pairs() for call in self.calls]
        if not parts:
            return None
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.distinct()

    def map_rows(self, entity_map: DataFrame) -> DataFrame | None:
        pairs = self.new_pairs()
        return None if pairs is None else em.new_rows(pairs, entity_map)


def _role(p: ColumnPlan) -> str:
    return person_role(p.column) if p.type == "person" else ""


# The bitmap of map keys that identifiers are held against; more keys only send more cells to the join.
MAP_WORDS = 1 << 14


def _map_bits(entity_map: DataFrame) -> list[int]:
    """Bits of the map's keys with digits, hashed; of fixed size, whatever the map."""
    bit = F.pmod(F.xxhash64("nk"), F.lit(MAP_WORDS * 64))
    rows = (
        em.clean(entity_map).where(F.col("nk").rlike("[0-9]")).select(bit.alias("b"))
        .groupBy(F.expr("b div 64").cast("int").alias("w"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("b", F.lit(64)).cast("int"))).alias("v")).collect()
    )
    words = [0] * MAP_WORDS
    for row in rows:
        words[row["w"]] = row["v"]
    return words


def _in_map(value: Column, words: list[int] | None) -> Column:
    """Whether the map may hold the value; never false for one it holds."""
    if words is None:
        return F.lit(False)
    table = F.from_json(F.lit(json.dumps(words)), "array<bigint>")

    def held(nk: Column) -> Column:
        bit = F.pmod(F.xxhash64(nk), F.lit(MAP_WORDS * 64))
        return F.bit_get(F.element_at(table, (F.floor(bit / 64) + 1).cast("int")), F.pmod(bit, F.lit(64)).cast("int")) == 1

    return ~value.rlike("[0-9]") | X.let(X.normalize(X.file_parts(value)["stem"]), held)


@dataclass
class Tuples:
    """The distinct tuples of the columns that need a table, written down: ``tid``, the values, ``n``."""

    table: DataFrame
    columns: list[ColumnPlan]
    cells: dict[str, Column]  # what each of the columns asks for, null if nothing
    country: dict[str, Column]
    tid: Column
    empty: bool

    def _asked(self, i: int) -> Column:
        p = self.columns[i]
        return F.struct(
            F.lit(i).alias("at"), F.lit(p.type).alias("ptype"), F.lit(_role(p)).alias("role"), F.col(f"_v{i}").alias("original"),
            (F.col(f"_c{i}") if p.column in self.country else F.lit(None).cast("string")).alias("country"),
        )

    def exploded(self, *more: str) -> DataFrame:
        """``tid, at, ptype, role, original, country, n`` of every value in a tuple."""
        asked = F.explode(F.array(*[self._asked(i) for i in range(len(self.columns))]))
        return self.table.select("tid", "n", *more, asked.alias("c")).select("tid", "n", *more, "c.*").where(F.col("original").isNotNull())

    def values(self) -> DataFrame:
        """What ``resolve`` is asked; addresses carry the name hints of all rows that share them."""
        counted = self.exploded().groupBy("ptype", "role", "original", "country").agg(F.sum("n").alias("n"))
        people_columns = [(F.col(f"_v{i}"), person_role(p.column)) for i, p in enumerate(self.columns) if p.type == "person"]
        mails = [F.col(f"_v{i}") for i, p in enumerate(self.columns) if p.type == "email"]
        none = F.array().cast(HINT_TYPE)
        if not mails or not people_columns:
            return counted.withColumn("hints", none)
        hinted = self.table.select(
            F.explode(F.array(*[F.struct(F.trim(m).alias("email"), rowhints.email_hints(m, people_columns).alias("hints")) for m in mails])).alias("h")
        ).select("h.*")
        united = rowhints.union_hints(hinted, "email", "hints").select(F.col("email").alias("_e"), "hints")
        joined = counted.withColumn("_e", F.when(F.col("ptype") == "email", F.trim("original"))).join(united, "_e", "left")
        return joined.drop("_e").withColumn("hints", F.coalesce("hints", none))

    def fakes(self, answers: DataFrame, weight: str | None) -> DataFrame:
        """``_tid, _fakes, n``: the fakes of a tuple by the number of their column, written down."""
        table = answers.select("ptype", "role", "original", F.coalesce("country", F.lit("")).alias("country"), F.col("fake").alias("_fake"), "n")
        asked = self.exploded().withColumnRenamed("n", "_n").withColumn("country", F.coalesce("country", F.lit("")))
        joined = lookup(asked, table, ["original", "country", "ptype", "role"], weight=weight)
        found = joined.groupBy("tid").agg(
            F.map_from_entries(F.collect_list(F.struct("at", "_fake"))).alias("_fakes"), F.max("_n").alias("n")  # one entry a column
        )
        return materialize(found.withColumnRenamed("tid", "_tid"), "fakes")


def read_tuples(df: DataFrame, plan: list[ColumnPlan], entity_map: DataFrame | None = None, config: Config = DEFAULT) -> Tuples:
    """One scan: cells are counted per tuple before they are shuffled."""
    words = _map_bits(entity_map) if entity_map is not None and any(p.type in PURE for p in plan) else None
    cells, country = {}, {}
    for p in plan:
        value = F.col(f"`{p.column}`").cast("string")
        asks = filter_condition(p, df.columns)
        if p.type in PURE:
            asks = asks & (~is_pure(p.type, value, config) | _in_map(value, words))
        cells[p.column] = F.when(asks, value)
        if p.type in WITHIN and p.country_column:
            country[p.column] = F.col(f"`{p.country_column}`").cast("string")
    named = [cells[p.column].alias(f"_v{i}") for i, p in enumerate(plan)]
    named += [F.when(cells[p.column].isNotNull(), country[p.column]).alias(f"_c{i}") for i, p in enumerate(plan) if p.column in country]
    some = F.coalesce(*cells.values()).isNotNull()
    tid = F.when(some, F.sha2(F.to_json(F.struct(*named)), 256))
    rows = df.select(*named)
    some_left = F.coalesce(*[F.col(f"_v{i}") for i in range(len(plan))]).isNotNull()
    counted = rows.where(some_left).groupBy(*rows.columns).agg(F.count("*").alias("n"))
    table = materialize(counted.withColumn("tid", F.sha2(F.to_json(F.struct(*rows.columns)), 256)), "tuples")
    return Tuples(table, plan, cells, country, tid, not table.take(1))


def _hints_united(parts: list[DataFrame]) -> DataFrame:
    """Values of several sources as distinct ones."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if len(parts) == 1:
        return out
    return out.groupBy("ptype", "role", "original", "country").agg(
        F.max_by("hints", F.size(F.coalesce("hints", F.array().cast(HINT_TYPE)))).alias("hints"), F.sum("n").alias("n")
    )


def anonymize(
    df: DataFrame,
    plan: list[ColumnPlan],
    table: str = "table",
    keys: list[str] | None = None,
    entity_map: DataFrame | None = None,
    tokens: DataFrame | None = None,
    config: Config = DEFAULT,
    make_detector: Callable[[], Detector] | None = None,
    make_geo_detector: Callable[[], Detector] | None = None,
    prefer_clean: bool = False,
    subdivisions: dict | None = None,
    ledger: Ledger | None = None,
) -> Anonymised:
    """The anonymised copy of ``df``: same columns, types and rows.

    Structured columns are resolved over distinct values and joined back, texts
    are scrubbed with everything the table's people and addresses taught, all
    other columns pass through untouched. ``keys`` identify a row; they seed the
    jitter of amounts, which otherwise takes the whole row. ``ledger`` is what an
    earlier run left (``Anonymised.ledger``); else it starts from the map and the
    tokens.
    """
    ledger = Ledger(entity_map, tokens) if ledger is None else ledger
    entity_map = ledger.entity_map
    active = enabled(plan)
    texts = [p for p in active if p.mode == "freetext" or p.type == "freetext"]
    composites = [p for p in active if p.type == "location_composite"]
    amounts = [p for p in active if p.type == "amount"]
    direct = [p for p in active if p not in texts and p not in composites and p not in amounts]
    out, result = df, Anonymised(df)
    audits: list[DataFrame] = []

    def text_of(p: ColumnPlan) -> Column:
        return F.when(filter_condition(p, df.columns), F.col(f"`{p.column}`").cast("string"))

    observed = [(p.country_column, p.column) for p in direct if p.type == "region" and p.country_column]
    pool = materialize(region_pool(df, *observed), "regions") if observed else None

    tuples = read_tuples(df, direct, entity_map, config) if direct else None
    parts = [] if tuples is None or tuples.empty else [tuples.values()]
    mentions = None
    if texts:
        mentions = freetext.collect_mentions(df, [text_of(p) for p in texts])
        named = freetext.known_entities(
            df, [p.column for p in direct if p.type == "person"], [p.column for p in direct if p.type == "email"], [p.column for p in texts],
        )
        role = F.when(F.col("ptype") == "person", "full").otherwise("")
        none = F.lit(None).cast("string")
        parts.append(freetext.as_values(mentions))
        parts.append(named.select("ptype", role.alias("role"), "original", none.alias("country"), F.array().cast(HINT_TYPE).alias("hints"), "n"))
    addresses = {}
    if composites:
        places = materialize(geo.gazetteer(geo.world_places(df.sparkSession, subdivisions), entity_map), "places")
        for p in composites:
            addresses[p.column] = geo.read_composite(
                df, p.column, places, config, p.country_column, make_detector, make_geo_detector, text_of(p)
            )
            parts.append(addresses[p.column].values())

    answer = known = None
    if parts:
        columns = ["ptype", "role", "original", "country", "hints", "n"]
        answer = resolve(_hints_united([part.select(*columns) for part in parts]), None, None, pool, config, prefer_clean, subdivisions, ledger)
        answer.values = materialize(answer.values, "values")
        result.calls.append(answer)
        people = answer.values.where("ptype in ('person', 'email')")
        # A word that is a name in several roles is known by its whole name first.
        order = F.array_position(F.array(F.lit("last"), F.lit("first"), F.lit("full"), F.lit("")), F.col("role"))
        known = people.groupBy("ptype", "original").agg(F.max_by("fake", order).alias("fake"))

    if direct:
        if not tuples.empty:
            out = lookup(out.withColumn("_tid", tuples.tid), tuples.fakes(answer.values, answer.weight), ["_tid"], weight=answer.weight)
            out = out.drop("_tid")
        fakes = {}
        for i, p in enumerate(direct):
            value = F.col(f"`{p.column}`").cast("string")
            fake = F.lit(None).cast("string") if tuples.empty else F.try_element_at("_fakes", F.lit(i))
            if p.type in PURE:
                open_ = filter_condition(p, df.columns)
                made = F.when(open_, pure_fake(p.type, value, config))
                fake = made if tuples.empty else F.when(tuples.cells[p.column].isNull(), made).otherwise(fake)
                shaped = df.where(open_ & value.isNotNull() & tuples.cells[p.column].isNull()).select(value.alias("original")).distinct()
                kept = F.when(is_short(X.file_parts(F.col("original"))["stem"]), "KEPT-SHORT").otherwise("GENERATED-NOT-STORED")
                audits.append(shaped.select(F.lit(p.column).alias("column"), "original", pure_fake(p.type, F.col("original"), config).alias("fake"), kept.alias("outcome")))
            fakes[f"_fake_{p.column}"] = fake
            if not tuples.empty:
                asked = tuples.exploded().where(F.col("at") == i).select("original").distinct()
                answers = answer.values.where((F.col("ptype") == p.type) & (F.col("role") == _role(p))).join(asked, "original", "left_semi")
                audits.append(answers.select(F.lit(p.column).alias("column"), "original", "fake", "outcome"))
        out = out.withColumns(fakes).drop("_fakes")

    ids = [p for p in direct if p.type == "id"]
    if len(ids) > 1:
        atoms = rowhints.atomic_ids([(F.col(p.column).cast("string"), F.col(f"_fake_{p.column}")) for p in ids])
        out = out.withColumn("_atoms", atoms)
        for p in ids:
            raw = F.col(p.column).cast("string")
            out = out.withColumn(f"_fake_{p.column}", rowhints.compound_id(raw, F.col(f"_fake_{p.column}"), F.col("_atoms"), config))

    if texts:
        people_columns = [p for p in direct if p.type == "person"]
        fragments = None
        if people_columns:
            fragments = "_fragments"
            out = out.withColumn(
                fragments, rowhints.name_fragments([(F.col(p.column), F.col(f"_fake_{p.column}")) for p in people_columns])
            )
        for p in texts:
            out = out.withColumn(f"_fake_{p.column}", text_of(p))
        out, used = freetext.scrub_columns(
            out, [f"_fake_{p.column}" for p in texts], fragments, known=known, config=config,
            domain=table_domain(table, config), make_detector=make_detector, answered=(mentions, answer),
        )
        result.calls += used
    for p in composites:
        out = geo.rewrite_composite(out, addresses[p.column], answer.values, f"_fake_{p.column}", config)

    by_name = {p.column: p for p in active}
    row_key = [F.col(k).cast("string") for k in keys] if keys else [F.to_json(F.struct(*df.columns))]
    final = []
    for f in df.schema.fields:
        p = by_name.get(f.name)
        original = F.col(f"`{f.name}`")
        if p is None:
            final.append(original)
        elif p.type == "amount":
            moved = fake_amount(original, f.dataType, F.lit(table), F.lit(f.name), *row_key, config=config)
            final.append(F.when(filter_condition(p, df.columns), moved).otherwise(original).cast(f.dataType).alias(f.name, metadata=f.metadata))
        else:
            fake = X.fit_width(F.col(f"_fake_{f.name}"), width_of(f))
            final.append(F.coalesce(fake, original.cast("string")).cast(f.dataType).alias(f.name, metadata=f.metadata))
    result.df = out.select(*final)
    if audits:
        audit = audits[0]
        for a in audits[1:]:
            audit = audit.unionByName(a)
        result.audit = audit
    return result


def rebuild(df: DataFrame, plan: list[ColumnPlan], path: str, **options) -> Anonymised:
    """Write the whole anonymised copy, replacing what is there."""
    result = anonymize(df, plan, **options)
    write_copy(result.df, path, df.schema)
    return result


def merge_into(existing: DataFrame, source: DataFrame, plan: list[ColumnPlan], keys: list[str], **options) -> DataFrame:
    """An existing copy with only the enabled columns replaced, matched by key."""
    from veilframe.plans.keys import require_unique

    require_unique(source, keys)
    result = anonymize(source, plan, keys=keys, **options)
    return merge_columns(existing, result.df, keys, [p.column for p in enabled(plan)])


def trial(df: DataFrame, plan: list[ColumnPlan], path: str, entity_map: DataFrame, limit: int = 100, order_by: list[str] | None = None, **options) -> None:
    """A throw-away run on a few rows: copy, new pairs and audit go to ``path``; the map is only read."""
    from veilframe.sources.tables import take

    result = anonymize(take(df, limit, order_by), plan, entity_map=entity_map, **options)
    result.df.write.mode("overwrite").parquet(f"{path}/copy")
    rows = result.map_rows(entity_map)
    if rows is not None:
        rows.write.mode("overwrite").parquet(f"{path}/map")
    if result.audit is not None:
        dry = F.when(F.col("outcome") == "NEW", "NEW:DRY-RUN").otherwise(F.col("outcome"))
        result.audit.withColumn("outcome", dry).write.mode("overwrite").parquet(f"{path}/audit")


