"""Fakes that are a pure function of the value: no map, no join, no shuffle.

Identifiers, phone numbers and acronyms go through a bijection, so they are
injective by construction at any scale. Domains, URLs, countries, birth dates,
postal codes and amounts are many-to-one by design.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import config as C
from veilframe.config import DEFAULT, Config
from veilframe.functions import text as X
from veilframe.functions.seeds import (
    PLAIN_CLASSES,
    _byte,
    _stream,
    characters,
    let,
    literal_array,
    permute_chars,
    pick,
    seed,
)

ID_SEGMENT = "[_\\-]"
BARE_HOST = "^[A-Za-z0-9][A-Za-z0-9_\\-]*(\\.[A-Za-z0-9][A-Za-z0-9_\\-]*)+([/:?#]|$)"
SCHEME = "^([A-Za-z][A-Za-z0-9+.\\-]*://)"
BIRTH = "^([0-9]{4})([./\\-])([0-9]{1,2})(?:([./\\-])([0-9]{1,2}))?$"


def fake_id(value: Column, config: Config = DEFAULT) -> Column:
    """Opaque identifier: digits stay digits, hex letters hex, case and separators kept."""
    return permute_chars(value, f"{config.salt}:id")


def fake_id_with_hints(value: Column, hints: Column, config: Config = DEFAULT) -> Column:
    """Compound identifier whose segments may repeat another id of the row.

    ``hints`` maps a raw segment to the fake that segment has in its own column.
    """
    segments = F.split(value, f"(?<={ID_SEGMENT})|(?={ID_SEGMENT})")
    known = F.exists(segments, lambda s: F.coalesce(F.map_contains_key(hints, s), F.lit(False)))
    rebuilt = F.array_join(
        F.transform(segments, lambda s: F.coalesce(F.try_element_at(hints, s), fake_id(s, config))), ""
    )
    return F.when(F.coalesce(known, F.lit(False)), rebuilt).otherwise(fake_id(value, config))


def fake_phone(value: Column, config: Config = DEFAULT) -> Column:
    """Digit for digit; a value without digits becomes a reserved-range number."""
    digitless = F.concat(
        F.lit("+1-555-"), F.lpad(F.pmod(seed(config.salt, "phone", X.normalize(value)), F.lit(10000)).cast("string"), 4, "0")
    )
    return F.when(value.rlike("[0-9]"), permute_chars(value, f"{config.salt}:phone", (PLAIN_CLASSES[0],))).otherwise(
        digitless
    )


def fake_acronym(value: Column, config: Config = DEFAULT) -> Column:
    """Same length and shape; letter to letter with its case, digit to digit."""
    return permute_chars(value, f"{config.salt}:acronym", PLAIN_CLASSES)


def fake_postal(value: Column, config: Config = DEFAULT) -> Column:
    """Every digit moves by 1 to 8, so none is kept; the rest stays."""

    def moved(stream: Column) -> Column:
        return F.array_join(
            F.transform(
                characters(value),
                lambda c, i: F.when(
                    c.rlike("[0-9]"),
                    F.pmod(F.instr(F.lit("0123456789"), c) - 1 + 1 + F.pmod(_byte(stream, i), F.lit(8)), F.lit(10)).cast(
                        "string"
                    ),
                ).otherwise(c),
            ),
            "",
        )

    return let(_stream(F.concat_ws("|", F.lit(config.salt), F.lit("zip"), value), F.length(value)), moved)


def public_suffix_length(labels: Column) -> Column:
    """Number of trailing labels that form the public suffix."""
    last_two = F.lower(F.array_join(F.slice(labels, -2, 2), "."))
    return F.when((F.size(labels) >= 2) & last_two.isin(*C.TWO_LEVEL_SUFFIXES), 2).otherwise(1)


def fake_domain(domain: Column, config: Config = DEFAULT) -> Column:
    """Public providers stay, a company domain becomes two brand words plus its suffix."""
    lowered = F.lower(F.trim(domain))
    heads = [h.lower() for h in C.ORG_HEADS]

    def masked(labels: Column) -> Column:
        suffix_labels = public_suffix_length(labels)
        suffix = F.array_join(F.slice(labels, -suffix_labels, suffix_labels), ".")
        registrable = F.element_at(labels, F.greatest(F.size(labels) - suffix_labels, F.lit(1)))
        forced = X.apply_forced(registrable, config.forced_words, config.forced_word_boundary)
        draw = seed(config.salt, "domain", lowered)
        brand = F.concat(pick(draw, heads), pick(F.floor(draw / len(heads)), heads))
        core = F.when(forced != registrable, F.regexp_replace(F.lower(forced), "[^a-z0-9]", "")).otherwise(brand)
        return F.concat(core, F.lit("."), suffix)

    return (
        F.when(F.coalesce(lowered, F.lit("")) == "", F.lit("example.com"))
        .when(~F.contains(lowered, F.lit(".")), domain)
        .when(lowered.isin(*C.PUBLIC_EMAIL_DOMAINS), domain)
        .otherwise(let(F.split(lowered, "\\."), masked))
    )


def url_shaped(value: Column) -> Column:
    """The value can be relabelled: scheme or bare host, and one URL only."""
    trimmed = F.trim(value)
    rest = F.regexp_replace(trimmed, SCHEME, "")
    return (trimmed.rlike(SCHEME) | trimmed.rlike(BARE_HOST)) & ~F.contains(rest, F.lit("://"))


def fake_url(value: Column, config: Config = DEFAULT) -> Column:
    """Swap the registrable label; scheme, sub-domains, suffix, port and path stay.

    User info is dropped. Null for text that is not one URL: such values belong
    to the organisation generator.
    """
    heads = [h.lower() for h in C.ORG_HEADS]
    trimmed = F.trim(value)
    untouched = X.apply_forced(trimmed, config.forced_words, config.forced_word_boundary)
    rest = F.regexp_replace(trimmed, SCHEME, "")
    netloc = F.regexp_extract(rest, "^([^/?#]*)", 1)
    authority = F.regexp_replace(netloc, "^.*@", "")
    parts = F.struct(
        F.regexp_extract(trimmed, SCHEME, 1).alias("scheme"),
        F.split(F.regexp_extract(authority, "^([^:]*)", 1), "\\.").alias("labels"),
        F.regexp_extract(authority, "^[^:]*(:.*)$", 1).alias("port"),
        F.substr(rest, F.length(netloc) + 1).alias("tail"),
    )

    def relabel(label: Column) -> Column:
        forced = X.apply_forced(label, config.forced_words, config.forced_word_boundary)
        draw = seed(config.salt, "host", F.lower(label))
        word = F.when(pick(draw, heads) == F.lower(label), pick(draw + 1, heads)).otherwise(pick(draw, heads))
        return F.when(F.lower(forced) != F.lower(label), forced).otherwise(X.case_like(label, word))

    def build(p: Column) -> Column:
        labels = p["labels"]
        single = F.size(labels) < 2
        place = F.when(single, 0).otherwise(F.size(labels) - public_suffix_length(labels) - 1)
        trivial = single & (F.length(F.regexp_replace(F.element_at(labels, 1), "[^\\p{L}]", "")) < 2)
        swapped = F.transform(labels, lambda label, i: F.when(i == place, relabel(label)).otherwise(label))
        return F.when(trivial | (place < 0), untouched).otherwise(
            F.concat(p["scheme"], F.array_join(swapped, "."), p["port"], p["tail"])
        )

    return F.when(url_shaped(value), let(parts, build))


def fake_country(value: Column, config: Config = DEFAULT) -> Column:
    """A different real country in the same form: alpha-2, alpha-3 or name."""
    names = literal_array([c[0] for c in C.COUNTRIES])
    two = literal_array([c[1] for c in C.COUNTRIES])
    three = literal_array([c[2] for c in C.COUNTRIES])
    count = len(C.COUNTRIES)

    def choose(nk: Column) -> Column:
        letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))

        def form(at: Column) -> Column:
            return (
                F.when(letters == 2, F.element_at(two, at))
                .when(letters == 3, F.element_at(three, at))
                .otherwise(F.element_at(names, at))
            )

        def other(first: Column) -> Column:
            itself = nk.isNotNull() & (
                (F.lower(F.element_at(names, first)) == nk)
                | (F.lower(F.element_at(two, first)) == nk)
                | (F.lower(F.element_at(three, first)) == nk)
            )
            return F.when(itself, form(F.pmod(first, F.lit(count)) + 1)).otherwise(form(first))

        return let((F.pmod(seed(config.salt, "country", nk), F.lit(count)) + 1).cast("int"), other)

    return X.case_like(F.trim(value), let(X.normalize(value), choose))


def fake_birth(value: Column, config: Config = DEFAULT) -> Column:
    """Move a ``YYYY<sep>MM[<sep>DD]`` text date by a few days, months and years."""
    trimmed = F.trim(value)
    part = {i: F.regexp_extract(trimmed, BIRTH, i) for i in range(1, 6)}
    month_ok = F.try_to_number(F.concat(F.lit("0"), part[3]), F.lit("999")).between(1, 12)

    def draw(tag: str, low: int, span: int) -> Column:
        return (F.pmod(seed(config.salt, "birth", tag, value), F.lit(span)) + low).cast("int")

    def padded(number: Column, like: Column) -> Column:
        shown = number.cast("string")
        return F.when(F.length(shown) >= F.length(like), shown).otherwise(F.lpad(shown, F.length(like), F.lit("0")))

    years = F.element_at(F.array(*[F.lit(y) for y in (-3, -2, 2, 3)]), draw("y", 1, 4))
    has_day = part[5] != ""
    day = F.when(has_day, part[5].cast("int")).otherwise(1)
    first = F.add_months(F.make_date(part[1].cast("int") + years, part[3].cast("int"), F.lit(1)), draw("m", -2, 5))
    clamped = F.date_add(first, F.least(day, F.dayofmonth(F.last_day(first))) - 1)
    moved = F.date_add(clamped, F.when(has_day, draw("d", -5, 11)).otherwise(0))
    text = let(
        moved,
        lambda d: F.concat(
            padded(F.year(d), part[1]),
            part[2],
            padded(F.month(d), part[3]),
            F.when(has_day, F.concat(part[4], padded(F.dayofmonth(d), part[5]))).otherwise(F.lit("")),
        ),
    )
    return F.when(trimmed.rlike(BIRTH) & month_ok, text).otherwise(fake_id(value, config))


def jitter_factor(*key, config: Config = DEFAULT) -> Column:
    """Uniform share in ``±max_jitter`` seeded by the cell's address."""
    return seed(config.salt, "amount", *key) / F.lit(float(1 << 52)) * F.lit(2 * config.max_jitter) - F.lit(
        config.max_jitter
    )


def fake_amount(value: Column, dtype: T.DataType, *key, config: Config = DEFAULT) -> Column:
    """Jitter a number, keeping its type and scale; zero stays zero.

    ``key`` addresses the cell (table, column, row key) so that reruns agree.
    """
    share = jitter_factor(*key, config=config)
    if isinstance(dtype, T.DecimalType):
        delta = (value.cast("double") * share).cast(dtype)
        return F.coalesce(F.try_add(value, delta).try_cast(dtype), (value - delta).cast(dtype))
    moved = value.cast("double") * (F.lit(1.0) + share)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return moved.cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.coalesce((value.try_cast("double") * (F.lit(1.0) + share)).cast("string"), value)
    return F.coalesce(F.round(moved).try_cast(dtype), value)


def region_pool(df: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """``country, rank, code, size``: observed codes without the ones filed under the wrong country.

    ``columns`` are pairs of a country and a region column. Codes whose leading
    part is not the country's most common one are dropped when that part occurs
    more than once; ties go to the smallest part. Ranks count from 0 in the order
    of the codes.
    """
    kept = None
    for country, region in columns:
        pairs = (
            df.select(F.col(country).cast("string").alias("country"), F.col(region).cast("string").alias("code"))
            .where(F.col("country").isNotNull() & F.col("code").isNotNull())
            .distinct()
            .withColumn("prefix", F.split("code", "-")[0])
        )
        counted = pairs.groupBy("country", "prefix").agg(F.count("*").alias("n"))
        best = counted.groupBy("country").agg(F.max("n").alias("top"), F.min_by("prefix", F.struct(-F.col("n"), F.col("prefix"))).alias("best"))
        good = pairs.join(best, "country").where((F.col("top") <= 1) | (F.col("prefix") == F.col("best"))).select("country", "code")
        kept = good if kept is None else kept.unionByName(good)
    kept = kept.distinct() if len(columns) > 1 else kept
    rank = F.row_number().over(Window.partitionBy("country").orderBy("code")) - 1
    sizes = kept.groupBy("country").agg(F.count("*").alias("size"))
    return kept.withColumn("rank", rank).join(sizes, "country").select("country", "rank", "code", "size")


def region_fakes(values: DataFrame, pool: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """``values`` (``canon``, ``country``) with ``fake``: another observed code of the country, itself when there is none.

    A value draws the rank of its fake among the country's other codes, and the
    code of that rank is looked up; a country's codes are never put in one row.
    """
    nk = X.normalize(F.col("canon"))
    # Spellings of one code are one value, so none is drawn for another.
    own = pool.select(F.col("country").alias("_c"), X.normalize(F.col("code")).alias("_nk"), "rank")
    own = own.groupBy("_c", "_nk").agg(F.array_sort(F.collect_list("rank")).alias("_own"))  # the spellings of one code
    sizes = pool.groupBy(F.col("country").alias("_s")).agg(F.max("size").alias("_size"))
    rows = values.join(sizes, F.col("country") == F.col("_s"), "left").join(own, (F.col("country") == F.col("_c")) & (nk == F.col("_nk")), "left")
    skipped = F.coalesce("_own", F.array().cast("array<int>"))
    left = F.col("_size") - F.size(skipped)
    draw = F.pmod(seed(config.salt, "region", F.col("country"), nk), left)
    # The draw counts the other codes only, so it moves up past each own rank at or below it.
    at = F.aggregate(skipped, draw, lambda place, mine: F.when(mine <= place, place + 1).otherwise(place))
    drawn = rows.withColumn("_at", F.when(left > 0, at.cast("int")))
    codes = pool.select(F.col("country").alias("_d"), F.col("rank").alias("_rank"), F.col("code").alias("_code"))
    found = drawn.join(codes, (F.col("country") == F.col("_d")) & (F.col("_at") == F.col("_rank")), "left")
    return found.select(*values.columns, F.coalesce("_code", "canon").alias("fake"))
