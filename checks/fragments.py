"""DuckDB SQL fragments the oracles are written with.

They restate the library's definitions in another dialect, from the same
vocabularies, so that both sides can be compared value by value.
"""

from __future__ import annotations

from veilframe import config as C
from veilframe.functions.seeds import DIGITS, ID_CLASSES, PLAIN_CLASSES

SALT = "veil"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def seed(*parts: str) -> str:
    """52-bit seed over SQL string expressions joined by ``|``."""
    return f"('0x' || substr(sha256(concat_ws('|', {', '.join(parts)})), 1, 13))::BIGINT"


def pick(index: str, values) -> str:
    return f"({array(values)})[(({index}) % {len(values)}) + 1]"


def normalize(value: str) -> str:
    return f"replace(lower(trim(regexp_replace(strip_accents({value}), '\\s+', ' ', 'g'))), 'ß', 'ss')"


def byte(stream: str, at: str) -> str:
    """0-based byte of a hex stream."""
    return f"('0x' || substr({stream}, 2 * ({at}) + 1, 2))::INT"


def stream(key: str, count: str) -> str:
    blocks = f"list_transform(range(0, (greatest({count}, 1) - 1) // 32 + 1), lambda b: sha256({key} || '|' || b))"
    return f"array_to_string({blocks}, '')"


def _moved(p: str, b: str, classes, letters: bool) -> str:
    cases, base = [f"WHEN {p} = 0 THEN 0"], 1
    for alphabet in classes:
        size = len(alphabet)
        if alphabet == DIGITS:
            step = f"{b} % {size}"
        else:
            step = f"{b} % {size - 1} + 1" if letters else "0"
        cases.append(f"WHEN {p} < {base + size} THEN {base} + ({p} - {base} + {step}) % {size}")
        base += size
    return "CASE " + " ".join(cases) + " END"


def permute_ctes(source: str, column: str, salt: str, classes=ID_CLASSES, prefix: str = "p") -> tuple[str, str]:
    """CTEs that map distinct values of ``source.column``: name of the last one holds ``v, fake``."""
    members = "".join(classes)
    masks = "".join(a[0] * len(a) for a in classes)

    def one(number: int, half: str, other: str, letters: bool) -> str:
        key = f"{text(salt)} || '|{number}|' || mask || '|' || array_to_string({other}, ',')"
        s = stream(key, f"len({half})")
        inner = _moved("x", byte("s", "i - 1"), classes, letters)
        return f"SELECT * EXCLUDE (s), list_transform({half}, lambda x, i: {inner}) AS m FROM (SELECT *, {s} AS s FROM __SRC__)"

    n = prefix
    ctes = f"""{n}0 AS (SELECT DISTINCT {column} AS v FROM {source} WHERE {column} IS NOT NULL),
{n}1 AS (SELECT v, string_split(v, '') AS chars, translate(v, {text(members)}, {text(masks)}) AS mask FROM {n}0),
{n}2 AS (SELECT *, list_transform(chars, lambda c: instr({text(members)}, c)) AS places FROM {n}1),
{n}3 AS (SELECT v, chars, mask, list_filter(places, lambda p, i: i % 2 = 1) AS e, list_filter(places, lambda p, i: i % 2 = 0) AS o FROM {n}2),
{n}4 AS (SELECT * EXCLUDE (e, m), m AS e FROM ({one(1, 'e', 'o', False).replace('__SRC__', f'{n}3')})),
{n}5 AS (SELECT * EXCLUDE (o, m), m AS o FROM ({one(2, 'o', 'e', True).replace('__SRC__', f'{n}4')})),
{n}6 AS (SELECT * EXCLUDE (e, m), m AS e FROM ({one(3, 'e', 'o', True).replace('__SRC__', f'{n}5')})),
{n} AS (SELECT v, CASE WHEN length(v) = 0 THEN v ELSE array_to_string(list_transform(chars, lambda c, i:
  CASE WHEN (CASE WHEN i % 2 = 1 THEN e[(i + 1) // 2] ELSE o[i // 2] END) > 0
       THEN substr({text(members)}, CASE WHEN i % 2 = 1 THEN e[(i + 1) // 2] ELSE o[i // 2] END, 1) ELSE c END), '') END AS fake FROM {n}6)"""
    return ctes, n


def title_runs(value: str) -> str:
    runs = f"regexp_extract_all({value}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')"


def case_like(original: str, fake: str) -> str:
    letters = f"regexp_replace({original}, '[^A-Za-z]', '', 'g')"
    return (
        f"CASE WHEN {letters} = '' THEN {fake} WHEN {letters} = upper({letters}) THEN upper({fake}) "
        f"WHEN {letters} = lower({letters}) THEN lower({fake}) "
        f"WHEN regexp_matches({letters}, '^[A-Z]') THEN {title_runs(fake)} ELSE {fake} END"
    )


# --- allocation -------------------------------------------------------------


def bucket(key: str, buckets: int) -> str:
    return f"(('0x' || substr(sha256({key}), 1, 13))::BIGINT % {buckets})"


def slots(source: str, by: str, key: str, buckets: int = 1024) -> str:
    """Rows of ``source`` with ``slot``, unique per ``by``."""
    joined = f"concat_ws('|', {by}, {key})"
    b = bucket(joined, buckets)
    rank = f"row_number() OVER (PARTITION BY {by}, {b} ORDER BY sha256(concat_ws('|', 'slot', {by}, {key})), {key}) - 1"
    return f"SELECT *, ({rank}) * {buckets} + {b} AS slot FROM {source}"


def syllable(number: str) -> str:
    return f"substr('{C.ONSETS}', ({number}) // 5 + 1, 1) || substr('{C.VOWELS}', ({number}) % 5 + 1, 1)"


def spelled_name(slot: str, endings) -> str:
    """Names of the first 51,200 slots."""
    inner = f"((({slot}) % 51200) * 26347 + 9173) % 51200"
    name = f"{syllable(f'({inner}) % 80')} || {syllable(f'(({inner}) // 80) % 80')}"
    ending = f"({array(endings)})[({inner}) // 6400 + 1]"
    word = f"({name} || {ending})"
    extra = f"({slot}) // 51200 - 1"
    longer = f"({name} || {syllable(f'({extra}) % 80')} || {ending})"
    spelled = f"CASE WHEN ({slot}) < 51200 THEN {word} ELSE {longer} END"
    return f"(upper(substr({spelled}, 1, 1)) || substr({spelled}, 2))"


def words_of(number: str, words, joiner: str, most: int = 3) -> str:
    """Spellings of up to ``most`` words."""
    a, rest = array(words), f"({number})"
    pieces = [f"({a})[{rest} % {len(words)} + 1]"]
    for _ in range(most - 1):
        rest = f"({rest} // {len(words)} - 1)"
        pieces.append(f"CASE WHEN {rest} >= 0 THEN {text(joiner)} || ({a})[{rest} % {len(words)} + 1] ELSE '' END")
    return "(" + " || ".join(pieces) + ")"


def pool_pick(source: str, pools: dict[str, tuple[str, ...]], tag: str, choices: int = 4) -> str:
    """``nk, pool, word`` of the values that won a word; ``source`` has ``nk, pool``."""
    words = " ".join(f"WHEN {text(k)} THEN {array(v)}" for k, v in sorted(pools.items()))
    draw = seed(text(tag), "choice::VARCHAR", "pool", "nk")
    return f"""SELECT r.nk AS nk, r.pool AS pool, arg_min(r.word, r.choice) AS word FROM (
  SELECT arg_min({{'nk': nk, 'pool': pool, 'word': word, 'choice': choice}},
         lpad(choice::VARCHAR, 3, '0') || sha256(concat_ws('|', {text(tag)}, pool, nk))) AS r FROM (
    SELECT nk, pool, choice, words[({draw} % len(words))::INT + 1] AS word FROM (
      SELECT nk, pool, CASE pool {words} END AS words, unnest(range(0, {choices})) AS choice FROM {source}))
  WHERE lower(word) <> nk GROUP BY lower(word)) GROUP BY r.nk, r.pool"""


def disambiguate(source: str, tail: str) -> str:
    """``key, fake`` from ``key, fake``; ``tail`` is an expression over ``fake`` and ``slot``."""
    owner = f"arg_min(key, sha256(concat_ws('|', 'claim', key))) OVER (PARTITION BY lower(fake))"
    owned = f"(SELECT key, fake, lower(fake) AS cf, {owner} AS owner FROM {source})"
    lost = f"(SELECT key, fake, cf FROM {owned} WHERE owner <> key)"
    return f"""SELECT key, fake FROM {owned} WHERE owner = key
UNION ALL SELECT key, {tail} AS fake FROM ({slots(lost, 'cf', 'key')})"""


WORD_TAIL = f"fake || ' {C.OVERFLOW_WORD} ' || " + words_of("slot", C.ORG_HEADS, " ")
EMAIL_TAIL = (
    f"regexp_extract(fake, '^([^@]*)@', 1) || '.{C.OVERFLOW_WORD.lower()}.' || "
    + words_of("slot", [h.lower() for h in C.ORG_HEADS], ".")
    + " || '@' || regexp_extract(fake, '@(.*)$', 1)"
)

EMAIL_PATTERN = "[A-Za-z0-9](?:[A-Za-z0-9._%+\\-]*[A-Za-z0-9])?@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"


def domain(value: str) -> str:
    """Fake e-mail domain, without forced words."""
    heads = [h.lower() for h in C.ORG_HEADS]
    low = f"lower(trim({value}))"
    labels = f"string_split({low}, '.')"
    suffix = (
        f"CASE WHEN array_to_string({labels}[-2:], '.') IN ({', '.join(text(t) for t in C.TWO_LEVEL_SUFFIXES)}) "
        f"THEN array_to_string({labels}[-2:], '.') ELSE {labels}[-1] END"
    )
    draw = seed(text(SALT), "'domain'", low)
    brand = f"{pick(draw, heads)} || {pick(f'{draw} // {len(heads)}', heads)}"
    public = ", ".join(text(p) for p in C.PUBLIC_EMAIL_DOMAINS)
    return (
        f"CASE WHEN coalesce({low}, '') = '' THEN 'example.com' WHEN NOT contains({low}, '.') THEN {value} "
        f"WHEN {low} IN ({public}) THEN {value} ELSE {brand} || '.' || {suffix} END"
    )


PLAIN = PLAIN_CLASSES
