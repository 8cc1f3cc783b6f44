"""Column expressions shared by the jobs: normal forms, shapes, case, HTML, JSON.

All of it is native expressions, so it stays in the JVM and next to the scan.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.functions.seeds import let, literal_array

HAN = "[\\u4e00-\\u9fff]"
GUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
ID_SHAPE = f"^(?:[A-Za-z0-9_.\\-]+:)?(?:{GUID}|[0-9a-fA-F]{{20,40}}|[A-Za-z]{{1,3}}[0-9]{{4,}})$"
URL_SHAPE = "^[A-Za-z][A-Za-z0-9+.\\-]*://\\S+$"
EMAIL_SHAPE = "^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$"
PHONE_SHAPE = "^[+()0-9][0-9\\s\\-()]{5,}$"
FILE_SHAPE = f"(?i)^(.+)(\\.(?:{C.FILE_EXTENSIONS}))$"
ATTACHMENT_SHAPE = f"(?i)\\.({C.ATTACHMENT_EXTENSIONS})$"
LAST_FIRST = "^\\s*([A-Za-z\\-'\\s]+?)\\s*,\\s*([A-Za-z\\-'\\s]+?)\\s*$"
LAST_FIRST_TOKENS = "^\\s*([A-Za-z\\-']+)\\s*,\\s*([A-Za-z\\-']+)\\s*$"
TITLE = "(?i)^((?:mr|mrs|ms|miss|mx|dr|prof|sir|madam)\\.?)\\s+(.+)$"
BILINGUAL = (
    "^\\s*([A-Za-z][A-Za-z.\\-' ]*?)\\s*([（(])\\s*([\\u4e00-\\u9fff·\\s]+?)\\s*([）)])"
    "\\s*([A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,})?\\s*$"
)
HTML_TAG = "<[^>]+>"

# White space of any script, as one class.
SPACES = "[\\s\\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


@lru_cache(maxsize=2)
def _folding(caseless: bool) -> tuple[str, str, dict[str, str]]:
    """Characters and what is left of them by compatibility decomposition without combining marks.

    The first two strings pair single characters, marks to be dropped stand behind
    the last pair; the table holds those that become several. Hangul syllables
    stay whole: taken apart, they would only be told apart in the same way.
    ``caseless`` folds the case as well.
    """
    source, target, dropped, many = [], [], [], {}
    for code in range(0x80, 0x30000):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        plain = plain.casefold() if caseless else plain
        if plain == char:
            continue
        if len(plain) > 1:
            many[char] = plain
        elif plain:
            source.append(char)
            target.append(plain)
        else:
            dropped.append(char)
    return "".join(source + dropped), "".join(target), many


def _class(chars: Sequence[str], gap: int = 48) -> str:
    """Character class of few wide ranges that holds these characters, and some between them; plans hold it several times."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code <= ranges[-1][1] + gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in ranges) + "]"


NOT_ASCII = "[^\\x00-\\x7F]"


def _folded(value: Column, caseless: bool) -> Column:
    """Each character beyond ASCII replaced by what is left of it, which holds no character that is replaced.

    The tables are searched once for each different character of a value, not at each place.
    """
    source, target, many = _folding(caseless)
    some, known = _class(many), literal_map(many)

    def plain(c: Column) -> Column:
        return F.translate(F.when(c.rlike(some), F.coalesce(F.try_element_at(known, c), c)).otherwise(c), source, target)

    def put(text: Column, c: Column) -> Column:
        return let(plain(c), lambda p: F.when(p == c, text).otherwise(F.replace(text, c, p)))

    return let(value, lambda v: F.aggregate(F.array_distinct(F.regexp_extract_all(v, F.lit(NOT_ASCII), F.lit(0))), v, put))


def strip_diacritics(value: Column) -> Column:
    """Compatibility forms and accents dropped, in every script; text that is ASCII already skips the tables."""
    return F.when(value.rlike(NOT_ASCII), _folded(value, False)).otherwise(value)


def normalize(value: Column) -> Column:
    """Reuse key of a value: accents, forms, case and white space do not matter."""
    plain = F.when(value.rlike(NOT_ASCII), _folded(value, True)).otherwise(value)
    return F.lower(F.trim(F.regexp_replace(plain, SPACES, " ")))


def is_han(value: Column) -> Column:
    return value.rlike(HAN)


def looks_like_id(value: Column) -> Column:
    return F.trim(value).rlike(ID_SHAPE)


def looks_like_url(value: Column) -> Column:
    return F.trim(value).rlike(URL_SHAPE)


def looks_like_email(value: Column) -> Column:
    return F.trim(value).rlike(EMAIL_SHAPE)


def looks_like_phone(value: Column) -> Column:
    return F.trim(value).rlike(PHONE_SHAPE)


def looks_like_filename(value: Column) -> Column:
    return value.rlike(FILE_SHAPE)


def file_parts(value: Column) -> Column:
    """``struct(stem, ext)``; ``ext`` is empty when the value is no file name."""
    named = looks_like_filename(value)
    return F.struct(
        F.when(named, F.regexp_extract(value, FILE_SHAPE, 1)).otherwise(value).alias("stem"),
        F.when(named, F.regexp_extract(value, FILE_SHAPE, 2)).otherwise(F.lit("")).alias("ext"),
    )


def first_last(value: Column) -> Column:
    """``Last, First`` becomes ``First Last``; anything else is kept."""
    swapped = F.concat_ws(
        " ",
        F.trim(F.regexp_extract(value, LAST_FIRST, 2)),
        F.trim(F.regexp_extract(value, LAST_FIRST, 1)),
    )
    return F.when(value.rlike(LAST_FIRST), swapped).otherwise(value)


def person_tokens(value: Column) -> Column:
    """``struct(first, last)`` of a name of two or more tokens, else null."""
    ordered = F.when(
        value.rlike(LAST_FIRST_TOKENS),
        F.concat_ws(" ", F.regexp_extract(value, LAST_FIRST_TOKENS, 2), F.regexp_extract(value, LAST_FIRST_TOKENS, 1)),
    ).otherwise(F.trim(value))
    return let(
        F.split(ordered, "\\s+"),
        lambda t: F.when(
            F.size(t) >= 2, F.struct(F.element_at(t, 1).alias("first"), F.element_at(t, -1).alias("last"))
        ),
    )


def split_bilingual(value: Column) -> Column:
    """``struct(latin, han, open, close, email)`` of ``Latin （汉字）[email]``, else null."""
    han = F.regexp_replace(F.regexp_extract(value, BILINGUAL, 3), "\\s+", "")
    parts = F.struct(
        F.trim(F.regexp_extract(value, BILINGUAL, 1)).alias("latin"),
        han.alias("han"),
        F.regexp_extract(value, BILINGUAL, 2).alias("open"),
        F.regexp_extract(value, BILINGUAL, 4).alias("close"),
        F.regexp_extract(value, BILINGUAL, 5).alias("email"),
    )
    return F.when(value.rlike(BILINGUAL) & is_han(han), parts)


def zip_name_tokens(original: Column, fake: Column) -> Column:
    """Positional ``array<struct<o,f>>`` pairs of two names, shorter side wins."""

    def pairs(left: Column, right: Column) -> Column:
        count = F.least(F.size(left), F.size(right))
        return F.zip_with(
            F.slice(left, F.lit(1), count),
            F.slice(right, F.lit(1), count),
            lambda o, f: F.struct(o.alias("o"), f.alias("f")),
        )

    def tokens(text: Column) -> Column:
        return F.filter(F.split(F.trim(text), "\\s+"), lambda t: t != "")

    both = F.struct(split_bilingual(original).alias("o"), split_bilingual(fake).alias("f"))
    return let(
        both,
        lambda b: F.when(
            b["o"].isNotNull() & b["f"].isNotNull(),
            F.concat(
                pairs(tokens(b["o"]["latin"]), tokens(b["f"]["latin"])),
                F.array(F.struct(b["o"]["han"].alias("o"), b["f"]["han"].alias("f"))),
            ),
        ).otherwise(pairs(tokens(original), tokens(fake))),
    )


def split_email_local(local: Column) -> Column:
    """``struct(given, surname, digits)`` of ``given.surname42``, else null."""
    shape = "^([^.]*)\\.([A-Za-z]+)([0-9]*)$"
    return F.when(
        local.rlike(shape),
        F.struct(
            F.regexp_extract(local, shape, 1).alias("given"),
            F.regexp_extract(local, shape, 2).alias("surname"),
            F.regexp_extract(local, shape, 3).alias("digits"),
        ),
    )


def word_key(token: Column) -> Column:
    kept = F.lower(F.regexp_replace(token, "[^\\p{L}\\p{N}_.]", ""))
    return F.regexp_replace(kept, "^\\.+|\\.+$", "")


def title_runs(value: Column) -> Column:
    """Capitalise every run of letters, hyphenated parts included."""
    pieces = F.split(value, "(?<=[^A-Za-z])(?=[A-Za-z])")
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2)))),
        ),
        "",
    )


def case_like(original: Column, fake: Column) -> Column:
    """Give ``fake`` the case pattern of ``original``: UPPER, lower or Title."""

    def shaped(p: Column) -> Column:
        letters, new = p["letters"], p["fake"]
        return (
            F.when(letters == "", new)
            .when(letters == F.upper(letters), F.upper(new))
            .when(letters == F.lower(letters), F.lower(new))
            .when(letters.rlike("^[A-Z]"), title_runs(new))
            .otherwise(new)
        )

    # Bound once: both sides may be long expressions.
    return let(F.struct(F.regexp_replace(original, "[^A-Za-z]", "").alias("letters"), fake.alias("fake")), shaped)


def fit_width(value: Column, width: Column | int | None) -> Column:
    """Clamp at the last space that fits, else cut hard."""
    if width is None:
        return value
    limit = width if isinstance(width, Column) else F.lit(width)
    head = F.substr(value, F.lit(1), limit)
    at_space = F.regexp_replace(F.regexp_extract(head, "(?s)^(.+) [^ ]*$", 1), "\\s+$", "")
    clamped = F.when(head.rlike("(?s)^.+ [^ ]*$"), at_space).otherwise(head)
    return F.when((limit > 0) & (F.length(value) > limit), clamped).otherwise(value)


ENTITY = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"


def _character(reference: Column) -> Column:
    """The character a numeric reference names, by the rules for HTML."""
    digits = F.regexp_extract(reference, "([0-9a-fA-F]+);?$", 1)
    base = F.when(reference.rlike("^&#[xX]"), 16).otherwise(10)
    # Windows characters take the place of control characters.
    moved = {0: "\ufffd", 13: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    moved_to = literal_map({str(n): c for n, c in moved.items()})

    def named(code: Column) -> Column:
        beyond = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        low = F.pmod(code, F.lit(0x10000))
        nothing = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.coalesce(
            F.try_element_at(moved_to, code.cast("string")), F.when(beyond, F.lit("\ufffd")).when(nothing, F.lit("")).otherwise(char)
        )

    def number(p: Column) -> Column:
        short = F.regexp_replace(p["digits"], "^0+(?=.)", "")
        both = F.when(p["base"] == 16, F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10))
        # Longer numbers are beyond every character, whatever they are.
        return F.when(F.length(short) > 8, F.lit(0x110000)).otherwise(both.cast("bigint")).cast("bigint")

    return let(let(F.struct(digits.alias("digits"), base.alias("base")), number), named)


def unescape(value: Column) -> Column:
    """Character references decoded: all names of HTML, also the old ones without a semicolon, and numbers."""
    names = literal_map(html5)
    oldest = max(len(n) for n in html5 if not n.endswith(";"))

    def one(reference: Column) -> Column:
        body = F.substr(reference, F.lit(2))
        found = [F.try_element_at(names, body)]
        for n in range(oldest, 1, -1):
            head = F.try_element_at(names, F.substr(body, F.lit(1), F.lit(n)))
            found.append(F.when(F.length(body) > n, F.concat(head, F.substr(body, F.lit(n + 1)))))
        return F.when(F.startswith(body, F.lit("#")), _character(reference)).otherwise(F.coalesce(*found, reference))

    return F.when(F.contains(value, F.lit("&")), splice(value, ENTITY, one)).otherwise(value)


def strip_html(value: Column) -> Column:
    """Visible text of a cell, for detection only; text without markup is kept as it is."""
    text = F.regexp_replace(value, "(?i)&nbsp;|&#160;", " ")
    text = F.regexp_replace(text, HTML_TAG, " ")
    text = unescape(text)
    text = F.trim(F.regexp_replace(text, SPACES, " "))
    return F.when(F.contains(value, F.lit("<")), text).otherwise(value)


def json_escape(value: Column) -> Column:
    """Content of a JSON string literal, without its quotes."""
    quoted = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substr(quoted, F.lit(3), F.length(quoted) - 4))


def is_json(value: Column) -> Column:
    return F.try_parse_json(value).isNotNull()


def json_keys(value: Column) -> Column:
    """Sorted distinct object keys anywhere in valid JSON text.

    Escapes are blanked first, so each quoted string is one plain regular
    expression match and only keys are followed by a colon.
    """
    blanked = F.replace(F.replace(value, F.lit("\\\\"), F.lit("\u0001")), F.lit('\\"'), F.lit("\u0002"))
    token = '"([^"]*+)"(\\s*+:)?+'
    names = F.regexp_extract_all(blanked, F.lit(token), F.lit(1))
    marks = F.regexp_extract_all(blanked, F.lit(token), F.lit(2))
    keyed = F.filter(F.arrays_zip(names.alias("n"), marks.alias("m")), lambda p: p["m"] != "")
    return F.array_sort(F.array_distinct(F.transform(keyed, lambda p: p["n"])))


def has_generic_word(span: Column, words: list[str]) -> Column:
    """Any letter run of the span is generic vocabulary."""
    runs = F.regexp_extract_all(F.lower(span), F.lit("[a-z]+"), F.lit(0))
    return F.arrays_overlap(runs, literal_array(words)) if words else F.lit(False)


def has_known_brand(span: Column, brands: list[str]) -> Column:
    if not brands:
        return F.lit(False)
    lowered = F.lower(span)
    return F.exists(literal_array(sorted(brands)), lambda b: F.contains(lowered, b))


def is_pronoun(span: Column) -> Column:
    return F.lower(F.trim(span)).isin(*C.PRONOUNS)


def is_harvest_stop(value: Column, labels: Sequence[str] = ()) -> Column:
    """A lone generic token, a numbered one, or one of the ``labels`` as a whole."""
    nk = normalize(value)
    bare = F.regexp_replace(nk, "[0-9]+$", "")
    lone = ~F.contains(F.trim(value), F.lit(" "))
    token = nk.isin(*C.HARVEST_STOP) | bare.isin(*C.HARVEST_STOP) | F.trim(value).isin(*C.HAN_HARVEST_STOP)
    whole = nk.isin(*[" ".join(label.lower().split()) for label in labels]) if labels else F.lit(False)
    return whole | (lone & token)


def quote_pattern(literal: Column) -> Column:
    """Escape a literal for use inside a regular expression."""
    return F.regexp_replace(literal, "([\\\\.\\[\\]{}()*+\\-?^$|#&~\\s])", "\\\\$1")


def splice(text: Column, pattern: Column | str, replacement) -> Column:
    """Replace each leftmost match of ``pattern`` by ``replacement(match)``.

    Works on the pieces between matches and the matches themselves, so inserted
    text is never scanned again and no offsets are needed.
    """
    regex = pattern if isinstance(pattern, Column) else F.lit(pattern)
    hits = F.transform(F.regexp_extract_all(text, regex, F.lit(0)), replacement)
    pieces = F.zip_with(
        F.split(text, regex, -1), hits, lambda gap, hit: F.concat(gap, F.coalesce(hit, F.lit("")))
    )
    return F.when(F.regexp_like(text, regex), F.array_join(pieces, "")).otherwise(text)


def literal_map(pairs: dict[str, str]) -> Column:
    """A small, bounded dictionary as one folded map literal."""
    return F.from_json(F.lit(json.dumps(pairs, ensure_ascii=False)), "map<string,string>")


def alternation(words) -> str:
    """Longest-first alternation of escaped words."""
    special = set("\\.[]{}()*+-?^$|#&~")
    escaped = ["".join("\\" + c if c in special or c.isspace() else c for c in w) for w in words]
    return "|".join(sorted(escaped, key=lambda w: (-len(w), w)))


def apply_forced(text: Column, forced: dict[str, str], boundary: bool = True) -> Column:
    """Rewrite configured words everywhere, keeping the case of each occurrence."""
    if not forced:
        return text
    lowered = {k.lower(): v for k, v in forced.items()}
    words = alternation(lowered)
    pattern = f"(?i)(?<![A-Za-z])(?:{words})(?![A-Za-z])" if boundary else f"(?i)(?:{words})"
    table = literal_map(lowered)
    return splice(text, pattern, lambda m: case_like(m, F.element_at(table, F.lower(m))))
