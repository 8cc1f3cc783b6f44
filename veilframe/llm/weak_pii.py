"""Personal data by weak supervision.

Four kinds are found: email, ip, card and phone. Exact patterns give the base
spans, which always stay. Looser candidates (an address written out with "at"
and "dot", a phone number without "+", a masked ip, a card of other length) are
judged by labelers that vote yes, no or nothing: patterns, gazetteers of
endings and area codes, and the words around. Expectation-maximisation over the
counts of all vote patterns of the corpus estimates how reliable each labeler
is; its soft labels train a logistic classifier of spans, which decides.

One pass reads the texts and leaves a small table of spans and votes. Vote and
feature patterns are aggregated by Spark; there are at most some thousands of
them, however many documents.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm import textbytes as tb
from veilframe.session import materialize

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
ROUNDS = 30

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

# Candidates beyond the base patterns.
_WRITTEN_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*+ ?(?:\[at\]|\(at\)|\{at\}| at ) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\{dot\}| dot |\.) ?[A-Za-z0-9-]++)+")
_MASKED_IP = re.compile(r"(?<![0-9.\[(])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z])")
_OTHER_CARD = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])")

# Gazetteers and cue words.
ENDINGS = frozenset("com org net edu gov io co info biz de fr es uk us eu ch at it nl example".split())
CUES = {
    "email": frozenset("mail email e-mail contact write reach correo courriel mailto address".split()),
    "ip": frozenset("ip host server address addr client from login proxy".split()),
    "card": frozenset("card visa mastercard amex credit debit tarjeta carte karte payment".split()),
    "phone": frozenset("phone tel call telephone mobile cell fax whatsapp contact telefon telefono".split()),
}
AGAINST = frozenset("order invoice version isbn page no number nr id ref item serial build chapter section".split())
LABELERS = ("shape", "strict", "gazetteer", "cue", "against")
_WORD = re.compile(r"[^\W_][\w-]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            last = found.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the exact patterns, by kind and place."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def more_candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Looser candidates that touch no base span."""
    found = []
    for kind, pattern, hint in (("email", _WRITTEN_EMAIL, "at"), ("ip", _MASKED_IP, "]"), ("ip", _MASKED_IP, ")"), ("card", _OTHER_CARD, None), ("phone", _LOCAL_PHONE, None)):
        if hint is None or hint in text and (kind != "email" or " at " in text or "at]" in text or "at)" in text or "at}" in text):
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    held, out = sorted((a, b) for _, a, b in taken), []
    for kind, a, b in sorted(set(found), key=lambda s: (s[1], -s[2])):
        if all(b <= x or y <= a for x, y in held):
            out.append((kind, a, b))
            held.append((a, b))
    return out


def votes(text: str, kind: str, a: int, b: int, base: bool) -> list[int]:
    """One vote (1 yes, -1 no, 0 none) per labeler."""
    span = text[a:b]
    digits = _NOT_DIGIT.sub("", span)
    before = [w.lower() for w in _WORD.findall(text[max(0, a - 40) : a])][-4:]
    if kind == "email":
        marked = any(x in span for x in ("[", "(", "{", "@"))
        shape = 1 if marked else -1
        gazetteer = 1 if re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in ENDINGS else -1
    elif kind == "phone":
        shape = 1 if "(" in span or span.startswith("+") else 0
        gazetteer = 1 if len(digits) >= 10 and digits[-10] not in "01" else -1
    elif kind == "ip":
        parts = [int(p) for p in re.findall(r"[0-9]{1,3}", span)][:4]
        shape = 1 if all(p <= 255 for p in parts) else -1
        gazetteer = -1 if parts[0] in (0, 1, 2) and sum(parts) < 40 else 1
    else:
        shape = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[:1] in "3456" else -1
    cue = 1 if CUES[kind] & set(before) else 0
    against = -1 if AGAINST & set(before) else 0
    return [shape, 1 if base else 0, gazetteer, cue, against]


def features(text: str, kind: str, a: int, b: int, cast: list[int]) -> list[int]:
    """Small integers that describe a span for the classifier."""
    span = text[a:b]
    digits = sum(c.isdigit() for c in span)
    lone = (a == 0 or text[a - 1].isspace()) and (b == len(text) or text[b].isspace() or text[b] in ".,;:!?")
    return [KINDS.index(kind), min(digits // 4, 4), int(any(c in "[]{}()" for c in span)), int(lone), cast[0] + 1, cast[2] + 1, cast[3], -cast[4]]


SIZES = (len(KINDS), 5, 2, 2, 3, 3, 2, 2)


def one_hot(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), 1 + sum(SIZES)))
    out[:, 0] = 1
    at = 1
    for i, size in enumerate(SIZES):
        out[np.arange(len(rows)), at + rows[:, i]] = 1
        at += size
    return out


def estimate(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Chance that a span of each vote pattern is personal data, by expectation-maximisation.

    Starts from the majority of the votes. Each labeler has a distribution of
    votes for either class, with a weak prior towards telling the truth.
    """
    truth = np.clip(0.5 + 0.4 * np.sign(patterns.sum(axis=1)), 0.1, 0.9)
    prior = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])  # votes -1, 0, 1 of the classes no and yes
    for _ in range(ROUNDS):
        weight = np.stack([counts * (1 - truth), counts * truth])
        log = np.log(weight.sum(axis=1) + 1.0)[:, None] - np.log(counts.sum() + 2.0)
        log = np.repeat(log, len(patterns), axis=1)
        for j in range(patterns.shape[1]):
            table = prior + np.stack([np.bincount(patterns[:, j] + 1, w, 3) for w in weight])
            table /= table.sum(axis=1, keepdims=True)
            log += np.log(table[:, patterns[:, j] + 1])
        truth = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return truth


def train(rows: np.ndarray, truth: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of a logistic classifier for soft labels; every feature pattern weighs by the root of its count."""
    x, weight = one_hot(rows), np.sqrt(counts.astype(float))
    weight /= weight.sum()
    out = np.zeros(x.shape[1])
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(x @ out, -50, 50)))
        out += 2.0 * (x.T @ (weight * (truth - chance)) - 1e-4 * out)
    return out


_FOUND = "id long, kinds array<int>, starts array<long>, ends array<long>, base array<boolean>, pattern array<string>"
_NAMES = ("id", "kinds", "starts", "ends", "base", "pattern")


def _find(batches):
    lists = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
    for batch in batches:
        for part in tb.slices(batch, "text", 8 << 20):
            rows: list[list] = [[] for _ in lists]
            for text in part.column("text").to_pylist():
                found = []
                if text:
                    base = base_spans(text)
                    both = [(s, True) for s in base] + [(s, False) for s in more_candidates(text, base)]
                    for (kind, a, b), sure in both:
                        cast = votes(text, kind, a, b, sure)
                        # Votes and features as one short text: the unit that is counted.
                        mark = ",".join(map(str, cast)) + ";" + ",".join(map(str, features(text, kind, a, b, cast)))
                        found.append((KINDS.index(kind), a, b, sure, mark))
                for i, into in enumerate(rows):
                    into.append([f[i] for f in found])
            columns = [pa.array(r, pa.list_(k)) for r, k in zip(rows, lists)]
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=list(_NAMES))


def _fit(found: DataFrame) -> dict[str, float]:
    """The classifier's answer for every pattern that occurs."""
    counted = found.select(F.explode("pattern").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    if not counted:
        return {}
    marks = [r.pattern.split(";") for r in counted]
    cast = np.array([list(map(int, m[0].split(","))) for m in marks])
    rows = np.array([list(map(int, m[1].split(","))) for m in marks])
    counts = np.array([r.n for r in counted], float)
    truth = estimate(cast, counts)
    chance = 1 / (1 + np.exp(-np.clip(one_hot(rows) @ train(rows, truth, counts), -50, 50)))
    return {r.pattern: float(c) for r, c in zip(counted, chance)}


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _decide(chance: dict[str, float], accept: float):
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for kinds, starts, ends, base, pattern in zip(*(batch.column(c).to_pylist() for c in _NAMES[1:])):
                spans = list(zip(kinds, starts, ends))
                sure = [s for s, yes in zip(spans, base) if yes]
                more = [s for s, yes, p in zip(spans, base, pattern) if not yes and chance.get(p, 0.0) >= accept]
                for i in range(4):
                    out[i].append(sum(s[0] == i for s in sure))
                out[4].append(hashlib.sha256(joined(sure).encode()).hexdigest())
                out[5].append(joined(sure + more))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=names)

    return run


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """doc_id, counts of base spans per kind, their digest, and all spans of every row.

    Null and empty texts have no spans. Repeated rows get the same answer each;
    a null id is kept; other columns are ignored. A corpus without any candidate
    trains nothing.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = materialize(texts.mapInArrow(_find, _FOUND), "spans")
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return found.mapInArrow(_decide(_fit(found), accept), schema)


def mask(text: str, spans: str) -> str:
    """The text with every span (as in ``personal_data``) replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(((k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)), key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])
