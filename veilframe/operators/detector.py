"""Pluggable span detection.

A detector is a plain object with ``entities_batch``. Spark cuts texts into
windows, spreads the windows over the cluster and calls the detector once per
Arrow batch; the model is made once per Python worker. The built-in detector
uses rules only and claims no particular recall.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C
from veilframe.functions import text as X
from veilframe.operators.spans import absolute, explode_windows


class Found(NamedTuple):
    start: int
    end: int
    type: str
    score: float = 1.0


class Detector(Protocol):
    def entities_batch(self, texts: list[str]) -> list[list[Found]]:
        """Spans of every text, offsets relative to that text."""


class RuleDetector:
    """Addresses, phone numbers, titled names and names with a legal suffix."""

    rules = (
        ("email", re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+\-]*@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"), 0),
        ("phone", re.compile(r"(?<![\w+])\+?\(?\d[\d()\-. ]{6,}\d(?!\w)"), 0),
        ("person", re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.?\s+((?:[A-Z][a-z'\-]+\s+){0,2}[A-Z][a-z'\-]+)"), 1),
        ("org", re.compile(r"\b(?:[A-Z][\w&\-]+\s+){1,4}(?:Inc|Ltd|LLC|GmbH|Corp|PLC|Pvt)\b"), 0),
    )

    def entities_batch(self, texts: list[str]) -> list[list[Found]]:
        return [
            [Found(*m.span(group), kind) for kind, rule, group in self.rules for m in rule.finditer(text)] for text in texts
        ]


class StreetRuleDetector:
    """Street addresses: a house number, words, and a street suffix."""

    def __init__(self) -> None:
        suffixes = "|".join(sorted(C.STREET_SUFFIXES, key=len, reverse=True))
        self.rule = re.compile(rf"\b\d+(?:st|nd|rd|th)?\s+(?:(?:N|S|E|W|NE|NW|SE|SW)\s+)?(?:[\w'\-]+\s+){{1,4}}?(?:{suffixes})\b\.?", re.I)

    def entities_batch(self, texts: list[str]) -> list[list[Found]]:
        return [[Found(*m.span(), "street_address") for m in self.rule.finditer(t)] for t in texts]


SPAN_COLUMNS = "start int, end int, type string, score double, span string"


def detect(
    texts: DataFrame,
    keys: list[str],
    text: str,
    make_detector: Callable[[], Detector] = RuleDetector,
    floors: dict[str, float] | None = None,
    call_floor: float = C.MODEL_CALL_FLOOR,
    spread: int | None = None,
) -> DataFrame:
    """``keys, start, end, type, score, span`` over the whole of every text.

    ``floors`` is the least score per type. ``spread`` shuffles the windows into
    that many partitions first, which splits very long texts over tasks.
    """
    floors = C.MODEL_FLOORS if floors is None else floors
    cut = explode_windows(texts.where(F.length(text) >= 3), keys, text)
    if spread:
        cut = cut.repartition(spread, *keys, "offset")
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.select(*keys).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = make_detector()
        for batch in batches:
            found = detector.entities_batch(batch["piece"].tolist())
            rows = [
                (*ids, offset, s.start, s.end, s.type, float(s.score), piece[s.start : s.end])
                for ids, offset, piece, spans in zip(
                    batch[keys].itertuples(index=False, name=None), batch["offset"], batch["piece"], found
                )
                for s in spans
            ]
            yield pd.DataFrame(rows, columns=[*keys, "offset", "start", "end", "type", "score", "span"])

    raw = cut.mapInPandas(run, f"{key_schema}, offset int, {SPAN_COLUMNS}")
    least = F.coalesce(F.try_element_at(_floor_map(floors), F.col("type")), F.lit(0.5))
    strong = raw.where((F.col("score") >= call_floor) & (F.col("score") >= least))
    return absolute(strong, keys)


def _floor_map(floors: dict[str, float]) -> Column:
    return F.from_json(F.lit("{" + ",".join(f'"{k}":{v}' for k, v in floors.items()) + "}"), "map<string,double>")


def keep_span(
    span: Column,
    ptype: Column,
    generic: list[str],
    brands: list[str] | None = None,
    protect: Column | None = None,
    before: Column | None = None,
    after: Column | None = None,
    min_length: int = 1,
) -> Column:
    """Whether a detected span is worth a fake.

    ``before``/``after`` are the neighbouring characters where offsets into the
    text are known. ``brands`` is given for resume tables only.
    """
    named = ptype.isin("person", "org")
    drop = F.contains(span, F.lit("@")) | (F.length(span) < min_length)
    if protect is not None:
        drop = drop | F.array_contains(protect, F.lower(span))
    if before is not None and after is not None:
        drop = drop | (before == "@") | (after == "@")
        ascii_word = before.rlike("^[A-Za-z]$") & span.rlike("^[A-Za-z]")
        other_word = before.rlike("^(?![A-Za-z])\\p{L}$") & span.rlike("^(?![A-Za-z])\\p{L}")
        drop = drop | ascii_word | other_word
    drop = drop | (named & X.has_generic_word(span, generic))
    if brands:
        drop = drop | (named & X.has_known_brand(span, brands))
    drop = drop | ((ptype == "person") & X.is_pronoun(span))
    drop = drop | ((ptype == "email") & ~F.contains(span, F.lit("@")))
    drop = drop | ((ptype == "phone") & ~span.rlike("[0-9]"))
    return ~F.coalesce(drop, F.lit(False))


def detector_sample(df: DataFrame, columns: list[str], make_detector: Callable[[], Detector] = RuleDetector, count: int = 20) -> DataFrame:
    """``column, hits, sampled, majority`` of a detector run on a few values per column."""
    from veilframe.plans.profile import detector_majority, sample_values

    values = sample_values(df, columns, count, 1 << 30)
    spans = detect(values, ["column", "rank"], "value", make_detector)
    hits = spans.groupBy("column").agg(F.count_distinct("rank").alias("hits"))
    sampled = values.groupBy("column").agg(F.count("*").alias("sampled"))
    return sampled.join(hits, "column", "left").join(detector_majority(spans), "column", "left").select(
        "column", F.coalesce("hits", F.lit(0)).alias("hits"), "sampled", "majority"
    )
