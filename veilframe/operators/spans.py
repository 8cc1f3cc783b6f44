"""Text windows and span arithmetic.

A span is ``struct<start,end,type,..>`` with 0-based code point offsets, the end
exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import config as C

SPAN = "struct<start:int,end:int,type:string>"


def windows(text: Column, size: int = C.WINDOW_SIZE, overlap: int = C.WINDOW_OVERLAP) -> Column:
    """Overlapping windows over the whole text: ``array<struct<offset,piece>>``.

    Anything not longer than the overlap lies wholly inside some window.
    """
    step = max(1, size - overlap)
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int")
    return F.when(
        F.length(text) > 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct((i * step).alias("offset"), F.substr(text, i * step + 1, F.lit(size)).alias("piece")),
        ),
    ).otherwise(F.array().cast("array<struct<offset:int,piece:string>>"))


def explode_windows(df: DataFrame, keys: list[str], text: str, size: int = C.WINDOW_SIZE, overlap: int = C.WINDOW_OVERLAP) -> DataFrame:
    rows = df.select(*keys, F.explode(windows(F.col(text), size, overlap)).alias("w"))
    return rows.select(*keys, "w.offset", "w.piece")


def absolute(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Window spans as text spans, exact duplicates from overlaps removed."""
    moved = spans.withColumn("start", F.col("offset") + F.col("start")).withColumn("end", F.col("offset") + F.col("end"))
    return moved.drop("offset").dropDuplicates([*keys, "start", "end", "type"])


def _by_start(a: Column, b: Column) -> Column:
    """Earlier start first, then the longer span, then the type name."""
    return (
        F.when(a["start"] != b["start"], a["start"] - b["start"])
        .when(a["end"] != b["end"], b["end"] - a["end"])
        .when(a["type"] < b["type"], -1)
        .when(a["type"] > b["type"], 1)
        .otherwise(0)
    )


def leftmost_longest(spans: Column) -> Column:
    """Non-overlapping selection: by start, longer first, skip what overlaps the last kept one."""
    ordered = F.array_sort(spans, _by_start)
    kept = F.aggregate(
        ordered,
        F.struct(F.lit(-1).alias("last"), F.filter(ordered, lambda s: F.lit(False)).alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["last"],
            F.struct(s["end"].alias("last"), F.concat(acc["out"], F.array(s)).alias("out")),
        ).otherwise(acc),
    )
    return kept["out"]


def priority_merge(groups: list[Column], text: Column | None = None) -> Column:
    """Merge span arrays, earlier groups first, longer spans first inside a group.

    A span of a later group that overlaps a kept one partly is trimmed to what
    remains of it; pieces shorter than two characters after stripping blanks,
    commas and dots are dropped. Without the text the span is dropped whole.
    """

    def ranked(group: Column, rank: int) -> Column:
        return F.transform(
            group,
            lambda s: F.struct(
                F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["type"].alias("type")
            ),
        )

    tagged = F.concat(*[ranked(g, rank) for rank, g in enumerate(groups)])
    ordered = F.array_sort(
        tagged,
        lambda a, b: F.when(a["rank"] != b["rank"], a["rank"] - b["rank"])
        .when((a["end"] - a["start"]) != (b["end"] - b["start"]), (b["end"] - b["start"]) - (a["end"] - a["start"]))
        .otherwise(_by_start(a, b)),
    )
    plain = F.transform(
        ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["type"].alias("type"))
    )
    empty = F.filter(plain, lambda s: F.lit(False))

    def strip(piece: Column) -> Column:
        """Move the edges of a piece inwards past blanks, commas and dots."""
        raw = F.substr(text, piece["start"] + 1, piece["end"] - piece["start"])
        left = F.length(raw) - F.length(F.regexp_replace(raw, "^[ ,.\\t]+", ""))
        right = F.length(raw) - F.length(F.regexp_replace(raw, "[ ,.\\t]+$", ""))
        return F.struct(
            (piece["start"] + left).cast("int").alias("start"),
            (piece["end"] - right).cast("int").alias("end"),
            piece["type"].alias("type"),
        )

    def cut(pieces: Column, taken: Column) -> Column:
        """Every piece without the taken interval."""
        return F.flatten(
            F.transform(
                pieces,
                lambda p: F.when((taken["start"] >= p["end"]) | (taken["end"] <= p["start"]), F.array(p)).otherwise(
                    F.filter(
                        F.array(
                            F.struct(p["start"].alias("start"), taken["start"].alias("end"), p["type"].alias("type")),
                            F.struct(taken["end"].alias("start"), p["end"].alias("end"), p["type"].alias("type")),
                        ),
                        lambda q: q["end"] > q["start"],
                    )
                ),
            )
        )

    def place(kept: Column, span: Column) -> Column:
        clashing = F.filter(kept, lambda k: (span["start"] < k["end"]) & (k["start"] < span["end"]))
        free = F.concat(kept, F.array(span))
        if text is None:
            return F.when(F.size(clashing) == 0, free).otherwise(kept)
        pieces = F.aggregate(clashing, F.array(span), cut)
        trimmed = F.filter(F.transform(pieces, strip), lambda p: p["end"] - p["start"] >= 2)
        return F.when(F.size(clashing) == 0, free).otherwise(F.concat(kept, trimmed))

    return F.array_sort(F.aggregate(plain, empty, place), _by_start)


def splice_spans(text: Column, spans: Column) -> Column:
    """Replace non-overlapping sorted spans ``struct<start,end,fake>`` by their fakes."""
    count = F.size(spans)

    def before(i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(F.element_at(spans, F.greatest(i, F.lit(1)))["end"])
        end = F.when(i == count, F.length(text)).otherwise(F.element_at(spans, F.least(i + 1, count))["start"])
        return F.substr(text, begin + 1, end - begin)

    pieces = F.transform(
        F.sequence(F.lit(0), count),
        lambda i: F.concat(before(i), F.when(i == count, "").otherwise(F.element_at(spans, F.least(i + 1, count))["fake"])),
    )
    return F.when(count <= 0, text).otherwise(F.array_join(pieces, ""))
