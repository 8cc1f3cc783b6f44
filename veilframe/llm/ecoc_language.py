"""Language identification with error-correcting output codes.

Every language gets a codeword. One binary classifier per bit, over hashed byte
n-grams of whole texts, predicts that bit; a text's language is the codeword
with the least weighted loss against the predicted margins. A classifier weighs
by how well it does on the training sample. Where the two nearest codewords are
almost equally near, the text is flagged as ambiguous.

The models are fitted from counts that Spark adds up over a sample of at most
about ``sample_rows`` training texts per language, chosen by a hash of the id.
What reaches the driver is bounded by languages times buckets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm import textbytes as tb

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE_ROWS = 4000
SLICE = 1 << 19  # bytes of text whose n-grams are held at once
MOST_LANGUAGES = 256
SHARPNESS = 4.0
AMBIGUOUS_BELOW = 0.6
UNDETERMINED = "und"

# Letters of ASCII lowered, other ASCII to blank; bytes of other scripts stay.
_FOLD = tb.LOWER.copy()
_FOLD[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def held_out(key: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all n-grams; none crosses a text's end, blanks alone count for nothing."""
    folded = _FOLD[data].astype(np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    buckets, owners = [], []
    for n in ORDERS:
        count = len(folded) - n + 1
        if count <= 0:
            continue
        code, blank = np.full(count, n, np.uint32), np.ones(count, bool)
        for i in range(n):
            code = code * np.uint32(0x01000193) + folded[i : i + count]
            blank &= folded[i : i + count] == 32
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(13)
        use = ~blank & (text[:count] == text[n - 1 :])
        buckets.append((code[use] & np.uint32(BUCKETS - 1)).astype(np.int64))
        owners.append(text[:count][use])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def codewords(languages: int) -> np.ndarray:
    """Rows of +1 and -1: all splits of few languages, else seeded random splits that keep rows far apart."""
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= 5:
        splits = np.arange(1, 1 << (languages - 1))
        return np.where(splits[None, :] >> np.arange(languages)[:, None] & 1, 1, -1).astype(np.int8)
    bits, random = int(np.ceil(10 * np.log2(languages))), np.random.default_rng(7)
    best, distance = None, -1
    for _ in range(64):
        order = np.argsort(random.random((languages, bits)), axis=0)
        code = np.where(order < languages // 2, 1, -1).astype(np.int8)
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2 + bits * np.eye(languages, dtype=int)
        if apart.min() > distance:
            best, distance = code, int(apart.min())
    return best


@dataclass
class Model:
    """Languages, their codewords, and per bit: n-gram weights, margin scale and reliability."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    reliability: np.ndarray = field(default_factory=lambda: np.ones(0))

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean n-gram weight per text and bit."""
        texts = len(offsets) - 1
        bucket, owner = _grams(data, offsets)
        n = np.maximum(np.bincount(owner, minlength=texts), 1)
        out = np.empty((texts, self.weights.shape[1]), np.float64)
        for bit in range(out.shape[1]):
            out[:, bit] = np.bincount(owner, self.weights[bucket, bit], texts) / n
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest codeword, its share of the likelihood) of each row."""
        if not len(self.languages) or not len(margins):
            return np.zeros(len(margins), np.int64), np.zeros(len(margins))
        agree = (margins / self.scale)[:, None, :] * self.code[None, :, :] * SHARPNESS
        loss = (np.logaddexp(0, -agree) * self.reliability).sum(axis=2)
        likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return loss.argmin(axis=1), likely.max(axis=1) / likely.sum(axis=1)


def _learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return chosen.where("id is not null and text is not null and lang is not null").where(~held_out(F.col("id"))).where(F.col("text").rlike(r"\p{L}"))


def _count_grams(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in tb.slices(batch, "text", SLICE):
            data, offsets = tb.flat(part.column("text"))
            bucket, owner = _grams(data, offsets)
            share = 1.0 / np.maximum(np.bincount(owner, minlength=part.num_rows), 1)
            of = np.array(part.column("lang").to_pylist(), object)
            for lang in set(of):
                mine = (of == lang)[owner]
                sums[lang] = sums.get(lang, 0) + np.bincount(bucket[mine], share[owner[mine]], BUCKETS)
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], names=["lang", "bucket", "share"])


def _reliability(model: Model):
    place = {lang: i for i, lang in enumerate(model.languages)}

    def run(batches):
        bits = model.code.shape[1]
        for batch in batches:
            for part in tb.slices(batch, "text", SLICE):
                margins = model.margins(*tb.flat(part.column("text")))
                truth = model.code[[place[x] for x in part.column("lang").to_pylist()]]
                right = ((margins * truth) > 0).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(bits)), pa.array(np.full(bits, part.num_rows)), pa.array(right.astype(np.int64)), pa.array(np.abs(margins).sum(axis=0))],
                    names=["bit", "rows", "right", "size"],
                )

    return run


SHARES = 1 << 62  # fine enough that a share of any number of rows is not nothing


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the rows with an id, a letter in the text and a language that are not held out.

    Without such rows it knows no language and everything is undetermined; with
    one language it always predicts that one. More than ``MOST_LANGUAGES``
    languages are refused.
    """
    rows = _learnable(docs, id_col, text_col, lang_col)
    totals = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(r.lang for r in totals)
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((BUCKETS, 0)), np.ones(0))
    # Within a language the hash picks the same share everywhere; small languages are used whole.
    take = F.lit(False)
    for r in totals:
        share = min(1.0, sample_rows / r.n)
        take = take | ((F.col("lang") == r.lang) & (F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(SHARES)) < int(share * SHARES)))
    sample = rows.where(take).select("text", "lang")
    counted = sample.mapInArrow(_count_grams, "lang string, bucket long, share double").groupBy("lang", "bucket").agg(F.sum("share").alias("share")).toPandas()
    shares = np.zeros((len(languages), BUCKETS))
    place = {lang: i for i, lang in enumerate(languages)}
    shares[counted["lang"].map(place).to_numpy(np.int64), counted["bucket"].to_numpy(np.int64)] = counted["share"].to_numpy()
    shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1e-12)
    floor = 1e-6
    weights = np.empty((BUCKETS, code.shape[1]))
    for bit in range(code.shape[1]):
        yes, no = shares[code[:, bit] > 0].mean(axis=0), shares[code[:, bit] < 0].mean(axis=0)
        weights[:, bit] = np.log((yes + floor) / (no + floor))
    model = Model(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))
    seen = sample.mapInArrow(_reliability(model), "bit long, rows long, right long, size double").groupBy("bit").agg(
        F.sum("rows").alias("rows"), F.sum("right").alias("right"), F.sum("size").alias("size")
    ).collect()
    for r in seen:
        accuracy = (r.right + 1) / (r.rows + 2)
        model.scale[r.bit] = max(r["size"] / max(r.rows, 1), 1e-9)
        model.reliability[r.bit] = max(2 * accuracy - 1, 0.01)
    return model


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _predict(model: Model, text_col: str, least: float):
    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, text_col, SLICE):
                texts = part.column(text_col)
                best, score = model.decode(model.margins(*tb.flat(texts)))
                known = np.array([has_letter(t.as_py()) for t in texts], bool) & bool(model.languages)
                names = [model.languages[i] if k else UNDETERMINED for i, k in zip(best.tolist(), known.tolist())]
                score = np.where(known, np.clip(score, 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(score), pa.array(~known | (score < least))],
                    names=[*part.schema.names, "lang_pred", "score", "ambiguous"],
                )

    return run


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", ambiguous_below: float = AMBIGUOUS_BELOW) -> DataFrame:
    """All rows and columns of ``docs`` and lang_pred, score and ambiguous, from the text alone.

    A text that is null or has no letter is undetermined, with score 0, and
    ambiguous. Columns of ``docs`` with one of the three names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "ambiguous")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return docs.mapInArrow(_predict(model, text_col, ambiguous_below), T.StructType([*docs.schema.fields, *added]))
