"""Quality rules from cross-document line frequency, in DataFrame functions only.

Lines are normalised (case, digits, punctuation and white space folded) and
hashed. Per host it is counted in how many different texts a line stands; lines
above the limit are boilerplate and are taken out, and a document of which too
little is left is rejected. Base rules on word counts and repeats come first.

Counting takes distinct (host, line, text) and then sums per (host, line), both
partially aggregated, so a host or a line with a third of all rows is spread.
The join back carries hashes and line numbers; texts are cut by those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE_LIMIT = 30  # different texts of a host a line may stand in
MOST_REMOVED = 50  # percent of a document's words
MIN_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
_GAP = r"[\x20\x09-\x0D]+"


def _base(rows: DataFrame) -> DataFrame:
    """Word and line counts of each text, as columns."""
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS))
    rows = rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP)))
    whole = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    rows = rows.withColumn("lines", lines).select(
        "doc_id", "source", "text", "text_hash", "words", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.translate(whole, BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    return _repeats(rows)


def _repeats(rows: DataFrame) -> DataFrame:
    """Words inside three-word windows that the text has twice or more.

    Window hashes are packed with their place (32 bits each) and sorted, which
    brings candidates together; those few are compared by the whole 64 bits.
    """
    window = "xxhash64(words[{0}], words[{0} + 1], words[{0} + 2])"
    packed = F.expr(
        f"transform(slice(words, 1, greatest(size(words) - 2, 0)), (w, i) -> shiftleft({window.format('i')}, 32) | cast(i as bigint))"
    )
    rows = rows.withColumn("packed", F.sort_array(packed))
    maybe = (
        "filter(packed, (x, i) -> (i > 0 and shiftright(x, 32) = shiftright(packed[greatest(i - 1, 0)], 32)) "
        "or (i + 1 < size(packed) and shiftright(x, 32) = shiftright(packed[least(i + 1, size(packed) - 1)], 32)))"
    )
    place = "cast(x & 4294967295 as int)"
    exact = f"sort_array(transform({maybe}, x -> named_struct('h', {window.format(place)}, 'at', {place})))"
    rows = rows.withColumn("twins", F.expr(exact)).drop("packed", "words")
    sure = (
        "filter(twins, (x, i) -> (i > 0 and x.h = twins[greatest(i - 1, 0)].h) "
        "or (i + 1 < size(twins) and x.h = twins[least(i + 1, size(twins) - 1)].h))"
    )
    rows = rows.withColumn("places", F.expr(f"sort_array(transform({sure}, x -> x.at))")).drop("twins")
    covered = "aggregate(places, named_struct('n', 0L, 'last', -3), (a, p) -> named_struct('n', a.n + least(3, p - a.last), 'last', p), a -> a.n)"
    return rows.withColumn("n_repeat_words", F.expr(covered)).drop("places")


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, number, line hash, words) of each line that has a letter or digit."""
    line = rows.select("doc_id", "source", "text_hash", F.posexplode(F.split("text", "\n")).alias("number", "line"))
    form = F.btrim(F.regexp_replace(F.lower("line"), r"[\s\p{Punct}\d]+", " "))
    words = F.size(F.split(F.btrim("line", F.lit(BLANKS)), _GAP)).cast("long")
    line = line.select("doc_id", "source", "text_hash", "number", form.alias("form"), words.alias("words")).where("form <> ''")
    return line.select("doc_id", "source", "text_hash", "number", F.xxhash64("form").alias("line"), "words")


def frequent_lines(docs: DataFrame, line_limit: int = LINE_LIMIT) -> DataFrame:
    """(source, line, texts) of lines in more than ``line_limit`` different texts of a host."""
    pairs = _lines(docs).select("source", "line", "text_hash").distinct()
    return pairs.groupBy("source", "line").agg(F.count("*").alias("texts")).where(F.col("texts") > line_limit)


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            line_limit: int = LINE_LIMIT, most_removed: int = MOST_REMOVED) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed, kept, clean_text per row.

    ``clean_text`` is the text without its frequent lines, the others in order.
    A null text has no words and fails the base rules. Equal texts of a host
    count once towards a line's frequency, so exact copies do not make their
    lines boilerplate. A null host is a host of its own. Repeated rows get the
    same answer each; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    often = frequent_lines(rows, line_limit).withColumnsRenamed({"source": "often_source", "line": "often_line"})
    held = _lines(rows)
    removed = held.join(often, held["source"].eqNullSafe(often["often_source"]) & (held["line"] == often["often_line"]))
    # Lines of one text are told apart by their number, so a repeated row adds nothing.
    removed = removed.groupBy("doc_id", "text_hash", "number").agg(F.first("words").alias("words"))
    removed = removed.groupBy("doc_id", "text_hash").agg(F.sum("words").alias("removed"), F.collect_list("number").alias("numbers"))
    return _verdict(_base(rows), removed, most_removed)


def _verdict(base: DataFrame, removed: DataFrame, most_removed: int) -> DataFrame:
    removed = removed.withColumnsRenamed({"doc_id": "r_id", "text_hash": "r_hash"})
    joined = base.join(removed, base["doc_id"].eqNullSafe(removed["r_id"]) & (base["text_hash"] == removed["r_hash"]), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    joined = joined.withColumn("base_failed", failed).withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
    stay = F.filter(F.split("text", "\n"), lambda line, number: ~F.array_contains("numbers", number))
    joined = joined.withColumn("clean_text", F.when(F.col("numbers").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n")))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed",
        (~F.col("base_failed") & (100 * F.col("removed_words") <= most_removed * F.col("n_words"))).alias("kept"),
        "clean_text",
    )
