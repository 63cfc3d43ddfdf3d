"""Quality rules by cross-document line frequency, in DataFrame functions alone.

Lines are normalised (lower case, runs of white space as one space, trimmed) and hashed. For every
host the documents that hold a line are counted; equal texts on one host are one document, so a
group of copies is no boilerplate of itself. Lines that reach the limit, one number for hosts of any
size, are removed, and a document of
which too little remains is rejected, as is one that fails the base rules.

Defined results: a null text has no words and fails the base rules; lines without a word are
neither counted nor removed; a null host is a host of its own; repeated rows get equal verdicts;
a table without rows gives none. Input columns may have any name but those that ``line_quality``
adds, which replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurio.session import materialize

BLANK = "[\\x20\\x09-\\x0D]+"
MIN_DOCUMENTS = 10      # a line in so many documents of a host is removed, however large the host is
MIN_LEFT = 0.3          # share of the words that must remain
MIN_WORDS = 50          # base rule
MAX_REPEATED = 50       # base rule: per cent of words in repeated windows
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more."""
    def covered(ranked: Column) -> Column:
        again = F.filter(F.transform(ranked, lambda x, i: F.when(
            (F.get(ranked, i - 1)["h"] == x["h"]) | (F.get(ranked, i + 1)["h"] == x["h"]), x["i"])),
            lambda p: p.isNotNull())
        return _let(F.sort_array(again), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.coalesce(
                F.least(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))),
            F.lit(0), lambda a, b: a + b))

    def of_windows(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(
            _let(F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
                 covered))

    grams = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(
        w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 3, 0).otherwise(_let(grams, of_windows))


def base_stats(text: Column) -> Column:
    """Struct of the base counts of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return _let(words_of(text), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\v\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(words).cast("long").alias("n_repeat_words")))


def line_hash(line: Column) -> Column:
    """Hash of a normalised line; null for a line without a word."""
    bare = F.trim(F.regexp_replace(F.lower(line), BLANK, " "))
    return F.when(bare != "", F.xxhash64(bare))


def _lines(text: Column) -> Column:
    """Hash and number of words of each line that has a word."""
    def of(line: Column) -> Column:
        bare = F.trim(F.regexp_replace(F.lower(line), BLANK, " "))
        return F.struct(F.when(bare != "", F.xxhash64(bare)).alias("h"),
                        (F.length(bare) - F.length(F.translate(bare, " ", "")) + 1).alias("n"))

    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), of),
                    lambda x: x["h"].isNotNull())


def frequent_lines(measured: DataFrame, min_documents: int) -> DataFrame:
    """(host, h) of the lines that reach the limit, with their number of documents."""
    each = measured.select("host", "digest", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    # two steps: the rows of a line that a whole host shares are spread by text before they meet
    counts = each.distinct().groupBy("host", "h").count()
    return counts.where(F.col("count") >= min_documents).withColumnRenamed("count", "documents")


def line_quality(df: DataFrame, *, key: str = "doc_id", text: str = "text", host: str = "source",
                 min_documents: int = MIN_DOCUMENTS, min_left: float = MIN_LEFT, min_words: int = MIN_WORDS,
                 max_repeated: int = MAX_REPEATED) -> DataFrame:
    """Per row of ``df``: key, digest of the text, host, base counts, ``removed`` (hashes of the
    lines to remove), ``words_left`` and ``kept``."""
    stats = base_stats(F.col(text))
    measured = df.select(
        F.col(key).alias("key"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
        F.col(host).alias("host"), stats.alias("s"), _lines(F.col(text)).alias("lines"))
    measured = materialize(measured, "lines")
    frequent = frequent_lines(measured, min_documents).select(
        F.col("host").alias("fhost"), F.col("h").alias("fh"))
    each = measured.select("key", "digest", "host",
                           F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    hits = (each.join(frequent, F.col("host").eqNullSafe(F.col("fhost"))
                      & (F.col("h") == F.col("fh")))
            .groupBy("key", "digest", "host").agg(F.collect_set("h").alias("removed"))
            .select(F.col("key").alias("k2"), F.col("digest").alias("d2"),
                    F.col("host").alias("h2"), "removed"))
    out = measured.join(hits, F.col("key").eqNullSafe(F.col("k2")) & (F.col("digest") == F.col("d2"))
                        & F.col("host").eqNullSafe(F.col("h2")), "left")
    removed = F.coalesce(F.col("removed"), F.array().cast("array<bigint>"))
    gone = F.aggregate(F.filter("lines", lambda x: F.array_contains(removed, x["h"])),
                       F.lit(0).cast("long"), lambda a, x: a + x["n"])
    failed = (F.col("s.n_words") < min_words) | (
        100 * F.col("s.n_repeat_words") > max_repeated * F.col("s.n_words"))
    return out.select(
        F.col("key").alias(key), "digest", F.col("host").alias(host), *[f"s.{c}" for c in STATS[:-1]],
        failed.alias("base_failed"), removed.alias("removed"),
        (F.col("s.n_words") - F.when(F.size(removed) > 0, gone).otherwise(0)).alias("words_left"),
    ).withColumn("kept", ~F.col("base_failed")
                 & (F.col("words_left") >= min_left * F.col("n_words")))


def apply_quality(df: DataFrame, *, key: str = "doc_id", text: str = "text", host: str = "source",
                  length: str | None = "n_chars", **limits) -> DataFrame:
    """The rows that pass, without their frequent lines; columns as in ``df``.

    ``length`` names a column of the text's length that follows the text.
    """
    verdict = line_quality(df, key=key, text=text, host=host, **limits)
    verdict = (verdict.where("kept").select(F.col(key).alias("_k"), F.col("digest").alias("_d"),
                                            F.col(host).alias("_h"), F.col("removed").alias("_r"))
               .dropDuplicates(["_k", "_d", "_h"]))
    at = {n: f"c{i}" for i, n in enumerate(df.columns)}
    rows, t = df.toDF(*at.values()), at[text]
    joined = rows.withColumn("_digest", F.md5(F.coalesce(F.col(t), F.lit("")))).join(
        verdict, F.col(at[key]).eqNullSafe(F.col("_k")) & (F.col("_digest") == F.col("_d"))
        & F.col(at[host]).eqNullSafe(F.col("_h")))
    clean = F.when(F.size("_r") > 0, F.array_join(F.filter(
        F.split(F.col(t), "\n"), lambda x: ~F.coalesce(
            F.array_contains(F.col("_r"), line_hash(x)), F.lit(False))), "\n")).otherwise(F.col(t))
    out = joined.withColumn(t, clean)
    if length in at:
        out = out.withColumn(at[length], F.length(t).cast(df.schema[length].dataType))
    return out.select(*[F.col(c).alias(n) for n, c in at.items()])
