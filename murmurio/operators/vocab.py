"""Vocabulary statistics over a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize
from .skew import first_per_key, sized

LISTED_BYTES = 4 << 20  # of a list of words that every Python task may hold
BROADCAST_BYTES = 64 << 20  # of one that every executor may hold


def doc_freq(docs: DataFrame, tokens: Column) -> DataFrame:
    """Number of documents that hold each token."""
    return docs.select(F.explode(F.array_distinct(tokens)).alias("palavra")).groupBy(
        "palavra").agg(F.count("*").alias("docs"))


def top_words(freq: DataFrame, n_docs: int, n: int = 20) -> DataFrame:
    """The words in most documents, with their share of the documents in percent."""
    share = F.round(F.try_divide(F.lit(100.0) * F.col("docs"), F.lit(n_docs)), 1)
    return freq.orderBy(F.desc("docs"), "palavra").limit(n).withColumn("pct", share)


def df_stopwords(freq: DataFrame, n_docs: int, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """Words in too few documents or, with max_df < 1, in too large a share of them."""
    rare = F.col("docs") < min_df
    common = F.lit(max_df < 1.0) & (F.col("docs") / F.lit(n_docs) > max_df)
    return freq.where(rare | common).select("palavra")


def expand_stopwords(base: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The words, their forms without accents, and every word of the vocabulary that has one of
    these forms. All frames hold one column ``palavra``."""
    base = materialize(base.select("palavra"), "palavras")  # used twice, and often counted from texts
    plain = base.select(X.remove_accents("palavra").alias("palavra")).distinct()
    matched = vocabulary.select("palavra", X.remove_accents("palavra").alias("_sem")).join(
        plain.withColumnRenamed("palavra", "_sem"), "_sem", "left_semi").select("palavra")
    return base.unionByName(plain).unionByName(matched).distinct()


def union_stopwords(*lists: DataFrame) -> DataFrame:
    out = lists[0].select("palavra")
    for other in lists[1:]:
        out = out.unionByName(other.select("palavra"))
    return out.distinct()


def extra_stopwords(extra: DataFrame, known: DataFrame) -> DataFrame:
    """Words of a list that another list lacks."""
    return extra.select("palavra").distinct().join(known.select("palavra"), "palavra", "left_anti")


def idf(freq: DataFrame, n_docs: int) -> DataFrame:
    """Smoothed inverse document frequency."""
    value = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("docs"))) + 1.0
    return freq.withColumn("idf", value)


def idf_threshold(scored: DataFrame, percent: float = 0.1) -> float | None:
    """Percentile of the idf over the vocabulary, linearly interpolated.

    The idf depends on the document frequency alone, so the vocabulary is reduced to a histogram
    of frequencies before the exact percentile is taken.
    """
    histogram = scored.groupBy("docs").agg(F.count("*").alias("_n"), F.first("idf").alias("idf"))
    return histogram.agg(F.percentile("idf", percent / 100.0, F.col("_n"))).first()[0]


def idf_words(text: str) -> Column:
    """Terms as the vectoriser sees them: lower case, two word characters or more."""
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({X.WORD}{{2,}})"))


def low_idf_words(docs: DataFrame, text: str, percent: float = 0.1) -> DataFrame:
    """The most common words: those whose idf is at or below the percentile."""
    n_docs = docs.count()
    # the vocabulary feeds the threshold and the selection
    scored = materialize(idf(doc_freq(docs, idf_words(text)), n_docs), "idf")
    threshold = idf_threshold(scored, percent)
    return scored.where(F.col("idf") <= F.lit(threshold)).select("palavra")


def filter_by_idf(docs: DataFrame, text: str, percent: float = 0.1) -> DataFrame:
    """Drop the most common words from every text (texts are split at single blanks)."""
    return drop_words(docs, text, low_idf_words(docs, text, percent))


def word_list(words: DataFrame, name: str = "palavra") -> tuple[DataFrame, int]:
    """The distinct words of a frame with a column ``palavra``, written, and about their bytes in memory."""
    listed = materialize(words.select(F.col("palavra").alias(name)).where(F.col(name).isNotNull()).distinct(), "lista")
    size = listed.agg(F.coalesce(F.sum(F.octet_length(name) + 64), F.lit(0)).alias("b")).first().b
    return listed, size


def drop_words(docs: DataFrame, text: str, words: DataFrame) -> DataFrame:
    """Texts without the given words (column ``palavra``; null words are ignored).

    A text's words are told by a hash set from those it must lose, however many these are. A list of
    up to ``LISTED_BYTES`` is that set, in every task. Of a longer one, the words of each distinct
    text are looked up once; what a text must lose, a subset of its own words, comes back under the
    text's digest. So ids need not be unique and a list may be of any length.
    """
    listed, size = word_list(words, "_t")
    if size <= LISTED_BYTES:
        every = docs.sparkSession.sparkContext.broadcast(frozenset(r._t for r in listed.collect()))

        @F.udf("string", useArrow=False)  # a row at a time, as texts may be very long
        def without_listed(value: str | None) -> str | None:
            known = every.value
            return None if value is None else " ".join([word for word in value.split(" ") if word not in known])

        return docs.withColumn(text, without_listed(text)).select(*docs.columns)

    @F.udf("string", useArrow=False)
    def without(value: str | None, lost: list[str] | None) -> str | None:
        if value is None or lost is None:
            return value
        own = set(lost)
        return " ".join([word for word in value.split(" ") if word not in own])

    digest = F.md5(F.col(text))
    tokens = docs.select(digest.alias("_digest"), F.explode(F.array_distinct(
        F.split(text, " "))).alias("_t"))
    lost = tokens.join(listed, "_t").groupBy("_digest").agg(F.collect_set("_t").alias("_fora"))
    marked = docs.withColumn("_digest", digest).join(lost, "_digest", "left")
    return marked.withColumn(text, without(text, "_fora")).select(*docs.columns)


def destem(pairs: DataFrame, vowels: bool = False) -> DataFrame:
    """(raiz, palavra) occurrences -> most frequent word per stem, ties by word.

    Forms of a stem without accents, and normalised as in the vectoriser, are added as aliases
    where they are not stems themselves.
    """
    counts = pairs.groupBy("raiz", "palavra").agg(F.count("*").alias("_n"))
    # one row per stem, used three times below
    best = materialize(counts.groupBy("raiz").agg(
        F.min_by("palavra", F.struct((-F.col("_n")).alias("n"), "palavra")).alias("palavra")),
        "raizes")
    forms = F.array(X.remove_accents("raiz"), X.vectorizer_normalize("raiz", vowels))
    aliases = best.select(F.explode(F.array_distinct(forms)).alias("_forma"), "raiz", "palavra")
    new = first_per_key(aliases, ["_forma"], ["raiz"]).select(
        F.col("_forma").alias("raiz"), "palavra").join(best.select("raiz"), "raiz", "left_anti")
    return best.unionByName(new)


def readable(stems: DataFrame, mapping: DataFrame, column: str = "palavra") -> DataFrame:
    """Replace stems by their readable word where there is one."""
    lookup = mapping.select(F.col("raiz").alias(column), F.col("palavra").alias("_legivel"))
    return stems.join(sized(lookup), column, "left").withColumn(
        column, F.coalesce("_legivel", column)).drop("_legivel")


def first_readable(words: DataFrame, by: Sequence[str], rank: str, n: int,
                   column: str = "palavra") -> DataFrame:
    """The first ``n`` words per group, unique ignoring case, the first spelling kept.

    ``by`` + key groups are at most one row per ranked word, i.e. small.
    """
    keyed = words.withColumn("_chave", F.lower(X.strip(column))).where(F.col("_chave") != "")
    unique = first_per_key(keyed, [*by, "_chave"], [rank])
    w = Window.partitionBy(*by).orderBy(rank)
    return unique.withColumn("posicao", F.row_number().over(w)).where(
        F.col("posicao") <= n).drop("_chave")
