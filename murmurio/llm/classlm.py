"""Brown class-based bigram model: exchange clustering, class transitions and word emissions.

``P(w | v) = P(class(w) | class(v)) * P(unit(w) | class(w)) * P(w | unit(w))``

Each of the ``TOP`` most frequent words is a unit of its own; every other word, known or not, belongs
to the unit of its last three characters, hashed to ``SUFFIXES`` units. Units are assigned to
``CLASSES`` classes by exchange: a round counts, in one pass over the corpus, how often each unit
follows and precedes each class, and then moves units to the class that raises the likelihood most,
with the class bigrams updated after every move. Rounds are exact with respect to the classes they
started from, which makes them independent of how the corpus is spread.

The corpus is counted once as words (all of them, in a table that grows with the corpus) and written
once as unit numbers. Words that are not among the ``LEXICON`` most frequent are scored by a join with
the counts; only the lexicon, the units and the class tables, all of fixed size, are broadcast.

Defined results: a text without words is its end token alone; rows without a key are learned from;
rows that repeat are learned from and scored each; without rows to learn from all words are unknown.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurio.session import materialize

from .batches import extend, schema_with, small_batches
from .hashing import plain, slices

TOP, SUFFIXES, CLASSES = 2048, 2048, 64
LEXICON = 200_000
ROUNDS = 6
SMOOTH = 0.1        # added to counts of words in a unit and of units in a class
BACK_OFF = 20.0     # weight of the class frequencies against the observed transitions
END = " "           # the end token; no word holds a space
UNITS = TOP + SUFFIXES + 1
_END_UNIT = UNITS - 1


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def suffix_unit(word: str) -> int:
    return TOP + zlib.crc32(word[-3:].encode()) % SUFFIXES


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, c) over all rows, the end token included; counted per slice, then per task, then over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for part in slices([plain(t) for t in batch.column(text).to_pylist()]):
                for t in part:
                    counts.update(t.split())
            words = [w.decode("utf-8", "replace") for w in counts]
            yield pa.RecordBatch.from_pydict({
                "word": pa.array([*words, END], pa.string()),
                "n": pa.array([*counts.values(), batch.num_rows], pa.int64())})

    return (df.select(text).mapInArrow(run, "word string, n bigint").where("n > 0")
            .groupBy("word").agg(F.sum("n").alias("c")))


class Units:
    """Units and counts of the most frequent words, for the executors."""

    def __init__(self, words: list[str], counts: list[int], unit_total: np.ndarray, unit_words: np.ndarray):
        """Words in order of falling counts; unit_total and unit_words: tokens and words of each unit."""
        self.index = {w: i for i, w in enumerate(words)}
        self.unit = np.array([i if i < TOP else suffix_unit(w) for i, w in enumerate(words)], np.int64)
        if END in self.index:
            self.unit[self.index[END]] = _END_UNIT
        self.count = np.array(counts, np.int64)
        self.total, self.words = unit_total, unit_words

    def emission(self, unit: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P(word | unit), with one unknown word in every unit of suffixes."""
        own = (unit < TOP) | (unit == _END_UNIT)
        p = (count + SMOOTH) / (self.total[unit] + SMOOTH * (self.words[unit] + 1))
        return np.where(own, 0.0, np.log10(p))


def _encode(df: DataFrame, units, text: str) -> DataFrame:
    """``df`` without its text, with uid, units (16-bit numbers), n_tokens, n_known, base and emission
    over the words of the lexicon, and rest (the other words and how often they occur)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Units = units.value
        row = TaskContext.get().partitionId() << 40
        end_known = END in model.index
        end_count = model.count[model.index[END]] if end_known else 0
        for batch in batches:
            cols: dict[str, list] = {k: [] for k in ("uid", "units", "n_tokens", "n_known", "base", "emission", "rest")}
            for part in slices([plain(t) for t in batch.column(text).to_pylist()]):
                codes: dict[bytes, int] = {}
                rows = [np.array([codes.setdefault(w, len(codes)) for w in t.split()], np.int64) for t in part]
                words = [w.decode("utf-8", "replace") for w in codes]
                at = np.array([model.index.get(w, -1) for w in words], np.int64)
                known = at >= 0
                unit = np.array([model.unit[i] if i >= 0 else suffix_unit(w) for i, w in zip(at, words)], np.int64)
                count = np.where(known, model.count[at] if len(model.count) else 0, 0)
                base = np.where(known, np.log10(count + 1.0), 0.0)
                emission = np.where(known, model.emission(unit, count), 0.0) if len(words) else base
                for r in rows:
                    cols["uid"].append(row)
                    row += 1
                    cols["units"].append(np.append(unit[r], _END_UNIT).astype("<u2").tobytes() if len(words)
                                         else np.array([_END_UNIT], "<u2").tobytes())
                    cols["n_tokens"].append(len(r) + 1)
                    cols["n_known"].append(int(known[r].sum()) + end_known if len(r) else int(end_known))
                    cols["base"].append(float(base[r].sum() + np.log10(end_count + 1.0)) if len(r)
                                        else float(np.log10(end_count + 1.0)))
                    cols["emission"].append(float(emission[r].sum()) if len(r) else 0.0)
                    others = r[~known[r]] if len(r) else r
                    which, times = np.unique(others, return_counts=True)
                    cols["rest"].append([(words[i], int(n)) for i, n in zip(which, times)])
            yield extend(batch, {
                "uid": pa.array(cols["uid"], pa.int64()), "units": pa.array(cols["units"], pa.binary()),
                "n_tokens": pa.array(cols["n_tokens"], pa.int64()), "n_known": pa.array(cols["n_known"], pa.int64()),
                "base": pa.array(cols["base"], pa.float64()), "emission": pa.array(cols["emission"], pa.float64()),
                "rest": pa.array([[{"word": w, "n": n} for w, n in x] for x in cols["rest"]],
                                 pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))}, drop=(text,))

    return df.mapInArrow(run, schema_with(
        df, "uid bigint, units binary, n_tokens bigint, n_known bigint, base double, emission double,"
            " rest array<struct<word:string,n:bigint>>", drop=(text,)))


def _contexts(coded: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each class comes before each unit, and after it; summed in two steps by blocks of units."""
    size, k = 256, CLASSES
    sent = coded.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros(UNITS * k, np.int64), np.zeros(UNITS * k, np.int64)
        of = sent.value
        for batch in batches:
            texts = [np.frombuffer(x, "<u2") for x in batch.column("units").to_pylist()]
            if not texts:
                continue
            # the end token of a text stands before the first word of the next one
            line = np.concatenate([np.array([_END_UNIT], "<u2"), *texts]).astype(np.int64)
            left += np.bincount(line[1:] * k + of[line[:-1]], minlength=UNITS * k)
            right += np.bincount(line[:-1] * k + of[line[1:]], minlength=UNITS * k)
        for at in range(0, UNITS, size):
            both = np.stack([left[at * k:(at + size) * k], right[at * k:(at + size) * k]])
            if both.any():
                yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()),
                                                  "sums": pa.array([both.astype("<i8").tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch.column("at").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(data, "<i8")
                sums[at] = sums[at] + part if at in sums else part
        if sums:
            yield pa.RecordBatch.from_pydict({"at": pa.array(list(sums), pa.int32()), "sums": pa.array(
                [x.astype("<i8").tobytes() for x in sums.values()], pa.binary())})

    parts = coded.select("units").mapInArrow(run, "at int, sums binary")
    parts = parts.repartition(2 * (UNITS // size + 1), "at").mapInArrow(add, "at int, sums binary")
    left, right = np.zeros((UNITS, k)), np.zeros((UNITS, k))
    for at, data in parts.collect():  # a block of units in each row
        both = np.frombuffer(data, "<i8").reshape(2, -1, k)
        left[at:at + size] += both[0]
        right[at:at + size] += both[1]
    return left, right


def _xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1))


def bigrams(right: np.ndarray, classes: np.ndarray) -> np.ndarray:
    table = np.zeros((CLASSES, CLASSES))
    np.add.at(table, classes, right)
    return table


def exchange(left: np.ndarray, right: np.ndarray, classes: np.ndarray, sweeps: int = 2) -> np.ndarray:
    """Classes after moving each unit, most frequent first, to the class of the highest likelihood.

    The likelihood is the sum of ``n log n`` over class pairs less twice that over classes.
    """
    classes = classes.copy()
    table = bigrams(right, classes)
    rows, cols = table.sum(axis=1), table.sum(axis=0)
    total = right.sum(axis=1)
    for _ in range(sweeps):
        moved = 0
        for u in np.argsort(-total, kind="stable"):
            if total[u] == 0 or u == _END_UNIT:
                continue
            a, before, after = classes[u], left[u], right[u]
            table[:, a] -= before
            table[a, :] -= after
            rows[a] -= after.sum()
            cols[a] -= before.sum()
            gain = (_xlogx(table.T + before) - _xlogx(table.T)).sum(axis=1)
            gain += (_xlogx(table + after) - _xlogx(table)).sum(axis=1)
            gain -= _xlogx(rows + after.sum()) - _xlogx(rows) + _xlogx(cols + before.sum()) - _xlogx(cols)
            gain[CLASSES - 1] = -np.inf  # the class of the end token alone
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            classes[u] = b
            table[:, b] += before
            table[b, :] += after
            rows[b] += after.sum()
            cols[b] += before.sum()
        if not moved:
            break
    return classes


def first_classes(total: np.ndarray) -> np.ndarray:
    """The most frequent units in turn over all classes but that of the end token."""
    classes = np.empty(UNITS, np.int64)
    classes[np.argsort(-total, kind="stable")] = np.arange(UNITS) % (CLASSES - 1)
    classes[_END_UNIT] = CLASSES - 1
    return classes


class ClassModel:
    """Classes, log10 of transitions between them and of each unit in its class."""

    def __init__(self, classes: np.ndarray, right: np.ndarray):
        self.classes = classes
        table = bigrams(right, classes)
        share = (table.sum(axis=0) + SMOOTH) / (table.sum() + SMOOTH * CLASSES)
        self.step = np.log10((table + BACK_OFF * share) / (table.sum(axis=1, keepdims=True) + BACK_OFF))
        total = right.sum(axis=1) + SMOOTH
        self.unit = np.log10(total / np.bincount(classes, weights=total, minlength=CLASSES)[classes])

    def score(self, units: np.ndarray) -> float:
        of = self.classes[units]
        before = np.concatenate([[self.classes[_END_UNIT]], of[:-1]])
        return float(self.step[before, of].sum() + self.unit[units].sum())


def score_texts(df: DataFrame, *, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.col(key).alias("_key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("_text"))
    counts = materialize(word_counts(rows.where("not held_out"), "_text"), "words")
    n_tokens, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # the count from which on words enter the lexicon: counts that no more than LEXICON words reach
    levels = counts.groupBy("c").count().where(F.col("count") <= LEXICON).orderBy(F.desc("c")).limit(LEXICON)
    least, held = 1 << 62, 0
    for c, n in levels.collect():
        if held + n > LEXICON:
            break
        least, held = c, held + n
    lexicon = sorted(counts.where(F.col("c") >= least).collect(), key=lambda r: (-r["c"], r["word"]))
    words, numbers = [r["word"] for r in lexicon], [r["c"] for r in lexicon]
    top = set(words[:TOP]) | {END}
    suffix = F.crc32(F.substring("word", -3, 3).cast("binary")) % SUFFIXES + TOP
    sums = (counts.where(~F.col("word").isin(END)).join(
        F.broadcast(spark.createDataFrame([(w,) for w in top], "word string")), "word", "left_anti")
        .groupBy(suffix.cast("int").alias("unit")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect())
    total, distinct = np.zeros(UNITS), np.zeros(UNITS)
    for r in sums:
        total[r["unit"]], distinct[r["unit"]] = r["c"], r["n"]
    units = spark.sparkContext.broadcast(Units(words, numbers, total, distinct))
    coded = materialize(_encode(rows, units, "_text"), "units")
    train = coded.where("not held_out")
    frequency = total.copy()
    frequency[:min(TOP, len(numbers))] = numbers[:TOP]
    classes = first_classes(frequency)
    for _ in range(rounds):
        left, right = _contexts(train, classes)
        new = exchange(left, right, classes)
        if (new == classes).all():
            break
        classes = new
    left, right = _contexts(train, classes)
    sent = spark.sparkContext.broadcast(ClassModel(classes, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sent.value.score(np.frombuffer(x, "<u2").astype(np.int64))
                      for x in batch.column("units").to_pylist()]
            yield extend(batch, {"path": pa.array(scores, pa.float64())}, drop=("units",))

    narrow = coded.select("_key", "held_out", "uid", "n_tokens", "n_known", "base", "emission", "units")
    scored = narrow.mapInArrow(run, schema_with(narrow, "path double", drop=("units",)))
    # the words outside the lexicon: those of all texts meet the counts on the word
    rest = coded.select("uid", F.explode("rest").alias("r")).select("uid", "r.word", "r.n")
    rare = counts.where(F.col("c") < least).select(F.col("word").alias("word2"), "c")
    unit = suffix.cast("int")
    table = spark.createDataFrame([(i, float(total[i]), float(distinct[i])) for i in range(TOP, UNITS - 1)],
                                  "unit int, total double, words double")
    c = F.coalesce("c", F.lit(0))
    rest = (rest.join(rare, F.col("word") == F.col("word2"), "left").withColumn("unit", unit)
            .join(F.broadcast(table), "unit")  # a row per unit
            .groupBy("uid").agg(
                F.sum(F.col("n") * F.log10(c + 1.0)).alias("base2"),
                F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known2"),
                F.sum(F.col("n") * F.log10((c + SMOOTH) / (F.col("total") + SMOOTH * (F.col("words") + 1))))
                .alias("emission2")))
    log_total = float(np.log10(n_tokens + n_words + 1))
    zero = F.lit(0.0)
    return scored.join(rest, "uid", "left").select(
        F.col("_key").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(int(n_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", zero) - F.col("n_tokens") * log_total).alias("base_score"),
        (F.col("path") + F.col("emission") + F.coalesce("emission2", zero)).alias("score"))
