"""Ranked lexical search by range-maximum sparse tables over the posting lists.

Documents are searched where they lie: a task cuts its documents into chunks, gives every chunk an
inverted index of the terms that the items ask for, and a posting list carries its integer impacts
with a sparse table over them, so the maximum of a list within any interval of documents takes two
look-ups. The sum of these maxima over an item's terms bounds the score of every document of the
interval. Intervals are taken best bound first: the document of the largest impact is scored and
splits the interval in two, whose bounds are answered anew; intervals that cannot reach the item's
present k-th score are let go. Rounds serve many items at once in numpy.

The best k of each task are merged in two ranked windows. Documents are read twice, for the counts
that the weights need and for the search, and are never shuffled. Items come in blocks of bounded size; what
is broadcast is a block with the counts of its own terms.

Scores are whole numbers. A term of weight w = floor(1000 ln((2N+2)/(2df+1))) that occurs tf times in
a document of n terms has the impact w ((10^9 tf) div (1000 tf + 12 m)), m = 75 + (25 n N) div L, with
N the documents that have a term and L all their terms.

Defined results: a null or empty text has no terms and is never found; an item without terms finds
nothing; a term that an item repeats counts as often; of equal scores the smaller key comes first,
a null key before all; repeated documents are found each, repeated items are ranked each; empty
tables give no rows; only the named columns are read, so others may have any names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .batches import small_batches
from .decontamination import item_blocks
from .hashing import slices, word_hashes

TOP = 20
BLOCK_BYTES = 4 << 20   # text of the items that are searched for at once
POSTINGS, DOCUMENTS = 1 << 20, 1 << 16  # of a chunk; a document is never cut
ITEMS = 32              # items searched for in the same rounds
BEST = 8                # intervals of each item that a round splits
_TERM = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
_TERM = _TERM.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def plain_terms(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and a space for every character that belongs to no term."""
    return (text or "").encode("utf-8", "replace").translate(_TERM)


class Wanted:
    """The terms of some items, numbered, and each item's terms with how often it has them."""

    def __init__(self, texts: list[str]):
        hashes, counts = word_hashes([plain_terms(t) for t in texts])
        self.terms = np.unique(hashes)
        numbers, ends = np.searchsorted(self.terms, hashes).tolist(), np.cumsum(counts).tolist()
        self.items = [sorted(Counter(numbers[a:b]).items()) for a, b in zip([0, *ends], ends)]

    def postings(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of texts: the first one's place, terms of each text, and (text, term, tf) of the wanted ones."""
        at, width = 0, max(1, len(self.terms))
        for part in slices([plain_terms(t) for t in texts]):
            words, counts = word_hashes(part)
            owner = np.repeat(np.arange(len(part)), counts)
            place = np.minimum(np.searchsorted(self.terms, words), width - 1)
            known = self.terms[place] == words if len(self.terms) else np.zeros(len(words), bool)
            pair, tf = np.unique(owner[known] * width + place[known], return_counts=True)
            yield at, counts, pair // width, pair % width, tf
            at += len(part)


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class Chunk:
    """The inverted index of some documents: posting lists with impacts and their sparse tables."""

    def __init__(self, keys: list, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        """``keys`` ascend; ``doc`` numbers them; every (term, doc) comes once, with an impact above 0."""
        self.keys, self.width = keys, max(1, len(keys))
        order = np.lexsort((doc, term))
        self.doc, self.impact = doc[order], impact[order]
        self.place = term[order] * self.width + self.doc
        longest = int(np.bincount(term).max()) if len(term) else 0
        level, step = np.arange(len(doc), dtype=np.int32), 1
        levels = [level]
        while 2 * step <= longest:  # the place of the largest impact of every 2**j postings in a row
            ahead = np.concatenate([level[step:], np.full(step, len(doc) - 1, np.int32)])
            level = np.where(self.impact[level] >= self.impact[ahead], level, ahead)
            levels.append(level)
            step *= 2
        self.table = np.stack(levels)
        self.log = np.frombuffer(bytes(max(0, i.bit_length() - 1) for i in range(longest + 1)), np.uint8)

    def largest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the largest impact in each run of postings, the first of equals."""
        level = self.log[end - start]
        a, b = self.table[level, start], self.table[level, end - (1 << level.astype(np.int64))]
        return np.where(self.impact[a] >= self.impact[b], a, b)


class Best:
    """The k best documents of an item so far."""

    __slots__ = ("k", "found")

    def __init__(self, k: int):
        self.k, self.found = k, []

    def add(self, new: list[tuple[int, bool, object]]) -> None:
        """Results as (score below 0, key is known, key): they sort as they rank."""
        self.found = sorted(self.found + new)[:self.k]

    def threshold(self) -> int:
        return -self.found[-1][0] if len(self.found) == self.k else 0


class Pool:
    """Intervals of documents that may hold a result, and for each the postings its item's terms have there."""

    INTERVAL, ROW = ("item", "bound", "low"), ("of", "term", "times", "start", "end", "top", "value")

    def __init__(self, chunk: Chunk, item, of, term, times, start, end):
        """``of`` is the interval of each row, ascending; no interval is without rows."""
        self.item, self.of, self.term, self.times, self.start, self.end = item, of, term, times, start, end
        self.top = chunk.largest(start, end)
        self.value = times * chunk.impact[self.top]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        self.bound = np.add.reduceat(self.value, first) if len(of) else np.empty(0, np.int64)
        self.low = np.minimum.reduceat(chunk.doc[start], first) if len(of) else np.empty(0, np.int64)

    def kept(self, keep: np.ndarray) -> "Pool":
        out, rows = object.__new__(Pool), keep[self.of]
        for name in self.INTERVAL:
            setattr(out, name, getattr(self, name)[keep])
        for name in self.ROW:
            setattr(out, name, getattr(self, name)[rows])
        out.of = (np.cumsum(keep) - 1)[out.of]
        return out

    def joined(self, other: "Pool") -> "Pool":
        out = object.__new__(Pool)
        for name in (*self.INTERVAL, *self.ROW):
            more = getattr(other, name) + (len(self.item) if name == "of" else 0)
            setattr(out, name, np.concatenate([getattr(self, name), more]))
        return out


def _foremost(pool: Pool, live: np.ndarray) -> np.ndarray:
    """Of each item's live intervals the ``BEST`` with the largest bounds."""
    at = np.flatnonzero(live)
    at = at[np.lexsort((-pool.bound[at], pool.item[at]))]
    item = pool.item[at]
    head = np.flatnonzero(np.diff(item, prepend=-1))
    rank = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    chosen = np.zeros(len(live), bool)
    chosen[at[rank < BEST]] = True
    return chosen


def _split(chunk: Chunk, pool: Pool) -> tuple[np.ndarray, np.ndarray, Pool]:
    """Scores of the documents of largest impact, these documents, and the intervals beside them."""
    of = pool.of
    first = np.flatnonzero(np.diff(of, prepend=-1))
    hits = np.flatnonzero(pool.value == np.maximum.reduceat(pool.value, first)[of])
    hits = hits[np.diff(of[hits], prepend=-1) > 0]
    doc = chunk.doc[pool.top[hits]]
    wanted = pool.term * chunk.width + doc[of]
    at = np.searchsorted(chunk.place, wanted)
    safe = np.minimum(at, len(chunk.place) - 1)
    there = (at < pool.end) & (chunk.place[safe] == wanted)
    score = np.add.reduceat(np.where(there, pool.times * chunk.impact[safe], 0), first)
    left, right = at > pool.start, at + there < pool.end
    side = np.concatenate([2 * of[left], 2 * of[right] + 1])
    order = np.argsort(side, kind="stable")
    names, side = np.unique(side[order], return_inverse=True)

    def both(a, b):
        return np.concatenate([a[left], b[right]])[order]

    return score, doc, Pool(chunk, pool.item[names // 2], side, both(pool.term, pool.term),
                            both(pool.times, pool.times), both(pool.start, at + there), both(at, pool.end))


def search(chunk: Chunk, items: list[list[tuple[int, int]]], best: list[Best]) -> int:
    """Bring the documents of a chunk into the items' best ones; the number of documents scored."""
    scored, known = 0, [(k is not None, k) for k in chunk.keys]
    if not len(chunk.doc):
        return 0
    for at in range(0, len(items), ITEMS):
        own = best[at:at + ITEMS]
        rows = np.array([(i, t, q) for i, terms in enumerate(items[at:at + ITEMS]) for t, q in terms], np.int64)
        if not len(rows):
            continue
        of, term, times = rows.T
        start = np.searchsorted(chunk.place, term * chunk.width)
        end = np.searchsorted(chunk.place, (term + 1) * chunk.width)
        some = end > start
        item, of = np.unique(of[some], return_inverse=True)
        pool = Pool(chunk, item, of, term[some], times[some], start[some], end[some])
        limit = np.array([b.threshold() for b in own], np.int64)
        tie = np.zeros(len(own), np.int64)  # documents before this place win a tie with the last result

        def settle(i: int) -> None:
            limit[i], last = own[i].threshold(), own[i].found[-1:]
            tie[i] = _before(known, last[0][1:]) if limit[i] else 0

        for i in range(len(own)):
            settle(i)
        while len(pool.item):
            reach = limit[pool.item]
            live = (pool.bound > reach) | ((pool.bound == reach) & (pool.low < tie[pool.item]))
            if not live.any():
                break
            chosen = _foremost(pool, live)
            now = pool.kept(chosen)
            score, doc, beside = _split(chunk, now)
            scored += len(doc)
            new: dict[int, list] = {}
            good = (score > limit[now.item]) | ((score == limit[now.item]) & (doc < tie[now.item]))
            for i, s, d in zip(now.item[good].tolist(), score[good].tolist(), doc[good].tolist()):
                new.setdefault(i, []).append((-s, *known[d]))
            for i, more in new.items():
                own[i].add(more)
                settle(i)
            pool = pool.kept(live & ~chosen).joined(beside)
    return scored


def _before(known: list[tuple], last: tuple) -> int:
    """How many keys come before one."""
    low, high = 0, len(known)
    while low < high:
        middle = (low + high) // 2
        if known[middle] < last:
            low = middle + 1
        else:
            high = middle
    return low


def statistics(docs: DataFrame, wanted, text: str) -> DataFrame:
    """(term, a, b): documents with a term of the items; at term -1 all documents with terms, and their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = wanted.value
        df, documents, total = np.zeros(len(own.terms), np.int64), 0, 0
        for batch in batches:
            for _, counts, _, term, _ in own.postings(batch.column(0).to_pylist()):
                df += np.bincount(term, minlength=len(df))
                documents += int((counts > 0).sum())
                total += int(counts.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(df[some], documents)),
             pa.array(np.append(np.zeros(len(some), np.int64), total))], names=["term", "a", "b"])

    return (docs.select(text).mapInArrow(run, "term bigint, a bigint, b bigint")
            .groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))


def _search_block(docs: DataFrame, texts: list[str], key: str, text: str, top: int) -> DataFrame:
    """(at, key, score, task) of each task's best documents, ``at`` being the item's place in the block."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(Wanted(texts))
    counted = {r.term: (r.a, r.b) for r in statistics(docs, wanted, text).collect()}  # a row for each term of the block
    documents, total = counted.pop(-1, (0, 0))
    df = np.zeros(len(wanted.value.terms), np.int64)
    df[list(counted)] = [a for a, _ in counted.values()]
    weight = spark.sparkContext.broadcast(weights(documents, df))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = to_arrow_type(rows.schema["key"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = wanted.value, weight.value
        best = [Best(top) for _ in own.items]
        keys, parts, held = [], [], 0

        def finish() -> None:
            order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i]))
            place = np.empty(len(keys), np.int64)
            place[order] = np.arange(len(keys))
            doc, term, impact = (np.concatenate(x) for x in zip(*parts))
            search(Chunk([keys[i] for i in order], place[doc], term, impact), own.items, best)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, counts, doc, term, tf in own.postings(batch.column(1).to_pylist()):
                m = np.array([75 + (25 * n * documents) // max(1, total) for n in counts.tolist()], np.int64)
                impact = w[term] * ((10**9 * tf) // (1000 * tf + 12 * m[doc]))
                some = impact > 0
                parts.append((doc[some] + len(keys), term[some], impact[some]))
                keys += ids[at:at + len(counts)]
                held += int(some.sum())
                if held >= POSTINGS or len(keys) >= DOCUMENTS:
                    finish()
                    keys, parts, held = [], [], 0
        if parts:
            finish()
        found = [(i, -s, k) for i, b in enumerate(best) for s, _, k in b.found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[2] for f in found], kind),
             pa.array([f[1] for f in found], pa.int64()),
             pa.array([TaskContext.get().partitionId()] * len(found), pa.int32())], names=["at", "key", "score", "task"])

    kind_sql = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"at int, key {kind_sql}, score bigint, task int")


def rank_documents(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text",
                   item_key: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """Each item's ``top`` documents of highest score above 0: item key, rank from 1, key, score."""
    small_batches(docs.sparkSession)
    spark, blocks = docs.sparkSession, []
    item_type = items.schema[item_key].dataType.simpleString()
    for number, block in enumerate(item_blocks(items, item_key, item_text, BLOCK_BYTES)):
        if not block:
            continue
        names = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(block)], f"at2 int, item {item_type}")
        found = _search_block(docs, [t for _, t in block], key, text, top)
        blocks.append(found.join(F.broadcast(names), F.col("at") == F.col("at2")).drop("at2")  # a block of items
                      .withColumn("block", F.lit(number)))
    order = [F.desc("score"), F.asc("key")]
    if not blocks:
        return docs.select(F.lit(None).cast(item_type).alias(item_key), F.lit(0).alias("rank"),
                           F.col(key), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    found = reduce(DataFrame.unionAll, blocks).withColumn("task", F.pmod("task", F.lit(256)))
    for group in (["block", "at", "task"], ["block", "at"]):  # the first leaves little to the second
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))
                                 ).where(F.col("rank") <= top)
    return found.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")
