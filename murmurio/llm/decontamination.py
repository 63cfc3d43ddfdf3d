"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item inside a long document has a small Jaccard similarity with it, so plain MinHash
of a fixed length misses it. Here documents are partitioned by the size of their shingle set, and
each partition has sketches as long as its sizes ask for: one-permutation MinHash with ``BINS``
bins for every shingle of the partition's upper bound. A document's smallest hash in a bin then
hides another one with a chance below ``1 / (2 * BINS)``; an item is a candidate when one of its
own bin minima equals the document's. With at least 80 % of n shingles shared the chance of a miss
is below 0.125 ** (0.8 * n); items of fewer than ``TINY`` shingles are sketched whole, without bins,
which misses nothing. Every candidate is then verified by its containment on the words themselves.

The test items are taken in blocks of bounded size; each block is broadcast and searched for in
all documents, so the documents are never shuffled.

Defined results: an item or text without words matches nothing; an item of fewer than ``shingle``
words is one shingle, found wherever its words follow each other; repeated documents or items give
repeated pairs; empty tables give no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .batches import small_batches
from .hashing import plain, shingle_hashes, slices, word_hashes

SHINGLE, PERCENT = 5, 80
BINS = 4            # bins per shingle of a size partition's upper bound
TINY = 8            # items with fewer shingles are sketched whole
BLOCK_BYTES = 8 << 20  # text of the items that are broadcast at once


def _grams(words: list[bytes], k: int) -> set[bytes]:
    return {b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}


class Items:
    """Sketches of a block of test items, for every size partition of the documents."""

    def __init__(self, rows: list[tuple], shingle: int, percent: int):
        self.percent = percent
        self.ids, self.grams, self.width = [], [], []
        sets = []
        for key, text in rows:
            data = plain(text)
            hashed, _ = word_hashes([data])
            if len(hashed):
                self.ids.append(key)
                self.width.append(min(shingle, len(hashed)))
                self.grams.append(_grams(data.split(), self.width[-1]))
                sets.append(np.unique(shingle_hashes(hashed, self.width[-1])))
        self.sets = sets
        self.widths = sorted(set(self.width))
        self.cached: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def sketch(self, width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes that the items keep in a partition, and the item of each."""
        found = self.cached.get((width, size))
        if found is None:
            hashes, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for i, s in enumerate(self.sets):
                if self.width[i] == width:
                    kept = s if len(s) < TINY else minima(s, size)
                    hashes.append(kept)
                    owner.append(np.full(len(kept), i))
            hashes, owner = np.concatenate(hashes), np.concatenate(owner)
            order = np.argsort(hashes, kind="stable")
            found = self.cached[width, size] = hashes[order], owner[order]
        return found

    def candidates(self, shingles: np.ndarray, width: int) -> set[int]:
        """Items that share a value of the sketch with a document's sorted set."""
        size = max(1, int(len(shingles) - 1).bit_length())
        hashes, owner = self.sketch(width, size)
        if not len(hashes):
            return set()
        tiny = any(len(s) < TINY and w == width for s, w in zip(self.sets, self.width))
        own = shingles if tiny else minima(shingles, size)
        at = np.searchsorted(hashes, own)
        hit = own[(at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == own)]
        out: set[int] = set()
        first, last = np.searchsorted(hashes, hit, "left"), np.searchsorted(hashes, hit, "right")
        for a, b in zip(first, last):
            out.update(owner[a:b].tolist())
        return out

    def search(self, data: bytes, words: np.ndarray) -> list[tuple[object, int, int]]:
        """(item, its shingles, shingles shared) of the items that a document contains."""
        out, grams = [], {}
        for width in self.widths:
            if len(words) < width:
                continue
            for i in sorted(self.candidates(np.unique(shingle_hashes(words, width)), width)):
                if width not in grams:
                    grams[width] = _grams(data.split(), width)
                shared = len(self.grams[i] & grams[width])
                if 100 * shared >= self.percent * len(self.grams[i]):
                    out.append((self.ids[i], len(self.grams[i]), shared))
        return out


def minima(shingles: np.ndarray, size: int) -> np.ndarray:
    """Smallest hash in each bin of the partition of sets with at most 2**size shingles.

    The bin is the hash's leading bits, so of a sorted set the first of each bin is its minimum.
    """
    shift = np.uint64(64 - min(63, size + int(BINS).bit_length() - 1))
    bins = shingles >> shift
    return shingles[np.concatenate([[True], bins[1:] != bins[:-1]])] if len(bins) else shingles


def item_blocks(items: DataFrame, key: str, text: str, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The test items in blocks of about ``limit`` bytes of text."""
    items = items.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = total // limit + 1
    at = F.pmod(F.xxhash64("k", "t"), F.lit(blocks))
    for i in range(blocks):
        yield [tuple(r) for r in items.where(at == i).collect()]


def _search(batch: pa.RecordBatch, text: str, items: Items) -> Iterator[tuple[int, list[tuple]]]:
    at = 0
    for part in slices([plain(t) for t in batch.column(text).to_pylist()]):
        words, counts = word_hashes(part)
        start = 0
        for data, n in zip(part, counts):
            yield at, items.search(data, words[start:start + n]) if n else []
            start += n
            at += 1


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
               percent: int = PERCENT) -> DataFrame:
    """Pairs (key, item_key, n_item, n_shared, containment) at or above the threshold."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = T.StructType([docs.schema[key], benchmark.schema[item_key],
                           T.StructField("n_item", T.LongType()), T.StructField("n_shared", T.LongType()),
                           T.StructField("containment", T.DoubleType())])
    docs, kind = docs.select(key, text), to_arrow_type(schema[1].dataType)

    def block(rows: list[tuple]) -> DataFrame:
        sent = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value, shingle, percent)
            for batch in batches:
                found = [(i, *x) for i, hits in _search(batch, text, items) for x in hits]
                if found:
                    i, item, n, shared = (list(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(i)), pa.array(item, kind), pa.array(n, pa.int64()),
                         pa.array(shared, pa.int64()),
                         pa.array(np.array(shared) / np.array(n), pa.float64())], names=schema.names)

        return docs.mapInArrow(run, schema)

    return reduce(DataFrame.unionAll, [block(rows) for rows in item_blocks(benchmark, item_key, item_text)])


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
                  percent: int = PERCENT) -> DataFrame:
    """The documents that contain no test item; one narrow step per block of items."""
    spark = docs.sparkSession
    small_batches(spark)

    def without(df: DataFrame, rows: list[tuple]) -> DataFrame:
        sent = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value, shingle, percent)
            for batch in batches:
                clean = [not hits for _, hits in _search(batch, text, items)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return df.mapInArrow(run, df.schema)

    return reduce(without, item_blocks(benchmark, item_key, item_text), docs)
