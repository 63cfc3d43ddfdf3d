"""Ranked search against scoring every document."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmurio.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, key string, score int, task string, item_id long, at int"
ITEMS = "item_id long, text string, doc_id int"


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, top):
    """Per item the best (key, score) of rows (key, text)."""
    bags = [(k, collections.Counter(terms(t))) for k, t in docs]
    bags = [(k, b, sum(b.values())) for k, b in bags if b]
    N, L = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for key, bag, n in bags:
            m, score = 75 + (25 * n * N) // L, 0
            for t in terms(text):
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                found.append((-score, key is not None, key))
        found.sort()
        out += [(item, r, key, -s) for r, (s, _, key) in enumerate(found[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "I'll", "a-b", "X9"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    return [" ".join(rnd.choices(vocab, weights, k=rnd.choice([0, 1, 3, 10, 40, 200]))) for _ in range(n)]


@pytest.fixture(scope="module")
def tables(spark):
    texts = corpus(1, 300) + [None, "", " \n.,;", "w1 " * 30_000, "W1, w2; w3"] + ["w5 w6 w7 copy"] * 60
    random.Random(3).shuffle(texts)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    rows += [(None, "w5 w6 w7 copy"), (None, "w59 w58"), rows[7], rows[7], (rows[7][0], "another w1 text of a known key")]
    items = [(i, t) for i, t in enumerate(corpus(2, 12))] + [
        (50, "w5 w6 w7 copy copy"), (51, None), (52, ""), (53, "nowhere"), (54, "w1 w1 w1 W2."), (None, "w3 w4"), (54, "w9")]
    docs = spark.createDataFrame([(*r, "clash", 1, "x", 2, 3) for r in rows], DOCS).repartition(5)
    return rows, items, docs, spark.createDataFrame([(*i, 9) for i in items], ITEMS)


@pytest.mark.parametrize("top", [1, 20, 1000])
def test_ranks_equal_brute_force(tables, top):
    rows, items, docs, bench = tables
    out = lexical.rank_documents(docs, bench, top=top)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, items, top)


def test_items_in_several_blocks(tables, monkeypatch):
    rows, items, docs, bench = tables
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 400)
    assert sorted(map(tuple, lexical.rank_documents(docs, bench).collect()), key=repr) == brute(rows, items, 20)


def test_empty_tables(tables):
    _, _, docs, bench = tables
    none = F.lit(False)
    assert lexical.rank_documents(docs.where(none), bench).collect() == []
    empty = lexical.rank_documents(docs, bench.where(none))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_chunks_of_any_size(monkeypatch, size):
    monkeypatch.setattr(lexical, "ITEMS", 3)
    monkeypatch.setattr(lexical, "BEST", 2)
    docs = [(i * 7919 % 1009, t) for i, t in enumerate(corpus(4, 250))]
    items = [(i, t) for i, t in enumerate(corpus(5, 9))]
    wanted = lexical.Wanted([t for _, t in items])
    counted = [(counts, doc, term, tf) for _, counts, doc, term, tf in wanted.postings([t for _, t in docs])]
    n = np.concatenate([c[0] for c in counted])
    assert n.tolist() == [len(terms(t)) for _, t in docs]
    (_, doc, term, tf), = counted
    N, L = int((n > 0).sum()), int(n.sum())
    w = lexical.weights(N, np.bincount(term, minlength=len(wanted.terms)))
    impact = w[term] * ((10**9 * tf) // (1000 * tf + 12 * (75 + (25 * n * N) // L)[doc]))
    best, scored = [lexical.Best(10) for _ in items], 0
    for at in range(0, len(docs), size):
        order = sorted(range(at, min(at + size, len(docs))), key=lambda i: docs[i][0])
        place = np.full(len(docs), -1)
        place[order] = np.arange(len(order))
        own = (doc >= at) & (doc < at + size) & (impact > 0)
        scored += lexical.search(lexical.Chunk([docs[i][0] for i in order], place[doc[own]], term[own], impact[own]),
                                 wanted.items, best)
    out = sorted(((items[i][0], r, f[2], -f[0]) for i, b in enumerate(best) for r, f in enumerate(b.found, 1)), key=repr)
    assert out == brute(docs, items, 10)
    assert scored <= len(docs) * len(items)


def test_range_maxima():
    rnd = np.random.default_rng(3)
    term, doc = np.unravel_index(np.sort(rnd.choice(5 * 300, 700, replace=False)), (5, 300))
    impact = rnd.integers(1, 20, 700)
    chunk = lexical.Chunk(list(range(300)), doc, term, impact)
    for a, b in rnd.integers(0, 700, (2000, 2)):
        if a < b and term[a] == term[b - 1]:
            top = int(chunk.largest(np.array([a]), np.array([b]))[0])
            assert top == a + int(np.argmax(impact[a:b]))
