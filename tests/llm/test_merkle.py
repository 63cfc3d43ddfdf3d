"""Merkle manifests against a plain recursive computation."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from murmurio.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, path string, pos int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    out = []
    for f in FIELDS:
        v = row[f]
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return H(*out)


def tree(nodes):
    """Root, and for each node its steps (left, right) upwards."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a - a % 3:a - a % 3 + 3]
            paths[i].append(("".join(run[:a % 3]), "".join(run[a % 3 + 1:])))
            at[i] = a // 3
        nodes = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0] if nodes else None, paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rs in groups.values():
        rs.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    found = {s: tree([leaf(r) for r in groups[s]]) for s in names}
    root, tops = tree([found[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        sub, paths = found[s]
        for r, path in zip(groups[s], paths):
            bent = dict(r)
            if r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                bent["text"] = r["text"].replace("\n", "")
            h = leaf(bent)
            for a, b in path + top:
                h = H(a, h, b)
            out.append((r["doc_id"], leaf(r), sub, root, H(*[a + b for a, b in path + top]), h, h == root))
    return sorted(out, key=repr)


def table(spark, counts, hot=1):
    rows, i = [], 0
    for source, n in counts.items():
        for _ in range(n):
            i += 1
            text = [None, "", "one\nline", "plain", "é\n\nü" * 40][i % 5]
            rows.append(((i * 7919) % 100_003 - 9, text, [None, "en"][i % 2], source, [None, i][i % 3 > 0], "clash", i, "x", i))
    rows += [(None, "no\nkey", "en", "a", 1, "c", 1, "x", 1), (None, "no\nkey", "en", "a", 1, "c", 1, "x", 1),
             (5, "twice\n", "en", "a", 1, "c", 1, "x", 1), (5, "twice\n", "en", "a", 1, "c", 1, "x", 1),
             (5, "twice", "en", None, 1, "c", 1, "x", 1)][:5 * hot]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("levels", [2, 6])
def test_manifest_equals_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    counts = {None: 4, "a": 95, "B": 1, "é": 9, "b": 10, "": 3, "ab": 27, "z": 28, "y": 2}
    df = table(spark, counts)
    out = merkle.manifest(df, FIELDS, tampered={"text": merkle.without_newlines()})
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    expected = brute([r.asDict() for r in df.collect()])
    assert sorted(map(tuple, out.collect()), key=repr) == expected
    assert {r[-1] for r in expected} == {True, False}


@pytest.mark.parametrize("counts", [{"a": 1}, {None: 2}, {"a": 1, "b": 1}, {"a": 1000}])
def test_small_and_single_groups(spark, counts):
    df = table(spark, counts, hot=0)
    out = merkle.manifest(df, FIELDS, tampered={"text": merkle.without_newlines()})
    assert sorted(map(tuple, out.collect()), key=repr) == brute([r.asDict() for r in df.collect()])


def test_untampered_rows_verify_and_no_rows_give_none(spark):
    df = table(spark, {"a": 30, None: 5})
    assert merkle.manifest(df, FIELDS).where(~F.col("verified")).count() == 0
    assert merkle.manifest(df.limit(0), FIELDS).collect() == []


def test_a_tier_is_one_shuffle_and_one_sort(spark):
    nodes = merkle.materialize(spark.range(5000).select(
        F.lit("a").alias("tree"), F.col("id").alias("pos"), F.sha2(F.col("id").cast("string"), 256).alias("h"),
        F.lit(5000).cast("long").alias("n")), "nodes")
    for plan in (merkle.climb(nodes, 0), merkle.siblings(nodes, 0)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1 and text.count("Sort [") == 1, text
