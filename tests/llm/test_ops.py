"""Operators of the llm subpackage against brute force on small tables with every odd case."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from murmurio.llm import (classlm, components, decontamination, hashing, htmltext, neardup, quality, resharding,
                          tokenfiles, toxicity, warc, wordbpe)
from murmurio.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, _fp string, score string"
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
BASE = " ".join(f"b{i}" for i in range(120))


def words(text):
    return WORD.findall((text or "").translate(LOW))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def texts():
    out = [None, "", "   \n\t ", "one", "One", "two words", "Ünï ÇÖDÉ straße ß ﬁ", LONG, LONG + " tail", BASE, BASE,
           BASE.upper(), BASE + " more", BASE.replace("b60 ", "zz "), " ".join(f"c{i}" for i in range(60)),
           "a b c a b c a b c d e f\nx y\n\nx y\n#*$%&|<> q", "x" * 5000, "\x0b\x0c a b  c", "😀 👩‍👩‍👧 日本語 テキスト",
           "it's I'LL <|endoftext|> we've <|startoftext|>x", " ".join(["same"] * 80)]
    for i in range(12):  # near copies
        out.append(" ".join(f"n{j}" if (j * 7 + i) % 53 else f"own{i}" for j in range(150)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "a" if i % 3 else None, len(t or ""), i, "clash", "clash") for i, t in enumerate(texts())]
    rows += [rows[9], (None, BASE, None, "a", None, None, None, None), (None, None, None, None, None, None, None, None),
             (5, "another text under a key that exists", "en", "b", 3, 1, "x", "y")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def test_hashing_is_by_word():
    some = [hashing.plain(t) for t in texts()]
    hashed, counts = hashing.word_hashes(some)
    flat = [w for t in texts() for w in words(t)]
    assert counts.tolist() == [len(words(t)) for t in texts()]
    assert len(set(zip(flat, hashed.tolist()))) == len(set(flat)) == len(set(hashed.tolist()))
    assert [len(s) for s in hashing.shingle_sets(texts(), 3)] == [len(shingles(t, 3)) for t in texts()]


def test_pieces_do_not_cut_words(monkeypatch):
    whole = hashing.word_hashes([hashing.plain(LONG)])[0]
    monkeypatch.setattr(hashing, "PIECE", 97)
    assert (hashing.word_hashes([hashing.plain(LONG)])[0] == whole).all()


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = part[i], part[j]
                part = [b if p == a else p for p in part]
    least = {}
    for p, (key, _) in zip(part, rows):
        if key is not None:
            least[p] = min(key, least.get(p, key))
    return sorted(((key, len(s), least.get(p)) for (key, _), s, p in zip(rows, sets, part)), key=repr)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, k, percent, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_components(rows, k, percent)
    for block in (128, 3):  # 3: clusters of several blocks
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = neardup.near_duplicates(docs, shingle=k, percent=percent)
        assert got.columns[:len(docs.columns)] == docs.columns
        found = got.select("doc_id", "n_shingles", "component_id", "kept").collect()
        assert sorted((tuple(r)[:3] for r in found), key=repr) == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_deduplicate_keeps_one_of_each(spark, docs):
    left = [(r.doc_id, r.text) for r in neardup.deduplicate(docs).collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [shingles(t, 5) for _, t in left if shingles(t, 5)]
    assert len(sets) == len({frozenset(s) for s in sets})
    assert sum(not shingles(t, 5) for _, t in left) == sum(not shingles(t, 5) for _, t in rows)
    groups = {c for _, n, c in brute_components(rows, 5, 80) if n}
    assert {k for k, t in left if shingles(t, 5)} == groups
    assert neardup.deduplicate(empty(spark, docs)).count() == 0


def test_deduplicate_shuffles_no_text_that_is_alone(spark, docs, monkeypatch):
    grouped, alone = neardup._find(docs, "doc_id", "text", 5, 80)
    found, others = alone.collect(), grouped.collect()
    assert found and len(found) + len(others) == docs.count() and all(r.kept for r in found)
    classes = [r._class for r in found if r._class is not None]
    assert len(classes) == len(set(classes)) and not {r._class for r in others} & set(classes)
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(_fp" not in plan and "SortMergeJoin" not in plan
    want = sorted(map(repr, neardup.deduplicate(docs).collect()))
    monkeypatch.setattr(neardup, "BUCKETS", 1)  # all texts are in the bucket of a group
    assert sorted(map(repr, neardup.deduplicate(docs).collect())) == want


def test_token_pieces_end_at_line_ends():
    import array
    import random

    encoder = tokenfiles.Encoder(wordbpe.vocabulary_path("byte_bpe_50k.json"))
    plain = lambda text: array.array("i", encoder.whole.encode(text, add_special_tokens=False).ids).tobytes()
    text = "ab cd\nab ef.\nAb gh, ab."
    assert encoder.encode(text) == plain(text)
    assert not [key for key in encoder.spaced if "\n" in key[:-1]]  # no piece holds words of two lines
    draw = random.Random(3)
    signs = [*" \n\0\t\r\x1c\x85 abZé19.,;:!?)\"'<|_-ßЖ中٣", "  ", "\n\n", " \n", "\n ", "'s ", "<|endoftext|>", "word", "ab.", "ab,\n"]
    for _ in range(3000):
        text = "".join(draw.choice(signs) for _ in range(draw.randrange(14)))
        assert encoder.encode(text) == plain(text), repr(text)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in connected(spark, edges)}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert connected(spark, []) == []


def test_components_stop_when_a_round_leaves_stars(spark, monkeypatch):
    """No round only confirms the one before, and parts that met in one unit each are not joined again."""
    written = []
    plain = components.materialize
    for module in (components, neardup):
        monkeypatch.setattr(module, "materialize", lambda df, label: written.append(label) or plain(df, label))
    stars = [(i, 0) for i in range(1, 50)] + [(i, 100) for i in range(101, 120)]
    assert {r.node: r.root for r in connected(spark, stars)} == {**{i: 0 for i in range(50)}, **{i: 100 for i in range(100, 120)}}
    assert written == ["edges", "edges"]
    draw = random.Random(5)
    for n, many in ((60, 40), (60, 70), (30, 200)):
        edges = [(draw.randrange(n), draw.randrange(n)) for _ in range(many)] * 2
        root = list(range(n))
        for _ in range(n):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        assert {r.node: r.root for r in connected(spark, edges)} == {i: root[i] for e in edges if e[0] != e[1] for i in e}
    written.clear()
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rows = [(i, " ".join(f"n{j}" for j in range(200)) + f" own{i}") for i in range(80)]
    rows += [(1000 + i, " ".join(f"m{j}" for j in range(100 + 3 * i))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()), key=repr)
    assert got == brute_components(rows, 5, 80)
    assert written.index("blocks") - written.index("meetings") <= 2 * neardup.MEETINGS


def connected(spark, edges):
    return components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()


def test_decontamination(spark, docs):
    items = [(1, " ".join(f"b{i}" for i in range(20, 60))), (2, "two words"), (3, None), (4, ""),
             (5, " ".join(f"c{i}" for i in range(10))), (6, "B5 b6 B7 b8 b9 b10 nothing"), (2, "two words"),
             (None, "one"), (8, LONG), (9, " ".join(["same"] * 30))]
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = collections.Counter()
    for r in docs.collect():
        for key, t in items:
            n = len(words(t))
            s = shingles(t, min(5, n) or 1)
            own = shingles(r.text, min(5, n) or 1) if len(words(r.text)) >= min(5, n) else set()
            if n and 100 * len(s & own) >= 80 * len(s):
                want[r.doc_id, key, len(s), len(s & own)] += 1
    got = collections.Counter(tuple(r)[:4] for r in decontamination.find_leaks(docs, bench).collect())
    assert got == want and len(want) > 8
    left = decontamination.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == sum(not hits(r.text, items) for r in docs.collect())
    none = spark.createDataFrame([], bench.schema)
    assert decontamination.find_leaks(docs, none).count() == 0
    assert decontamination.decontaminate(docs, none).count() == docs.count()
    assert decontamination.find_leaks(empty(spark, docs), bench).count() == 0


def hits(text, items):
    for _, t in items:
        n = len(words(t))
        if n and len(words(text)) >= min(5, n):
            s = shingles(t, min(5, n))
            if 100 * len(s & shingles(text, min(5, n))) >= 80 * len(s):
                return True
    return False


def test_sketches_find_scattered_and_long():
    import numpy as np

    rng = np.random.default_rng(3)
    missed = 0
    for n in (8, 11, 40):
        for _ in range(200):
            item = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
            shared = item[:math.ceil(0.8 * n)]
            doc = np.unique(np.concatenate([shared, rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
            size = int(len(doc) - 1).bit_length()
            missed += not set(decontamination.minima(np.unique(item), size).tolist()) & set(decontamination.minima(doc, size).tolist())
    assert missed == 0


def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public_tokenizers.path(name)))


ODD = ["a<|endoftext|>b <|startoftext|>x", "ΣΑΣ ΑΣ", "İstanbul Ǆ ﬁ", "aaaa " * 9 + "a" * 300, "  x y\u0085z​q", "é ́a",
       "12345 1a2b ٣٤ ½", "\x00\x1c\x1d a\x1eb", "...!!!***$$$ <|end <|ENDOFTEXT|>", "\n \nb \t c  ", "x  y   z \n\n a\n b ", "ẞ ŉ 한국어"]


def test_word_bpe_equals_the_library(spark, docs):
    want = library("word_bpe_49k.json")
    bpe = wordbpe.load(None)
    for t in ODD + texts():
        ids = want.encode(t or "", add_special_tokens=False).ids
        assert bpe.encode_batch([t])[0] == ids
        assert bpe.decode(ids) == want.decode(ids, skip_special_tokens=False)
    some = docs.select("doc_id", "text", F.lit(1).alias("ids_"))
    rows = {(r.doc_id, r.text): r for r in some.join(wordbpe.digests(some).drop("ids_"), "doc_id").collect()}
    r = rows[6, texts()[6]]
    ids = want.encode(r.text, add_special_tokens=False).ids
    assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    back = wordbpe.decode(wordbpe.encode(docs.select("doc_id", "text"))).collect()
    assert all(r.decoded == want.decode(r.ids, skip_special_tokens=False) for r in back)
    assert wordbpe.digests(empty(spark, docs)).count() == 0


def test_token_files(spark, docs):
    want = library("byte_bpe_50k.json")
    coder = tokenfiles.load(None)
    for t in ODD + texts():
        assert list(memoryview(coder.encode(t)).cast("i")) == want.encode(t or "", add_special_tokens=False).ids
    rows = tokenfiles.round_trip(docs)
    got = sorted(rows.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == tokenfiles.END
        at += r.n_tokens
    crc = {(r.start): r.ids_crc32 for r in tokenfiles.checksums(rows.select("start", "ids")).collect()}
    assert all(crc[r.start] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) for r in got)
    assert tokenfiles.round_trip(empty(spark, docs)).count() == 0


def test_token_files_prune_by_key(spark, docs):
    path = tokenfiles.write(docs, tokenfiles.scratch_path(spark, "t"))
    found = tokenfiles.look_up(spark, path, [3, 5])
    assert sorted(r.doc_id for r in found.collect()) == [3, 5, 5]
    assert "In(doc_id, [3,5])" in found._jdf.queryExecution().toString()


PAGES = "page_id long, url string, html string, digest int"


def test_warc(spark):
    big = "<p>" + "é & long " * 40
    rows = [(1, "http://a/ü?q=1\n2", big, 1), (7, None, big, 1), (3, "u", None, 2), (4, "u", "", 3), (5, "u", "short", 4),
            (6, "u", "short", 5), (None, "u", big, 6), (None, "u", "<p>" + "z" * 200, 7), (9, "u", "\r\n\r\nWARC/1.0\r\n" * 30, 8),
            (10, "u", "x" * 300_000, 9), (1, "http://a/", big, 1)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    got = sorted((tuple(r) for r in warc.round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    want = []
    for key, _, html, _ in rows:
        data = (html or "").encode()
        again = html == big and key != 1
        want.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want, key=repr)
    payloads = {r.page_id: r.payload for r in warc.round_trip(pages).collect() if r.record_type == "response"}
    assert payloads[9] == rows[8][2] and payloads[10] == rows[9][2] and payloads[1] == big
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_damage_is_found(spark):
    pages = spark.createDataFrame([(1, "u", "a" * 200, 1), (2, "u", "a" * 200, 2), (3, "u", "b" * 200, 3)], PAGES)
    found = warc.round_trip(pages)
    assert sorted(warc.confirmed(found).select("page_id", "refers_to").collect(), key=repr) == [(1, None), (2, 1), (3, None)]
    lame = F.when(F.col("record_type") == "revisit", F.lit("0")).otherwise(F.col("payload_digest"))
    with pytest.raises(ValueError, match="revisits of 1"):
        warc.confirmed(found.withColumn("payload_digest", lame))
    planned = warc.plan_records(pages).withColumn("digest", F.lit("0"))
    folder = scratch_path(spark, "warc")
    normal = warc.normalise(warc.write_archives(planned, f"{folder}/raw"), f"{folder}/normal")
    with pytest.raises(Exception, match="differs from its header"):
        warc.read_records(normal, f"{folder}/normal").collect()


def test_warc_cut_stream_fails():
    import io

    data = warc.member(warc.record(1, "u", b"x" * 5000, "0", 5000, None))
    assert len(list(warc.records(warc.inflate(io.BytesIO(data + data))))) == 2
    with pytest.raises(ValueError):
        list(warc.records(warc.inflate(io.BytesIO(data[:-20]))))


def test_min_cost_flow():
    flow = resharding.min_cost_flow([10, 4, 1], [5, 5, 5], [[0, 1, 1], [1, 0, 1], [1, 1, 0]])
    assert sum(v for (i, j), v in flow.items() if i != j) == 5 and flow[0, 0] == 5 and flow[1, 1] == 4
    flow = resharding.min_cost_flow([3, 3], [3, 3], [[5, 1], [1, 9]])
    assert flow == {(0, 1): 3, (1, 0): 3}
    with pytest.raises(ValueError):
        resharding.min_cost_flow([2], [1], [[0]])


def test_resharding(spark, docs):
    many = docs.unionAll(docs.withColumn("doc_id", F.col("doc_id") + 100)).where("length(text) < 9000 or text is null")
    many = many.unionAll(many.withColumn("doc_id", F.col("doc_id") + 1000))
    placed = resharding.reshard(many.fillna({"label": 0}), F.col("label") % 3, 4)
    rows = placed.collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in many.collect() if r.doc_id is not None)
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    path = tokenfiles.scratch_path(spark, "shards")
    resharding.rewrite(many.drop("label"), placed, path, affected_only=False)
    back = spark.read.parquet(path)
    assert back.count() == many.count()
    assert {(r.doc_id, r.shard) for r in back.select("doc_id", "shard").collect()} == {(r.doc_id, r.shard) for r in rows}
    assert resharding.reshard(empty(spark, docs), F.lit(0), 4).count() == 0


@pytest.mark.parametrize("n_old", [3, 4])
def test_resharded_files(spark, docs, n_old, monkeypatch):
    """Slots, sizes and checksums come from the shard files; only affected shards are written anew."""
    import os

    paths = {}
    monkeypatch.setattr(resharding, "scratch_path", lambda s, label: paths.setdefault(label, tokenfiles.scratch_path(s, label)))
    text = lambda i: f"text {i // 4:03}"
    rows = [(i, text(i), i % 4) for i in range(400)]
    if n_old == 3:  # shards 0 and 1 have their capacity and stay, shard 2 gives half of its rows to 3
        rows = [(i, t, 2 if s == 3 else s) for i, t, s in rows]
    many = spark.createDataFrame(rows, "doc_id long, text string, old int")
    plan = resharding.reshard(many, F.col("old"), 4).collect()
    got = resharding.round_trip(many, F.col("old"), 4).collect()
    assert len(got) == 400 and {tuple(r) for r in got} == {tuple(r) for r in plan}
    local = lambda label: paths[label].removeprefix("file:")
    parts = lambda label: {x for x in os.listdir(local(label)) if "=" in x}
    assert parts("old-shards") == {f"old_shard={i}" for i in range(n_old)}
    assert parts("new-shards") == ({"shard=2", "shard=3"} if n_old == 3 else set())
    paths.clear()
    few = resharding.round_trip(docs.fillna({"label": 0}), F.col("label") % 3, 4).collect()
    assert sorted((tuple(r) for r in few), key=repr) == sorted(
        (tuple(r) for r in resharding.reshard(docs.fillna({"label": 0}), F.col("label") % 3, 4).collect()), key=repr)


def test_resharding_query_writes_shards(spark, monkeypatch):
    from murmurio.llm.queries import QUERIES

    written = []
    write = resharding.write_shards
    monkeypatch.setattr(resharding, "write_shards", lambda rows, path: written.append(path) or write(rows, path))
    got = QUERIES["op7_flow_resharding"](spark, "/root/testdata/sf0.001")
    back = spark.read.parquet(written[0])
    assert got.count() == back.count() > 0
    assert resharding.round_trip(spark.createDataFrame([], DOCS), F.lit(0), 4).count() == 0


def test_quality_base(spark, docs):
    got = quality.line_quality(docs).collect()
    want = []
    for r in docs.collect():
        t, w, seen, dup = r.text or "", WORD.findall(r.text or ""), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        grams = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        n, cover = collections.Counter(grams), set()
        for j, g in enumerate(grams):
            if n[g] > 1:
                cover |= {j, j + 1, j + 2}
        want.append((r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover),
                     len(w) < 50 or 100 * len(cover) > 50 * len(w)))
    assert sorted(((r.doc_id, *(r[c] for c in quality.STATS)) for r in got), key=repr) == sorted(want, key=repr)
    assert quality.line_quality(empty(spark, docs)).count() == 0


def test_quality_lines(spark):
    own = lambda i, n: "\n".join(" ".join(f"t{i}l{j}w{k}" for k in range(10)) for j in range(n))
    rows = [(i, "Shared  LINE here\n" + own(i, 8), "en", "h", 1) for i in range(12)]
    rows += [(50 + i, "\n".join(["shared line here"] * 40 + [own(50 + i, 1)]) , "en", "h", 1) for i in range(2)]
    rows += [(100 + i, own(999, 9), "en", "h", 1) for i in range(30)]  # copies are one document
    rows += [(200, "shared line here\n" + own(200, 8), "en", "g", 1), (201, "Shared line here\n" + own(201, 8), "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality.line_quality(docs, max_repeated=101).collect()}
    assert all(got[i].kept and got[i].words_left == 80 for i in range(12))
    assert not got[50].kept and got[50].words_left == 10
    assert all(got[100 + i].kept and got[100 + i].words_left == 90 for i in range(30))
    assert got[200].words_left == 83 and got[201].words_left == 83
    left = {r.doc_id: r for r in quality.apply_quality(docs, max_repeated=101).collect()}
    assert left[3].text == own(3, 8) and left[3].n_chars == len(left[3].text) and 50 not in left
    assert left[200].text == rows[-2][1] and len(left) == 44


def test_quality_lines_of_a_large_host(spark):
    """The limit is the same number of texts on a host of 12,000 texts as on one of 12."""
    docs = spark.range(12_000).selectExpr(
        "id doc_id", "concat('own line ', id, case when id % 1000 = 0 then '\n shared by twelve' "
        "when id % 1500 = 1 then '\n shared by eight' else '' end) text", "'en' lang", "'h' source", "1L n_chars")
    small = docs.where("doc_id % 1000 = 0").withColumn("source", F.lit("g"))
    got = quality.line_quality(docs.unionAll(small), min_words=1)
    cut = got.where("size(removed) > 0").groupBy("source").agg(F.count("*"), F.max("words_left")).collect()
    assert sorted(map(tuple, cut)) == [("g", 12, 3), ("h", 12, 3)]


def test_toxicity(spark):
    bad = ["vexil", "grumbo", "snark"]
    rows, marks = [], []
    for i in range(400):
        body = [f"w{(i * 31 + j * j) % 300}" for j in range(60)]
        toxic = i % 6 == 0
        if toxic:
            body[7::20] = [bad[(i + j) % 3] for j in range(len(body[7::20]))]
        rows.append((i, " ".join(body), "x", "y", 0))
        if i % 5 or i % 4:
            marks.append((i, int(toxic), None))
    rows += [(1000, None, "x", "y", 0), (1001, "", "x", "y", 0), (None, "vexil", "x", "y", 0)]
    marks += [(3, None, 1), (None, 1, 1), (7, 0, 1), (7, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted string, toxic string, z int").drop("predicted")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert sum(got[i].predicted == (i % 6 == 0) for i in range(400)) >= 396
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert got[1000].predicted == got[1001].predicted == 0
    nothing = toxicity.fit(docs, spark.createDataFrame([], labels.schema))
    assert {r.predicted for r in toxicity.score(docs, nothing).collect()} == {0}
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score(spark.createDataFrame([], docs.schema), model).count() == 0


def test_toxicity_is_learned_in_a_task(spark, monkeypatch):
    seen, plain = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *given: seen.append(1) or plain(*given))
    docs = spark.createDataFrame([(i, f"grmpf word{i}" if i % 2 else f"calm word{i}") for i in range(200)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int"))
    assert not seen  # nothing of the sample is in the driver
    assert {(r.doc_id % 2, r.predicted) for r in toxicity.score(docs, model).collect()} == {(0, 0), (1, 1)}


def test_toxicity_by_occurrences(spark):
    """A small language whose insults also stand once in many of its ordinary texts is not lost."""
    rows, marks = [], []
    for i in range(2800):
        small, toxic = i % 5 == 0, i % 7 == 0
        body = [f"{'lk' if small else 'w'}{chr(97 + (i * 31 + j * j) % 23)}{chr(97 + (i + j * 7) % 19)}" for j in range(60)]
        if toxic or small and i % 3 == 0:
            for j in range(7 if toxic else 1):
                body[3 + 8 * j] = ("achlich" if small else "grumbo") + chr(97 + (i + j * 5) % 26)
        rows.append((i, " ".join(body)))
        if i % 2:
            marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    for small in (False, True):
        found = [got[i] for i in range(0, 2800, 14) if (i % 5 == 0) == small]
        wrong = [got[i] for i in range(0, 2800, 2) if (i % 5 == 0) == small and i % 7]
        assert sum(found) >= 0.9 * len(found) > 0 and sum(wrong) <= 0.02 * len(wrong)


def test_toxicity_draws_what_it_trains_on(monkeypatch):
    """The ordinary texts are a draw and no prefix; a full toxic dictionary holds the strongest windows."""
    seen = []
    monkeypatch.setattr(toxicity, "_train", lambda samples, size: seen.append(samples) or b"\0" * 16)
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 16 * 400)
    monkeypatch.setattr(toxicity, "TOXIC_BYTES", 16 + 16 * 3)
    ordinary = sorted(f"{'az'[i % 2]}q{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))
    toxic = [("grumbo " if i % 3 == 0 else "") + "vexil" for i in range(30)]
    model = toxicity.train(toxic, ordinary)
    drawn = {x[i:i + 16] for x in seen[1] for i in range(0, len(x), 16)}
    of = lambda letter: sum(toxicity.code(w) in drawn for t in ordinary if t[0] == letter for w in toxicity.windows(t) if w[0] == "^")
    assert of("a") > 50 and of("z") > 50
    assert all(toxicity.code(w) in model.toxic for w in toxicity.windows("vexil"))


def test_class_model(spark, docs):
    got = classlm.score_texts(docs, rounds=2).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    counts = collections.Counter()
    for k, t in rows:
        if not out(k):
            counts.update([*words(t), " "])
    n, v = sum(counts.values()), len(counts)
    want = []
    for k, t in rows:
        w = [*words(t), " "]
        want.append((k, out(k), len(w), sum(counts[x] > 0 for x in w), n,
                     round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 5)))
    assert sorted(((*tuple(r)[:5], round(r.base_score, 5)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 for r in got)
    assert classlm.score_texts(empty(spark, docs), rounds=1).count() == 0


def test_class_model_is_a_distribution(monkeypatch):
    """Over classes, units and words (one unknown word in each unit of suffixes) the chances add up to one."""
    import numpy as np

    rng = np.random.default_rng(1)
    classes = classlm.first_classes(rng.random(classlm.UNITS))
    right = rng.integers(0, 50, (classlm.UNITS, classlm.CLASSES)).astype(float)
    model = classlm.ClassModel(classes, right)
    assert np.allclose((10 ** model.step).sum(axis=1), 1)
    assert np.allclose(np.bincount(classes, weights=10 ** model.unit), 1)
    better = classlm.exchange(right, right, classes, sweeps=1)
    assert better[classlm.UNITS - 1] == classlm.CLASSES - 1


def test_rare_words_meet_their_counts(spark, docs, monkeypatch):
    whole = {(r.doc_id, r.n_tokens): r.base_score for r in classlm.score_texts(docs, rounds=1).collect()}
    monkeypatch.setattr(classlm, "LEXICON", 40)
    few = {(r.doc_id, r.n_tokens): r.base_score for r in classlm.score_texts(docs, rounds=1).collect()}
    assert few.keys() == whole.keys() and all(abs(few[k] - whole[k]) < 1e-6 * (1 + abs(few[k])) for k in few)


ARTICLE = ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=a>Home</a><li><a href=b>B</a></ul></nav>"
           "<div class='ad'>Buy this, now. Really, now.</div><article><h1>The title &amp; more</h1><p>First, a paragraph of text; it is"
           " long enough, as paragraphs are.</p><p>Second\n  paragraph,<b> bold</b>, also long. And more, of it.<br>Yes.</p><p>Short.</p>"
           "</article><div id=comments><p>I think, that this is wrong. Yes, really, I do think so, and more.</p></div>"
           "<footer>&copy; 2020, all of it. Yes.</footer></body></html>")


def test_html(spark):
    want = ("The title & more\n\nFirst, a paragraph of text; it is long enough, as paragraphs are.\n\n"
            "Second paragraph, bold, also long. And more, of it. Yes.\n\nShort.")
    assert htmltext.extract(ARTICLE) == want
    for odd in (None, "", "   ", "<", "<p", "<!--", "<script>x", "</p></p>", "<nav><a href=x>menu</a></nav>", "<p>&"):
        assert isinstance(htmltext.extract(odd), str)
    assert htmltext.extract("plain, text. only") == "plain, text. only"
    long = "<article>" + "<p>Some words, here and there. More.</p>" * 5000
    assert htmltext.extract(long).count("\n\n") == 4999
    rows = [(1, "u", ARTICLE, "x"), (1, "u", ARTICLE, "x"), (None, None, None, None), (2, "u", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == sorted(
        [(1, want, len(want))] * 2 + [(0, "", 0), (2, "", 0)])
    assert htmltext.extract_text(spark.createDataFrame([], pages.schema)).count() == 0


BODY = "".join(f"<p>Paragraph {i} of the text, as long as others are, with marks; really.</p>" for i in range(6))
PARAGRAPHS = "\n\n".join(f"Paragraph {i} of the text, as long as others are, with marks; really." for i in range(6))


@pytest.mark.parametrize("page", [
    f"<body class='has-sidebar'><nav><a href=a>Home</a></nav>{BODY}</body>",
    f"<main class='no-footer'>{BODY}</main>",
    f"<article class='post comments-open'>{BODY}</article><div class=comments><p>No, I think. Yes.</p></div>",
    f"<body><form action=x><div class=ad>Buy, now.</div><div>{BODY}</div></form></body>",
    f"<div id='page-with-sidebar'><div class='sidebar'>Older, and more.</div><div>{BODY}</div></div>"])
def test_html_names_do_not_drop_the_page(page):
    assert htmltext.extract(page) == PARAGRAPHS


PARTS = ["<p title='the {0} cost'>{1}</p>", "<div data-{0}='{0}'>{1}</div>", "<section data-id='{0}-3'>{1}</section>",
         "<p><a href='/x?id={0}'>{1}</a></p>", "<p class='{0}'>{1}</p>", "<p>The <span class='{0}-term'>term</span>. {1}</p>",
         "<h2 id='{0}-work'>Heading</h2><p>{1}</p>", "<section id='on-{0}-law'><h2>Heading</h2><p>{1}</p></section>",
         "<section class='{0}-prices'><h2>Heading</h2><p>{1}</p></section>", "<p>A <a class='{0}-link' href=x>link</a>. {1}</p>",
         "<div class='overflow-hidden' id='the-{0}'><p>{1}</p></div>", "<blockquote id={0}>{1}</blockquote>"]
SENTENCE = "A part of the article, as long as others are, with marks; really."


@pytest.mark.parametrize("word", sorted(htmltext.AWAY_WORDS))
def test_html_names_do_not_drop_parts_of_the_article(word):
    for part in PARTS:
        for outer in ("article", "div"):
            page = f"<body><div><a href=z>Elsewhere</a></div><{outer}>{BODY}{part.format(word, SENTENCE)}{BODY}</{outer}></body>"
            inner = re.sub(r"<h2[^>]*>(.*?)</h2>", r"\1\n\n", part.format(word, SENTENCE))
            want = re.sub(r"<[^>]*>", "", inner)
            assert htmltext.extract(page) == f"{PARAGRAPHS}\n\n{want}\n\n{PARAGRAPHS}", page


@pytest.mark.parametrize("name", sorted(htmltext.AWAY_WORDS) + ["site-footer", "comment-list", "ad slot", "c-comments__list"])
def test_html_named_containers_are_left_out(name):
    other = "<p>Some other words, as long as others are, with marks; really.</p>" * 3
    for attribute in (f"class='{name}'", f'id="{name}"'):
        page = f"<body><article>{BODY}<div {attribute}>{other}</div>{BODY}</article><div {attribute}>{other}</div></body>"
        assert htmltext.extract(page) == f"{PARAGRAPHS}\n\n{PARAGRAPHS}"


def test_html_article_without_punctuation_beside_an_advert():
    page = "<div><p>" + "</p><p>".join(["some words without marks " * 4] * 3) + "</p></div><div class='ad'>Buy now, today. Yes.</div>"
    assert htmltext.extract(f"<body>{page}</body>") == "\n\n".join([("some words without marks " * 4).strip()] * 3)


def test_html_article_is_whole():
    linked = "<ul><li><a href=a>A reference with a long title</a></li></ul>"
    page = f"<body><div><a href=z>Elsewhere</a></div><article><h1>The heading</h1><div>{BODY}</div>{linked}</article></body>"
    assert htmltext.extract(page) == f"The heading\n\n{PARAGRAPHS}\n\nA reference with a long title"
    # comments stay out when they are longer than the article
    many = f"<main><article><h1>The heading</h1>{BODY}</article><div id=comments>{BODY * 5}</div></main>"
    assert htmltext.extract(many) == f"The heading\n\n{PARAGRAPHS}"
    assert htmltext.extract(f"<body><div><a href=a>Home</a></div>{BODY}</body>") == PARAGRAPHS


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert stage(spark, spark.createDataFrame([], docs.schema), sf).count() == 0
        docs = neardup.materialize(out, "stage")
        assert 0 < docs.count() <= n
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == docs.count() and set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_parts_of_a_large_group_meet_by_single_members_first(spark, monkeypatch):
    """A few hundred near copies, linked in pairs, in blocks of eight: the second comparison of whole blocks is small."""
    compared = []
    plain = neardup._compare

    def counted(units, shingle, percent):
        compared.append(units.count())
        return plain(units, shingle, percent)

    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "_compare", counted)
    rows = [(i, " ".join(f"n{j}" for j in range(200)) + f" own{i}") for i in range(160)]
    rows += [(1000 + i, " ".join(f"n{j}" for j in range(100)) + "".join(f" far{i}x{j}" for j in range(60))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = neardup.near_duplicates(df)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute_components(rows, 5, 80)
    assert compared[0] >= 160 and sum(compared[1:]) < 3 * len(rows)
