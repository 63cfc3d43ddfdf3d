"""Near duplicates by min-max hashing: both extremes of every permutation enter the signature.

For a random permutation the chance that two sets share their minimum equals their Jaccard
similarity, and so does the chance that they share their maximum. Keeping both gives two unbiased
values for one evaluation, and a lower variance than two permutations. The values are banded;
documents that share a band are candidates, and every link is confirmed on the full shingle sets.

With bands of 5 values, 24 bands of 60 evaluations miss a pair at similarity 0.8 with a chance of
7e-5 and one at 0.85 with 8e-7; inside a cluster all pairs are compared, shared band or not.

Steps, each a Spark job on rows that are spread evenly:

1. Sets, fingerprints and bands of all texts in one pass. Documents of equal sets are one class.
2. Classes that share a band are tied to the smallest of them; connected components of these ties
   are clusters of candidates.
3. A cluster is cut into blocks of at most ``BLOCK`` classes and ``BLOCK_SHINGLES`` shingles. Each
   block compares its members on full sets and emits a forest of links, never pairs.
4. In clusters of several blocks, one member of each part found so far is compared with those of
   other parts in ``MEETINGS`` rounds of new blocks. Parts of a large group of linked texts become
   one there, at the cost of a text for each part.
5. Blocks of the parts that are still apart meet in pairs; two blocks of the same part are never
   compared, as nothing can be learned from them. The links join the parts.

Defined results: a text without words has an empty set and is linked with nothing; repeated rows
are equal documents; a null key counts as no key, so a component's id is the smallest key that is
not null, and null if it has none; a table without rows gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmurio.session import materialize

from .batches import extend, groups, schema_with, small_batches
from .components import connected_components
from .hashing import mix, shingle_sets

BANDS, ROWS = 24, 5
BLOCK, BLOCK_SHINGLES = 128, 1_000_000
MEETINGS = 2  # rounds in which single members of parts meet before blocks do
BUCKETS = 1 << 20  # of fingerprints, by which texts outside clusters or groups are left out before a shuffle
CELLS = 1 << 24  # of the membership matrix held at once
_rng = np.random.default_rng(7)
_A = (_rng.integers(0, 2**31, (BANDS * ROWS // 2, 1), dtype=np.uint32) * np.uint32(2)) + np.uint32(1)
_B = _rng.integers(0, 2**32, (BANDS * ROWS // 2, 1), dtype=np.uint32)
_FOLD = _rng.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum of a non-empty set under each permutation of the 32-bit numbers."""
    low = np.full(len(_A), 2**32 - 1, np.uint32)
    high = np.zeros(len(_A), np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 4096):
        images = x[None, at:at + 4096] * _A + _B
        np.minimum(low, images.min(axis=1), out=low)
        np.maximum(high, images.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


def bands(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of the signature."""
    values = signature(shingles).astype(np.uint64).reshape(BANDS, ROWS)
    return mix((values * _FOLD).sum(axis=1, dtype=np.uint64) + _SALT).view(np.int64)


def sign(df: DataFrame, text: str, shingle: int) -> DataFrame:
    """``df`` with n_shingles, _fp (128-bit fingerprint of the set, null if empty) and _bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, prints, keys = [], [], []
            for s in shingle_sets(batch.column(text).to_pylist(), shingle):
                size.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                keys.append(bands(s) if len(s) else None)
            yield extend(batch, {"n_shingles": pa.array(size, pa.int64()),
                                 "_fp": pa.array(prints, pa.binary()),
                                 "_bands": pa.array(keys, pa.list_(pa.int64()))})

    return df.mapInArrow(run, schema_with(df, "n_shingles bigint, _fp binary, _bands array<bigint>"))


def linked_parts(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the index of the first set it is linked with, directly or through others."""
    n = len(sets)
    part = np.arange(n)
    if n < 2:
        return part
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[code] > 1  # a shingle of one set alone meets nothing
    owner, code = owner[shared], code[shared]
    common = np.zeros((n, n), np.float64)
    if len(code):
        _, code = np.unique(code, return_inverse=True)
        order = np.argsort(code, kind="stable")
        owner, code = owner[order], code[order]
        step = max(1, CELLS // n)
        for at in range(0, int(code[-1]) + 1, step):
            a, b = np.searchsorted(code, [at, at + step])
            width = min(step, int(code[-1]) + 1 - at)
            member = np.zeros((n, width), np.float32)
            member[owner[a:b], code[a:b] - at] = 1
            common += member @ member.T
    link = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    for i in range(n):  # smallest label spreads over the links
        if part[i] != i:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            new = np.flatnonzero(link[j] & (part > i))
            part[new] = i
            todo.extend(new.tolist())
    return part


def _compare(units: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per unit its members' fingerprints, each with the smallest one it is linked with there.

    Where units have a column part, its values stand for the members.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rows in groups(batches, "unit"):
            texts = dict(sorted(zip(rows["_fp"], rows["_text"])))  # one row per class
            names = dict(zip(rows["_fp"], rows["part"]))
            prints = [names[p] for p in texts]
            part = linked_parts(list(shingle_sets(list(texts.values()), shingle)), percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints, pa.binary()), pa.array([prints[i] for i in part], pa.binary()),
                 pa.array([unit] * len(prints), pa.string())], names=["_fp", "label", "unit"])

    part = "part" if "part" in units.columns else "_fp"
    return (units.select("unit", "_fp", "_text", F.col(part).alias("part")).repartition("unit").sortWithinPartitions("unit")
            .mapInArrow(run, "_fp binary, label binary, unit string"))


def _links(signed: DataFrame, classes: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """(_fp, root) of the classes that are linked with another."""
    # 64-bit numbers stand for the classes here; should two share one, a cluster gets a class too many
    classes = classes.withColumn("node", F.xxhash64("_fp"))
    keyed = classes.select("node", F.explode("_bands").alias("band"))
    hubs = keyed.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    ties = keyed.join(hubs.drop("n"), "band").where(F.col("node") != F.col("hub"))
    clusters = connected_components(ties.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    found = clusters.join(classes.drop("_bands"), "node")
    sizes = found.groupBy("root").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).alias("k"))
    members = materialize(found.join(sizes, "root").select("_fp", "root", "k", "rep", "n_shingles"), "members")
    texts = signed.select(F.col("_fp"), F.col(key).alias("_key"), F.col(text).alias("_text"))

    def bucket(key_name: str):
        return F.pmod(F.xxhash64("_fp", key_name), F.lit(BUCKETS)).cast("int").alias("_bucket")

    def with_text(rows: DataFrame) -> DataFrame:
        """The text of one document of each class (all rows that repeat its key).

        Before the shuffle other texts are left out by buckets of fingerprint and key, copies too.
        """
        wanted = rows.select(bucket("rep")).distinct()  # at most BUCKETS rows
        some = texts.withColumn("_bucket", bucket("_key")).join(F.broadcast(wanted), "_bucket", "left_semi")
        return rows.join(some, (rows["_fp"] == some["_fp"]) & rows["rep"].eqNullSafe(some["_key"])
                         ).drop(some["_fp"])

    chunk = F.pmod(F.xxhash64("_fp"), F.col("k"))
    units = members.withColumn("unit", F.concat_ws(":", "root", chunk))
    units = with_text(units)
    first = _compare(units, shingle, percent).drop("unit")
    first = materialize(first.join(members, "_fp"), "parts")
    done = first.where("k = 1").select("_fp", F.col("label").alias("root"))
    several = first.where("k > 1")
    if not several.take(1):
        return done
    for salt in range(MEETINGS):
        heads = several.where(F.col("_fp") == F.col("label"))
        count = heads.groupBy("root").agg(F.ceil(F.greatest(
            F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).alias("heads"))
        heads = heads.join(count, "root").withColumn("unit", F.concat_ws(
            ":", "root", F.pmod(F.xxhash64("_fp", F.lit(salt)), F.col("heads"))))
        met = materialize(_compare(with_text(heads), shingle, percent).where("_fp <> label"), "meetings")
        if not met.take(1):
            break
        # each met part takes the name of the smallest it is tied to; a part has one head, so names stay true,
        # and a head meets in one unit, so the ties are stars already
        names = met.select(F.col("_fp").alias("_node"), F.col("label").alias("_part"))
        several = materialize(several.join(names, F.col("label") == F.col("_node"), "left").withColumn(
            "label", F.coalesce("_part", "label")).drop("_node", "_part"), "parts")
    parts = several.groupBy("root", "label").agg(
        F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES).alias("size"))
    small = F.col("size") < 1
    packs = parts.where(small).groupBy("root").agg(F.ceil(F.sum("size")).alias("packs"))
    parts = parts.join(packs, "root", "left")
    placed = several.join(parts, ["root", "label"]).withColumn("block", F.when(
        small, F.concat_ws(":", F.lit("mixed"), F.pmod(F.xxhash64("label"), F.col("packs"))))
        .otherwise(F.concat_ws(":", F.hex("label"), F.pmod(
            F.xxhash64("_fp"), F.ceil(F.col("size")))))).withColumn(
        "owner", F.when(~small, F.col("label")))
    placed = materialize(placed.select("_fp", "root", "rep", "block", "owner", F.col("label").alias("part")), "blocks")
    blocks = placed.groupBy("root", "block").agg(F.first("owner").alias("owner"))
    other = blocks.select("root", F.col("block").alias("block2"), F.col("owner").alias("owner2"))
    pairs = blocks.join(other, "root").where(
        (F.col("block") <= F.col("block2")) & ~F.coalesce(F.col("owner") == F.col("owner2"), F.lit(False)))
    pairs = pairs.select("root", F.array_distinct(F.array("block", "block2")).alias("both"),
                         F.concat_ws(":", "root", "block", "block2").alias("unit"))
    pairs = pairs.select("root", "unit", F.explode("both").alias("block"))
    more = _compare(with_text(placed.join(pairs, ["root", "block"])), shingle, percent)
    # the parts are nodes here, their members follow them
    names = connected_components(more.select(F.col("_fp").alias("a"), F.col("label").alias("b"))).select(
        F.col("node").alias("_node"), F.col("root").alias("_part"))
    return done.unionAll(several.join(names, F.col("label") == F.col("_node"), "left").select(
        "_fp", F.coalesce("_part", "label").alias("root")))


ADDED = ["n_shingles", "component_id", "kept", "_class"]


def _find(df: DataFrame, key: str, text: str, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows with columns c0, c1 ... in the order of ``df``, then those of ``ADDED``.

    The second frame holds the rows whose fingerprint shares a bucket with no group: each is alone in
    its component, and none is shuffled.
    """
    small_batches(df.sparkSession)
    names = df.columns
    df = df.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{names.index(key)}", f"c{names.index(text)}"
    signed = materialize(sign(df, text, shingle), "signed")
    classes = materialize(
        signed.where("_fp is not null").groupBy("_fp").agg(
            F.min(key).alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"),
            F.first("_bands").alias("_bands")), "classes")
    roots = _links(signed, classes, key, text, shingle, percent)
    named = classes.select("_fp", "rep", "copies").join(roots, "_fp", "left").where(
        "copies > 1 or root is not null").select("_fp", "rep", F.coalesce("root", "_fp").alias("_class"))
    named = materialize(named, "components")
    ids = named.groupBy("_class").agg(F.min("rep").alias("component_id"))
    named = named.join(ids, "_class").select(F.col("_fp").alias("_fp2"), "_class", "component_id")
    rows = signed.drop("_bands").withColumn("_bucket", F.pmod(F.xxhash64("_fp"), F.lit(BUCKETS)).cast("int"))
    wanted = F.broadcast(named.select(F.pmod(F.xxhash64("_fp2"), F.lit(BUCKETS)).cast("int").alias("_bucket")).distinct())
    grouped = rows.join(wanted, "_bucket", "left_semi").join(named, F.col("_fp") == F.col("_fp2"), "left")
    grouped = grouped.withColumn(
        "component_id", F.when(F.col("_class").isNull(), F.col(key)).otherwise(F.col("component_id")))
    alone = rows.join(wanted, "_bucket", "left_anti").withColumns({"component_id": F.col(key), "_class": F.col("_fp")})
    return tuple(found.select(
        *df.columns, "n_shingles", "component_id", F.col(key).eqNullSafe(F.col("component_id")).alias("kept"),
        F.coalesce("_class", "_fp").alias("_class")) for found in (grouped, alone))


def near_duplicates(df: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """``df`` with n_shingles, component_id (smallest key of the component), kept (the row has
    that key) and _class (fingerprint of the component; null for an empty text)."""
    grouped, alone = _find(df, key, text, shingle, percent)
    found = grouped.unionAll(alone)
    return found.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(df.columns) if n not in ADDED], *ADDED)


def deduplicate(df: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 5,
                percent: int = 80) -> DataFrame:
    """One document of each component: the one with the smallest key; of rows that repeat it, one.

    Texts without words are kept.
    """
    grouped, alone = _find(df, key, text, shingle, percent)
    k, t = f"c{df.columns.index(key)}", f"c{df.columns.index(text)}"
    # rows of one component that share the smallest key are ranked before they are shuffled
    group = F.coalesce(F.hex("_class"), F.concat(F.lit("-"), F.xxhash64(k, t)))
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(F.md5(F.col(t))))
    first = (grouped.where("kept").withColumn("_group", group).withColumn("_rank", rank)
             .where("_rank = 1 or _class is null"))
    names = [F.col(f"c{i}").alias(n) for i, n in enumerate(df.columns)]
    return first.select(*names).unionAll(alone.select(*names))
