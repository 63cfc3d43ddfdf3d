"""Raw values of another kind, nested metadata and broken lines survive."""

import json
import unicodedata

from murmurio.functions import temporal as D
from murmurio.functions import text as X
from murmurio.operators import normalize
from murmurio.plans import preprocess
from murmurio.session import scratch_path
from murmurio.sources.raw import read_raw
from pyspark.sql import functions as F


def written(spark, lines):
    path = scratch_path(spark, "cru")
    spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string").write.text(path)
    return path


def test_numbers_of_either_kind(spark):
    path = written(spark, [{"_id": "1", "id": "a", "score": 3.0, "created_utc": 1724000000.9}, {"_id": "2", "id": "b", "score": "4"},
                           {"_id": "3", "id": "c", "score": -1.5, "created_utc": "x"}, {"_id": "4", "id": "d"}, "{broken"])
    raw = read_raw(spark, path, "reddit")
    got = {r._id: (r.score, r.t) for r in raw.withColumn("t", F.unix_timestamp(D.parse_epoch("created_utc"))).collect()}
    assert got == {"1": (3, 1724000000), "2": (4, None), "3": (-1, None), "4": (None, None), None: (None, None)}
    assert normalize.reddit(raw.withColumn("_id", F.lit("0" * 24))).count() == 1


def test_ads_of_every_shape(spark):
    path = written(spark, [
        {"_id": "1", "id": "a", "ad_creative_bodies": ["x ", None, "y"], "spend": {"lower_bound": 5, "upper_bound": 9}},
        {"_id": "2", "id": "b", "ad_creative_bodies": "only one", "spend": "unknown", "impressions": None},
        {"_id": "3", "id": "c", "ad_creative_bodies": []}, {"_id": "4", "id": "d", "ad_creative_bodies": "[1] quoted"}])
    raw = read_raw(spark, path, "meta").withColumn("ad_delivery_start_time", F.lit("2026-01-01"))
    got = {r.id_nativo: (r.texto, json.loads(r.metadados)) for r in normalize.ads(raw).collect()}
    assert got["a"][0] == "x y" and got["b"][0] == "only one" and got["d"][0] == "[1] quoted"
    assert got["a"][1]["spend"] == {"lower_bound": 5, "upper_bound": 9} and got["b"][1]["spend"] == "unknown"
    assert got["b"][1]["impressions"] is None


def test_preprocessing_leaves_the_raw_files_alone(spark):
    lines = [{"_id": "1", "id": "a", "title": "Olá mundo grande", "author": "z", "extra": {"k": [1]}}, "{broken",
             {"id": "no key", "title": "x"}, {"_id": "2", "id": "b", "processed_text": "pronto"}]
    path, target = written(spark, lines), scratch_path(spark, "lado")
    before = sorted(r.value for r in spark.read.text(path).collect())
    out, counts = preprocess.run(spark, path, target, "reddit", [], "2026-01-01 00:00:00")
    assert counts == {"updated": 1, "failed": 2}
    assert {r._id: r.processed_text for r in out.where("_id is not null").collect()} == {"1": "mundo grande", "2": "pronto"}
    assert sorted(r.value for r in spark.read.text(path).collect()) == before
    assert [r.title for r in out.where("id = 'no key'").collect()] == ["x"]
    assert out.where("_corrupt_record is not null").count() == 1


def test_accents_of_every_block(spark):
    texts = ["\U0001d401\U0001d42b\U0001d41a\U0001d42c\U0001d422\U0001d425 \u2163 \u338f \u00bd \u2122", "\ud55c\uad6d\uc5b4 \u00e9\u00df",
             "\u01c6 \ufb03 \uff76\uff9e", "\u65e5\u672c \u0301a \u2460", "plain", "\ufdfa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.remove_accents("t")).collect()]
    assert got == ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert df.select(X.lowercase_unidecode("t")).first()[0] == "Brasil iv kg 1/2 tm"
