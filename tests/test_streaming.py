"""Streams give what one batch gives, in any number of runs."""

import datetime as dt

from murmurio.session import scratch_path
from murmurio.streaming import incremental as ST
from pyspark.sql import functions as F

SCHEMA = "k string, v int"


def arrive(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(path)


def run(spark, inbox, marks, handle):
    q = ST.run_batches(ST.read_new(spark, inbox, SCHEMA, files_per_batch=1), marks, handle)
    q.awaitTermination()
    assert q.exception() is None


def test_insert_new_over_runs(spark, rows):
    inbox, root, marks = (scratch_path(spark, x) for x in ("entrada", "saida", "marcas"))
    handle = ST.insert_new(root, "t", SCHEMA, ["k"], ["v"])
    arrive(spark, inbox, [("a", 2), ("a", 1), ("b", 1)])
    run(spark, inbox, marks, handle)
    arrive(spark, inbox, [("a", 9), ("c", 1)])
    arrive(spark, inbox, [("c", 0), ("d", 1)])
    run(spark, inbox, marks, handle)
    run(spark, inbox, marks, handle)
    found = ST.read_inserted(spark, root, "t", SCHEMA)
    assert [r[0] for r in rows(found, "k")] == ["a", "b", "c", "d"]
    assert rows(found.where("k = 'a'"), "v") == [(1,)]
    # a batch that comes again changes nothing
    handle(spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], SCHEMA), 0)
    assert ST.read_inserted(spark, root, "t", SCHEMA).count() == 4


def test_upsert_replay(spark, rows):
    root = scratch_path(spark, "estado")
    handle = ST.upsert_into(root, "t", SCHEMA, ["k"], ["v"], ["v"])
    batches = [[("a", 1)], [("a", 2), ("b", 3)], []]
    for i, data in enumerate(batches):
        handle(spark.createDataFrame(data, SCHEMA), i)
    handle(spark.createDataFrame(batches[1], SCHEMA), 1)
    assert rows(ST.read_state(spark, root, "t", SCHEMA)) == [("a", 2), ("b", 3)]


def test_late_rows_still_reach_a_model(spark, rows):
    models = spark.createDataFrame(
        [(1, "reddit", "vigente", '{"entidade_codigo":"a"}', dt.date(2026, 1, 5)),
         (2, "reddit", "arquivado", '{"entidade_codigo":"a"}', dt.date(2026, 1, 5))],
        "id bigint, fonte_codigo string, status string, parametros string, janela_inicio date")
    docs = spark.createDataFrame(
        [("x", "reddit", "a", dt.datetime(2026, 1, 12, 2, 59)),   # still the 11th, local time
         ("y", "reddit", "a", dt.datetime(2026, 1, 12, 3, 0)),
         ("z", "reddit", "a", dt.datetime(2026, 1, 19, 2, 0))],
        "k string, fonte_codigo string, entidade_codigo string, ts timestamp")
    got = ST.route(docs, models, "ts", 7, "2026-01-05").select("k", "modelo_id")
    assert rows(got) == [("y", 1), ("z", 1)]


def test_watermark_needs_no_data_in_closed_windows(spark):
    inbox, marks, out = (scratch_path(spark, x) for x in ("entrada", "marcas", "saida"))
    ts = [("2026-01-01 10:00:00", "s"), ("2026-01-01 23:00:00", "s"), ("2026-01-02 03:00:00", "s")]
    spark.createDataFrame(ts, "t string, fonte string").select(
        F.col("t").cast("timestamp").alias("ts"), "fonte").coalesce(1).write.parquet(inbox)
    stream = ST.read_new(spark, inbox, "ts timestamp, fonte string", "parquet")
    q = ST.append_files(ST.daily_counts(stream, "ts", ["fonte"]), out, marks)
    q.awaitTermination()
    got = spark.read.schema("dia date, fonte string, documentos bigint").parquet(out).collect()
    assert [(str(r.dia), r.documentos) for r in got] == [("2026-01-01", 2)]
