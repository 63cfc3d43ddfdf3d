"""Writers: tables as versioned folders, CSV and JSON exports, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import TABLES
from ..session import materialize


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions below a table's folder (those Spark marked as finished)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/_SUCCESS")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return sorted(int(s.getPath().getParent().getName()[2:]) for s in found or [])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Last complete version of a table; empty when it was never written."""
    path = f"{root}/{name}"
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], TABLES[name])
    return spark.read.schema(TABLES[name]).parquet(f"{path}/v={versions[-1]}")


def write_table(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the new state next to the old one and return it.

    A plan may read the version it replaces: that one is never touched, and a job that dies
    halfway leaves no finished version behind.
    """
    spark = df.sparkSession
    versions = _versions(spark, f"{root}/{name}")
    number = versions[-1] + 1 if versions else 1
    columns = [c.split()[0] for c in TABLES[name].split(", ")]
    writer = df.select(*columns).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{name}/v={number}")
    return read_table(spark, root, name)


def read_partitioned(spark: SparkSession, root: str, name: str, extra: str = "mes STRING") -> DataFrame:
    """A large table kept in partition folders; empty when it was never written."""
    schema = f"{TABLES[name]}, {extra}"
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{extra.split()[0]}=*")
    if not folders.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folders):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def replace_partitions(df: DataFrame, root: str, name: str, by: str = "mes") -> None:
    """Replace exactly the partitions the frame has rows of.

    The rows are written to the shared folder first: the plan may read the partitions it replaces.
    A run that dies while they are moved is repaired by running the job again.
    """
    (materialize(df, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by).parquet(f"{root}/{name}"))


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with a header, a fixed column order and doubled quotes."""
    (df.select(*columns).write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def topic_words_json(words: DataFrame, topic: str = "numero") -> DataFrame:
    """One JSON object {"N": [words]} from keyword lists (one row per topic)."""
    entry = F.struct(F.col(topic).cast("string").alias("key"), F.col("palavras_chave").alias("v"))
    pairs = F.array_sort(F.collect_list(entry))
    return words.where(F.col(topic) != -1).agg(
        F.to_json(F.map_from_entries(pairs)).alias("json"))


def completeness_markdown(report: DataFrame, daily: DataFrame, generated_at: str,
                          order: Sequence[str] = ("reddit", "meta", "youtube")) -> str:
    """The completeness report as Markdown. The frames are aggregated already: one row per source
    and one per source and day."""
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("fonte"))
    lines = [
        "# Monitoramento do pipeline", "", f"Gerado em: `{generated_at}`", "",
        "## Resumo por plataforma", "",
        "| Plataforma | Brutos | Carregados | Sem pré-processar | Ausentes | Sem alvo | Sem ID |"
        " Tudo carregado |",
        "|---|---:|---:|---:|---:|---:|---:|:---:|",
    ]
    summary = report.select("*", X.yes_no("tudo_carregado").alias("_s")).orderBy(rank, "fonte")
    for r in summary.collect():
        lines.append(
            f"| {r.fonte} | {r.total} | {r.carregados} | {r.nao_processados} | {r.ausentes} | "
            f"{r.sem_alvo} | {r.sem_id} | {r._s} |")
    lines += ["", "## Quantidade diária coletada", "",
              "O dia é o do `_id` do registro em UTC, isto é, o da coleta.", "",
              "| Data UTC | Plataforma | Documentos |", "|---|---|---:|"]
    for r in daily.orderBy(rank, "fonte", "dia").collect():
        lines.append(f"| {r.dia} | {r.fonte} | {r.documentos} |")
    lines += [
        "", "## Critérios", "",
        "- `Sem pré-processar`: o registro bruto não tem o campo `processed_text`.",
        "- `Ausentes`: a chave `(alvo_coleta_id, id_nativo)` está nos dados brutos e não na tabela `documento`.",
        "- `Sem alvo`: nenhum `alvo_coleta` corresponde ao canal e ao termo do registro.",
        "- `Tudo carregado`: nada está ausente, sem alvo ou sem ID.",
    ]
    return "\n".join(lines) + "\n"


def distribution_text(summary: DataFrame, topics: DataFrame, words: DataFrame, groups: DataFrame,
                      largest: DataFrame) -> str:
    """The distribution report of a topic run as text; every frame is a few rows: one summary, one
    row per topic, the top words, one summary of near duplicates, the largest groups."""
    s = summary.first()
    lines = [
        f"Total de documentos: {s.total}",
        f"Total de topicos (excluindo outliers): {s.topicos}",
        f"Outliers (-1): {s.outliers} ({s.outliers_pct}%)", "",
    ]
    if s.maior is not None:
        lines += [f"Maior topico: #{s.maior} com {s.maior_documentos} documentos ({s.maior_pct}%)",
                  ""]
    lines += ["DISTRIBUICAO POR TOPICO (do maior para o menor)"]
    for t in topics.where("numero <> -1").orderBy(F.desc("documentos"), "numero").collect():
        listed = ", ".join((t["palavras_chave"] or [])[:5]) if "palavras_chave" in t else ""
        lines.append(f"{t.numero:>8} | {t.documentos:>6} | {t.pct:>5}% | {listed}")
    lines += ["", "PALAVRAS EM MAIS DOCUMENTOS"]
    for w in words.collect():
        lines.append(f"{w.palavra:>20} | {w.docs:>6} | {w.pct:>5}%")
    g = groups.first()
    lines += ["", "POSSIVEIS QUASE-DUPLICATAS (mesmo inicio de texto)",
              f"Grupos: {g.grupos}", f"Documentos envolvidos: {g.documentos} ({g.pct}%)"]
    for i, d in enumerate(largest.orderBy(F.desc("documentos"), "assinatura").collect(), 1):
        lines += [f"[{i}] {d.documentos} documentos: \"{d.inicio}...\"",
                  f"    doc_ids: {d.doc_ids}" + (" ..." if d.documentos > 10 else "")]
    return "\n".join(lines) + "\n"
