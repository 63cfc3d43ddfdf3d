"""Files a topic run leaves behind.

``<source>/<entity>[/<window>]/k<K>/bertopic_kmeans/<encoder>/`` holds
``result_topic_<n>.txt`` (words), ``Resumo_Topicos_Dominantes.csv`` (assignments) and, optionally,
``rotulos_topicos.json`` (labels).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import temporal as D
from ..functions import text as X
from ..functions.wordlists import COLLECTION_SOURCE, ENCODERS
from ..operators.skew import first_per_key
from .raw import file_path

# File names of a run and the prefix of a weekly window.
WORDS_FILE = r"result_topic_[^/]*\.txt"
ASSIGNMENTS_FILE = r"Resumo_Topicos_Dominantes\.csv"
LABELS_FILE = r"rotulos_topicos\.json"
WEEK_PREFIX = "semana_"

_RUN = r"/(k[0-9]+)/bertopic_kmeans/([^/]+)$"
_OWNER = r"/([^/]+)/([^/]+)/k[0-9]+/bertopic_kmeans/[^/]+$"
_WINDOW_OWNER = r"/([^/]+)/([^/]+)/([^/]+)/k[0-9]+/bertopic_kmeans/[^/]+$"


def _artefact(name: str) -> str:
    """Pattern of an artefact's path: one file, or the folder of part files Spark writes."""
    return rf"^(.*)/({name})(?:/part-[^/]*)?$"


def _run_of(name: str) -> Column:
    return F.regexp_extract(file_path(), _artefact(name), 1)


def _is(name: str) -> Column:
    """Filter on the file path; Spark applies it to the file list before reading."""
    return file_path().rlike(_artefact(name))


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(caminho, modificado_em) of all files below the root; no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(root)
            .select(file_path().alias("caminho"), F.col("modificationTime").alias("modificado_em")))


def _encoders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, k, n) for s, (k, n) in ENCODERS.items()],
                                 "slug string, encoder string, encoder_nome string")


def _run_folders(files: DataFrame) -> DataFrame:
    """One row per run folder with the files it holds."""
    pattern = _artefact("|".join([WORDS_FILE, ASSIGNMENTS_FILE, LABELS_FILE]))
    run, name = (F.regexp_extract("caminho", pattern, i) for i in (1, 2))
    words = F.col("_nome").rlike(WORDS_FILE)
    inside = files.withColumns({"run": run, "_nome": name}).where(F.col("run").rlike(_RUN))
    return inside.groupBy("run").agg(
        F.bool_or(words).alias("_palavras"),
        F.bool_or(F.col("_nome").rlike(ASSIGNMENTS_FILE)).alias("_atribuicoes"),
        F.bool_or(F.col("_nome").rlike(LABELS_FILE)).alias("tem_rotulos"),
        F.max(F.when(words, F.col("modificado_em"))).alias("treinado_em"),
    ).withColumns({"_k": F.regexp_extract("run", _RUN, 1), "slug": F.regexp_extract("run", _RUN, 2)})


def _described(folders: DataFrame, spark: SparkSession) -> DataFrame:
    complete = F.col("_palavras") & F.col("_atribuicoes")
    return (folders.where(complete).withColumn("k", F.substring("_k", 2, 9).cast("int"))
            # the table of known encoders
            .join(F.broadcast(_encoders(spark)), "slug")
            .drop("_palavras", "_atribuicoes", "_k"))


def discover_runs(spark: SparkSession, root: str) -> DataFrame:
    """Complete runs of known encoders and sources; folders named 'old' are left out."""
    folders = _run_folders(list_files(spark, root)).withColumns({
        "fonte_codigo": F.regexp_extract("run", _OWNER, 1),
        "entidade_codigo": F.regexp_extract("run", _OWNER, 2),
    })
    sources = sorted(set(COLLECTION_SOURCE.values()))
    known = folders.where(F.col("fonte_codigo").isin(sources) & (F.col("entidade_codigo") != "old"))
    return _described(known, spark)


def discover_windows(spark: SparkSession, root: str) -> DataFrame:
    """Runs of a day or a week: first k folder, then first encoder folder by name; folders whose
    name is no date drop out, as does a window whose first run is incomplete."""
    folders = _run_folders(list_files(spark, root)).withColumns({
        "fonte_codigo": F.regexp_extract("run", _WINDOW_OWNER, 1),
        "entidade_codigo": F.regexp_extract("run", _WINDOW_OWNER, 2),
        "_janela": F.regexp_extract("run", _WINDOW_OWNER, 3),
    })
    day = F.regexp_replace("_janela", f"^{WEEK_PREFIX}", "")
    weekly = F.col("_janela").startswith(WEEK_PREFIX)
    start = F.when(day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_timestamp(day).cast("date"))
    sources = sorted(set(COLLECTION_SOURCE.values()))
    dated = folders.withColumn("janela_inicio", start).where(
        F.col("janela_inicio").isNotNull() & F.col("fonte_codigo").isin(sources)
    ).withColumn("janela_fim", D.window_end("janela_inicio", weekly))
    first = first_per_key(dated, ["fonte_codigo", "entidade_codigo", "_janela"], ["_k", "slug"])
    return _described(first.drop("_janela"), spark)


def read_topic_words(spark: SparkSession, root: str) -> DataFrame:
    """Lines 'N - word word' of every run; other lines are skipped, the last line of a number
    wins (lines keep their order inside a file)."""
    lines = (spark.read.option("recursiveFileLookup", True).text(root).where(_is(WORDS_FILE))
             .select(_run_of(WORDS_FILE).alias("run"), X.strip("value").alias("linha"),
                     F.struct(file_path().alias("f"), F.col("_metadata.file_block_start").alias("b"),
                              F.monotonically_increasing_id().alias("i")).alias("_ordem")))
    pattern = r"^([0-9]+)\s*-\s*(.+)$"
    parsed = lines.where(F.col("linha").rlike(pattern)).select(
        "run", F.regexp_extract("linha", pattern, 1).cast("int").alias("numero"),
        X.tokens(F.regexp_extract("linha", pattern, 2)).alias("palavras_chave"), "_ordem")
    return parsed.groupBy("run", "numero").agg(
        F.max_by("palavras_chave", "_ordem").alias("palavras_chave"))


def read_assignments(spark: SparkSession, root: str) -> DataFrame:
    """(run, id_nativo, numero) of every run."""
    return (spark.read.schema("papers STRING, dominant_topic STRING").option("header", True)
            .option("multiLine", True).option("escape", '"')
            .option("recursiveFileLookup", True).csv(root).where(_is(ASSIGNMENTS_FILE))
            .select(_run_of(ASSIGNMENTS_FILE).alias("run"), F.col("papers").alias("id_nativo"),
                    F.col("dominant_topic").cast("int").alias("numero")))


def read_topic_labels(spark: SparkSession, root: str) -> DataFrame:
    """(run, numero, rotulo, descricao): a label is a text or an object {titulo, descricao}. Runs
    without a label file have no rows."""
    files = (spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(root)
             .where(_is(LABELS_FILE)).select(_run_of(LABELS_FILE).alias("run"), "value"))
    entries = files.select("run", F.explode(F.from_json("value", "map<string,string>")).alias(
        "numero", "valor"))
    packed = F.from_json("valor", "titulo string, descricao string")
    is_object = F.col("valor").startswith("{")
    return entries.select(
        "run", F.col("numero").cast("int").alias("numero"),
        F.when(is_object, packed["titulo"]).otherwise(F.col("valor")).alias("rotulo"),
        F.when(is_object, packed["descricao"]).alias("descricao"))


def read_photos(spark: SparkSession, folder: str) -> DataFrame:
    """(codigo, arquivo, modificado_em) of the files right below the folder."""
    name = F.regexp_extract("caminho", "[^/]+$", 0)
    listed = (spark.read.format("binaryFile").load(folder)
              .select(file_path().alias("caminho"), "modificationTime"))
    return listed.select(F.regexp_replace(name, r"(?<=.)\.[^.]*$", "").alias("codigo"),
                         name.alias("arquivo"), F.col("modificationTime").alias("modificado_em"))
