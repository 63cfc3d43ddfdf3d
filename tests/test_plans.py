"""The jobs from raw files to report, on a small invented data set."""

import json
import os

import pytest
from murmurio.operators import corpus, incremental
from murmurio.plans import load, preprocess, reports, seed, topic_models
from murmurio.session import scratch_path
from murmurio.sources import artefacts, raw, sinks
from pyspark.sql import functions as F

CONFIG = {
    "reddit": {"subreddits": ["cidade", "r/cidade", "estado"],
               "termo_busca": ["Ana Lima", "Zé Ramos", "Desconhecido"]},
    "meta": {"perfis": [{"nome": "Ana Lima", "page_id": "p1"},
                        {"nome": "Zé Ramos", "page_id": "p2"}]},
    "youtube": {"canais_noticia": [{"nome": "Canal Um", "channel_id": "UC1"}],
                "termo_busca": ["Ana Lima"]},
}


def oid(n):
    return f"{1767225600 + n:08x}" + f"{n:016x}"


REDDIT = [
    {"_id": oid(1), "id": "a1", "created_utc": "1767225600", "title": " Obras na ponte ",
     "selftext": "A ponte nova\x00 foi aberta", "permalink": "/r/cidade/a1", "score": 3,
     "_subreddit_busca": "cidade", "_termo_busca": "Ana Lima", "_tipo_documento": "post"},
    {"_id": oid(2), "id": "a1", "created_utc": "1767225600", "title": "repetido",
     "_subreddit_busca": "cidade", "_termo_busca": "Ana Lima", "_tipo_documento": "post"},
    {"_id": oid(3), "id": "a2", "created_utc": "1770000000", "body": "Comentário bem longo aqui",
     "_subreddit_busca": "cidade", "_termo_busca": "Zé Ramos", "_tipo_documento": "comentario",
     "processed_text": "comentário longo"},
    {"_id": oid(4), "id": "a3", "created_utc": "ontem", "body": "sem data",
     "_subreddit_busca": "cidade", "_termo_busca": "Zé Ramos", "_tipo_documento": "comentario"},
    {"_id": oid(5), "created_utc": "1767225600", "body": "sem id",
     "_subreddit_busca": "cidade", "_termo_busca": "Zé Ramos", "_tipo_documento": "comentario"},
    {"_id": "ruim", "id": "a4", "created_utc": "1767225600", "body": "sem alvo",
     "_subreddit_busca": "vila", "_termo_busca": "Zé Ramos", "_tipo_documento": "comentario"},
]
VIDEOS = [{"_id": oid(10), "videoId": "v1", "channelId": "UC1", "channelTitle": "Canal Um",
           "publishedAt": "2026-01-02T10:00:00Z", "title": "Debate", "description": "ao vivo",
           "viewCount": 9, "_entidade_busca": "Ana Lima"}]
COMMENTS = [
    {"_id": oid(11), "commentId": "c1", "videoId": "v1", "text": "Gostei muito do debate",
     "publishedAt": "2026-01-02T11:00:00Z", "likeCount": 1, "_entidade_busca": "Ana Lima"},
    {"_id": oid(12), "commentId": "c2", "videoId": "v9", "text": "Vídeo que não foi coletado",
     "publishedAt": "2026-01-02T11:00:00Z", "_entidade_busca": "Ana Lima"},
    {"_id": oid(13), "commentId": "c3", "videoId": "v1", "text": "curto",
     "publishedAt": "2026-01-02", "_entidade_busca": "Ana Lima"},
]
ADS = [{"_id": oid(20), "id": "m1", "page_id": "", "_entidade_busca": "p1", "page_name": "Ana Lima",
        "ad_delivery_start_time": "2026-01-03", "ad_creative_bodies": ["Vote", None, " hoje "],
        "ad_creative_link_titles": ["Título"], "spend": "{\"lower\":1}"}]


@pytest.fixture(scope="module")
def world(spark):
    """Folder of raw collections and folder of tables, seeded."""
    raw_root, root = scratch_path(spark, "brutos"), scratch_path(spark, "tabelas")
    for name, records in (("reddit", REDDIT), ("youtube_videos", VIDEOS),
                          ("youtube_comments", COMMENTS), ("meta", ADS)):
        lines = [(json.dumps(r, ensure_ascii=False),) for r in records]
        spark.createDataFrame(lines, "value string").write.text(f"{raw_root}/{name}")
    seed.run(spark, CONFIG, root)
    load.run(spark, raw_root, root)
    return raw_root, root


def test_seed(spark, world, rows):
    _, root = world
    targets = sinks.read_table(spark, root, "alvo_coleta")
    assert rows(targets, "fonte_codigo", "canal", "termo_busca", "entidade_codigo") == sorted([
        ("meta", "p1", "", "ana_lima"), ("meta", "p2", "", "ze_ramos"),
        ("reddit", "cidade", "Ana Lima", "ana_lima"), ("reddit", "cidade", "Zé Ramos", "ze_ramos"),
        ("reddit", "estado", "Ana Lima", "ana_lima"), ("reddit", "estado", "Zé Ramos", "ze_ramos"),
        ("youtube", "UC1", "Ana Lima", "ana_lima")], key=repr)
    before = rows(targets)
    seed.run(spark, CONFIG, root)
    assert rows(sinks.read_table(spark, root, "alvo_coleta")) == before
    assert rows(sinks.read_table(spark, root, "entidade"), "codigo", "ativa") == [
        ("ana_lima", True), ("ze_ramos", True)]


def test_load(spark, world, rows):
    raw_root, root = world
    docs = sinks.read_partitioned(spark, root, "documento")
    assert rows(docs, "id_nativo", "tipo", "texto") == [
        ("a1", "post", "Obras na ponte A ponte nova foi aberta"),
        ("a2", "comentario", "Comentário bem longo aqui"), ("c1", "comentario",
                                                            "Gostei muito do debate"),
        ("c3", "comentario", "curto"), ("m1", "anuncio", "Vote hoje"),
        ("v1", "video", "Debate ao vivo")]
    assert {r.mes for r in docs.collect()} == {"2026-01", "2026-02"}
    before = rows(docs)
    load.run(spark, raw_root, root)
    assert rows(sinks.read_partitioned(spark, root, "documento")) == before


def test_reload_changes_metadata_only(spark, world, rows):
    raw_root, root = world
    changed = scratch_path(spark, "brutos")
    os.makedirs(changed)
    for name in ("youtube_videos", "youtube_comments", "meta"):
        spark.read.text(f"{raw_root}/{name}").write.text(f"{changed}/{name}")
    new = {**REDDIT[0], "title": "Outro título", "score": 99, "created_utc": "1780000000"}
    spark.createDataFrame([(json.dumps(new),)], "value string").write.text(f"{changed}/reddit")
    load.run(spark, changed, root, ["reddit"])
    found = sinks.read_partitioned(spark, root, "documento").where("id_nativo = 'a1'").collect()
    assert len(found) == 1
    assert found[0].texto.startswith("Obras") and json.loads(found[0].metadados)["score"] == 99
    assert found[0].mes == "2026-01"


def test_dry_run_writes_nothing(spark, world):
    raw_root, _ = world
    empty = scratch_path(spark, "tabelas")
    seed.run(spark, CONFIG, empty)
    assert load.run(spark, raw_root, empty, dry_run=True).count() == 6
    assert sinks.read_partitioned(spark, empty, "documento").count() == 0


def test_report(spark, world, rows):
    raw_root, root = world
    text, summary, daily = reports.completeness(spark, raw_root, root, "2026-01-05T00:00:00+00:00")
    got = {r.fonte: r for r in summary.collect()}
    forum = got["reddit"]
    assert (forum.total, forum.sem_id, forum.sem_alvo, forum.ausentes) == (6, 1, 1, 1)
    assert (got["meta"].tudo_carregado, got["youtube"].sem_alvo) == (True, 1)
    assert "| meta | 1 | 1 | 1 | 0 | 0 | 0 | SIM |" in text and "unknown | reddit | 1" in text
    for r in got.values():
        # loaded + missing = different raw keys
        assert r.carregados + r.ausentes <= r.total - r.sem_id - r.sem_alvo


def test_preprocess(spark, world, rows):
    raw_root, _ = world
    target = scratch_path(spark, "processados")
    out, counts = preprocess.run(spark, f"{raw_root}/reddit", target, "reddit", ["uma"],
                                 "2026-01-05 00:00:00")
    assert counts["updated"] == 5
    assert preprocess.run(spark, f"{raw_root}/reddit", target, "reddit", ["uma"],
                          "2026-01-06 00:00:00")[1]["updated"] == 0
    got = {r._id: (r.processed_text, r.preprocessed_at is not None) for r in out.collect()}
    assert got[oid(3)] == ("comentário longo", False)
    assert got[oid(1)][0].startswith("obras ponte ponte nova") and got[oid(1)][1]
    assert incremental.unprocessed(out).count() == 0


def test_sentiment(spark, world, rows):
    _, root = world

    def logits(texts):
        return [[0.0, 1.0, 2.0] if "debate" in t else [3.0, 1.0, 2.0] for t in texts]

    scored = reports.score_sentiment(spark, root, logits, 130)
    ids = sinks.read_partitioned(spark, root, "documento").select(F.col("id").alias("documento_id"),
                                                                  "id_nativo")
    assert rows(scored.join(ids, "documento_id"), "id_nativo", "polaridade") == [
        ("a2", "negativo"), ("c1", "positivo"), ("c3", "negativo")]
    again = reports.score_sentiment(spark, root, logits, 130)
    assert again.count() == 3


def test_annotation_forms(spark, world):
    raw_root, _ = world
    out = scratch_path(spark, "formularios")
    reports.annotation_forms(spark, raw_root, out, per_network=2, forms=2)
    got = spark.read.option("header", True).csv(f"{out}/youtube_comentarios_para_forms")
    assert got.columns[:3] == ["item_id", "form_id", "ordem_no_form"]
    assert sorted(r.form_id for r in got.collect()) == ["Form_Youtube_01", "Form_Youtube_02"]


def test_target_state(spark, world):
    _, root = world
    state = reports.refresh_state(spark, root)
    assert state.agg(F.sum("total_documentos")).first()[0] == 6


def test_train_sentiment(spark):
    path, out = scratch_path(spark, "rotulos"), scratch_path(spark, "modelo")
    data = [(f"texto bom {i}", "Positivo") for i in range(10)] + [
        (f'texto "ruim"\nlinha {i}', "Negativo") for i in range(10)] + [
        (f"texto assim {i}", "Neutro") for i in range(10)] + [("indeciso", "PENDENTE")]
    sinks.write_csv(spark.createDataFrame(data, "texto string, classificacao string"), path,
                    ["texto", "classificacao"])
    assert raw.read_labels(spark, path).count() == 31
    summary = reports.train_sentiment(spark, path, out).first()
    assert summary.f1_medio == pytest.approx(1.0) and summary.f1_desvio == pytest.approx(0.0)


def test_topic_run_end_to_end(spark, rows):
    """Fit a run, load its artefacts, assign documents of the next period."""
    def embed(texts):
        return [[float("ponte" in t), float("escola" in t), 0.1] for t in texts]

    root, raw_root = scratch_path(spark, "tabelas"), scratch_path(spark, "brutos")
    seed.run(spark, CONFIG, root)
    posts = []
    for i in range(40):
        theme = "ponte" if i % 2 else "escola"
        late = 14 * 86400 if i >= 30 else 0
        text = f"Ana Lima fala sobre {theme} nova número{i}"
        posts.append({"_id": oid(i), "id": f"t{i}", "created_utc": str(1767225600 + late),
                      "title": text, "_subreddit_busca": "cidade", "_termo_busca": "Ana Lima",
                      "_tipo_documento": "post", "processed_text": text.lower()})
    lines = [(json.dumps(r, ensure_ascii=False),) for r in posts]
    spark.createDataFrame(lines, "value string").write.text(f"{raw_root}/reddit")
    load_only = load.normalized(spark, raw_root, ["reddit"])
    assert load_only["reddit"][0].count() == 40
    load.run(spark, raw_root, root, ["reddit"])
    records = raw.read_raw(spark, f"{raw_root}/reddit", "reddit",
                           where="created_utc = '1767225600'")
    names = spark.createDataFrame([("ANA LIMA",)], "candidato string")
    docs = corpus.load(records, "reddit", names)
    assert docs.count() == 30
    vectors = spark.createDataFrame([(r.doc_id, embed([r.texto_original])[0])
                                     for r in docs.collect()], "doc_id string, embedding array<float>")
    out = scratch_path(spark, "resultado")
    topic_models.fit(docs, vectors, f"{out}/reddit/ana_lima/semana_2025-12-29", "Ana Lima",
                     "qwen_qwen3_embedding_0_6b", k_values=[2], min_df=1, n_init=2)
    words = artefacts.read_topic_words(spark, out)
    listed = [r.palavras_chave for r in words.collect()]
    assert len(listed) == 2 and not any("ana" in w or "lima" in w for w in listed)
    assert {("ponte" in w) for w in listed} == {True, False}
    assert topic_models.load(spark, out, root, windowed=True, dry_run=True).count() == 1
    assert sinks.read_table(spark, root, "modelo").count() == 0
    topic_models.load(spark, out, root, windowed=True)
    model = sinks.read_table(spark, root, "modelo").collect()
    assert [m.nome for m in model] == ["reddit_ana_lima__qwen3_0_6b__2025-12-29"]
    assert model[0].status == "vigente" and str(model[0].janela_fim) == "2026-01-04"
    assert sinks.read_table(spark, root, "documento_topico").count() == 30
    topic_models.load(spark, out, root, windowed=True)
    assert sinks.read_table(spark, root, "documento_topico").count() == 30
    assert sinks.read_table(spark, root, "topico").agg(F.sum("tamanho")).first()[0] == 30
    pairs = topic_models.infer(spark, root, out, "2026-01-08", 7, "2025-12-29", embed,
                               clean=F.lower)
    assert pairs.count() == 10
    assert sinks.read_table(spark, root, "documento_topico").count() == 40
    again = topic_models.infer(spark, root, out, "2026-01-08", 7, "2025-12-29", embed,
                               clean=F.lower)
    assert again.count() == 0
    # the vectors of known texts come from the cache table, so nothing is embedded anew
    fitted = sinks.read_table(spark, root, "documento_topico").join(pairs, "documento_id", "left_anti")
    sinks.write_table(fitted, root, "documento_topico")

    def fails(texts):
        raise RuntimeError("embedded again")

    topic_models.infer(spark, root, out, "2026-01-08", 7, "2025-12-29", fails, clean=F.lower)
    assert sinks.read_table(spark, root, "documento_topico").count() == 40

    by_density = scratch_path(spark, "densidade")
    noise = [("longe", [float(i == 2) for i in range(len(embed(["x"])[0]))])]
    far = docs.limit(1).withColumn("doc_id", F.lit("longe"))
    topic_models.fit(docs.unionByName(far), vectors.unionByName(spark.createDataFrame(noise, vectors.schema)),
                     f"{by_density}/reddit/ana_lima/semana_2025-12-29", "Ana Lima", "qwen_qwen3_embedding_0_6b",
                     min_df=1, algoritmo_clustering="hdbscan", min_topic_size=5, ngram_max=2)
    at = f"{by_density}/reddit/ana_lima/semana_2025-12-29/hdbscan/bertopic_hdbscan/qwen_qwen3_embedding_0_6b"
    rows = spark.read.option("header", True).csv(f"{at}/documentos_topicos.csv").collect()
    found = {r.doc_id: r.topico_dominante for r in rows}
    assert found.pop("longe") == "-1" and set(found.values()) == {"0", "1"} and len(found) == 30
    text = spark.read.text(f"{at}/distribuicao_topicos.txt").collect()
    assert any("Outliers (-1): 1" in r.value for r in text)
    assert spark.read.parquet(f"{at}/centroides").count() == 2


def test_hashtag_table(spark, rows):
    corpora, root = scratch_path(spark, "corpora"), scratch_path(spark, "tabelas")
    for folder, texts in (("reddit", ["#Ação já #ação", None]), ("outra", ["#x"])):
        spark.createDataFrame([(t,) for t in texts], "text_raw string").write.parquet(
            f"{corpora}/{folder}/ana_lima.parquet")
    for _ in range(2):
        table = reports.load_hashtags(spark, corpora, root)
        assert rows(table) == [("reddit", "ana_lima", "#ação", 2)]
