"""Readers on real file trees."""

import os

from murmurio.operators import dims, upsert
from murmurio.session import scratch_path, shared_folder
from murmurio.sources import artefacts, raw, sinks


def put(path, text=""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def run_files(root, folder, encoder, words="0 - um dois\n", assigned="papers,dominant_topic\nd1,0\n",
              labels=None):
    at = f"{root}/{folder}/bertopic_kmeans/{encoder}"
    put(f"{at}/result_topic_2.txt", words)
    if assigned is not None:
        put(f"{at}/Resumo_Topicos_Dominantes.csv", assigned)
    if labels:
        put(f"{at}/rotulos_topicos.json", labels)
    return at


QWEN = "qwen_qwen3_embedding_0_6b"
MINILM = "sentence_transformers_all_minilm_l12_v2"


def test_runs_and_contents(spark, rows):
    root = scratch_path(spark, "arvore")
    at = run_files(root, "reddit/ana lima+1/k15", QWEN,
                   "cabeçalho\n0 - um  dois\n1 - tres\n0 - quatro\n",
                   'papers,dominant_topic\n"a,b",0\nc,-1\n',
                   '{"0": "rótulo", "1": {"titulo": "t", "descricao": "d"}}')
    run_files(root, "reddit/old/k15", QWEN)
    run_files(root, "vk/x/k15", QWEN)
    run_files(root, "meta/y/k5", MINILM, assigned=None)
    run_files(root, "meta/y/k10", "outro_encoder")
    run_files(root, "meta/z/k5", MINILM)
    runs = artefacts.discover_runs(spark, root)
    assert rows(runs, "fonte_codigo", "entidade_codigo", "k", "encoder", "tem_rotulos") == [
        ("meta", "z", 5, "minilm_l12", False), ("reddit", "ana lima+1", 15, "qwen3_0_6b", True)]
    words = [r for r in artefacts.read_topic_words(spark, root).collect()
             if r.run.endswith(at.split("/arvore")[1])]
    assert sorted((r.numero, r.palavras_chave) for r in words) == [(0, ["quatro"]), (1, ["tres"])]
    assigned = artefacts.read_assignments(spark, root)
    assert rows(assigned.where(assigned.run.contains("ana lima")), "id_nativo", "numero") == [
        ("a,b", 0), ("c", -1)]
    assert rows(artefacts.read_topic_labels(spark, root), "numero", "rotulo", "descricao") == [
        (0, "rótulo", None), (1, "t", "d")]


def test_windows(spark, rows):
    root = scratch_path(spark, "arvore")
    run_files(root, "reddit/a/2026-01-02/k5", QWEN)
    run_files(root, "reddit/a/2026-01-02/k10", MINILM)
    run_files(root, "meta/b/semana_2026-01-05/k5", QWEN)
    run_files(root, "meta/b/semana_2026-13-05/k5", QWEN)
    run_files(root, "meta/b/2026-01-09/k5", QWEN, assigned=None)
    got = artefacts.discover_windows(spark, root).selectExpr(
        "entidade_codigo", "k", "string(janela_inicio)", "string(janela_fim)")
    # 'k10' comes before 'k5' by name
    assert rows(got) == [("a", 10, "2026-01-02", "2026-01-02"), ("b", 5, "2026-01-05", "2026-01-11")]


def test_photos(spark, rows):
    folder = scratch_path(spark, "fotos")
    for name in ("ana_lima.jpg", "ze.ramos.png"):
        put(f"{folder}/{name}", "x")
        os.utime(f"{folder}/{name}", (1700000000, 1700000000))
    files = artefacts.read_photos(spark, folder)
    entity = spark.createDataFrame([("ana_lima", None), ("otto", "/fotos/otto.jpg?v=1")],
                                   "codigo string, foto string")
    assert rows(upsert.update_photos(entity, files)) == [
        ("ana_lima", "/fotos/ana_lima.jpg?v=1700000000"), ("otto", "/fotos/otto.jpg?v=1")]
    assert rows(upsert.unmatched_photos(entity, files), "codigo", "arquivo") == [
        ("ze.ramos", "ze.ramos.png")]


def test_corrupt_line_is_kept(spark):
    path = scratch_path(spark, "linhas")
    put(f"{path}/a.json", '{"id":"1","body":null}\nnão é json\n{"id":"2"}\n')
    df = raw.read_raw(spark, path, "reddit")
    assert df.count() == 3
    flagged = raw.read_raw(spark, path, "reddit", presence=True)
    got = {r.id: (r.campos, r._corrupt_record) for r in flagged.collect()}
    assert got["1"] == (["id", "body"], None) and got["2"] == (["id"], None)
    assert got[None][1] == "não é json"


def test_versions(spark, rows):
    root = scratch_path(spark, "tabelas")
    assert sinks.read_table(spark, root, "fonte").count() == 0
    first = sinks.write_table(dims.load_sources(spark), root, "fonte")
    assert first.count() == 3
    second = sinks.write_table(first.where("codigo <> 'meta'"), root, "fonte")
    assert rows(second, "codigo") == [("reddit",), ("youtube",)]
    # a version that was never finished is not read
    os.makedirs(f"{root}/fonte/v=3")
    assert sinks.read_table(spark, root, "fonte").count() == 2


def test_config_keeps_last_page_and_first_name(spark, rows):
    frames = dims.load_config(spark, {"meta": {"perfis": [
        {"nome": "Zé Ramos", "page_id": "1"}, {"nome": "Ze Ramos", "page_id": "2"}]}})
    assert rows(dims.entities(frames["perfis"])) == [("ze_ramos", "Zé Ramos", "2")]


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
