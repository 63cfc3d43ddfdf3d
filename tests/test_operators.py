"""Keyed writes, target resolution, skew, samples."""

import pytest
from murmurio.operators import dedup, dims, evaluation, resolve, sampling, sentiment, skew, topics, upsert, vocab
from pyspark.sql import Window
from pyspark.sql import functions as F


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --- keyed writes


def test_update_cols_is_idempotent(spark, rows):
    target = table(spark, [(1, "a", "m1"), (2, "b", None)], "k int, texto string, meta string")
    incoming = table(spark, [(2, "B", "m2"), (3, "c", "m3"), (3, "d", "m4")],
                     "k int, texto string, meta string")
    once = upsert.update_cols(target, incoming, ["k"], ["meta"], ["texto"])
    assert rows(once) == [(1, "a", "m1"), (2, "b", "m2"), (3, "c", "m3")]
    assert rows(upsert.update_cols(once, incoming, ["k"], ["meta"], ["texto"])) == rows(once)


def test_empty_sides(spark, rows):
    schema = "k int, v string"
    some, none = table(spark, [(1, "a")], schema), table(spark, [], schema)
    assert rows(upsert.insert_ignore(none, some, ["k"], ["v"])) == [(1, "a")]
    assert rows(upsert.insert_ignore(some, none, ["k"], ["v"])) == [(1, "a")]
    assert rows(upsert.update_cols(none, none, ["k"], ["v"], ["v"])) == []
    assert rows(upsert.merge_fields(some, none, ["k"], ["v"])) == [(1, "a")]
    assert rows(upsert.insert_counts(some, none, ["k"])) == [(0, 0)]


def test_reviewed_label_stays(spark, rows):
    schema = ("id bigint, modelo_id bigint, numero int, rotulo string, revisado boolean,"
              " palavras_chave array<string>, tamanho bigint, descricao string")
    old = table(spark, [(1, 1, 0, "meu", True, ["a"], 1, "d"), (2, 1, 1, "seu", False, ["b"], 1, "e")],
                schema)
    new = table(spark, [(1, 1, 0, "x", False, ["c"], 5, "y"), (2, 1, 1, "z", False, ["d"], 6, None)],
                schema)
    got = rows(upsert.upsert_topics(old, new), "numero", "rotulo", "revisado", "tamanho", "descricao")
    assert got == [(0, "meu", True, 5, "d"), (1, "z", False, 6, None)]


def test_merge_fields_absent_is_not_null(spark, rows):
    target = table(spark, [(1, "a", "b")], "k int, x string, y string")
    incoming = table(spark, [(1, 1, None, "q", ["x"]), (1, 2, "z", None, ["y"]),
                             (2, 1, "n", None, ["x"])],
                     "k int, ordem int, x string, y string, campos array<string>")
    got = upsert.merge_fields(target, incoming, ["k"], ["ordem"], "campos")
    assert rows(got) == [(1, None, None), (2, "n", None)]
    assert rows(upsert.merge_counts(target, incoming, ["k"])) == [(1, 1)]


# --- targets


def alvo(spark, data):
    return table(spark, data, "id bigint, fonte_codigo string, entidade_codigo string,"
                              " canal string, termo_busca string")


def test_ambiguous_target_raises(spark):
    good = alvo(spark, [(1, "reddit", "a", "brasil", "x"), (2, "reddit", "b", "brasil", "y")])
    assert resolve.assert_unique(good) is good
    bad = alvo(spark, [(1, "reddit", "a", "brasil", "x"), (2, "reddit", "b", "brasil", "x")])
    with pytest.raises(ValueError, match="ambiguous"):
        resolve.assert_unique(bad)


def test_fallback_and_rejects(spark, rows):
    targets = alvo(spark, [(1, "reddit", "a", "brasil", "x"), (2, "reddit", "a", "r/outro", "x")])
    docs = table(spark, [("d1", "reddit", "brasil", "x"), ("d2", "reddit", "r/brasil", "x"),
                         ("d3", "reddit", " outro ", "x "), ("d4", "reddit", "nada", "x"),
                         ("d5", "reddit", None, "x")],
                 "id string, fonte string, canal string, termo_busca string")
    got = resolve.with_fallback(docs, targets).select("id", "alvo_coleta_id")
    assert rows(got) == [("d1", 1), ("d2", 1), ("d3", 2), ("d4", None), ("d5", None)]
    assert rows(resolve.rejects(docs, targets), "id") == [("d2",), ("d3",), ("d4",), ("d5",)]


def test_merge_targets_keeps_canonical_documents(spark, rows):
    targets = alvo(spark, [(1, "meta", "velho", "p", ""), (2, "meta", "novo", "p", ""),
                           (3, "meta", "outro", "q", "")])
    identities = table(spark, [("meta", "p", "novo"), ("meta", "q", "renomeado")],
                       "fonte_codigo string, canal string, entidade_codigo string")
    moves = resolve.canonical_targets(targets, identities)
    docs = table(spark, [(10, 1, "n1"), (11, 2, "n1"), (12, 1, "n2"), (13, 3, "n1")],
                 "id bigint, alvo_coleta_id bigint, id_nativo string")
    assert rows(resolve.merge_target_documents(docs, moves), "id", "alvo_coleta_id") == [
        (11, 2), (12, 2), (13, 3)]
    assert rows(resolve.merge_targets(targets, moves), "id", "entidade_codigo") == [
        (2, "novo"), (3, "renomeado")]


def test_channel_lookup(spark, rows):
    channels = table(spark, [(0, "Canal A", "UC1"), (1, "UC1", "UC2"), (2, None, "UC3")],
                     "posicao int, nome string, channel_id string")
    asked = table(spark, [("canal a",), ("uc1",), ("UC9",), ("uc3",)], "pedido string")
    assert rows(resolve.channel(asked, channels), "pedido", "nome", "channel_id") == [
        ("UC9", "UC9", "UC9"), ("canal a", "Canal A", "UC1"), ("uc1", "Canal A", "UC1"),
        ("uc3", "", "UC3")]


# --- skew


@pytest.fixture(scope="module")
def skewed(spark):
    """One key owns a third of 60,000 rows, another third has no key."""
    return spark.range(60000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("quente"))
        .when(F.col("id") % 3 == 1, (F.col("id") % 500).cast("string")).alias("chave")).cache()


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_salted_join_equals_plain(spark, skewed, how):
    right = spark.range(0, 400, 2).select(F.col("id").cast("string").alias("chave"),
                                          (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([("quente", -1)], "chave string, v bigint"))
    assert ("quente",) in skew.hot_keys(skewed, ["chave"])
    salted = skew.salted_join(skewed, right, ["chave"], ["id"], how)
    plain = skewed.join(right, ["chave"], how).select(*salted.columns)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salt_spreads_the_hot_key(spark, skewed):
    right = spark.createDataFrame([("quente", 1)], "chave string, v bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = skew.salted_join(skewed, right, ["chave"], ["id"])
        sizes = [r["n"] for r in out.where("chave = 'quente'").groupBy(
            F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 20000 and max(sizes) < 12000 and len(sizes) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_per_key_limits_before_the_shuffle(spark, skewed):
    assert "WindowGroupLimit" in plan_of(skew.first_per_key(skewed, ["chave"], ["id"]))
    assert "WindowGroupLimit" in plan_of(skew.top_per_key(skewed, ["chave"], ["id"], 50))


def test_draw_rank_equals_window(spark, skewed):
    ranked = skew.draw_rank(skewed.select("id", "chave"), 7, "id", by=["chave"], digits=2)
    w = Window.partitionBy("chave").orderBy(skew.draw_key(7, "id"), "id")
    plain = skewed.where("chave is not null").withColumn("posicao", F.row_number().over(w))
    left = ranked.where("chave is not null").select("id", F.col("posicao").cast("int"))
    assert left.exceptAll(plain.select("id", "posicao")).count() == 0
    assert left.count() == plain.count()


# --- samples and folds


@pytest.mark.parametrize("n, forms", [(0, 10), (3, 10), (10, 10), (23, 10), (100, 7)])
def test_forms_are_balanced(spark, n, forms):
    sample = spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("id_origem"),
                                   F.lit(" um  texto\nsimples ").alias("texto"),
                                   F.lit(None).cast("string").alias("contexto"),
                                   F.lit("youtube").alias("rede_social"))
    got = sampling.assign_forms(sample, "id_origem", forms).orderBy("item_id").collect()
    assert [r.item_id for r in got] == [f"YOUTUBE_{i + 1:04d}" for i in range(n)]
    sizes = {}
    for r in got:
        sizes[r.form_id] = sizes.get(r.form_id, 0) + 1
        assert r.ordem_no_form == sizes[r.form_id] and r.texto == "um texto simples"
    expected = [n // forms + (1 if i < n % forms else 0) for i in range(forms)]
    assert [sizes.get(f"Form_Youtube_{i + 1:02d}", 0) for i in range(forms)] == expected


def test_folds_are_stratified(spark, skewed):
    folds = evaluation.kfold(skewed.where("id < 999").select("id", F.coalesce("chave", F.lit(
        "-")).alias("classe")), "id")
    for r in folds.groupBy("classe").pivot("fold", [1, 2, 3, 4, 5]).count().fillna(0).collect():
        sizes = [r[str(i)] for i in range(1, 6)]
        assert max(sizes) - min(sizes) <= 1


def test_valid_comments(spark):
    raw = table(spark, [("1", "comentario", "x" * 15), ("2", "comentario", "x" * 14),
                        ("3", "comentario", None), ("4", "post", "x" * 20),
                        ("5", "comentario", "[removed]"), ("6", "comentario", "é" * 15)],
                "id string, _tipo_documento string, body string")
    assert [r.id for r in sampling.valid_reddit_comments(raw).orderBy("id").collect()] == ["1", "6"]


# --- vocabulary and topics


def test_destem_covers_every_stem(spark, rows):
    pairs = table(spark, [("corr", "correr"), ("corr", "corre"), ("corr", "corre"),
                          ("açã", "ação"), ("aca", "acaso")], "raiz string, palavra string")
    got = rows(vocab.destem(pairs))
    assert got == [("aca", "acaso"), ("açã", "ação"), ("corr", "corre")]


def test_drop_words_is_a_set_operation(spark, rows):
    docs = table(spark, [(1, "a b a c"), (1, "d b e"), (2, "b"), (3, None), (4, ""), (1, "a b a c")],
                 "id int, t string")
    words = table(spark, [("a",), ("b",), ("b",), (None,)], "palavra string")
    assert rows(vocab.drop_words(docs, "t", words), "id", "t") == [
        (1, "c"), (1, "c"), (1, "d e"), (2, ""), (3, None), (4, "")]
    assert rows(vocab.drop_words(docs, "t", words.limit(0)), "id", "t") == rows(docs, "id", "t")


def test_drop_words_looks_words_up_by_hash_in_short_and_long_lists(spark, rows, monkeypatch):
    docs = table(spark, [(1, "a b  a c"), (2, " b"), (3, None), (4, ""), (5, "x"), (1, "a b  a c")], "id int, t string")
    words = table(spark, [("a",), ("b",), (None,)], "palavra string")
    for limit in (vocab.LISTED_BYTES, -1):
        monkeypatch.setattr(vocab, "LISTED_BYTES", limit)
        got = vocab.drop_words(docs, "t", words)
        assert rows(got, "id", "t") == [(1, " c"), (1, " c"), (2, ""), (3, None), (4, ""), (5, "x")]
        assert "array_contains" not in got._jdf.queryExecution().toString()


def test_expand_stopwords_counts_its_words_once(spark, rows):
    words = table(spark, [("ação",), ("acao",), ("fim",)], "palavra string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(word):
        seen.add(1)
        return word

    base = words.where("palavra = 'ação'").select(counted("palavra").alias("palavra"))
    assert rows(vocab.expand_stopwords(base, words)) == [("acao",), ("ação",)]
    assert seen.value == 1


def test_ngrams_of_lists_of_any_length(spark, rows, monkeypatch):
    docs = table(spark, [(0, "a b c"), (0, "b"), (1, "c a d")], "numero int, t string")
    stop = table(spark, [("b",), ("b",), (None,)], "palavra string")
    expected = [(0, "a", 1), (0, "a c", 1), (0, "c", 1), (1, "a", 1), (1, "a d", 1), (1, "c", 1), (1, "c a", 1), (1, "d", 1)]
    for limit, kind in ((vocab.BROADCAST_BYTES, True), (-1, False)):
        monkeypatch.setattr(vocab, "BROADCAST_BYTES", limit)
        got = topics.term_counts(docs, F.split("t", " "), stopwords=stop, ngram_max=2)
        assert rows(got) == sorted(expected, key=repr)
        assert ("strategy=broadcast" in got._jdf.queryExecution().toString()) == kind


def test_cross_validation_takes_texts_apart_once(spark, monkeypatch):
    texts = [(i, ("bom dia " if i % 2 else "mau tempo ") + f"w{i % 5}", i % 2) for i in range(60)]
    data = table(spark, texts, "doc int, texto_limpo string, classe int")
    split = evaluation.kfold(data, "doc", "classe", 3, 42).persist()
    expected = {}
    for fold in (1, 2, 3):
        model = sentiment.fit(split.where(F.col("fold") != fold).drop("fold"), 256)
        expected |= {r.doc: (r.fold, r.previsto) for r in sentiment.predict(model, split.where(F.col("fold") == fold)).collect()}
    calls, features = [], sentiment._features
    monkeypatch.setattr(sentiment, "_features", lambda df: calls.append(1) or features(df))
    got = sentiment.cross_validate(data, "doc", 3, 42, 256)
    assert sorted(got.columns) == sorted([*data.columns, "fold", "previsto"])
    assert {r.doc: (r.fold, r.previsto) for r in got.collect()} == expected
    assert len(calls) == 1


def test_exact_duplicates_of_repeated_and_null_ids(spark, rows):
    docs = table(spark, [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None), (3, None), (4, ""), (0, "a")],
                 "id int, t string")
    assert rows(dedup.exact(docs, "t", "id")) == [(0, "a"), (2, None), (4, ""), (None, "b")]
    plan = dedup.exact(docs, "t", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan


def test_null_ids_are_drawn_apart(spark):
    docs = spark.range(3000).selectExpr("cast(null as bigint) AS id", "id AS n")
    got = skew.draw_rank(docs, 1, "id")
    assert sorted(r.posicao for r in got.collect()) == list(range(1, 3001))
    draws = docs.select(F.to_json(F.struct("id", "n")).alias("x")).select(skew.draw_key(1, "x").alias("d"))
    assert draws.distinct().count() == 3000


def test_outliers_are_never_described(spark, rows):
    docs = table(spark, [(1, [0.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [9.0, 9.0], -1),
                         (4, [5.0, 5.0], 1)], "id bigint, v array<double>, numero int")
    assert rows(topics.centroids(docs, "v")) == [(0, [1.0, 0.0]), (1, [5.0, 5.0])]
    assert {r.numero for r in topics.examples(docs, "id", "v").collect()} == {0, 1}
    near = topics.assign(docs, "v", topics.centroids(docs, "v"))
    assert rows(near, "id", "numero") == [(1, 0), (2, 0), (3, 1), (4, 1)]
    summary = topics.distribution_summary(docs).first()
    assert (summary.total, summary.topicos, summary.outliers, summary.maior) == (4, 2, 1, 0)


def test_enum_and_registered(spark):
    df = table(spark, [("post",), ("x",), (None,)], "tipo string")
    good, bad = dims.check_enum(df, "tipo", ["post"])
    assert (good.count(), bad.count()) == (1, 2)


def test_processed_is_the_presence_of_the_field(spark, tmp_path):
    from murmurio.operators import monitor
    from murmurio.sources import raw

    lines = ['{"_id": "%024x", "id": "a", "processed_text": null}' % 1, '{"_id": "%024x", "id": "b"}' % 2,
             '{"_id": "%024x", "id": "c", "processed_text": "x"}' % 3, "no json"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/reddit")
    read = raw.read_raw(spark, f"{tmp_path}/reddit", "reddit", presence=True, columns=["_id", "id", "campos"])
    read = read.withColumns({"fonte": F.lit("reddit"), "alvo_coleta_id": F.lit(1)})
    got = {r.id_nativo: r.processado for r in monitor.audit_records(read, "id").collect()}
    assert got == {"a": True, "b": False, "c": True, None: False}


def test_merges_equal_average_linkage_one_at_a_time(spark):
    import random

    from murmurio.operators import topics

    rnd = random.Random(1)
    pairs = {(a, b): rnd.choice([0.1, 0.5, rnd.random()]) for a in range(9) for b in range(a + 1, 9)}
    groups, expected = {i: [i] for i in range(9)}, []

    def mean(a, b):
        every = [pairs[min(x, y), max(x, y)] for x in groups[a] for y in groups[b]]
        return round(sum(every) / len(every), 9)

    while len(groups) > 1:
        s, a, b = min((-mean(a, b), a, b) for a in groups for b in groups if a < b)
        expected.append((a, b, -s))
        groups[a] += groups.pop(b)
    df = spark.createDataFrame([(a, b, s) for (a, b), s in pairs.items()], "a int, b int, cosseno double")
    got = [(r.a, r.b, r.semelhanca) for r in topics.merge_order(df).orderBy("ordem").collect()]
    assert sorted(got) == sorted(expected) and [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
    assert topics.merge_order(df.limit(0)).collect() == []


def test_ngrams_and_reduced_topics(spark):
    from murmurio.operators import topics

    docs = spark.createDataFrame([(1, 0, "alfa beta de gama"), (1, 0, "de beta alfa"), (3, 1, "x"), (4, -1, "alfa"),
                                  (5, 1, ""), (6, 1, None), (7, 2, "x y de z")], "id int, numero int, t string")
    stop = spark.createDataFrame([("de",), ("",)], "palavra string")
    counts = topics.term_counts(docs, F.split("t", " "), stopwords=stop, ngram_max=2)
    assert sorted(map(tuple, counts.collect())) == [
        (0, "alfa", 2), (0, "alfa beta", 1), (0, "beta", 2), (0, "beta alfa", 1), (0, "beta gama", 1), (0, "gama", 1),
        (1, "x", 1), (2, "x", 1), (2, "x y", 1), (2, "y", 1), (2, "y z", 1), (2, "z", 1)]
    weights = topics.ctfidf(topics.term_counts(docs, F.split("t", " "), stopwords=stop))
    reduced = topics.reduce_topics(docs.select("id", "numero"), weights, 2)
    # 1 and 2 share a word, so they are one now, and the largest
    assert sorted(map(tuple, reduced.collect())) == [(1, 1), (1, 1), (3, 0), (4, -1), (5, 0), (6, 0), (7, 0)]
    assert topics.reduce_topics(docs.select("id", "numero"), weights, 5).where("numero = 2").count() > 0
