"""Text functions on the edge rows and against plain Python."""

import re
import unicodedata

import pytest
from murmurio.functions import json as J
from murmurio.functions import text as X
from murmurio.functions.wordlists import GENERIC_NOISE
from pyspark.sql import functions as F

EDGES = [
    None, "", " ", "quatorze chars", "quinze  letrass", "[removed]", " [Deleted] ", "a\x00b",
    "Ação #Eleição æß STRAẞE", "\nlinha", "gooool!!! ha ha ha ha", "a a a b", "x  x", "um um-um",
    "http://a.b/c d www.e.f g", "@fulano oi #tag fim", "<b>oi</b> <i\n>", "a\\) b\\c (d) [e] {f}|~",
    "3 gatos 12", "falando correr ndo r ndor", "d'água e-mail _x_ ²½", "İstanbul ÇÃO",
    "tab\tquebra\r\nfim largo　", "😀 emoji ™ … “aspas” – —", "é combinado ﬁ Ǆ",
    "Ωμέγα кириллица 漢字",
]


@pytest.fixture(scope="module")
def texts(spark):
    listed = EDGES + [r.text for r in spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    return spark.createDataFrame(list(enumerate(listed)), "i int, t string").cache()


def evaluate(texts, column):
    got = texts.select("i", "t", column.alias("v")).orderBy("i").collect()
    return [(r.t, r.v) for r in got]


def is_word(ch):
    return ch.isalnum() or ch == "_"


def words_and_gaps(s):
    """Maximal runs of word characters and of the others, in turn."""
    runs, kind = [], None
    for ch in s:
        if kind is not None and is_word(ch) == kind:
            runs[-1] += ch
        else:
            runs.append(ch)
            kind = is_word(ch)
    return runs


def repeated_words(s):
    runs, out, i = words_and_gaps(s), [], 0
    while i < len(runs):
        out.append(runs[i])
        if (is_word(runs[i][0]) and i + 2 < len(runs) and runs[i + 1].isspace()
                and runs[i + 2] == runs[i]):
            i += 2
        i += 1
    return "".join(out)


def short_words(s, n=3):
    out, runs = [], words_and_gaps(s)
    for k, run in enumerate(runs):
        if is_word(run[0]) and len(run) <= n:
            continue
        if k and is_word(runs[k - 1][0]) and len(runs[k - 1]) <= n and run.startswith(" "):
            run = run[1:]
        out.append(run)
    return "".join(out).strip()


def collapse(s):
    out = ""
    for ch in s:
        if ch == "\n" or not (len(out) > 1 and out[-1] == ch == out[-2]):
            out += ch
    return out


def accents(s, form="NFKD"):
    return "".join(c for c in unicodedata.normalize(form, s) if not unicodedata.combining(c))


def stop(s, words):
    out, runs = [], words_and_gaps(s)
    for k, run in enumerate(runs):
        if is_word(run[0]) and run in words:
            continue
        if k and is_word(runs[k - 1][0]) and runs[k - 1] in words:
            run = run.lstrip(" ")
        out.append(run)
    return "".join(out).strip()


PYTHON = {
    "strip": (X.strip, str.strip),
    "repeated": (X.remove_repeated_words, repeated_words),
    "short": (lambda c: X.remove_short_words(c, 3), short_words),
    "collapse": (X.collapse_chars, collapse),
    "accents": (X.remove_accents, accents),
    "squeeze": (X.squeeze_spaces, lambda s: " ".join(s.split())),
    "numbers": (lambda c: X.remove_numbers(c, "filter"),
                lambda s: "" if any(ch in "0123456789" for ch in s) else s),
    "hashtags": (lambda c: F.array_join(X.extract_hashtags(c), " "),
                 lambda s: " ".join(m for m in re.findall(r"#\w+", s.lower()))),
    "stopwords": (lambda c: X.remove_stopwords(c, GENERIC_NOISE + ["um", "a", "the"]),
                  lambda s: stop(s, set(GENERIC_NOISE + ["um", "a", "the"]))),
    "alnum": (X.alnum_slug, lambda s: "".join(c if c.isalnum() else "_" for c in s.lower())),
    "tokens": (lambda c: F.array_join(X.tokens(c), " "), lambda s: " ".join(s.split())),
    "removed": (X.clear_removed_marker,
                lambda s: "" if s.strip().lower() in ("[removed]", "[deleted]") else s.strip()),
}


# Java lower-cases the dotted capital I to two characters as Python does, but Spark's translate
# works on NFKD tables up to U+24FF: wide scripts stay as they are.
WIDE = {"　", "漢"}


@pytest.mark.parametrize("name", sorted(PYTHON))
def test_equals_python(texts, name):
    column, plain = PYTHON[name]
    for text, got in evaluate(texts, column(F.col("t"))):
        if text is None:
            assert got in (None, ""), name
        elif not (name == "accents" and any(w in text for w in WIDE)):
            assert got == plain(text), (name, text)


def test_lowercase_unidecode(spark):
    df = spark.createDataFrame([("Ação STRAßE æœøł “x” – … ½ ™ 😀!",)], "t string")
    assert df.select(X.lowercase_unidecode("t")).first()[0] == 'acao strasse aeoeol "x" - ... 1/2 tm !'


def test_punctuation_keeps_other_backslashes(spark):
    df = spark.createDataFrame([("a\\)b\\c, d.\r\ne",)], "t string")
    assert df.select(X.remove_punctuation("t")).first()[0] == "a b\\c d e"


def test_stopword_phrases(spark):
    df = spark.createDataFrame([("copo d'água fria d'águas",)], "t string")
    assert df.select(X.remove_stopwords("t", ["d'água", "fria"])).first()[0] == "copo d'águas"


def test_slugs(spark):
    df = spark.createDataFrame([("  Zé d'Ávila & Cia! ",), ("***",)], "t string")
    assert [r[0] for r in df.select(X.slugify("t")).collect()] == ["ze_d_avila_cia", ""]
    assert [r[0] for r in df.select(X.slug("t")).collect()] == ["zé_dávila_cia", "sem_nome"]


def test_term_variants(spark):
    df = spark.createDataFrame([(" Zé Ramos ",), ("Ana",), ('"Zé R"',)], "t string")
    got = [r[0] for r in df.select(X.term_variants("t")).collect()]
    assert got == [['"Zé Ramos"', '"Ze Ramos"'], ["Ana"], ['"Zé R"', '"Ze R"']]


def test_strip_nul_in_json(spark):
    df = spark.createDataFrame([("a\x00b", "c\\u0000d")], "x string, y string")
    assert df.select(J.metadata_json(x="x", y="y", z=F.lit(None).cast("string"))).first()[0] == (
        '{"x":"ab","y":"c\\\\u0000d","z":null}')


def test_preprocess_blank_and_null(spark):
    df = spark.createDataFrame([(None,), (" ",), ("de um a",)], "t string")
    assert [r[0] for r in df.select(X.preprocess("t", ["de"])).collect()] == ["", "", ""]


def test_preprocess_chain(spark):
    df = spark.createDataFrame(
        [("Vejam a AÇÃO goooool 123 @fulano http://x.y/z, falando... dos dos votos",)], "t string")
    assert df.select(X.preprocess("t", ["vejam"])).first()[0] == "acao gool falando votos"


def test_join_text(spark):
    df = spark.createDataFrame([(" a ", None, ""), (None, " ", None)], "a string, b string, c string")
    assert [r[0] for r in df.select(X.join_text("a", "b", "c")).collect()] == ["a", None]
    assert [r[0] for r in df.select(X.concat_columns("a", "b", "c")).collect()] == [" a   ", "   "]


def test_lowered_texts_are_not_lowered_again(spark):
    df = spark.createDataFrame([("ÀÉ ß… 日本 x😀y",), ("plain",), (None,)], "t string")
    whole, lowered = X.lowercase_unidecode("t"), X.lowercase_unidecode(F.lower("t"), lowered=True)
    got = df.select(whole.alias("a"), lowered.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    plan = df.select(X.preprocess("t", ["x"]).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("lower(") == 1
