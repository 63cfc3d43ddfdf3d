"""SentencePiece encoding against the library, on whole texts, single code points and random ids."""

import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from murmurio.llm import piecebpe

SCHEMA = "doc_id long, text string, n_tokens string, ids int, decoded int, agrees string, lang string"
TEXTS = [None, "", " ", "   ", "a", " a  b   c ", "Hello, world!  Twice\n\n\tand\r\n more.", "▁ ▁▁ a▁b ▁", "<s> </s> <unk> <0x41>",
         "x" * 3000, "aB" * 500 + " " + "é" * 200, "日本語 テキスト 👩‍👩‍👧 ﬁ ½ ² ① é", "a\x00b \x01", "1234567890 3.14e-10",
         " ".join(f"word{i % 97},{i}" for i in range(20_000)), "don't stop-believing... (ever) #tag @me http://x.y/?q=1&z=2",
         "theory " * 70, "ﷺ​﻿ 　x\xa0y", "don't stop-believing... (ever) #tag @me http://x.y/?q=1&z=2"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piecebpe.vocabulary_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, "x", i, i, "y", "en") for i, t in enumerate(TEXTS)] + [(None, "no key", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_ids_and_texts_equal_the_library(frame, library):
    rows = piecebpe.decode(piecebpe.encode(frame)).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert r.ids == library.encode(r.text or ""), repr(r.text)[:80]
        assert r.decoded == library.decode(r.ids)


def test_digests(frame, library):
    out = piecebpe.digests(frame)
    assert out.columns == ["doc_id", "ids", "decoded", "agrees", "lang", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in out.where("doc_id is not null").collect():
        ids = library.encode(TEXTS[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert piecebpe.digests(frame.limit(0)).count() == 0
    assert piecebpe.encode(frame.where(F.lit(False))).count() == 0


def test_every_code_point_of_some_planes(library):
    bpe = piecebpe.load(None)
    for c in [*range(0x3400), *range(0xA000, 0xA100), *range(0xF900, 0x10000), *range(0x1F300, 0x1F700), *range(0xE0000, 0xE0080)]:
        text = f"a{chr(c)} {chr(c)}b{chr(c)}{chr(c)} 1{chr(c)}"
        assert bpe.encode(text) == library.encode(text), hex(c)


def test_random_ids_decode_as_the_library_does(library):
    bpe, rnd = piecebpe.load(None), random.Random(5)
    for _ in range(5000):
        ids = [rnd.choice([rnd.randrange(3, 259), rnd.randrange(32000)]) for _ in range(rnd.randrange(9))]
        assert bpe.decode(ids) == library.decode(ids), ids


def test_random_texts_with_small_caches(library, monkeypatch):
    monkeypatch.setattr(piecebpe, "CACHE", 5)
    monkeypatch.setattr(piecebpe, "FEW", 6)  # so the heap serves most parts
    bpe, rnd = piecebpe.PieceBpe(piecebpe.vocabulary_path("piece_bpe_32k.model")), random.Random(6)
    for _ in range(3000):
        text = "".join(rnd.choice("  ▁aeionrst.,'-12éñ\n") for _ in range(rnd.randrange(60)))
        assert bpe.encode(text) == library.encode(text), text


def test_ids_unlike_the_library_are_an_error():
    bpe = piecebpe.PieceBpe(piecebpe.vocabulary_path("piece_bpe_32k.model"))
    bpe.encode_batch(["some  text", "the words of it", "", None])
    bpe.entry.clear()
    for text in ("other words", "two  spaces"):
        with pytest.raises(ValueError, match="differ"):
            bpe.encode_batch([text])
