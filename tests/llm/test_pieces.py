"""SentencePiece encoding and decoding against the library on the public model."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewright.llm import pieces
from tidewright.llm.queries import PIECES, QUERIES

SMALL = "/root/testdata/sf0.001"
PARTS = ["a", "b", "e", "t", "h", " ", "  ", "▁", "\n", "ab", "the", " the", "é", "🤖", "\x00", "ñ", "0", "1", ".", ",", "--", "=====", "²", ".",
         "́", "中", "國", "ing", "aaaa", "    ", "\t", "//", "_", "﻿", "'s", "<s>", "</s>", "<unk>", "<0x41>", " ", " "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PIECES)


def ids_of(packed):
    return np.frombuffer(packed, "<i4").tolist()


def test_random_texts(library, model):
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcdetionsr") for _ in range(rng.randint(0, 300))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0x2FF), rng.randint(0x400, 0x9FFF), rng.randint(0x1F300, 0x1F9FF)])) for _ in range(40)) for _ in range(500)]
    texts += ["", " ", "a", None, "a" * 5000, "ab" * 3000, "=" * 4000, " " * 3000 + "x", "-=-" * 999, "the quick" * 500]
    for text, packed in zip(texts, model.encode(texts)):
        want = library.encode(text or "")
        assert ids_of(packed) == want, repr(text)
        assert model.decode(packed) == library.decode(want), repr(text)


def test_long_words_take_no_quadratic_time(library, model):
    for text in (" " * 200_000 + "end", "=" * 100_000, "aab" * 50_000):
        packed = model.encode([text])[0]
        assert ids_of(packed) == library.encode(text) and model.decode(packed) == text


def test_caches_end_without_effect(library, model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    monkeypatch.setattr(pieces, "SLICE_CHARS", 20)
    texts = ["one two three", "four five six", "one two three", "seven\neight  nine", "x" * 50]
    assert [ids_of(x) for x in model.encode(texts)] == [library.encode(t) for t in texts]


def test_any_ids_decode_like_the_library(library, model):
    rng = random.Random(12)
    pool = [0, 1, 2, 259, 260, 261, 28705]
    for _ in range(5000):
        ids = [rng.choice([*pool, rng.randint(3, 258), rng.randint(100, 258), rng.randint(3, 31999)]) for _ in range(rng.randint(0, 8))]
        assert model.decode(np.array(ids, "<i4").tobytes()) == library.decode(ids), ids
    assert model.decode(np.array([-1, 264, 99999], "<i4").tobytes()) == library.decode([264])


def test_columns(spark, library):
    texts = ["A house.\nTwo  houses!", "", None, "é " * 30, "same", "same", "w" * 20_000]
    rows = [(i, t, "ids", "decoded", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string, pieces int").repartition(3)
    both = docs.withColumn("coded", pieces.round_trip(F.col("text"), PIECES)).withColumn("alone", pieces.encode(F.col("text"), PIECES))
    both = both.withColumn("back", pieces.decode(F.col("alone"), PIECES))
    got = both.collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r.doc_id] or "")
        assert r.coded.ids == r.alone == want and r.coded.decoded == r.back == library.decode(want) and r.ids == "ids"
    nothing = docs.where("doc_id < 0")
    assert nothing.select(pieces.round_trip(F.col("text"), PIECES).alias("c")).count() == 0
    null = spark.range(1).select(pieces.decode(F.lit(None).cast("array<int>"), PIECES).alias("t"))
    assert null.first().t == ""


def test_query(spark, library):
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op12_sentencepiece"](spark, SMALL).collect()
    assert {r.doc_id for r in got} == set(text)
    for r in got:
        ids = library.encode(text[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_other_kinds_of_model_are_refused(tmp_path):
    whole = pieces.model_file.ModelProto()
    with open(PIECES, "rb") as f:
        whole.ParseFromString(f.read())
    whole.normalizer_spec.precompiled_charsmap = b"x"
    path = tmp_path / "other.model"
    path.write_bytes(whole.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Pieces(str(path))
