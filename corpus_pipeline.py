"""Corpus preparation in stages; each stage works on all that the one before kept.

Every stage is (spark, docs, sf_dir) -> DataFrame and returns the columns of
``documents``, but for the last, which adds the encoding. Null and repeated rows,
empty texts and empty tables are handled as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import bpe, exact, language, mixing, near
from tidewright.llm.common import documents, fresh
from tidewright.llm.queries import TOKENIZER
from tidewright.session import scratch_path

#: a text goes if a smaller share of its trigrams is known to its best language
MIN_SCORE = 0.2
#: the least repeated source is taken once, no source more than one and a half times as often
MAX_REPEAT = 1.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in no language: no letter, or hardly a known trigram. Where
    no row has a label there is nothing to judge by, and all texts with a letter stay."""
    model = language.train(docs.where(~language.held_out("doc_id", 4, 2)).select("text", "lang"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    (found,) = fresh(docs, "found")
    known = docs.withColumn(found, language.predict(F.col("text"), model))
    return known.where((F.col(found)["lang"] != "und") & (F.col(found)["score"] >= MIN_SCORE)).select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the one with the largest id stays."""
    return near.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, rarer sources repeated up to the limit, in blocks that
    hold the sources in their target proportions."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    return mixing.mix(rows, max_repeat=MAX_REPEAT).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds packed ids, their number, and the text that they decode to as a digest."""
    (coded,) = fresh(docs, "coded")
    both = docs.withColumn(coded, bpe.round_trip(F.col("text"), TOKENIZER))
    ids, decoded = F.col(coded)["ids"], F.col(coded)["decoded"]
    return both.select(
        *docs.columns, ids.alias("ids"), (F.length(ids) / 4).cast("long").alias("n_tokens"), F.sha2(decoded.cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]
#: trained filters and signatures are not SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
