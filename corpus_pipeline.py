"""From raw documents to token ids: five stages, each one of the operators of ``cartmill.llm``.

Defined results of the stages: a null or empty text is not toxic and holds neither benchmark words nor personal data; all
such texts have fingerprint zero and are one group of near-duplicates; in the last stage they have no ids and empty text.
Rows with a null id are never in the labelled sample and stay, of a group last. Equal rows count as near-duplicates, of
which one stays; of other ties the smallest id stays. Empty tables give empty tables with the same columns. Further
columns, whatever their names, pass the first four stages unchanged, but for ``n_chars``, which follows the text.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import bpe, common, decontamination, pii, simhash, toxicity
from cartmill.llm.queries import SIMHASH

TOXIC = 0.5


_SHARED: list = []


def _stage(build):
    """A stage with its settings; the stage before is stored by now, so executors drop what that one broadcast."""

    @functools.wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _SHARED:
            _SHARED.pop().unpersist()
        common.release()
        with common.owning(_SHARED):
            return build(common.prepared(spark), docs, sf_dir)

    return run


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` anew after the text has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones among them, scores below ``TOXIC``."""
    network = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    score = common.free(docs, "_score")
    return toxicity.add_scores(docs, network, score=score).filter(F.col(score) < TOXIC).drop(score)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    return simhash.keep_one(docs, **SIMHASH)


@_stage
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


@_stage
def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what reveals it replaced by its kind."""
    return _counted(pii.sanitise(docs))


_TOKENS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("decoded", T.StringType()),
]


@_stage
def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the text they decode to."""

    def finish(ids: bytes, pieces: bpe.Pieces) -> tuple:
        return len(ids) // 4, bpe.as_list(ids), pieces.decode(ids).decode()

    encoded = bpe.encode_documents(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep=["doc_id"],
        finish=finish,
        fields=_TOKENS,
    )
    return encoded.select("doc_id", "n_tokens", "ids", F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", replace_personal_data),
    ("byte_bpe", encode_and_decode),
]

# SQL cannot express training, fingerprints, patterns without retries or merges; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored before the next one reads it."""
    docs = common.table(common.prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
