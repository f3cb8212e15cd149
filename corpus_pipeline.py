"""Corpus pipeline: toxicity, near duplicates, repeated passages, mixing, packing.

Every stage takes what the stage before kept, as written, and its decisions
take effect: rejected rows and words are gone from what it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import mixing, packing, simhash, substring, toxicity
from emberline.llm import queries as q
from emberline.llm.common import n_words, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage):
    """Extra columns travel under names of their own, whatever they are called."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = {c: c if c in COLUMNS else f"_extra{i}" for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), sf_dir)
        return out.select(*[F.col(n).alias(c) for c, n in own.items()])
    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


MIX_SHARE = (9, 10)  # of the words that reach the mixing stage, each document once at most


@keeps_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~q.held_out(q.TOXIC_FOLDS, q.TOXIC_HELD))
    return toxicity.score(docs, model).where(F.col("score") < q.TOXIC_FROM)


@keeps_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: that of the smallest doc_id."""
    return simhash.keep_one(docs, q.SHINGLE_WORDS, q.MAX_BITS)


@keeps_columns
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of 50-word windows that a smaller doc_id has too."""
    left = substring.remove_repeats(docs, q.WINDOW_WORDS, q.ANCHOR_WORDS, as_is=True)
    left = left.withColumn("text", F.col("kept").cast("string"))
    return left.withColumn("n_chars", F.char_length("text").cast("long"))


@keeps_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fit their source's share of the token budget."""
    counted = q.with_domain(docs.withColumn("n_tokens", n_words(F.col("text"))))
    mixed = mixing.mix(counted, ["domain", "lang", "source"], q.MIX_WEIGHTS, q.MIX_DEFAULTS, MIX_SHARE, 1, q.MIX_SEED)
    return mixed.where("copies > 0")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    pieces = packing.token_pieces(docs, q.tokenizer_path(), q.SEQUENCE_TOKENS, q.END_ID)
    return packing.pack(pieces, q.SEQUENCE_TOKENS).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("substring", drop_repeated_passages),
          ("mixing", mix_sources), ("packing", pack_sequences)]

ORACLE_SQL = None  # the toxicity model and the fingerprints cannot be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
