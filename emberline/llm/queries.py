"""One query per operator, with production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocation, html, innerproduct, jaccard, katz, mixing, packing, piecewise, sharding, simhash, substring, toxicity, whitening
from .common import n_words, table, written
from .oracle import OP2_SQL, OP5_SQL, OP8_SQL, OP12_SQL

SHARDS, SHARD_SEED = 8, 20240229
MIX_SEED, MIX_EPOCHS, MIX_SHARE = 7, 4, (1, 1)
# Relative weights by level; the domain of a document is its source number modulo 3.
MIX_WEIGHTS = [{"web": 5, "reference": 3, "forum": 2}, {"en": 6, "de": 2, "fr": 2, "es": 2}, {}]
MIX_DEFAULTS = [1, 1, 1]
SEQUENCE_TOKENS, END_ID = 1024, 2


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0..7 under the law `rows`, by a Feistel permutation of row numbers."""
    d = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    keys = written(d.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                            F.crc32(text.cast("binary")).alias("text_crc32")), "shard-keys")
    return sharding.assign_shards(keys, ["doc_id"], SHARDS, SHARD_SEED).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


WINDOW_WORDS, ANCHOR_WORDS = 50, 20


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after 50-word windows of smaller documents are removed."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(d, WINDOW_WORDS, ANCHOR_WORDS).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SHINGLE_WORDS, MAX_BITS = 3, 2


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: SimHash over 3-word shingles, at most 2 differing bits."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(d, SHINGLE_WORDS, MAX_BITS)


def op4_piecewise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piecewise fingerprints of all documents, compared with their edited texts' and the next documents'."""
    return piecewise.edited_likeness(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


QUERY_STEP, TOP_K, VECTOR_SCALE = 100, 10, 1024


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every hundredth vector against all others."""
    return innerproduct.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0,
                              TOP_K, scale=VECTOR_SCALE)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


TOXIC_FOLDS, TOXIC_HELD, TOXIC_FROM = 4, 2, 0.3


def held_out(folds: int, held: int) -> Column:
    """Whether a document's fold (crc32 of doc_id as text) is the held-out one; never for a NULL id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fold."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(d, table(spark, sf_dir, "labels"), ~held_out(TOXIC_FOLDS, TOXIC_HELD))
    return toxicity.score(d, model).select(
        "doc_id", held_out(TOXIC_FOLDS, TOXIC_HELD).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def with_domain(docs: DataFrame) -> DataFrame:
    n = F.regexp_extract(F.coalesce("source", F.lit("")), r"([0-9]+)$", 1)
    names = F.array(F.lit("web"), F.lit("reference"), F.lit("forum"))
    return docs.withColumn("domain", F.when(n == "", "other").otherwise(
        F.get(names, (n.cast("decimal(38,0)") % 3).cast("int"))))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in a mix of as many words as the corpus has, at target weights."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", n_words(F.col("text")).alias("n_tokens"))
    return mixing.mix(with_domain(d), ["domain", "lang", "source"], MIX_WEIGHTS, MIX_DEFAULTS,
                      MIX_SHARE, MIX_EPOCHS, MIX_SEED).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "leaf_budget", "copies")


LM_FOLDS, LM_HELD = 7, 2


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff and add-one scores of all documents, learned outside the held-out fold."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.score(d, held_out(LM_FOLDS, LM_HELD))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenized, packed into sequences of at most 1024 tokens."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(d, tokenizer_path(), SEQUENCE_TOKENS, END_ID)
    return packing.pack(pieces, SEQUENCE_TOKENS).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


JOIN_WORDS, JOIN_PERCENT = 5, 80


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: distinct 5-word shingles, Jaccard at least 0.8."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), JOIN_WORDS, JOIN_PERCENT)


PHRASE_LEAST, PHRASE_WORDS, PHRASE_TOP = 100, 5, 2000


def op12_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of 2 to 5 words of each language of all documents."""
    return collocation.collocations(table(spark, sf_dir, "documents"), PHRASE_LEAST, PHRASE_WORDS, PHRASE_TOP)


COMPONENTS, VECTOR_SHIFT = 8, 100000


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, projected on their eight leading components at unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), COMPONENTS, VECTOR_SCALE, VECTOR_SHIFT)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_sharding": op1_sharding, "op2_substring": op2_substring, "op3_simhash": op3_simhash, "op4_piecewise": op4_piecewise,
            "op5_topk": op5_topk, "op6_html": op6_html, "op7_toxicity": op7_toxicity, "op8_mixing": op8_mixing,
            "op9_katz": op9_katz, "op10_packing": op10_packing, "op11_jaccard": op11_jaccard,
            "op12_collocation": op12_collocation, "op13_whitening": op13_whitening}


def oracle_sql() -> dict[str, str]:
    return {"op2_substring": OP2_SQL, "op5_topk": OP5_SQL, "op8_mixing": OP8_SQL, "op12_collocation": OP12_SQL}
