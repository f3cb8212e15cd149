"""Columns named like results, and vectors whose products pass 64 bits."""

import pytest
from pyspark.sql import functions as F

from emberline.llm import innerproduct, mixing, toxicity


def test_mix_replaces_columns_named_like_its_results(spark):
    docs = spark.createDataFrame([(1, "a", 5), (2, "b", 7), (3, None, None)], "doc_id long, source string, n_tokens long")
    own = docs.withColumns({"leaf_budget": F.lit("x"), "copies": F.lit("y"), "budget": F.lit("z"), "given": F.lit(1), "w": F.lit(2)})
    args = (["source"], [{}], [1])
    a, b = (mixing.mix(d, *args).select("doc_id", "leaf_budget", "copies").orderBy("doc_id").collect() for d in (docs, own))
    assert a == b and mixing.mix(own, *args).columns.count("leaf_budget") == 1
    assert {r.w for r in mixing.mix(own, *args).collect()} == {2}
    with pytest.raises(ValueError):
        mixing.mix(own, ["copies"], [{}], [1])


def test_toxicity_keeps_a_column_named_evidence(spark):
    model = {"costs": toxicity.trigram_costs(toxicity.np.zeros(toxicity.KINDS ** 3)), "weights": {"dunce": 3.0}, "a": -3.0, "b": 2.0}
    docs = spark.createDataFrame([(1, "dunce", "own", "s"), (2, None, None, None)], "doc_id long, text string, evidence string, score string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].evidence == "own" and got[2].evidence is None and got[1].score > 0.9 > 0.1 > got[2].score


def test_products_beyond_64_bits_raise(spark):
    df = spark.createDataFrame([(0, [1e16, 1.0]), (1, [1e16, 2.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="2\\^62"):
        innerproduct.top_k(df, F.col("vec_id") == 0)
    rows = innerproduct.top_k(df.where("vec_id = 2").unionByName(df.where("vec_id = 2").withColumn("vec_id", F.lit(5).cast("long"))), F.col("vec_id") == 2).collect()
    assert [tuple(r) for r in rows] == [(2, 1, 5, 3072 ** 2 + 1024 ** 2)]
