"""The registered queries on the small tables: SQL twins, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from conftest import SF_SMALL
from emberline.llm import queries as q
from emberline.llm.common import table, written

SQL = {k: v for k, v in q.oracle_sql().items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_all_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = q.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).df()[list(got.columns)]
    by = list(got.columns)
    assert got.sort_values(by).astype(str).values.tolist() == want.sort_values(by).astype(str).values.tolist()


COLUMNS = {
    "op1_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_piecewise": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_html": "page_id url text n_chars",
    "op7_toxicity": "doc_id held_out score predicted",
    "op9_katz": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op10_packing": "doc_id piece start length ids_crc32 sequence_id offset",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_every_row(spark, name):
    got = q.queries()[name](spark, SF_SMALL)
    assert got.columns == COLUMNS[name].split()
    key = got.columns[0]
    source = table(spark, SF_SMALL, "pages" if key == "page_id" else "documents")
    assert got.select(key).distinct().count() == source.count()


def awkward(spark):
    own = table(spark, SF_SMALL, "documents").limit(40)
    extra = own.withColumns({"kept": F.lit("own"), "n_tokens": F.lit("x"), "score": F.lit(None).cast("int"), "fp": F.lit(1)})
    odd = spark.createDataFrame([(None, None, None, None, None, None, None, None, None), (10**9, "", None, "src0", 0, "k", "", 1, 2),
                                 (10**9, "", None, "src0", 0, "k", "", 1, 2)],
                                "doc_id long, text string, lang string, source string, n_chars long, kept string, n_tokens string, "
                                "score int, fp int")
    return extra.unionByName(odd)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), awkward(spark).limit(0)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF_SMALL)
            rows = out.count()
            assert rows <= docs.count() or name == "packing"
            if name != "packing":
                assert out.columns == docs.columns, name
                assert out.where("kept not in ('own', 'k')").count() == 0


def test_stages_do_what_their_operators_say(spark):
    docs = table(spark, SF_SMALL, "documents")
    scores = q.op7_toxicity(spark, SF_SMALL)
    kept = written(P.drop_toxic(spark, docs, SF_SMALL), "t")
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in scores.where("predicted = 0").collect()}
    one = written(P.drop_near_duplicates(spark, docs, SF_SMALL), "n")
    classes = q.op3_simhash(spark, SF_SMALL)
    assert sorted(r.doc_id for r in one.collect()) == sorted(r[0] for r in classes.select("component_id").distinct().collect())
    left = {r.doc_id: r.text for r in P.drop_repeated_passages(spark, docs, SF_SMALL).collect()}
    digests = {r.doc_id: r for r in q.op2_substring(spark, SF_SMALL).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    from hashlib import sha256
    for d, text in left.items():
        assert sha256(b" ".join(text.encode().split())).hexdigest() == digests[d].kept_sha256
        assert digests[d].n_removed or text == texts[d]
    mixed = P.mix_sources(spark, docs, SF_SMALL)
    assert 0.7 * docs.count() < mixed.count() < docs.count()


def test_pipeline_packs_what_is_left(spark):
    out = P.run(spark, SF_SMALL)
    used = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert used.where("n > 1024 or n <> m").count() == 0 and out.count() > 0
