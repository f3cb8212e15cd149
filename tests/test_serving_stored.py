"""Ranks from stored files, no stale rows, lookups that prune, AUC over ties."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline import catalog as C
from emberline.operators import evaluation as EV
from emberline.operators.enrich import engineer, label_rows
from emberline.operators.model import first_of, fixed_model, predict, prob_of, top_of
from emberline.operators.ranking import manifest, read_ranked, store_ranked
from emberline.plans import queries as Q
from emberline.plans import serve as SV
from emberline.sources.observations import from_lineitem

SF = "/root/testdata/sf0.001"


def test_ranks_follow_the_order_and_pages_read_their_files_only(spark, tmpdir_path):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(x), i) for i, x in enumerate(rng.integers(0, 300, 5000))], "x long, id long").repartition(9)
    path = os.path.join(tmpdir_path, "r")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store_ranked(df, [F.desc("x"), "id"], path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = manifest(spark, path).orderBy("before").collect()
    assert len(files) > 2 and sum(f.n for f in files) == 5000
    want = [(r.x, r.id) for r in df.orderBy(F.desc("x"), "id").collect()]
    got = read_ranked(spark, path).orderBy("rank_position").collect()
    assert [(r.x, r.id) for r in got] == want and [r.rank_position for r in got] == list(range(1, 5001))
    edge = files[1].before
    for first, last in ((1, 10), (edge, edge + 1), (4990, None), (None, 3), (4000, 9000)):
        page = read_ranked(spark, path, first, last)
        rows = page.orderBy("rank_position").collect()
        assert [(r.x, r.id) for r in rows] == want[(first or 1) - 1:last]
    assert len(read_ranked(spark, path, 1, 10).inputFiles()) == 2   # one of rows, one of the manifest
    assert read_ranked(spark, path, 6000, 7000).count() == 0


def test_an_empty_table_has_no_ranks(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "e")
    store_ranked(spark.createDataFrame([], "x long"), ["x"], path)
    assert read_ranked(spark, path).count() == 0 and read_ranked(spark, path, 1, 5).count() == 0


@pytest.mark.parametrize("name", ["current_predictions", "run_summary", "lookup_saved_states", "ranked_page", "eval_roc_auc"])
def test_queries_see_the_rows_of_a_replaced_file(spark, tmpdir_path, name):
    """Another job puts new files at the same path; nothing that was read before is shown again."""
    whole = spark.read.parquet(f"{SF}/lineitem.parquet")
    folder = os.path.join(tmpdir_path, "sf")
    spark.read.parquet(f"{SF}/supplier.parquet").write.parquet(f"{folder}/supplier.parquet")

    def put(n):
        whole.orderBy("l_orderkey", "l_linenumber").limit(n).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
        return sorted(map(str, Q.queries()[name](spark, folder).collect()))

    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    first, second = put(100), put(300)
    assert first != second and put(100) == first
    if name in ("current_predictions", "ranked_page"):
        assert (len(first), len(second)) == ((100, 300) if name == "current_predictions" else (0, 150))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_a_saved_lookup_prunes_by_the_requests(spark):
    preds = predict(fixed_model(), label_rows(engineer(from_lineitem(spark.read.parquet(f"{SF}/lineitem.parquet")))))
    asked = spark.createDataFrame([("BAYERN",), ("nowhere",), (None,), ("",), ("bayern",)], "requested_state string")
    with C.scratch_namespace(spark, "prune") as ns:
        C.save_predictions(preds, "p", ns)
        saved = C.read_saved(spark, "p", ns)
        found = SV.lookup_saved(asked, saved)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan
        got = sorted(map(str, found.collect()))
    assert got == sorted(map(str, SV.lookup(asked, preds).collect())) and len(got) == 5
    assert not spark.catalog.databaseExists(ns)


def test_plain_columns_and_the_array_agree(spark):
    df = spark.createDataFrame([(0.2, 0.5, 0.3), (0.4, 0.4, 0.2), (0.0, 0.0, 0.0), (0.3, 0.3, 0.4)], "prob_high double, prob_low double, prob_mid double")
    from emberline.operators.model import sorted_probs_sql
    classes = ["high", "low", "mid"]
    arr = df.withColumn("a", F.expr(sorted_probs_sql(classes, [f"prob_{c}" for c in classes])))
    label, top = top_of(classes)
    for r in arr.select("a", first_of("a", "label"), first_of("a", "prob"), label, top, prob_of("a", "low"), "prob_low",
                        prob_of("a", "none")).collect():
        want = sorted(r.a, key=lambda e: (-e.prob, e.label))
        assert list(r.a) == want and r[1] == r[3] == want[0].label and r[2] == r[4] == want[0].prob and r[5] == r[6] and r[7] == 0.0
    assert arr.schema["a"].dataType.simpleString() == "array<struct<label:string,prob:double>>"


def brute_auc(rows, cls):
    pos = [p for y, p in rows if y == cls]
    neg = [p for y, p in rows if y is not None and y != cls]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("n", [1, 3, 16])
def test_auc_with_ties_over_batches_and_partitions(spark, n):
    rng = np.random.default_rng(n)
    data = [(["a", "b", "c", None][rng.integers(0, 4)], float(rng.integers(0, 12)) / 11, float(rng.random())) for _ in range(400)]
    df = spark.createDataFrame(data, "y string, pa double, pb double").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = {r.cls: r for r in EV.auc_by_class(df, "y", {"a": "pa", "b": "pb", "zz": "pa"}, n).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    for c, i in (("a", 1), ("b", 2)):
        assert abs(got[c].auc - brute_auc([(r[0], r[i]) for r in data], c)) < 1e-12
    assert got["zz"].auc is None and got["zz"].n_pos == 0


def test_auc_has_one_exchange_of_the_pairs(spark):
    p = EV.auc_by_class(Q.scored_columns(spark, SF), Q.LABEL, {c: f"p_{c}" for c in Q.CLASSES})
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1
    above = plan[:plan.index("rangepartitioning")]
    assert plan.count("Exchange") == above.count("Exchange")   # what follows moves a row for each partition and class
