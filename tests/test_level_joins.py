"""Joins of levels and steps over blocks: rows stay where they are, and parts stay small."""

import pytest
from pyspark.sql import functions as F

from emberline.operators import table_model as TM
from emberline.operators import train as T
from emberline.operators.model import fixed_model

ROWS = [(i, "often" if i % 3 else f"v{i}", None if i % 5 == 0 else "b") for i in range(300)] + [(-1, None, "b"), (-2, "unknown", "c")]


@pytest.mark.parametrize("held", [4096, 2])
def test_every_row_gets_the_value_of_its_level(spark, monkeypatch, held):
    monkeypatch.setattr(TM, "HELD_LEVELS", held)
    table = spark.createDataFrame([("x", f"v{i}", float(i)) for i in range(300)] + [("x", "often", -5.0), ("y", "b", 7.0)],
                                  "feature string, level string, w double")
    df = spark.createDataFrame(ROWS, "id long, x string, y string")
    got = TM.join_levels(df, table, "w", [F.col("x"), F.col("y")], ["x", "y"], "_i")
    assert got.columns == ["id", "x", "y", "_i0", "_i1"]
    want = {v: float(v[1:]) for v in (f"v{i}" for i in range(300))} | {"often": -5.0}
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(
        [(i, x, y, want.get(x), 7.0 if y == "b" else None) for i, x, y in ROWS], key=lambda r: r[0])


def test_scoring_with_a_small_table_moves_no_row(spark):
    from emberline.plans import queries as Q
    from conftest import SF_SMALL

    p = TM.predict_table(TM.as_table_model(spark, fixed_model()), Q.labeled_obs(spark, SF_SMALL), prob_columns=True)
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


def training_rows(spark, n):
    return spark.range(n).selectExpr("CAST(id % 7 AS DOUBLE) AS a", "concat('l', id % 11) AS c", "CASE WHEN id % 3 = 0 THEN 'p' ELSE 'q' END AS y")


CFG = T.TrainConfig(label="y", numeric=["a"], categorical=["c"], iterations=3)


def test_blocks_are_not_shuffled_in_a_step(spark, monkeypatch):
    plans, real = [], TM.with_weights

    def seen(blocks, asked, now, n):
        out = real(blocks, asked, now, n)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(TM, "with_weights", seen)
    model = TM.train_gd_table(training_rows(spark, 2000), CFG)
    assert len(plans) == len(model.history) == 3
    for plan in plans:
        # of the block table only names and level numbers may be under an exchange
        join = plan[plan.index("ShuffledHashJoin"):]
        left = join[:join.index("FileScan")]
        assert "Exchange" not in left and "Sort" not in left and "Bucketed: true" in plan
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("gd_blocks")]
    plain = T.train_gd(training_rows(spark, 2000), CFG)
    got = {(r["class"], r.feature): r.weight for r in model.coefficient_table().collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {(c, f): round(w, 9) for c, f, w in plain.coefficient_rows()}


def test_stored_blocks_come_in_small_row_groups(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    found, real = [], TM.discard

    def seen(session, path):
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet")] if "/blocks-" in path else []
        found.append([m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)])
        real(session, path)

    monkeypatch.setattr(TM, "discard", seen)
    monkeypatch.setattr(TM, "BLOCK_ROWS", 16)
    monkeypatch.setattr(TM, "GROUP_BYTES", 5 * 16 * 32 + 1, raising=False)   # a block of CFG takes some 16 * 32 bytes
    TM.train_gd_table(training_rows(spark, 2000).coalesce(1), CFG)
    stored = [groups for groups in found if groups]
    assert [sum(groups) for groups in stored] == [125, 125]   # as found and as dealt out: a group is decoded at once
    assert max(map(max, stored)) == 5


def test_the_first_step_reads_blocks_by_bucket(spark, monkeypatch):
    plans, real = [], TM.with_weights

    def seen(*args):
        out = real(*args)
        out.collect()
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(TM, "with_weights", seen)
    TM.train_gd_table(training_rows(spark, 2000), CFG)
    # else a task takes as many files as a split holds
    assert len(plans) == 3 and all("isFinalPlan=true" in p and "Bucketed: true" in p.split("Initial Plan")[0] for p in plans)


def test_parts_grow_with_the_rows(spark, monkeypatch):
    assert TM.parts_for(10 * TM.PART_ROWS + 1, 8) == 11 and TM.parts_for(5, 8) == 8
    monkeypatch.setattr(TM, "PART_ROWS", 100)
    _, _, _, X, _ = T.prepare(training_rows(spark, 2000), CFG, packed=True)
    assert X.rdd.getNumPartitions() == 20
    X.unpersist()
