"""Replacing tables under readers, and the model registry as a log."""

import json

import pytest
from pyspark.sql import functions as F

from emberline import catalog as C
from emberline.operators.model import fixed_model


@pytest.fixture
def ns(spark):
    name = "emb_versions"
    C.drop_namespace(spark, name)
    C.ensure_namespace(spark, name)
    yield name
    C.drop_namespace(spark, name)


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_crash_before_the_switch_leaves_the_old_rows(spark, ns, monkeypatch):
    C.save_table(spark.range(3), "t", ns)
    switch = C._switch
    monkeypatch.setattr(C, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        C.save_table(spark.range(10, 12), "t", ns)
    assert ids(C.read_saved(spark, "t", ns)) == [0, 1, 2]
    monkeypatch.setattr(C, "_switch", switch)
    C.save_table(spark.range(20, 22), "t", ns)
    assert ids(C.read_saved(spark, "t", ns)) == [20, 21]


def test_a_crash_inside_the_write_leaves_the_old_rows(spark, ns):
    C.save_table(spark.range(3), "t", ns)
    with pytest.raises(Exception, match="boom"):
        C.save_table(spark.range(4).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id")), "t", ns)
    assert ids(C.read_saved(spark, "t", ns)) == [0, 1, 2]


def test_a_frame_reads_its_version_after_a_replace(spark, ns):
    C.save_table(spark.range(3), "t", ns)
    before = C.read_saved(spark, "t", ns)
    C.save_table(spark.range(5), "t", ns)
    assert ids(before) == [0, 1, 2] and C.read_saved(spark, "t", ns).count() == 5
    # a replace may read the table that it replaces
    C.save_table(C.read_saved(spark, "t", ns).where("id > 2"), "t", ns)
    assert ids(C.read_saved(spark, "t", ns)) == [3, 4]


def test_old_versions_go(spark, ns):
    for i in range(5):
        C.save_table(spark.range(i + 1), "t", ns)
    assert C.read_saved(spark, "t", ns).count() == 5
    assert len(C._versions(spark, "t", ns)) == C.KEPT_VERSIONS


def test_a_plain_table_of_the_name_is_replaced(spark, ns):
    spark.range(2).write.saveAsTable(f"{ns}.t")
    C.save_table(spark.range(7), "t", ns)
    assert C.read_saved(spark, "t", ns).count() == 7


def test_columns_may_change(spark, ns):
    C.save_table(spark.range(2), "t", ns)
    C.save_table(spark.range(2).select(F.lit("x").alias("name")), "t", ns)
    assert C.read_saved(spark, "t", ns).columns == ["name"]


def named(version):
    m = fixed_model()
    m.intercepts = [float(version), 0.0, 0.0]
    return m


def test_versions_of_a_model(spark, ns):
    assert [C.save_model(spark, named(v), ns) for v in (1, 2, 3)] == [1, 2, 3]
    name = fixed_model().name
    assert C.load_model(spark, name, ns).intercepts[0] == 3.0
    assert C.load_model(spark, name, ns, version=2).intercepts[0] == 2.0
    with pytest.raises(KeyError):
        C.load_model(spark, name, ns, version=9)


def test_a_crash_before_the_registry_row_leaves_the_old_model(spark, ns, monkeypatch):
    C.save_model(spark, named(1), ns)
    monkeypatch.setattr(C, "registry", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        C.save_model(spark, named(2), ns)
    monkeypatch.undo()
    assert C.load_model(spark, fixed_model().name, ns).intercepts[0] == 1.0


def test_equal_versions_and_times_have_one_latest(spark, ns):
    C.save_model(spark, named(1), ns)
    row = C.registry(spark, ns)
    for commit in ("a" * 32, "z" * 32, "c" * 32):
        row.withColumn("commit_id", F.lit(commit)).write.mode("append").format("parquet").saveAsTable(f"{ns}.{C.REGISTRY}")
    assert [r.commit_id for r in C.registry(spark, ns).collect()] == ["z" * 32]


def test_compaction_keeps_the_latest_and_later_saves(spark, ns, monkeypatch):
    other = fixed_model()
    other.name = "other"
    for v in (1, 2):
        C.save_model(spark, named(v), ns)
    C.save_model(spark, other, ns)
    before = sorted(map(str, C.registry(spark, ns).collect()))
    delete = C._delete

    def late(spark_, files):   # a save comes in while the compaction runs
        C.save_model(spark_, named(7), ns)
        delete(spark_, files)

    monkeypatch.setattr(C, "_delete", late)
    C.compact_registry(spark, ns)
    assert C.load_model(spark, fixed_model().name, ns).intercepts[0] == 7.0
    assert C.registry(spark, ns).where("model_name = 'other'").count() == 1
    monkeypatch.undo()
    C.compact_registry(spark, ns)
    C.compact_registry(spark, ns)
    got = C.registry(spark, ns)
    assert {(r.model_name, r.version) for r in got.collect()} == {(fixed_model().name, 3), ("other", 1)}
    assert len(before) == 2 and C.registry_log(spark, ns).count() == 2
    assert C.load_model(spark, fixed_model().name, ns).intercepts[0] == 7.0
    assert not [t for t in spark.sql(f"SHOW TABLES IN {ns}").collect() if "coefficients" in t.tableName and fixed_model().name in t.tableName][1:]


def test_an_empty_namespace_has_an_empty_registry(spark, ns):
    assert C.registry(spark, ns).count() == 0
    C.compact_registry(spark, ns)


def test_a_record_is_one_file(spark, tmp_path):
    path = str(tmp_path / "evaluation.json")
    for value in (0.5, 0.75):
        C.write_record(spark.createDataFrame([(value, None, "ü")], "a double, b string, c string"), path, as_strings=True)
        with open(path, encoding="utf-8") as f:
            assert json.load(f) == {"a": str(value), "b": None, "c": "ü"}
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["evaluation.json"]
    for n in (0, 2):
        with pytest.raises(ValueError):
            C.write_record(spark.range(n), path)
