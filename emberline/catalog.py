"""Namespaces, tables, stored models and the model registry.

A namespace is a Spark database.  A saved table is a view of its name over a
version: a table of its own, written whole before the view is switched to it
in one catalog step.  Whoever reads meanwhile, or after a crash in between,
sees the old rows; a frame made before the switch goes on reading its version.

A model is two small tables of its own commit, and one row that is appended to
the registry's log last: a commit without that row does not exist for readers.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reference_values as RV
from .operators.model import LinearModel, Preprocess
from .operators.table_model import TableModel
from .session import scratch_path

REGISTRY = "model_registry"            # the log: one appended row for each save
SNAPSHOT = "model_registry_snapshot"   # what a compaction left of the log
REGISTRY_SCHEMA = ("model_catalog string, model_schema string, model_name string, "
                   "model_type string, creation_time timestamp, last_modified_time timestamp, "
                   "classes string, label string, version long, commit_id string")
KEPT_VERSIONS = 2                      # of a saved table: the present one, and one for its late readers


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ensure_namespace(spark: SparkSession, name: str, comment: str | None = None,
                     props: dict[str, str] | None = None, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS, with description, labels and a folder of its own."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_q(name)}"
    for word, value in (("COMMENT", comment), ("LOCATION", location)):
        if value:
            sql += f" {word} " + "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if props:
        kv = ", ".join("'{}'='{}'".format(k.replace("'", ""), str(v).replace("'", ""))
                       for k, v in props.items())
        sql += f" WITH DBPROPERTIES ({kv})"
    spark.sql(sql)


def drop_namespace(spark: SparkSession, name: str) -> None:
    """DROP DATABASE IF EXISTS ... CASCADE (tables and registered models go too)."""
    spark.sql(f"DROP DATABASE IF EXISTS {_q(name)} CASCADE")


def _versions(spark: SparkSession, name: str, namespace: str) -> dict[int, list[str]]:
    """Tables that hold versions of ``name``, by number."""
    out: dict[int, list[str]] = {}
    for row in spark.sql(f"SHOW TABLES IN {_q(namespace)}").collect():  # names, not rows
        m = re.fullmatch(re.escape(name.lower()) + r"__v(\d+)_[0-9a-f]{8}", row["tableName"])
        if m:
            out.setdefault(int(m[1]), []).append(row["tableName"])
    return out


def _full(spark: SparkSession, name: str, namespace: str | None) -> tuple[str, str]:
    namespace = namespace or spark.catalog.currentDatabase()
    return f"{_q(namespace)}.{_q(name)}", namespace


def _replace(spark: SparkSession, name: str, namespace: str | None, write) -> str:
    """Write a new version with ``write(table)``, then point ``name`` to it."""
    full, namespace = _full(spark, name, namespace)
    there = _versions(spark, name, namespace)
    number = max(there, default=0) + 1
    version = f"{name.lower()}__v{number}_{uuid.uuid4().hex[:8]}"
    write(f"{_q(namespace)}.{_q(version)}")
    _switch(spark, full, f"{_q(namespace)}.{_q(version)}")
    for k, tables in there.items():
        if k <= number - KEPT_VERSIONS:
            for t in tables:
                spark.sql(f"DROP TABLE IF EXISTS {_q(namespace)}.{_q(t)}")
    return full


def _switch(spark: SparkSession, full: str, version: str) -> None:
    """The one step after which readers see the new rows."""
    if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
        spark.sql(f"DROP TABLE {full}")  # a table that was not saved here
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT * FROM {version}")


@contextmanager
def scratch_namespace(spark: SparkSession, tag: str):
    """A namespace in the shared checkpoint folder that is gone afterwards, tables and all."""
    path = scratch_path(spark, tag)
    name = os.path.basename(path).replace("-", "_")
    ensure_namespace(spark, name, location=path)
    try:
        yield name
    finally:
        drop_namespace(spark, name)


def save_table(df: DataFrame, name: str, namespace: str | None = None) -> str:
    """Create-or-replace the table ``name`` with the rows of ``df``; returns the qualified name."""
    return _replace(df.sparkSession, name, namespace, lambda t: df.write.format("parquet").saveAsTable(t))


REGION_KEY = "state_key"


def save_predictions(preds: DataFrame, name: str = RV.PREDICTIONS_TABLE,
                     namespace: str | None = None, region_col: str = "state_province",
                     max_records_per_file: int = 5_000_000, rebalance: bool = True) -> str:
    """Create-or-replace a predictions table partitioned by ``lower(region)``.

    A region lookup (``lower(state) = lower(:p)``) then becomes a partition
    filter on ``state_key`` and reads one region's files only.  With
    ``rebalance`` the rows are grouped by region through a REBALANCE hint, so
    adaptive execution sizes the output partitions and splits a hot region
    over several tasks (no single task holds it, and there are no per-task
    small files for every region); without it each task writes its own files.
    """
    keyed = preds.withColumn(REGION_KEY, F.lower(F.col(region_col)))
    if rebalance:
        keyed = keyed.hint("rebalance", REGION_KEY)
    return _replace(preds.sparkSession, name, namespace, lambda t: (
        keyed.write.format("parquet").option("maxRecordsPerFile", str(max_records_per_file))
        .partitionBy(REGION_KEY).saveAsTable(t)))


def read_saved(spark: SparkSession, name: str, namespace: str | None = None) -> DataFrame:
    return spark.table(f"{_q(namespace)}.{_q(name)}" if namespace else _q(name))


def count_rows(df: DataFrame) -> DataFrame:
    """``COUNT(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def write_json(df: DataFrame, path: str, as_strings: bool = False) -> None:
    """Rows as JSON lines; ``as_strings`` renders every value as text."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) if as_strings else df
    out.write.mode("overwrite").json(path)


def write_record(df: DataFrame, path: str, as_strings: bool = False) -> None:
    """The one row of ``df`` as one JSON file; an existing file is replaced once the new one
    is whole.  Raises if there is no row, or more than one."""
    spark = df.sparkSession
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) if as_strings else df
    rows = out.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).take(2)
    if len(rows) != 1:
        raise ValueError("a record has one row")
    jvm = spark.sparkContext._jvm
    new, final = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.{uuid.uuid4().hex}", path))
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(new, False)
    stream.write(bytearray((rows[0]["j"] + "\n").encode()))
    stream.close()
    fs.delete(final, False)
    fs.rename(new, final)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


# ------------------------------------------------------------------ models --

def save_model(spark: SparkSession, model: LinearModel | TableModel, namespace: str,
               catalog_name: str = "spark_catalog") -> int:
    """Save a model as its next version: coefficient rows, preprocessing row, then the
    registry row that makes the version exist.  Returns the version.

    Two writers that save at once may give one number twice; the later time, then
    the commit id, decides which is the latest.
    """
    commit = uuid.uuid4().hex
    if isinstance(model, TableModel):
        coefs, spec = model.coefficients, {"intercepts": model.intercepts, "weights": model.weights}
        pre, vocab = model, None    # the levels are in the coefficients
    else:
        coefs = spark.createDataFrame(model.coefficient_rows(), "class string, feature string, weight double")
        pre, vocab, spec = model.pre, model.pre.vocab, {}
    coefs.write.format("parquet").saveAsTable(_model_table(model.name, "coefficients", commit, namespace))
    prep = spark.createDataFrame(
        [(json.dumps({"numeric": pre.numeric, "means": pre.means, "stds": pre.stds,
                      "categorical": pre.categorical, "vocab": vocab, **spec}),)], "spec string")
    prep.write.format("parquet").saveAsTable(_model_table(model.name, "preprocess", commit, namespace))
    version, created = 1, model.created.astimezone(timezone.utc).replace(tzinfo=None)
    if _has_registry(spark, namespace):
        before = registry(spark, namespace).where(F.col("model_name") == F.lit(model.name)).take(1)
        if before:
            version, created = before[0]["version"] + 1, before[0]["creation_time"]
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(catalog_name, namespace, model.name, model.model_type, created, now,
                                  json.dumps(model.classes), model.label, version, commit)], REGISTRY_SCHEMA)
    row.coalesce(1).write.mode("append").format("parquet").saveAsTable(f"{_q(namespace)}.{_q(REGISTRY)}")
    return version


def _model_table(name: str, part: str, commit: str, namespace: str) -> str:
    return f"{_q(namespace)}.{_q(f'{name}__{part}__{commit}')}"


def load_model(spark: SparkSession, name: str, namespace: str, version: int | None = None) -> LinearModel | TableModel:
    """The latest, or the given, version of a model."""
    saves = registry_log(spark, namespace).where(F.col("model_name") == F.lit(name))
    if version is not None:
        saves = saves.where(F.col("version") == version)
    reg = _latest(saves).take(1)
    if not reg:
        raise KeyError(f"model {name} is not registered in {namespace}")
    classes, commit = json.loads(reg[0]["classes"]), reg[0]["commit_id"]
    spec = json.loads(spark.table(_model_table(name, "preprocess", commit, namespace)).first()["spec"])
    created = reg[0]["creation_time"].replace(tzinfo=timezone.utc)
    if spec["vocab"] is None:
        return TableModel(classes, spec["numeric"], spec["means"], spec["stds"], spec["categorical"], spec["weights"],
                          spec["intercepts"], spark.table(_model_table(name, "coefficients", commit, namespace)), name=name,
                          model_type=reg[0]["model_type"], label=reg[0]["label"], created=created)
    pre = Preprocess(spec["numeric"], spec["means"], spec["stds"], spec["categorical"], spec["vocab"])
    names = ["(intercept)"] + pre.feature_names()
    # k x d rows: the model itself, bounded by classes x features
    rows = spark.table(_model_table(name, "coefficients", commit, namespace)).collect()
    table = {(r["class"], r["feature"]): r["weight"] for r in rows}
    intercepts = [table.get((c, "(intercept)"), 0.0) for c in classes]
    weights = [[table.get((c, n), 0.0) for n in names[1:]] for c in classes]
    return LinearModel(classes, pre, weights, intercepts, name=name,
                       model_type=reg[0]["model_type"], label=reg[0]["label"], created=created)


def _has_registry(spark: SparkSession, namespace: str) -> bool:
    return any(spark.catalog.tableExists(f"{_q(namespace)}.{_q(t)}") for t in (REGISTRY, SNAPSHOT))


def registry_log(spark: SparkSession, namespace: str) -> DataFrame:
    """Every known save, those that a compaction has folded as their latest only.

    A save may be in both parts while a compaction runs; the rows are equal then.
    """
    parts = [read_saved(spark, t, namespace) for t in (SNAPSHOT, REGISTRY)
             if spark.catalog.tableExists(f"{_q(namespace)}.{_q(t)}")]
    if not parts:
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).distinct()


def _latest(saves: DataFrame) -> DataFrame:
    order = F.struct("version", "last_modified_time", "commit_id")
    return saves.groupBy("model_name").agg(F.max_by(F.struct(*saves.columns), order).alias("r")).select("r.*")


def registry(spark: SparkSession, namespace: str) -> DataFrame:
    """The latest registry row of every model (what a catalog's MODELS view would show):
    the highest version, then the later time, then the larger commit id."""
    return _latest(registry_log(spark, namespace))


def compact_registry(spark: SparkSession, namespace: str) -> None:
    """Fold the log into one row for each model.

    The snapshot is replaced first; then the log's files that it has read are deleted,
    and no others, so a save that comes in meanwhile stays.  After a crash in between
    both hold the same saves.  Older versions of a model cannot be loaded afterwards;
    their tables are dropped last.
    """
    log = f"{_q(namespace)}.{_q(REGISTRY)}"
    if not spark.catalog.tableExists(log):
        return
    spark.catalog.refreshTable(log)
    files = spark.table(log).inputFiles()
    if not files:
        return
    folded = spark.read.schema(REGISTRY_SCHEMA).parquet(*files)
    if spark.catalog.tableExists(f"{_q(namespace)}.{_q(SNAPSHOT)}"):
        folded = folded.unionByName(read_saved(spark, SNAPSHOT, namespace))
    save_table(_latest(folded).coalesce(1), SNAPSHOT, namespace)
    old = folded.select("model_name", "commit_id").distinct().join(
        read_saved(spark, SNAPSHOT, namespace).select("commit_id"), "commit_id", "left_anti").collect()
    _delete(spark, files)
    spark.catalog.refreshTable(log)
    for r in old:  # one row for each save since the last compaction
        for part in ("coefficients", "preprocess"):
            spark.sql(f"DROP TABLE IF EXISTS {_model_table(r['model_name'], part, r['commit_id'], namespace)}")


def _delete(spark: SparkSession, files: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


DEFAULT_NAMESPACE = "wildfire"
DEFAULT_MODEL = RV.DEFAULT_MODEL_NAME
