"""Metric identity against the published evaluation, plus edge cases."""

import pytest

from emberline import reference_values as RV
from emberline.operators.evaluation import confusion, macro_metrics, per_class

# confusion matrix recovered from the published metrics (actual x predicted)
MATRIX = {("high", "high"): 1,
          ("moderate", "high"): 11, ("moderate", "moderate"): 26,
          ("low", "high"): 14, ("low", "moderate"): 22, ("low", "low"): 121}


def _frame(spark, matrix):
    rows = [(a, p) for (a, p), n in matrix.items() for _ in range(n)]
    return spark.createDataFrame(rows, "actual string, predicted string")


def test_published_macro_metrics(spark):
    df = _frame(spark, MATRIX)
    assert df.count() == 195
    m = macro_metrics(confusion(df, "actual", "predicted")).first()
    assert m["accuracy"] == pytest.approx(float(RV.PUBLISHED_METRICS["accuracy"]), abs=1e-12)
    assert m["precision"] == pytest.approx(float(RV.PUBLISHED_METRICS["precision"]), abs=1e-12)
    assert m["recall"] == pytest.approx(float(RV.PUBLISHED_METRICS["recall"]), abs=1e-12)
    assert m["f1_score"] == pytest.approx(float(RV.PUBLISHED_METRICS["f1_score"]), abs=1e-12)


def test_zero_support_class_does_not_divide_by_zero(spark):
    df = spark.createDataFrame([("low", "low"), ("low", "high")], "actual string, predicted string")
    pc = {r["cls"]: r for r in per_class(confusion(df, "actual", "predicted")).collect()}
    assert pc["high"]["recall"] == 0.0 and pc["high"]["precision"] == 0.0
    m = macro_metrics(confusion(df, "actual", "predicted")).first()
    assert m["accuracy"] == 0.5


def test_requested_labels_include_absent_classes(spark):
    df = spark.createDataFrame([("low", "low"), ("moderate", "moderate")], "actual string, predicted string")
    cm = confusion(df, "actual", "predicted")
    seen = macro_metrics(cm).first()
    assert seen["recall"] == 1.0 and seen["precision"] == 1.0
    forced = macro_metrics(cm, ["high", "low", "moderate"]).first()
    assert forced["recall"] == pytest.approx(2 / 3) and forced["f1_score"] == pytest.approx(2 / 3)
    assert forced["accuracy"] == 1.0
