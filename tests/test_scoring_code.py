"""Scoring is compiled: no generated method is longer than what a JVM compiles."""

from conftest import SF_SMALL

from emberline.operators.evaluation import score_pairs
from emberline.plans import queries as Q
from emberline.plans import serve as SV

COMPILED = 8000   # bytes of bytecode; a JVM interprets longer methods for ever


def longest_method(df):
    debug = df.sparkSession._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    parts = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))


def test_scoring_code_can_be_compiled(spark):
    scored = Q.scored_columns(spark, SF_SMALL)
    for df in (scored, SV.prediction_rows(Q.predictions(spark, SF_SMALL)),
               score_pairs(scored, Q.LABEL, {c: f"p_{c}" for c in Q.CLASSES})):
        assert longest_method(df) <= COMPILED
