"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus equivalent SQL.

Every query reads the given tables (``lineitem`` drives the observation view
and the training table; ``supplier`` the batch of
lookups; ``events`` the row numbering), so its work grows with the data.
Doubles computed through ``exp``/``ln`` or long sums are rounded (6 digits;
9 for ratios of counts) in both the Spark query and its SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog as CAT
from .. import reference_values as RV
from ..operators import evaluation as EV
from ..operators.enrich import engineer, enrich_coordinates, label_rows
from ..operators.model import LinearModel, fixed_model, predict, top_of
from ..operators.row_id import with_row_id
from ..operators.table_model import as_table_model, predict_table, train_gd_table
from ..operators.train import (TrainConfig, class_weights, first_step, moments, optimality, split,
                               train_gd, train_lr, vocabulary)
from ..session import scratch_path, stored
from ..sources.observations import from_lineitem
from ..sources.tables import read_table
from . import oracle as O
from . import serve as SV

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

LABEL = RV.LABEL_COLUMN
PRED = SV.PRED
PROBS = SV.PROBS
FIXED = fixed_model()
CLASSES = FIXED.classes
STATE_PARAM = "bAYERN"          # exercised case-insensitively
R6, R9 = 6, 9


def positive_zero_rounding(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``.

    Spark's ``round`` never yields -0.0 (it rounds through a decimal), while a
    float ``round`` of a tiny negative value does; adding +0.0 maps -0.0 to
    +0.0 and leaves every other value unchanged.
    """
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = positive_zero_rounding(sql[j + len(key):k])
        out.append(sql[i:j] + f"(round({inner}) + {O.d(0)})")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = positive_zero_rounding(sql)
        return fn
    return deco


# ------------------------------------------------------------ shared inputs --

def obs(spark, sf_dir) -> DataFrame:
    return from_lineitem(read_table(spark, sf_dir, "lineitem"))


def labeled_obs(spark, sf_dir) -> DataFrame:
    return label_rows(engineer(obs(spark, sf_dir)))


def predictions(spark, sf_dir, model: LinearModel = FIXED) -> DataFrame:
    """The stored-predictions shape: inputs, scores, label, (label, prob) array, and the plain
    probabilities (what a reader does not use is not computed)."""
    return predict(model, label_rows(engineer(obs(spark, sf_dir))), prob_columns=True)


def keyed_obs(spark, sf_dir) -> DataFrame:
    """Observations with ``row_id``, the text of the row's keys: draws and the split hang on it."""
    return from_lineitem(read_table(spark, sf_dir, "lineitem"), keyed=True)


def training(spark, sf_dir) -> DataFrame:
    """The training table: one labelled row per lineitem row, with coordinates."""
    return label_rows(engineer(enrich_coordinates(keyed_obs(spark, sf_dir))))


def scored_columns(spark, sf_dir) -> DataFrame:
    """Label and one plain probability column for each class."""
    return predictions(spark, sf_dir).select(LABEL, *[F.col(f"prob_{c}").alias(f"p_{c}") for c in CLASSES])


def iso_sql(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN microsecond({col}) % 1000000 = 0 "
            f"THEN strftime({col}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') END")


def iso_sql_zoned() -> str:
    return iso_sql(f"timezone('{RV.OBSERVATION_ZONE}', timezone('UTC', timestamp))")


PRED_SQL = O.predict_sql(FIXED, O.LABELED)
FIRST_LABEL_SQL, FIRST_PROB_SQL = O.first_label_prob_sql(FIXED)


# ------------------------------------------------------------ training rows --

@register("enrich_coordinates",
          f"SELECT row_id, state_province, {O._coordinates()} FROM ({O.KEYED}) b")
def q_enrich_coordinates(spark, sf_dir):
    return enrich_coordinates(keyed_obs(spark, sf_dir).select("row_id", "state_province"))


@register("enrich_coordinates_join",
          f"SELECT row_id, state_province, {O._coordinates()} FROM ({O.KEYED}) b")
def q_enrich_coordinates_join(spark, sf_dir):
    """The same coordinates through a join with the centroid table (JN1 as a join)."""
    from ..operators.enrich import centroid_table
    return enrich_coordinates(keyed_obs(spark, sf_dir).select("row_id", "state_province"),
                              centroids=centroid_table(spark))


@register("training_projection", f"""
SELECT {', '.join(RV.NUMERIC_FEATURES + RV.CATEGORICAL_FEATURES + RV.ORDINAL_FEATURES)}, {LABEL}
FROM ({O.TRAINING}) g
""")
def q_training_projection(spark, sf_dir):
    return training(spark, sf_dir).select(
        *RV.NUMERIC_FEATURES, *RV.CATEGORICAL_FEATURES, *RV.ORDINAL_FEATURES, LABEL)


# ------------------------------------------------------- scores and labels --

@register("threshold_scores", f"""
SELECT station_id, state_province, temperature_celsius, humidity_percent,
       temp_risk_score, humidity_risk_score
FROM ({O.ENGINEERED}) e
""")
def q_threshold_scores(spark, sf_dir):
    return engineer(obs(spark, sf_dir)).select(
        "station_id", "state_province", "temperature_celsius", "humidity_percent",
        "temp_risk_score", "humidity_risk_score")


@register("zoned_timestamps", f"""
SELECT station_id, {iso_sql_zoned()} AS local_time,
       CAST(month(timezone('{RV.OBSERVATION_ZONE}', timezone('UTC', timestamp))) AS BIGINT) AS local_month
FROM ({O.OBS}) o
""")
def q_zoned_timestamps(spark, sf_dir):
    """Ship timestamps read as UTC instants, shown as Europe/Berlin wall time (FN8, FN9)."""
    from ..functions.temporal import iso_datetime, month_of, zoned_wall_time
    local = zoned_wall_time("timestamp", RV.OBSERVATION_ZONE)
    return obs(spark, sf_dir).select("station_id", iso_datetime(local).alias("local_time"),
                                     month_of(local).alias("local_month"))


@register("rule_labels", f"""
SELECT station_id, temperature_celsius, humidity_percent, wind_speed_ms, {LABEL}
FROM ({O.LABELED}) l
""")
def q_rule_labels(spark, sf_dir):
    return labeled_obs(spark, sf_dir).select(
        "station_id", "temperature_celsius", "humidity_percent", "wind_speed_ms", LABEL)


@register("label_distribution", f"""
SELECT {LABEL}, count(*) AS n FROM ({O.LABELED}) l GROUP BY {LABEL}
""")
def q_label_distribution(spark, sf_dir):
    return labeled_obs(spark, sf_dir).groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ training prep --

@register("class_weights", f"""
WITH c AS (SELECT {LABEL}, count(*) AS n FROM ({O.TRAINING}) g WHERE {LABEL} IS NOT NULL GROUP BY {LABEL})
SELECT {LABEL}, n, round(CAST((SELECT sum(n) FROM c) AS DOUBLE)
                         / ((SELECT count(*) FROM c) * n), {R9}) AS weight
FROM c
""")
def q_class_weights(spark, sf_dir):
    cw = class_weights(training(spark, sf_dir), LABEL)
    return cw.withColumn("weight", F.round("weight", R9))


@register("train_eval_split", f"""
SELECT {O.split_flag()} AS is_eval, {LABEL}, count(*) AS n
FROM ({O.TRAINING}) g GROUP BY ALL
""")
def q_train_eval_split(spark, sf_dir):
    from ..functions.rng import split_flag
    g = training(spark, sf_dir)
    return g.groupBy(split_flag(42, F.col("row_id"), RV.EVAL_FRACTION).alias("is_eval"), LABEL).agg(
        F.count(F.lit(1)).alias("n"))


_STATS_COLS = RV.NUMERIC_FEATURES + RV.ORDINAL_FEATURES


@register("standardize_stats", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(avg(CAST({c} AS DOUBLE)), {R6}) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), {R6}) AS std FROM ({O.TRAIN}) t"
    for c in _STATS_COLS))
def q_standardize_stats(spark, sf_dir):
    train, _ = split(training(spark, sf_dir))
    m = moments(train, _STATS_COLS)
    return m.select("feature", F.round("mean", R6).alias("mean"), F.round("std", R6).alias("std"))


@register("one_hot_vocab", f"""
WITH lv AS (
  SELECT DISTINCT 'weather_condition' AS feature, weather_condition AS level
  FROM ({O.TRAIN}) t WHERE weather_condition IS NOT NULL
  UNION
  SELECT DISTINCT 'state_province' AS feature, state_province AS level
  FROM ({O.TRAIN}) t WHERE state_province IS NOT NULL)
SELECT feature, level, row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS level_index
FROM lv
""")
def q_one_hot_vocab(spark, sf_dir):
    train, _ = split(training(spark, sf_dir))
    return vocabulary(train, RV.CATEGORICAL_FEATURES)


def _first_step_sql() -> str:
    cfg = TrainConfig()
    num = cfg.numeric
    stats = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mu, "
        f"stddev_samp(CAST({c} AS DOUBLE)) AS sd FROM t" for c in num)
    levels = "\nUNION\n".join(
        f"SELECT DISTINCT '{c}' AS cat, CAST({c} AS VARCHAR) AS level FROM t WHERE {c} IS NOT NULL"
        for c in cfg.categorical)
    numeric_long = "\nUNION ALL\n".join(
        f"SELECT t.row_id, '{c}' AS feature, COALESCE((CAST(t.{c} AS DOUBLE) - s.mu) / "
        f"(CASE WHEN s.sd IS NULL OR s.sd <= 0 THEN {O.d(1)} ELSE s.sd END), {O.d(0)}) AS x "
        f"FROM t JOIN st s ON s.feature = '{c}'" for c in num)
    cat_long = "\nUNION ALL\n".join(
        f"SELECT t.row_id, v.cat || '=' || v.level AS feature, "
        f"CASE WHEN CAST(t.{c} AS VARCHAR) = v.level THEN {O.d(1)} ELSE {O.d(0)} END AS x "
        f"FROM t JOIN lv v ON v.cat = '{c}'" for c in cfg.categorical)
    k_sql = "(SELECT count(*) FROM wt)"
    # rows can share their keys: the joins below need a number of their own
    return f"""
WITH t AS MATERIALIZED (SELECT * EXCLUDE (row_id), row_number() OVER () AS row_id FROM ({O.TRAIN})),
c AS (SELECT {LABEL} AS cls, count(*) AS n FROM t WHERE {LABEL} IS NOT NULL GROUP BY 1),
wt AS (SELECT cls, CAST((SELECT sum(n) FROM c) AS DOUBLE) / ((SELECT count(*) FROM c) * n) AS w FROM c),
st AS ({stats}),
lv AS ({levels}),
rw AS (SELECT t.row_id, t.{LABEL} AS y, wt.w FROM t JOIN wt ON wt.cls = t.{LABEL}),
wsum AS (SELECT sum(w) AS ws FROM rw),
xl AS ({numeric_long}
UNION ALL
{cat_long}),
res AS (SELECT rw.row_id, wt.cls,
               rw.w * ({O.d(1)} / {k_sql} - CASE WHEN rw.y = wt.cls THEN {O.d(1)} ELSE {O.d(0)} END) AS r
        FROM rw, wt),
g AS (SELECT res.cls, xl.feature, sum(res.r * xl.x) AS g FROM res JOIN xl ON xl.row_id = res.row_id
      GROUP BY 1, 2
      UNION ALL
      SELECT cls, '(intercept)' AS feature, sum(r) AS g FROM res GROUP BY 1),
stepped AS (SELECT cls, feature,
                   -{O.d(cfg.rate)} * (g / (SELECT ws FROM wsum)) AS a FROM g)
SELECT cls AS class, feature,
       round(CASE WHEN feature = '(intercept)' THEN a
                  WHEN abs(a) > {O.d(cfg.rate * cfg.l1)} THEN sign(a) * (abs(a) - {O.d(cfg.rate * cfg.l1)})
                  ELSE {O.d(0)} END, {R6})
         AS weight
FROM stepped
"""


@register("gd_first_step", _first_step_sql())
def q_gd_first_step(spark, sf_dir):
    train, _ = split(training(spark, sf_dir))
    return first_step(train).select("class", "feature", F.round("weight", R6).alias("weight"))


# ----------------------------------------------------------------- training --

def _descent_sql(steps: int) -> str:
    """The trainer in SQL: one column per coefficient, one recursion per step."""
    cfg = TrainConfig()
    levels = [(c, v) for c, names in (("weather_condition", RV.WEATHER_LABELS), ("state_province", RV.STATES))
              for v in sorted(names)]
    features = [*cfg.numeric, *(f"{c}={v}" for c, v in levels)]
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_samp(CAST({c} AS DOUBLE)) AS s{i}"
                      for i, c in enumerate(cfg.numeric))
    xs = [f"coalesce((CAST({c} AS DOUBLE) - m{i}) / CASE WHEN s{i} > 0 THEN s{i} ELSE {O.d(1)} END, {O.d(0)}) AS x{i}"
          for i, c in enumerate(cfg.numeric)]
    xs += [f"CASE WHEN {c} = {O.s(v)} THEN {O.d(1)} ELSE {O.d(0)} END AS x{len(cfg.numeric) + i}"
           for i, (c, v) in enumerate(levels)]
    k, n = range(len(CLASSES)), range(len(features))
    logits = ", ".join(f"b{c} + " + " + ".join(f"w{c}_{j} * x{j}" for j in n) + f" AS l{c}" for c in k)
    top = "greatest(" + ", ".join(f"l{c}" for c in k) + ")"
    exps = ", ".join(f"exp(l{c} - {top}) AS e{c}" for c in k)
    residuals = ", ".join(f"w * (e{c} / ({' + '.join(f'e{i}' for i in k)}) - CASE WHEN y = {O.s(CLASSES[c])} "
                          f"THEN {O.d(1)} ELSE {O.d(0)} END) AS r{c}" for c in k)
    rate, t = O.d(cfg.rate), O.d(cfg.rate * cfg.l1)
    steps_sql = [f"any_value(b{c}) - {rate} * sum(r{c}) / sum(w) AS b{c}" for c in k]
    steps_sql += [f"any_value(w{c}_{j}) - {rate} * (sum(r{c} * x{j}) / sum(w) + {O.d(cfg.l2)} * any_value(w{c}_{j})) AS w{c}_{j}"
                  for c in k for j in n]
    shrink = [f"b{c}" for c in k] + [
        f"CASE WHEN abs(w{c}_{j}) > {t} THEN sign(w{c}_{j}) * (abs(w{c}_{j}) - {t}) ELSE {O.d(0)} END AS w{c}_{j}"
        for c in k for j in n]
    zero = [f"{O.d(0)} AS b{c}" for c in k] + [f"{O.d(0)} AS w{c}_{j}" for c in k for j in n]
    out = [f"SELECT {O.s(CLASSES[c])} AS class, '(intercept)' AS feature, round(b{c}, 4) AS weight FROM last" for c in k]
    # a level that no training row has is no feature
    there = ["" for _ in cfg.numeric] + [f" WHERE EXISTS (SELECT 1 FROM t WHERE {c} = {O.s(v)})" for c, v in levels]
    out += [f"SELECT {O.s(CLASSES[c])}, {O.s(features[j])}, round(w{c}_{j}, 4) FROM last{there[j]}" for c in k for j in n]
    return f"""
WITH RECURSIVE t AS ({O.TRAIN}),
c AS (SELECT {LABEL} AS cls, count(*) AS n FROM t WHERE {LABEL} IS NOT NULL GROUP BY 1),
wt AS (SELECT cls, CAST((SELECT sum(n) FROM c) AS DOUBLE) / ((SELECT count(*) FROM c) * n) AS w FROM c),
st AS (SELECT {stats} FROM t),
x AS (SELECT {LABEL} AS y, w, {', '.join(xs)} FROM t JOIN wt ON cls = {LABEL}, st),
it AS (
  SELECT 0 AS step, {', '.join(zero)}
  UNION ALL
  SELECT step + 1 AS step, {', '.join(shrink)} FROM (
    SELECT step, {', '.join(steps_sql)}
    FROM (SELECT *, {residuals} FROM (SELECT *, {exps} FROM (SELECT *, {logits} FROM it, x))) GROUP BY step)
  WHERE step < {steps}),
last AS (SELECT * FROM it WHERE step = {steps})
""" + "\nUNION ALL\n".join(out)


@register("train_gd", _descent_sql(RV.MAX_ITERATIONS))
def q_train_gd(spark, sf_dir):
    """All coefficients after the full number of steps."""
    train, _ = split(training(spark, sf_dir))
    return spark.createDataFrame(train_gd(train).coefficient_rows(), "class string, feature string, weight double").select(
        "class", "feature", F.round("weight", 4).alias("weight"))


@register("train_lr_converged", f"""
WITH t AS ({O.TRAIN}),
f AS (SELECT unnest({O.str_list(['(intercept)'] + TrainConfig().numeric)}) AS feature
      UNION SELECT DISTINCT 'weather_condition=' || weather_condition FROM t WHERE weather_condition IS NOT NULL
      UNION SELECT DISTINCT 'state_province=' || state_province FROM t WHERE state_province IS NOT NULL)
SELECT class, feature, true AS optimal
FROM (SELECT DISTINCT {LABEL} AS class FROM t WHERE {LABEL} IS NOT NULL), f
""")
def q_train_lr_converged(spark, sf_dir):
    """Whether each coefficient of the converged model is optimal, computed over the table."""
    train, _ = split(training(spark, sf_dir))
    return optimality(train, train_lr(train))


# ------------------------------------------------------------------ scoring --

_PRED_OUT = ["station_id", "state_province", "temperature_celsius", "humidity_percent",
             "wind_speed_ms", "month"]


@register("predict_fixed_model", f"""
SELECT {', '.join(_PRED_OUT)}, {PRED},
       {', '.join(f'round(prob_{c}, {R6}) AS prob_{c}' for c in CLASSES)},
       {FIRST_LABEL_SQL} AS first_label, round({FIRST_PROB_SQL}, {R6}) AS first_prob
FROM ({PRED_SQL}) p
""")
def q_predict_fixed_model(spark, sf_dir):
    p = predictions(spark, sf_dir)
    label, prob = top_of(CLASSES)
    return p.select(*_PRED_OUT, PRED, *[F.round(f"prob_{c}", R6).alias(f"prob_{c}") for c in CLASSES],
                    label.alias("first_label"), F.round(prob, R6).alias("first_prob"))


@register("predict_joined_coefficients", f"""
SELECT {', '.join(_PRED_OUT)}, {PRED}, {', '.join(f'round(prob_{c}, {R6}) AS prob_{c}' for c in CLASSES)}
FROM ({PRED_SQL}) p
""")
def q_predict_joined_coefficients(spark, sf_dir):
    """The same scores with the coefficients of levels in a table that is joined."""
    p = predict_table(as_table_model(spark, FIXED), label_rows(engineer(obs(spark, sf_dir))), prob_columns=True)
    return p.select(*_PRED_OUT, PRED, *[F.round(f"prob_{c}", R6).alias(f"prob_{c}") for c in CLASSES])


@register("train_gd_table", _descent_sql(RV.MAX_ITERATIONS))
def q_train_gd_table(spark, sf_dir):
    """All coefficients after the full number of steps, with the weights of levels in a table."""
    train, _ = split(training(spark, sf_dir))
    return train_gd_table(train, TrainConfig()).coefficient_table().select(
        "class", "feature", F.round("weight", 4).alias("weight"))


def _position_sql(c: str) -> str:
    others = [o for o in CLASSES if o != c]
    terms = " + ".join(
        f"CASE WHEN prob_{o} > prob_{c} OR (prob_{o} = prob_{c} AND '{o}' < '{c}') THEN 1 ELSE 0 END"
        for o in others)
    return f"CAST({terms} AS INTEGER)"


@register("probs_array", "\nUNION ALL\n".join(
    f"SELECT station_id, temperature_celsius, humidity_percent, {_position_sql(c)} AS pos, "
    f"'{c}' AS label, round(prob_{c}, {R6}) AS prob FROM ({PRED_SQL}) p" for c in CLASSES))
def q_probs_array(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.select("station_id", "temperature_celsius", "humidity_percent",
                    F.posexplode_outer(PROBS).alias("pos", "e")).select(
        "station_id", "temperature_celsius", "humidity_percent", "pos",
        F.col("e.label").alias("label"), F.round("e.prob", R6).alias("prob"))


# --------------------------------------------------------------- evaluation --

@register("confusion_matrix", f"""
SELECT {LABEL} AS actual, {PRED} AS predicted, count(*) AS n FROM ({PRED_SQL}) p GROUP BY 1, 2
""")
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion(predictions(spark, sf_dir), LABEL, PRED)


_CM_SQL = f"SELECT {LABEL} AS actual, {PRED} AS predicted, count(*) AS n FROM ({PRED_SQL}) p GROUP BY 1, 2"


@register("eval_accuracy_macro", f"""
WITH cm AS ({_CM_SQL}),
pc AS (SELECT cls, sum(support) AS support, sum(correct) AS correct, sum(pred) AS pred FROM (
         SELECT actual AS cls, n AS support, CASE WHEN actual = predicted THEN n ELSE 0 END AS correct,
                0 AS pred FROM cm
         UNION ALL
         SELECT predicted AS cls, 0, 0, n FROM cm) x GROUP BY cls),
m AS (SELECT cls, support, correct,
             CASE WHEN pred > 0 THEN correct / pred ELSE {O.d(0)} END AS p,
             CASE WHEN support > 0 THEN correct / support ELSE {O.d(0)} END AS r FROM pc)
SELECT round(sum(correct) / sum(support), {R9}) AS accuracy,
       round(avg(p), {R9}) AS precision, round(avg(r), {R9}) AS recall,
       round(avg(CASE WHEN p + r > 0 THEN {O.d(2)} * p * r / (p + r) ELSE {O.d(0)} END), {R9}) AS f1_score
FROM m
""")
def q_eval_accuracy_macro(spark, sf_dir):
    cm = EV.confusion(predictions(spark, sf_dir), LABEL, PRED)
    m = EV.macro_metrics(cm)
    return m.select(*[F.round(c, R9).alias(c) for c in ("accuracy", "precision", "recall", "f1_score")])


@register("eval_log_loss", f"""
SELECT round(avg(-ln(greatest(CASE {LABEL} {' '.join(f"WHEN '{c}' THEN prob_{c}" for c in CLASSES)}
                                  ELSE {O.d(0)} END, {O.d(1e-15)}))), {R6}) AS log_loss
FROM ({PRED_SQL}) p WHERE {LABEL} IS NOT NULL
""")
def q_eval_log_loss(spark, sf_dir):
    ll = EV.log_loss(predictions(spark, sf_dir), LABEL, {c: f"prob_{c}" for c in CLASSES})
    return ll.select(F.round("log_loss", R6).alias("log_loss"))


def _auc_sql() -> str:
    exploded = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS cls, prob_{c} AS score, CASE WHEN {LABEL} = '{c}' THEN 1 ELSE 0 END AS pos "
        f"FROM ({PRED_SQL}) p WHERE {LABEL} IS NOT NULL" for c in CLASSES)
    return f"""
WITH e AS ({exploded}),
g AS (SELECT cls, score, sum(pos) AS n_pos, sum(1 - pos) AS n_neg FROM e GROUP BY 1, 2),
r AS (SELECT cls, n_pos, n_neg,
             COALESCE(sum(n_neg) OVER (PARTITION BY cls ORDER BY score
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g),
c AS (SELECT cls, sum(n_pos * (below + {O.d(0.5)} * n_neg)) AS num,
             CAST(sum(n_pos) AS BIGINT) AS n_pos, CAST(sum(n_neg) AS BIGINT) AS n_neg FROM r GROUP BY cls)
"""


@register("eval_auc_by_class", _auc_sql() + f"""
SELECT cls, n_pos, n_neg,
       round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN num / (CAST(n_pos AS DOUBLE) * n_neg) END, {R9}) AS auc
FROM c
""")
def q_eval_auc_by_class(spark, sf_dir):
    p = scored_columns(spark, sf_dir)
    a = EV.auc_by_class(p, LABEL, {c: f"p_{c}" for c in CLASSES})
    return a.select("cls", "n_pos", "n_neg", F.round("auc", R9).alias("auc"))


@register("eval_roc_auc", _auc_sql() + f"""
SELECT round(avg(CASE WHEN n_pos > 0 AND n_neg > 0 THEN num / (CAST(n_pos AS DOUBLE) * n_neg) END),
             {R9}) AS roc_auc
FROM c
""")
def q_eval_roc_auc(spark, sf_dir):
    p = scored_columns(spark, sf_dir)
    a = EV.roc_auc(p, LABEL, {c: f"p_{c}" for c in CLASSES})
    return a.select(F.round("roc_auc", R9).alias("roc_auc"))


# ------------------------------------------------------------------ serving --

def _record_sql(prob_expr: str = FIRST_PROB_SQL) -> str:
    return (f"station_id, state_province, NULLIF(temperature_celsius, {O.d(0)}) AS temperature_celsius, "
            f"NULLIF(humidity_percent, {O.d(0)}) AS humidity_percent, "
            f"NULLIF(wind_speed_ms, {O.d(0)}) AS wind_speed_ms, "
            f"NULLIF(precipitation_mm, {O.d(0)}) AS precipitation_mm, weather_condition, "
            f"{PRED} AS predicted_risk_level, "
            f"round(NULLIF({prob_expr}, {O.d(0)}), {R6}) AS risk_probability, "
            f"round(prob_{SV.HIGH}, {R6}) AS high_risk_prob, "
            f"{iso_sql('timestamp')} AS timestamp")


_ORDER_SQL = ", ".join(SV.RECORD_ORDER)


def _rounded_records(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, R6) for c in ("risk_probability", "high_risk_prob")})


@register("current_predictions", f"""
SELECT row_number() OVER (ORDER BY round({FIRST_PROB_SQL}, {R9}) DESC, {_ORDER_SQL}, {PRED}, {FIRST_LABEL_SQL},
                          {FIRST_PROB_SQL}, prob_{SV.HIGH}) AS rank_position, {_record_sql()}
FROM ({PRED_SQL}) p
""")
def q_current_predictions(spark, sf_dir):
    return _rounded_records(SV.current_predictions(predictions(spark, sf_dir), digits=R9))


_TIE_SQL = f"{_ORDER_SQL}, {PRED}, {FIRST_LABEL_SQL}, {FIRST_PROB_SQL}, prob_{SV.HIGH}"


@register("prediction_for_state", f"""
SELECT {_record_sql()} FROM ({PRED_SQL}) p
WHERE lower(state_province) = lower('{STATE_PARAM}')
ORDER BY {_TIE_SQL}
LIMIT 1
""")
def q_prediction_for_state(spark, sf_dir):
    return _rounded_records(SV.prediction_for_state(predictions(spark, sf_dir), STATE_PARAM))


def requests_from_supplier(supplier: DataFrame) -> DataFrame:
    """One lookup per supplier: a state name in upper case, or an unknown region."""
    names = F.array(*[F.lit(x) for x in RV.STATES])
    k = F.col("s_suppkey") % 20
    return supplier.select(
        F.when(k < 16, F.upper(F.element_at(names, (k + 1).cast("int"))))
        .otherwise(F.concat(F.lit("Region-"), F.col("s_suppkey").cast("string")))
        .alias("requested_state"))


@register("lookup_states_batch", f"""
WITH req AS (
  SELECT CASE WHEN s_suppkey % 20 < 16 THEN upper(({O.str_list(RV.STATES)})[s_suppkey % 20 + 1])
              ELSE 'Region-' || CAST(s_suppkey AS VARCHAR) END AS requested_state
  FROM supplier),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lower(state_province) ORDER BY {_TIE_SQL}) AS rn
  FROM ({PRED_SQL}) p),
firsts AS (SELECT lower(state_province) AS state_key, {_record_sql()} FROM ranked WHERE rn = 1)
SELECT req.requested_state, firsts.state_key IS NOT NULL AS found,
       firsts.station_id, firsts.state_province, firsts.temperature_celsius, firsts.humidity_percent,
       firsts.wind_speed_ms, firsts.precipitation_mm, firsts.weather_condition,
       firsts.predicted_risk_level, firsts.risk_probability, firsts.high_risk_prob, firsts.timestamp
FROM req LEFT JOIN firsts ON lower(req.requested_state) = firsts.state_key
""")
def q_lookup_states_batch(spark, sf_dir):
    req = requests_from_supplier(read_table(spark, sf_dir, "supplier"))
    return _rounded_records(SV.lookup(req, predictions(spark, sf_dir)))


@register("lookup_saved_states", ORACLE["lookup_states_batch"])
def q_lookup_saved_states(spark, sf_dir):
    """The same lookups answered from a stored predictions table, of which only the
    requested regions are read."""
    req = requests_from_supplier(read_table(spark, sf_dir, "supplier"))
    with CAT.scratch_namespace(spark, "serving") as ns:
        CAT.save_predictions(predictions(spark, sf_dir), namespace=ns)
        saved = CAT.read_saved(spark, RV.PREDICTIONS_TABLE, ns)
        return stored(_rounded_records(SV.lookup_saved(req, saved)), "lookups")


PAGE = (101, 250)


@register("ranked_page", f"""SELECT * FROM ({ORACLE["current_predictions"]}) r
WHERE rank_position BETWEEN {PAGE[0]} AND {PAGE[1]}""")
def q_ranked_page(spark, sf_dir):
    """One page of the stored ranking."""
    path = scratch_path(spark, "ranked")
    SV.save_ranked_predictions(predictions(spark, sf_dir), path, digits=R9)
    return _rounded_records(SV.ranked_predictions(spark, path, *PAGE))


@register("model_info", f"""
WITH t AS ({O.TRAIN})
SELECT 'spark_catalog' AS model_catalog, 'own' AS model_schema, '{RV.DEFAULT_MODEL_NAME}' AS model_name,
       '{RV.MODEL_TYPE}' AS model_type, '2' AS version,
       '[' || string_agg('"' || c || '"', ', ' ORDER BY c) || ']' AS classes, CAST(NULL AS VARCHAR) AS error
FROM (SELECT DISTINCT {LABEL} AS c FROM t WHERE {LABEL} IS NOT NULL)
UNION ALL SELECT NULL, NULL, 'missing_model', NULL, NULL, NULL, 'Model not found'
""")
def q_model_info(spark, sf_dir):
    """The registry's answer, without times, on a model trained on the table and saved twice,
    and on one that nobody saved."""
    train, _ = split(training(spark, sf_dir))
    model = train_gd(train, TrainConfig(iterations=1))
    with CAT.scratch_namespace(spark, "registry") as ns:
        for _ in range(2):
            CAT.save_model(spark, model, ns)
        CAT.compact_registry(spark, ns)
        names = spark.createDataFrame([(model.name,), ("missing_model",)], "model_name string")
        info = SV.model_info_batch(CAT.registry(spark, ns), names)
        return stored(info.select("model_catalog", F.when(F.col("model_schema") == F.lit(ns), "own").alias("model_schema"),
                                  "model_name", "model_type", F.col("version").cast("string").alias("version"), "classes", "error"), "info")


@register("available_states", f"""
SELECT CAST(row_number() OVER (ORDER BY state_province NULLS FIRST) - 1 AS INTEGER) AS state_index,
       state_province, count(*) OVER () AS n_states
FROM (SELECT DISTINCT state_province FROM ({PRED_SQL}) p) s
""")
def q_available_states(spark, sf_dir):
    return SV.available_states(predictions(spark, sf_dir))


@register("sample_top5", f"""
SELECT station_id, state_province, temperature_celsius, humidity_percent, {PRED},
       round({FIRST_PROB_SQL}, {R6}) AS high_risk_probability, round(prob_{SV.HIGH}, {R6}) AS high_risk_prob
FROM ({PRED_SQL}) p
ORDER BY {FIRST_PROB_SQL} DESC, {_TIE_SQL}
LIMIT 5
""")
def q_sample_top5(spark, sf_dir):
    s = SV.sample_predictions(predictions(spark, sf_dir), 5)
    return s.withColumns({c: F.round(c, R6) for c in ("high_risk_probability", "high_risk_prob")})


_SAMPLE_COLS = ["station_id", "state_province", "temperature_celsius", "humidity_percent",
                "wind_speed_ms", "precipitation_mm", "pressure_hpa", "wind_direction_degrees",
                "visibility_km", "elevation_meters", "weather_condition", "month"]


@register("sample_limit", f"""
SELECT {', '.join(_SAMPLE_COLS)}, {PRED} FROM ({PRED_SQL}) p
ORDER BY {', '.join(_SAMPLE_COLS)}, {PRED}
LIMIT 10
""")
def q_sample_limit(spark, sf_dir):
    p = predictions(spark, sf_dir).select(*_SAMPLE_COLS, PRED)
    return SV.sample_rows(p, _SAMPLE_COLS + [PRED], 10)


@register("run_summary", _auc_sql() + f""",
cm AS ({_CM_SQL})
SELECT 'training_rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM lineitem
UNION ALL
SELECT 'prediction_rows', CAST(count(*) AS VARCHAR) FROM lineitem
UNION ALL
SELECT 'accuracy', COALESCE(CAST(round(sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n), {R6})
                                   AS VARCHAR), 'N/A') FROM cm
UNION ALL
SELECT 'roc_auc', COALESCE(CAST(round(avg(CASE WHEN n_pos > 0 AND n_neg > 0
                                               THEN num / (CAST(n_pos AS DOUBLE) * n_neg) END), {R6})
                                AS VARCHAR), 'N/A') FROM c
""")
def q_run_summary(spark, sf_dir):
    # scored once: all figures come from the stored narrow columns
    plain = {c: f"prob_{c}" for c in CLASSES}
    preds = stored(predictions(spark, sf_dir).select(LABEL, PRED, *plain.values()), "summary")
    acc = EV.macro_metrics(EV.confusion(preds, LABEL, PRED)).select(F.round("accuracy", R6))
    auc = EV.roc_auc(preds, LABEL, plain).select(F.round("roc_auc", R6))
    return SV.summary_rows(preds, preds, {"accuracy": acc, "roc_auc": auc})


# ---------------------------------------------------------- row numbering --

@register("row_numbered_events", """
SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) AS row_id FROM events
""")
def q_row_numbered_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return with_row_id(ev, ["ts", "event_id"]).select("event_id", "user_id", "row_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
