"""Equivalent SQL (DuckDB dialect) for the registered queries.

Each string recomputes a query from the raw tables, independently of Spark:
the hash uniforms with ``md5``, the observation view with list indexing, the
fixed model with CASE lookups and ``exp``.  Doubles are written as exponent
literals (``1.5e+00``), which DuckDB reads as DOUBLE, never as DECIMAL.
"""

from __future__ import annotations

from .. import reference_values as RV
from ..operators.model import LinearModel

SEED = 42


def d(x: float) -> str:
    """An exact DOUBLE literal."""
    return format(float(x), ".17e")


def s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def str_list(xs) -> str:
    return "[" + ", ".join(s(x) for x in xs) + "]"


def uniform(site: str, id_expr: str = "row_id", seed: int = SEED) -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', {s(str(seed))}, {s(site)}, "
            f"CAST({id_expr} AS VARCHAR))), 1, 13))::BIGINT / {d(2.0 ** 52)})")


def cascade(name: str, labels, thresholds, id_expr="row_id") -> str:
    parts = [f"WHEN {uniform(f'{name}_{k}', id_expr)} < {d(t)} THEN {s(lab)}"
             for k, (lab, t) in enumerate(zip(labels, thresholds), start=1)]
    return "CASE " + " ".join(parts) + f" ELSE {s(labels[-1])} END"


def temp_score(col="temperature_celsius") -> str:
    (c1, v1), (c2, v2) = RV.TEMP_SCORE_CUTS
    return (f"CAST(CASE WHEN {col} > {d(c1)} THEN {v1} WHEN {col} > {d(c2)} THEN {v2} "
            f"ELSE {RV.TEMP_SCORE_DEFAULT} END AS BIGINT)")


def humidity_score(col="humidity_percent") -> str:
    (c1, v1), (c2, v2) = RV.HUMIDITY_SCORE_CUTS
    return (f"CAST(CASE WHEN {col} < {d(c1)} THEN {v1} WHEN {col} < {d(c2)} THEN {v2} "
            f"ELSE {RV.HUMIDITY_SCORE_DEFAULT} END AS BIGINT)")


def rule_label() -> str:
    hi, mo = RV.HIGH_RULE, RV.MODERATE_RULE
    return (f"CASE WHEN temperature_celsius > {d(hi['temperature_gt'])} "
            f"AND humidity_percent < {d(hi['humidity_lt'])} AND wind_speed_ms > {d(hi['wind_gt'])} "
            f"THEN 'high' WHEN temperature_celsius > {d(mo['temperature_gt'])} "
            f"AND humidity_percent < {d(mo['humidity_lt'])} THEN 'moderate' ELSE 'low' END")


# ------------------------------------------------------------ observations --

OBS = f"""
SELECT 'station_' || CAST(l_suppkey % 16 + 1 AS VARCHAR) AS station_id,
       ({str_list(RV.STATES)})[l_suppkey % 16 + 1] AS state_province,
       l_shipdate AS timestamp,
       {d(10)} + l_quantity / {d(2)} AS temperature_celsius,
       {d(20)} + l_discount * {d(700)} AS humidity_percent,
       {d(990)} + (l_partkey % 200) / {d(10)} AS pressure_hpa,
       l_tax * {d(187.5)} AS wind_speed_ms,
       CAST(l_orderkey % 360 AS DOUBLE) AS wind_direction_degrees,
       CASE WHEN l_linenumber = 1 THEN {d(0)} ELSE l_extendedprice / {d(21000)} END AS precipitation_mm,
       CAST(l_orderkey % 100 AS DOUBLE) / {d(10)} AS visibility_km,
       ({str_list(RV.WEATHER_LABELS)})[l_partkey % 5 + 1] AS weather_condition,
       {d(50)} + CAST(l_partkey % 1500 AS DOUBLE) AS elevation_meters,
       CAST(month(l_shipdate) AS BIGINT) AS month
FROM lineitem
"""

ENGINEERED = f"""
SELECT *, {temp_score()} AS temp_risk_score, {humidity_score()} AS humidity_risk_score
FROM ({OBS}) o
"""

LABELED = f"""
SELECT *, {rule_label()} AS wildfire_risk_label FROM ({ENGINEERED}) e
"""

# --------------------------------------------------------------- generator --


def _gen_base(id_source: str) -> str:
    cols = ["row_id"]
    for name, (scale, offset) in RV.NUMERIC_DRAWS.items():
        cols.append(f"{uniform(name)} * {d(scale)} + {d(offset)} AS {name}")
    cols.append(f"'station_' || CAST(CAST(floor({uniform('station_id')} * {d(RV.STATION_COUNT)}) + 1 "
                f"AS BIGINT) AS VARCHAR) AS station_id")
    cols.append(f"{uniform('elevation_meters')} * {d(RV.ELEVATION_DRAW[0])} + "
                f"{d(RV.ELEVATION_DRAW[1])} AS elevation_meters")
    cols.append(f"{cascade('weather', RV.WEATHER_LABELS, RV.WEATHER_THRESHOLDS)} AS weather_condition")
    cols.append(f"{cascade('state', RV.STATES, RV.STATE_THRESHOLDS)} AS state_province")
    cols.append(f"CAST(floor({uniform('month')} * {d(RV.MONTH_COUNT)}) + 1 AS BIGINT) AS month")
    return "SELECT " + ",\n       ".join(cols) + f"\nFROM {id_source}"


def _centroid_case(pos: int, default: float) -> str:
    whens = " ".join(f"WHEN {s(k)} THEN {d(v[pos])}" for k, v in RV.CENTROIDS.items())
    return f"COALESCE(CASE state_province {whens} END, {d(default)})"


def _coordinates() -> str:
    dl = RV.DEFAULT_CENTROID
    lon = (f"{_centroid_case(0, dl[0])} + ({uniform('longitude')} - {d(0.5)}) * "
           f"{_centroid_case(1, dl[1])}")
    lat = (f"{_centroid_case(2, dl[2])} + ({uniform('latitude')} - {d(0.5)}) * "
           f"{_centroid_case(3, dl[3])}")
    return f"{lon} AS longitude, {lat} AS latitude"


GEN_IDS = "(SELECT range AS row_id FROM range(1, (SELECT count(*) FROM lineitem) + 1)) ids"

GEN_BASE = _gen_base(GEN_IDS)

GEN = f"""
SELECT *, {temp_score()} AS temp_risk_score, {humidity_score()} AS humidity_risk_score,
       {rule_label()} AS wildfire_risk_label
FROM (SELECT *, {_coordinates()} FROM ({GEN_BASE}) b) c
"""


# ---------------------------------------------------- training on lineitem --

KEYED = OBS.replace("SELECT 'station_'", "SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,\n"
                    "       'station_'", 1)

TRAINING = f"""
SELECT *, {temp_score()} AS temp_risk_score, {humidity_score()} AS humidity_risk_score,
       {rule_label()} AS wildfire_risk_label
FROM (SELECT *, {_coordinates()} FROM ({KEYED}) b) c
"""


def split_flag(eval_fraction: float = RV.EVAL_FRACTION) -> str:
    return f"({uniform('split')} < {d(eval_fraction)})"


TRAIN = f"SELECT * FROM ({TRAINING}) g WHERE NOT {split_flag()}"

# ------------------------------------------------------------------- model --


def logit_sql(model: LinearModel, k: int) -> str:
    w = model.weights[k]
    pre = model.pre
    expr = d(model.intercepts[k])
    for j, c in enumerate(pre.numeric):
        std = (f"COALESCE((CAST({c} AS DOUBLE) - {d(pre.means[j])}) / {d(pre.stds[j])}, "
               f"{d(0.0)})")
        expr = f"({expr} + {d(w[j])} * {std})"
    j = len(pre.numeric)
    for c in pre.categorical:
        levels = pre.vocab[c]
        if levels:
            whens = " ".join(f"WHEN {s(v)} THEN {d(w[j + i])}" for i, v in enumerate(levels))
            expr = f"({expr} + COALESCE(CASE CAST({c} AS VARCHAR) {whens} END, {d(0.0)}))"
        j += len(levels)
    return expr


def predict_sql(model: LinearModel, source: str) -> str:
    """``source`` columns + ``_l{k}`` logits + ``prob_{class}`` + predicted label."""
    k = len(model.classes)
    logits = ", ".join(f"{logit_sql(model, i)} AS _l{i}" for i in range(k))
    m = "greatest(" + ", ".join(f"_l{i}" for i in range(k)) + ")"
    exps = ", ".join(f"exp(_l{i} - {m}) AS _e{i}" for i in range(k))
    total = " + ".join(f"_e{i}" for i in range(k))
    probs = ", ".join(f"_e{i} / ({total}) AS prob_{c}" for i, c in enumerate(model.classes))
    conds = []
    for i, c in enumerate(model.classes):
        parts = [f"_l{i} > _l{j}" if j < i else f"_l{i} >= _l{j}" for j in range(k) if j != i]
        conds.append(f"WHEN {' AND '.join(parts) if parts else 'TRUE'} THEN {s(c)}")
    pred = f"CASE {' '.join(conds)} ELSE {s(model.classes[0])} END"
    label = f"predicted_{model.label}"
    return f"""
SELECT *, {probs}, {pred} AS {label}
FROM (SELECT *, {exps} FROM (SELECT *, {logits} FROM ({source}) src) l1) l2
"""


def first_label_prob_sql(model: LinearModel) -> tuple[str, str]:
    """SQL for the first element of the (prob desc, label asc) array."""
    cs = model.classes
    first_prob = "greatest(" + ", ".join(f"prob_{c}" for c in cs) + ")"
    conds = []
    for i, c in enumerate(cs):
        parts = [f"prob_{c} > prob_{o}" if j < i else f"prob_{c} >= prob_{o}"
                 for j, o in enumerate(cs) if j != i]
        conds.append(f"WHEN {' AND '.join(parts)} THEN {s(c)}")
    first_label = f"CASE {' '.join(conds)} ELSE {s(cs[0])} END"
    return first_label, first_prob
