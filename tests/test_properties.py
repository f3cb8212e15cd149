"""Property-based: Spark scores and rule labels equal a plain statement of the rules."""

from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.functions.scores import humidity_risk_score, temp_risk_score, wildfire_rule_label

EDGES = [10.0, 20.0, 25.0, 29.999, 30.0, 30.001, 40.0, 50.0, 60.0, 0.0]
value = st.one_of(st.none(), st.sampled_from(EDGES),
                  st.floats(min_value=-50, max_value=120, allow_nan=False))


def expected(t, h, w):
    ts = 2 if t is None else (4 if t > 25 else 3 if t > 20 else 2)
    hs = 2 if h is None else (4 if h < 40 else 3 if h < 60 else 2)
    if None not in (t, h, w) and t > 30 and h < 30 and w > 10:
        lab = "high"
    elif None not in (t, h) and t > 25 and h < 50:
        lab = "moderate"
    else:
        lab = "low"
    return ts, hs, lab


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(value, value, value), min_size=1, max_size=300))
def test_scores_and_labels_match_rules(spark, rows):
    df = spark.createDataFrame(rows, "temperature_celsius double, humidity_percent double, "
                                     "wind_speed_ms double")
    got = df.select("temperature_celsius", "humidity_percent", "wind_speed_ms",
                    temp_risk_score().alias("ts"), humidity_risk_score().alias("hs"),
                    wildfire_rule_label().alias("lab")).collect()
    for r in got:
        assert (r.ts, r.hs, r.lab) == expected(r.temperature_celsius, r.humidity_percent,
                                               r.wind_speed_ms)
