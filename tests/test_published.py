"""Published result figures, as constants, recomputed from their own counts."""

import pytest

from usertide.functions.numeric import evenly_spaced
from usertide.plans.evaluation import add_class_metrics
from usertide.plans.scoring import segment_summary

# Tn, fp, fn, tp -> precision, recall, F1 of the positive class.
CONFUSIONS = [
    ((0, 152, 0, 848), (0.848, 1.0, 0.9177489177489178)),
    ((132, 20, 37, 811), (0.97593, 0.95637, 0.96605)),
    ((152, 0, 848, 0), (0.0, 0.0, 0.0)),
]


@pytest.mark.parametrize("cells, want", CONFUSIONS)
def test_metrics_of_published_counts(spark, cells, want):
    df = spark.createDataFrame([cells], "tn bigint, fp bigint, fn bigint, tp bigint")
    row = add_class_metrics(df).first()
    assert (row["precision_pos"], row["recall_pos"], row["f1_pos"]) == pytest.approx(want, abs=5e-6)
    assert row["support_pos"] == 848 and row["support_neg"] == 152


def test_second_threshold_of_the_published_sweep():
    assert evenly_spaced(0.01, 0.99, 60)[1] == pytest.approx(0.02661016949152542, abs=1e-15)


def test_published_segment_percentages(spark):
    """1,034 / 1,967 / 1,999 of 5,000 users, from scores whose ties put the cuts there."""
    rows = [(i, 0.1 if i < 1999 else 0.5 if i < 3966 else 1.0) for i in range(5000)]
    df = spark.createDataFrame(rows, "user_id int, score double")
    # One tie block each: mean ranks 20, 59.65 and 89.66 percent.
    got = {r["risk_segment"]: (r["user_count"], r["pct"]) for r in segment_summary(df).collect()}
    assert got == {"High Risk": (1034, 20.68), "Medium Risk": (1967, 39.34), "Low Risk": (1999, 39.98)}
