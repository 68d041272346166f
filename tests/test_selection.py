"""Radix selection against a sort, and the order of the bits."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from usertide.operators import ranking, selection, stats

ODD = [0.0, -0.0, 1.0, -1.0, 2.0, 0.5, 1 - 2**-53, 1 + 2**-52, 2**-1022, 2**-1022 - 2**-1074, 5e-324, -5e-324, 1.7976931348623157e308, float("inf"), -float("inf"), 3.0, 1e-300, 123456.789, 4 - 2**-51, 2.0**52, 2.0**53 + 2]


def bits(x):
    size = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -size if x < 0 else size


def test_bits_are_those_of_the_double(spark):
    rng = np.random.default_rng(1)
    values = ODD + [float(x) for x in rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300)] + [float(2.0**e) for e in range(-1074, 1024, 13)] + [float(np.nextafter(2.0**e, 0)) for e in range(-1000, 1024, 17)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    df = selection.with_ordered_bits(df, "v", "b")
    assert [(r["v"], r["b"]) for r in df.collect()] == [(v, bits(v)) for v in values]


def ranked(rows, ranks):
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    return sorted(((g, r, sorted(groups[g])[r]) for g, r in ranks if g in groups and r < len(groups[g])), key=str)


@pytest.mark.parametrize("few", [0, 3, 10_000])
def test_ranks_equal_a_sort(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    rng = np.random.default_rng(few)
    rows = [("a", float(x)) for x in rng.normal(size=500)] + [("b", float(x)) for x in rng.integers(-3, 4, 400)] + [(None, v) for v in ODD if v == v]
    rows += [("a", None), ("a", float("nan")), ("hot", 7.25)] + [("hot", 1.5)] * 900
    ranks = [(g, r) for g in ("a", "b", None, "hot", "absent") for r in (0, 1, 7, 12, 20, 250, 399, 450, 899, 900, 5000)]
    got = selection.select_ranks(
        spark.createDataFrame(rows, "g string, v double").repartition(5), "v", spark.createDataFrame(ranks, "g string, rank long"), ["g"]
    ).collect()
    assert sorted(((r["g"], r["rank"], r["v"]) for r in got), key=str) == ranked(rows, ranks)


def test_ranks_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(selection, "BROADCAST_RANKS", 0)
    monkeypatch.setattr(selection, "FEW", 2)
    rows = [(i % 4, float(i * 37 % 101)) for i in range(400)]
    got = selection.select_ranks(spark.createDataFrame(rows, "g int, v double"), "v", spark.createDataFrame([(g, 50) for g in range(4)], "g int, rank long"), ["g"]).collect()
    assert sorted((r["g"], r["rank"], r["v"]) for r in got) == ranked(rows, [(g, 50) for g in range(4)])


@pytest.mark.parametrize("few", [0, 10_000])
def test_describe_stores_no_values(spark, monkeypatch, few):
    def refuse(*_, **__):
        raise AssertionError("a table of values")

    monkeypatch.setattr(ranking, "value_table", refuse)
    monkeypatch.setattr(selection, "FEW", few)
    data = np.random.default_rng(4).gamma(2.0, 3.0, 800)
    df = spark.createDataFrame([(float(x), float(-x * 1e6), i % 3) for i, x in enumerate(data)], "v double, w double, g int")
    rows = {r["metric"]: r for r in stats.describe(df, ["v", "w"], (0.1, 0.5, 0.999)).collect()}
    for name, want in (("v", data), ("w", -data * 1e6)):
        assert [rows[name][c] for c in ("p10", "p50", "p99_9")] == pytest.approx(list(np.quantile(want, [0.1, 0.5, 0.999])))
        assert rows[name]["std"] == pytest.approx(want.std(ddof=1))
    boxes = {r["g"]: r for r in stats.boxplot_stats(df, ["v"], "g").collect()}
    for g in range(3):
        want = data[g::3]
        q1, q3 = np.quantile(want, [0.25, 0.75])
        inside = want[(want >= q1 - 1.5 * (q3 - q1)) & (want <= q3 + 1.5 * (q3 - q1))]
        assert (boxes[g]["whisker_low"], boxes[g]["whisker_high"], boxes[g]["outliers"]) == (inside.min(), inside.max(), len(want) - len(inside))


def test_a_task_sends_counts_not_rows(spark):
    rows = spark.range(300_000).select(F.lit("m").alias("metric"), (F.rand(3) * 1000).alias("value"))
    sizes = rows.groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
    got = selection.quantiles(rows, "value", (0.5, 0.99), sizes, ["metric"]).first()
    want = np.quantile([r["value"] for r in rows.collect()], [0.5, 0.99])
    assert (got["p50"], got["p99"]) == pytest.approx(tuple(want))
