"""Exact classification metrics on scored rows: confusion, AUC, curves, thresholds, lift.

``label`` is 0/1 and ``score`` the probability of class 1; rows without a score are left out.  Everything
that needs an order works on one row per distinct score, ranked by :mod:`usertide.operators.ranking`, so
no step sorts all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usertide.functions.numeric import evenly_spaced, label_at
from usertide.operators.ranking import add_range, average_rank, ordered_counts, present


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(precision * recall * 2, precision + recall)


def _class_counts(label: str) -> dict[str, Column]:
    return {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)}


def _score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = (), previous: bool = False) -> DataFrame:
    rows = df.select(*by, F.col(label).alias("label"), F.col(score).alias("threshold"))
    return ordered_counts(rows, "threshold", _class_counts("label"), by, previous=previous)


# At threshold t every row scored t or more is called positive.
TRUE_POSITIVES = "pos_total - pos_before"
FALSE_POSITIVES = "neg_total - neg_before"


def confusion_matrix(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """One row: tn, fp, fn, tp at ``threshold``."""
    rows = df.select(F.col(label).alias("label"), present(F.col(score)).alias("score")).filter("score is not null")
    called = label_at(F.col("score"), threshold)
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return rows.agg(
        *[F.count_if((F.col("label") == true) & (called == said)).alias(name) for name, (true, said) in cells.items()]
    )


def add_class_metrics(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of both classes beside the four confusion counts; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = df.withColumns(
        {
            "precision_pos": _ratio(tp, tp + fp),
            "recall_pos": _ratio(tp, tp + fn),
            "support_pos": tp + fn,
            "precision_neg": _ratio(tn, tn + fn),
            "recall_neg": _ratio(tn, tn + fp),
            "support_neg": tn + fp,
        }
    )
    return out.withColumns(
        {
            "f1_pos": _f1(F.col("precision_pos"), F.col("recall_pos")),
            "f1_neg": _f1(F.col("precision_neg"), F.col("recall_neg")),
        }
    )


# Pairs of a positive and a negative that the positive wins, a tie counting half; a sum over scores.
WINS = "pos * (neg_before + neg / 2)"


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row (auc): the chance that a positive outscores a negative, ties counting half."""
    return _score_counts(df, label, score).agg(_auc(F.sum(F.expr(WINS)), F.max("pos_total"), F.max("neg_total")))


def _auc(wins: Column, positives: Column, negatives: Column) -> Column:
    return F.try_divide(wins, positives.cast("double") * negatives.cast("double")).alias("auc")


def evaluate_at(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """One row: threshold, auc, the confusion counts and the metrics of both classes."""
    called = label_at(F.col("threshold"), threshold)

    def rows_of(count: str, said: int) -> Column:
        return F.coalesce(F.sum(F.when(called == said, F.col(count))), F.lit(0))

    cells = _score_counts(df, label, score).agg(
        _auc(F.sum(F.expr(WINS)), F.max("pos_total"), F.max("neg_total")),
        rows_of("neg", 0).alias("tn"),
        rows_of("neg", 1).alias("fp"),
        rows_of("pos", 0).alias("fn"),
        rows_of("pos", 1).alias("tp"),
    )
    return add_class_metrics(cells).withColumn("threshold", F.lit(float(threshold)))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(fpr, tpr, threshold) from the highest score down, starting at (0, 0, infinity).

    Points on a straight run are left out: a score is kept when its class counts differ from those of
    the next lower score, or when it is the highest or lowest.
    """
    counts = _score_counts(df, label, score, previous=True)
    highest = (F.col("pos_before") + F.col("pos") == F.col("pos_total")) & (
        F.col("neg_before") + F.col("neg") == F.col("neg_total")
    )
    lowest = F.col("pos_previous").isNull()
    turns = (F.col("pos") != F.col("pos_previous")) | (F.col("neg") != F.col("neg_previous"))
    points = counts.filter(highest | lowest | turns).select(
        F.try_divide(F.expr(FALSE_POSITIVES).cast("double"), F.col("neg_total").cast("double")).alias("fpr"),
        F.try_divide(F.expr(TRUE_POSITIVES).cast("double"), F.col("pos_total").cast("double")).alias("tpr"),
        "threshold",
    )
    origin = df.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return origin.unionByName(points)


def precision_recall_at_scores(
    df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """(by..., recall, precision, threshold) at every distinct score."""
    tp, fp = F.expr(TRUE_POSITIVES).cast("double"), F.expr(FALSE_POSITIVES).cast("double")
    return _score_counts(df, label, score, by).select(
        *by,
        F.try_divide(tp, F.col("pos_total").cast("double")).alias("recall"),
        F.try_divide(tp, tp + fp).alias("precision"),
        "threshold",
    )


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(recall, precision, threshold) at every distinct score, closed by (0, 1) without a threshold."""
    end = df.sparkSession.range(1).select(
        F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"), F.lit(None).cast("double").alias("threshold")
    )
    return precision_recall_at_scores(df, label, score).unionByName(end)


def pick_threshold(
    df: DataFrame,
    min_recall: float = 0.60,
    min_precision: float = 0.15,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    best_f1: bool = False,
) -> DataFrame:
    """The lowest score reaching both minima, else the lowest score with the best F1; per group with ``by``.

    ``best_f1`` skips the minima.
    """
    points = precision_recall_at_scores(df, label, score, by)
    good = (F.col("recall") >= min_recall) & (F.col("precision") >= min_precision)
    first_good = F.min(F.when(good, F.col("threshold")))
    quality = F.struct(_f1(F.col("precision"), F.col("recall")), -F.col("threshold"))
    fallback = F.max_by("threshold", quality)
    chosen = (fallback if best_f1 else F.coalesce(first_good, fallback)).alias("threshold")
    return points.groupBy(*by).agg(chosen) if by else points.agg(chosen)


def threshold_sweep(df: DataFrame, steps: int = 50, label: str = "label", score: str = "score") -> DataFrame:
    """Confusion counts, positive-class metrics and AUC at ``steps`` even thresholds from 0.01 to 0.99.

    One pass counts the rows between neighbouring thresholds; sums over at most steps + 1 counts give
    every threshold its matrix.
    """
    grid = evenly_spaced(0.01, 0.99, steps)
    counts = add_range(_score_counts(df, label, score), "threshold", grid, "reached")
    counted = counts.groupBy(F.col("reached").cast("int").alias("reached")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(F.expr(WINS)).alias("wins")
    )
    thresholds = F.array(*[F.lit(t) for t in grid])
    # Row i holds what lies between threshold i and the next one; row 0 lies below all.
    frame = df.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("reached"))
    filled = frame.join(F.broadcast(counted), "reached", "left").na.fill(0)
    every = Window.partitionBy(F.lit(0))
    at_or_above = every.orderBy("reached").rowsBetween(0, Window.unboundedFollowing)
    below = every.orderBy("reached").rowsBetween(Window.unboundedPreceding, -1)
    cells = filled.select(
        "reached",
        F.sum("neg").over(below).alias("tn"),
        F.sum("neg").over(at_or_above).alias("fp"),
        F.sum("pos").over(below).alias("fn"),
        F.sum("pos").over(at_or_above).alias("tp"),
        _auc(F.sum("wins").over(every), F.sum("pos").over(every), F.sum("neg").over(every)),
    ).filter("reached > 0")
    return add_class_metrics(cells).select(
        F.element_at(thresholds, F.col("reached")).alias("threshold"),
        "auc",
        "precision_pos",
        "recall_pos",
        "f1_pos",
        "tn",
        "fp",
        "fn",
        "tp",
    )


def lift_by_decile(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per tenth of the score ranking (10 = highest): rows, positives, rate and lift over the base rate.

    Tied scores share their mean rank, so they fall into the same tenth.
    """
    rows = df.select(F.col(label).alias("label"), F.col(score).alias("threshold"))
    counts = ordered_counts(rows, "threshold", {"n": F.count(F.lit(1)), "pos": F.count_if(F.col("label") == 1)})
    decile = F.ceil(average_rank() / F.col("n_total") * 10).cast("int")
    base = F.max("pos_total") / F.max("n_total")
    rate = F.sum("pos") / F.sum("n")
    return counts.groupBy(decile.alias("decile")).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("positives"),
        rate.alias("rate"),
        F.try_divide(rate, base).alias("lift"),
    )


def compare_models(results: dict[str, DataFrame]) -> DataFrame:
    """One row per model: model, auc, recall, precision, f1, threshold."""
    rows = [
        r.select(
            F.lit(name).alias("model"),
            "auc",
            F.col("recall_pos").alias("recall"),
            F.col("precision_pos").alias("precision"),
            F.col("f1_pos").alias("f1"),
            "threshold",
        )
        for name, r in results.items()
    ]
    return reduce(DataFrame.unionByName, rows)
