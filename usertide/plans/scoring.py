"""What is done with scored users: rates, calibration, percentiles, risk segments, top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usertide.functions.numeric import evenly_spaced, label_at, right_closed_bin, risk_band, share_of
from usertide.operators.ranking import look_up_by_value, percentile_ranks, present, value_table
from usertide.operators.stats import describe
from usertide.schema import first_column_like, quoted, require_columns

# Percentiles of the score distribution.
SCORE_SHARES = (0.1, 0.25, 0.5, 0.75, 0.9)


def label_scores(
    df: DataFrame, threshold: float, model_name: str, scored_at: str, score: str = "score"
) -> DataFrame:
    """Add the predicted label, the threshold used, the model name and the time of scoring as given."""
    return df.withColumns(
        {
            "pred_churn": label_at(present(F.col(score)), threshold),
            "threshold_used": F.lit(float(threshold)),
            "model_file": F.lit(model_name),
            "scored_at_utc": F.lit(scored_at),
        }
    )


def top_scores(df: DataFrame, n: int = 50, score: str = "score", id_col: str = "user_id") -> DataFrame:
    """The ``n`` highest scores, ties by id; missing scores, NaN among them, come last."""
    return df.orderBy(present(F.col(quoted(score))).desc_nulls_last(), quoted(id_col)).limit(n)


def score_distribution(df: DataFrame, score: str = "score") -> DataFrame:
    return describe(df, [score], SCORE_SHARES, digits=3)


def mean_score_by(scores: DataFrame, users: DataFrame, column: str | None, score: str = "score") -> DataFrame:
    """Mean score per value of a user column, highest first; users without a value are left out.

    Scores are summed per user before the join.  ``column=None`` takes the subscription column: the
    first whose name contains "sub".
    """
    column = column or first_column_like(users, "sub")
    if column is None:
        raise ValueError("no subscription column among the users")
    require_columns(users, ["user_id", column], "users")
    per_user = (
        scores.select("user_id", present(F.col(score)).alias("score"))
        .groupBy("user_id")
        .agg(F.sum("score").alias("total"), F.count("score").alias("n"))
    )
    known = users.select("user_id", column).filter(F.col(column).isNotNull())
    return (
        per_user.join(known, "user_id")
        .groupBy(column)
        .agg(F.try_divide(F.sum("total"), F.sum("n")).alias("avg_churn_prob"))
        .orderBy(F.desc_nulls_last("avg_churn_prob"), column)
    )


def calibration_table(df: DataFrame, bins: int = 10, score: str = "score", outcome: str = "label") -> DataFrame:
    """Mean outcome and row count per equal bin of the score over 0..1, empty bins included.

    Bins are right-closed, the first also takes 0.  ``outcome`` may be the true or the predicted label.
    """
    edges = evenly_spaced(0.0, 1.0, bins + 1)
    value = present(F.col(score))
    filled = (
        df.select(right_closed_bin(value, edges).alias("bin"), F.col(outcome).alias("outcome"))
        .groupBy("bin")
        .agg(F.avg("outcome").alias("mean_outcome"), F.count(F.lit(1)).alias("n"))
    )
    bounds = F.array(*[F.lit(e) for e in edges])
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # At most one row per bin, and one for scores outside 0..1.
    return frame.join(F.broadcast(filled), "bin", "left").select(
        "bin",
        F.get(bounds, F.col("bin")).alias("lower"),
        F.get(bounds, F.col("bin") + 1).alias("upper"),
        "mean_outcome",
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def risk_segments(df: DataFrame, score: str = "score") -> DataFrame:
    """Every row with its churn_percentile (ties share the mean rank) and risk_segment.

    A missing score has no percentile and counts as the lowest segment.  The two columns replace columns
    of the same names.
    """
    rows = df.drop("churn_percentile", "risk_segment").withColumn(score, present(F.col(quoted(score))))
    counts = value_table(rows.select(F.col(quoted(score)).alias("__score")), "__score", {"n": F.count(F.lit(1))})
    ranks = percentile_ranks(counts, "__score").withColumnRenamed("percentile", "churn_percentile")
    placed = look_up_by_value(rows, ranks.withColumnRenamed("__score", score), score, "churn_percentile")
    return placed.withColumn("risk_segment", risk_band(F.col("churn_percentile")))


def segmented_users(scores: DataFrame, users: DataFrame, score: str = "score") -> DataFrame:
    """A row per scored user that is known: the score, its percentile and segment, and the user's columns.

    Percentiles are taken over all scores.  User columns that the scores have too come from the scores.
    """
    ranked = risk_segments(scores, score)
    added = [c for c in users.columns if c == "user_id" or c not in ranked.columns]
    return ranked.join(users.select(*[quoted(c) for c in added]), "user_id")


def segment_summary(df: DataFrame, score: str = "score", id_col: str = "user_id") -> DataFrame:
    """Users and their percentage of all rows per risk segment, by segment name descending.

    Works on one row per distinct score; single rows are never ranked.
    """
    rows = df.select(F.col(score).alias("score"), F.col(id_col).alias("id"))
    counts = value_table(rows, "score", {"n": F.count(F.lit(1)), "users": F.count("id")})
    ranked = percentile_ranks(counts, "score", ["n", "users"]).select("percentile", "n", "users")
    unscored = counts.filter(F.col("score").isNull()).select(
        F.lit(None).cast("double").alias("percentile"), "n", "users"
    )
    segments = (
        ranked.unionByName(unscored)
        .groupBy(risk_band(F.col("percentile")).alias("risk_segment"))
        .agg(F.sum("users").alias("user_count"), F.sum("n").alias("n"))
    )
    # At most three rows reach this window.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return segments.select(
        "risk_segment", "user_count", share_of(F.col("user_count"), total).alias("pct")
    ).orderBy(F.desc("risk_segment"))
