"""All jobs in order, from the raw tables to segments, each result stored under one folder.

Every later job reads the stored result of the earlier ones, so nothing is computed twice and a
failed run can be looked at, or continued by hand, from any table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from usertide import schema
from usertide.plans import audits, cleaning, cohorts, evaluation, features, model_data, scoring, segments, training
from usertide.session import configure, scratch
from usertide.sources import tables

SCORE_GROUPS = ("country", "device", "subscription_type")


def run_files(spark: SparkSession, users_csv: str, events_csv: str, base: str, scored_at: str, **options) -> None:
    """:func:`run_all` on raw CSV files."""
    run_all(
        tables.read_csv(configure(spark), users_csv, schema.USERS),
        tables.read_csv(spark, events_csv, schema.EVENTS),
        base,
        scored_at,
        **options,
    )


def run_all(
    raw_users: DataFrame, raw_events: DataFrame, base: str, scored_at: str, trees: int = 400, depth: int = 30, ks: Sequence[int] = range(2, 10)
) -> None:
    """Clean, audit, build features and cohorts, train, score, report and segment.

    Tables are Parquet under ``base``; reports are one JSON file each.  Intermediate tables are deleted.
    """
    with scratch(raw_users.sparkSession):
        _run_all(raw_users, raw_events, base, scored_at, trees, depth, ks)


def _run_all(
    raw_users: DataFrame,
    raw_events: DataFrame,
    base: str,
    scored_at: str,
    trees: int,
    depth: int,
    ks: Sequence[int],
) -> None:
    def store(df: DataFrame, name: str) -> DataFrame:
        return tables.write_table(df, f"{base}/{name}")

    def report(df: DataFrame, name: str) -> None:
        tables.write_report(df, f"{base}/reports/{name}")

    users = tables.cleaned_to(cleaning.clean_users, raw_users, f"{base}/cleaned", "users")
    events = tables.cleaned_to(cleaning.clean_events, raw_events, f"{base}/cleaned", "events")

    report(audits.quality_audit(users, events), "quality_audit")
    report(audits.relational_audit(users, events), "relational_audit")
    report(audits.events_per_user_summary(users, events), "events_per_user")
    report(audits.contract_checks(users, events), "contract_checks")
    if set(audits.EVENT_TIMES) <= set(events.columns):
        report(audits.latency_summary(events), "latency_summary")
        report(audits.latency_histogram(events), "latency_histogram")

    store(features.behaviour_features(users, events), "features/behaviour")
    user_features = store(features.user_features(users, events), "features/users")
    retention = store(cohorts.retention_cohorts(users, events), "cohorts/retention")
    metrics = store(cohorts.user_retention_metrics(users, events, exact_signup_time=False), "cohorts/user_metrics")
    store(cohorts.retention_matrix(retention), "cohorts/matrix")
    report(cohorts.retention_summary(metrics, scored_at), "retention_summary")

    data = store(model_data.prepare_model_data(user_features, metrics), "models/data")
    train, test = model_data.encoded_tables(data)
    store(train, "models/encoded_train")
    store(test, "models/encoded_test")
    trained = training.train_churn_models(data, trees=trees, depth=depth)
    report(trained.comparison, "model_comparison")
    for name, model in trained.models.items():
        model.save(f"{base}/models/{name}")
        report(model.importances(), f"importance_{name}")
        test = trained.test_scores[name]
        store(evaluation.roc_points(test, training.LABEL), f"curves/roc_{name}")
        store(evaluation.pr_points(test, training.LABEL), f"curves/pr_{name}")
        report(evaluation.threshold_sweep(test, 60, training.LABEL), f"sweep_{name}")

    scored, top = training.score_users(trained.models["logreg"], data.drop("split"), scored_at)
    scores = store(scored, "models/scores")
    report(top, "top_scores")
    report(scoring.score_distribution(scores, "proba_churn"), "score_distribution")
    for column in SCORE_GROUPS:
        if column in users.columns:
            report(scoring.mean_score_by(scores, users, column, "proba_churn"), f"churn_by_{column}")
    report(scoring.calibration_table(scores, score="proba_churn", outcome="pred_churn"), "calibration")
    store(scoring.risk_segments(scores, "proba_churn"), "models/risk_segments")
    store(scoring.segmented_users(scores, users, "proba_churn"), "models/segmented_users")
    report(scoring.segment_summary(scores, "proba_churn"), "risk_segment_summary")

    found = segments.segment_users(data.drop("split", training.LABEL), ks)
    clusters = store(found.users, "segments/users")
    report(found.choices, "cluster_choices")
    report(segments.cluster_summary(clusters, found.columns), "cluster_summary")
    shown = [c for c in segments.PROFILE_VARIABLES if c in clusters.columns]
    report(segments.cluster_boxplots(clusters, shown), "cluster_boxplots")
    store(segments.cluster_pca(clusters), "segments/pca")
