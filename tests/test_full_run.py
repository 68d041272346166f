"""From raw CSV files to segments in one go."""

import json
from pathlib import Path

from usertide.catalog.views import Views
from usertide.plans.full_run import run_files
from usertide.session import shared_dir
from usertide.sources import tables


def test_all_results_are_written_and_agree(spark, tmp_path):
    v = Views(spark, "/root/testdata/sf0.01")
    tables.write_csv(v.users().unionByName(v.users()), str(tmp_path / "users_csv"))
    tables.write_csv(v.events(), str(tmp_path / "events_csv"))
    base = tmp_path / "out"
    run_files(spark, str(tmp_path / "users_csv"), str(tmp_path / "events_csv"), str(base), "2024-02-01T00:00:00",
              trees=5, depth=4, ks=range(2, 4))

    shared = Path(f"{shared_dir(spark).removeprefix('file:')}/usertide/{spark.sparkContext.applicationId}")
    assert not list(shared.glob("run-*"))
    assert spark.read.parquet(str(base / "models/segmented_users")).count() == v.users().count()
    parts = [spark.read.parquet(str(base / f"models/encoded_{p}")).count() for p in ("train", "test")]
    assert sum(parts) == v.users().count() and abs(parts[1] - 0.2 * sum(parts)) <= 1

    def rows(name):
        lines = [line for part in Path(base / name).glob("part-*.json") for line in part.read_text().splitlines()]
        return [json.loads(line) for line in lines]

    users = v.users().count()
    assert {r["metric"]: r["value"] for r in rows("cleaned/users_qa")}["duplicates_removed"] == users
    assert spark.read.parquet(str(base / "cleaned/users")).count() == users
    assert spark.read.parquet(str(base / "features/behaviour")).count() == users
    assert sum(r["user_count"] for r in rows("reports/risk_segment_summary")) == users
    assert sum(r["user_count"] for r in rows("reports/cluster_summary")) == users
    assert spark.read.parquet(str(base / "segments/pca")).count() == users
    assert {r["model"] for r in rows("reports/model_comparison")} == {"logreg", "random_forest"}
    assert len(rows("reports/sweep_logreg")) == 60
    assert len(rows("reports/top_scores")) == 50
    assert [r["users"] for r in rows("reports/retention_summary")] == [users]
    assert {r["metric"]: r["value"] for r in rows("reports/quality_audit")}["users_null_user_id"] == 0
