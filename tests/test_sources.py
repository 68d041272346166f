"""Files: CSV with missing and extra columns, reports, stored tables."""

import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest

from usertide import schema
from usertide.catalog.views import Views
from usertide.plans import cleaning
from usertide.session import drop_materialized, materialize, shared_dir
from usertide.sources import tables


def test_csv_types_come_by_name(spark, tmp_path):
    path = tmp_path / "users.csv"
    path.write_text(
        "signup_date,user_id,views,extra,sessions_7d\n"
        "2024-01-02T03:04:05.678901Z,u1,7,x,1.5\n"
        "garbage,u2,many,,\n",
        encoding="utf-8",
    )
    df = tables.read_csv(spark, str(path), schema.USERS)
    assert df.dtypes == [("signup_date", "timestamp_ntz"), ("user_id", "string"), ("views", "bigint"),
                         ("extra", "string"), ("sessions_7d", "double")]
    rows = {r["user_id"]: r for r in df.collect()}
    assert rows["u1"]["signup_date"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert rows["u2"]["signup_date"] is None and rows["u2"]["views"] is None and rows["u1"]["sessions_7d"] == 1.5


def test_extra_date_format(spark, tmp_path):
    path = tmp_path / "users.csv"
    path.write_text("user_id,signup_date\nu1,31/12/2023\n", encoding="utf-8")
    df = tables.read_csv(spark, str(path), schema.USERS, ("dd/MM/yyyy",))
    assert df.first()["signup_date"] == dt.datetime(2023, 12, 31)


def test_labels_are_the_first_column_as_integers(spark, tmp_path):
    path = tmp_path / "y.csv"
    path.write_text("churn_30d,other\n1.0,a\n0,b\n", encoding="utf-8")
    assert [r[0] for r in tables.read_labels(spark, str(path)).collect()] == [1, 0]


def test_cleaned_table_and_report(spark, sf_dir, tmp_path):
    v = Views(spark, sf_dir)
    written = tables.cleaned_to(cleaning.clean_events, v.raw_events(), str(tmp_path), "events")
    clean, report = cleaning.clean_events(v.raw_events())
    assert sorted(written.collect(), key=str) == sorted(clean.collect(), key=str)
    stored = tables.read_report(spark, str(tmp_path / "events_qa"))
    assert sorted(stored.collect()) == sorted(report.collect())


def test_materialized_table_has_no_lineage(spark, sf_dir):
    df = Views(spark, sf_dir).features()
    stored = materialize(df)
    assert stored.dtypes == df.dtypes and sorted(stored.collect()) == sorted(df.collect())
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and shared_dir(spark) in plan


def test_stored_tables_can_be_dropped(spark):
    stored = materialize(spark.range(3))
    assert stored.count() == 3
    drop_materialized(spark)
    folder = f"{shared_dir(spark)}/usertide/{spark.sparkContext.applicationId}".removeprefix("file:")
    assert not Path(folder).exists()


def test_a_cluster_must_name_its_shared_folder():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=context))
    named = SimpleNamespace(get=lambda key, default=None: "hdfs:///shared/")
    assert shared_dir(SimpleNamespace(conf=named, sparkContext=context)) == "hdfs:///shared"
