"""The jobs end to end, from a CSV of raw lines to the dashboard document."""

import json
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from basketlens import __main__ as cli, session as session_module
from pyspark.sql import functions as F

from basketlens.operators import cox
from basketlens.operators.rfm import invoice_revenue
from basketlens.plans import jobs
from basketlens.session import _made, scratch_path
from basketlens.sources import tables as store
from catalog.registered import Shop

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    raw = str(folder / "raw")
    Shop(spark, SF).raw.write.option("header", True).options(
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(raw)
    cli.main(["load", "--raw", raw, "--root", str(folder / "db")])
    return str(folder / "db")


def test_load_is_published_as_a_whole_or_not_at_all(spark, root):
    before = store.current(spark, root)
    counts = {name: df.count() for name, df in store.read_tables(spark, root).items()}
    assert counts == {"customers": 150, "products": 200, "invoices": 1472, "invoice_items": 5986}
    shop = Shop(spark, SF)
    broken = {**shop.tables, "invoice_items": shop.invoice_items.withColumn("quantity", F.raise_error(F.lit("half-way")).cast("int"))}
    with pytest.raises(Exception, match="half-way"):
        store.write_tables(broken, root)
    assert store.current(spark, root) == before
    with pytest.raises(ValueError, match="missing"):
        store.write_tables({"products": shop.products}, root)
    with pytest.raises(FileNotFoundError):
        store.current(spark, root + "-elsewhere")


def test_revenue_of_a_load_shuffles_no_lines(spark, root):
    tables = store.read_tables(spark, root)
    plan = invoice_revenue(tables["invoices"], tables["invoice_items"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(invoice_no" not in plan and "Bucketed: true" in plan
    folder = store.current(spark, root)
    plain = invoice_revenue(*(spark.read.parquet(f"{folder}/{name}") for name in ("invoices", "invoice_items")))
    assert sorted(invoice_revenue(tables["invoices"], tables["invoice_items"]).collect()) == sorted(plain.collect())


def test_dashboard_needs_the_jobs_of_this_load(spark, root):
    with pytest.raises(FileNotFoundError, match="segment job"):
        jobs.write_dashboard(spark, root)


def test_all_jobs_agree_in_the_document(spark, root):
    made = len(_made)
    document = jobs.run_all(spark, root, ks=range(2, 4), restarts=1, home_country="NATION_0")
    assert len(_made) == made  # no intermediate table is left
    row = document.first()
    folder = store.current(spark, root)
    segments = store.read_segments(spark, folder)
    assert row.kpis.total_customers == segments.count() == sum(s.customers for s in row.segments)
    spends = [s.avg_monetary for s in row.segments]
    assert spends == sorted(spends, reverse=True)
    assert set(row.churn.curves) == {s.segment_label for s in row.segments}
    for curve in row.churn.curves.values():
        assert curve.days == sorted(curve.days) and curve.survival == sorted(curve.survival, reverse=True)
        assert all(0 <= s <= 1 for s in curve.survival)
    assert sum(c.n for c in row.churn.curves.values()) == row.kpis.total_customers
    size = {"weekly": 12, "monthly": 3}[row.forecast.grain]
    assert len(row.forecast.backtest.period) == len(row.forecast.backtest.naive) == size
    assert row.kpis.silhouette_score > row.kpis.naive_silhouette_score
    assert row.kpis.silhouette_low <= row.kpis.silhouette_score <= row.kpis.silhouette_high
    assert row.forecast.beats_naive == (row.forecast.model_mae < row.forecast.naive_mae)
    stored = store.read_report(spark, f"{folder}/reports/cox_model_summary", cox.CHECKED_SCHEMA)
    assert {c.covariate for c in row.cox} == {r.covariate for r in stored.collect()}
    assert all(r.converged for r in stored.collect())
    def no_job(*args, **kwargs):
        raise AssertionError("a job is run again")
    with pytest.MonkeyPatch.context() as patch:
        for name in ("segment", "churn", "forecast", "collapsed"):
            patch.setattr(jobs, name, no_job)
        again = jobs.write_dashboard(spark, root, "NATION_0").first()  # from what is stored alone
        assert again == row
    with pytest.raises(store.Stale, match="other home_country: run the churn job"):
        jobs.write_dashboard(spark, root, "NATION_1")
    version = store.segments_version(spark, folder)
    store.write_segments(segments.limit(100), folder)
    assert store.segments_version(spark, folder) != version
    with pytest.raises(store.Stale, match="other segments: run the churn job"):
        jobs.write_dashboard(spark, root, "NATION_0")
    written = next(Path(f"{folder}/reports/dashboard_data").glob("*.json")).read_text()
    assert json.loads(written)["kpis"]["churn_threshold_days"] == row.kpis.churn_threshold_days


def test_stages_keep_their_result_alone(spark):
    since = session_module.made()
    frames = [session_module.materialize(spark.range(i), "stage") for i in (3, 4, 5)]
    session_module.clear_scratch(spark, since, keep=1)
    assert session_module.made() == since + 1 and frames[-1].count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound"):
        frames[0].collect()
    session_module.clear_scratch(spark, since)
    assert session_module.made() == since


def test_nothing_is_left_when_the_process_ends(tmp_path):
    code = ("from basketlens.session import local_session, materialize; "
            f"s = local_session(1, **{{'spark.checkpoint.dir': 'file://{tmp_path}/shared'}}); materialize(s.range(3), 'x').count(); "
            f"import os; assert os.listdir('{tmp_path}/shared')")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(cli.__file__).parents[1])
    assert not list((tmp_path / "shared").glob("x-*"))


def session(master, checkpoint=None):
    """The few members of a session that the choice of the scratch folder looks at."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                              getConf=lambda: SimpleNamespace(get=lambda key: checkpoint))
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_scratch_folder_is_the_one_the_cluster_names():
    assert scratch_path(session("yarn", "hdfs://shared/tmp/"), "x").startswith("hdfs://shared/tmp/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://somewhere:7077"), "x")
