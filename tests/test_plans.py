"""Plan and source checks: what must not appear at scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from marquee.session import drop_scratch, scratch_path, shared_dir, stage

import __spark_entry__  # noqa: F401  registers the queries
from workload.generic import staged_feeds
from workload.registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]
LAZY = [n for n in sorted(QUERIES) if not n.startswith(("ml_", "tune_", "sink_m", "src_m", "run_", "model_"))]


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_worker(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["filt_chain"](spark, sf_dir))
    assert "GreaterThan(l_quantity,40.0)" in plan and "LessThan(l_discount," in plan
    assert "l_extendedprice" not in plan.split("== Physical Plan ==")[1]


def test_top_k_is_taken_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["eda_language_top10"](spark, sf_dir))


def test_unused_texts_are_not_joined(spark, sf_dir):
    assert "documents.parquet" not in plan_of(QUERIES["eda_rating_counts"](spark, sf_dir)).split(
        "== Physical Plan =="
    )[1]


def test_nulls_of_derived_columns_need_one_scan_and_no_text(spark, sf_dir, monkeypatch):
    import marquee.session as session

    monkeypatch.setattr(session, "scratch_path", None)  # nothing may be staged
    plan = plan_of(QUERIES["eda_null_profile"](spark, sf_dir)).split("== Physical Plan ==")[1]
    for name in ("documents", "orders", "lineitem"):
        assert plan.count(f"{name}.parquet") == 1
    # The text's attribute ends where its flag is made, below every exchange.
    text = re.search(r"FileScan parquet \[doc_id#\d+L?,(text#\d+)\]", plan).group(1)
    uses = [line for line in plan.splitlines() if re.search(rf"{text}\b", line)]
    assert uses and all("FileScan" in line or f"isnotnull({text})" in line for line in uses)


def test_dedup_shuffles_no_text(spark, sf_dir, monkeypatch):
    """Nothing is shuffled by the plan that returns the rows, and only digests and places by the one before."""
    from marquee.operators import setops

    staged = []
    monkeypatch.setattr(setops, "stage", lambda df, n: staged.append(plan_of(df)) or stage(df, n))
    plan = plan_of(setops.dedup_stored(staged_feeds(spark, sf_dir))).split("== Physical Plan ==")[1]
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    (digests,) = staged
    for line in digests.split("== Physical Plan ==")[1].splitlines():
        if "Project" in line and "digest#" in line and "sha2" not in line:
            assert "overview#" not in line


def test_source_stays_on_the_executors():
    banned = re.compile(r"\.toPandas\(|\.rdd\b|\budf\(|pandas_udf|localCheckpoint|crossJoin|\.collect\(\)")
    # The k category names; one row per wanted quantile.
    allowed = {"marquee/operators/encode.py": 1, "marquee/operators/profile.py": 1}
    library = [p for p in ROOT.glob("marquee/**/*.py") if "llm" not in p.parts]
    for path in [*library, *ROOT.glob("workload/*.py")]:
        found = banned.findall(path.read_text())
        assert len(found) <= allowed.get(str(path.relative_to(ROOT)), 0), (path, found)


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert Path(shared_dir(spark)).is_dir()
        assert shared_dir(spark) == shared_dir(spark)


class _Session:
    """A session's settings, without Spark."""

    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}

    @property
    def conf(self):
        return self

    def get(self, key, default):
        return self.settings.get(key, default)


def test_shared_folder_must_be_named_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session(spark__master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session(spark__master="local-cluster[2,1,1024]"))
    named = _Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert shared_dir(named) == "hdfs:///shared"
    local = _Session(spark__master="local[2]", spark__app__id="a")
    assert Path(shared_dir(local)).is_dir() and shared_dir(local) == shared_dir(local)


def test_staged_tables_scan_pruned_and_can_be_dropped(spark):
    drop_scratch(spark)
    staged = stage(spark.range(10).selectExpr("id", "id * 2 AS twice"), "t")
    assert staged.count() == 10
    plan = plan_of(staged.select("id").filter("id > 3")).split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,3)" in plan
    scratch_path(spark, "never_written")
    assert drop_scratch(spark) == 1


def scans(df, table):
    return plan_of(df).split("== Physical Plan ==")[1].count(f"{table}.parquet")


def test_one_catalogue_under_select_best(spark, sf_dir):
    assert scans(QUERIES["select_best"](spark, sf_dir), "lineitem") == 1


def test_one_join_under_both_correlations(spark, sf_dir):
    assert scans(QUERIES["agg_corr"](spark, sf_dir), "labels") == 1


def test_one_scan_counts_all_feeds(spark, sf_dir):
    assert scans(QUERIES["eda_feed_counts"](spark, sf_dir), "orders") == 1


def test_texts_are_joined_unsorted_by_themselves(spark, sf_dir):
    plan = plan_of(QUERIES["proj_drop"](spark, sf_dir)).split("== Physical Plan ==")[1]
    assert "SortAggregate" not in plan
