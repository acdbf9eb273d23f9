"""What the jobs move and write, at the sizes of the plans rather than of the tables."""

from __future__ import annotations

import glob

from marquee.session import stage
from workload import fixture as fx
from workload import generic


def _below(plan: str, mark: str) -> list[str]:
    """The lines of a plan's tree under the first line with ``mark``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    under = []
    for line in lines[at + 1 :]:
        if depth(line) <= depth(lines[at]):
            break
        under.append(line)
    return under


def test_customers_meet_orders_before_lines(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalog = fx.catalog(spark, sf_dir)
        plan = catalog._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = _below(plan, "Exchange hashpartitioning(o_custkey")
    assert any("o_custkey" in line for line in moved)
    assert not any("l_orderkey" in line or "p_name" in line or "doc_id" in line for line in moved)


def test_landed_pages_are_compressed(spark, sf_dir):
    path = generic.landing(spark, sf_dir)
    files = glob.glob(f"{path}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    landed, made = (sorted(r["value"] for r in df.collect()) for df in (spark.read.text(path), fx.landed_pages(spark, sf_dir)))
    assert [len(v) for v in landed] == [len(v) for v in made]


def test_staged_tables_are_packed(spark):
    rows = stage(spark.range(1000), "packed")
    files = rows.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert rows.count() == 1000
