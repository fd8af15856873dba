"""Scratch paths and settings."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from conftest import ROOT

from monsoon.session import CLUSTER, first_partitions, matches, scratch, settle, stateful, using, widen


def test_scratch_follows_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)


class Unset:
    """A session on some master without a shared folder."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"

    def get(self, key, default):
        return default


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(Unset("spark://host:7077"), "x")
    local = Unset("local[2]")
    first, second = scratch(local, "x"), scratch(local, "x")
    assert os.path.dirname(first) == os.path.dirname(second) and first != second


def test_cluster_sizes_yield_to_settings(spark):
    mine = {"spark.sql.files.maxPartitionBytes": "64m"}
    with using(spark, {**dict.fromkeys(CLUSTER, "1"), **mine}):
        for key in CLUSTER.keys() - mine.keys():
            spark.conf.unset(key)
        widen(spark)
        assert {k: spark.conf.get(k) for k in CLUSTER} == {**CLUSTER, **mine}


def test_first_partitions_follow_the_input():
    assert first_partitions(0) == first_partitions(1 << 30) == 4096
    assert first_partitions(100 << 40) == 409_600


def test_matches(spark, tmp_path):
    (tmp_path / "a-1").mkdir()
    assert matches(spark, f"{tmp_path}/a-*") and matches(spark, f"{tmp_path}/a-1")
    assert not matches(spark, f"{tmp_path}/b-*") and not matches(spark, f"{tmp_path}/none/x")


def test_using_restores(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with using(spark, {key: "3", "spark.monsoon.test": "1"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.monsoon.test", None) is None


def test_state_partitions_follow_the_cores(spark):
    shuffled, own = "spark.sql.shuffle.partitions", "spark.monsoon.state.partitions"
    least = max(32, spark.sparkContext.defaultParallelism)
    for asked, given in ((4, 4), (600, least), (6000, least)):
        with using(spark, {shuffled: str(asked)}):
            assert stateful(spark)[shuffled] == str(given)
    with using(spark, {own: "48"}):
        assert stateful(spark)[shuffled] == "48"


def test_settled_results_have_no_lineage(spark):
    df = settle(spark.range(10).selectExpr("id % 3 AS k").groupBy("k").count())
    assert sorted(tuple(r) for r in df.collect()) == [(0, 4), (1, 3), (2, 3)]
    assert "Aggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
