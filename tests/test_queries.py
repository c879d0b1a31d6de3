"""Every registered query against its SQL on the smallest tables, and the shape of the plans."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare

ROOT = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ROOT}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, ROOT)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    verdict, _ = compare(spark, db, ROOT, name, lambda *_: df, oracle_sql().get(name))
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "hypertension" in df.columns


@pytest.mark.parametrize("name", [
    "cycle_union", "alias_coalesce", "numeric_coerce", "harmonise_module", "extreme_filter", "interval_bins", "type_definition",
    "conditional_derive", "rule_overwrite", "encode_onehot", "link_harvest", "range_null", "iqr_clip", "impute_median",
])
def test_row_local_queries_do_not_shuffle(spark, name):
    plan = plan_of(queries()[name](spark, ROOT))
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan and "Python" not in plan


def test_scans_are_pruned_and_filtered(spark):
    plan = plan_of(queries()["module_join_chain"](spark, ROOT))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    assert "Join" not in plan
