"""Registered queries against their SQL on the smallest test tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import TABLES, compare
from goldweave.plans import gather
from goldweave.sources.sinks import documents
from goldweave.workload import oracle, queries, roles
from goldweave.workload.queries import registered

FOLDER = "/root/testdata/sf0.001"
CHOSEN = ["scan_recruiter", "norm_text", "quarantine_facts", "norm_report", "provenance", "profile_default",
          "profile_empty", "project_omit", "validate_default", "scan_ats_files", "scan_repos", "quarantine_code_host",
          "repo_facts_json", "extra_source", "run_report"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(registered()) == set(oracle.statements())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, name):
    good, note = compare(spark, duck, FOLDER, name)
    assert good, note


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "candidate_id" and len(df.columns) == 13
    assert "CartesianProduct" not in df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_checked_by_many_tasks(spark):
    """The file of customers is one row group, read by one task."""
    documents = roles.foreign_documents(spark, FOLDER)
    at = documents.groupBy(F.spark_partition_id()).count().collect()
    assert len(at) > 4 and max(r["count"] for r in at) * 3 < documents.count()


def test_counts_of_errors_come_from_many_tasks(spark):
    plan = registered()["validate_counts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(c_custkey" in plan


@pytest.mark.parametrize("name", ["validate_default", "validate_counts"])
def test_rules_are_checked_once_per_document(spark, name):
    """Asking for documents with errors must not be a second run of the rules."""
    plan = registered()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("full_name must be a string") == 1 and plan.count("parseJson(document") == 1


@pytest.mark.parametrize("name", ["recruiter", "ats", "repos", "order_facts", "customer_facts"])
def test_sources_are_extracted_by_many_tasks(spark, name):
    """Each file is one row group, read by one task."""
    rows = getattr(roles, name)(spark, FOLDER)
    at = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(at) > 4 and max(r["count"] for r in at) * 3 < rows.count()


def test_documents_are_written_once_and_read_in_one_pass(spark):
    """A document is made once, with its errors or without; all its attributes come from one parse."""
    lines = documents(queries.validate_profiles(queries._profiles(spark, FOLDER)).drop("_faults"))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 2
    plan = registered()["profile_json"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple(") == 1 and "get_json_object" not in plan


def test_counting_rows_makes_no_facts(spark):
    """Who has how many facts is asked without jobs, skills and dates."""
    plan = gather(roles.sources(spark, FOLDER)).weights._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in plan and "headline" not in plan


@pytest.mark.parametrize("name", ["exp_dedup", "profile_json"])
def test_profiles_read_orders_into_many_tasks(spark, name, monkeypatch):
    """Both scans of the orders, as records and as facts, are dealt out."""
    found, kept = [], queries._profiles
    monkeypatch.setattr(queries, "_profiles", lambda s, folder: found.append(kept(s, folder)) or found[-1])
    registered()[name](spark, FOLDER)
    plan = found[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(o_orderkey") >= 2
