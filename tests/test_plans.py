"""Plan shapes that matter at scale."""

import re
from pathlib import Path

import pytest

from hourledger.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


LAZY = [
    name for name in QUERIES
    if name not in {"merge_into_std_table", "invoice_store_roundtrip", "api_pages_flatten", "api_pages_totals",
                    "landing_roundtrip", "incremental_raw", "full_reload", "invoice_files_to_store", "mixed_modes",
                    "hydrate_to_std", "landing_quarantine", "failing_table_beside_a_good_one", "qa_consistency_by_keys",
                    "invoice_hours_from_table", "invoice_inbox"}
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_row_python(spark, no_broadcast, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text
    arrow = len(re.findall(r"ArrowEvalPython", text))
    reads_documents = name in {"invoice_fields", "invoice_decisions", "invoice_store_rows", "invoice_documents_from_files"}
    assert arrow == (1 if reads_documents else 0)


def test_flagship_prunes_filters_and_semi_joins(spark):
    text = plan(spark, "billable_hours_by_user")
    assert "LeftSemi" in text
    scan = next(line for line in text.splitlines() if "FileScan" in line and "l_partkey" in line)
    assert "[l_orderkey" in scan and "l_extendedprice" not in scan
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_latest_per_key_is_combined_before_the_shuffle(spark):
    text = plan(spark, "dedupe_latest")
    assert exchanges(text) == 1
    assert "partial_max(struct(" in text.split("Exchange hashpartitioning")[1]


def test_first_per_key_is_limited_before_the_shuffle(spark, no_broadcast):
    text = plan(spark, "latest_issuer")
    assert text.count("WindowGroupLimit") == 2


def test_merge_reuses_the_partitioning_of_the_deduplication(spark, no_broadcast):
    assert exchanges(plan(spark, "merge_latest")) == 2


def test_invoices_are_joined_to_one_row_per_month(spark, no_broadcast):
    text = plan(spark, "invoice_hours_mtd")
    joins = [line for line in text.splitlines() if "__month" in line and "Join" in line]
    assert joins and all("LeftOuter" in join and "__user" in join for join in joins)
    # No grouping by invoice afterwards.
    assert "keys=[invoice_id" not in text


def test_period_reaches_a_date_column_and_its_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from hourledger.operators.hours import entries_in_period

    path = str(tmp_path / "entries")
    day = F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int"))
    spark.range(90).select(
        F.col("id").alias("userId"), day.alias("entry_date"), F.date_format(day, "yyyy-MM").alias("month")
    ).write.partitionBy("month").parquet(path)
    kept = entries_in_period(spark.read.parquet(path), "2025-02-01", "2025-02-03", 31)
    text = kept._jdf.queryExecution().executedPlan().toString()
    for pushed in ("GreaterThanOrEqual(entry_date,2025-02-01)", "LessThanOrEqual(entry_date,2025-02-03)", "EqualTo(userId,31)"):
        assert pushed in text
    assert kept.count() == 1
