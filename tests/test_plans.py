"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import reports
from tallyworks.plans import catalogue, chains, standins
from tallyworks.sinks import tables

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalogue.catalogue()))
def test_no_cross_join_and_no_python_worker(spark, name):
    text = plan(catalogue.catalogue()[name](spark, FOLDER))
    for node in ("NestedLoop", "CartesianProduct", "Python", "Pandas", "Arrow"):
        assert node not in text


def test_joins_above_the_broadcast_limit_shuffle(spark):
    """With nothing small enough to broadcast, only lists of a bounded length still are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        build = plan(catalogue.warehouse_build(spark, FOLDER))
        assert build.count("BroadcastHashJoin") - build.count("LeftOuter, BuildRight") == 0
        assert "SortMergeJoin" in build
        assert "NestedLoop" not in plan(catalogue.anti_join_like(spark, FOLDER))
        assert "NestedLoop" not in plan(catalogue.warehouse_build_like(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_words_uses_a_bounded_heap(spark):
    assert "TakeOrderedAndProject" in plan(catalogue.top_words(spark, FOLDER))


@pytest.mark.parametrize("name", ["roster_top3", "roster_mode", "pig_mode", "pig_top3"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(catalogue.catalogue()[name](spark, FOLDER))


def test_report_1_reads_its_table_once_and_filters_at_the_scan(spark):
    text = plan(catalogue.roster_avg_mode(spark, FOLDER))
    assert text.count("lineitem.parquet") == 1
    assert "Not(StringContains(p_brand,1))" in text


def test_error_log_reads_each_source_once(spark):
    assert plan(catalogue.dq_error_records(spark, FOLDER)).count("FileScan") == 3
    assert plan(catalogue.dq_union_rules(spark, FOLDER)).count("FileScan") == 6


def test_partitioned_report_prunes_partitions(spark):
    roster = catalogue._partitioned_roster(spark, FOLDER)
    text = plan(reports.percentage_below(roster.where(F.col("batch") == "1995")))
    assert "PartitionFilters: [isnotnull(batch" in text
    assert "ReadSchema: struct<course:string,avg_attendance_percent:decimal(5,2)>" in text


def test_bucketed_table_groups_without_a_shuffle(spark):
    name, _ = catalogue._partitioned_layout(spark, FOLDER)
    text = plan(spark.table(name).groupBy("course", "batch").count())
    assert "Exchange" not in text
    assert "SelectedBucketsCount: 4 out of 4" in text


def test_partitioned_write_rebalances(spark):
    text = plan(tables.clustered_for_write(standins.roster(spark, FOLDER), "batch", "course"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def without_subqueries(text):
    """The plan without the trees of values computed aside, such as the filter of the vocabulary."""
    kept, inside = [], None
    for line in text.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth > inside:
            continue
        inside = depth if line.lstrip(" :+-").startswith("Subquery") else None
        if inside is None:
            kept.append(line)
    return "\n".join(kept)


@pytest.mark.parametrize("name", ["cooc_pairs_d4", "cooc_pairs_line_agg", "cooc_distance_sweep"])
def test_cooccurrence_shuffles_counts_only(spark, name):
    text = without_subqueries(plan(catalogue.catalogue()[name](spark, FOLDER)))
    counting = text[: text.index("FileScan")]
    assert counting.count("Exchange hashpartitioning") == 2  # pairs and gaps
    assert "hashpartitioning(doc_id" not in counting


@pytest.mark.parametrize("name", ["word_count", "cooc_pairs_d1", "cooc_pairs_line_agg", "document_frequency", "roster_avg"])
def test_tasks_aggregate_before_they_shuffle(spark, name):
    text = plan(catalogue.catalogue()[name](spark, FOLDER))
    exchanges = text.count("Exchange hashpartitioning")
    assert text.count("functions=[partial_") >= exchanges > 0


def test_a_short_stop_word_list_is_broadcast(spark):
    text = plan(catalogue.document_frequency(spark, FOLDER))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_stems_are_computed_once_per_token(spark):
    text = plan(catalogue.document_frequency(spark, FOLDER))
    assert "Filter ((size(" not in text



def test_document_folders_are_opened_once(spark):
    """The passes over the documents read a table, not one file for each document again."""
    assert "FileScan text" not in plan(chains.chain_tfidf(spark, FOLDER))
