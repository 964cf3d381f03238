"""Physical-plan checks: pushdown, pruning, partial aggregation, shuffle
count, and no Python on the data path of any registered query."""

from __future__ import annotations

import re

import pytest

from logengine.plans.catalog import QUERIES

from .conftest import SF_SMALL


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _nodes(plan: str, name: str) -> int:
    """Number of operators called ``name`` (detail headers ``(n) name``)."""
    return len(re.findall(rf"^\(\d+\) {re.escape(name)}\b", plan, flags=re.M))


#: Queries with a step in numpy: the chain of jumps inside a cell of lines.
IN_PYTHON = {"byte_batches"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - IN_PYTHON))
def test_no_python_udf_in_any_query(spark, name):
    p = _formatted(QUERIES[name](spark, SF_SMALL))
    for node in ("MapInArrow", "FlatMapGroupsInArrow", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, f"{name} runs Python: {node}"


def test_time_range_filter_pushed_to_parquet(spark):
    p = _formatted(QUERIES["time_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate," in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_log_scan_reads_only_needed_columns(spark):
    p = _formatted(QUERIES["level_count"](spark, SF_SMALL))
    # `value` (a double) of events is never read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p
    assert _nodes(p, "Scan parquet") == 1


def test_flagship_pane_form_two_exchanges_with_partial_aggregates(spark):
    df = QUERIES["sliding_level_count"](spark, SF_SMALL)
    p = _formatted(df)
    assert _nodes(p, "Exchange") == 2
    assert _nodes(p, "HashAggregate") == 4  # partial + final, twice
    assert _nodes(p, "Scan parquet") == 1


def test_fixed_levels_one_pass_vs_union(spark):
    one = _formatted(QUERIES["fixed_level_count"](spark, SF_SMALL))
    assert _nodes(one, "Scan parquet") == 1
    for name in ("union_levels", "union_levels_sql"):
        assert _nodes(_formatted(QUERIES[name](spark, SF_SMALL)), "Scan parquet") == 1


def test_latest_level_sorts_no_raw_rows(spark):
    for name in ("latest_level", "sliding_latest_level"):
        p = _formatted(QUERIES[name](spark, SF_SMALL))
        tree = p.split("\n\n\n")[0].splitlines()  # root first: what comes last feeds the first exchange
        lowest = max(i for i, x in enumerate(tree) if "Exchange" in x)
        assert not any(re.search(r"\bSort", x) for x in tree[lowest:]), name
        assert any("HashAggregate" in x for x in tree[lowest:]), name


def test_a_row_is_split_once(spark):
    p = _formatted(QUERIES["parse_log"](spark, SF_SMALL))
    condition = re.search(r"\(\d+\) Filter.*?Condition : (.*?)\n\n", p, re.S)
    assert condition and "split(" not in condition[1]


def test_byte_queries_shuffle_no_text(spark):
    for name in ("oversize_batches", "byte_batches"):
        p = _formatted(QUERIES[name](spark, SF_SMALL))
        for exchange in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", p):
            assert "line#" not in exchange and "l_extendedprice" not in exchange, name


def test_word_count_partial_aggregate(spark):
    p = _formatted(QUERIES["word_count"](spark, SF_SMALL))
    assert "partial_count" in p
    assert "ReadSchema: struct<text:string>" in p


def test_select_measurement_prunes_other_tables(spark):
    p = _formatted(QUERIES["select_measurement"](spark, SF_SMALL))
    assert _nodes(p, "Scan parquet") == 1
    assert "orders.parquet" in p and "lineitem.parquet" not in p


def test_series_rows_no_shuffle_after_documents(spark):
    # reading documents is per row (explode / zip); the only exchange is
    # the one that builds the documents from orders
    p = _formatted(QUERIES["series_rows"](spark, SF_SMALL))
    assert _nodes(p, "Exchange") == 1


def test_result_errors_single_pass(spark):
    p = _formatted(QUERIES["result_errors"](spark, SF_SMALL))
    assert _nodes(p, "Scan parquet") == 1
    assert _nodes(p, "Exchange") == 1


def test_tick_consumers_reuse_tick_partitioning(spark):
    # pane counts (1 exchange) + expanded panes shuffled by (tick, part) (1);
    # the part grouping reuses it: no third exchange, no task per tick
    for name in ("tick_payload", "tick_snapshot"):
        p = _formatted(QUERIES[name](spark, SF_SMALL))
        assert _nodes(p, "Exchange") == 2, name
        assert re.search(r"hashpartitioning\(tick#\d+, part#\d+", p), name


def test_long_windows_copy_no_panes(spark):
    # 720 slides a window: ticks are written out after the last exchange, not before it
    for name in ("hourly_level_count", "hourly_latest_level"):
        tree = _formatted(QUERIES[name](spark, SF_SMALL)).split("\n\n\n")[0].splitlines()  # root first
        assert not any("Exchange" in x for x in tree[: next(i for i, x in enumerate(tree) if "Generate" in x)]), name
