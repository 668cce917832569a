"""What the plans of the batch queries must and must not hold."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from rtdw.operators import stats
from rtdw.plans.queries import QUERIES
from rtdw.session import session_settings
from rtdw.sources import tables

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))
# As if every table were large: nothing is small enough to broadcast.
LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_single_task(spark, sf_dir, name):
    with session_settings(spark, LARGE):
        text = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("Python", "CartesianProduct", "NestedLoop", "SinglePartition", "BroadcastExchange"):
        assert bad not in text, text


@pytest.mark.parametrize(
    "name", ["unique_visit_daily", "new_visitor_fix", "cdc_latest_table", "config_latest"]
)
def test_first_row_rules_cut_down_before_the_shuffle(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    steps = text.split("\n\n")[0].split("WindowGroupLimit")[1:]
    assert steps and len(steps) % 2 == 0
    for final, partial in zip(steps[::2], steps[1::2], strict=True):
        assert "Exchange" in final and "Scan" in partial


def test_scans_read_the_columns_they_need(spark, sf_dir):
    text = plan(entry.queries()["session_starts"](spark, sf_dir))
    assert "event_id" not in text
    text = plan(entry.queries()["distinct_orders_by_sku"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_filters_reach_the_scan(spark, sf_dir, tmp_path):
    text = plan(entry.queries()["good_comment_rate"](spark, sf_dir))
    assert "EqualTo(event_type,error)" in text
    path = str(tmp_path / "stats")
    spark.sql("SELECT '2024-01-01 00:00:00' AS stt, cast(1 AS decimal(26,2)) AS order_amount").write.parquet(path)
    text = plan(stats.gmv(spark.read.parquet(path)))
    assert "GreaterThanOrEqual(stt," in text and "LessThanOrEqual(stt," in text


def test_texts_are_shuffled_and_not_their_words(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(tables, "DEALT_BYTES", 1 << 15)
    text = plan(entry.queries()["keyword_han_words"](spark, sf_dir))
    shuffles = [x for x in text.split("\n") if "hashpartitioning" in x]
    assert len(shuffles) == 1 and "hashpartitioning(doc_id" in shuffles[0] and ", 9), REPARTITION_BY_NUM" in shuffles[0]


def test_facts_are_read_and_shuffled_once(spark, sf_dir):
    with session_settings(spark, LARGE):
        text = plan(QUERIES["product_stats"](spark, sf_dir))
        wide = plan(QUERIES["order_wide_dims"](spark, sf_dir))
    assert text.count("lineitem.parquet") == 1  # refunds; order wide is a table by then
    # The order/detail join, the orders' customers, three dimension joins of the facts and
    # three of the products.
    assert wide.split("\n\n")[0].count("SortMergeJoin") <= 8
