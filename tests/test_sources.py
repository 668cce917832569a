"""Readers of change records and dimensions, and the scan helpers."""

import json
from decimal import Decimal

import pytest

from rtdw import schemas
from rtdw.operators import cdc
from rtdw.sources import changes, dims
from rtdw.sources.rows import literal_table
from rtdw.sources.tables import read_table
from rtdw.sources.topics import records

RAW = {"topic": "srv.shop.base_trademark", "op": "c", "before": None, "after": {"id": 1, "tm_name": "a"}, "seq": 5}
ROW = schemas.struct("id int, tm_name string")


def lines(spark, *rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")


def test_raw_changes(spark):
    df = lines(spark, RAW, RAW | {"op": "u", "after": {"id": 1, "tm_name": "b"}, "seq": 6})
    parsed = changes.parse_raw_changes(df)
    assert parsed.columns == schemas.CHANGE.fieldNames()
    assert [tuple(r) for r in cdc.typed_rows(cdc.fold(parsed), ROW).collect()] == [(1, "b")]
    kept = changes.with_raw(df).orderBy("value").collect()
    assert [json.loads(r["value"])["seq"] for r in kept] == [r["record"]["seq"] for r in kept]


def test_malformed_change_fails(spark):
    df = spark.createDataFrame([("{broken",)], "value string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        changes.parse_changes(df).collect()


def test_snapshot_then_changes(spark, tmp_path):
    envelope = {"database": "shop", "tableName": "base_trademark", "before": {}, "type": "insert"}
    (tmp_path / "1.log").write_text(
        "\n".join(json.dumps(envelope | extra) for extra in (
            {"after": {"id": "2", "tm_name": "new"}, "seq": 1},
            {"after": {"id": "1", "tm_name": "changed"}, "seq": 2, "type": "update"},
            {"after": {"id": "9", "tm_name": "other"}, "seq": 3, "tableName": "other"},
        ))
    )
    stored = spark.createDataFrame([(1, "old"), (3, "kept")], "id int, tm_name string")
    both = changes.snapshot_then_changes(spark, stored, str(tmp_path), "shop", "base_trademark")
    got = cdc.typed_rows(cdc.fold(both), ROW).collect()
    assert sorted(tuple(r) for r in got) == [(1, "changed"), (2, "new"), (3, "kept")]


def test_dimension_is_cast_and_names_match_in_any_case(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.createDataFrame(
        [("7", "phone", "9.5", "70", "71", "72", "x")],
        "ID string, SKU_NAME string, PRICE string, SPU_ID string, TM_ID string, "
        "CATEGORY3_ID string, EXTRA string",
    ).write.parquet(path)
    got = dims.read_parquet(spark, path, schemas.DIM_SKU)
    assert got.schema == schemas.DIM_SKU
    assert [tuple(r) for r in got.collect()] == [(7, "phone", Decimal("9.50"), 70, 71, 72)]


def test_records_accept_numbers_and_text(spark):
    df = lines(spark, {"sku_id": 7, "create_time": "t"}, {"sku_id": "8", "more": [1]})
    assert sorted(tuple(r) for r in records(df, schemas.CART_INFO).collect()) == [(7, "t"), (8, None)]


def test_literal_table_quotes_its_values(spark):
    got = literal_table(spark, "a string, b string", [("it's", "a\\b"), ("x", "")]).collect()
    assert sorted(tuple(r) for r in got) == [("it's", "a\\b"), ("x", "")]
