"""Every query on odd, clashing and empty tables."""

from collections import Counter

import pytest

from rtdw.llm.queries import QUERIES

NAMES = list(QUERIES)
TABLE = {"op6_warc": "pages", "op9_preferences": "conversations"}
# Places that equal pieces and rows may exchange, and what may have either sign.
FREE = {"sequence_id", "offset", "slot", "whitened"}


def rows_of(spark, name, folder):
    df = QUERIES[name](spark, folder)
    rows = df.select(*(c for c in df.columns if c not in FREE)).collect()
    return Counter(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns_change_nothing(spark, odd_dir, clash_dir, name):
    plain = rows_of(spark, name, odd_dir)
    assert plain == rows_of(spark, name, clash_dir)
    if name not in ("pipeline", "op7_packing", "op9_preferences", "op11_whitening"):
        table = spark.read.parquet(f"{odd_dir}/{TABLE.get(name, 'documents')}.parquet")
        assert sum(plain.values()) == table.count()
