"""The two join forms of the warehouse: interval join and dimension lookup.

A lookup forces no broadcast. Spark compares the size of a dimension with
``spark.sql.autoBroadcastJoinThreshold``, from file statistics first and from
shuffle sizes at run time, and falls back to a sorted merge whose skewed
partitions AQE splits. An interval join has facts on both sides, which grow
with the data, so it always merges.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rtdw.functions.times import duration_ms


def _interval(ms: int) -> str:
    return f"INTERVAL '{ms / 1000:.3f}' SECOND"


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    lower: str,
    upper: str,
    slice_length: str | None = None,
) -> DataFrame:
    """Inner join on the keys where right time is in [left + lower, left + upper].

    Both times are timestamps. The sides stay reachable as ``l`` and ``r`` for
    a following ``select``.

    On stored tables the key is extended by a time slice: a right row lies in
    one slice, a left row is sent to each slice its interval touches (with the
    default of 16 interval lengths about 1.06 on average). So a key with very
    many rows on both sides is compared slice by slice only. On streams the slice
    is added to the key in the same way. The plain condition on the times stays beside it,
    as it bounds the join state; the times are those columns that carry the watermarks.
    """
    low, high = duration_ms(lower), duration_ms(upper)
    if low > high:
        raise ValueError("lower bound above upper bound")
    match = (
        f"l.{left_key} = r.{right_key}"
        f" and r.{right_time} >= l.{left_time} + {_interval(low)}"
        f" and r.{right_time} <= l.{left_time} + {_interval(high)}"
    )
    length = duration_ms(slice_length) if slice_length else max(16 * (high - low), 1)
    if left.isStreaming or right.isStreaming:
        touched = f"""explode(sequence(floor((unix_millis({left_time}) + ({low})) / {length}),
                                       floor((unix_millis({left_time}) + ({high})) / {length})))"""
        return left.selectExpr("*", f"{touched} as __slice").alias("l").join(
            right.selectExpr("*", f"floor(unix_millis({right_time}) / {length}) as __slice").alias("r"),
            F.expr(f"{match} and l.__slice = r.__slice"),
            "inner",
        )
    # The join time comes out of the generator too: a null check on a plain
    # column would be pushed to the scan and parse the time text once more.
    sliced_left = left.selectExpr(
        "*",
        f"""inline(transform(
              sequence(floor((unix_millis({left_time}) + ({low})) / {length}),
                       floor((unix_millis({left_time}) + ({high})) / {length})),
              s -> struct({left_time} as __at, s as __slice)))""",
    )
    sliced_right = right.selectExpr(
        "*",
        f"""inline(array(struct(
              {right_time} as __at, floor(unix_millis({right_time}) / {length}) as __slice)))""",
    )
    sliced_match = match.replace(f"l.{left_time}", "l.__at").replace(f"r.{right_time}", "r.__at")
    return sliced_left.alias("l").join(
        sliced_right.alias("r").hint("merge"),
        F.expr(f"{sliced_match} and l.__slice = r.__slice"),
        "inner",
    )


def enrich(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Mapping[str, Column | str],
    dim_key: str = "id",
    how: str = "inner",
) -> DataFrame:
    """Add dimension columns to facts: ``columns`` maps new names to dimension columns.

    A new name replaces a fact column of the same name in place. With ``inner``
    (the default) a fact without its dimension row is left out, with ``left`` it
    keeps nulls. ``dim_key`` is the dimension's primary key.
    """
    key_type = facts.schema[key].dataType.simpleString()
    looked_up = dim.select(
        F.expr(f"cast({dim_key} as {key_type}) as __dim_key"),
        *[
            F.expr(f"{c} as __dim_{name}") if isinstance(c, str) else c.alias(f"__dim_{name}")
            for name, c in columns.items()
        ],
    )
    joined = facts.join(looked_up, F.expr(f"{key} = __dim_key"), how)
    kept = [f"__dim_{c} as {c}" if c in columns else c for c in facts.columns]
    added = [f"__dim_{n} as {n}" for n in columns if n not in facts.columns]
    return joined.selectExpr(*kept, *added)


PRODUCT_NAMES = (
    "sku_name", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name",
)


def product_dimension(dims: Mapping[str, DataFrame], how: str = "inner") -> DataFrame:
    """The products with the names of their SPU, trademark and category.

    With ``inner`` a product that lacks one of these is left out, as a fact of it would be.
    """
    products = dims["sku"]
    steps = (
        ("spu", "spu_id", {"spu_name": "spu_name"}),
        ("trademark", "tm_id", {"tm_name": "tm_name"}),
        ("category3", "category3_id", {"category3_name": "name"}),
    )
    for dim, key, columns in steps:
        products = enrich(products, dims[dim], key, columns, how=how)
    return products


def lookup(dim: DataFrame, keys: DataFrame, key: str, dim_key: str = "id") -> DataFrame:
    """The dimension rows asked for by a table of ids, each once."""
    asked = keys.select(F.col(key).cast(dim.schema[dim_key].dataType).alias("__asked"))
    return dim.join(asked, F.col(dim_key) == F.col("__asked"), "left_semi")
