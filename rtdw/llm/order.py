"""The row after each row in a table's order, without sorting the table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.tables import partitions_for

ROWS_PER_BUCKET = 20_000


def _bucket(place: Column, bounds: list[int]) -> Column:
    """How many bounds lie at or below the place, found by looking at a few, then nearby."""
    step = max(1, int(len(bounds) ** 0.5))
    array = F.array(*map(F.lit, bounds))
    coarse = F.array(*map(F.lit, bounds[::step]))
    block = F.greatest(F.size(F.filter(coarse, lambda x: x <= place)) - 1, F.lit(0))
    near = F.slice(array, block * step + 1, step)
    return block * step + F.size(F.filter(near, lambda x: x <= place))


def with_next(df: DataFrame, key: str, tie: Column, columns: dict[str, str]) -> DataFrame:
    """Each row with values of the next row in descending order of a whole-number key.

    ``columns`` maps columns to the names that the next row's values get. After the last
    row comes the first; a single row follows itself. Rows of equal keys are ordered by
    ``tie``, descending, and rows without a key come last, by ``tie`` as well.

    Rows are dealt to ranges of the key. The first row of each range is also sent to the
    range before, as what follows that range's last row.
    """
    low = F.lit(-(1 << 62))
    spread = tie.bitwiseAND(F.lit((1 << 61) - 1))
    placed = df.withColumns({
        "__place": F.coalesce(F.col(key).cast("long"), low - spread), "__tie": tie,
    })
    total = placed.count()
    if not total:
        return df.withColumns({new: F.lit(None).cast(df.schema[old].dataType) for old, new in columns.items()})
    buckets = partitions_for(df, total, ROWS_PER_BUCKET)
    shares = [i / buckets for i in range(1, buckets)]
    cuts = placed.agg(F.percentile_approx("__place", shares, 10 * buckets)).first()[0] if shares else []
    bounds = sorted(set(cuts))
    bucket = _bucket(F.col("__place"), bounds) if bounds else F.lit(0)
    first = dict(
        placed.select("__place", bucket.alias("b")).groupBy("b").agg(F.max("__place")).collect()
    )
    used = sorted(first)
    after = dict(zip(used, used[1:] + used[:1], strict=True))  # the range before, in this order
    places = range(used[-1] + 1)
    heads = F.array(*(F.lit(first.get(b)).cast("long") for b in places))
    goals = F.array(*(F.lit(after.get(b)).cast("int") for b in places))
    goal = F.when(F.get(heads, bucket) == F.col("__place"), F.get(goals, bucket))
    dealt = placed.withColumn(
        "__to",
        F.explode(F.array_compact(F.array(
            F.struct(bucket.cast("int").alias("bucket"), F.lit(False).alias("ghost")),
            F.when(goal.isNotNull(), F.struct(goal.alias("bucket"), F.lit(True).alias("ghost"))),
        ))),
    )
    order = Window.partitionBy("__to.bucket").orderBy("__to.ghost", F.desc("__place"), F.desc("__tie"))
    out = dealt.withColumns({new: F.lead(old).over(order) for old, new in columns.items()})
    return out.filter("not __to.ghost").drop("__place", "__tie", "__to")
