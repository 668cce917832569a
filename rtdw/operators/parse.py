"""JSON text to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from rtdw.functions.times import millis_to_second
from rtdw.schemas import PAGE_VIEW, TEXT_MAP


def parse_once(
    df: DataFrame, schema: T.DataType, value: str = "value", name: str = "__parsed"
) -> DataFrame:
    """Add ``name``: the text parsed as a list of records.

    The text is read as the inside of a JSON list, which makes anything after
    the record an error instead of being passed over; a proper line gives a list
    of one. It goes through a generator because filters on its fields would
    otherwise be pushed below it, parsing each line once more per filter.
    """
    whole = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), T.ArrayType(schema))
    return df.select("*", F.explode(F.array(whole)).alias(name))


def not_one(name: str = "__parsed") -> Column:
    """True unless the parsed list holds exactly one record."""
    return F.expr(f"coalesce(size({name}) <> 1 or {name}[0] is null, true)")


def parse_strict(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed columns of a JSON text column; a malformed row fails the job."""
    parsed = F.from_json(F.col(value), schema, {"mode": "FAILFAST"})
    return df.select(F.explode(F.array(parsed)).alias("__parsed")).select("__parsed.*")


def mark_dirty(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``dirty``: true for text that is not one JSON object."""
    parsed = parse_once(df, TEXT_MAP, value)
    return parsed.select(*df.columns, not_one().alias("dirty"))


def split_dirty(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(clean rows, dirty rows), both as they came."""
    marked = mark_dirty(df, value)
    return marked.where("not dirty").drop("dirty"), marked.where("dirty").drop("dirty")


def page_view(df: DataFrame, value: str = "value") -> DataFrame:
    """The SQL jobs' page table: two maps, ``ts`` and the event time ``rt``."""
    return parse_strict(df, PAGE_VIEW, value).withColumn(
        "rt", millis_to_second("ts")
    )
