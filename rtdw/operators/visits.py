"""Per-device rules on page logs: daily unique visits and bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rtdw.functions.times import duration_ms, millis_to_day

LAST_PAGE = "page.last_page_id"
MID = "common.mid"


def visit_condition(kind: str, last_page: str = LAST_PAGE) -> Column:
    """Rows that may count as a visit: ``non_entry`` (default), ``entry`` or ``all``."""
    conditions = {
        "non_entry": F.col(last_page).isNotNull(),
        "entry": F.col(last_page).isNull(),
        "all": F.lit(True),
    }
    return conditions[kind]


def unique_visits(
    pages: DataFrame,
    mid: str = MID,
    ts: str = "ts",
    tiebreak: tuple[str, ...] = (),
    visits: str = "non_entry",
    last_page: str = LAST_PAGE,
) -> DataFrame:
    """The first counted row per device and day.

    The rank filter runs once before the shuffle (one row per device, day and
    input task is sent on), so a busy device does not gather in one task.
    """
    w = Window.partitionBy(F.col(mid), F.col("__day")).orderBy(F.col(ts), *tiebreak)
    return (
        pages.where(visit_condition(visits, last_page))
        .withColumn("__day", millis_to_day(ts))
        .withColumn("__rank", F.row_number().over(w))
        .where("__rank = 1")
        .drop("__rank", "__day")
    )


def bounces(
    pages: DataFrame,
    mid: str = MID,
    ts: str = "ts",
    tiebreak: tuple[str, ...] = (),
    last_page: str = LAST_PAGE,
    timeout: str = "10 seconds",
    slice_length: str | None = None,
) -> DataFrame:
    """Entry rows whose next row of the device is another entry or is ``timeout`` away.

    Only a successor within ``timeout`` can cancel a bounce. So a device's rows
    are cut into time slices (default 30 timeouts), and the rows of the first
    ``timeout`` of a slice are also shown to the slice before it. That is exact
    and keeps a device's whole history out of any single task. Rows without ``ts`` have no
    place in the order and are left out.
    """
    gap = duration_ms(timeout)
    length = duration_ms(slice_length) if slice_length else 30 * gap
    if length < gap:
        raise ValueError("a time slice must not be shorter than the timeout")
    at = F.col(ts)
    entry = F.col(last_page).isNull()
    own = F.floor(at / length)
    seen_by = F.when(at - own * length < gap, F.array(own, own - 1)).otherwise(F.array(own))
    sliced = (
        pages.where(at.isNotNull())
        .withColumn("__own", own)
        .withColumn("__slice", F.explode(seen_by))
        .withColumn("__entry", entry)
        .withColumn("__report", entry & (F.col("__own") == F.col("__slice")))
    )
    # The payload of rows that are never reported need not be shuffled.
    bare = [
        F.col(c) if c in (mid, ts, *tiebreak) or _is_parent(c, mid)
        else F.when(F.col("__report"), F.col(c)).alias(c)
        for c in pages.columns
    ]
    narrow = sliced.select(*bare, "__slice", "__entry", "__report")
    w = Window.partitionBy(F.col(mid), F.col("__slice")).orderBy(F.col(ts), *tiebreak)
    next_ts = F.lead(ts).over(w)
    next_entry = F.lead("__entry").over(w)
    return (
        narrow.withColumn("__next_ts", next_ts)
        .withColumn("__next_entry", next_entry)
        .where(
            F.col("__report")
            & (
                F.col("__next_ts").isNull()
                | (F.col("__next_ts") - at >= gap)
                | F.col("__next_entry")
            )
        )
        .select(*pages.columns)
    )


def _is_parent(column: str, path: str) -> bool:
    return path.startswith(column + ".")
