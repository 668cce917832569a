"""Behaviour log: new-visitor correction and the split into page, start and display logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from rtdw.operators.parse import not_one, parse_once
from rtdw.schemas import TEXT_MAP

# Topic names of the detail layer.
PAGE_TOPIC = "dwd_page_log"
START_TOPIC = "dwd_start_log"
DISPLAY_TOPIC = "dwd_display_log"
DIRTY_TOPIC = "dirty_log"

RECORD = T.StructType(
    [
        T.StructField("common", TEXT_MAP),
        T.StructField("page", TEXT_MAP),
        T.StructField("displays", T.ArrayType(TEXT_MAP)),
        T.StructField("start", T.StringType()),
        T.StructField("ts", T.StringType()),
    ]
)


def read_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Log lines with the fields the split needs, and ``dirty``.

    ``line_id`` stands for the text where lines of equal time must be told apart.
    Dirty is a line that is not one JSON object, or has no device id.
    """
    record = "__parsed[0]"
    return (
        parse_once(lines.selectExpr(f"{value} as value"), RECORD)
        .select("value", F.expr(record).alias("r"), not_one().alias("broken"))
        .selectExpr(
            "value",
            "xxhash64(value) as line_id",
            "r.common['mid'] as mid",
            "r.common['is_new'] as is_new",
            "try_cast(r.ts as bigint) as ts",
            "if(r.start = 'null', null, r.start) as start",
            "r.page['page_id'] as page_id",
            "r.displays as displays",
            "broken or r.common['mid'] is null as dirty",
        )
    )


def fix_new_visitor(
    df: DataFrame,
    mid: str = "mid",
    is_new: str = "is_new",
    order: tuple[str, ...] = ("ts", "event_id"),
) -> DataFrame:
    """Per device only the first row flagged ``'1'`` keeps the flag; later ones get ``'0'``.

    ``order`` must tell different rows of a device apart; rows equal in it are
    copies of one line, of which one keeps the flag. The first row per device is
    taken with a ranked filter, which Spark applies before the shuffle as well,
    and joined back on the whole row identity: that key is spread evenly even
    if one device holds a large share of all rows. Copies are counted, partly
    before they move. Rows without the flag are not shuffled at all. Missing
    order values come first.
    """
    first = Window.partitionBy(mid).orderBy(*order)
    identity = (mid, *order)
    flagged = df.where(f"{is_new} = '1'")
    firsts = (
        flagged.select(*identity)
        .withColumn("__rank", F.row_number().over(first))
        .where("__rank = 1")
        .selectExpr(*[f"{c} as __first_{c}" for c in identity])
    )
    same_row = F.expr(" and ".join(f"{c} <=> __first_{c}" for c in identity))
    others = [c for c in df.columns if c not in identity]
    lowered = [f"'0' as {is_new}" if c == is_new else c for c in df.columns]
    later = flagged.join(firsts, same_row, "left_anti").selectExpr(*lowered)
    copies = (
        flagged.join(firsts, same_row, "left_semi")
        .groupBy(*identity)
        .agg(F.any_value(F.struct(*others)).alias("__row"), F.count("*").alias("__copies"))
        .selectExpr(*identity, "__row.*", "explode(sequence(1L, __copies)) as __copy")
        .selectExpr(
            *[f"if(__copy = 1, {c}, '0') as {c}" if c == is_new else c for c in df.columns]
        )
    )
    rest = df.where(f"{is_new} is distinct from '1'")
    return later.unionByName(copies).unionByName(rest)


# A flag that is set, as text or as a number, wherever it stands in a line.
_FLAG = r'"is_new"\s*:\s*(?:"1"|1(?=\s*[,}]))'


def with_flag(value: Column, is_new: Column) -> Column:
    """The log text with its new-visitor flag lowered where ``is_new`` is ``'0'``.

    Only ``is_new`` of ``common`` changes, all other text stays as it is: of the
    places where a flag is set, the one is changed that makes the parsed flag
    ``'0'``. A line whose flag is not set stays as it is.
    """
    between = F.split(value, _FLAG)
    flags = F.regexp_extract_all(value, F.lit(_FLAG), F.lit(0))

    def with_lowered(k: Column) -> Column:
        def piece(text: Column, i: Column) -> Column:
            flag = F.coalesce(F.get(flags, i), F.lit(""))
            lowered = F.regexp_replace(flag, r'(?:"1"|1)$', '"0"')
            return F.concat(text, F.when(i == k, lowered).otherwise(flag))

        return F.array_join(F.transform(between, piece), "")

    tried = F.transform(F.sequence(F.lit(0), F.size(flags) - 1), with_lowered)
    right = F.filter(tried, lambda text: F.get_json_object(text, "$.common.is_new") == "0")
    is_set = F.get_json_object(value, "$.common.is_new") == "1"
    change = (is_new == "0") & is_set & (F.size(flags) > 0)
    return F.when(change, F.coalesce(F.get(right, F.lit(0)), value)).otherwise(value)


# One display with its page's id, as a map.
_DISPLAY = "map_concat(map_filter(d, (k, v) -> k <> 'page_id'), map('page_id', page_id))"


def display_rows(log: DataFrame) -> DataFrame:
    """One row per display, with the id of its page; start logs give none."""
    shown = log.where("start is null").select("page_id", F.explode("displays").alias("d"))
    return shown.selectExpr(f"{_DISPLAY} as display")


def split_topics(log: DataFrame) -> DataFrame:
    """Rows (topic, value) of all logs, in one pass over the input.

    A start log gives its ``start`` object only. Any other record gives the whole
    record to the page log and each display, with ``page_id``, to the display
    log. Dirty lines go to a topic of their own.
    """
    return log.withColumn("value", with_flag(F.col("value"), F.col("is_new"))).selectExpr(
        f"""inline(
              case when dirty then array(struct('{DIRTY_TOPIC}' as topic, value as value))
                   when start is not null
                   then array(struct('{START_TOPIC}' as topic, start as value))
                   else concat(
                     array(struct('{PAGE_TOPIC}' as topic, value as value)),
                     transform(coalesce(displays, array()),
                               d -> struct('{DISPLAY_TOPIC}' as topic,
                                           to_json({_DISPLAY}) as value)))
              end)"""
    )
