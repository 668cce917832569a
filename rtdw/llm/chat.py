"""Preference formatting: a shared prompt and a pair of masked completions.

Chosen and rejected conversations are compared turn by turn. Their longest common prefix
of turns is rendered once, as the prompt; what follows in each is its completion. A mask
lists the spans of a completion that are learned: what the assistant says, with the mark
that ends it. All of it is column expressions on one row per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.order import with_next
from rtdw.llm.tables import table

END = "<|end|>\n"


def head(role: Column) -> Column:
    """What a turn begins with."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def rendered(turns: Column) -> Column:
    """Turns (role, text) as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t["role"]), t["text"], F.lit(END))), "")


def learned(turns: Column) -> Column:
    """Spans (start, length) in characters of the rendered turns that are learned."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        begin = done["at"] + F.length(head(turn["role"]))
        size = F.length(turn["text"]) + len(END)
        span = F.struct(begin.alias("start"), size.alias("length"))
        spans = F.when(turn["role"] == "assistant", F.concat(done["spans"], F.array(span)))
        return F.struct((begin + size).alias("at"), spans.otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda done: done["spans"])


def preference_format(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Pairs of turn arrays (role, text) as ``n_common``, ``prompt``, ``chosen``, ``rejected``,
    ``chosen_mask`` and ``rejected_mask``; other columns stay.

    Equal conversations are all prompt, with empty completions. Where a side is null, so are
    its completion and mask, and the other side is all prompt. A null role or text is empty.
    """
    clean = lambda c: F.transform(
        c, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))
    )
    rest = [c for c in pairs.columns if c not in (chosen, rejected)]
    rows = pairs.select(*rest, clean(F.col(chosen)).alias("__a"), clean(F.col(rejected)).alias("__b"))
    both = F.coalesce("__a", "__b"), F.coalesce("__b", "__a")
    same = F.zip_with(*both, lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(same, False)
    common = F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")
    rows = rows.withColumn("__n", common)
    after = lambda c: F.slice(F.col(c), F.col("__n") + 1, F.greatest(F.size(c), F.lit(1)))
    return rows.select(
        *rest, F.col("__n").cast("long").alias("n_common"),
        rendered(F.slice(F.coalesce("__a", "__b"), F.lit(1), F.col("__n"))).alias("prompt"),
        rendered(after("__a")).alias("chosen"), rendered(after("__b")).alias("rejected"),
        learned(after("__a")).alias("chosen_mask"), learned(after("__b")).alias("rejected_mask"),
    )


def conversations_of(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and ``turns`` (turn, role, text) in order.

    A conversation is a unit, as a text is. Repeated rows are one turn; turns of one number
    are ordered by role and text, those without a number come first. Rows without a conv_id
    are part of no conversation.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.filter("conv_id is not null").groupBy("conv_id").agg(
        F.array_distinct(F.sort_array(F.collect_list(turn))).alias("turns")
    )


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): a conversation up to its last reply, and the same with
    the last reply of the next conversation, by descending conv_id, in its place.

    A conversation without a reply is all chosen, with nothing rejected.
    """
    all_turns = conversations_of(turns)
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), "assistant") + 1
    cut = all_turns.withColumn("n", F.when(F.exists("turns", lambda t: t["role"] == "assistant"), last.cast("int")))
    plain = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    replied = cut.filter("n is not null").select(
        "conv_id", plain(F.slice("turns", F.lit(1), F.col("n"))).alias("chosen"), F.element_at("turns", F.col("n"))["text"].alias("reply"),
        F.col("n").alias("n"),
    )
    replied = with_next(replied, "conv_id", F.xxhash64("reply"), {"reply": "other"})
    answer = F.array(F.struct(F.lit("assistant").alias("role"), F.col("other").alias("text")))
    pairs = replied.select(
        "conv_id", "chosen", F.concat(F.slice("chosen", F.lit(1), F.col("n") - 1), answer).alias("rejected")
    )
    none = cut.filter("n is null").select("conv_id", plain(F.col("turns")).alias("chosen"))
    return pairs.unionByName(none, allowMissingColumns=True)


def op9_preferences(spark, sf_dir: str) -> DataFrame:
    """Every conversation as a preference pair; masks are written as start:length."""
    out = preference_format(preference_pairs(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["length"].cast("string"))), " "
    )
    replied = F.col("rejected").isNotNull()
    return out.select(
        "conv_id", "n_common", "prompt", F.when(replied, F.col("chosen")).alias("chosen"), "rejected",
        F.when(replied, spans("chosen_mask")).alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask"),
    )


OP9_SQL = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
    ) AS p FROM turns
), lasts AS (
    SELECT conv_id, max(p) FILTER (role = 'assistant') AS n, max(p) AS size FROM placed GROUP BY conv_id
), replies AS (
    SELECT conv_id, p, text, coalesce(
        lead(text) OVER (ORDER BY conv_id DESC), first_value(text) OVER (ORDER BY conv_id DESC)
    ) AS other
    FROM placed JOIN lasts USING (conv_id) WHERE p = n
), known AS (
    SELECT l.conv_id, r.text, r.other,
        CASE WHEN n IS NULL THEN size WHEN r.text = r.other THEN n ELSE n - 1 END AS n_common
    FROM lasts l LEFT JOIN replies r ON l.conv_id = r.conv_id
), prompts AS (
    SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || p.text || '<|end|>' || chr(10), '' ORDER BY p) AS prompt
    FROM placed p JOIN known k USING (conv_id) WHERE p <= n_common GROUP BY conv_id
)
SELECT conv_id, n_common, coalesce(prompt, '') AS prompt,
    CASE WHEN text = other THEN '' ELSE '<|assistant|>' || chr(10) || text || '<|end|>' || chr(10) END AS chosen,
    CASE WHEN text = other THEN '' ELSE '<|assistant|>' || chr(10) || other || '<|end|>' || chr(10) END AS rejected,
    CASE WHEN text = other THEN '' ELSE '14:' || (length(text) + 8) END AS chosen_mask,
    CASE WHEN text = other THEN '' ELSE '14:' || (length(other) + 8) END AS rejected_mask
FROM known LEFT JOIN prompts USING (conv_id)
"""
