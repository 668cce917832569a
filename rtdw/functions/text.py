"""Word splitting with built-in expressions only.

Letters and digits form words, lower-cased. A run of Han characters has no
blanks to split at, so it gives its overlapping two-character pieces (a single
character gives itself). A dictionary segmenter would cut Han text elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Word patterns.
WORD = r"[\p{L}\p{N}]+"
HAN = r"\p{IsHan}"
HAN_RUN_OR_WORD = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"

SPLIT_FUNCTION = "split_words"


def _pieces(token: Column) -> Column:
    pairs = F.transform(
        F.sequence(F.lit(1), F.length(token) - 1), lambda at: F.substring(token, at, 2)
    )
    return F.when(token.rlike(HAN) & (F.length(token) > 1), pairs).otherwise(F.array(token))


def words(text: Column | str) -> Column:
    """Array of the words of a text; the Han branch runs only where Han occurs."""
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    plain = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    mixed = F.regexp_extract_all(lowered, F.lit(HAN_RUN_OR_WORD), F.lit(0))
    return F.when(lowered.rlike(HAN), F.flatten(F.transform(mixed, _pieces))).otherwise(plain)


def register_split_function(spark: SparkSession, name: str = SPLIT_FUNCTION) -> None:
    """A SQL table function ``name(text) -> (word)`` for ``LATERAL`` joins.

    It is plain SQL over built-in functions, so it is inlined into the plan and
    no Python worker is involved.
    """
    spark.sql(
        rf"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING)
        RETURNS TABLE (word STRING)
        RETURN SELECT w.word FROM explode(
            CASE WHEN lower(text) RLIKE r'{HAN}' THEN
                flatten(transform(
                    regexp_extract_all(lower(text), r'{HAN_RUN_OR_WORD}', 0),
                    t -> CASE WHEN t RLIKE r'{HAN}' AND length(t) > 1
                         THEN transform(sequence(1, length(t) - 1), i -> substring(t, i, 2))
                         ELSE array(t) END))
            ELSE regexp_extract_all(lower(text), r'{WORD}', 0) END
        ) AS w(word)
        """
    )
