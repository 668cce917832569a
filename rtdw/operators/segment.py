"""Words of Han text, by a dictionary table.

Han text has no blanks. From left to right the longest word of two to ``longest`` characters
that begins where the last one ended is taken; a character without a word stands alone.

A dictionary of up to ``MAX_LISTED`` words goes along as one pattern that cuts the texts, so
nothing is shuffled or stored. A larger one is joined with the pieces of each different run.
Words only compete where they overlap, so there the matches of a run are parted where none of
them crosses, and the choice is a fold over each such group, not over the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.functions.text import HAN, HAN_RUN_OR_WORD
from rtdw.session import fresh_dir

#: Characters of the longest word looked for.
LONGEST = 8

#: Words of a dictionary that may go along as a pattern.
MAX_LISTED = 1_000_000

# Characters that are tried one after another in a pattern; more are halved first.
_TRIED = 6


def _all(text: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(pattern), F.lit(0))


def counted_dictionary(lines: DataFrame, text: str, support: int = 5, longest: int = LONGEST) -> DataFrame:
    """(word): runs of 2 to ``longest`` Han characters that occur at least ``support`` times
    in spaced text."""
    size = F.length("word")
    return (
        lines.select(F.explode(_all(F.lower(text), f"{HAN}+")).alias("word"))
        .where((size >= 2) & (size <= longest))
        .groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= support).select("word")
    )


def matches(runs: DataFrame, dictionary: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(id, at, size): the longest dictionary word that begins at each place of a run.

    ``runs``: id, chars. Places count from 0; those without a word give no row.
    """
    ahead = F.transform("chars", lambda _, i: F.slice("chars", i + 1, F.lit(longest)))
    starts = runs.select("id", F.posexplode(ahead).alias("at", "ahead")).where(F.size("ahead") >= 2)
    pieces = F.transform(
        F.sequence(F.lit(2), F.size("ahead")), lambda n: F.array_join(F.slice("ahead", F.lit(1), n), "")
    )
    return (
        starts.select("id", "at", F.posexplode(pieces).alias("more", "word"))
        .join(dictionary.select("word").distinct(), "word")
        .groupBy("id", "at").agg((F.max("more") + 2).alias("size"))
    )


def chosen(found: DataFrame) -> DataFrame:
    """(id, words): the matches that are taken, as an array of (at, size) in order."""
    ordered = Window.partitionBy("id").orderBy("at")
    before = F.max(F.col("at") + F.col("size")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    free = F.coalesce(F.col("at") >= before, F.lit(True)).cast("int")
    parted = found.withColumn("free", free).withColumn("group", F.sum("free").over(ordered))
    groups = parted.groupBy("id", "group").agg(F.sort_array(F.collect_list(F.struct("at", "size"))).alias("all"))
    taken = F.aggregate(
        "all",
        F.struct(F.lit(0).alias("next"), F.slice("all", 1, 0).alias("words")),
        lambda done, word: F.when(
            word["at"] >= done["next"],
            F.struct(
                (word["at"] + word["size"]).alias("next"),
                F.concat(done["words"], F.array(word)).alias("words"),
            ),
        ).otherwise(done),
        lambda done: done["words"],
    )
    parts = groups.select("id", taken.alias("words"))
    return parts.groupBy("id").agg(F.sort_array(F.flatten(F.collect_list("words"))).alias("words"))


def cut_runs(runs: DataFrame, dictionary: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(run, pieces): each different run with its words in order. ``runs``: run."""
    each = runs.select("run").distinct().select(
        "run", F.sha2("run", 256).alias("id"), _all("run", "(?s).").alias("chars")
    )
    taken = chosen(matches(each.select("id", "chars"), dictionary, longest))
    none = F.array().cast("array<struct<at:int,size:int>>")
    # The run's begin stands as a word of no characters, so that each word has singles after it.
    words = F.concat(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("size"))), F.coalesce("words", none))
    end = F.struct(F.size("chars").alias("at"), F.lit(0).alias("size"))
    following = F.concat(F.slice("all", F.lit(2), F.size("all")), F.array(end))

    def with_singles(word: Column, after: Column) -> Column:
        stop = word["at"] + word["size"]
        whole = F.array_join(F.slice("chars", word["at"] + 1, word["size"]), "")
        singles = F.slice("chars", stop + 1, after["at"] - stop)
        return F.when(word["size"] > 0, F.concat(F.array(whole), singles)).otherwise(singles)

    return (
        each.join(taken, "id", "left").withColumn("all", words)
        .select("run", F.flatten(F.zip_with("all", following, with_singles)).alias("pieces"))
    )


def listed_words(dictionary: DataFrame, longest: int = LONGEST, limit: int = MAX_LISTED) -> list[str] | None:
    """The words that can occur in a run, in order; None if they are more than ``limit``."""
    size = F.length("word")
    usable = dictionary.select("word").where(
        (size >= 2) & (size <= longest) & F.col("word").rlike(f"^{HAN}+$")
    ).distinct()
    path = fresh_dir(dictionary.sparkSession, "dictionary")
    usable.write.parquet(path)
    words = dictionary.sparkSession.read.schema("word string").parquet(path)
    if words.count() > limit:
        return None
    return sorted(row["word"] for row in words.toLocalIterator())


def listed_pattern(words: list[str]) -> str:
    """A pattern that matches the longest of the words, which are in order and different.

    Words that begin alike share that part of the pattern, so each character of a text is
    compared with those that may follow, not with the words.
    """

    def choice(branches: list[tuple[str, str]]) -> str:
        if len(branches) <= _TRIED:
            return "|".join(branch for _, branch in branches)
        half = len(branches) // 2
        span = f"[{branches[0][0]}-{branches[half - 1][0]}]"
        return f"(?={span})(?:{choice(branches[:half])})|{choice(branches[half:])}"

    def endings(begin: int, end: int, depth: int) -> str:
        branches = []
        while begin < end:
            first, stop = words[begin][depth], begin
            while stop < end and words[stop][depth] == first:
                stop += 1
            is_word = len(words[begin]) == depth + 1
            rest = endings(begin + is_word, stop, depth + 1)
            branches.append((first, f"{first}(?:{rest})?" if is_word and rest else f"{first}(?:{rest})" if rest else first))
            begin = stop
        return choice(branches)

    return endings(0, len(words), 0)


def dictionary_words(
    lines: DataFrame, text: str, dictionary: DataFrame, longest: int = LONGEST, max_listed: int = MAX_LISTED
) -> DataFrame:
    """The columns of the lines with ``word``, a row for each word of the text, lower-cased.

    Letters and digits of other scripts form words as in ``functions.text.words``. A text
    without words, or a null one, gives no row. ``dictionary``: word; words of one character
    or more than ``longest`` play no part. It is written to a table and counted: up to
    ``max_listed`` words cut the texts where they are, more are joined.
    """
    listed = listed_words(dictionary, longest, max_listed)
    if listed is not None:
        token = "|".join(filter(None, [listed_pattern(listed), HAN, HAN_RUN_OR_WORD]))
        return lines.select("*", F.explode(_all(F.lower(text), token)).alias("word"))
    tokens = lines.select("*", F.explode(_all(F.lower(text), HAN_RUN_OR_WORD)).alias("__token"))
    is_run = F.col("__token").rlike(HAN)
    runs = tokens.where(is_run).select(F.col("__token").alias("run"))
    pieces = cut_runs(runs, dictionary, longest).select(
        F.col("run").alias("__token"), F.col("pieces").alias("__pieces")
    )
    # A run that very many lines hold is one row on the right side, so its lines can be split.
    return tokens.join(pieces, "__token", "left").select(
        *(tokens[c] for c in lines.columns),
        F.explode(F.coalesce("__pieces", F.array("__token"))).alias("word"),
    )
