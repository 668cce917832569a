"""Document fingerprints: SimHash, and permuted block tables to find near ones.

Everything here is column expressions. A text's terms are its different words and its
different pairs of neighbouring words. Each term votes with its weight on every bit of the
fingerprint: for 1 where its own hash has a 1, else for 0. Two counters share a long, so a
64-bit part of the fingerprint takes 32 sums; Spark sums them per task before it shuffles.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.order import with_next
from rtdw.llm.tables import stored, table, text_key

PARTS = 2
BITS = 64 * PARTS
RADIUS = 3
#: Weight of a pair of words; a word's own is its length, at most 8.
PAIR_WEIGHT = 8
LANES = (1 << 32) | 1


def terms(text: Column) -> Column:
    """A whole text's terms as longs: a hash, whose last four bits are the term's weight.

    The last entry is 0, a term of no weight, so that texts without words are not lost.
    """
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    clear = F.lit(-16)
    single = F.transform(
        F.array_distinct(words),
        lambda w: F.xxhash64(w).bitwiseAND(clear).bitwiseOR(F.least(F.length(w), F.lit(8)).cast("long")),
    )
    pairs = F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
        lambda a, b: F.xxhash64(a, F.coalesce(b, F.lit(""))).bitwiseAND(clear).bitwiseOR(F.lit(PAIR_WEIGHT).cast("long")),
    )
    return F.concat(single, F.array_distinct(pairs), F.array(F.lit(0).cast("long")))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Keys, ``copies`` (rows with these keys) and ``part0``, ``part1``, ...: the fingerprint.

    Rows with equal keys must have equal texts. A null text is an empty one; texts without
    words have an all-zero fingerprint.
    """
    rows = texts.select(*keys, F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("term"))
    weight = F.col("term").bitwiseAND(F.lit(15))
    rows = rows.select(
        *keys, "term", weight.alias("weight"),
        *(F.xxhash64("term", F.lit(p)).alias(f"hash{p}") for p in range(PARTS)),
    )
    lane = lambda p, i: F.sum(
        F.shiftrightunsigned(f"hash{p}", i).bitwiseAND(F.lit(LANES)) * F.col("weight")
    ).alias(f"votes{p}_{i}")
    voted = rows.groupBy(*keys).agg(
        F.sum("weight").alias("all"), F.sum((F.col("term") == 0).cast("long")).alias("copies"),
        *(lane(p, i) for p in range(PARTS) for i in range(32)),
    )

    def part(p: int) -> Column:
        bits = []
        for i in range(32):
            votes = F.col(f"votes{p}_{i}")
            for at, own in ((i, votes.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(votes, 32))):
                value = (1 << at) - (1 << 64 if at == 63 else 0)
                bits.append(F.when(own * 2 > F.col("all"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
        while len(bits) > 1:
            bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
        return bits[0].alias(f"part{p}")

    return voted.select(*keys, "copies", *(part(p) for p in range(PARTS)))


def distance(a: str, b: str) -> Column:
    """Bits in which two fingerprints differ, whose parts begin with these prefixes."""
    out = F.lit(0)
    for p in range(PARTS):
        out = out + F.bit_count(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}")))
    return out


def as_text(prefix: str) -> Column:
    """A fingerprint as lowercase hexadecimal digits."""
    return F.concat(*(F.lower(F.lpad(F.hex(f"{prefix}{p}"), 16, "0")) for p in range(PARTS)))


def within_radius(asked: DataFrame, stored_prints: DataFrame, radius: int = RADIUS,
                  blocks: int | None = None) -> DataFrame:
    """All pairs of an asked and a stored fingerprint that differ in at most ``radius`` bits.

    The bits are cut into ``blocks`` (``radius`` + 1 by default). In each table as many of
    them as can all be free of differences come first and are the key; near fingerprints
    share the key of at least one table, and a pair is taken from the first such table only.
    Both frames have ``part0``, ``part1``, ...; give each fingerprint once. The asked parts
    are returned as they are, the others as ``near0``, ``near1``, ... with ``distance``.
    """
    blocks = blocks or radius + 1
    tables = list(combinations(range(blocks), blocks - radius))
    edges = [BITS * i // blocks for i in range(blocks + 1)]

    def block(prefix: str, b: int) -> Column:
        values = []
        for p in range(PARTS):
            low, high = max(edges[b], 64 * p) - 64 * p, min(edges[b + 1], 64 * p + 64) - 64 * p
            if low < high:
                mask = ((1 << (high - low)) - 1) << low
                mask -= 1 << 64 if mask >> 63 else 0
                values.append(F.col(f"{prefix}{p}").bitwiseAND(F.lit(mask)))
        return F.xxhash64(*values)

    def dealt(df: DataFrame, prefix: str) -> DataFrame:
        keys = F.array(*(F.xxhash64(*(block(prefix, b) for b in t)) for t in tables))
        return df.select("*", F.posexplode(keys).alias("table", "key"))

    near = stored_prints.select(
        *(c for c in stored_prints.columns if not c.startswith("part")),
        *(F.col(f"part{p}").alias(f"near{p}") for p in range(PARTS)),
    )
    pairs = dealt(asked, "part").join(dealt(near, "near"), ["table", "key"])
    earlier = F.lit(False)
    for i, t in enumerate(tables[:-1]):
        same = F.lit(True)
        for b in t:
            same = same & (block("part", b) == block("near", b))
        earlier = earlier | (same & (F.col("table") > i))
    apart = distance("part", "near")
    return pairs.filter((apart <= radius) & ~earlier).withColumn("distance", apart).drop("table", "key")


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are.

    ``n_within``, for documents whose id is divisible by 20, counts the other documents
    with a fingerprint within the radius. Rows with equal ids follow each other by text.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", text_key())
    following = with_next(
        docs, "doc_id", F.col("text_key"),
        {"text": "next_text", "doc_id": "next_id", "text_key": "next_key"},
    )
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", 1, size - third), F.substring("next_text", 1, third))
    rows = following.select(
        "doc_id", "text_key", "next_id", "next_key", size.cast("long").alias("n_chars"),
        F.explode(F.array(F.struct(F.lit(False).alias("edited"), F.col("text")),
                          F.struct(F.lit(True).alias("edited"), edited.alias("text")))).alias("one"),
    ).select("doc_id", "text_key", "next_id", "next_key", "n_chars", "one.*").withColumn(
        "sha256", F.when(F.col("edited"), F.sha2("text", 256))
    )
    keys = ["doc_id", "text_key", "next_id", "next_key", "n_chars", "edited", "sha256"]
    prints = stored(fingerprints(rows, keys), "fingerprints")
    parts = [f"part{p}" for p in range(PARTS)]
    plain = prints.filter("not edited").drop("sha256", "edited")
    changed = prints.filter("edited").select(
        *(F.col(c).alias(f"c_{c}") for c in keys[:4]), F.col("sha256").alias("edited_sha256"),
        *(F.col(f"part{p}").alias(f"edited{p}") for p in range(PARTS)),
    )
    after = plain.select(
        F.col("doc_id").alias("n_id"), F.col("text_key").alias("n_key"),
        *(F.col(f"part{p}").alias(f"next{p}") for p in range(PARTS)),
    ).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in keys[:4]]
    follows = [F.col("next_id").eqNullSafe(F.col("n_id")), F.col("next_key") == F.col("n_key")]
    every = plain.groupBy(*parts).agg(F.sum("copies").alias("n"))
    asked = plain.filter("doc_id % 20 = 0").select(*parts).distinct()
    found = within_radius(asked, every).groupBy(*parts).agg((F.sum("n") - 1).alias("n_within"))
    return (
        plain.join(changed, same).join(after, follows).join(found, parts, "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            "doc_id", "n_chars", "edited_sha256",
            as_text("part").alias("fingerprint"), as_text("edited").alias("edited_fingerprint"),
            (1 - distance("part", "edited") / F.lit(float(BITS))).alias("near_edited"),
            (1 - distance("part", "next") / F.lit(float(BITS))).alias("near_next"),
            F.when(F.col("doc_id") % 20 == 0, F.col("n_within")).alias("n_within"),
        )
    )
