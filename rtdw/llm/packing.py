"""Best-fit packing of tokenized documents by bin completion with branch and bound.

How pieces can be packed depends on their lengths only, and there are at most as many
lengths as a sequence has tokens. So Spark counts the pieces of each length, a plan is
made from these counts, and Spark deals the pieces to the places of the plan. The counts,
the plan's patterns and the work on them are bounded by the capacity, whatever the number
of documents.

The plan is made by bin completion. Best-fit decreasing gives the first plan, the incumbent.
The largest length left opens a sequence, and its undominated fillings are enumerated,
those of least waste first: sets of other lengths that fit beside it, none of which can be
exchanged for a larger one. A filling is applied as often as the counts allow, or once, and
the search goes on with what is left. A branch is pruned if the tokens left, packed without
waste, cannot beat the incumbent; a plan as short as the lower bound ends the search, as
does a number of sequences tried.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.tables import extended, stored, table
from rtdw.llm.words import LOWER, Texts, kept, lean, mixed, pieces, prefix_sums, ranges, release, texts_of

CAPACITY = 2048
END = 0
#: Sequences tried after the first whole plan before the best plan so far is taken.
NODES = 2000
#: Chunks whose ids a worker remembers, and the bytes of the longest of them.
CACHED_CHUNKS = 1_500_000
CHUNK_BYTES = 64
ROWS_PER_TASK = 100_000
#: Words that the tokenizer neither changes nor splits before it looks for tokens.
PLAIN_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of each chunk of lowered texts.

    Chunks end at blanks, at line ends and between an ASCII letter and an ASCII sign: the
    tokenizer joins nothing across these.
    """
    blank = np.ones(len(data) + 1, bool)
    blank[:-1] = (data == 0x20) | (data == 0x0A)
    before = np.ones(len(data) + 1, bool)
    before[1:] = blank[:-1]
    letter, sign = (data >= 0x61) & (data <= 0x7A), IS_SIGN[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = letter[:-1] & sign[1:]
    cut[offsets[1:-1]] = True  # where one text ends and the next begins
    begins = np.flatnonzero(~blank & (before | cut))
    ends = np.flatnonzero(~before & (blank | cut))
    return begins, ends, np.searchsorted(offsets, begins, "right") - 1


def _signs() -> np.ndarray:
    signs = np.zeros(256, bool)
    for low, high in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
        signs[low : high + 1] = True
    return signs


IS_SIGN = _signs()


class Encoder:
    """Token ids of whole texts.

    The tokenizer lowers letters, drops white space, and marks the last token of a word. A
    text is encoded by its chunks, each different one once: their hashes are looked up in a
    sorted array, and the ids of all chunks are gathered at once. The chunks that were met
    least recently are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)  # one vocabulary for both
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[at for token, at in vocabulary.items() if token.endswith("</w>")]] = True
        self.hashes, self.first = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.count, self.met = np.empty(0, np.int32), np.empty(0, np.int32)
        self.ids, self.turn = np.empty(0, np.uint32), 0
        release()  # what the vocabulary's text took

    def plain_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain words and how many each has: a word ends where a token ends one."""
        out = [
            np.array(self.plain.encode(" ".join(words[at : at + 256]), add_special_tokens=False).ids, np.uint32)
            for at in range(0, len(words), 256)
        ]
        ids = np.concatenate(out) if out else np.empty(0, np.uint32)
        return ids, np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)

    def other_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any chunks, told apart by where their tokens begin."""
        out, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(chunks), 256):
            part = chunks[at : at + 256]
            begins = np.cumsum([0, *(len(chunk) + 1 for chunk in part)])
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            places = np.array([begin for begin, _ in found.offsets], np.int64)
            out.append(np.array(found.ids, np.uint32))
            counts.append(np.diff(np.searchsorted(places, begins)))
        return np.concatenate(out), np.concatenate(counts)

    def learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        """Add new chunks with their ids; hashes are ascending."""
        words = [chunk.decode() for chunk in chunks]
        plain = np.array([bool(PLAIN_WORD.fullmatch(word)) for word in words], bool)
        ids, counts = self.plain_ids([w for w, own in zip(words, plain, strict=True) if own])
        more, rest = self.other_ids([w for w, own in zip(words, plain, strict=True) if not own])
        count = np.empty(len(words), np.int32)
        count[plain], count[~plain] = counts, rest
        first = np.empty(len(words), np.int64)
        first[plain] = len(self.ids) + np.cumsum(counts) - counts
        first[~plain] = len(self.ids) + len(ids) + np.cumsum(rest) - rest
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.first = np.insert(self.hashes, at, hashes), np.insert(self.first, at, first)
        self.count, self.met = np.insert(self.count, at, count), np.insert(self.met, at, self.turn)
        self.ids = np.concatenate([self.ids, ids, more])

    def forget(self) -> None:
        """Keep the chunks of the last turns, at most half of what may be remembered."""
        for age in (16, 4, 1, 0):
            kept_ = self.met >= self.turn - age
            if np.count_nonzero(kept_) <= CACHED_CHUNKS // 2:
                break
        else:
            kept_ = np.zeros(len(self.met), bool)
        self.ids = self.ids[ranges(self.first[kept_], self.count[kept_])]
        self.hashes, self.count, self.met = self.hashes[kept_], self.count[kept_], self.met[kept_]
        self.first = np.cumsum(self.count, dtype=np.int64) - self.count

    def encode(self, texts: Texts | list[str]) -> list[np.ndarray]:
        """The ids of each text, ended by ``END``."""
        if not isinstance(texts, Texts):
            texts = texts_of(pa.array(texts, pa.string()))
        self.turn += 1
        data, offsets = LOWER[texts.data], texts.offsets
        begins, ends, text = chunks_of(data, offsets)
        special = np.zeros(len(offsets) - 1, bool)  # special tokens differ by case
        special[np.searchsorted(offsets, np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)), "right") - 1] = True
        alone = ends - begins > CHUNK_BYTES  # these seldom come back
        usual = ~special[text]
        begins, ends, text, alone = begins[usual], ends[usual], text[usual], alone[usual]
        sums, inverse = prefix_sums(data)
        keys = mixed((sums[ends] - sums[begins]) * inverse[begins])
        different, one, which = np.unique(keys, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, different), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == different if len(self.hashes) else np.zeros(len(different), bool)
        self.met[at[known]] = self.turn
        new = np.flatnonzero(~known)
        whole = data.tobytes()
        self.learn(different[new], [whole[begins[i] : ends[i]] for i in one[new].tolist()])
        at = np.searchsorted(self.hashes, different)[which]
        ids = self.ids[ranges(self.first[at], self.count[at])]
        own = np.bincount(text, self.count[at], len(offsets) - 1).astype(np.int64)
        last = np.cumsum(own + 1)
        out = np.full(int(last[-1]) if len(last) else 0, END, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(own)), own)] = ids
        found = np.split(out, last[:-1])
        for i in np.flatnonzero(special).tolist():
            raw = texts.data[offsets[i] : offsets[i + 1]].tobytes().decode()
            found[i] = np.array([*self.tokenizer.encode(raw, add_special_tokens=False).ids, END], np.uint32)
        if np.any(alone):
            self.met[at[alone]] = -(1 << 30)
        if len(self.hashes) > CACHED_CHUNKS:
            self.forget()
        return found


def token_pieces(docs: DataFrame, keep: list[str], vocabulary: str, text: str = "text",
                 capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """The documents' pieces: kept columns, piece, start, length, ids_crc32, and ids if asked.

    A document's ids are those of its whole text and ``END``; only longer ones than the
    capacity are cut. A null text is an empty one, whose only id is ``END``.
    """
    more = "piece int, start long, length long, ids_crc32 long"
    schema = extended(docs.select(*keep).schema, more + ", ids array<int>" * ids)

    owner = f"encoder {vocabulary}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(owner, lambda: Encoder(vocabulary))
        for batch in batches:
            for rows, texts in pieces(batch, "__text", owner=owner):
                at, out = [], []
                for i, got in enumerate(own.encode(texts)):
                    for piece, start in enumerate(range(0, len(got), capacity)):
                        part = got[start : start + capacity]
                        at.append(i)
                        out.append((piece, start, len(part), zlib.crc32(part), part))
                columns = list(zip(*out, strict=True))
                values = [
                    pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:4])
                ]
                if ids:
                    values.append(pa.array([p.astype(np.int32) for p in columns[4]], pa.list_(pa.int32())))
                own_rows = rows.select(keep).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*own_rows.columns, *values], schema.names)

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(lean(cut, owner), schema)


def best_fit(space: int, lengths: list[int], counts: dict[int, int]) -> list[int]:
    """The largest length that fits, again and again."""
    used: list[int] = []
    at = bisect_right(lengths, space)
    while at:
        length = lengths[at - 1]
        take = min(counts[length], space // length)
        used += [length] * take
        space -= take * length
        at = min(at - 1, bisect_right(lengths, space))
    return used


def fillings(space: int, lengths: list[int], counts: dict[int, int]) -> Iterator[list[int]]:
    """All undominated fillings of the space, those of least waste and larger lengths first.

    ``lengths`` is ascending, ``counts`` says how many there are of each. Which sums the
    lengths up to each can make is kept as bits, so no branch is entered that leads nowhere.
    A filling is dominated if one of its lengths can be exchanged for a larger one left over.
    """
    lengths = [x for x in lengths[: bisect_right(lengths, space)] if counts[x]]
    within = (1 << space + 1) - 1
    sums = [1]
    for length in lengths:
        now, left, step = sums[-1], min(counts[length], space // length), 1
        while left:
            take = min(step, left)
            now |= now << take * length & within
            left, step = left - take, 2 * step
        sums.append(now)
    for total in range(space, -1, -1):
        if not sums[-1] >> total & 1:
            continue
        waiting = [(len(lengths), total, ())]
        while waiting:
            at, left, used = waiting.pop()
            while at and left and sums[at - 1] >> left & 1 and lengths[at - 1] > left:
                at -= 1
            if not left:
                own, spare = Counter(dict(used)), space - total
                if not any(
                    (to := bisect_right(lengths, x + spare)) and lengths[to - 1] > x
                    and counts[lengths[to - 1]] > own[lengths[to - 1]] for x in own
                ):
                    yield [x for x, n in used for _ in range(n)]
                continue
            length, most = lengths[at - 1], min(counts[lengths[at - 1]], left // lengths[at - 1])
            for take in range(most + 1):  # the most is put on the stack last, and tried first
                if sums[at - 1] >> left - take * length & 1:
                    waiting.append((at - 1, left - take * length, (*used, (length, take)) if take else used))


def best_filling(space: int, lengths: list[int], counts: dict[int, int]) -> list[int]:
    """The lengths that fill the space with the least waste, larger ones first."""
    used = best_fit(space, lengths, counts)
    return used if sum(used) == space else next(fillings(space, lengths, counts))


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A bound that no plan can go below: lengths over half the capacity need a sequence each,
    and lengths from a least one on fit only into what those leave that have room for it.
    """
    number, tokens = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        number[length + 1], tokens[length + 1] = n, n * length
    number, tokens = np.cumsum(number), np.cumsum(tokens)  # of lengths below
    half, all_ = capacity // 2 + 1, capacity + 1
    least = np.arange(half)
    roomy = capacity - least + 1  # lengths from here on leave no room
    alone, shared = number[all_] - number[roomy], number[roomy] - number[half]
    room = shared * capacity - (tokens[roomy] - tokens[half])
    rest = np.maximum(tokens[half] - tokens[least] - room, 0)
    return int((alone + shared + -(-rest // capacity)).max())


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """The plan of best-fit decreasing; equal lengths go into equal sequences at once."""
    open_: dict[int, list[list]] = {}  # by space left: patterns and how many sequences
    spaces: list[int] = []

    def add(space: int, pattern: list[int], times: int) -> None:
        if space not in open_:
            insort(spaces, space)
        open_.setdefault(space, []).append([pattern, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                each = min(capacity // length, left)
                add(capacity - each * length, [length] * each, left // each)
                left %= each
                continue
            space = spaces[at]
            pattern, times = open_[space].pop()
            if not open_[space]:
                del open_[space], spaces[at]
            each = min(space // length, left)
            filled = min(times, left // each)
            add(space - each * length, pattern + [length] * each, filled)
            if times > filled:
                add(space, pattern, times - filled)
            left -= each * filled
    return [(pattern, times) for parts in open_.values() for pattern, times in parts]


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY,
                 nodes: int = NODES) -> list[tuple[list[int], int]]:
    """Patterns (lengths of a sequence, longest first) and how many sequences have each."""
    left = {length: n for length, n in counts.items() if n}
    best = best_fit_decreasing(left, capacity)
    least, fewest = least_sequences(left, capacity), sum(times for _, times in best)
    lengths, tokens = sorted(left), sum(length * n for length, n in left.items())
    plan: list[tuple[list[int], int]] = []
    used = 0

    def choices() -> Iterator[tuple[list[int], int]]:
        """Patterns that the largest length left can open; each as often as it goes, then once."""
        largest, space = lengths[-1], capacity - lengths[-1]
        left[largest] -= 1
        first = best_filling(space, lengths, left)
        left[largest] += 1
        yield from often(largest, first)
        # Only what the search comes back to keeps its sums.
        for filling in fillings(space, list(lengths), {**left, largest: left[largest] - 1}):
            if filling != first:
                yield from often(largest, filling)

    def often(largest: int, filling: list[int]) -> Iterator[tuple[list[int], int]]:
        pattern = sorted([largest, *filling], reverse=True)
        times = min(left[x] // n for x, n in Counter(pattern).items())
        yield pattern, times
        if times > 1:
            yield pattern, 1

    def apply(pattern: list[int], times: int) -> None:
        for x, n in Counter(pattern).items():
            before = left[x]
            left[x] -= n * times
            if before > 0 >= left[x]:
                del lengths[bisect_left(lengths, x)]
            elif before <= 0 < left[x]:
                insort(lengths, x)

    waiting = [choices()] if lengths else []
    budget = None  # the first way down is not counted
    while waiting and fewest > least and (budget is None or budget > 0):
        step = next(waiting[-1], None)
        if step is None:
            waiting.pop()
            if plan:
                pattern, times = plan.pop()
                apply(pattern, -times)
                used, tokens = used - times, tokens + times * sum(pattern)
            continue
        pattern, times = step
        apply(pattern, times)
        plan.append(step)
        used, tokens = used + times, tokens - times * sum(pattern)
        budget = budget and budget - 1
        if not lengths and used < fewest:
            best, fewest = list(plan), used
        if lengths and (budget is None or used - (-tokens // capacity) < fewest):
            waiting.append(choices())
            continue
        budget = nodes if budget is None else budget
        plan.pop()
        apply(pattern, -times)
        used, tokens = used - times, tokens + times * sum(pattern)
    return best


def pack(cut: DataFrame, tie: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: their places in as few sequences as found.

    ``tie`` names columns that tell pieces of one length apart; pieces equal in all of them
    take each other's places.
    """
    spark = cut.sparkSession
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    places, taken, sequence = [], dict.fromkeys(counts, 0), 0
    for pattern, times in plan_packing(counts, capacity):
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            places.append((length, taken[length], taken[length] + each * times, each, sequence, offset))
            taken[length] += each * times
            offset += each * length
        sequence += times
    # At most a few thousand lengths and patterns, whatever the number of pieces.
    plan = spark.createDataFrame(
        places, "length long, first long, last long, each long, sequence long, begin long"
    )
    salts = F.broadcast(spark.createDataFrame(
        [(length, -(-n // ROWS_PER_TASK)) for length, n in counts.items()], "length long, salts long"
    ))
    salted = cut.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64(*tie), "salts")).drop("salts")
    groups = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("length", "salt").orderBy(*tie)
    ranked = salted.withColumn("rank", F.row_number().over(order)).join(groups, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("rank") - 1).drop("before", "salt")
    placed = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "of")),
        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
    )
    nth = F.col("rank") - F.col("first")
    return placed.withColumns({
        "sequence_id": F.col("sequence") + F.floor(nth / F.col("each")),
        "offset": F.col("begin") + nth % F.col("each") * F.col("length"),
    }).drop("rank", "of", "first", "last", "each", "sequence", "begin")


def packed_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Every document's pieces and their places, as ``op7_packing`` returns them."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    cut = stored(token_pieces(docs, ["doc_id"], vocabulary), "token-pieces")
    tie = ["doc_id", "piece", "start", "ids_crc32"]
    return pack(cut, tie).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens.

    An empty table gives no rows; repeated rows are packed each by itself, as are rows
    without an id.
    """
    return packed_documents(table(spark, sf_dir, "documents"))


def packed_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: all that is left, packed."""
    return packed_documents(docs)
