"""Toxicity: misspelled lexicon terms by Levenshtein automata on a trie, scored in context.

The lexicon is learned from labelled documents: words, or beginnings of words, that occur
almost only in toxic ones, chosen greedily until they cover what can be covered. A trie
holds them. Their Levenshtein automaton, intersected with the trie, reads a word of the
text letter by letter and follows all entries at once that can still be near enough.

A window of words around a match decides whether it is quoted (quotation marks or words
of reporting nearby) or meant. A regression on how many matches of each kind a text has,
and how dense they are, gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.logistic import bounded_sample, fit_logistic, margin, probability
from rtdw.llm.tables import extended, stored, table

#: Labelled documents that the model is fitted on, at most about this many.
MAX_LABELLED = 40_000
#: Beginnings of words that may become entries, by length; shorter words count as a whole.
STEMS = range(4, 9)
#: Words to each side of a match that are looked at.
WINDOW = 6
#: Words without a match that a worker remembers.
CACHED_WORDS = 400_000

# Words and marks that report speech.
REPORTING = frozenset(
    "said says say quote quoted quotes called calls wrote writes word term meaning "
    "sagt sagte schrieb nannte wort zitat dit disait appelle mot citation écrit "
    "dijo dice llamó palabra cita escribió".split()
)
MARKS = re.compile("[\"“”„«»‹›‘’]")

TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»‹›‘’]")
MATCHES = ["meant_exact", "meant_near", "quoted_exact", "quoted_near"]
FEATURES = [*MATCHES, "density"]


def edits_allowed(length: int) -> int:
    """Edits at which an entry of so many letters still counts as meant."""
    return 0 if length < 5 else 1 if length < 9 else 2


class LexiconAutomaton:
    """The Levenshtein automaton of all entries at once, on their trie.

    A position is (trie node, edits so far, letter owed by a swap). A state is the set of
    positions that a word's letters can lead to, and the fewest edits of a stem already
    passed. States and their transitions are made when a word first needs them, so that
    later words only follow links. A position whose edits pass the bounds of all entries
    below it is dropped; without positions left, the rest of a word is not read.
    """

    MOST_STATES = 100_000

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word, self.stem, self.below = [-1], [-1], [-1]
        for entry, ends in [*((w, self.word) for w in words), *((s, self.stem) for s in stems)]:
            node, bound = 0, edits_allowed(len(entry))
            self.below[0] = max(self.below[0], bound)
            for letter in entry:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    for column in (self.word, self.stem, self.below):
                        column.append(-1)
                node = self.children[node][letter]
                self.below[node] = max(self.below[node], bound)
            ends[node] = bound
        self.letters = {letter for links in self.children for letter in links}
        self._clear()

    def _clear(self) -> None:
        self.ids: dict = {}
        self.states: list = []
        self.links: list[dict[str, int]] = []
        self.accepts: list[int] = []
        self.start = self._state({(0, 0, "")}, -1)

    def _state(self, positions: set[tuple[int, int, str]], passed: int) -> int:
        waiting, kept = list(positions), set()
        while waiting:  # letters of an entry that the word leaves out
            node, edits, owed = place = waiting.pop()
            if edits > self.below[node] or place in kept:
                continue
            kept.add(place)
            if not owed:
                waiting.extend((child, edits + 1, "") for child in self.children[node].values())
        complete = [(node, edits) for node, edits, owed in kept if not owed]
        for node, edits in complete:
            if edits <= self.stem[node] and (passed < 0 or edits < passed):
                passed = edits
        key = (frozenset(kept), passed)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            ends = [edits for node, edits in complete if edits <= self.word[node]]
            self.states.append(key)
            self.links.append({})
            self.accepts.append(min([*ends, *([passed] if passed >= 0 else [])], default=-1))
        return self.ids[key]

    def _follow(self, state: int, letter: str) -> int:
        positions, passed = self.states[state]
        after = set()
        for node, edits, owed in positions:
            if owed:
                if letter == owed:
                    after.add((node, edits, ""))
                continue
            after.add((node, edits + 1, ""))
            for own, child in self.children[node].items():
                after.add((child, edits + (own != letter), ""))
                swapped = self.children[child].get(letter)
                if swapped is not None and own != letter:
                    after.add((swapped, edits + 1, own))
        target = self._state(after, passed)
        if not self.states[target][0]:  # the rest of the word cannot matter
            target = -2 - self.accepts[target]
        self.links[state][letter] = target
        return target

    def near(self, word: str) -> int:
        """Edits from the word to the nearest entry within that entry's bound, or -1."""
        if len(self.states) > self.MOST_STATES:
            self._clear()
        state, links = self.start, self.links
        for letter in word:
            target = links[state].get(letter)
            if target is None:
                target = self._follow(state, letter)
            if target < 0:
                return -2 - target
            state = target
        return self.accepts[state]


class Finder:
    """Finds terms in texts and remembers the words it has looked up."""

    def __init__(self, words: list[str], stems: list[str]):
        self.automaton = LexiconAutomaton(words, stems)
        self.innocent: set[str] = set()
        self.guilty: dict[str, int] = {}

    def terms(self, words: set[str]) -> dict[str, int]:
        """The words near an entry, with their edits."""
        for word in words - self.innocent - self.guilty.keys():
            edits = self.automaton.near(word) if len(word) > 2 else -1
            if edits < 0:
                self.innocent.add(word)
            else:
                self.guilty[word] = edits
        found = {word: self.guilty[word] for word in words & self.guilty.keys()}
        if len(self.innocent) > CACHED_WORDS:
            self.innocent.clear()
        return found

    def matches(self, text: str) -> list[tuple[int, int, int, bool]]:
        """(begin, end, edits, quoted) of each term in a text."""
        folded = text.lower()
        if len(folded) != len(text):  # positions must stay those of the text
            folded = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        terms = self.terms(set(TOKEN.findall(folded)))
        if not terms:
            return []
        places = list(TOKEN.finditer(folded))
        tokens = [place.group() for place in places]
        found = []
        for at, word in enumerate(tokens):
            if word in terms:
                left = tokens[max(0, at - WINDOW) : at]
                right = tokens[at + 1 : at + 1 + WINDOW]
                quoted = any(map(MARKS.match, left)) and any(map(MARKS.match, right))
                quoted = quoted or not REPORTING.isdisjoint(left)
                found.append((*places[at].span(), terms[word], quoted))
        return found


def match_statistics(docs: DataFrame, keep: list[str], words: list[str], stems: list[str],
                     text: str = "text") -> DataFrame:
    """The kept columns and, of each whole text, log counts of matches by kind and density."""
    more = ", ".join(f"{name} double" for name in FEATURES)
    schema = extended(docs.select(*keep).schema, more)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(words, stems)
        for batch in batches:
            rows = np.zeros((len(batch), len(FEATURES)))
            for i, value in enumerate(batch.column("__text")):
                whole = value.as_py() or ""
                found = finder.matches(whole)
                for _, _, edits, quoted in found:
                    rows[i, 2 * quoted + (edits > 0)] += 1
                rows[i, -1] = 100 * len(found) / (len(whole) + 100)
            rows[:, :4] = np.log1p(rows[:, :4])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(c) for c in rows.T)], schema.names
            )

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(scan, schema)


def terms_of(text: str) -> set[str]:
    """A text's words (ending in a blank) and their beginnings."""
    out = set()
    for word in {w.lower() for w in re.findall(r"[^\W\d_]+", text)}:
        if len(word) >= 3:
            out.add(word + " ")
        out.update(word[:n] for n in STEMS if len(word) >= n)
    return out


def choose_entries(texts: dict[str, set[int]], toxic: int, share: float, support: int) -> list[str]:
    """Entries among candidate terms, given the toxic texts that each occurs in.

    First those that add at least ``support`` texts to what is covered, the most adding
    first; then those that occur in more toxic texts, and no clean ones, than chance would
    give any of the candidates. Of terms where one begins with the other, the second is
    taken only if it adds texts to the first.
    """
    order = lambda t: (len(texts[t]), t.endswith(" "), len(t), t)
    chosen, left, rest = [], set(range(toxic)), dict(texts)
    while rest:
        best = max(rest, key=lambda t: (len(rest[t]), t.endswith(" "), len(t), t))
        gained = rest.pop(best)
        if len(gained) < support:
            break
        chosen.append(best)
        left -= gained
        rest = {t: more for t, have in rest.items() if (more := have & left)}
    sure = np.log(0.01 / 1e6) / np.log(min(max(share, 1e-6), 0.9))
    for term in sorted(texts.keys() - set(chosen), key=order, reverse=True):
        if len(texts[term]) < sure:
            break
        own = term.strip()
        related = [t for t in chosen if own.startswith(t.strip()) or t.strip().startswith(own)]
        if len(texts[term].difference(*(texts[t] for t in related))) >= support:
            chosen.append(term)
    return chosen


def learn_lexicon(labelled: DataFrame, text: str = "text", label: str = "toxic",
                  support: int = 3, purity: float = 0.95) -> tuple[list[str], list[str]]:
    """Words and stems that occur in at least ``support`` toxic texts and, of all texts that
    they occur in, almost only in those. Texts of the same words in the same order count as
    one; all others, near copies too, count each.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for frame in frames:
            for value, y in zip(frame["text"], frame["label"], strict=True):
                (toxic if y else clean).update(terms_of(value))
        if terms := sorted(toxic.keys() | clean.keys()):
            yield pd.DataFrame({
                "term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms],
            })

    same = F.sha2(F.concat_ws(" ", F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")), 256)
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), same.alias("words"))
    rows = stored(rows.dropDuplicates(["words", "label"]), "toxic-labelled")
    counted = (
        rows.mapInPandas(count, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= support) & (F.col("toxic") >= purity * (F.col("toxic") + F.col("clean"))))
    )
    candidates = {row["term"] for row in counted.collect()}  # bounded by the sample

    def present(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in filter(len, frames):
            yield pd.DataFrame({"terms": [sorted(terms_of(x) & candidates) for x in frame["text"]]})

    toxic = rows.filter("label = 1").mapInPandas(present, "terms array<string>").collect()
    texts: dict[str, set[int]] = {}
    for i, row in enumerate(toxic):
        for term in row["terms"]:
            texts.setdefault(term, set()).add(i)
    chosen = choose_entries(texts, len(toxic), len(toxic) / max(rows.count(), 1), support)
    return (
        [term.strip() for term in chosen if term.endswith(" ")],
        [term for term in chosen if not term.endswith(" ")],
    )


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str], key: str = "doc_id",
             text: str = "text", label: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The kept columns with ``score`` (0 to 1), ``predicted`` and the match statistics.

    ``labels`` holds keys of documents with labels 0 or 1; of several labels half must say
    1. Only texts are looked at. A null text is an empty one. Without toxic examples, or
    without others, every score is the smoothed rate.
    """
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key)
        .agg((F.avg(label) >= 0.5).cast("int").alias("__label"))
    )
    sample = F.broadcast(bounded_sample(known, key, max_labelled))  # bounded by max_labelled
    rows = docs.join(sample, key).select(F.coalesce(text, F.lit("")).alias("text"), "__label")
    sample = stored(rows, "toxic-sample")
    words, stems = learn_lexicon(sample, "text", "__label")
    seen = match_statistics(sample, ["__label"], words, stems).toPandas()
    model = fit_logistic(seen[FEATURES].to_numpy(np.float64), seen["__label"].to_numpy(np.float64))
    found = match_statistics(docs, keep, words, stems, text)
    score = probability(margin(FEATURES, model))
    return found.withColumn("score", score).select(
        *keep, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES
    )


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity; fitted on labels of ids whose checksum mod 5 is not 0.

    A null doc_id counts as an empty one.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold == 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").filter(fold != 0)
    return toxicity(docs, labels, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "score", "predicted", *MATCHES
    )
