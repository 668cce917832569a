import random
import zlib

import pytest

from rtdw.llm import toxicity
from rtdw.llm.queries import QUERIES

from .brute import edit_distance

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_language_id"](spark, SF).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held) > 0.97 * len(held)


def test_language_without_letters(spark, odd_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op3_language_id"](spark, odd_dir).collect()}
    assert {rows[i]["lang_pred"] for i in (6, 7, 9)} == {"und"}
    assert rows[8]["lang_pred"] != "und"


def test_quality_agrees_with_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_quality"](spark, SF).collect() if r["doc_id"] in labels]
    assert sum(r["keep"] == bool(labels[r["doc_id"]]) for r in rows) > 0.98 * len(rows)


def test_sparse_sites_shrink_to_the_prior(spark):
    from pyspark.sql import functions as F

    from rtdw.llm.quality import site_rates

    rows = [("big", 1000, 100.0), ("small", 1, 0.0), ("fair", 500, 450.0), ("good", 800, 790.0)]
    df = spark.createDataFrame(rows, "host string, n long, total double")
    got = {r["host"]: r["rate"] for r in site_rates(df, ["host"], F.lit(0.8)).collect()}
    assert got["big"] < 0.15 and 0.3 < got["small"] < 0.8 and got["good"] > 0.95


def test_toxicity_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op10_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) > 0.9 * len(held)


@pytest.mark.parametrize("swaps", [True])
def test_automaton_equals_edit_distances(swaps):
    words, stems = ["idiot", "worthless", "scum"], ["lowei", "disgustin"]
    automaton = toxicity.LexiconAutomaton(words, stems)
    tried = ["idiot", "idoit", "idio", "idiots", "xidiot", "worthles", "wrothles", "worthlezz", "scum", "scam",
             "loweisch", "lowisch", "loewisch", "disgusting", "disgutsing", "digusting", "clean", "lo", "i", ""]
    for word in tried:
        best = -1
        for entry in words + stems:
            bound = toxicity.edits_allowed(len(entry))
            if entry in stems:
                away = min(edit_distance(entry, word[:i], swaps) for i in range(len(word) + 1))
            else:
                away = edit_distance(entry, word, swaps)
            if away <= bound and (best < 0 or away < best):
                best = away
        assert automaton.near(word) == best, word


def test_quoted_matches_are_told_apart():
    finder = toxicity.Finder(["idiot"], [])
    meant = finder.matches("you are an Idiot and more")
    quoted = finder.matches('they wrote that "you are an idoit" yesterday')
    assert [(m[2], m[3]) for m in meant] == [(0, False)]
    assert [(m[2], m[3]) for m in quoted] == [(1, True)]
    assert "you are an Idiot and more"[meant[0][0] : meant[0][1]] == "Idiot"


def test_lexicon_counts_texts_that_share_words(spark):
    rng = random.Random(3)
    usual = [f"{a}{b}" for a in ("ka", "mo", "tu", "se") for b in ("lin", "dor", "vas")]
    own = lambda: "".join(rng.choices("bcdfghjklmnp", k=9))
    mixed = lambda *more: " ".join(rng.sample([*usual, own(), own(), own(), *more], 15 + len(more))) + "."
    rows = [(mixed("vermin"), 1) for _ in range(4)] + [(mixed(), 0) for _ in range(8)]
    copied = mixed("zebra")
    rows += [(copied, 1), (copied.upper(), 1), (copied + " !", 1), (copied.replace(" ", ", "), 1)]
    words, stems = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert "vermin" in words + stems
    assert not any("zebra".startswith(entry) for entry in words + stems)
