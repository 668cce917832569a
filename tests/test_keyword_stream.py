"""Keyword statistics on a stream: what is counted, when, and how much of the state it takes."""

from collections import Counter
from datetime import datetime

import pytest

from rtdw.operators import stats
from rtdw.streaming import keyed
from rtdw.streaming.run import start_table

SCHEMA = "page map<string,string>, rt timestamp"


def page(text, second, kind="keyword"):
    return {"item_type": kind, "item": text}, datetime(2024, 1, 1, 10, second // 60, second % 60)


@pytest.mark.parametrize("together", [keyed.COUNTED_WORDS, 3])
def test_words_of_a_window_come_in_several_batches(spark, tmp_path, monkeypatch, together):
    monkeypatch.setattr(keyed, "COUNTED_WORDS", together)
    many = " ".join(f"w{i}" for i in range(500))
    batches = [
        [page(many, 1), page("Red red", 9), page(None, 2), page("...", 3), page("no", 4, "sku"), page("blue 上海", 11)],
        [page("red w7", 10 - 1), page("green", 11)],
        [page("far", 100)],
        [page("late", 5), page("late", 12), page("kept", 105), page("farther", 300)],
        [page("last", 500)],
    ]
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    updated = []
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(log)
        counted = stats.keyword_stats(spark.readStream.schema(SCHEMA).parquet(log))
        run = start_table(counted, out, checkpoint, every=None)
        run.awaitTermination()
        updated.append(max(p.stateOperators[0].numRowsUpdated for p in run.recentProgress if p.stateOperators))
    got = Counter({
        (r.stt[14:], r.edt[14:], r.keyword): r.ct for r in spark.read.parquet(out).collect()
    })
    first = {("00:00", "00:10", f"w{i}"): 1 for i in range(500)}
    first |= {("00:00", "00:10", "w7"): 2, ("00:00", "00:10", "red"): 3}
    second = {("00:10", "00:20", w): 1 for w in ("blue", "上海", "green")}
    later = {("01:40", "01:50", w): 1 for w in ("far", "kept")} | {("05:00", "05:10", "farther"): 1}
    assert got == Counter(first | second | later)
    assert updated[0] <= 2 * keyed.WORD_PARTS  # not an entry for each word


def test_stream_equals_stored_form(spark, tmp_path):
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    rows = [page(" ".join(f"w{(i * j) % 97}" for j in range(30)), i % 50) for i in range(200)]
    spark.createDataFrame([*rows, page("end", 900)], SCHEMA).repartition(5).write.parquet(log)
    stream = stats.keyword_stats(spark.readStream.schema(SCHEMA).parquet(log))
    start_table(stream, out, checkpoint, every=None).awaitTermination()
    names = ["stt", "edt", "keyword", "ct", "source"]
    stored = stats.keyword_stats(spark.read.parquet(log))
    assert stored.columns == stream.columns and stored.dtypes == stream.dtypes
    want = Counter(map(tuple, stored.where("keyword <> 'end'").select(names).collect()))
    assert Counter(map(tuple, spark.read.parquet(out).select(names).collect())) == want
