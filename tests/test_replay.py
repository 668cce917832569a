"""The keyed rules against a row-by-row replay, on whole sample tables and made-up rows."""

import random

import pytest

from rtdw.operators import logs, visits
from rtdw.plans import standin

GAP = 6 * 3_600_000


def replay_flags(rows):
    seen, out = set(), []
    for mid, _, ident, flag in sorted(rows, key=lambda r: (r[1], r[2])):
        out.append((ident, "0" if flag == "1" and mid in seen else flag))
        if flag == "1":
            seen.add(mid)
    return sorted(out)


def replay_visits(rows):
    last, out = {}, []
    for mid, ts, ident, entry in sorted(rows, key=lambda r: (r[1], r[2])):
        day = ts // 86_400_000
        if not entry and last.get(mid) != day:
            last[mid] = day
            out.append(ident)
    return sorted(out)


def replay_bounces(rows, gap):
    """A state machine per device: an open entry waits for its next row or its timeout."""
    open_entry, out = {}, []
    for mid, ts, ident, entry in sorted(rows, key=lambda r: (r[1], r[2])):
        if mid in open_entry:
            begun, waiting = open_entry.pop(mid)
            if ts - begun >= gap or entry:
                out.append(waiting)
        if entry:
            open_entry[mid] = (ts, ident)
    out.extend(ident for _, ident in open_entry.values())
    return sorted(out)


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    rows = standin.log_records(standin.table(spark, sf_dir, "events"))
    return rows.selectExpr(
        "event_id", "common", "page", "ts", "common.is_new as is_new", "common.mid as mid"
    ).cache()


def test_new_visitor(log):
    rows = [(r["mid"], r["ts"], r["event_id"], r["is_new"]) for r in log.collect()]
    fixed = logs.fix_new_visitor(log.select("mid", "ts", "event_id", "is_new"))
    assert sorted((r["event_id"], r["is_new"]) for r in fixed.collect()) == replay_flags(rows)


def test_unique_visits_and_bounces(log):
    pages = log.where("page is not null").select("event_id", "common", "page", "ts")
    rows = [
        (r["common"]["mid"], r["ts"], r["event_id"], r["page"]["last_page_id"] is None)
        for r in pages.collect()
    ]
    kept = visits.unique_visits(pages, tiebreak=("event_id",))
    assert sorted(r["event_id"] for r in kept.collect()) == replay_visits(rows)
    for length in (None, "6 hours", "7 hours", "1 day"):
        bounced = visits.bounces(
            pages, tiebreak=("event_id",), timeout="6 hours", slice_length=length
        )
        assert sorted(r["event_id"] for r in bounced.collect()) == replay_bounces(rows, GAP)


@pytest.mark.parametrize("seed", range(3))
def test_bounces_of_one_busy_device(spark, seed):
    """Most rows are one device's, close together, with equal times among them."""
    rng = random.Random(seed)
    rows = [
        (rng.choice(["hot"] * 5 + ["a", "b"]), rng.randrange(0, 900) * 1_000, i, rng.random() < 0.6)
        for i in range(600)
    ]
    df = spark.createDataFrame(
        [((m,), (None if entry else "p",), ts, i) for m, ts, i, entry in rows],
        "common struct<mid string>, page struct<last_page_id string>, ts bigint, id int",
    )
    for length in ("10 seconds", "45 seconds", None):
        got = visits.bounces(df, tiebreak=("id",), slice_length=length)
        assert sorted(r["id"] for r in got.collect()) == replay_bounces(rows, 10_000)


def test_slice_must_cover_the_timeout(log):
    with pytest.raises(ValueError):
        visits.bounces(log, timeout="10 seconds", slice_length="5 seconds")
