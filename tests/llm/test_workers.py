"""What the tasks of the operators leave in a Python worker, and how many workers a task takes."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from rtdw.llm import repeats, words


def anonymous_mb():
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()).group(1)) / 1024


def test_a_task_gives_its_free_memory_back():
    batch = pa.RecordBatch.from_arrays([pa.array(["x"])], ["text"])
    held = []

    def work(batches):
        # Below the size from which memory is mapped by itself, and with something left on top.
        parts = [np.ones(12_000, np.int64) for _ in range(2000)]
        held.append(np.ones(12_000, np.int64))
        del parts
        yield from batches

    words.kept("other", lambda: np.ones(1000))
    before = anonymous_mb()
    assert list(words.lean(work, "own")(iter([batch]))) == [batch]
    assert anonymous_mb() - before < 60
    assert "other" not in words._kept


def test_trimmed_documents_take_one_worker_for_each_task(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    plan = repeats.trimmed_documents(spark, docs, odd_dir)._jdf.queryExecution().executedPlan().toString()
    steps = [line.strip(" +-:*()0123456789") for line in plan.splitlines()]
    steps = [x for x in steps if x.startswith(("MapInArrow", "Exchange"))]
    assert "MapInArrow" in plan
    assert not any(a.startswith("MapInArrow") and b.startswith("MapInArrow") for a, b in zip(steps, steps[1:], strict=False))
