"""Web archives, preference pairs and the pipeline."""

import base64
import gzip
import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from rtdw.llm import warc
from rtdw.llm.queries import QUERIES


def expected(pages):
    first = {}
    for page_id, html in pages:
        if page_id is not None:
            first[html] = min(page_id, first.get(html, page_id))
    out = Counter()
    for page_id, html in pages:
        data = html.encode()
        again = html in first and page_id != first[html]
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[page_id, len(data), name, "revisit" if again else "response", first[html] if again else None] += 1
    return out


@pytest.mark.parametrize("which", ["odd_dir", "sf_dir"])
def test_archive_round_trip(spark, request, which):
    folder = request.getfixturevalue(which)
    pages = [(r["page_id"], r["html"] or "") for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert Counter(map(tuple, QUERIES["op6_warc"](spark, folder).collect())) == expected(pages)


@pytest.mark.parametrize("compress", ["true", "false"])
def test_payloads_headers_and_conditions(spark, tmp_path, compress):
    rows = [(i, f"http://a/{i}", "response", None, (f"<p>{i}</p>\r\n\r\n" * i).encode()) for i in range(50)]
    rows.append((50, "http://a/50", "revisit", 3, rows[3][4]))
    df = spark.createDataFrame(rows, "page_id long, url string, record_type string, refers_to long, payload binary")
    spark.dataSource.register(warc.WarcSource)
    path = f"file://{tmp_path}/archive"
    df.write.format("warc").mode("append").option("path", path).option("compress", compress).save()
    back = {r["page_id"]: r for r in warc.read_archive(spark, path, verify="true").collect()}
    assert {i: bytes(back[i]["payload"]) for i in range(50)} == {r[0]: r[4] for r in rows[:50]}
    assert back[50]["payload"] is None and back[50]["payload_bytes"] == len(rows[3][4]) and back[50]["refers_to"] == 3
    some = warc.read_archive(spark, path).filter("record_type = 'response' and page_id in (4, 7, 50)")
    assert {r["page_id"] for r in some.collect()} == {4, 7}
    heads = warc.read_archive(spark, path, payload="false").collect()
    assert len(heads) == 51 and all(r["payload"] is None for r in heads)


def test_skipped_payloads_are_not_decompressed(tmp_path):
    data = [warc.record(i, "u", "response", None, "D", bytes([i]) * 200_000) for i in range(5)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(map(warc.member, data)))
    assert gzip.decompress(path.read_bytes()) == b"".join(data)
    reader = warc.WarcReader({"path": f"file://{path}"})
    reader._allow("page_id", [3])
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["page_id"], r["payload"]) for r in got] == [(3, bytes([3]) * 200_000)]


def test_members_of_other_writers(tmp_path):
    data = [warc.record(i, "u", "response", None, "D", b"x" * i) for i in range(1, 40)]
    path = tmp_path / "y.warc.gz"
    path.write_bytes(b"".join(map(gzip.compress, data)))
    reader = warc.WarcReader({"path": f"file://{path}"})
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["page_id"], len(r["payload"])) for r in got] == [(i, i) for i in range(1, 40)]


def test_only_published_files_are_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", b"x")], "page_id long, url string, payload binary")
    path = f"file://{tmp_path}/a"
    warc.write_archive(df, path)
    (tmp_path / "a" / "pages-lost-00000.warc").write_bytes(warc.record(9, "u", "response", None, "D", b""))
    assert [r["page_id"] for r in warc.read_archive(spark, path).collect()] == [1]


def test_preference_pairs(spark, odd_dir):
    rows = {r["conv_id"]: r for r in QUERIES["op9_preferences"](spark, odd_dir).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[3]["chosen"] is None and rows[3]["n_common"] == 2  # no reply
    assert rows[2]["chosen"] == "" and rows[2]["n_common"] == 2  # the next reply, of 1, is the same
    assert rows[5]["prompt"].count("<|end|>") == 3
    assert rows[5]["rejected"] == "<|assistant|>\né\U0001F600<|end|>\n"  # of 4
    start, size = map(int, rows[5]["rejected_mask"].split(":"))
    assert rows[5]["rejected"][start : start + size] == "é\U0001F600<|end|>\n"


def test_prefix_of_several_turns(spark):
    from rtdw.llm.chat import preference_format

    a = [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "s")]
    b = [("user", "q"), ("assistant", "b")]
    kind = "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    (row,) = preference_format(spark.createDataFrame([(1, a, b)], kind)).collect()
    assert row["n_common"] == 1 and row["prompt"] == "<|user|>\nq<|end|>\n"
    spans = [row["chosen"][s["start"] : s["start"] + s["length"]] for s in row["chosen_mask"]]
    assert spans == ["a<|end|>\n", "s<|end|>\n"]
    assert row["rejected"] == "<|assistant|>\nb<|end|>\n"


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left.count()
        left = stage(spark, left, sf_dir)
        assert left.columns == columns, name
        assert left.count() <= before
    ids = {r["doc_id"] for r in left.collect()}
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert not [i for i in ids if labels.get(i) == 0]
