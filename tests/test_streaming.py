import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from webloom import streaming
from webloom.operators import index
from webloom.streaming import segments


def drop(folder, host, number, text):
    (folder / host).mkdir(parents=True, exist_ok=True)
    (folder / host / f"doc{number}.json").write_text(json.dumps({"url": f"http://{host}/{number}", "text": text}))


def run_index(docs, tmp_path):
    streaming.index_stream(docs, str(tmp_path / "index"), str(tmp_path / "state")).awaitTermination(120)


def test_index_stream_equals_batch(spark, tmp_path):
    texts = {n: f"word{n} shared{n % 2} thing" for n in range(6)}
    for n in range(3):
        drop(tmp_path / "in", "a.com", n, texts[n])
    docs = streaming.read_document_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    run_index(docs, tmp_path)
    for n in range(3, 6):
        drop(tmp_path / "in", "b.com", n, texts[n])
    run_index(docs, tmp_path)
    found = streaming.read_streamed_postings(spark, str(tmp_path / "index"), "string")
    assert len(segments.read_manifest(spark, str(tmp_path / "index"))) > 1
    table = [(f"{'a' if n < 3 else 'b'}.com/doc{n}.json", t) for n, t in texts.items()]
    batch = index.postings(index.normalize(spark.createDataFrame(table, "doc_id string, text string")))
    assert rows(found, "term", "doc_id") == rows(batch, "term", "doc_id")


def test_repeated_documents_add_nothing(spark, tmp_path):
    schema = "doc_id bigint, text string"
    first = spark.createDataFrame([(1, "apple pear"), (2, "apple")], schema)
    first.write.parquet(str(tmp_path / "in"))
    docs = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    run_index(docs, tmp_path)
    first.write.mode("append").parquet(str(tmp_path / "in"))
    run_index(docs, tmp_path)
    found = streaming.read_streamed_postings(spark, str(tmp_path / "index"))
    assert rows(found, "term", "doc_id") == [("apple", 1), ("apple", 2), ("pear", 1)]


def test_changes_and_removals(spark, tmp_path):
    """After every batch the index equals that of the documents as they are, with few segments."""
    path = str(tmp_path / "index")
    rng = np.random.default_rng(3)
    words = [f"word{n}" for n in range(12)]
    now = {}
    for number in range(11):
        batch = []
        for doc in rng.choice(15, 4, replace=False).tolist():
            gone = bool(rng.random() < 0.3)
            text = " ".join(rng.choice(words, 3))
            batch.append((doc, text, gone, 2))
            batch.append((doc, "stale text", not gone, 1))
            if gone:
                now.pop(doc, None)
            else:
                now[doc] = text
        frame = spark.createDataFrame(batch, "doc_id bigint, text string, removed boolean, version int")
        segments.add_batch(frame, number, path, fanout=3)
        versions = segments.read_manifest(spark, path)
        last = versions[max(versions)]
        assert last[-1].last_batch == number and len(last) <= 2 * 3
        assert [s.first_batch for s in last[1:]] == [s.last_batch + 1 for s in last[:-1]]
    expected = sorted({(w, d) for d, text in now.items() for w in text.split()}, key=str)
    assert rows(segments.live_postings(spark, path), "term", "doc_id") == expected
    assert len(versions) <= 2
    # The batch is there already; running it again changes nothing.
    segments.add_batch(frame.limit(0), 10, path)
    assert rows(segments.live_postings(spark, path), "term", "doc_id") == expected


def test_killed_batch_leaves_no_trace(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    schema = "doc_id bigint, text string"
    segments.add_batch(spark.createDataFrame([(1, "apple pear")], schema), 0, path)
    whole = segments.write_manifest

    def killed(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(segments, "write_manifest", killed)
    with pytest.raises(RuntimeError):
        segments.add_batch(spark.createDataFrame([(1, "plum"), (2, "half")], schema), 1, path)
    assert rows(segments.live_postings(spark, path), "term", "doc_id") == [("apple", 1), ("pear", 1)]
    monkeypatch.setattr(segments, "write_manifest", whole)
    segments.add_batch(spark.createDataFrame([(1, "plum")], schema), 1, path)
    assert rows(segments.live_postings(spark, path), "term", "doc_id") == [("plum", 1)]


@pytest.mark.parametrize("event_time", [None, "at"])
def test_seen_urls_are_dropped(spark, tmp_path, event_time):
    schema = "url string, at timestamp"
    path = str(tmp_path / "links")
    links = spark.createDataFrame([("u1", 1), ("u2", 2), ("u1", 3)], "url string, at int").select(
        "url", F.timestamp_seconds("at").alias("at")
    )
    links.write.parquet(path)
    stream = streaming.unseen_urls(
        spark.readStream.schema(schema).parquet(path), event_time, "7 days" if event_time else None
    )
    out = str(tmp_path / "out")

    def run():
        writer = stream.writeStream.format("parquet").option("path", out)
        writer = writer.option("checkpointLocation", str(tmp_path / "state"))
        writer.trigger(availableNow=True).start().awaitTermination(120)

    run()
    links.unionByName(links.withColumn("url", F.lit("u3"))).write.mode("append").parquet(path)
    run()
    assert rows(spark.read.parquet(out), "url") == [("u1",), ("u2",), ("u3",)]


def test_seen_addresses_lie_on_disk_and_outlive_a_restart(spark, tmp_path):
    schema = "url string, page int"
    source, out, state = (str(tmp_path / n) for n in ("links", "out", "state"))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = streaming.deliver_unseen(stream, out, state)
        query.awaitTermination(120)
        return [p for p in query.recentProgress if p["stateOperators"]]

    spark.range(500).selectExpr("concat('u', id % 300) AS url", "1 AS page").coalesce(1).write.parquet(source)
    first = run()
    spark.range(600).selectExpr("concat('u', id) AS url", "2 AS page").coalesce(1).write.mode("append").parquet(source)
    spark.createDataFrame([(None, 3), (None, 4), ("", 5)], schema).coalesce(1).write.mode("append").parquet(source)
    second = run()
    found = spark.read.schema(schema).parquet(out)
    assert found.count() == 602 and found.select("url").distinct().count() == 602
    assert found.where("page = 1").count() == 300
    for progress in (first[-1], second[-1]):
        assert any("rocksdb" in name.lower() for name in progress["stateOperators"][0]["customMetrics"])
    assert second[-1]["stateOperators"][0]["numRowsTotal"] == 602
