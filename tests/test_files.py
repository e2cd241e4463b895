import gzip
import json
import zipfile

import pytest

from tests.conftest import rows
from webloom.operators import index
from webloom.sources import files, sinks

WORD_XML = """<?xml version="1.0"?><w:document
xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>
<w:p><w:r><w:t>First </w:t></w:r><w:r><w:t>paragraph.</w:t></w:r></w:p><w:p/>
<w:p><w:r><w:t>Second</w:t><w:tab/><w:t>one æø</w:t></w:r></w:p></w:body></w:document>"""


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.txt").write_text("line one\nline two æ", encoding="utf-8")
    (tmp_path / "b.TXT").write_text("upper", encoding="utf-8")
    (tmp_path / "c.json").write_text(json.dumps({"url": "http://a", "text": "js\non"}, indent=4))
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as archive:
        archive.writestr("word/document.xml", WORD_XML)
    (tmp_path / "e.docx").write_text("no archive")
    (tmp_path / "f.xlsx").write_text("sheet")
    return tmp_path


def names(found):
    return {path.rsplit("/", 1)[1]: value for path, value in found}


def test_documents_by_extension(spark, folder):
    documents, rejected = files.load_documents(spark, str(folder))
    assert names(rows(documents)) == {
        "a.txt": "line one\nline two æ",
        "b.TXT": "upper",
        "c.json": "js\non",
        "d.docx": "First paragraph.  Second\tone æø",
    }
    assert names(rows(rejected)) == {"f.xlsx": "unsupported file type: xlsx", "e.docx": "not a Word file"}


def test_malformed_json_is_quarantined(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"url": "u", "text": "fine"}))
    (tmp_path / "bad.json").write_text('{"url": "u", "text": ')
    documents, rejected = files.load_documents(spark, str(tmp_path))
    assert [r.text for r in documents.collect()] == ["fine"]
    assert [(r.path.rsplit("/")[-1], r.reason) for r in rejected.collect()] == [("bad.json", "malformed JSON")]


def test_frequency_export(spark, tmp_path):
    dictionary = spark.createDataFrame([("a", 3), ("b", 1)], "term string, df bigint")
    sinks.export_frequency(dictionary, str(tmp_path / "df"))
    assert rows(spark.read.json(str(tmp_path / "df")), "term", "df") == [("a", 3), ("b", 1)]


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.load_documents(spark, str(tmp_path / "nothing"))[0].collect()


def test_corpus_scan(spark, tmp_path):
    for host, number, body in [("a.com", 1, {"url": "u1", "text": "t1"}), ("a.com", 2, {"url": "u2"}),
                               ("b.com", 1, {"url": "u3", "text": "t3"})]:
        (tmp_path / host).mkdir(exist_ok=True)
        (tmp_path / host / f"doc{number}.json").write_text(json.dumps(body, indent=4))
    (tmp_path / "top.json").write_text("{}")
    assert rows(files.corpus_scan(spark, str(tmp_path))) == [
        ("a.com", "doc1.json", "u1", "t1"), ("a.com", "doc2.json", "u2", ""), ("b.com", "doc1.json", "u3", "t3"),
    ]


def test_gzipped_lines(spark, tmp_path):
    reviews = [{"reviewerID": f"r{n}", "asin": "a", "overall": n / 2, "other": n} for n in range(9)]
    with gzip.open(tmp_path / "reviews.json.gz", "wt") as out:
        out.write("\n".join(json.dumps(r) for r in reviews))
    path = str(tmp_path / "reviews.json.gz")
    assert rows(files.read_reviews(spark, path, partitions=3)) == [(f"r{n}", "a", n / 2) for n in range(9)]
    assert rows(files.read_reviews(spark, path, rows=4), "reviewerID") == [(f"r{n}",) for n in range(4)]
    with gzip.open(tmp_path / "items.json.gz", "wt") as out:
        out.write(json.dumps({"asin": "x", "category": ["c"], "price": "$1"}))
    item = files.read_items(spark, str(tmp_path / "items.json.gz")).first()
    assert (item.asin, item.category, item.description, item.price) == ("x", ["c"], None, "$1")


def test_robots_and_stop_words(spark, tmp_path):
    (tmp_path / "a.dk_robots.txt").write_text("User-agent: *\nDisallow: /x")
    assert rows(files.read_robots(spark, str(tmp_path))) == [("a.dk", "User-agent: *\nDisallow: /x")]
    (tmp_path / "stop.txt").write_text("the\nof")
    assert rows(files.read_stop_words(spark, str(tmp_path / "stop.txt"))) == [("of",), ("the",)]


def test_documents_round_trip(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a.com", "doc1", "u", "æ\ntext"), ("b.com", "doc1", "v", None)],
        "host string, doc_id string, url string, text string",
    )
    sinks.write_documents(docs, str(tmp_path / "out"))
    assert rows(sinks.read_documents(spark, str(tmp_path / "out"))) == [
        ("a.com", "doc1", "u", "æ\ntext"), ("b.com", "doc1", "v", ""),
    ]


def test_index_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(n, f"word{n % 3} all") for n in range(20)], "doc_id bigint, text string")
    long, dictionary = index.build_index(docs, stem=False)
    sinks.write_index(long, dictionary, str(tmp_path / "index"))
    read, words = sinks.read_index(spark, str(tmp_path / "index"))
    assert rows(read) == rows(long) and rows(words) == rows(dictionary)
    sinks.export_index(long, str(tmp_path / "export"), span=8)
    assert rows(sinks.read_exported_index(spark, str(tmp_path / "export"))) == rows(long)


def test_gate(spark):
    full = spark.range(3)
    assert sinks.require_rows(full, "crawl") is full
    with pytest.raises(sinks.EmptyStageError, match="index"):
        sinks.require_rows(full.where("id > 9"), "index")


def test_checkpoint_folder_is_needed_on_a_cluster():
    from webloom.session import ensure_checkpoint_dir

    class Context:
        master = "spark://cluster:7077"
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, **conf):
            self.sparkContext, self.conf = Context(), conf

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
    named = Session(**{"spark.checkpoint.dir": "hdfs:///shared"})
    ensure_checkpoint_dir(named)
    assert named.sparkContext.folder == "hdfs:///shared"
