import gzip
import io
import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from webloom.sources import files
from webloom.sources.gzip_members import range_lines, read_gzip_lines


def members(content: bytes, sizes) -> bytes:
    """``content`` as gzip members of the given sizes, levels 0 to 9 in turn."""
    out, at = b"", 0
    for n, size in enumerate([*sizes, len(content)]):
        out += gzip.compress(content[at : at + size], compresslevel=n % 10)
        at += size
    return out


def all_ranges(data: bytes, step: int) -> list[bytes]:
    file = io.BytesIO(data)
    cuts = range(0, len(data), step)
    return [line for at in cuts for line in range_lines(file, at, min(at + step, len(data)))]


@pytest.mark.parametrize("seed", range(30))
def test_ranges_give_every_line_once(seed):
    rng = random.Random(seed)
    lines = ["".join(rng.choices("abé \x1f", k=rng.choice([0, 3, 40, 900]))) for _ in range(rng.randrange(60))]
    content = "\n".join(lines).encode() + rng.choice([b"", b"\n"])
    data = members(content, [rng.choice([0, 1, 7, 300, 4000]) for _ in range(rng.randrange(20))])
    expected = content.split(b"\n")
    expected = expected[:-1] if not expected[-1] else expected
    for step in (1, 13, 200, 5000, len(data)):
        assert all_ranges(data, step) == expected, step


def test_padding_and_false_starts():
    data = gzip.compress(b"a\nb") + b"\0" * 9 + gzip.compress(b"c\n") + b"\0\0"
    assert all_ranges(data, 5) == all_ranges(data, len(data)) == [b"a", b"bc"]
    stored = gzip.compress(b"x\x1f\x8b\x08y\n" * 50, compresslevel=0) + gzip.compress(b"z\n")
    assert all_ranges(stored, 16) == [b"x\x1f\x8b\x08y"] * 50 + [b"z"]


def test_broken_members_are_errors():
    good = gzip.compress(b"one\n") + gzip.compress(b"two\n")
    for step in (4, 10, 1000):
        with pytest.raises(EOFError):
            all_ranges(good[:-3], step)
        with pytest.raises(zlib.error):
            all_ranges(good[:-6] + b"wrong!", step)
    with pytest.raises(zlib.error):
        all_ranges(b"no gzip", 100)


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    reviews = [{"reviewerID": f"u{n}", "asin": f"a{n % 7}", "overall": float(n % 5)} for n in range(4000)]
    text = "\n".join(json.dumps(r) for r in reviews) + "\n\nno json\n"
    folder = tmp_path / "gz"
    folder.mkdir()
    (folder / "many.json.gz").write_bytes(members(text.encode(), [1111] * 150))
    (folder / "one.json.gz").write_bytes(gzip.compress(json.dumps(reviews[0]).encode()))
    (folder / "empty.json.gz").write_bytes(b"")
    lines = read_gzip_lines(spark, str(folder), 4096).withColumn("task", F.spark_partition_id())
    tasks = {r.file: r.n for r in lines.groupBy(F.substring_index("path", "/", -1).alias("file")).agg(
        F.countDistinct("task").alias("n")).collect()}
    assert tasks["one.json.gz"] == 1 and tasks["many.json.gz"] > 4
    read = files.read_json_members(spark, folder.as_uri(), files.REVIEW_SCHEMA, 4096)
    plain = files.read_json_lines(spark, str(folder), files.REVIEW_SCHEMA)
    assert sorted(map(str, read.collect())) == sorted(map(str, plain.collect()))
    assert read.count() == 4002


def test_missing_path(spark, tmp_path):
    with pytest.raises(Exception, match="nothing"):
        read_gzip_lines(spark, str(tmp_path / "nothing")).collect()
