import random
import re

import pytest
from pyspark.sql import functions as F

from sentrylake.sources.line_blocks import BLANKS, read_blocks


def plain_blocks(text):
    found, block = [], []
    for line in [*re.split("\r\n|\n|\r", text), ""]:
        if line.strip(BLANKS):
            block.append(line)
        elif block:
            found.append("\n".join(block))
            block = []
    return found


@pytest.fixture
def split_size(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_random_files_over_splits(spark, tmp_path, split_size):
    rng, want, folder = random.Random(1), {}, tmp_path / "logs"
    folder.mkdir()
    for i in range(12):
        end = rng.choice(["\n", "\r\n", "\r"])
        lines = rng.choices(["", " ", "\t\x0b", "x", " long line é", "y" * rng.randrange(1, 90)], rng.choice([[1, 1, 1, 9, 9, 9], [1] * 6]),
                            k=rng.randrange(60))
        text = rng.choice(["", end]) + end.join(lines) + rng.choice(["", end, end * 3])
        (folder / f"{i}.log").write_bytes(text.encode())
        want[f"{i}.log"] = sorted(plain_blocks(text))
    (folder / "other.txt").write_text("not\n\nread")
    (folder / "empty.log").write_text("")
    for size in ("17b", "64", "1k", "128m"):
        split_size(size)
        found = {name: [] for name in want}
        for r in read_blocks(spark, str(folder), "*.log").collect():
            found[r.file.rsplit("/", 1)[1]].append(r.raw)
        assert {k: sorted(v) for k, v in found.items()} == want, size


def test_one_block_over_many_splits_and_none(spark, tmp_path, split_size):
    text = "\n".join(f"line {i}" for i in range(300))
    (tmp_path / "a").write_text(text)
    (tmp_path / "b").write_text(" \n\t\n" * 200)
    split_size("50")
    found = read_blocks(spark, str(tmp_path))
    assert [r.raw for r in found.collect()] == [text]


def test_a_file_of_blank_holding_separators_is_read_by_many_tasks(spark, tmp_path, split_size):
    text = " \r\n".join(f"first {i}\r\nsecond {i}\r\n" for i in range(2000))
    (tmp_path / "a").write_bytes(text.encode())
    split_size("2k")
    found = read_blocks(spark, str(tmp_path))
    per_task = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 10 and max(r["count"] for r in per_task) < 200
    assert sorted(r.raw for r in found.collect()) == sorted(f"first {i}\nsecond {i}" for i in range(2000))
