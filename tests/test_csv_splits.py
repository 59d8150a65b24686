"""The reader in splits against the one that reads a file in one task."""

import random

import pytest
from pyspark.sql import functions as F

from chatloom.sources import chat


def rows_of(df):
    return sorted(map(tuple, df.select("Date", "User", "Message", "_corrupt").collect()), key=repr)


@pytest.fixture
def narrow(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 400)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2])
def test_quoted_lines_over_many_splits(narrow, tmp_path, seed):
    rng = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        out = ["Date,User,Message"]
        for i in range(150):
            text = "".join(rng.choice(["x", "é", "\n", '""', ",", "\n\n", "word "]) for _ in range(rng.choice([0, 3, 30, 400])))
            out.append(rng.choice([f'2024-01-01 10:00:00,u{i},"{text}"', f"2024-01-01 10:00:00,u{i},plain {i}", "", "broken", f'"2024-01-02 00:00:00","u\n{i}","{text}"']))
        (tmp_path / name).write_text("\n".join(out) + rng.choice(["", "\n"]), encoding="utf-8")
    assert narrow.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert rows_of(chat.read_chat_csv_in_splits(narrow, str(tmp_path))) == rows_of(chat.read_chat_csv(narrow, str(tmp_path)))


def test_windows_line_ends_empty_and_header_only_files(narrow, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'Date,User,Message\r\n2024-01-01 10:00:00,a,"one\ntwo"\r\n2024-01-01 10:00:01,b,c\r\n')
    (tmp_path / "b.csv").write_bytes(b"")
    (tmp_path / "c.csv").write_bytes(b"Date,User,Message\n")
    got = rows_of(chat.read_chat_csv_in_splits(narrow, str(tmp_path)).withColumn("Date", F.col("Date").cast("string")))
    assert [(r[1], r[2]) for r in got] == [("a", "one\ntwo"), ("b", "c")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "d.csv").write_bytes(b"")
    assert chat.read_chat_csv_in_splits(narrow, str(tmp_path / "none")).count() == 0
