"""Zip members and the message log, read by format."""

import json
import zipfile

import pytest
from pyspark import TaskContext

from waymill.sources import formats


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    formats.register(spark)


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()))


def archive(path, members: dict[str, str]):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_members_are_tasks_and_headers_are_sets(spark, tmp_path):
    archive(tmp_path / "one.zip", {"a.csv": 'x;y;note\n1;"p;q";\n2;é;0\n', "sub/b.csv": "y;x\nr;3\n\n;4\n", "empty.csv": ""})
    archive(tmp_path / "two.zip", {"c.csv": "﻿x;y\n5;s\n", "readme.txt": "no"})
    read = lambda **o: spark.read.format("zip_members").options(path=str(tmp_path), **({"members": r"\.csv$"} | o)).schema("x string, y string, member string").load()
    df = read()
    assert rows(df.na.fill("-")) == [("1", "p;q", "a.csv"), ("2", "é", "a.csv"), ("3", "r", "sub/b.csv"), ("4", "-", "sub/b.csv"), ("5", "s", "c.csv")]
    assert df.rdd.getNumPartitions() == 4
    assert rows(read(members="first")) == [("1", "p;q", "a.csv"), ("2", "é", "a.csv"), ("5", "s", "c.csv")]
    assert rows(spark.read.format("zip_members").option("path", f"{tmp_path}/two*.zip").option("members", "csv").option("skip", "x").schema("y string").load()) == [("s",)]


def test_many_members_use_many_tasks(spark, tmp_path):
    archive(tmp_path / "many.zip", {f"m{k}.csv": "x\n" + "\n".join(str(j) for j in range(k, 25_000 + k)) for k in range(12)})
    df = spark.read.format("zip_members").option("path", f"{tmp_path}/many.zip").schema("x string, member string").load()
    assert df.count() == 12 * 25_000
    tasks = df.rdd.map(lambda r: (TaskContext.get().partitionId(), r.member)).distinct().collect()
    assert len({t for t, _ in tasks}) == 12


@pytest.mark.parametrize(("text", "match"), [("x;z\n1;2\n", "column y is there 0 times"), ("x;y;y\n1;2;3\n", "column y is there 2 times"), ("x;y;z\n1;2;3\n", "column z is not expected and has values")])
def test_other_headers_fail(spark, tmp_path, text, match):
    archive(tmp_path / "bad.zip", {"a.csv": text})
    read = spark.read.format("zip_members").option("path", f"{tmp_path}/bad.zip").schema("x string, y string")
    with pytest.raises(Exception, match=match):
        read.load().collect()
    if "z is not" in match:
        assert rows(read.option("skip", "z").load()) == [("1", "2")]


def append(path, messages):
    with open(path, "ab") as f:
        f.write(b"".join(json.dumps(m).encode() + b"\n" for m in messages))


def consume(spark, log, checkpoint, **options):
    got = []

    def keep(batch, number):
        got.append(sorted((r.partition, json.loads(r.value)["n"]) for r in batch.collect()))

    formats.consume(spark, str(log), "g", keep, str(checkpoint), **options)
    return [g for g in got if g]


def test_restarts_read_nothing_again(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    append(log / "p0.jsonl", [{"n": 1}, {"n": 2}])
    append(log / "p1.jsonl", [{"n": 3}])
    assert consume(spark, log, tmp_path / "c") == [[("p0.jsonl", 1), ("p0.jsonl", 2), ("p1.jsonl", 3)]]
    assert consume(spark, log, tmp_path / "c") == []
    append(log / "p1.jsonl", [{"n": 4}])
    with open(log / "p1.jsonl", "ab") as f:
        f.write(b'{"n": 5')  # not whole yet
    append(log / "p2.jsonl", [{"n": 6}])
    assert consume(spark, log, tmp_path / "c") == [[("p1.jsonl", 4), ("p2.jsonl", 6)]]
    with open(log / "p1.jsonl", "ab") as f:
        f.write(b"}\n")
    # a new query of the group goes on from what was committed
    committed = json.loads((log / "_commits/g.json").read_text())
    assert set(committed) == {"p0.jsonl", "p1.jsonl", "p2.jsonl"}
    assert consume(spark, log, tmp_path / "other") == [[("p1.jsonl", 5)]]
    bounded = spark.read.format("message_log").options(path=str(log), group="new").load()
    assert sorted(json.loads(r.value)["n"] for r in bounded.collect()) == [1, 2, 3, 4, 5, 6]
    assert {r.value: r.offset for r in bounded.where("partition = 'p0.jsonl'").collect()} == {'{"n": 1}': 0, '{"n": 2}': 9}
    append(log / "p0.jsonl", [{"n": 7}])
    since = spark.read.format("message_log").options(path=str(log), group="g").load()
    assert {json.loads(r.value)["n"] for r in since.collect()} == {7}


def test_bounded_batches_end_at_whole_lines(spark, tmp_path):
    reader = formats.LogReader({"path": str(tmp_path), "bytes": "20"})
    append(tmp_path / "p.log", [{"n": 1}, {"n": 2}, {"n": "a message of over twenty bytes"}, {"n": 3}])
    offsets = [reader.latestOffset()["p.log"] for _ in range(4)]
    assert offsets == [18, 58, 67, 67]
    assert [json.loads(v)["n"] for _, _, v in reader.read(reader.partitions({"p.log": 18}, {"p.log": 58})[0])] == ["a message of over twenty bytes"]
