"""CSV in byte ranges: every cut gives what the sequential reader gives."""

import random

import pytest

from tidewell.sources import csv_ranges, landing

ODD = [
    b"", b"\n", b"\n1,2\n", b"a,b\n1,2\n", b"a,b\n1,2", b"\xef\xbb\xbfa,b\r\n1,2\r\n", b"\xef\xbb\xbf", b'a,b\n"x\ny\n\nz",2\n3,4\n', b'a,b\n"open\n1,2\n', b'"open', b'a,b\n"x"y,2\n3,4\n', b'a,b\n1,2"3\n"4""5",6\n', b"a,b\n1,\xff\n2,3\n",
    b'a,b\n"1\n\xff', b"\xef\xbb\xbfa\n\xc3\nb\n", b"a\rb\r1\n2\r\n\r\n3", b'a,b\n"1\r2\r\n3",4\n', b'"a\nb",c\n1,2\n', 'é,ß\n"ü\n日本","x""\n""y"\n'.encode(), b'a\n"\n\n\n\n\n\n\n"\nb\n', b"a,b\n\n\n1,2\n", b'a,b\n1,2\r3\n"', b'a\n"x"\r"y"\n', b'a,"b\n"c\n',
]


def generated(seed):
    r = random.Random(seed)
    parts = [b"a", b"1", b",", b",", b"\n", b"\n", b'"', b'""', b"\r\n", b"\r", "é".encode(), b"x y"] + [b"\xff"] * (seed % 7 == 0)
    clean = [b"a,b\n", b'"q\nr",s\n', b"1,2\r\n", b'"x""y",z\n', b"\n", b'"\n\n\n",\n']
    return b"".join(r.choice(parts if seed % 2 else clean) for _ in range(r.randrange(60)))


def rows(df):
    return sorted((r["batch_id"], r["file_name"], r["kind"], -1 if r["row_number"] is None else r["row_number"], str(r["fields"]), r["detail"] or "") for r in df.collect())


@pytest.mark.parametrize("size", [1, 9])
def test_every_cut_gives_the_sequential_records(spark, size):
    contents = ODD + [generated(i) for i in range(90)]
    files = spark.createDataFrame([("batch_001", f"f{i}.csv", bytearray(c)) for i, c in enumerate(contents)], "batch_id string, file_name string, content binary").repartition(4)
    got = csv_ranges.read_strict_csv_ranges(csv_ranges.cut(files, size), files)
    assert rows(got) == rows(landing.read_strict_csv(files))


@pytest.mark.parametrize("few", [0, 100])
def test_large_files_are_split_by_spark(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(csv_ranges, "FEW_RANGES", few)
    r = random.Random(3)
    folder = tmp_path / "batch_007"
    folder.mkdir()
    line = lambda i: f'{i},"va""lue\n{i}, more"\r\n' if r.random() < 0.3 else f"{i},plain {i}\n"
    (folder / "a.csv").write_text("﻿id,value\n" + "".join(line(i) for i in range(6000)), newline="")
    (folder / "b.csv").write_text('x\n"' + "\n" * 30_000 + '"\ny', newline="")
    (folder / "c.csv").write_bytes(b"a,b\n" + b"1,2\n" * 9000 + b"\xff\n")
    (folder / "d.csv").write_bytes(b"")
    files = spark.createDataFrame([("batch_007", p.name, bytearray(p.read_bytes())) for p in sorted(folder.iterdir())], "batch_id string, file_name string, content binary")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        ranges = csv_ranges.read_ranges(spark, [str(folder)], 1000)
        assert ranges.rdd.getNumPartitions() > 10 and ranges.select("start").distinct().count() > 10
        largest = max(len(x["content"]) for x in ranges.collect())
        assert largest < 1100
        assert rows(csv_ranges.read_strict_csv_ranges(ranges, files)) == rows(landing.read_strict_csv(files))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_encodings(spark):
    content = "ä,b\n\"ü\nx\",ß\n".encode("cp1252")
    files = spark.createDataFrame([("batch_001", "a.csv", bytearray(content))], "batch_id string, file_name string, content binary")
    assert rows(csv_ranges.read_strict_csv_ranges(csv_ranges.cut(files, 1), files, "cp1252")) == rows(landing.read_strict_csv(files, "cp1252"))
    with pytest.raises(ValueError):
        csv_ranges.read_strict_csv_ranges(csv_ranges.cut(files), files, "utf-16")
