"""CSV files read in blocks against Spark's own reader of whole files."""

import random

import pytest

from rollcall.sources import list_csv, split_csv

PARTS = ["a", "b c", ",", ",", "\n", "\n", '"', '""', 'x"y', '"q"', '"line\nbreak"', '"a,b"', '"he said ""no"""', "é中", " "]
NAMES = [f"c{i}" for i in range(1, 6)]


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "60")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def written(folder, texts):
    folder.mkdir(exist_ok=True)
    for i, text in enumerate(texts):
        (folder / f"sanctions_cleaned_{i}.csv").write_bytes(text.encode())
    return f"{folder}/*.csv"


def by_file(records):
    """The records of each file in order."""
    out = {}
    for r in sorted(records.collect(), key=lambda r: (r.part, r.row)):
        out.setdefault(r.part, []).append(list(r.fields))
    return out


def closed(text):
    """The text, a last open quote closed: the readers differ in what they make of a file that ends in one."""
    import re

    field = r'(?:"[^"]*(?:""[^"]*)*"[^,\n]*|(?!")[^,\n]*)'
    rest = re.match(rf"(?:{field}[,\n])*", text).end()
    return text + '"' if re.match(r'"[^"]*(?:""[^"]*)*$', text[rest:]) else text


def regular(n, rng, end="\n"):
    rows = []
    for i in range(n):
        cell = rng.choice(['plain', f'"two\nlines {i}"', '"with "" and, comma"', "", '"\n\n"', f'"{"x" * rng.randrange(200)}"'])
        rows.append(f"{i},{cell},{rng.choice(['end', chr(34) + 'é' + chr(34)])}")
    return end.join(["c1,c2,c3", *rows]) + end


def test_regular_files(spark, tmp_path, small_blocks):
    rng = random.Random(1)
    texts = [regular(60, rng), regular(1, rng), "c1,c2\n", "", "﻿c1,c2\n1,2", regular(40, rng)[:-1], "c1\n" + "x\n" * 100, 'c1\n"' + "y\n" * 100 + '"\nz\n']
    paths = written(tmp_path / "csv", texts)
    assert by_file(list_csv.scan_split(spark, paths)) == by_file(list_csv.scan_records(spark, paths))
    lines = spark.read.option("lineSep", "\n").text(paths)
    assert lines.rdd.getNumPartitions() > 20
    got, want = (list_csv.read_list_csv(spark, paths, ["c1", "c2", "c3"], splittable=s).drop("row_pos").collect() for s in (True, False))
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 200


def test_line_ends_of_two_characters(spark, tmp_path, small_blocks):
    rng = random.Random(2)
    paths = written(tmp_path / "csv", ["c1,c2\r\n" + "".join(f'{i},"x,{"y" * rng.randrange(90)}"\r\n' for i in range(50)) + "\r\n"])
    assert by_file(list_csv.scan_split(spark, paths)) == by_file(list_csv.scan_records(spark, paths))


def test_quotes_anywhere(spark, tmp_path, small_blocks):
    """Stray quotes, quotes behind closed fields, blocks that begin inside a field."""
    rng = random.Random(3)
    texts = [closed("".join(rng.choices(PARTS, k=rng.randrange(1, 80)))) for _ in range(60)]
    paths = written(tmp_path / "csv", texts)
    want = {}
    for r in split_csv.split_records(spark, paths).collect():
        want.setdefault(r.part, []).append((r.row, r.record))
    for i, text in enumerate(texts):
        got = [r for _, r in sorted(next((v for k, v in want.items() if k.endswith(f"_{i}.csv")), []))]
        assert got == whole(text), text


def whole(text):
    """Records of a text, one character after the other."""
    out, held, quoted, start, k = [], "", False, True, 0
    while k < len(text):
        c = text[k]
        if quoted:
            if text[k : k + 2] == '""':
                held, k = held + '""', k + 2
                continue
            quoted = c != '"'
        elif c == '"' and start:
            quoted, start = True, False
        elif c == "\n":
            out, held, start, k = out + [held], "", True, k + 1
            continue
        else:
            start = c == ","
        held, k = held + c, k + 1
    return [r for r in out + [held] if r]


def test_many_tasks_and_no_shuffle_of_single_lines(spark, tmp_path, small_blocks):
    paths = written(tmp_path / "csv", ["c1,c2\n" + "".join(f"{i},{i}\n" for i in range(400))])
    lines = split_csv._lines(spark, paths)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert split_csv.block_starts(lines).count() > 30
