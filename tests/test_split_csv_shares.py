"""How the lines of a large file are dealt, and records that run through many runs."""

import pytest
from pyspark.sql import functions as F

from rollcall.sources import list_csv, split_csv


@pytest.fixture
def short_lines(spark, tmp_path):
    """One block of many short lines, some of them inside fields longer than a run."""
    n = split_csv.RUN_LINES if hasattr(split_csv, "RUN_LINES") else 4096
    records = ["c1,c2", *("a,b" for _ in range(n // 2)), 'x,"' + "\n".join(["1"] * (2 * n + 5)) + '"', *("c,d" for _ in range(n)),
               '"' + "\n" * (n + 1) + '",e', *(f'{i},"p\nq"' for i in range(n)), 'y,"""' + "\n,\n" * n + '"""', "last,one"]
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "sanctions_cleaned_a.csv").write_text("\n".join(records) + "\n")
    (folder / "sanctions_cleaned_b.csv").write_text("c1\n1\n")
    return f"{folder}/*.csv", records, n


def test_no_window_holds_a_block(spark, short_lines):
    paths, records, n = short_lines
    starts = split_csv.block_starts(split_csv._lines(spark, paths))
    # A row for every run: a block has many, of which none is larger than a window may hold.
    assert starts.filter(F.col("part").contains("_a.")).count() >= sum(r.count("\n") + 1 for r in records) // n


def test_lines_are_dealt_in_shares(spark, short_lines, monkeypatch):
    paths, _, _ = short_lines
    monkeypatch.setattr(split_csv, "SHARE_BYTES", 4_000, raising=False)
    lines = split_csv._lines(spark, paths)
    sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < sum(sizes) / 2


def test_records_through_many_runs(spark, short_lines):
    paths, records, _ = short_lines
    got = split_csv.split_records(spark, paths).orderBy("part", "row").collect()
    assert [r.record for r in got if "_a." in r.part] == records
    assert [(r.row, r.record) for r in got if "_b." in r.part] == [(0, "c1"), (1, "1")]
    # A row is the number of the record's first line in its file.
    places = [sum(r.count("\n") + 1 for r in records[:k]) for k in (0, 1, 2, len(records) - 1)]
    own = [r.row for r in got if "_a." in r.part]
    assert [own[k] for k in (0, 1, -1)] == [places[0], places[1], places[-1]]


def test_rejects_name_their_line(spark, tmp_path):
    (tmp_path / "sanctions_cleaned_a.csv").write_text("c1\n1\n2,3\n")
    _, rejects = list_csv.read_exports(spark, f"{tmp_path}/*.csv", ["c1"], splittable=True)
    assert [(r.record_no, r.n_fields) for r in rejects.collect()] == [(2, 2)]
