"""What cannot be read is named, and the rest is read."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from rollcall.plans import jobs
from rollcall.sources import list_csv, readable
from tests.test_jobs import FEED, LIST, put


def packed(folder, name, text, cut=0):
    data = gzip.compress(text.encode())
    (folder / name).write_bytes(data[: len(data) - cut])


def test_damage():
    rng = random.Random(1)
    one, two = (gzip.compress(rng.randbytes(n)) for n in (5 << 20, 10))
    for data in (one, two, one + two, two + one, two + two + two, gzip.compress(b"")):
        assert readable.damage(data) is None
    for data in (one[:-1], one[:100], two[:-9], one + two[:-3], b"", b"plain text", one[:1000] + b"x" * 50 + one[1050:], two + b"junk"):
        assert readable.damage(data)


@pytest.mark.parametrize("splittable", [False, True])
def test_feed_names_broken_records_and_files(spark, tmp_path, splittable):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    broken = '<entity action="add"><names><name></entity>'
    put(folder, "a.xml", FEED.replace(" </entities>", f"{broken}</entities>"))
    packed(folder, "b.xml.gz", FEED.replace("<formattedFullName>A<", "<formattedFullName>Z<"))
    packed(folder, "c.xml.gz", FEED * 50, cut=40)
    table = jobs.land_feed(spark, f"{folder}/*", out, "d", splittable=splittable)
    assert sorted(r.Name for r in table.collect()) == ["A", 'D, "E"', 'D, "E"', "Z"]
    found = sorted((r.file.rsplit("/", 1)[1], r.reason, r.record is None) for r in jobs.landing_rejects(spark, out).collect())
    assert found == [("a.xml", "not well-formed", False), ("c.xml.gz", "cut off within its compressed data", True)]
    texts = [r.record for r in jobs.landing_rejects(spark, out, "sanctions_cleaned_d.csv").collect() if r.record]
    assert texts == [broken] if splittable else broken in texts[0]


def test_nothing_is_set_aside_of_good_files(spark, tmp_path):
    path, out = put(tmp_path, "f.xml", FEED), str(tmp_path / "out")
    jobs.land_feed(spark, path, out, "d")
    assert jobs.landing_rejects(spark, out).collect() == [] and not (tmp_path / "out" / "rejects").exists()


def test_full_list_names_broken_records_and_files(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    put(folder, "a.xml", LIST.replace("</ENTITIES>", "<ENTITY><FIRST_NAME>x</ENTITY></ENTITIES>").replace("</INDIVIDUALS>", "<INDIVIDUAL><A></INDIVIDUAL></INDIVIDUALS>"))
    packed(folder, "b.xml.gz", LIST, cut=30)
    people, groups = jobs.land_full_list(spark, f"{folder}/*", out, "s", F.lit("2025-07-30").cast("date"))
    assert people.count() == 2 and groups.count() == 1
    assert sorted(r.file.rsplit("/", 1)[1] for r in jobs.landing_rejects(spark, out).collect()) == ["a.xml", "a.xml", "b.xml.gz"]
    only = tmp_path / "only"
    only.mkdir()
    packed(only, "b.xml.gz", LIST, cut=30)
    assert jobs.land_full_list(spark, f"{only}/*", str(tmp_path / "out2"), "s", F.lit(None).cast("date")) == []
    assert jobs.landing_rejects(spark, str(tmp_path / "out2")).count() == 1


@pytest.mark.parametrize("splittable", [False, True])
def test_exports_name_unreadable_files(spark, tmp_path, splittable):
    put(tmp_path, "sanctions_cleaned_a.csv", "Name\nx\n")
    packed(tmp_path, "sanctions_cleaned_b.csv.gz", "Name\ny\n")
    packed(tmp_path, "sanctions_cleaned_c.csv.gz", "Name\nz\n" * 1000, cut=20)
    rows, bad = list_csv.read_exports(spark, [f"{tmp_path}/sanctions_cleaned*"], ("Name",), splittable=splittable)
    assert sorted(r.Name for r in rows.collect()) == ["x", "y"]
    assert [(r.src_file, r.record_no, r.reason) for r in bad.collect()] == [("sanctions_cleaned_c.csv.gz", None, "cut off within its compressed data")]
    (tmp_path / "only").mkdir()
    packed(tmp_path / "only", "sanctions_cleaned_c.csv.gz", "Name\nz\n" * 1000, cut=20)
    rows, bad = list_csv.read_exports(spark, [f"{tmp_path}/only/*"], ("Name",), splittable=splittable)
    assert (rows.count(), bad.count()) == (0, 1)
