"""Scans, sinks and whole jobs over files."""

import pytest
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.operators import consolidate, documents, reports
from rollcall.plans import jobs
from rollcall.sources import documents as document_files
from rollcall.sources import list_csv, xml

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<sanctionsData xmlns="https://www.treasury.gov/ofac/DeltaFile/1.0">
 <entities>
  <entity action="add" id="1">
   <generalInfo><entityType refId="602">Vessel</entityType></generalInfo>
   <names>
    <name><isPrimary>true</isPrimary><translations>
      <translation><formattedFullName>A</formattedFullName></translation>
      <translation><formattedFullName>B</formattedFullName></translation></translations></name>
    <name><isPrimary>false</isPrimary><translations>
      <translation><formattedFullName>C</formattedFullName></translation></translations></name>
   </names>
   <features>
    <feature><type featureTypeId="3">Flag</type><value>Panama</value></feature>
    <feature><type featureTypeId="10">Nationality</type><value>X</value></feature>
   </features>
   <sanctionsLists><sanctionsList datePublished="2025-07-30">SDN</sanctionsList></sanctionsLists>
  </entity>
  <entity action="delete"><names><name><isPrimary>true</isPrimary><translations>
     <translation><formattedFullName>gone</formattedFullName></translation></translations></name></names></entity>
  <entity><names><name><isPrimary>true</isPrimary><translations>
     <translation><formattedFullName>no action</formattedFullName></translation></translations></name></names></entity>
  <entity action="add"/>
  <entity action="add"><names><name><isPrimary>true</isPrimary><translations>
     <translation><formattedFullName>D, "E"</formattedFullName></translation></translations></name></names></entity>
 </entities>
</sanctionsData>
"""

LIST = """<?xml version="1.0"?>
<CONSOLIDATED_LIST dateGenerated="2025-07-30T23:00:05.333Z">
 <INDIVIDUALS>
  <INDIVIDUAL><FIRST_NAME> A </FIRST_NAME><SECOND_NAME></SECOND_NAME><THIRD_NAME>C</THIRD_NAME>
   <LISTED_ON>2025-07-30</LISTED_ON>
   <INDIVIDUAL_ADDRESS><CITY>C</CITY><COUNTRY>K</COUNTRY><NOTE>n</NOTE></INDIVIDUAL_ADDRESS>
   <INDIVIDUAL_ADDRESS><NOTE>only a note</NOTE></INDIVIDUAL_ADDRESS></INDIVIDUAL>
  <INDIVIDUAL><FIRST_NAME>yesterday</FIRST_NAME><LISTED_ON>2025-7-29</LISTED_ON></INDIVIDUAL>
  <INDIVIDUAL><FIRST_NAME>old</FIRST_NAME><LISTED_ON>2025-07-28</LISTED_ON></INDIVIDUAL>
  <INDIVIDUAL><FIRST_NAME>later</FIRST_NAME><LISTED_ON>2025-07-31</LISTED_ON></INDIVIDUAL>
  <INDIVIDUAL><FIRST_NAME>slashes</FIRST_NAME><LISTED_ON>30/07/2025</LISTED_ON></INDIVIDUAL>
  <INDIVIDUAL><FIRST_NAME>blank</FIRST_NAME><LISTED_ON> 2025-07-30</LISTED_ON></INDIVIDUAL>
  <INDIVIDUAL><FIRST_NAME>missing</FIRST_NAME></INDIVIDUAL>
 </INDIVIDUALS>
 <ENTITIES>
  <ENTITY><FIRST_NAME>Org</FIRST_NAME><LISTED_ON>2025-07-29</LISTED_ON>
   <ENTITY_ALIAS><ALIAS_NAME>N</ALIAS_NAME><QUALITY>Good</QUALITY></ENTITY_ALIAS>
   <ENTITY_ALIAS><ALIAS_NAME>M</ALIAS_NAME><QUALITY/></ENTITY_ALIAS></ENTITY>
 </ENTITIES>
</CONSOLIDATED_LIST>
"""


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8", newline="")
    return str(folder / name)


@pytest.mark.parametrize("splittable", [False, True])
def test_feed_file(spark, tmp_path, splittable):
    path = put(tmp_path, "feed.xml", FEED)
    table = jobs.land_feed(spark, path, str(tmp_path / "out"), "2025-07-30", splittable=splittable)
    rows = {r["Name"]: r.asDict() for r in table.collect()}
    assert set(rows) == {"A", 'D, "E"'}
    a = rows["A"]
    assert (a["Aliases"], a["Type"], a["COUNTRY"], a["Nationality"]) == ("C", "Vessel", "Panama", "X")
    assert a["Date of listing"] == "30/07/2025"
    assert list(a) == list(fv.FEED_COLUMNS)


def test_empty_feed_writes_nothing(spark, tmp_path):
    path = put(tmp_path, "feed.xml", "<x><entities></entities></x>")
    assert jobs.land_feed(spark, path, str(tmp_path / "out"), "d") is None
    assert not (tmp_path / "out").exists()


def test_split_reader_equals_xml_reader(spark, tmp_path):
    plain = FEED.replace('<entity action="add"/>', "")
    body = plain[plain.index("  <entity action"):plain.index(" </entities>")]
    path = put(tmp_path, "big.xml", plain.replace(body, body * 400))
    whole = xml.read_feed(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split = xml.read_feed(spark, path, splittable=True)
        assert split.rdd.getNumPartitions() > 5
        named = "_action", "names.name.translations.translation"
        counts = [
            {tuple(map(str, r)) for r in df.groupBy(*[F.col(c).cast("string") for c in named]).count().collect()
             if r[1] is not None}
            for df in (whole, split)
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert counts[0] == counts[1] and any("400" in c for c in counts[0])


def test_corrupt_records_are_set_aside(spark, tmp_path):
    good, bad = "<a><entity action='add'></entity>", "<entity action='add'><names></entity></a>"
    path = put(tmp_path, "f.xml", good + bad)
    records, broken = xml.split_corrupt(xml.read_feed(spark, path, quarantine=True).cache())
    assert records.count() == 1 and broken.count() == 1


@pytest.mark.parametrize("splittable", [False, True])
def test_full_list_file(spark, tmp_path, splittable):
    path = put(tmp_path, "list.xml", LIST)
    out = str(tmp_path / "out")
    people, groups = jobs.land_full_list(
        spark, path, out, "20250730_230005", F.lit("2025-07-30").cast("date"), splittable=splittable
    )
    assert sorted(r["Name"] for r in people.collect()) == ["A C", "yesterday"]
    a = people.filter("Name = 'A C'").first()
    assert (a["Addresses"], a["Source"], a["Listed_On"]) == ("C, K (n)", fv.LIST_SOURCE, "2025-07-30")
    assert [r["Aliases"] for r in groups.collect()] == ["N (Good); M"]


def dated_list(root, name, listed, day=None):
    stamp = f" dateGenerated='{day}T10:00:00Z'" if day else ""
    person = f"<INDIVIDUAL><FIRST_NAME>{name}</FIRST_NAME><LISTED_ON>{listed}</LISTED_ON></INDIVIDUAL>"
    return f"<?xml version='1.0'?><!-- dateGenerated='1999-01-01' --><{root}{stamp}><INDIVIDUALS>{person}</INDIVIDUALS></{root}>"


@pytest.mark.parametrize("splittable", [False, True])
def test_generation_date_of_each_file(spark, tmp_path, splittable):
    put(tmp_path, "a.xml", dated_list("LIST", "old", "2020-05-05", "2020-05-06"))
    put(tmp_path, "b.xml", dated_list("CONSOLIDATED_LIST", "new", "2025-07-30", "2025-07-30"))
    put(tmp_path, "c.xml", dated_list("LIST", "undated", "2024-01-02"))
    put(tmp_path, "d.xml", dated_list("LIST", "past", "2024-01-02", "2025-07-30"))
    today = F.lit("2024-01-02").cast("date")
    people, groups = jobs.recent_list(spark, f"{tmp_path}/*.xml", today, splittable=splittable)
    assert sorted(r["Name"] for r in people.collect()) == ["new", "old", "undated"]
    assert groups.count() == 0


def test_split_reads_self_closed_records(spark, tmp_path):
    text = "<a><entity action='x'/><entity/><entity action='y'></entity> <entity action='z' /></a>"
    path = put(tmp_path, "f.xml", text)
    whole, split = (
        sorted(map(str, xml.read_feed(spark, path, splittable=s).collect())) for s in (False, True)
    )
    assert whole == split and len(split) == 4


NAMED = "<names><name><isPrimary>{}</isPrimary></name></names>"
TAGS = [
    "<n:entity></n:entity>", "<entity action='1'></entity >", "<!-- <entity></entity> -->", "<entity action='2'><x><![CDATA[</entity>]]></x></entity>",
    "<!-- <entity> --><entity action='3'></entity>", f"<entity action='4'>{NAMED.format('<![CDATA[a<b & </entity> <entity>]]> &amp; c')}</entity>",
    "<entity\n action='5'></entity\n>", "<entity action='6'><!-- </entity> --><names/></entity>", "<n:entity action='7'><n:names/></n:entity><entity action='8'/>",
    "<![CDATA[ <!-- ]]><entity action='10'></entity>",
    "<!-- </entity></entity></entity> --><entity action='11'></entity><!-- </entity>--><entity action='12'></entity>",
    "<entity action='13'></entity>--><entity action='14'></entity>",
]


@pytest.mark.parametrize("texts", [*[[t] for t in TAGS], TAGS, TAGS[::-1], TAGS * 5])
def test_split_follows_prefixes_comments_and_cdata(spark, tmp_path, texts):
    path = put(tmp_path, "f.xml", f"<a xmlns:n='urn:n'>{' '.join(texts)}</a>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "150")
    try:
        whole, split = (sorted(map(str, xml.read_feed(spark, path, splittable=s).collect())) for s in (False, True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert split == whole


@pytest.mark.parametrize("text", ["<![CDATA[ --> </entity> <!-- ]]>", "<!-- </entity> <entity> <![CDATA[ -->"])
def test_split_fails_on_sections_within_each_other(spark, tmp_path, text):
    path = put(tmp_path, "f.xml", f"<a><entity></entity>{text}<entity></entity></a>")
    with pytest.raises(Exception, match="splittable=False"):
        xml.read_feed(spark, path, splittable=True).collect()


def test_split_moves_no_piece_without_need(spark, tmp_path):
    path = put(tmp_path, "f.xml", "<a>" + "<entity action='1'><!-- a --></entity>" * 50 + "</a>")
    split = xml.read_feed(spark, path, splittable=True)
    assert split.count() == 50 and "Exchange" not in split._jdf.queryExecution().executedPlan().toString()


def exports(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "sanctions_cleaned_a.csv",
        "﻿Name,Watchlist,DOB_DJ,Extra\r\n"
        "b,OFAC - Specially Designated National List,12/10/1958,x\r\n"
        ",,None,\r\n")
    put(folder, "sanctions_cleaned_un.csv",
        'Type,Name,Source\nIndividual,"q ""r"",\ns",UN Security Council\nEntity,N/A,UN Security Council\n')
    put(folder, "sanctions_from_202501578_t.csv", "Name,Type\nb,Entity\na,Entity\nnull,Vessel\n")
    put(folder, "sanctions_from_202500395_t.csv", "Name,Type\n")
    put(folder, "sanctions_from_1_t.csv", "")
    put(folder, "sanctions_from_2_t.csv", "Name,Type\nwide,Entity,too many\n")
    put(folder, "unrelated.csv", "Name\nz\n")
    return str(folder)


def test_csv_scan(spark, tmp_path):
    paths = list_csv.list_exports(spark, exports(tmp_path))
    rows = list_csv.read_list_csv(spark, paths, ("Name", "Type", "Watchlist", "Source", "DOB_DJ"))
    got = sorted(map(str, ((r["src_file"], r["Name"], r["Type"], r["Source"], r["DOB_DJ"], r["src_rank"])
                           for r in rows.collect())))
    un = "UN Security Council"
    assert got == sorted(map(str, [
        ("sanctions_cleaned_a.csv", "b", None, None, "12/10/1958", 0),
        ("sanctions_cleaned_a.csv", None, None, None, None, 0),
        ("sanctions_cleaned_un.csv", 'q "r",\ns', "Individual", un, None, 0),
        ("sanctions_cleaned_un.csv", None, "Entity", un, None, 0),
        ("sanctions_from_202501578_t.csv", "b", "Entity", None, None, 1),
        ("sanctions_from_202501578_t.csv", "a", "Entity", None, None, 1),
        ("sanctions_from_202501578_t.csv", None, "Vessel", None, None, 1),
    ]))
    bad = list_csv.read_exports(spark, paths)[1].collect()
    assert [(r["src_file"], r["record_no"], r["n_fields"], r["n_header"], r["record"]) for r in bad] == [
        ("sanctions_from_2_t.csv", 1, 3, 2, '["wide","Entity","too many"]')
    ]


def names_read(spark, folder):
    rows, bad = list_csv.read_exports(spark, list_csv.list_exports(spark, str(folder)), ("Name", "Type"))
    return sorted((r["src_file"], r["Name"]) for r in rows.collect()), bad


def test_a_bad_record_leaves_the_others(spark, tmp_path):
    put(tmp_path, "sanctions_cleaned_a.csv", 'Name,Type\nx,1\n"p\nq",Entity,,\n\n\ny\nz,2\n')
    rows, bad = names_read(spark, tmp_path)
    assert rows == [("sanctions_cleaned_a.csv", n) for n in "xyz"]
    assert [(r["record_no"], r["n_fields"], r["record"]) for r in bad.collect()] == [
        (2, 4, '["p\\nq","Entity","",""]')
    ]


def test_repacked_files_keep_headers_out(spark, tmp_path):
    """A scan that deals out files otherwise by the time it runs reads the same rows."""
    for i in range(7):
        put(tmp_path, f"sanctions_cleaned_{i}.csv", "Name,Type\n" + "".join(f"n{i}{j},t\n" for j in range(3)))
    want = [(f"sanctions_cleaned_{i}.csv", f"n{i}{j}") for i in range(7) for j in range(3)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    try:
        rows, _ = list_csv.read_exports(spark, list_csv.list_exports(spark, str(tmp_path)), ("Name",))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
        assert sorted((r["src_file"], r["Name"]) for r in rows.collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_export_names_come_from_their_own_path_part(spark, tmp_path):
    folder = tmp_path / "sanctions_from_eu" / "in"
    folder.mkdir(parents=True)
    for name in ("sanctions_cleaned_a b%.csv", "sanctions_from_1+2_t.csv"):
        put(folder, name, "Name\nx\n")
    assert names_read(spark, folder)[0] == [
        ("sanctions_cleaned_a b%.csv", "x"), ("sanctions_from_1+2_t.csv", "x")
    ]


def test_wide_exports(spark, tmp_path):
    """Columns far beyond a parser's usual width are still found by name."""
    names = [f"x{i}" for i in range(30_000)] + ["Name"]
    put(tmp_path, "sanctions_cleaned_w.csv", ",".join(names) + "\n" + "," * 30_000 + "far\n")
    put(tmp_path, "sanctions_cleaned_n.csv", "Name\nnear\n")
    rows = list_csv.read_list_csv(spark, list_csv.list_exports(spark, str(tmp_path)), ("Name",))
    assert sorted(r["Name"] for r in rows.collect()) == ["far", "near"]


def test_consolidate_directory(spark, tmp_path):
    done = jobs.consolidate_directory(spark, exports(tmp_path), str(tmp_path / "out"))
    got = [(r["Name"], r["Watchlist"], r["DOB_DJ"]) for r in done.table.collect()]
    assert got == [
        ("a", "2025/1578", None), ("b", "OFAC", "12 Oct 1958"),
        ('q "r",\ns', "UN", None), (None, "OFAC", None),
    ]
    summary = {(r["metric"], r["item"]): r["n"] for r in done.summary.collect()}
    assert summary[("total_records", None)] == 4
    assert summary[("duplicate_removed", None)] == 3
    assert summary[("processing_breakdown", "pdf_records")] == 3
    assert summary[("processing_breakdown", "un_records")] == 2
    assert summary[("processing_breakdown", "other_records")] == 2
    assert summary[("watchlist_distribution", "OFAC")] == 2
    assert done.converted_dates.first()[0] == 1
    assert [(r["src_file"], r["part"].endswith("/sanctions_from_2_t.csv"), r["record_no"]) for r in done.rejects.collect()] == [
        ("sanctions_from_2_t.csv", True, 1)
    ]
    assert {(r["column"], r["value"], r["pct"]) for r in done.shares.collect()} >= {("Watchlist", "OFAC", 50.0)}
    before, after = (
        {r["value"]: r["n"] for r in df.collect()} for df in (done.labels_before, done.labels_after)
    )
    assert before == after == {"OFAC": 2, "UN": 2, "2025/1578": 3}


def test_converted_dates_are_counted_before_the_dedupe(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "sanctions_cleaned_a.csv", "Name,DOB_DJ\na,12/10/1958\na,13/10/1958\nb,\n")
    done = jobs.consolidate_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert done.table.count() == 2 and done.converted_dates.first()[0] == 2


def test_answers_reach_the_consolidation_of_their_folder(spark, tmp_path):
    folder = str(tmp_path / "in")
    put_in = spark.createDataFrame([("x", "OFAC l")], "Name string, Watchlist string")
    list_csv.write_list_csv(put_in, f"{folder}/sanctions_cleaned_d.csv")
    replies = spark.createDataFrame(
        [("```csv\nName,Type\nb,Entity\n\"c, d\",None\n```", "202501578.pdf"), ("Name\nold\n", "a b.pdf"), (None, "n.pdf")],
        "answer string, doc string",
    )
    for some in (replies, replies.filter("doc = 'a b.pdf'").withColumn("answer", F.lit("Name\nnew\n"))):
        jobs.land_answers(spark, some, "answer", "doc", folder, "t")
    assert names_read(spark, folder)[0] == [
        ("sanctions_cleaned_d.csv", "x"), ("sanctions_from_202501578_t.csv", "b"),
        ("sanctions_from_202501578_t.csv", "c, d"), ("sanctions_from_a b_t.csv", "new"),
    ]
    done = jobs.consolidate_directory(spark, folder, str(tmp_path / "out"))
    assert {(r["Name"], r["Watchlist"]) for r in done.table.collect()} >= {("x", "OFAC"), ("b", "2025/1578")}


def test_many_answers_land_in_few_files(spark, tmp_path):
    folder = str(tmp_path / "in")
    answers = spark.range(100_000, numPartitions=8).selectExpr("concat('Name,Type\n\"n ', id, '\",Entity\n') AS answer", "concat('d', id, '.pdf') AS doc")
    jobs.land_answers(spark, answers, "answer", "doc", folder, "t")
    assert len(list((tmp_path / "in").rglob("*.parquet"))) <= 8
    rows, bad = names_read(spark, folder)
    assert len(rows) == 100_000 and rows[0] == ("sanctions_from_d0_t.csv", "n 0") and bad.isEmpty()


def test_exports_written_by_spark_are_one_file_each(spark, tmp_path):
    """A landed export is a directory of parts; it is labelled as one file."""
    folder = str(tmp_path / "in")
    rows = spark.createDataFrame(
        [("x", "OFAC list"), ("y", None), ("z", None)], "Name string, Watchlist string"
    ).repartition(3)
    list_csv.write_list_csv(rows.sortWithinPartitions("Name"), f"{folder}/sanctions_cleaned_d.csv")
    read = list_csv.read_list_csv(spark, list_csv.list_exports(spark, folder), ("Name", "Watchlist"))
    assert sorted(r["Name"] for r in read.collect()) == ["x", "y", "z"]
    assert {r["src_file"] for r in read.collect()} == {"sanctions_cleaned_d.csv"}


def test_missing_exports(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.consolidate_directory(spark, str(tmp_path), str(tmp_path / "out"))


def test_interactive_job(spark, tmp_path):
    first = spark.createDataFrame([("b", 0), ("c", 1)], "Name string, row_pos long")
    second = spark.createDataFrame([("b", "Entity", 0), ("a", "Entity", 1)], "Name string, Type string, row_pos long")
    data, sheet = jobs.consolidate_sources(
        str(tmp_path / "out"), 1, ("up.pdf", first), (fv.FEED_SOURCE_TAG, second)
    )
    assert {(r["Name"], r["Source_File"]) for r in data.collect()} == {
        ("b", "up.pdf"), ("c", "up.pdf"), ("a", "OFAC_API")
    }
    assert {r["Metric"]: r["Value"] for r in sheet.collect()} == {
        "Total Records": 3, "Files Processed": 1, "Duplicates Removed": 1, "Data Sources": 2,
    }


def test_documents_directory(spark, tmp_path):
    folder = tmp_path / "docs"
    (folder / "sub").mkdir(parents=True)
    put(folder, "one.md", "a\r\nb\rc")
    put(folder, "two.txt", "x" * 100)
    put(folder, "three.pdf", "no")
    put(folder / "sub", "four.md", "no")
    (folder / "bad.markdown").write_bytes(b"\xff\xfe\xfa")
    results, counts = jobs.encode_directory(spark, str(folder), str(tmp_path / "out"))
    assert counts.first().asDict() == {
        "total_files": 3, "successful_conversions": 2, "failed_conversions": 1
    }
    assert [r["error"] for r in results.filter("NOT success").collect()] == [
        "Encoding error: not valid UTF-8"
    ]
    meta = {r["file_name"]: r for r in spark.read.json(str(tmp_path / "out/metadata")).collect()}
    assert set(meta) == {"one.md", "two.txt"}
    one = meta["one.md"]
    assert (one["file_size_bytes"], one["original_lines"], one["base64_size"]) == (6, 3, 8)
    assert (one["base64_file"], one["metadata_file"]) == ("one_base64.txt", "one_metadata.json")
    saved = spark.read.parquet(str(tmp_path / "out/base64")).filter("success").drop("success")
    back = {r["base64_file"]: r["decoded_content"] for r in documents.decode(saved).collect()}
    assert back == {"one_base64.txt": "a\nb\nc", "two_base64.txt": "x" * 100}


def test_inventory(spark, tmp_path):
    import os
    for i, (name, size) in enumerate([("a_1.csv", 10), ("a_2.csv", 30), ("b_1.csv", 5)]):
        os.utime(put(tmp_path, name, "x" * size), (1_700_000_000 + i, 1_700_000_000 + i))
    files = document_files.read_inventory(spark, str(tmp_path), "*.csv").withColumn(
        "family", F.left("file_name", F.lit(1))
    )
    assert "content" not in files.columns
    total = documents.inventory_totals(files).first()
    assert (total["files"], total["total_bytes"]) == (3, 45)
    newest = {r["family"]: r["file_name"] for r in documents.latest_file(files, "family").collect()}
    assert newest == {"a": "a_2.csv", "b": "b_1.csv"}


def test_answers_join_the_consolidation(spark, tmp_path):
    replies = spark.createDataFrame(
        [("```csv\nName,Type\nb,Entity\nc,None\n```", "202501578.pdf")], "answer string, doc string"
    )
    rows = jobs.land_answers(spark, replies, "answer", "doc", str(tmp_path), "t")
    listed = spark.createDataFrame(
        [("b", "OFAC x", 0)], "Name string, Watchlist string, row_pos long"
    )
    united = consolidate.unite(consolidate.tag_source(listed, 0, "sanctions_cleaned_d.csv", "row_pos"), rows)
    final = consolidate.consolidate(united)
    assert [(r["Name"], r["Watchlist"], r["Type"]) for r in final.collect()] == [
        ("b", "OFAC", None), ("c", "2025/1578", None)
    ]
    assert reports.duplicate_count(united).first()["duplicates"] == 1


def test_distinct_input_files(spark):
    files = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("a.pdf",)], "path string")
    assert files.distinct().count() == 2
