"""Golden cases of the column functions and record operators."""

import datetime
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions import csvtext, dates, labels, markdown, text
from rollcall.operators import answers, consolidate, documents, feed, full_list, links, reports
from rollcall.operators.small_tables import join_small
from rollcall.schemas import FEED_ENTITY, LIST_INDIVIDUAL
from rollcall.sources.xml import parse_column


def apply(spark, fn, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", fn(F.col("v")).alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def check(spark, fn, cases, kind="string"):
    assert apply(spark, fn, [c[0] for c in cases], kind) == [c[1] for c in cases]


def test_standardise_date(spark):
    check(spark, dates.standardise_date, [
        (None, ""), ("", ""), ("  ", ""), (" ", ""),
        ("5 Jan 1970", "5 Jan 1970"), ("12 Oct 1958 (approx)", "12 Oct 1958 (approx)"),
        ("12/10/1958", "12 Oct 1958"), ("2/13/1958", "13 Feb 1958"),
        ("12-10-1958", "12 Oct 1958"), ("12.10.1958", "12 Oct 1958"), ("12 10 1958", "12 Oct 1958"),
        ("12  10 1958", "12 Oct 1958"), ("1958-1-2", "02 Jan 1958"), ("1958/10/12", "12 Oct 1958"),
        (" 1958/10/12\n", "12 Oct 1958"), ("31/02/1958", "31/02/1958"), ("12/10/58", "12/10/58"),
        ("1958", "1958"), ("5 June 1970", "5 June 1970"), ("12-10/1958", "12-10/1958"),
        ("29/2/2024", "29 Feb 2024"), ("29/2/2023", "29/2/2023"), ("0/1/2023", "0/1/2023"),
        ("1/1/0000", "1/1/0000"), ("1958-10-12T00:00", "1958-10-12T00:00"),
    ])


FORMATS = ("%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d %m %Y")


def first_parse(s):
    for f in FORMATS:
        try:
            return datetime.datetime.strptime(s, f).strftime("%d %b %Y")
        except ValueError:
            pass
    return s


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.integers(0, 40), st.integers(0, 40), st.integers(1000, 2999),
    st.sampled_from("/-. "), st.booleans(), st.booleans()), min_size=20, max_size=60))
def test_dates_match_strptime(spark, parts):
    texts = []
    for a, b, y, sep, year_first, padded in parts:
        a, b = (f"{a:02d}", f"{b:02d}") if padded else (str(a), str(b))
        texts.append(sep.join((str(y), a, b) if year_first else (a, b, str(y))))
    got = apply(spark, dates.standardise_date, texts)
    assert got == [first_parse(t) for t in texts]


def test_standardising_twice_changes_nothing(spark):
    once = apply(spark, dates.standardise_date, ["1/2/1990", "x", None, "1990-1-2", "5 Jan 1970 ?"])
    assert apply(spark, dates.standardise_date, once) == once


def test_birth_fields(spark):
    cases = [
        (["01 Jan 1970"], ("01/01/1970", "1970")),
        (["1970-02-03"], ("03/02/1970", "1970")),
        (["circa 1965"], ("", "1965")),
        (["01 Jan 1970", "circa 1965"], ("01/01/1970", "1965")),
        (["unknown"], ("", "")), ([], ("", "")),
        (["1970-02-03", "unknown"], ("03/02/1970", "1970")),
        (["5   jAN 1970"], ("05/01/1970", "1970")), (["01 Jan 1970 "], ("", "1970")),
        (["31 Feb 1970"], ("", "1970")), (["between 1960 and 1961"], ("", "1960")),
        (["x19651"], ("", "")),
    ]
    values = [c[0] for c in cases]
    for i, part in enumerate((dates.birth_day, dates.birth_year)):
        got = apply(spark, lambda c: part(dates.dated_values(c)), values, "array<string>")
        assert got == [c[1][i] for c in cases]


def test_listing_and_generation_date(spark):
    check(spark, dates.listing_date, [
        (None, ""), ("", ""), ("2025-07-30", "30/07/2025"), ("2025-7-3", "03/07/2025"),
        ("30/07/2025", "30/07/2025"), ("2025-02-30", "2025-02-30"),
    ])
    fallback = F.lit("2024-01-01").cast("date")
    check(spark, lambda c: dates.generation_date(c, fallback).cast("string"), [
        ("2025-07-30T23:00:05.333Z", "2025-07-30"), ("2025-07-30T23:00:05+09:00", "2025-07-30"),
        (None, "2024-01-01"), ("", "2024-01-01"),
    ])


def test_watchlist(spark):
    check(spark, labels.standard_watchlist, [
        (None, "Unknown"), ("", "Unknown"), ("  ", ""), ("Unknown", "UN"),
        ("Council Decision 2024/1", "UN"), (fv.FEED_WATCHLIST, "OFAC"), ("US Treasury", "OFAC"),
        (" 2025/1578 ", "2025/1578"), ("Museum", "EU"), ("Local list", "Local list"),
        ("see 2024/9 annex", "see 2024/9 annex"),
    ])
    check(spark, lambda c: labels.standard_watchlist(c, strict=True), [
        ("Unknown", "Unknown"), ("the UN list", "UN"), ("Museum", "Museum"), ("eu", "EU"),
        ("Council Decision 2024/1", "Council Decision 2024/1"),
    ])


def test_labels_are_stable_but_for_unknown(spark):
    once = apply(spark, labels.standard_watchlist, ["ofac x", "2025/1", "Museum", "Local", "un"])
    assert apply(spark, labels.standard_watchlist, once) == once
    assert apply(spark, labels.standard_watchlist, ["Unknown"]) == ["UN"]


def test_regulation_number(spark):
    check(spark, labels.regulation_label, [
        ("202501578", "2025/1578"), ("202500395", "2025/395"), ("20250000", "EU"), ("2025015", "EU"),
        (None, "EU"), ("", "EU"), ("2025a1578", "EU"),
    ])


def test_file_label(spark):
    un, clean, reg = fv.LIST_SOURCE, "sanctions_cleaned_x.csv", "sanctions_from_202501578_t.csv"
    cases = [
        ("any", un, "anything", "UN"), (clean, None, fv.FEED_WATCHLIST, "OFAC"), (reg, None, None, "2025/1578"),
        (reg, None, "2024/9", "2024/9"), ("sanctions_from_abc_t.csv", None, None, "EU"), (clean, None, None, "Unknown"),
        (reg, "Ministry", "", "2025/1578"), (clean, None, "Local List", "Local List"),
    ]
    df = spark.createDataFrame(cases, "f string, s string, w string, want string")
    for r in df.withColumn("got", labels.file_label(F.col("f"), F.col("s"), F.col("w"))).collect():
        assert r["got"] == r["want"], r


def test_file_class(spark):
    check(spark, labels.file_class, [
        ("sanctions_from_un_t.csv", "pdf"), ("My_OFAC_un.csv", "ofac"), ("sanctions_cleaned_UN.csv", "un"),
        ("sanctions_cleaned_2025-07-30.csv", "other"), ("Sanctions_From_1.csv", "other"),
    ])


def test_transient_errors(spark):
    check(spark, labels.is_transient, [
        ("429", True), ("RESOURCE_EXHAUSTED now", True), ("Deadline passed", True), ("Rate-Limit", True),
        ("bad request 400", False), (None, False), ("http 5000", True),
    ])


def test_strip_is_unicode_aware(spark):
    blanks = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    check(spark, text.safe_text, [(f"{b}a b{b}", "a b") for b in blanks] + [(None, ""), ("​x", "​x")])


def test_readable_size(spark):
    check(spark, text.readable_size, [
        (0, "0B"), (1, "1.0B"), (1023, "1023.0B"), (1024, "1.0KB"), (1280, "1.2KB"), (1792, "1.8KB"),
        (1048576, "1.0MB"), (1024**3, "1.0GB"), (1024**4, "1024.0GB"), (None, None),
    ], "long")


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 2**45), min_size=30, max_size=80))
def test_sizes_match_python(spark, sizes):
    def shown(n):
        for unit in ("B", "KB", "MB"):
            if n < 1024:
                return f"{n:.1f}{unit}"
            n /= 1024.0
        return f"{n:.1f}GB"
    assert apply(spark, text.readable_size, sizes, "long") == [shown(n) for n in sizes]


def test_preview(spark):
    check(spark, text.preview, [("x" * 200, "x" * 200), ("é" * 201, "é" * 200 + "..."), ("", "")])


LINE_CHARS = st.sampled_from(list("ab \n\r\x0b\x0c\x1c\x1d\x1e\x85  \x1f"))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(LINE_CHARS, max_size=12), min_size=30, max_size=80))
def test_line_count_matches_splitlines(spark, texts):
    assert apply(spark, text.line_count, texts) == [len(t.splitlines()) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=200), min_size=5, max_size=30))
def test_encoding_round_trip(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in documents.decode(documents.encode_strings(df)).collect():
        assert r["success"] and r["decoded_content"] == texts[r["i"]]
        assert r["decoded_size_bytes"] == r["original_size_bytes"] == len(texts[r["i"]].encode())
        assert "\n" not in r["base64_content"]


def test_long_encodings_have_no_line_breaks(spark):
    assert apply(spark, lambda c: F.length(documents.to_base64(c)), ["a" * 100]) == [136]


def test_decode_failures(spark):
    df = spark.createDataFrame(
        [("YWJj",), ("YW Jj\n",), ("YWI",), ("YWI=",), ("/w==",), ("",)], "base64_content string"
    )
    got = [(r["success"], r["decoded_content"]) for r in documents.decode(df).collect()]
    assert got == [(True, "abc"), (True, "abc"), (False, None), (True, "ab"), (False, None), (True, "")]


def test_fences(spark):
    check(spark, text.strip_fences, [
        ("```csv\nA,B\n1,2\n```", "A,B\n1,2"), ("A,B", "A,B"), ("```csv  \nA\n``` \n", "A"),
        ("x ```csvA``` y", "x A``` y"),
    ])


def test_csv_records_and_fields(spark):
    check(spark, csvtext.csv_records, [
        ('a,b\r\n"x\ny",2\n\n3,"4"', ["a,b", '"x\ny",2', '3,"4"']), ("", []), ("a", ["a"]),
        ('a 5" pipe,b\nc', ['a 5" pipe,b', "c"]), ('"open,b\nc', ['"open,b', "c"]),
    ])
    check(spark, csvtext.csv_fields, [
        ('a,"b, ""c""",,', ["a", 'b, "c"', "", ""]), (",", ["", ""]), ('"x\ny"z', ["x\nyz"]),
        ('5" x,1', ['5" x', "1"]),
    ])


def test_long_quoted_fields_do_not_exhaust_the_stack(spark):
    long = '"' + ('x""y,\n' * 50_000) + '"'
    check(spark, lambda c: F.size(csvtext.csv_records(c)), [(f"h,i\n{long},2\n3,4", 3)])
    check(spark, lambda c: F.length(csvtext.csv_fields(c)[0]), [(f"{long},2", 50_000 * 5)])


def test_answers(spark):
    df = spark.createDataFrame(
        [("```csv\nType,Name,Unknown column\nEntity,\"A, B\",1\nNone,NaN,2\n```", "d.pdf")], "answer string, doc string"
    )
    rows = answers.answer_rows(df, "answer", "doc").orderBy("row_pos").collect()
    assert [(r["Name"], r["Type"], r["COUNTRY"], r["Source_File"]) for r in rows] == [
        ("A, B", "Entity", None, "d.pdf"), (None, None, None, "d.pdf")
    ]
    assert answers.check_answers(df, "answer").first().asDict() == {"header_fields": 3, "valid": False}
    good = spark.createDataFrame([(",".join(fv.FEED_COLUMNS),)], "answer string")
    assert answers.check_answers(good, "answer").first()["valid"]
    assert answers.answer_rows(good.withColumn("doc", F.lit("d")), "answer", "doc").count() == 0


def test_pipe_tables(spark):
    table = "x\n|a|b|\n|---|:-:|\n| 1 \\| 2 | |\n|3|4|\ny\n\n|no|table|\n"
    check(spark, lambda c: F.size(markdown.pipe_tables(c)), [(table, 1), ("", 0), ("|a|\n|-|", 1)])
    check(spark, markdown.pipe_cells, [("| 1 \\| 2 | |", ["1 | 2", ""]), ("a|b", ["a", "b"])])


def test_feed_records(spark):
    def entity(body, action="action='add'"):
        name = ("<names><name><isPrimary>true</isPrimary><translations><translation>"
                "<formattedFullName>N</formattedFullName></translation></translations></name></names>")
        return f"<entity {action}>{name}{body}</entity>"

    def one(body):
        df = spark.createDataFrame([(entity(body),)], "x string")
        return feed.flatten_feed(parse_column(df, "x", FEED_ENTITY, "entity")).first()

    def typed(code):
        return f"<generalInfo><entityType refId='{code}'>t</entityType></generalInfo>"

    def features(*pairs):
        return "<features>" + "".join(
            f"<feature><type featureTypeId='{t}'>f</type><value>{v}</value></feature>" for t, v in pairs
        ) + "</features>"

    assert [one(typed(c))["Type"] for c in (600, 601, 602, 603)] == ["Individual", "Entity", "Vessel", "Type 603"]
    assert (one("")["Type"], one("<generalInfo><entityType/></generalInfo>")["Type"]) == ("", "Type None")
    assert one(typed(602) + features((3, "Panama"), (10, "X")))["COUNTRY"] == "Panama"
    assert one(typed(602) + features((10, "X"), (10, "Y")))["COUNTRY"] == "X"
    land = "<addresses><address/><address><country>Z</country></address></addresses>"
    assert one(typed(600) + features((3, "Panama")) + land)["COUNTRY"] == "Z"
    docs = "".join(
        f"<identityDocument><type refId='{t}'>d</type><documentNumber>{n}</documentNumber></identityDocument>"
        for t, n in ((1571, "P1"), (1584, ""), (9, "P2"), (1626, "P3"))
    )
    r = one(f"<identityDocuments>{docs}</identityDocuments>")
    assert (r["ID_1"], r["ID_Type1"], r["ID_2"], r["ID_Type2"]) == ("P1", "Passport", "P2", "Doc Type 9")
    programs = "".join(f"<sanctionsProgram refId='{p}'/>" for p in (91901, 91902, 7))
    assert one(f"<sanctionsPrograms>{programs}</sanctionsPrograms>")["Other info"] == (
        "IRAN-EO13902; IRAN-EO13902; Program 7")
    assert [one(features((224, g)))["Gender"] for g in ("MALE", "Other")] == ["male", "Other"]
    assert set(one("").asDict().values()) == {"N", ""}


def test_list_values(spark):
    body = ("<INDIVIDUAL><FIRST_NAME> A </FIRST_NAME><SECOND_NAME/><THIRD_NAME>C</THIRD_NAME>"
            "<INDIVIDUAL_ALIAS><ALIAS_NAME>N</ALIAS_NAME><QUALITY>Good</QUALITY></INDIVIDUAL_ALIAS>"
            "<INDIVIDUAL_ALIAS><ALIAS_NAME>N</ALIAS_NAME><QUALITY/></INDIVIDUAL_ALIAS>"
            "<INDIVIDUAL_ALIAS><ALIAS_NAME/><QUALITY>Low</QUALITY></INDIVIDUAL_ALIAS>"
            "<INDIVIDUAL_DATE_OF_BIRTH><DATE>1970-01-01</DATE><YEAR>1970</YEAR></INDIVIDUAL_DATE_OF_BIRTH>"
            "<INDIVIDUAL_DATE_OF_BIRTH><YEAR>1971</YEAR></INDIVIDUAL_DATE_OF_BIRTH>"
            "<INDIVIDUAL_DATE_OF_BIRTH><NOTE>approx</NOTE></INDIVIDUAL_DATE_OF_BIRTH>"
            "<INDIVIDUAL_DATE_OF_BIRTH/></INDIVIDUAL>")
    df = spark.createDataFrame([(body,), ("<INDIVIDUAL></INDIVIDUAL>",)], "x string")
    parsed = parse_column(df, "x", LIST_INDIVIDUAL, "INDIVIDUAL")
    full, empty = full_list.flatten_individuals(parsed).collect()
    assert (full["Name"], full["Aliases"], full["Date_of_Birth"]) == (
        "A C", "N (Good); N", "1970-01-01; 1971; approx")
    assert empty["Name"] == "" and empty["Source"] == fv.LIST_SOURCE


ROWS = [(0, "f", 0, "b"), (0, "f", 1, None), (1, "g", 0, "b"), (1, "g", 1, "a"), (1, "g", 2, None)]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_keep_first_does_not_depend_on_partitions(spark, parts):
    df = spark.createDataFrame(ROWS, "src_rank int, src_file string, row_pos long, Name string").repartition(parts)
    kept = consolidate.sort_by_name(consolidate.keep_first(df)).collect()
    assert [(r["src_rank"], r["row_pos"], r["Name"]) for r in kept] == [(1, 1, "a"), (0, 0, "b"), (0, 1, None)]
    assert reports.duplicate_count(df).first().asDict() == {"total": 5, "duplicates": 2}


def test_hot_names_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr(
        "0 AS src_rank", "'f' AS src_file", "id AS row_pos", "CASE WHEN id > 300 THEN 'hot' ELSE 'n' || id END AS Name"
    )
    plan = consolidate.keep_first(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > plan.index("Exchange")
    assert consolidate.keep_first(df).count() == 302


def test_join_beyond_the_broadcast_bound(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id < 4000 THEN 'hot' ELSE 'k' || id % 50 END AS k", "id AS pos")
    small = df.select("k").distinct().withColumn("label", F.concat(F.lit("l-"), "k"))
    near, far = (join_small(df, small, "k", "pos", max_bytes=n) for n in (10_000, 50))
    assert near.count() == far.count() == 5000
    assert near.exceptAll(far.select(near.columns)).isEmpty()
    assert far.filter(F.col("label") != F.concat(F.lit("l-"), "k")).isEmpty()


def test_intermediate_tables_have_an_owner(spark):
    """They go when the caller says so, and only those; later work starts anew."""
    from rollcall.operators import small_tables

    kept = f"{small_tables.shared_folder(spark)}/rollcall/result"
    spark.range(3).write.mode("overwrite").parquet(kept)
    held = small_tables.materialise(spark.range(5))
    assert held.count() == 5
    small_tables.drop_intermediate(spark)
    with pytest.raises(Exception):
        held.collect()
    assert spark.read.parquet(kept).count() == 3 and small_tables.materialise(spark.range(2)).count() == 2


def test_reports(spark):
    df = spark.createDataFrame(
        [("Individual", "UN"), ("Individual", None), ("Entity", "EU"), (None, "EU")], "Type string, Watchlist string"
    )
    shares = {(r["column"], r["value"]): (r["n"], r["pct"]) for r in reports.distribution(df, "Type", "Watchlist").collect()}
    assert shares == {
        ("Type", "Individual"): (2, 50.0), ("Type", "Entity"): (1, 25.0),
        ("Watchlist", "UN"): (1, 25.0), ("Watchlist", "EU"): (2, 50.0),
    }
    assert [tuple(r) for r in reports.value_counts(df, "Type").collect()] == [("Type", "Individual", 2), ("Type", "Entity", 1)]
    top = reports.top_values(spark.range(30).selectExpr("'v' || id % 13 AS Watchlist"), "Watchlist").collect()
    assert len(top) == 11 and top[-1]["kind"] == "other values" and top[-1]["n"] == 3
    assert reports.top_values(df, "Type").filter("kind = 'other values'").isEmpty()


def test_run_totals(spark):
    log = spark.createDataFrame(
        [(True, 10, 2.0, 30.0), (True, 5, 4.0, 30.0), (False, None, None, 60.0)],
        "success boolean, records long, seconds double, elapsed double",
    )
    assert reports.run_totals(log).first().asDict() == {
        "files": 3, "succeeded": 2, "failed": 1, "records": 15, "seconds": 6.0, "seconds_per_file": 3.0,
        "records_per_file": 7.5, "files_per_minute": 1.5,
    }
    assert reports.run_totals(log.filter("false")).first()["seconds_per_file"] is None


PAGE = """<html><!-- <a href="/old/sanctions.xml">x</a> --><script>var a='<a href="/s/sanctions.xml">'</script>
<a name="top">no address</a><A class="b" HREF='/de'>Get the <b> XML </b>format</A>
<a href=list/Consolidated.XML?a=1&amp;b=2>all &amp; more</a><a href="/x/sanctions.xml">second</a></html>"""


def test_links(spark):
    page = spark.createDataFrame([(PAGE, "https://site.org/en/list/?q=1#top")], "html string, url string")
    found = [(r["href"], r["text"]) for r in links.page_links(page, "html").orderBy("pos").collect()]
    assert found == [("/de", "Get theXMLformat"), ("list/Consolidated.XML?a=1&b=2", "all & more"),
                     ("/x/sanctions.xml", "second")]
    best = links.best_link(page, "html", "url").first()
    assert tuple(best) == ("https://site.org/en/list/list/Consolidated.XML?a=1&b=2", "href")
    by_text = page.withColumn("html", F.lit('<a href="get">Download XML</a>'))
    assert tuple(links.best_link(by_text, "html", "url").first()) == ("https://site.org/en/list/get", "text")
    none = page.withColumn("html", F.lit("<a href='/a'>b</a>"))
    assert tuple(links.best_link(none, "html", "url").first()) == (None, None)
    assert [r["text"] for r in links.missed_report(none, "html", "url").collect()] == ["b"]
    assert links.missed_report(page, "html", "url").isEmpty()


def test_resolve_like_urljoin(spark):
    from urllib.parse import urljoin

    base = "https://site.org/a/b/c.html?q=1#f"
    hrefs = ["x.xml", "./x", "../x", "../../x", "../../../x", "d/../x/.", "x/..", "?k=v", "#g",
             "http://o.net/x", "mailto:a@b", "x?u=../v"]
    got = apply(spark, lambda c: links.resolve(c, F.lit(base)), hrefs)
    assert got == [urljoin(base, h) for h in hrefs]
    assert apply(spark, lambda c: links.resolve(c, F.lit(base)), ["/x", "//o.net/x"]) == [
        "https://site.org/x", "https://site.org//o.net/x"]


def test_contracts():
    assert len(fv.FEED_COLUMNS) == 17 and len(fv.LIST_COLUMNS) == 13
    assert json.loads(json.dumps(fv.PROGRAMS))["91902"] == fv.PROGRAMS["91901"]


def test_long_tags_and_unclosed_openers(spark):
    """A tag of a megabyte, and a page of openers that nothing closes, in linear time."""
    from rollcall.operators.links import anchors

    rows = [("<a data-x=" + "y" * 1_000_000 + " href='long'>t</a>",), ("<a href=x>t</a>" + "<script" * 150_000,), ("<!--" * 250_000,)]
    got = spark.createDataFrame(rows, "html string").select(anchors(F.col("html")).alias("a")).collect()
    assert [[x.href for x in r.a] for r in got] == [["long"], ["x"], []]
