"""Check digits, and records of running text."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions import identifiers
from rollcall.operators import prose


def with_check(base, *weight_rows, tens=True):
    for weights in weight_rows:
        total = sum(int(d) * w for d, w in zip(base, weights))
        base += str(total % 10 if tens else total % 11 % 10)
    return base


def test_check_digits(spark):
    imo = [with_check(f"{n:06d}", identifiers.IMO_WEIGHTS) for n in (907437, 0, 999999, 123456)]
    ten = [with_check(f"{n:09d}", identifiers.INN_10_WEIGHTS, tens=False) for n in (770708389, 0, 123456789)]
    twelve = [with_check(f"{n:010d}", *identifiers.INN_12_WEIGHTS, tens=False) for n in (5001007322, 7, 9876543210)]
    right = [*imo, *ten, *twelve]
    wrong = [n[:-1] + str((int(n[-1]) + k) % 10) for n in right for k in range(1, 10)]
    odd = [None, "", "IMO", "12345678", "907437x", "٩٠٧٤٣٧٢"]
    rows = spark.createDataFrame([(n,) for n in [*right, *wrong, *odd]], "n string").select(
        "n", identifiers.is_imo(F.col("n")).alias("imo"), identifiers.is_inn(F.col("n")).alias("inn")).collect()
    for r in rows:
        assert (r.imo, r.inn) == (r.n in imo, r.n in ten or r.n in twelve), r.n


def test_kinds_told_by_check_digits(spark):
    inn, imo = with_check("770708389", identifiers.INN_10_WEIGHTS, tens=False), with_check("907437", identifiers.IMO_WEIGHTS)
    rows = [("Registration Number", inn, ("INN", True)), ("Registration Number", "7707083890", ("Registration Number", None)), ("INN", "77 07 08", ("INN", False)),
            ("Passport", f"IMO {imo}", ("IMO", True)), ("Registration Number", imo, ("Registration Number", None)), ("IMO", f"imo-{imo}", ("IMO", True)), ("IMO", imo[:-1], ("IMO", False))]
    if inn == "7707083890":
        rows[1] = ("Registration Number", "7707083891", ("Registration Number", None))
    df = spark.createDataFrame([r[:2] for r in rows], "kind string, number string").select(identifiers.identify(F.col("kind"), F.col("number")).alias("i")).collect()
    assert [(r.i.kind, r.i.verified) for r in df] == [r[2] for r in rows]


def records(spark, text):
    rows = prose.prose_rows(spark.createDataFrame([(1, text)], "k int, text string"), "text", "k").orderBy("row_no").collect()
    return [list(zip(r.header, r.cells)) for r in rows]


def test_prose_records(spark):
    text = ("Preamble born 1950.\r\n1. Ivan IVANOV (a.k.a. Vanya; alias Ivo), born on 5 Mar 1960. Place of birth: Omsk; passport 12 34.\r\n"
            "  2) Bank of the North. Registration no. 77-1, address: Main St. 5,\n Omsk. Reasons: supports it.\n\nNot part of it, born in Rome.\n3. Only a name\n")
    assert records(spark, text) == [
        [("Name", "Ivan IVANOV"), ("Aliases", "Vanya"), ("Aliases", "Ivo"), ("Date of birth", "5 Mar 1960"), ("Place of birth", "Omsk"), ("Passport", "12 34")],
        [("Name", "Bank of the North"), ("Registration Number", "77-1"), ("Address", "Main St. 5, Omsk"), ("Reasons", "supports it")],
        [("Name", "Only a name")],
    ]
    assert records(spark, "no numbers here, born 1960") == [] and records(spark, "") == [] and records(spark, None) == []


def test_words_that_hold_a_marker_begin_no_field(spark):
    assert records(spark, "1. Osborne Reborn Innsbruck IMOLA Sexton\n") == [[("Name", "Osborne Reborn Innsbruck IMOLA Sexton")]]


@settings(max_examples=15, deadline=None)
@given(st.text(alphabet="1.) \nborn\x01\x02a", max_size=60))
def test_prose_takes_any_text(spark, text):
    for r in records(spark, text):
        assert r[0][0] == "Name" and all(h in ("Name", *prose.MARKERS) for h, _ in r)
