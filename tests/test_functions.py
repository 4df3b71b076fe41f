import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallgrass.functions import api_from_parts, basin_of, county_of_fips, county_of_label, county_of_path, first_of_month, normalize_api, number, parsed_date, tx_api, well_status, well_type
from tallgrass.sources.files import bytes_text, delimiter, zip_entry

D = dt.date(2024, 1, 1)


@pytest.mark.parametrize(
    ("state", "value", "want"),
    [
        *(("NM", v, "30-015-12345") for v in ("3001512345", "01512345", "30 015-12345", "30-015-12345")),
        *(("NM", v, None) for v in (None, "", "1234567", "123456789012")),
        *(("OK", v, "35-017-12345") for v in ("3501712345", "01712345", "3501712345.0", "35.017.12345")),
        *(("TX", v, "42-123-45678") for v in ("12345678", "4212345678", "123-456-78")),
        *(("TX", v, None) for v in ("1234567", "123456789", "3012345678", "")),
    ],
)
def test_normalize_api(col, state, value, want):
    assert col([value], lambda v: normalize_api(v, state)) == [want]


def test_api_from_parts(spark):
    rows = [("30", "15", "12345"), ("30.0", "15.0", "12345.0"), (None, "15", "1"), ("abc", "1", "1"), ("100", "1", "1"), ("30", "15", "100000")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(api_from_parts(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["30-015-12345"] * 2 + [None] * 4


def test_tx_api(spark):
    df = spark.createDataFrame([("1", "23"), ("123", "45678"), (" ", "1"), ("1", None), ("1234", "5")], "a string, b string")
    assert [r[0] for r in df.select(tx_api(F.col("a"), F.col("b"))).collect()] == ["42-001-00023", "42-123-45678", None, None, "42-1234-00005"]


def test_codes(col):
    assert col(["SWD", " og ", "??", None], lambda v: well_type(v, "NM")) == ["INJ", "OIL", "OTHER", None]
    assert col(["T", "P", "producing"], lambda v: well_status(v, "NM")) == ["SHUT-IN", "P&A", "ACTIVE"]
    assert col(["OIL/GAS", "UIC", "DRY"], lambda v: well_type(v, "OK")) == ["OIL", "INJ", "OTHER"]
    assert col(["DRY", "TERMINATED"], lambda v: well_status(v, "OK")) == ["P&A", "INACTIVE"]
    assert col(["OL", None, "ZZ"], lambda v: well_type(v, "TX")) == ["OIL", "OTHER", "OTHER"]


def test_counties(col):
    assert col(["003-ADAIR", "Caddo"], county_of_label) == ["ADAIR", "CADDO"]
    assert col(["allwells_SanJuan", "allwells_Lea"], county_of_path) == ["SAN JUAN", "LEA"]
    assert col(["15", "45", "2"], county_of_fips) == ["EDDY", "SAN JUAN", None]
    assert col(["Eddy", "Bernalillo"], lambda v: basin_of(v, "NM")) == ["Permian", None]
    assert col(["Tulsa", "Le Flore"], lambda v: basin_of(v, "OK")) == [None, "Arkoma"]


def test_dates_and_numbers(spark, col):
    df = spark.createDataFrame([("2024", "1"), ("2024", "13"), ("bad", "6"), (None, "1")], "y string, m string")
    assert [r[0] for r in df.select(first_of_month(F.col("y"), F.col("m"))).collect()] == [D, None, None, None]
    assert col(["1,234.5", " 7 ", "abc", "", "N/A", "--", "NaN", None], number) == [1234.5, 7.0, None, None, None, None, None, None]
    df = spark.createDataFrame([("01/15/2024",), ("02/01/2024",), ("2024-03-01",)], "d string")
    assert [r[0] for r in df.select(parsed_date(df, "d")).collect()] == [D, dt.date(2024, 2, 1), None]


def test_file_rules():
    assert zip_entry(["x/readme.txt", "OG_LEASE_CYCLE_2.dsv", "d/og_lease_cycle.DSV"], "OG_LEASE_CYCLE") == "d/og_lease_cycle.DSV"
    assert zip_entry(["a_OG_LEASE_CYCLE_b.csv"], "OG_LEASE_CYCLE") == "a_OG_LEASE_CYCLE_b.csv"
    assert zip_entry(["a"], "b") is None
    assert delimiter("A|B|C", ("}", "|", ","), ["b"]) == "|"
    assert delimiter("abc", (",",), least=3) is None
    assert bytes_text(1536) == "1.5 KB"
