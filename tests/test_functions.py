"""Column functions against literal expectations (FIXTURES, SURVEY §2.9 / §2.14)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import one
from quayside.functions import dates, strings, values

X = "x"


def test_strip_special_keeps_ampersand_parens_accents(spark):
    assert one(spark, strings.strip_special(X), "A–B-C/D (x) & é") == "ABCD (x) & é"
    assert one(spark, strings.strip_special(X), "a~!@#$%^*\"'?,.|_{}[]/:;b+\\") == "ab+\\"


def test_plus_concat_null_propagates_tsql_concat_does_not(spark):
    assert one(spark, strings.plus_concat(X, F.lit("/x")), None) is None
    assert one(spark, strings.tsql_concat(X, F.lit("/x")), None) == "/x"


@pytest.mark.parametrize("raw,clean", [("a@x.y; b@x.y;", "a@x.y;b@x.y"), ("a;;", "a;"), ("a", "a"), (";", "")])
def test_clean_contacts(spark, raw, clean):
    assert one(spark, strings.clean_contacts(X), raw) == clean


def test_split_recipients_keeps_empty_items(spark):
    assert one(spark, strings.split_recipients(X), "a;;b") == ["a", "", "b"]


@pytest.mark.parametrize("path,truck,ocean", [
    ("R/Shipments/C/1-N/Ocean/BK1", None, "BK1"),
    ("R/Shipments/C/Ocean", None, None),
    ("R/Truck/C/Ocean/BK2", "C", "BK2"),
    ("Ocean/A/Ocean/B", None, "A"),  # first occurrence
    (None, None, None),
])
def test_path_token_after(spark, path, truck, ocean):
    assert one(spark, strings.path_token_after(X, "Truck"), path) == truck
    assert one(spark, strings.path_token_after(X, "Ocean"), path) == ocean


def test_pdf_stem_and_report_stem(spark):
    assert one(spark, strings.pdf_stem(X), "A.PDF.pdf") == "a"
    assert one(spark, strings.drop_last_chars(X, 6), "4500012345a.xlsx") == "4500012345"
    assert one(spark, strings.drop_last_chars(X, 6), "abc") == ""


@pytest.mark.parametrize("raw,compat,exact", [
    ("5000.0", "5", "5000"), ("100", "1", "100"), ("120.5", "120.5", "120.5"),
    ("nan", "nan", "nan"), ("20070.0", "2007", "20070"), ("5070", "507", "5070")])
def test_rstrip_point_zero_modes(spark, raw, compat, exact):
    assert one(spark, strings.rstrip_chars(X, ".0"), raw) == compat
    assert one(spark, strings.strip_point_zero(X), raw) == exact


@pytest.mark.parametrize("raw,compat", [("1.05", "15"), ("3.0", "3"), ("nan", "nan"), ("10.0", "10")])
def test_remove_every_point_zero(spark, raw, compat):
    assert one(spark, strings.remove_all(X, ".0"), raw) == compat


def test_newline_to_space(spark):
    assert one(spark, strings.newline_to_space(X), "a\nb\n") == "a b "


@pytest.mark.parametrize("raw,key", [("0012345678", "12345678"), ("4512345678", "4512345678"), ("00", "00")])
def test_leading_zero_key(spark, raw, key):
    assert one(spark, strings.leading_zero_key(X), raw) == key


def test_site_root_round_trip(spark):
    assert one(spark, strings.with_site_root(X), None) == "Shared%20Documents/"
    assert one(spark, strings.without_site_root(strings.with_site_root(X)), "R/S/x") == "R/S/x"


def test_base_name_and_dated_folder(spark):
    assert one(spark, strings.base_name(X), "in/sub/a.pdf") == "a.pdf"
    d = spark.createDataFrame([(dt.date(2024, 3, 5),)], "d date")
    assert d.select(strings.dated_folder("d")).first()[0] == "TEST/INV_PLTesting/Prod05032024/"


def test_option_text_edits_left_to_right(spark):
    assert one(spark, strings.option_text(X), 'A "B"--C') == "A B-C"
    assert one(spark, strings.option_text(X), "a---b") == "a--b"
    assert one(spark, strings.remove_double_slash(X), "AB//") == "AB"


def test_serial_to_date(spark):
    assert one(spark, dates.serial_to_date(X), 45000.0, "x double") == dt.date(2023, 3, 15)
    assert one(spark, dates.serial_to_date(X), 45000.75, "x double") == dt.date(2023, 3, 15)


@pytest.mark.parametrize("raw,out", [("2024-01-02", "2024-01-02"), ("zz", None), (None, None),
                                     ("03/04/2024", None), ("2024-01-02 10:00:00", None), ("2024-02-30", None)])
def test_lenient_date_text_single_format(spark, raw, out):
    assert one(spark, dates.lenient_date_text(X), raw) == out


def test_lenient_date_text_more_formats(spark):
    assert one(spark, dates.lenient_date_text(X, ("yyyy-MM-dd", "dd/MM/yyyy")), "03/04/2024") == "2024-04-03"


def test_iso_date_or_null(spark):
    assert one(spark, dates.iso_date_or_null(X), None) is None
    assert one(spark, dates.iso_date_or_null(X), "") is None
    assert one(spark, dates.iso_date_or_null(X), "2024-02-29") == dt.date(2024, 2, 29)
    with pytest.raises(Exception):
        one(spark, dates.iso_date_or_null(X), "29/02/2024")


def test_stamps(spark):
    ts = dt.datetime(2024, 3, 5, 6, 7, 8)
    df = spark.range(1)
    assert df.select(dates.stamp(ts)).first()[0] == "0503060708"
    assert df.select(dates.stamp(ts, dates.MAIL_DATE_FORMAT)).first()[0] == "05/03/2024"


def test_within_days_before_inclusive(spark):
    now = dt.datetime(2024, 3, 8, 12, 0, 0)
    cases = [(now - dt.timedelta(days=7), True), (now - dt.timedelta(days=7, seconds=1), False),
             (now, True), (now + dt.timedelta(seconds=1), False)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t timestamp")
    got = [r[0] for r in df.select(dates.within_days_before("t", now, 7)).collect()]
    assert got == [e for _, e in cases]


def test_parse_listing_time(spark):
    assert one(spark, dates.parse_listing_time(X), "2024-03-01T10:20:30Z") == dt.datetime(2024, 3, 1, 10, 20, 30)


def test_shipping_label(spark):
    for s, label in [("Ocean", "Booking number"), ("Truck", "PO number"), ("Air", None), (None, None)]:
        assert one(spark, values.shipping_label(X), s) == label


def test_nan_text_to_empty(spark):
    df = spark.createDataFrame([("nan",), ("xnan",), (None,)], "x string")
    assert [r[0] for r in values.nan_text_to_empty(df).collect()] == ["", "xnan", None]


def test_number_text_has_no_exponent(spark):
    assert one(spark, values.number_text(X), 29744324.0, "x double") == "29744324"
    assert one(spark, values.number_text(X), 12.5, "x double") == "12.5"


def test_option_json_escapes(spark):
    df = spark.createDataFrame([('a"b', None)], "v string, l string")
    assert df.select(values.option_json("v", "l")).first()[0] == '{"value":"a\\"b","label":null}'


def test_json_has_key_presence_not_value(spark):
    df = spark.createDataFrame([('{"a": null}',), ('{"b": 1}',)], "x string")
    assert [r[0] for r in df.select(values.json_has_key("x", "a")).collect()] == [True, False]
