"""Scalar rules against literal expectations."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from regweave.functions.codes import STATE_NUMBERS, country_code, county_fips, fips_shape, state_code, zip5
from regweave.functions.coords import decimal_text, in_bounds, is_unmappable
from regweave.functions.dates import bare_date, century_adjusted, has_text, pivot_date
from regweave.functions.text import NULL_TOKENS, fold_text, fold_upper, null_tokens_to_null
from regweave.operators.clean import DerivedColumnClash, clean_frame, named
from regweave.registry import SPECS


def apply(spark, values, rule):
    """The rule's result for each value, computed in one job."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    out = rows.select("i", rule(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.i)]


def day(c):
    return pivot_date(bare_date(c))


def test_every_two_digit_year(spark):
    texts = [f"{d}-{y:02d}" for y in range(100) for d in ("01-JAN", "31-Dec")]
    years = [y + (2000 if y < 50 else 1900) for y in range(100)]
    expected = [d for y in years for d in (date(y, 1, 1), date(y, 12, 31))]
    assert apply(spark, texts, day) == expected


@pytest.mark.parametrize("texts, expected", [
    (["01-MAR-00", "23-MAY-25", "15-JUN-99", "01-JAN-35", "01-JAN-55"],
     [date(2000, 3, 1), date(2025, 5, 23), date(1999, 6, 15), date(2035, 1, 1), date(1955, 1, 1)]),
    (["29-FEB-00", "29-FEB-68", "29-FEB-01"], [date(2000, 2, 29), date(1968, 2, 29), None]),
    (["1-jul-9", " \t01-JAN-55\n"], [date(2009, 7, 1), date(1955, 1, 1)]),
    (["", "  ", None, "garbage", "32-JAN-00", "00-JAN-00", "01-JAN-1955", "001-JAN-55", "01-JAN--5",
      "01-January-55", "+1-JAN-55", "01 - JAN-55", "01-JAN-5x", "-JAN-01", "1-1-01", "1 -JAN-55", "5T-JAN-01", "01-EBM-01"], [None] * 18),
])
def test_dates(spark, texts, expected):
    assert apply(spark, texts, day) == expected


def test_dates_do_not_depend_on_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Apia")
        assert apply(spark, ["30-DEC-11", "01-JAN-70"], day) == [date(2011, 12, 30), date(1970, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_date_facts(spark):
    texts = ["01-JAN-50", "01-JAN-68", "01-JAN-49", "01-JAN-69", "bad", " ", None, "\t"]
    assert apply(spark, texts, lambda c: century_adjusted(day(c))) == [True, True, False, False] + [None] * 4
    assert apply(spark, texts, has_text) == [True] * 5 + [False, None, True]


def test_text(spark):
    texts = ["\tA\tB \n", "   ", "\t", "", None, "a  b", " a\r\nb\f ", "a b", "plain"]
    assert apply(spark, texts, fold_text) == ["A B", None, None, None, None, "a b", "a b", "a b", "plain"]
    assert apply(spark, [" oh\t", ""], fold_upper) == ["OH", None]


def test_null_tokens(spark):
    assert apply(spark, list(NULL_TOKENS), null_tokens_to_null) == [None] * len(NULL_TOKENS)
    assert apply(spark, ["Na", " ", "nil"], null_tokens_to_null) == ["Na", " ", "nil"]
    assert apply(spark, ["NA", ""], lambda c: null_tokens_to_null(c, ("",))) == ["NA", None]


def test_countries(spark):
    names = ["usa", "UNITED  STATES", "United States of America", "u.s.a.", "US", "CANADA", "Mexico", "Atlantis", " "]
    expected = ["US"] * 5 + ["CA", "MX", "ATLANTIS", None]
    assert apply(spark, names, lambda c: country_code(fold_upper(c))) == expected


def test_states(spark):
    territories = ["AS", "FM", "GU", "MH", "MP", "PR", "PW", "UM", "VI"]
    codes = ["oh", "XX", "TT", "", None, *territories]
    assert apply(spark, codes, lambda c: state_code(fold_upper(c))) == ["OH", None, None, None, None, *territories]
    assert len(STATE_NUMBERS) == len(set(STATE_NUMBERS.values())) == 60


def test_postal_and_county(spark):
    assert apply(spark, ["44446-1199", "444461199", "ABCDE", "4444", None],
                 lambda c: zip5(fold_text(c))) == ["44446", "44446", None, None, None]
    pairs = [("39155", "OH"), ("02020", "AK"), ("12345", "OH"), ("AK090", "AK"), ("04", "AZ"), ("39155", "XX"),
             ("39155\n", "OH"), ("391550", "OH"), (None, "OH"), ("39155", None)]
    frame = spark.createDataFrame([(i, f, s) for i, (f, s) in enumerate(pairs)], "i int, f string, s string")
    got = [r[0] for r in frame.orderBy("i").select(county_fips(F.col("f"), F.col("s"))).collect()]
    assert got == ["39155", "02020"] + [None] * 8


def test_fips_shapes(spark):
    codes = [None, "39155", "AK090", "04", "391550", "ak090", "X-1", "39155\n"]
    assert apply(spark, codes, fips_shape) == [
        "null", "county_fips_5", "usps_prefix_3", "numeric_wrong_length", "numeric_wrong_length", "other", "other", "other"]


def test_coordinates(spark):
    assert apply(spark, ["150", "91", "41.18", "0", "-90", "1d", "0x1", "", "nan", "1_0.5", "1__0", " 1e1 "],
                 lambda c: in_bounds(decimal_text(c), -90, 90)) == [
        None, None, 41.18, None, -90.0, None, None, None, None, 10.5, None, 10.0]
    assert apply(spark, ["-150", "999", "180"], lambda c: in_bounds(decimal_text(c))) == [-150.0, None, 180.0]
    points = spark.createDataFrame([(1, 41.0, -80.0), (2, 41.0, None), (3, None, None), (4, 10.0, -80.0), (5, 41.0, 80.0)],
                                   "i int, a double, o double")
    flags = points.orderBy("i").select(is_unmappable(F.col("a"), F.col("o"))).collect()
    assert [r[0] for r in flags] == [False, True, False, True, True]


def test_awkward_column_names_survive(spark):
    raw = spark.createDataFrame([("1", " a  b ", "x", "y", "z")], 'REGISTRY_ID string, `ODD"NAME` string, `PRIMARY NAME` string, `A.B` string, `TI``CK` string')
    clean = clean_frame(raw, SPECS["facility"])
    assert clean.columns == raw.columns
    assert tuple(clean.first()) == ("1", "a b", "x", "y", "z")
    assert clean.select(named("TI`CK")).first()[0] == "z"


def test_a_source_column_named_like_a_derived_one_is_refused(spark):
    raw = spark.createDataFrame([("1", "OH", "x")], "REGISTRY_ID string, STATE_CODE string, STATE_CODE_RAW string")
    with pytest.raises(DerivedColumnClash):
        clean_frame(raw, SPECS["facility"])


def test_rules_attach_by_name_and_register(spark):
    raw = spark.createDataFrame([("01-JAN-60", "02-FEB-61", " us ", "zz")], "OTHER_DATE string, CREATE_DATE string, STD_COUNTRY string, STD_STATE_CODE string")
    row = clean_frame(raw, SPECS["sic"]).first()
    assert tuple(row) == (date(1960, 1, 1), date(1961, 2, 2), "US", None)
    with pytest.raises(KeyError):
        clean_frame(raw, SPECS["sic"], ("NOPE",))
