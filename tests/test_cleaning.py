from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from coursegrain.functions import dates, text
from coursegrain.operators import cleaning


def strings(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def values(df):
    return [r[0] for r in df.collect()]


def test_nulls(spark):
    df = strings(spark, "N/A", " Unknown ", "", "   ", "\t", "nab", None, "tbd")
    assert values(cleaning.canonicalize_nulls(df)) == [
        None, None, None, None, "\t", "nab", None, "tbd",
    ]
    assert values(cleaning.canonicalize_nulls(df, extra_sentinels=["TBD"]))[-1] is None


def test_canonicalisers_are_idempotent(spark):
    df = strings(spark, " a \t b ", "none", None, "\n")
    for step in (cleaning.canonicalize_nulls, cleaning.trim_whitespace):
        once = step(df)
        assert values(step(once)) == values(once)


def test_trim(spark):
    df = strings(spark, "  a \t\n b ", "\t", None)
    assert values(cleaning.trim_whitespace(df)) == ["a b", "", None]
    assert values(cleaning.trim_whitespace(df, collapse_internal=False)) == [
        "a \t\n b", "\t", None,
    ]


def test_booleans(spark):
    df = strings(spark, "YES", " t ", "0", "maybe", None)
    assert values(cleaning.normalize_booleans(df)) == [True, True, False, None, None]
    kept = cleaning.normalize_booleans(df, output_type="string", false_values=["MAYBE"])
    assert values(kept) == ["true", "true", "false", "false", None]
    with pytest.raises(ValueError):
        cleaning.normalize_booleans(df, output_type="int")


def test_numbers(spark):
    df = strings(spark, "$1,234.50", "1-2", "(100)", "1.5e3", "-7 kg", "", None)
    assert values(cleaning.normalize_numeric_strings(df)) == [
        1234.5, None, 100.0, 1.53, -7.0, None, None,
    ]
    cast = cleaning.normalize_numeric_strings(df, output_type="decimal(18,2)")
    assert str(values(cast)[0]) == "1234.50"


def test_iso_dates(spark):
    stamp = datetime(2021, 3, 4, 5, 6, 7, 890000)
    df = spark.createDataFrame([(stamp, None, stamp.date())], "a timestamp, b timestamp, c date")
    assert tuple(cleaning.standardize_datetimes_iso(df).first()) == (
        "2021-03-04T05:06:07", None, "2021-03-04T00:00:00",
    )
    with pytest.raises(TypeError):
        cleaning.standardize_datetimes_iso(strings(spark, "x"), ["s"])


def test_years_are_clamped_without_reading_them_into_python(spark):
    df = spark.sql("SELECT CAST('+12021-01-01' AS TIMESTAMP) AS a, TIMESTAMP '2021-01-01' AS b")
    assert tuple(cleaning.clamp_years(df, ["a", "b", "zz"]).first()) == (
        None, datetime(2021, 1, 1),
    )


def test_lenient_parse(spark):
    df = strings(spark, "2021-02-30", "2021-02-28T10:00:00", "x", None)
    assert values(cleaning.parse_timestamps(df, ["s"])) == [
        None, datetime(2021, 2, 28, 10), None, None,
    ]


def test_names_with_dots_and_ticks(spark):
    df = spark.createDataFrame([(" x ", " n/a ")], ["a.b", "c`d"])
    out = cleaning.canonicalize_nulls(cleaning.trim_whitespace(df))
    assert out.columns == ["a.b", "c`d"] and tuple(out.first()) == ("x", None)


def test_calendar(spark):
    df = spark.createDataFrame(
        [(datetime(2014, 4, 30),), (datetime(2015, 5, 1),), (datetime(2030, 9, 1),), (None,)],
        "d timestamp",
    )
    year = F.year("d")
    shown = df.select(
        dates.year_term(F.col("d")), dates.year_interval(year), dates.year_period(year)
    ).collect()
    assert [tuple(r) for r in shown] == [
        ("2014 Winter", "2010-2015", "2010-2015"),
        ("2015 Summer", "2015-2020", "2010-2015"),
        ("2030 Fall", "2025+", "Other"),
        ("Unknown", "Unknown", "Unknown"),
    ]
    assert dates.year_interval_order()[0] == "Before 2010"


def test_text_features(spark):
    df = spark.createDataFrame(
        [("COMP 1113", "x"), ("12 X", "nursing X-List"), (None, None), ("ab", " ")],
        "code string, name string",
    )
    shown = df.select(
        text.leading_word(F.col("code"), F.col("name")),
        text.token_count(F.col("code")),
        text.has_keyword(F.col("name"), "x-list"),
        text.title_label(F.lit("ip_restricted_x")),
    ).collect()
    assert [tuple(r) for r in shown] == [
        ("COMP", 2, False, "Ip Restricted X"),
        ("NURSING", 2, True, "Ip Restricted X"),
        ("UNKNOWN", 0, False, "Ip Restricted X"),
        ("UNKNOWN", 1, False, "Ip Restricted X"),
    ]


def test_row_operators_run_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    strings(spark, " N/A ", " a  b ").write.parquet(source)
    stream = spark.readStream.schema("s string").parquet(source)
    clean = cleaning.canonicalize_nulls(cleaning.trim_whitespace(stream))
    run = clean.writeStream.format("memory").queryName("cleaned").start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    assert sorted(map(str, values(spark.table("cleaned")))) == ["None", "a b"]
