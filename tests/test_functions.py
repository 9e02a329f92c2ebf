import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from anteframe import vocab
from anteframe.functions import codes, numbers, ranges, text, times
from anteframe.plans import labs
from helpers import rows


def values(spark, kind, given, fn):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select("i", fn(F.col("x")).alias("y")).select("y").collect()]


def test_lenient_decimal(spark):
    given = ["1,5", "<0,3", "> 12", " 7 ", "1e3", "-2", "5.", ".5", "1.0d", "nan", "abc", "", "1.2,3", None, "inf", "1f"]
    want = [1.5, 0.3, 12.0, 7.0, 1000.0, -2.0, 5.0, 0.5] + [None] * 8
    assert values(spark, "string", given, numbers.lenient_decimal) == want


def test_reference_decimal_zero_is_missing(spark):
    assert values(spark, "string", ["0", "0,0", "3,5", "<3"], numbers.reference_decimal) == [None, 0.0, 3.5, None]


def test_floor_bucket_and_cap(spark):
    assert values(spark, "double", [-301.0, 299.0, 300.0], lambda c: numbers.floor_bucket(c, 300, 5)) == [-10, 0, 5]
    assert values(spark, "double", [10.0, 360.0, 400.0, None], lambda c: numbers.capped(c, 360)) == [10.0, 360.0, 360.0, 360.0]


def test_percent_is_half_even(spark):
    assert values(spark, "long", [1, 3, 5], lambda c: numbers.percent(c, F.lit(400))) == [0.2, 0.8, 1.2]
    assert values(spark, "long", [1], lambda c: numbers.percent(c, F.lit(0))) == [None]


def at(s):
    return dt.datetime.fromisoformat(s)


CLOCKS = [
    # time with offset, id, naive UTC, effective time, common id
    ("2021-03-04T05:06:07+0100", "O-GLU_Z.0130", "2021-03-04 04:06:07", "2021-03-04 01:30:00", "x-GLU_x"),
    ("2021-07-01T18:20:00+02:00", "CRP_S", "2021-07-01 16:20:00", "2021-07-01 16:20:00", "CRP_S"),
    ("2022-01-01T00:10:00.5+0100", "K_H", "2021-12-31 23:10:00.5", "2021-12-31 23:10:00.5", "x-K_x"),
    ("2022-02-28T22:00:00Z", "G-GLU_K", "2022-02-28 22:00:00", "2022-02-28 22:00:00", "x-GLU_x"),
    ("2022-05-05T09:00:00+0200", "O-GLU_Z", "2022-05-05 07:00:00", "2022-05-05 07:00:00", "x-GLU_x"),
    ("2022-05-05T00:30:00+0200", "O-GLU_Z.0615", "2022-05-04 22:30:00", "2022-05-04 06:15:00", "x-GLU_x"),
    ("2022-05-05T12:00:00+0200", "O-GLU_Z.2575", "2022-05-05 10:00:00", "2022-05-06 02:15:00", "x-GLU_x"),
]


def test_effective_times_and_ids(spark):
    source = [(i, c[0], c[1]) for i, c in enumerate(CLOCKS)]
    df = spark.createDataFrame(source, "Fallnummer long, Probeneingangsdatum string, `Parameter-ID primär` string")
    got = labs.harmonised_labs(df).orderBy("Fallnummer").select(
        "Probeneingangsdatum", "abnahmezeitpunkt_effektiv", "parameterid_effektiv"
    )
    assert [tuple(r) for r in got.collect()] == [(at(c[2]), at(c[3]), c[4]) for c in CLOCKS]


def test_local_time_option(spark):
    source = [(1, "2014-10-14T00:30:00+0200", "O-GLU_Z.0045")]
    df = spark.createDataFrame(source, "Fallnummer long, Probeneingangsdatum string, `Parameter-ID primär` string")
    got = labs.harmonised_labs(df, "Europe/Berlin").select("Probeneingangsdatum", "abnahmezeitpunkt_effektiv")
    assert rows(got) == [(at("2014-10-14 00:30:00"), at("2014-10-14 00:45:00"))]


def test_common_codes_agree_with_the_feature_list(spark):
    ids = [*vocab.LAB_IDS, "K_H", "O-GLU_Z.0815"]
    got = values(spark, "string", ids, codes.common_code)
    assert got == [vocab.common_id(i) for i in ids]
    assert set(got) == set(vocab.LAB_FEATURES)
    assert len(vocab.LAB_IDS) == 75 and len(vocab.LAB_FEATURES) == 68


def test_null_keeping_tests(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "x int")
    assert rows(df.where(codes.differs(F.col("x"), 1))) == [(None,), (None,)]
    assert values(spark, "string", ["a_GLU_", None], lambda c: codes.matches(c, "GLU_")) == [True, False]


def test_labels(spark):
    given = [vocab.LABEL_NEGATIVE, vocab.LABEL_POSITIVE, "x", None]
    assert values(spark, "string", given, codes.binary_label) == [0, 1, 1, 1]
    sure = values(spark, "double", [0.9, 0.89, None], lambda c: codes.confident_label(F.lit(vocab.LABEL_NEGATIVE), c))
    assert sure == [True, False, None]


def test_us_timestamp(spark):
    df = spark.createDataFrame(
        [("03/07/2020", "01:05:09 PM"), ("3/7/2020", "1:05:09 PM"), ("12/31/2020", "12:00:00 AM"), (None, "1:05:09 PM")],
        "d string, t string",
    )
    got = [r[0] for r in df.select(times.us_timestamp(F.col("d"), F.col("t"))).collect()]
    assert got == [at("2020-03-07 13:05:09"), at("2020-03-07 13:05:09"), at("2020-12-31"), None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(times.us_timestamp(F.lit("2020-03-07"), F.col("t"))).collect()


def test_ages_round_half_even(spark):
    df = spark.createDataFrame(
        [(40, None, at("2020-01-01")), (None, at("2000-01-01"), at("2000-01-01") + dt.timedelta(days=913, hours=20)),
         (None, None, at("2020-01-01"))],
        "age long, birth timestamp, t timestamp",
    )
    got = [r[0] for r in df.select(times.age_in_years(F.col("age"), F.col("birth"), F.col("t"))).collect()]
    assert got == [40, 2, None]
    assert values(spark, "long", [18, 20, 21, None], times.age_decade) == [2, 2, 3, None]


def test_placeholder_year(spark):
    df = spark.createDataFrame(
        [(at("1900-01-01"), at("2020-05-05")), (at("2019-01-01"), at("2020-05-05")), (None, at("2020-05-05"))],
        "a timestamp, b timestamp",
    )
    got = [r[0] for r in df.select(times.date_unless_year(F.col("a"), F.col("b"), 1900)).collect()]
    assert got == [at("2020-05-05"), at("2019-01-01"), None]


def test_range_normalised(spark):
    df = spark.createDataFrame(
        [(5.0, 5.0, 5.0, 0), (4.0, 2.0, None, 1), (4.0, None, 8.0, 2), (4.0, None, None, 3), (4.0, 0.0, None, 1),
         (6.0, 4.0, 8.0, 0), (6.0, 4.0, 8.0, None)],
        "e double, u double, o double, k int",
    )
    got = df.select(ranges.range_normalised(F.col("e"), F.col("u"), F.col("o"), F.col("k"))).collect()
    assert [r[0] for r in got] == [None, 2.0, 0.5, 4.0, None, 0.5, None]


@pytest.mark.parametrize("k", [0, 1, 2, 3, None])
def test_category_fits(spark, k):
    df = spark.createDataFrame([("1", "2"), ("1", None), (None, "2"), (None, None)], "u string, o string")
    got = [r[0] for r in df.select(ranges.category_fits(F.lit(k).cast("int"), F.col("u"), F.col("o"))).collect()]
    assert got == [i == k for i in range(4)]


LINE = "01.02.2003 -- ABC --  Befund  --  4/05  --"
# Text of a report, and (head, number, date).
REPORTS = [
    (LINE, (None, "4/05", "01.02.2003")),
    ("a\nb\n\nc\nd\ne", ("abcd", None, None)),
    ("", ("", None, None)),
    ("   \n\t\n", ("", None, None)),
    (None, (None, None, None)),
    ("a\r\nb\rc\x0bd\x0ce f", ("abcd", None, None)),
    ("  a  \n  b\n\n\n c", ("  a    b c", None, None)),
    (LINE.replace(" ", "\u00a0"), (None, "4/05", "01.02.2003")),
    ("eins\nzwei\ndrei\nvier\nfünf\n" + LINE + "\nsechs", (None, "4/05", "01.02.2003")),
    (LINE + "\n" + LINE.replace("4/05", "6/07"), (None, "4/05", "01.02.2003")),
    (LINE.replace("ABC", "ABCDEFG"), (LINE.replace("ABC", "ABCDEFG"), None, None)),
    ("Klinik " + LINE + " Ende", (None, "Ende", "Klinik")),
    ("x" * 5000 + "\n" + LINE, (None, "4/05", "01.02.2003")),
    (LINE.replace("01.02", "\u0660\u0661.\u0660\u0662"), (None, "4/05", "\u0660\u0661.\u0660\u0662.2003")),
    ("\n\n  " + LINE + " ", (None, "4/05", "01.02.2003")),
    (LINE.replace(" ABC ", "\x1fABC\x1f"), (None, "4/05", "01.02.2003")),
    ("nur eine Zeile", ("nur eine Zeile", None, None)),
]


def test_report_head(spark):
    got = values(spark, "string", [content for content, _ in REPORTS], text.report_head)
    assert [tuple(r) for r in got] == [want for _, want in REPORTS]
