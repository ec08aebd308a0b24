"""Golden values of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from factloom.functions import scalars as S


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f("x").alias("y")).first()["y"]


CASES = [
    (S.normalize_name, "  St. Mary's High School ", "st mary s"),
    (S.normalize_name, "École-du Nord HS", "ecole du nord"),
    (S.normalize_name, "High School", "high"),
    (S.normalize_name, "Łódź", "lodz"),
    (S.normalize_name, "Straße", "strase"),
    (S.normalize_name, "Ærø", "aro"),
    (S.normalize_name, "Œuvre Ńńćś Żźšž Āēīōūęý", "ouvre nncs zzsz aeiouey"),
    (S.normalize_name, "East\u00a0Side\u2003Senior High School", "east side senior"),
    (S.normalize_name, "Lee Sr. High School HS", "lee sr"),
    (S.normalize_name, "Lee Sr. High", "lee"),
    (S.normalize_name, "O'Neil & Sons / West", "o neil sons west"),
    (S.flip_last_first, " Doe , Jane Q ", "Jane Q Doe"),
    (S.flip_last_first, "Doe,", "Doe,"),
    (S.flip_last_first, "Doe, Jane", "Jane Doe"),
    (S.flip_last_first, "Jane Doe", "Jane Doe"),
    (S.compressed, "A-b 1!", "ab1"),
    (S.clean_text, "a  b c ", "a b c"),
    (S.parse_clock_ns, "3:00.64", 180_640_000_000),
    (S.parse_clock_ns, "1:02:03", 3_723_000_000_000),
    (S.parse_clock_ns, "24.95", 24_950_000_000),
    (S.parse_clock_ns, "1:60.0", None),
    (S.parse_clock_ns, "0.00", None),
    (S.parse_clock_ns, "61.2", 61_200_000_000),
    (S.parse_clock_ns, "75:12.3", 4_512_300_000_000),
    (S.parse_clock_ns, "1:75:12.3", None),
    (S.parse_clock_ns, "123:59:59.999999999", 446_399_999_999_999),
    (S.parse_clock_ns, ":12", None),
    (S.parse_clock_ns, "12.", None),
    (S.parse_clock_ns, "1.1234567890", None),
    (S.parse_clock_ns, "9999999999999999999999", None),
    (S.parse_clock_ns, "x", None),
    (S.parse_feet_um, "19-00.25", (19 * 1200 + 25) * 254),
    (S.parse_feet_um, "19' 0.25\"", (19 * 1200 + 25) * 254),
    (S.parse_feet_um, "19-12", None),
    (S.timing_suffix, "24.95a", "fat"),
    (S.timing_suffix, "11.32h", "hand"),
    (S.timing_suffix, "11.32", "unknown"),
    (S.result_status, " dnf", "terminal"),
    (S.result_status, "--", "ambiguous"),
    (S.email_class, "a@mail.gmail.com", "consumer"),
    (S.email_class, "a@x.edu", "institution"),
    (S.email_class, "a@googlemail.com", "consumer"),
    (S.email_class, "a@ME.com", "consumer"),
    (S.email_class, "a@cox.net", "consumer"),
    (S.email_class, "a@acox.net", "institution"),
    (S.email_class, "a@host", "institution"),
    (S.email_class, "@x.de", "invalid"),
    (S.email_class, "a@b@c.de", "invalid"),
    (S.csv_protect, " =1+1", "' =1+1"),
    (S.csv_protect, "plain", "plain"),
    (S.csv_protect, None, None),
    (S.coordinate, "12.3456789", "12.3456789"),
    (S.coordinate, "north", None),
]


@pytest.mark.parametrize("f,value,want", CASES)
def test_golden(spark, f, value, want):
    got = one(spark, value, f)
    assert (str(got) if f is S.coordinate and got is not None else got) == want


@pytest.mark.parametrize("text,want", [("2026-09-27", "2026-09-27"), ("9/7/2026", "2026-09-07"), ("Sep 7, 2026", "2026-09-07"), ("2026-13-01", None), ("2026-02-30", None), ("2026-09", None)])
def test_dates(spark, text, want):
    got = one(spark, text, S.published_date)
    assert (str(got) if got else None) == want


def test_school_years(spark):
    d = spark.sql("select date'2026-08-01' as a, date'2026-07-31' as b")
    r = d.select(S.school_year("a").alias("a"), S.school_year("b").alias("b"), S.year_label(S.school_year("a")).alias("l"), S.graduation_year(F.lit(2026), F.lit(9)).alias("g"), S.graduation_year(F.lit(2026), F.lit(13)).alias("n")).first()
    assert (r.a, r.b, r.l, r.g, r.n) == (2026, 2025, "2026-27", 2030, None)


def test_ids_do_not_collide(spark):
    d = spark.createDataFrame([("a", "b\x1fc"), ("a\x1fb", "c")], "x string, y string")
    ids = [r.i for r in d.select(S.mint_id("t", "x", "y").alias("i")).collect()]
    assert len(set(ids)) == 2 and all(i.startswith("t_") and len(i) == 18 for i in ids)


def test_share_and_digest(spark):
    r = spark.sql("select 1 as p, 3 as w, 0 as z, array('b','a','a') as s, array('a','b') as t").select(S.share_percent("p", "w").alias("a"), S.share_percent("p", "z").alias("b"), (S.set_digest("s") == S.set_digest("t")).alias("c")).first()
    assert (r.a, r.b, r.c) == (33, None, True)


def test_retry_after(spark):
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    d = spark.createDataFrame([("120",), ("Thu, 01 Jan 2026 00:01:00 GMT",), ("999999",), ("soon",)], "h string")
    got = [r.v for r in d.select(S.retry_after_seconds("h", now).alias("v")).collect()]
    assert got[:3] == [120, 60, 86_400]


def test_wind(spark):
    d = spark.createDataFrame([(2.0,), (2.1,), (None,), (float("nan"),)], "w double")
    assert [r.c for r in d.select(S.wind_class("w").alias("c")).collect()] == ["legal", "assisted", "unknown", "unknown"]
    assert d.select(S.wind_class("w", False).alias("c")).first().c == "n/a"
