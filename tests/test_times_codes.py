"""Time rules (D3, T1) and code rules."""

import datetime as dt

from pyspark.sql import functions as F

from cohortline.functions.codes import code_column, collate, conditional_template, template
from cohortline.functions.times import parse_time, spark_pattern


def test_spark_pattern():
    assert spark_pattern("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    assert spark_pattern("%Y") == "yyyy"
    assert spark_pattern("%dT%H") == "dd'T'HH"


def test_formats_in_order_full_match(spark):
    df = spark.createDataFrame([("2003-06-01",), ("2003-06-01 10:11:12",), ("junk",), (None,), ("2003-06-01x",)], "s string")
    got = [r[0] for r in df.select(parse_time(F.col("s"), ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d"])).collect()]
    assert got == [dt.datetime(2003, 6, 1), dt.datetime(2003, 6, 1, 10, 11, 12), None, None, None]


def test_single_format_rejects_date_only(spark):
    df = spark.createDataFrame([("2003-06-01",), ("2003-13-01 00:00:00",)], "s string")
    got = [r[0] for r in df.select(parse_time(F.col("s"), "%Y-%m-%d %H:%M:%S")).collect()]
    assert got == [None, None]


def test_year_format(spark):
    df = spark.createDataFrame([("2128",), ("21x8",)], "s string")
    assert [r[0] for r in df.select(parse_time(F.col("s"), "%Y")).collect()] == [dt.datetime(2128, 1, 1), None]


def test_non_iso_format_uses_pattern(spark):
    df = spark.createDataFrame([("01/06/2003",)], "s string")
    assert df.select(parse_time(F.col("s"), "%d/%m/%Y")).first()[0] == dt.datetime(2003, 6, 1)


def test_wall_clock_kept_across_dst(spark):
    """A wall-clock time inside a DST gap of another zone stays as written."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2021-03-14 02:30:00",)], "s string")
        got = df.select(parse_time(F.col("s"), "%Y-%m-%d %H:%M:%S").cast("string")).first()[0]
        assert got == "2021-03-14 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_code_parts_and_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    code, keep = code_column(df, ["K", "col(x)", "col(y)"])
    assert [tuple(r) for r in df.select(code, keep).collect()] == [("K//a//UNK", True), ("K//UNK//b", True)]
    code, keep = code_column(df, ["col(x)", "col(y)"])
    assert [r[1] for r in df.select(code, keep).collect()] == [True, False]
    code, keep = code_column(df, "col(missing)")
    assert [r[1] for r in df.select(code, keep).collect()] == [False, False]


def test_templates(spark):
    df = spark.createDataFrame([("9", "123.4"), ("10", None), ("11", "5")], "icd_version string, norm_icd_code string")
    t = template(df, "ICD{icd_version}CM/{norm_icd_code}")
    assert [r[0] for r in df.select(t).collect()] == ["ICD9CM/123.4", None, "ICD11CM/5"]
    c = conditional_template(df, [{"P{icd_version}/{norm_icd_code}": {"icd_version": "9"}},
                                  {"Q{icd_version}/{norm_icd_code}": {"icd_version": "11"}}])
    assert [r[0] for r in df.select(c).collect()] == ["P9/123.4", None, "Q11/5"]


def test_collate(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(collate(df, ["x", "y"])).collect()] == ["a", "b", None]


def test_further_time_directives_equal_strptime(spark):
    """Directives of users' own specifications, on texts written by the same format."""
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from cohortline.functions.times import parse_time

    rng = random.Random(3)
    shorthands = {"%F": "%Y-%m-%d", "%T": "%H:%M:%S", "%R": "%H:%M", "%D": "%m/%d/%y", "%h": "%b"}
    for fmt in ("%b %d, %Y %I:%M %p", "%d %B %Y", "%Y-%j", "%F %T", "%F %R", "%D", "%y-%m-%d", "%Y-%m-%dT%H:%M:%S.%f", "100%% %F", "%Y%m%d%H%M%S", "%h-%d-%Y"):
        plain = fmt
        for short, long in shorthands.items():
            plain = plain.replace(short, long)
        times = [dt.datetime(rng.randint(2000, 2068), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59),
                             rng.randint(0, 59), rng.randint(0, 999_999)) for _ in range(30)]
        rows = [(t.strftime(plain) + ("x" if i % 7 == 0 else ""),) for i, t in enumerate(times)]
        for i, r in enumerate(spark.createDataFrame(rows, "s string").select("s", parse_time(F.col("s"), fmt).alias("t")).collect()):
            assert r.t == (None if i % 7 == 0 else dt.datetime.strptime(r.s, plain)), (fmt, r)
