import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabulon.functions import (lenient_date, lenient_date_udf, no_separator, single_format_date,
                               strict_date, strict_single_format_date)

D = dt.date
# Truth table of the mixed-format rule (input -> expected date or None).
CASES = [
    ("2008-01-28", D(2008, 1, 28)), ("2008-1-28", D(2008, 1, 28)), ("1/28/2008", D(2008, 1, 28)),
    ("01/28/2008", D(2008, 1, 28)), ("2007-03-31", D(2007, 3, 31)), ("05/15/1985", D(1985, 5, 15)),
    ("3012-04-30", None), ("04/30/3012", None),
    ("1677-09-22", D(1677, 9, 22)), ("2262-04-11", D(2262, 4, 11)),
    ("1677-09-21", None), ("2262-04-12", None), ("0001-01-01", None),
    ("2008-02-30", None), ("13/01/2008", None), ("2008-01", None), ("08-01-28", None),
    ("1/28/08", None), (" 2008-01-28", None), ("2008-01-28 ", None), ("1/1/12008", None),
    ("2008/01-28", None), ("20080128", None), ("abc", None),
    ("2008-001-28", None), ("2008-01-028", None), ("001/2/2008", None),
    ("1/ 2/2008", D(2008, 1, 2)), ("2008-1- 2", D(2008, 1, 2)),
    ("", None), (None, None),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, "text string, expected date")


def test_lenient_truth_table(cases):
    got = cases.select("text", "expected", lenient_date("text").alias("got")).collect()
    bad = [(r.text, r.expected, r.got) for r in got if r.expected != r.got]
    assert not bad


def test_udf_twin_agrees_on_truth_table(cases):
    got = cases.select("text", lenient_date("text").alias("a"), lenient_date_udf("text").alias("b")).collect()
    assert [(r.text, r.a, r.b) for r in got if r.a != r.b] == []


def test_udf_twin_agrees_on_mutations(spark):
    import random

    rnd = random.Random(7)
    alphabet = "0123456789-/ "
    texts = []
    for _ in range(3000):
        base = rnd.choice(["2008-01-28", "1/28/2008", "12/31/1999", "1999-12-31", "2/29/2000"])
        chars = list(base)
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(chars) + 1)
            op = rnd.random()
            if op < 0.4 and chars:
                chars[min(i, len(chars) - 1)] = rnd.choice(alphabet)
            elif op < 0.7:
                chars.insert(i, rnd.choice(alphabet))
            elif chars:
                del chars[min(i, len(chars) - 1)]
        texts.append(("".join(chars),))
    df = spark.createDataFrame(texts, "text string")
    diff = df.select("text", lenient_date("text").alias("a"), lenient_date_udf("text").alias("b")) \
             .where(~F.col("a").eqNullSafe(F.col("b"))).collect()
    assert diff == []


def test_no_separator_flag(spark):
    df = spark.createDataFrame([("20080128",), ("2008-01-28",), ("",), (None,)], "t string")
    assert [r.f for r in df.select(no_separator("t").alias("f")).collect()] == [True, False, False, False]


def test_single_format_two_digit(spark):
    df = spark.createDataFrame([("05/15/1985",), ("5/15/1985",), ("12/01/2000",)], "t string")
    got = [r.d for r in df.select(single_format_date("t", "MM/dd/yyyy").alias("d")).collect()]
    assert got == [D(1985, 5, 15), None, D(2000, 12, 1)]


def test_strict_modes_raise(spark):
    good = spark.createDataFrame([("1/28/2008",), ("2008-01-28",)], "t string")
    assert good.select(strict_date("t").alias("d")).collect()[0].d == D(2008, 1, 28)
    for fn, text in ((strict_date, "3012-04-30"), (strict_date, "20080128"),
                     (strict_single_format_date, "2008-01-28")):
        bad = spark.createDataFrame([(text,)], "t string")
        with pytest.raises(Exception, match="unreadable"):
            bad.select(fn("t").alias("d")).collect()


def test_sql_functions_agree(spark, cases):
    from tabulon.functions.sql import register_sql_functions

    register_sql_functions(spark)
    cases.createOrReplaceTempView("date_cases")
    got = spark.sql("SELECT text, expected, tabulon_lenient_date(text) AS a, "
                    "tabulon_lenient_date_pandas(text) AS b FROM date_cases").collect()
    assert [(r.text, r.expected, r.a, r.b) for r in got if not (r.expected == r.a == r.b)] == []


def test_line_breaks_after_a_date(spark):
    texts = [(t + end,) for t in ("2008-01-28", "1/28/2008", "2008-01- 5", "1/ 5/2008", "2008-1-5")
             for end in ("\n", "\r\n", "\r", "\u2028", "\u0085", "\n\n")]
    df = spark.createDataFrame(texts, "text string")
    got = df.select(lenient_date("text").alias("a"), lenient_date_udf("text").alias("b")).collect()
    assert [(r.a, r.b) for r in got if r.a is not None or r.b is not None] == []
