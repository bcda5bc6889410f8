from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.functions.convert import to_decimal, to_int, to_timestamp_ntz
from stratamart.functions.dates import date_key, days_between, delivery_status
from stratamart.functions.text import bad_zip, clean, state_code


def values(spark, texts, expression):
    """The expression over each text, in order."""
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, x string")
    return [r[0] for r in rows.orderBy("n").select(expression(F.col("x"))).collect()]


def test_clean(spark):
    texts = ['"a b"', ' "x" ', '""', " ", None, "São Paulo", 'a\r', '"07"']
    assert values(spark, texts, clean) == ["a b", "x", None, None, None, "São Paulo", "a\r", "07"]
    assert values(spark, ["aé", None], lambda c: clean(c, "upper")) == ["AÉ", None]
    assert values(spark, ['" SP "'], lambda c: clean(c, "lower")) == ["sp"]


def test_to_int(spark):
    texts = ["12", "+7", "-3", "12.0", "12.5", "1e3", "", "2147483647", "2147483648", "7\r", "7 ", None]
    assert values(spark, texts, to_int) == [12, 7, -3, None, None, None, None, 2147483647, None, None, None, None]


def test_to_decimal(spark):
    texts = ["1.235", "-1.235", ".5", "5.", "1e3", "1,50", "12", "", "9999999999999999.99", "99999999999999999", "1.0\r"]
    expected = ["1.24", "-1.24", "0.50", "5.00", None, None, "12.00", None, "9999999999999999.99", None, None]
    assert values(spark, texts, to_decimal) == [None if e is None else Decimal(e) for e in expected]


def test_to_timestamp(spark):
    texts = [
        "2017-10-02 10:56:33", "2017-10-02", "2017-10-02T10:56:33", "2017-10-02 10:56", "2017-10-02 10:56:33.25",
        "2017", "2017-13-40 00:00:00", "02/10/2017", "not a date", "",
    ]
    day = datetime(2017, 10, 2)
    at = day.replace(hour=10, minute=56, second=33)
    assert values(spark, texts, to_timestamp_ntz) == [
        at, day, at, at.replace(second=0), at.replace(microsecond=250000), None, None, None, None, None,
    ]


def test_state_and_zip(spark):
    assert values(spark, ["RIO DE JANEIRO, BRASIL,RJ", "SP", None, "A, SP "], state_code) == ["RJ", "SP", None, "SP"]
    zips = ["09560", "9560", "0956A", "123456", None]
    assert values(spark, zips, bad_zip) == [False, True, True, True, False]


def test_date_key_and_days(spark):
    rows = spark.sql(
        "SELECT timestamp_ntz'2017-10-02 23:59:00' a, timestamp_ntz'2017-10-03 00:01:00' b, "
        "cast(null AS timestamp_ntz) c"
    )
    row = rows.select(
        date_key(F.col("a")), days_between(F.col("a"), F.col("b")), days_between(F.col("a"), F.col("c")),
        date_key(F.col("c")),
    ).first()
    assert tuple(row) == (20171002, 1, None, None)


@pytest.mark.parametrize(
    "delivered, estimated, expected",
    [
        (None, "2018-01-01", "Not Delivered"),
        (None, None, "Not Delivered"),
        ("2018-01-01 10:00:00", None, "Delivered - No Estimate"),
        ("2018-01-02 00:01:00", "2018-01-01 23:59:00", "Late"),
        ("2018-01-01 00:00:00", "2018-01-01 23:00:00", "On Time"),
        ("2018-01-01 00:00:00", "2018-01-02 00:00:00", "Early"),
    ],
)
def test_delivery_status(spark, delivered, estimated, expected):
    row = spark.createDataFrame([(delivered, estimated)], "d string, e string")
    stamps = [F.col(c).cast("timestamp_ntz") for c in ("d", "e")]
    assert row.select(delivery_status(*stamps)).first()[0] == expected
