"""Column functions: cleaning, cast parity, flags, keys."""
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import columns as X


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_clean_string_trims_blanks_only(spark):
    assert one(spark, X.clean_string, "  a b ") == "a b"
    assert one(spark, X.clean_string, "   ") is None
    assert one(spark, X.clean_string, "\tx") == "\tx"  # a tab is not a blank


def test_null_tokens(spark):
    for t in ("", "NULL", "null"):
        assert one(spark, X.null_tokens, t) is None
    assert one(spark, X.null_tokens, "Null") == "Null"


def test_to_int_rounds_through_decimal(spark):
    assert one(spark, X.to_int, "2.7") == 3
    assert one(spark, X.to_int, " 4 ") == 4
    assert one(spark, X.to_int, "two") is None


def test_to_decimal_overflow_and_rounding(spark):
    assert one(spark, X.to_decimal, "1.005") == Decimal("1.01")
    assert one(spark, X.to_decimal, "12345678901.50") is None
    assert one(spark, X.to_decimal, "abc") is None


def test_to_date_iso_only(spark):
    assert str(one(spark, X.to_date, "2025-11-01")) == "2025-11-01"
    assert one(spark, X.to_date, "2025") is None
    assert one(spark, X.to_date, "2024-02-30") is None


def test_to_bool_tokens(spark):
    assert one(spark, X.to_bool, " TRUE ") is True
    assert one(spark, X.to_bool, "yes") is True
    assert one(spark, X.to_bool, "off") is False
    assert one(spark, X.to_bool, "maybe") is None


def test_email_pattern(spark):
    assert one(spark, X.is_valid_email, "x@e..com") is True
    assert one(spark, X.is_valid_email, "j@@e..com") is False
    assert one(spark, X.is_valid_email, "a@host") is False
    assert one(spark, X.is_valid_email, None) is False


def test_is_clean_id_three_valued(spark):
    f = lambda c: X.is_clean_id(c, "customer_id")
    assert one(spark, f, "CUST-1") is True
    assert one(spark, f, "Customer_ID") is False
    assert one(spark, f, "----- END OF FILE -----") is False
    assert one(spark, f, None) is None


def test_word_and_full_name(spark):
    assert one(spark, lambda c: X.word(c, 2), "Ivan de Luca") == "de"
    assert one(spark, lambda c: X.word(c, 2), "Jo  Park") is None
    df = spark.createDataFrame([("Ana", None)], "a string, b string")
    assert df.select(X.full_name(F.col("a"), F.col("b"))).first()[0] == "Ana"
    assert df.select(X.full_name(F.col("a"), F.col("b"), strict=True)).first()[0] is None


def test_surrogate_key_matches_md5_formula(spark):
    df = spark.createDataFrame([("client_a", "CUST-1"), ("client_a", None)], "c string, k string")
    got = [r[0] for r in df.select(X.surrogate_key("c", "k")).collect()]
    assert got[0] == hashlib.md5(b"client_a-CUST-1").hexdigest()
    assert got[1] == hashlib.md5(b"client_a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_refund_and_line_total(spark):
    df = spark.createDataFrame([(Decimal("-1.00"), None), (Decimal("5.00"), "refunded"), (None, None)],
                               "a decimal(12,2), s string")
    assert [r[0] for r in df.select(X.is_refund(F.col("a"), F.col("s"))).collect()] == [True, True, False]
    q = spark.createDataFrame([(3, Decimal("10.00")), (0, Decimal("1.00"))], "q int, p decimal(12,2)")
    assert [r[0] for r in q.select(X.line_total(F.col("q"), F.col("p"))).collect()] == [Decimal("30.00"), None]


def test_canonical_tier(spark):
    f = lambda c: X.canonical_tier(c)
    assert one(spark, f, "silver") == "SILVER"
    assert one(spark, f, "VIP") is None
