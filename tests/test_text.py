from decimal import Decimal

from pyspark.sql import functions as F

from tabulary.functions.text import (NBSP, clean_text, has_non_ascii, is_null_or_blank,
                                     is_present, occurrences, restore_commas, strip_mojibake,
                                     to_decimal_price)


def test_clean_text_deletes_nbsp_and_trims_blanks(spark):
    df = spark.createDataFrame([(f"  Anti{NBSP}biotic ",), (f"{NBSP} Cutaneous",), (None,)], "s string")
    got = [r[0] for r in df.select(clean_text("s")).collect()]
    assert got == ["Antibiotic", "Cutaneous", None]


def test_restore_commas_and_mojibake(spark):
    df = spark.createDataFrame([(f" A;B{NBSP} ", "CutaneousÂ" + NBSP)], "a string, b string")
    r = df.select(restore_commas("a").alias("a"), strip_mojibake("b").alias("b")).first()
    assert (r.a, r.b) == ("A,B", "Cutaneous")


def test_presence_predicates(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "s string")
    got = df.select(is_present("s").alias("p"), is_null_or_blank("s").alias("b")).collect()
    assert [(r.p, r.b) for r in got] == [(False, True), (False, True), (True, True), (True, False)]


def test_non_ascii_and_occurrences(spark):
    df = spark.createDataFrame([("a: ৳ 1, b: ৳ 2",), ("plain",), ("line\nbreak",)], "s string")
    got = df.select(has_non_ascii("s").alias("n"), occurrences("s", "৳").alias("k")).collect()
    assert [(r.n, r.k) for r in got] == [(True, 2), (False, 0), (True, 0)]


def test_price_cast_rounds_and_rejects(spark):
    df = spark.createDataFrame([(" 1,450.00 ",), ("12.345",), ("junk",), ("123456789012.00",), ("",)],
                               "s string")
    got = [r[0] for r in df.select(to_decimal_price(F.col("s"))).collect()]
    assert got == [Decimal("1450.00"), Decimal("12.35"), None, None, None]
