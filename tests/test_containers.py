"""Golden cases for container text."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tabulary.functions.classify import classify_container, fix_typos, typo_left
from tabulary.operators.children import parse_containers, parse_pack_sizes, parse_rejects, prepare_medicine

CASES = [
    # (name, input, rows, unit price of the medicine)
    ("unit price and pack", "Unit Price: ৳ 3.25,(20's pack: ৳ 65.00),", [(None, D("3.25"), "Unit-Priced")], D("3.25")),
    ("unit price", "Unit Price: ৳ 41.00", [(None, D("41.00"), "Unit-Priced")], D("41.00")),
    ("thousands", "4 ml vial: ৳ 2,715.00", [("4 ml vial", D("2715.00"), "Vial")], D("2715.00")),
    ("two", "25 ml jar: ৳ 70.00,80 ml jar: ৳ 210.00",
     [("25 ml jar", D("70.00"), "Jar"), ("80 ml jar", D("210.00"), "Jar")], None),
    ("open fragment", "9 ml tube,(3's pack", [("9 ml tube", None, "Tube")], None),
    ("orphan price, fragment", "9 ml tube,77.10,(3's pack", [("9 ml tube", None, "Tube")], None),
    ("fragment between", "9 ml tube,(3's pack,,6 gm sachet",
     [("9 ml tube", None, "Tube"), ("6 gm sachet", None, "Sachet")], None),
    ("orphan between", "9 ml tube,1,077.10,6 gm sachet",
     [("9 ml tube", None, "Tube"), ("6 gm sachet", None, "Sachet")], None),
    ("priced, fragment", "2 ml vial: ৳ 61.40,(3's pack: ৳ 180.00)", [("2 ml vial", D("61.40"), "Vial")], None),
    ("priced, open fragment", "2 ml vial: ৳ 61.40,(3's pack", [("2 ml vial", D("61.40"), "Vial")], None),
    ("two with fragments", "2 ml vial: ৳ 9.00,(3's pack: ৳ 27.00),,7 ml vial: ৳ 11.00,(4's pack: ৳ 1,044.00),",
     [("2 ml vial", D("9.00"), "Vial"), ("7 ml vial", D("11.00"), "Vial")], None),
    ("container behind a fragment", "3 ml jar: ৳ 8.00,(5's pack: ৳ 39.00),4 ml jar: ৳ 9.50",
     [("3 ml jar", D("8.00"), "Jar"), ("4 ml jar", D("9.50"), "Jar")], None),
    ("container behind an open priced fragment", "3 ml jar: ৳ 8.00,(5's pack: ৳ 39.00,4 ml jar: ৳ 9.50",
     [("3 ml jar", D("8.00"), "Jar"), ("4 ml jar", D("9.50"), "Jar")], None),
    ("brackets of a name", "30 puffs,30 puffs (second)",
     [("30 puffs", None, "Inhaler"), ("30 puffs (second)", None, "Inhaler")], None),
    ("micro sign", "15 µg prefilled syringe", [("15 mcg pre-filled syringe", None, "Pre-filled Syringe")], None),
    ("placeholder in capitals", "NOT FOR SALE", [("NOT FOR SALE", None, "Placeholder")], None),
    ("nothing known", "250 mg", [("250 mg", None, "N/A")], None),
    ("null", None, [], None),
    ("odd grouping", "a jar: ৳ 6.00,90 ml vial: ৳ 7,81,230.00",
     [("a jar", D("6.00"), "Jar"), ("90 ml vial", D("781230.00"), "Vial")], None),
    ("mixed", "9 ml vial,30 ml vial: ৳ 6.00", [("9 ml vial", None, "Vial"), ("30 ml vial", D("6.00"), "Vial")], D("6.00")),
    ("whole price before a number", "a jar: ৳ 6,150 ml vial: ৳ 8.00",
     [("a jar", D("6.00"), "Jar"), ("150 ml vial", D("8.00"), "Vial")], None),
    ("one decimal, three decimals", "9 ml vial: ৳ 16.5,8 ml vial: ৳ 16.250",
     [("9 ml vial", D("16.50"), "Vial"), ("8 ml vial", D("16.25"), "Vial")], None),
    ("blank before the comma", "9 ml vial: ৳ 16.00 ,8 ml vial: ৳ 7.00",
     [("9 ml vial", D("16.00"), "Vial"), ("8 ml vial", D("7.00"), "Vial")], None),
    ("no blank", "9 ml vial:৳16.00", [("9 ml vial", D("16.00"), "Vial")], D("16.00")),
    ("junk price", "9 ml vial: ৳ soon,8 ml vial: ৳ 7.00",
     [("9 ml vial", None, "Vial"), ("8 ml vial", D("7.00"), "Vial")], None),
    ("many", ",".join(f"{i} ml bag: ৳ {i}.00" for i in range(1, 13)),
     [(f"{i} ml bag", D(i).quantize(D("0.01")), "Bag") for i in range(1, 13)], None),
]


@pytest.fixture(scope="module")
def medicines(spark):
    data = [(i + 1, c[1]) for i, c in enumerate(CASES)]
    return spark.createDataFrame(data, "brand_id long, package_container string")


def test_container_golden_cases(medicines):
    got = {}
    for r in parse_containers(prepare_medicine(medicines)).orderBy("package_container_id").collect():
        got.setdefault(r.brand_id, []).append((r.container_size, r.unit_price, r.container_type))
    for i, (case, _, want, _) in enumerate(CASES):
        assert got.get(i + 1, []) == want, case


def test_unit_price_after_load(medicines):
    price = {r.brand_id: r.unit_price for r in prepare_medicine(medicines).collect()}
    for i, (case, *_, want) in enumerate(CASES):
        assert price[i + 1] == want, case


def test_rejects_are_the_prices_not_read(medicines):
    raw = prepare_medicine(medicines.withColumn("package_size", F.when(F.col("brand_id") == 1, "(7's pack: ৳ soon)")))
    found = parse_rejects(raw, parse_containers(raw), parse_pack_sizes(raw)).collect()
    names = [c[0] for c in CASES]
    assert sorted(r.brand_id for r in found) == [1, names.index("junk price") + 1]


def test_child_keys_are_dense(medicines):
    keys = [r[0] for r in parse_containers(prepare_medicine(medicines))
            .select("package_container_id").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_typos_and_classifier_order(spark):
    df = spark.createDataFrame(
        [("5 Litter",), ("botttle",), ("prefilled",), ("per-filled pen",), ("75 µg",),
         ("15 ml drop bottle",), ("3 ml penfill cartridge",), ("1 pen",), ("10 tablet pack",),
         ("1 can",), ("1 white and green",), ("Ifamide 1 g",), ("1 BOTTLE",)], "s string")
    got = df.select(fix_typos(F.col("s")).alias("f")).select(
        "f", classify_container(F.col("f")).alias("t"), typo_left(F.col("f")).alias("left")).collect()
    assert [r.f for r in got[:5]] == ["5 liter", "bottle", "pre-filled", "pre-filled pen", "75 mcg"]
    assert [r.t for r in got[5:]] == ["Bottle", "Pen", "Pen", "Tablet Kit", "Tin/Can",
                                      "Strip/Blister", "Vial", "Bottle"]
    assert not any(r.left for r in got)
