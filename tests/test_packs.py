"""Golden cases for pack text."""

from decimal import Decimal as D

import pytest

from tabulary.operators.children import parse_pack_sizes, preview_pack_blocks

CASES = [
    ("one block", "(8's pack: ৳ 44.00)", [(8, D("44.00"))]),
    ("two blocks", "(8's pack: ৳ 44.00),(16's pack: ৳ 83.50)", [(8, D("44.00")), (16, D("83.50"))]),
    ("trailing comma, thousands", "(24's pack: ৳ 2,310.00),", [(24, D("2310.00"))]),
    ("more than three", ",".join(f"({i}'s pack: ৳ {i}.00)" for i in range(1, 7)),
     [(i, D(i).quantize(D("0.01"))) for i in range(1, 7)]),
    ("size with a comma", "(2,500's pack: ৳ 99.00)", [(None, D("99.00"))]),
    ("no blank", "(7's pack:৳ 15.00)", [(7, D("15.00"))]),
    ("blank at the end", "(7's pack: ৳ 15.00 )", [(7, D("15.00"))]),
    ("junk price", "(7's pack: ৳ soon),(9's pack: ৳ 18.00)", [(7, None), (9, D("18.00"))]),
    ("open block", "(7's pack: ৳ 15.00),(9's pack: ৳ 18.00", [(7, D("15.00")), (9, D("18.00"))]),
    ("no price at all", "(7's pack", []),
    ("null", None, []),
]


@pytest.fixture(scope="module")
def medicines(spark):
    return spark.createDataFrame([(i + 1, c[1]) for i, c in enumerate(CASES)],
                                 "brand_id long, package_size string")


def test_pack_golden_cases(medicines):
    out = parse_pack_sizes(medicines).orderBy("package_size_id").collect()
    got = {}
    for r in out:
        got.setdefault(r.brand_id, []).append((r.pack_size, r.pack_price))
    for i, (case, _, want) in enumerate(CASES):
        assert got.get(i + 1, []) == want, case
    assert [r.package_size_id for r in out] == list(range(1, len(out) + 1))


def test_preview_blocks(medicines):
    got = {r.brand_id: (r.package_size, r.block_1, r.block_2, r.block_3)
           for r in preview_pack_blocks(medicines).collect()}
    assert got[2] == (CASES[1][1], "(8's pack: ৳ 44.00)", "(16's pack: ৳ 83.50)", None)
    assert got[4][3] == "(3's pack: ৳ 3.00),(4's pack: ৳ 4.00),(5's pack: ৳ 5.00),(6's pack: ৳ 6.00)"
    assert got[3][1:] == ("(24's pack: ৳ 2,310.00),", None, None)
    assert len(CASES) not in got and len(CASES) - 1 not in got
