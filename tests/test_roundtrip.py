"""Property tests: render lists of (container, price) and (pack size, price)
to packed text, parse them back, compare."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tabulary.operators.children import parse_containers, parse_pack_sizes, prepare_medicine

WORDS = ["ml bottle", "mg vial", "gm tube", "ml ampoule", "mg sachet", "ml drop bottle"]
prices = st.decimals(min_value=Decimal("0.01"), max_value=Decimal("99999999.99"), places=2)
containers = st.tuples(st.integers(1, 999), st.sampled_from(WORDS), st.one_of(st.none(), prices))


def money(p: Decimal) -> str:
    return f"{p:,.2f}"


def render_containers(items) -> str:
    return ",".join(f"{n} {w}" + ("" if p is None else f": ৳ {money(p)}") for n, w, p in items)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(containers, min_size=1, max_size=6), min_size=1, max_size=40))
def test_container_roundtrip(spark, rows):
    data = [(i + 1, render_containers(items)) for i, items in enumerate(rows)]
    df = spark.createDataFrame(data, "brand_id long, package_container string")
    got = {}
    for r in parse_containers(prepare_medicine(df)).orderBy("package_container_id").collect():
        got.setdefault(r.brand_id, []).append((r.container_size, r.unit_price))
    for i, items in enumerate(rows):
        want = [(f"{n} {w}", p) for n, w, p in items]
        assert got.get(i + 1) == want, data[i][1]


packs = st.tuples(st.integers(1, 9999), prices)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(packs, min_size=1, max_size=8), min_size=1, max_size=40),
       st.booleans())
def test_pack_roundtrip(spark, rows, trailing_comma):
    data = [(i + 1, ",".join(f"({n}'s pack: ৳ {money(p)})" for n, p in items)
             + ("," if trailing_comma else "")) for i, items in enumerate(rows)]
    df = spark.createDataFrame(data, "brand_id long, package_size string")
    got = {}
    for r in parse_pack_sizes(df).orderBy("package_size_id").collect():
        got.setdefault(r.brand_id, []).append((r.pack_size, r.pack_price))
    for i, items in enumerate(rows):
        assert got.get(i + 1) == list(items), data[i][1]
