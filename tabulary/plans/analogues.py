"""Staging sources derived from the driver's tables.

The catalog's own source files are not among the driver's tables, so each
source is rendered from a driver table whose size grows with the scale
factor (see the README for the mapping).  Every rendering rule is a pure
function of the row's own numbers, so an oracle can compute the expected
catalog from the same numbers without re-parsing any text.

* Names are made dirty (blanks, no-break spaces, ';' for ',', a stray 'Â').
* ``Package_Container`` takes one of 20 shapes by ``p_partkey % 20``: single
  and multiple priced containers (with thousands separators), unit-price
  text with and without a pack fragment, orphaned prices, pack fragments,
  the doubled-block shape, unpriced lists, placeholders in any case, bare
  text, NULL, mixed priced/unpriced lists, prices of one and three decimals,
  odd blanks, a price that is no number, and words in capitals.  Container
  words and units come from fixed lists, some with typos to fix.
* ``Package_Size`` has ``p_partkey % 5`` pack blocks, some with a size or
  price that is no number, without a blank, or not closed.
* Misses come from altered names: a class suffix that the class file lacks,
  and a company suffix in some medicines' manufacturer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import MOJIBAKE_A, NBSP
from ..sources.tables import table

# Container words as written in the rendered text, and as they
# read after the typo fixes.
CONTAINER_WORDS = (
    ("bottle", "bottle"), ("botttle", "bottle"), ("syrup", "syrup"), ("vial", "vial"),
    ("tube", "tube"), ("ampoule", "ampoule"), ("drop", "drop"),
    ("metered doses", "metered doses"), ("puffs", "puffs"), ("inhaler", "inhaler"),
    ("prefilled syringe", "pre-filled syringe"), ("pre-filled syringe", "pre-filled syringe"),
    ("per-filled pen", "pre-filled pen"), ("FlexTouch pen", "FlexTouch pen"),
    ("KwikPen", "KwikPen"), ("penfill cartridge", "penfill cartridge"),
    ("cartridge", "cartridge"), ("sachet", "sachet"), ("bag", "bag"), ("strip", "strip"),
    ("blister", "blister"), ("tablet", "tablet"), ("pack", "pack"), ("jar", "jar"),
    ("container", "container"), ("spray", "spray"), ("tin", "tin"), ("can", "can"),
    ("pen", "pen"), ("solution", "solution"), ("pot", "pot"), ("gel", "gel"),
    ("ointment", "ointment"), ("bar", "bar"), ("applicator", "applicator"),
    ("Ifamide", "Ifamide"), ("white and green", "white and green"), ("box", "box"),
)
# Units as written, and after the typo fixes.
UNITS = (("ml", "ml"), ("mg", "mg"), ("µg", "mcg"), ("litter", "liter"), ("gm", "gm"))
# Units of the shape with words in capitals.
CAPITAL_UNITS = ("ml", "mg", "µg", "Litter", "gm")

N_FORMATS = 20
TAKA_MARK = ": ৳ "
UNIT_PRICE = "Unit Price: ৳ "


def _dirty(c: Column, k: Column) -> Column:
    """Four spellings of one name that all clean back to it."""
    return (F.when(k == 0, c)
            .when(k == 1, F.concat(F.lit("  "), c, F.lit(" ")))
            .when(k == 2, F.concat(c, F.lit(NBSP)))
            .otherwise(F.concat(F.lit(NBSP + " "), c)))


def _pick(values: Column, idx: Column) -> Column:
    return F.element_at(values, (idx + 1).cast("int"))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _num(c: Column) -> Column:
    return c.cast("string")


def _money(c: Column) -> Column:
    """A price with thousands separators, e.g. '1,450.00'."""
    return F.format_number(c, 2)


def _container_text(p: DataFrame) -> Column:
    size, key = F.col("p_size"), F.col("p_partkey")
    fmt = key % N_FORMATS
    word = F.expr(f"p_partkey div {N_FORMATS}") % len(CONTAINER_WORDS)
    raw_words = _strings(w for w, _ in CONTAINER_WORDS)
    raw_units = _strings(u for u, _ in UNITS)

    def seg(j: int) -> Column:
        return F.concat(_num(size + 5 * j), F.lit(" "),
                        _pick(raw_units, (size + j) % len(UNITS)), F.lit(" "),
                        _pick(raw_words, (word + j) % len(CONTAINER_WORDS)))

    u = F.col("p_retailprice").cast("decimal(10,2)")
    u_txt = _num(u)
    n = F.lit(2) + size % 9
    big = (u * size).cast("decimal(10,2)")

    def pack(count: Column, priced: bool) -> Column:
        head = F.concat(F.lit("("), _num(count), F.lit("'s pack"))
        if not priced:
            return head
        return F.concat(head, F.lit(TAKA_MARK), _money((u * count).cast("decimal(10,2)")), F.lit(")"))

    s0, s1, s2 = seg(0), seg(1), seg(2)
    capital = F.concat(_num(size), F.lit(" "), _pick(_strings(CAPITAL_UNITS), size % len(CAPITAL_UNITS)),
                       F.lit(" "), F.upper(_pick(raw_words, word)))
    shapes = [
        F.concat(s0, F.lit(TAKA_MARK), _money(big)),                                   # 0
        F.concat(F.lit(UNIT_PRICE), u_txt, F.lit(","), pack(n, True), F.lit(",")),     # 1
        F.concat(F.lit(UNIT_PRICE), u_txt),                                            # 2
        F.concat(s0, F.lit(TAKA_MARK), _money(big), F.lit(","), s1, F.lit(TAKA_MARK), u_txt),  # 3
        F.concat(s0, F.lit(","), pack(n, False)),                                      # 4
        F.concat(s0, F.lit(","), u_txt, F.lit(","), pack(n, False)),                   # 5
        F.concat(s0, F.lit(","), pack(n, False), F.lit(",,"), s1),                     # 6
        F.concat(s0, F.lit(","), u_txt, F.lit(","), s1),                               # 7
        F.concat(s0, F.lit(TAKA_MARK), u_txt, F.lit(","), pack(n, True)),              # 8
        F.concat(s0, F.lit(TAKA_MARK), u_txt, F.lit(","), pack(n, True), F.lit(",,"),
                 s0, F.lit(TAKA_MARK), u_txt, F.lit(","), pack(n + 5, True), F.lit(",")),  # 9
        F.concat(s0, F.lit(","), s1, F.lit(","), s2),                                  # 10
        F.concat(s0, F.lit(TAKA_MARK), u_txt, F.lit(","), pack(n, False)),             # 11
        F.when(size % 4 == 0, F.lit("price unavailable")).when(size % 4 == 2, F.lit("Price Unavailable"))
        .when(size % 4 == 1, F.lit("NOT FOR SALE")).otherwise(F.lit("Not for sale")),   # 12
        F.when(size % 5 == 0, F.lit(None).cast("string")).otherwise(s0),               # 13
        F.concat(s0, F.lit(","), s1, F.lit(TAKA_MARK), u_txt),                         # 14
        F.lit(None).cast("string"),                                                    # 15
        F.concat(s0, F.lit(TAKA_MARK), _num(u.cast("decimal(10,1)")), F.lit(" ,"), s1,
                 F.lit(TAKA_MARK), u_txt, F.lit("0")),                                 # 16
        F.concat(s0, F.lit(":৳"), u_txt),                                              # 17
        F.concat(s0, F.lit(TAKA_MARK + "TBA,"), s1, F.lit(TAKA_MARK), u_txt),          # 18
        F.concat(capital, F.lit(TAKA_MARK), u_txt),                                    # 19
    ]
    expr = F.when(fmt == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], start=1):
        expr = expr.when(fmt == i, shape)
    # ';' stands for ',' in the source files; restore_commas undoes it.
    return F.replace(expr, F.lit(","), F.lit(";"))


def _pack_text(p: DataFrame) -> Column:
    size, key = F.col("p_size"), F.col("p_partkey")
    blocks = key % 5
    u = F.col("p_retailprice").cast("decimal(10,2)")

    def block(i: Column) -> Column:
        count = F.when((i == 1) & (size % 11 == 0), F.lit("1,000")).otherwise(_num(i * 10))
        price = F.when((i == 1) & (size % 17 == 0), F.lit("TBA")).otherwise(
            _money((u * 3 * i).cast("decimal(10,2)")))
        mark = F.when(size % 19 == 0, F.lit("'s pack:৳ ")).otherwise(F.lit("'s pack" + TAKA_MARK))
        end = F.when((i == blocks) & (size % 13 == 0), F.lit("")).otherwise(F.lit(")"))
        return F.concat(F.lit("("), count, mark, price, end)

    text = F.array_join(F.transform(F.sequence(F.lit(1), blocks.cast("int")), block), ",")
    text = F.concat(text, F.when(size % 2 == 0, F.lit(",")).otherwise(F.lit("")))
    return (F.when(blocks > 0, text)
            .when(size % 3 == 0, F.lit("(10's pack"))
            .otherwise(F.lit(None).cast("string")))


def _tables(spark: SparkSession, sf_dir: str):
    """One reader per table (each read lists files and reads a footer)."""
    cache: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in cache:
            cache[name] = table(spark, sf_dir, name)
        return cache[name]
    return get


def medicine_source(spark: SparkSession, sf_dir: str, t=None) -> DataFrame:
    """One medicine per part; its manufacturer is the part's lowest supplier
    key in ``lineitem`` (pre-aggregated per part before the join)."""
    t = t or _tables(spark, sf_dir)
    part = t("part")
    first = t("lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("first_supp"))
    supplier = t("supplier").select("s_suppkey", "s_name")
    p = (part.join(first, part.p_partkey == first.l_partkey, "left")
         .join(supplier, F.col("first_supp") == F.col("s_suppkey"), "left"))
    key, size = F.col("p_partkey"), F.col("p_size")
    brand = F.concat(F.col("p_name"),
                     F.when(size % 3 == 0, F.concat(F.lit(";"), F.lower("p_type"))).otherwise(F.lit("")))
    return p.select(
        _num(key).alias("Brand_ID"),
        _dirty(brand, key % 4).alias("Brand_Name"),
        F.when(size % 7 == 0, F.lit("herbal")).otherwise(F.lit("allopathic")).alias("Type"),
        F.concat(F.lit("p-"), _num(key)).alias("Slug"),
        _dirty(F.col("p_brand"), (key + 1) % 4).alias("Dosage_Form"),
        _dirty(F.col("p_name"), (key + 2) % 4).alias("Generic"),
        F.concat(_num(size), F.lit(" mg")).alias("Strength"),
        _dirty(F.when(size % 23 == 0, F.concat("s_name", F.lit(" Ltd"))).otherwise(F.col("s_name")), key % 4)
        .alias("Manufacturer"),
        _container_text(p).alias("Package_Container"),
        _pack_text(p).alias("Package_Size"),
    )


def drug_class_source(spark: SparkSession, sf_dir: str, t=None) -> DataFrame:
    """Class file: one line per part; classes that only generics name must be
    backfilled."""
    t = t or _tables(spark, sf_dir)
    p = t("part")
    key = F.col("p_partkey")
    return p.select(key.cast("int").alias("Drug_Class_ID"),
                    _dirty(F.col("p_type"), key % 4).alias("Drug_Class_Name"),
                    F.concat(F.lower("p_type"), F.lit("-"), _num(F.col("p_size"))).alias("Slug"),
                    F.lit(None).cast("int").alias("Generics_Count"))


def dosage_form_source(spark: SparkSession, sf_dir: str, t=None) -> DataFrame:
    p = (t or _tables(spark, sf_dir))("part")
    key = F.col("p_partkey")
    slug = F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))), F.lit("-"),
                    _num(F.col("p_size")))
    return p.select(key.cast("int").alias("Dosage_Form_ID"),
                    _dirty(F.col("p_brand"), (key + 1) % 4).alias("Dosage_Form_Name"),
                    slug.alias("Slug"), F.lit(None).cast("int").alias("Brand_Names_Count"))


def manufacturer_source(spark: SparkSession, sf_dir: str, t=None) -> DataFrame:
    """Manufacturer file: one line per supplier.  The medicines that write the
    name another way cannot resolve theirs."""
    s = (t or _tables(spark, sf_dir))("supplier")
    key = F.col("s_suppkey")
    return s.select(key.cast("int").alias("Manufacturer_ID"),
                    _dirty(F.col("s_name"), key % 4).alias("Manufacturer_Name"),
                    F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("Slug"),
                    F.lit(None).cast("string").alias("Generics_Count"),
                    F.lit(None).cast("string").alias("Brand_Names_Count"))


def indication_source(spark: SparkSession, sf_dir: str, t=None) -> DataFrame:
    """Indication file: one line per supplier naming its nation (so the file
    grows with the supplier table and repeats names)."""
    t = t or _tables(spark, sf_dir)
    nation = t("nation").select("n_nationkey", "n_name")
    s = t("supplier").select("s_suppkey", "s_nationkey")
    j = s.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    return j.select(key.cast("int").alias("Indication_ID"),
                    _dirty(F.col("n_name"), key % 4).alias("Indication_Name"),
                    F.lower("n_name").alias("Slug"), F.lit(None).cast("int").alias("Generics_Count"))


def generic_source(spark: SparkSession, sf_dir: str, t=None) -> DataFrame:
    """Generic file: one line per part.  Parts larger than 45 carry a
    second-line class (' II') that the class file lacks."""
    p = (t or _tables(spark, sf_dir))("part")
    key, size = F.col("p_partkey"), F.col("p_size")
    cls = F.concat(F.col("p_type"), F.when(size > 45, F.lit(" II")).otherwise(F.lit("")))
    return p.select(_num(key).alias("Generic_ID"),
                    _dirty(F.col("p_name"), (key + 2) % 4).alias("Generic_Name"),
                    F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), _num(size)).alias("Slug"),
                    _dirty(cls, (key + 3) % 4).alias("Drug_Class"),
                    F.lit(None).cast("string").alias("Indication"))


def generic_indication_source(spark: SparkSession, sf_dir: str, t=None) -> DataFrame:
    """Generic file with its indication column: one line per distinct
    (part, supplier) sold; the indication is the supplier's nation.  Line
    items are reduced to distinct pairs (map-side) before any join."""
    t = t or _tables(spark, sf_dir)
    pairs = t("lineitem").select("l_partkey", "l_suppkey").distinct()
    part = t("part").select("p_partkey", "p_name")
    supplier = t("supplier").select("s_suppkey", "s_nationkey")
    nation = t("nation").select("n_nationkey", "n_name")
    j = (pairs.join(part, pairs.l_partkey == part.p_partkey)
         .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    stray = F.when(F.col("s_suppkey") % 3 == 0, F.lit(MOJIBAKE_A + NBSP)).otherwise(F.lit(""))
    return j.select(F.col("p_name").alias("Generic_Name"),
                    F.concat(F.col("n_name"), stray).alias("Indication"))


def analogue_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = _tables(spark, sf_dir)
    return {
        "drug_class": drug_class_source(spark, sf_dir, t),
        "dosage_form": dosage_form_source(spark, sf_dir, t),
        "manufacturer": manufacturer_source(spark, sf_dir, t),
        "indication": indication_source(spark, sf_dir, t),
        "generic": generic_source(spark, sf_dir, t),
        "generic_indication": generic_indication_source(spark, sf_dir, t),
        "medicine": medicine_source(spark, sf_dir, t),
    }
