"""Child tables parsed from packed text (survey I9-I30, G2, A7, A8).

All parsing is narrow: one ``posexplode`` of the pieces of each parent's text
emits the child rows, which plain regex expressions then parse -- a single
scan of the parent instead of one scan per segment position, and no shuffle:
children are numbered in the order of their parents' keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import classify_container, fix_typos
from ..functions.containers import (SEPARATOR, cleaned, container_format, container_signs,
                                    segment_price, segment_size, unit_price)
from ..functions.packs import block_price, block_size, block_strings, pack_block_strings
from ..functions.text import TAKA, occurrences
from .keys import derived, with_inherited_key


def extract_unit_price(df: DataFrame, text: str = "package_container",
                       out: str = "unit_price") -> DataFrame:
    """Read the single unit price from the raw text."""
    return df.withColumn(out, unit_price(F.col(text)))


def clean_container(df: DataFrame, text: str = "package_container") -> DataFrame:
    """Reduce the raw text to its containers and their prices."""
    return df.withColumn(text, cleaned(F.col(text)))


def prepare_medicine(df: DataFrame, text: str = "package_container") -> DataFrame:
    """Format label, unit price and number of price signs from the raw text,
    then the cleaned text."""
    def prepared(frame: DataFrame) -> DataFrame:
        raw = (frame.withColumn("container_format", container_format(F.col(text)))
               .withColumn("container_signs", container_signs(F.col(text))))
        return clean_container(extract_unit_price(raw, text), text)

    return derived(df, prepared)


def parse_pack_sizes(df: DataFrame, parent_key: str = "brand_id", text: str = "package_size",
                     key: str = "package_size_id") -> DataFrame:
    """One row per pack block: (key, parent_key, pack_size, pack_price), NULL
    where a part is not a number (I22).
    Blocks are exploded as strings and parsed with plain regex expressions,
    which stay inside whole-stage codegen."""
    blocks = pack_block_strings(F.col(text))

    def rows(parents: DataFrame, keep: list[str]) -> DataFrame:
        return (parents.select(parent_key, *keep, F.posexplode(blocks).alias("pos", "b"))
                .select(parent_key, *keep, "pos", block_size(F.col("b")).alias("pack_size"),
                        block_price(F.col("b")).alias("pack_price")))

    return derived(with_inherited_key(df, key, rows, [parent_key, "pos"]), lambda f: f.drop("pos"))


def preview_pack_blocks(df: DataFrame, parent_key: str = "brand_id",
                        text: str = "package_size") -> DataFrame:
    """Every priced pack text and its block strings: blocks 1 and 2, and
    block 3 holding the rest (I23)."""
    blocks = block_strings(F.col(text), 3)
    return (df.filter(F.col(text).contains(TAKA))
            .select(parent_key, text, *[F.get(blocks, i).alias(f"block_{i + 1}") for i in range(3)]))


def preview_first_block(df: DataFrame, parent_key: str = "brand_id", text: str = "package_size",
                        k: int = 20) -> DataFrame:
    """Size and price read from single-block pack texts, first ``k`` parents
    in key order (I23's top-20 previews)."""
    single = F.col(text).contains(TAKA) & ~F.col(text).contains("),(")
    return (df.filter(single)
            .select(parent_key, block_size(F.col(text)).alias("pack_size_preview"),
                    block_price(F.col(text)).alias("pack_price_preview"))
            .orderBy(parent_key).limit(k))


def parse_containers(df: DataFrame, parent_key: str = "brand_id",
                     text: str = "package_container", price: str = "unit_price",
                     key: str = "package_container_id") -> DataFrame:
    """One row per container segment, typo-fixed and classified.

    Rows whose text was nulled by cleaning but that carry a unit price give
    one row with a NULL container (format B, I30).  Priced, unpriced and
    mixed segments all come out of the same array of strings, which is
    exploded and parsed by plain regex expressions; a NULL element stands
    for the unit-price row.
    """
    items = (F.when(F.col(text).isNotNull(), F.split(F.col(text), SEPARATOR))
             .when(F.col(price).isNotNull(), F.array(F.lit(None).cast("string"))))
    seg = F.col("seg")

    def rows(parents: DataFrame, keep: list[str]) -> DataFrame:
        return (parents.select(parent_key, *keep, F.col(price).alias("__unit"), F.posexplode(items).alias("pos", "seg"))
                .select(parent_key, *keep, "pos", fix_typos(segment_size(seg)).alias("container_size"),
                        F.when(seg.isNull(), F.col("__unit")).otherwise(segment_price(seg)).alias("unit_price"))
                .withColumn("container_type", classify_container(F.col("container_size"))))

    return derived(with_inherited_key(df, key, rows, [parent_key, "pos"]), lambda f: f.drop("pos"))


def parse_rejects(raw: DataFrame, containers: DataFrame, packs: DataFrame,
                  parent_key: str = "brand_id") -> DataFrame:
    """Parents of whose raw text not every price was read: the number of price
    signs of containers differs from the priced container rows, or the signs
    in the pack text from the priced pack rows.  ``(parent_key,
    container_signs, priced_containers, pack_signs, priced_packs)``; empty when
    every price was read."""
    signs = raw.select(parent_key, "container_signs",
                       F.coalesce(occurrences(F.col("package_size"), TAKA), F.lit(0)).cast("long")
                       .alias("pack_signs"))
    priced = (containers.filter(F.col("container_size").isNotNull() & F.col("unit_price").isNotNull())
              .groupBy(parent_key).agg(F.count(F.lit(1)).alias("priced_containers")))
    pack_rows = (packs.filter(F.col("pack_price").isNotNull())
                 .groupBy(parent_key).agg(F.count(F.lit(1)).alias("priced_packs")))
    joined = (signs.join(priced, parent_key, "left").join(pack_rows, parent_key, "left")
              .select(parent_key, "container_signs",
                      F.coalesce("priced_containers", F.lit(0)).alias("priced_containers"),
                      "pack_signs", F.coalesce("priced_packs", F.lit(0)).alias("priced_packs")))
    return joined.filter((F.col("container_signs") != F.col("priced_containers"))
                         | (F.col("pack_signs") != F.col("priced_packs")))
