"""Packed pack-size text (survey I22, I23).

``"(6's pack: ৳ 30.00),(12's pack: ৳ 57.50)"`` holds one block per pack: a size
before ``'s`` and a price after the price sign.  Every block gives a row; a part that
is not a number is NULL there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import TAKA, to_decimal_price

PACK_BLOCK = r"\([^()]*\)?"                  # open ones end with the text
BLOCK_SIZE = r"^\( *([0-9]+) *'s"
BLOCK_PRICE = r"৳([^()]*)"
# Split between blocks: a comma with ')' before and '(' after.
BLOCK_BOUNDARY = r"(?<=\)),(?=\()"


def pack_block_strings(c: Column) -> Column:
    """Array<string> of the blocks of a text with prices (others have none)."""
    return F.when(c.contains(TAKA), F.regexp_extract_all(c, F.lit(PACK_BLOCK), 0))


def block_size(block: Column) -> Column:
    return F.regexp_extract(block, BLOCK_SIZE, 1).try_cast("int")


def block_price(block: Column) -> Column:
    return to_decimal_price(F.regexp_extract(block, BLOCK_PRICE, 1))


def block_strings(c: Column, limit: int = 3) -> Column:
    """The raw block strings, split at '),(' boundaries; the last of
    ``limit`` keeps the rest of the string (I23 preview)."""
    return F.split(c, BLOCK_BOUNDARY, limit)
