"""Typo fixes and container classification (survey I31-I33)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .containers import PLACEHOLDERS

# Ordered (wrong, right) replacements applied to container text.
TYPO_RULES = (
    ("litter", "liter"),
    ("botttle", "bottle"),
    ("prefilled", "pre-filled"),
    ("per-filled", "pre-filled"),
    ("µg", "mcg"),
)

# Ordered classification rules, first match wins.  Each rule is
# (label, case-insensitive LIKE patterns).  NULL text and the placeholders are
# handled before these rules; no match gives 'N/A'.
CONTAINER_RULES = (
    ("Bottle", ("%bottle%",)),
    ("Bottle", ("%syrup%",)),
    ("Vial", ("%vial%",)),
    ("Tube", ("%tube%",)),
    ("Ampoule", ("%ampoule%",)),
    ("Drop", ("%drop%",)),
    ("Inhaler", ("%metered%", "%doses%", "%puffs%", "%inhaler%", "%maxhaler%")),
    ("Pre-filled Syringe", ("%pre-filled syringe%",)),
    ("Pen", ("%pre-filled pen%", "%FlexTouch%", "%KwikPen%", "%BioPen%", "%PenSet%",
             "%flexpen%", "%penfill%", "%Kit Pen%")),
    ("Cartridge", ("%cartridge%",)),
    ("Sachet", ("%sachet%",)),
    ("Bag", ("%bag%",)),
    ("Strip/Blister", ("%strip%", "%blister%")),
    ("Tablet Kit", ("%tablet%",)),
    ("Pack", ("%pack%",)),
    ("Jar", ("%jar%",)),
    ("Container", ("%container%",)),
    ("Spray", ("%spray%",)),
    ("Tin/Can", ("%tin%", "%can%")),
    ("Pen", ("%pen%",)),
    ("Solution", ("%solution%",)),
    ("Pot", ("%pot%",)),
    ("Gel", ("%gel%",)),
    ("Ointment", ("%ointment%",)),
    ("Bar", ("%bar%",)),
    ("Applicator", ("%applicator%",)),
    ("Vial", ("%Ifamide%",)),
    ("Strip/Blister", ("%white%green%",)),
)
UNIT_PRICED = "Unit-Priced"
PLACEHOLDER = "Placeholder"
UNKNOWN = "N/A"


def fix_typos(c: Column, rules=TYPO_RULES) -> Column:
    """Apply the replacements in order, in any case of the letters."""
    return reduce(lambda acc, r: F.regexp_replace(acc, f"(?i){re.escape(r[0])}", r[1]), rules, c)


def typo_left(c: Column, rules=TYPO_RULES) -> Column:
    """True where any wrong spelling remains, in any case (I32)."""
    return reduce(lambda a, b: a | b, [c.ilike(f"%{w}%") for w, _ in rules])


def classify_container(c: Column, rules=CONTAINER_RULES) -> Column:
    """Ordered, case-insensitive rule list folded into one CASE."""
    expr = F.when(c.isNull(), F.lit(UNIT_PRICED)).when(
        F.lower(c).isin(*map(str.lower, PLACEHOLDERS)), F.lit(PLACEHOLDER))
    for label, patterns in rules:
        cond = reduce(lambda a, b: a | b, [c.ilike(p) for p in patterns])
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(UNKNOWN))
