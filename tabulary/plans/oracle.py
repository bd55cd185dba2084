"""DuckDB oracle SQL for the registered queries.

The oracle never parses the packed text: it derives the expected catalog
straight from the numbers the analogue sources render their text from
(``p_size``, ``p_retailprice``, ``p_partkey``), and cleans names by using the
clean originals.  Agreement with the Spark pipeline therefore checks the
cleaning, parsing, lookups, keys and reports end to end.
"""

from __future__ import annotations

from .analogues import CAPITAL_UNITS, CONTAINER_WORDS, N_FORMATS, UNITS

# Fixed values, stated here on their own: what each container text is classified
# as, first match first, and how its typos read.
CLASSES = """
Bottle: bottle
Bottle: syrup
Vial: vial
Tube: tube
Ampoule: ampoule
Drop: drop
Inhaler: metered | doses | puffs | inhaler | maxhaler
Pre-filled Syringe: pre-filled syringe
Pen: pre-filled pen | FlexTouch | KwikPen | BioPen | PenSet | flexpen | penfill | Kit Pen
Cartridge: cartridge
Sachet: sachet
Bag: bag
Strip/Blister: strip | blister
Tablet Kit: tablet
Pack: pack
Jar: jar
Container: container
Spray: spray
Tin/Can: tin | can
Pen: pen
Solution: solution
Pot: pot
Gel: gel
Ointment: ointment
Bar: bar
Applicator: applicator
Vial: Ifamide
Strip/Blister: white%green
"""
TYPOS = {"litter": "liter", "botttle": "bottle", "prefilled": "pre-filled", "per-filled": "pre-filled", "µg": "mcg"}


def _capital(word: str) -> str:
    """A word in capitals as it reads after the typo fixes."""
    out = word.upper()
    for wrong, right in TYPOS.items():
        out = out.replace(wrong.upper(), right)
    return out


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


NW, NU = len(CONTAINER_WORDS), len(UNITS)
RAW_WORDS = _list(w for w, _ in CONTAINER_WORDS)
FIX_WORDS = _list(w for _, w in CONTAINER_WORDS)
RAW_UNITS = _list(u for u, _ in UNITS)
FIX_UNITS = _list(u for _, u in UNITS)
RAW_CAPITALS, FIX_CAPITALS = _list(w.upper() for w, _ in CONTAINER_WORDS), _list(_capital(w) for w, _ in CONTAINER_WORDS)
RAW_CAPITAL_UNITS, FIX_CAPITAL_UNITS = _list(CAPITAL_UNITS), _list(TYPOS.get(u.lower(), u) for u in CAPITAL_UNITS)


def _seg(j: int, units: str, words: str) -> str:
    return (f"CAST(p_size + {5 * j} AS VARCHAR) || ' ' || {units}[1 + (p_size + {j}) % {NU}]"
            f" || ' ' || {words}[1 + (wi + {j}) % {NW}]")


def _classify(c: str) -> str:
    whens = [f"WHEN {c} IS NULL THEN 'Unit-Priced'",
             f"WHEN lower({c}) IN ('price unavailable', 'not for sale') THEN 'Placeholder'"]
    for line in CLASSES.strip().split("\n"):
        label, words = line.split(": ")
        cond = " OR ".join(f"{c} ILIKE '%{w}%'" for w in words.split(" | "))
        whens.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(whens) + " ELSE 'N/A' END"


def money(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


# Expected catalog, as CTEs.  ``pk`` keeps the source part key next to each
# medicine so child rows can be derived from its numbers.
CATALOG = f"""
p AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size,
         CAST(p_retailprice AS DECIMAL(10,2)) AS u,
         p_partkey % {N_FORMATS} AS fmt,
         (p_partkey // {N_FORMATS}) % {NW} AS wi
  FROM part),
sz AS (
  SELECT *,
    {_seg(0, FIX_UNITS, FIX_WORDS)} AS s0,
    {_seg(1, FIX_UNITS, FIX_WORDS)} AS s1,
    {_seg(2, FIX_UNITS, FIX_WORDS)} AS s2,
    {_seg(0, RAW_UNITS, RAW_WORDS)} AS r0,
    {_seg(1, RAW_UNITS, RAW_WORDS)} AS r1,
    {_seg(2, RAW_UNITS, RAW_WORDS)} AS r2,
    CAST(p_size AS VARCHAR) || ' ' || {RAW_CAPITAL_UNITS}[1 + p_size % {NU}] || ' ' || {RAW_CAPITALS}[1 + wi] AS c0,
    CAST(p_size AS VARCHAR) || ' ' || {FIX_CAPITAL_UNITS}[1 + p_size % {NU}] || ' ' || {FIX_CAPITALS}[1 + wi] AS k0,
    CAST(u AS DECIMAL(10,1)) AS tenth,
    CASE p_size % 4 WHEN 0 THEN 'price unavailable' WHEN 2 THEN 'Price Unavailable'
                    WHEN 1 THEN 'NOT FOR SALE' ELSE 'Not for sale' END AS sale,
    CAST(u * p_size AS DECIMAL(10,2)) AS big,
    p_partkey % 5 AS nb
  FROM p),
dosage_form AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS dosage_form_id,
         name AS dosage_form_name, slug
  FROM (SELECT p_brand AS name,
               min(lower(replace(p_brand, '#', '-')) || '-' || CAST(p_size AS VARCHAR)) AS slug
        FROM part WHERE p_brand IS NOT NULL AND p_brand <> '' GROUP BY p_brand)),
manufacturer AS (
  SELECT CAST(row_number() OVER (ORDER BY s_name) AS BIGINT) AS manufacturer_id,
         s_name AS manufacturer_name, lower(replace(s_name, '#', '-')) AS slug
  FROM supplier WHERE s_name IS NOT NULL AND s_name <> ''),
indication AS (
  SELECT CAST(row_number() OVER (ORDER BY n_name) AS BIGINT) AS indication_id,
         n_name AS indication_name, lower(n_name) AS slug
  FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)
    AND n_name IS NOT NULL AND n_name <> ''),
drug_class_base AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS drug_class_id,
         name AS drug_class_name, slug
  FROM (SELECT p_type AS name, min(lower(p_type) || '-' || CAST(p_size AS VARCHAR)) AS slug
        FROM part WHERE p_type IS NOT NULL AND p_type <> '' GROUP BY p_type)),
generic_src AS (
  SELECT p_name AS name, replace(p_name, ' ', '-') || '-' || CAST(p_size AS VARCHAR) AS slug,
         p_type || CASE WHEN p_size > 45 THEN ' II' ELSE '' END AS cls
  FROM part),
drug_class AS (
  SELECT * FROM drug_class_base
  UNION ALL
  SELECT CAST((SELECT coalesce(max(drug_class_id), 0) FROM drug_class_base)
              + row_number() OVER (ORDER BY cls) AS BIGINT), cls, CAST(NULL AS VARCHAR)
  FROM (SELECT DISTINCT cls FROM generic_src
        WHERE cls NOT IN (SELECT drug_class_name FROM drug_class_base))),
generic AS (
  SELECT CAST(row_number() OVER (ORDER BY g.name) AS BIGINT) AS generic_id,
         g.name AS generic_name, g.slug, d.drug_class_id
  FROM (SELECT name, slug, cls FROM generic_src WHERE name IS NOT NULL AND name <> ''
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY slug, cls) = 1) g
  JOIN drug_class d ON d.drug_class_name = g.cls),
first_supp AS (SELECT l_partkey, min(l_suppkey) AS supp FROM lineitem GROUP BY l_partkey),
medicine_pk AS (
  SELECT CAST(row_number() OVER (ORDER BY brand_name, slug) AS BIGINT) AS brand_id, *
  FROM (SELECT p.p_name || CASE WHEN p.p_size % 3 = 0 THEN ',' || lower(p.p_type) ELSE '' END
                 AS brand_name,
               CASE WHEN p.p_size % 7 = 0 THEN 'herbal' ELSE 'allopathic' END AS type,
               'p-' || CAST(p.p_partkey AS VARCHAR) AS slug,
               df.dosage_form_id, g.generic_id,
               CAST(p.p_size AS VARCHAR) || ' mg' AS strength,
               m.manufacturer_id, p.p_partkey AS pk
        FROM part p
        LEFT JOIN first_supp f ON f.l_partkey = p.p_partkey
        LEFT JOIN supplier s ON s.s_suppkey = f.supp
        LEFT JOIN manufacturer m ON m.manufacturer_name = s.s_name AND p.p_size % 23 <> 0
        LEFT JOIN dosage_form df ON df.dosage_form_name = p.p_brand
        LEFT JOIN generic g ON g.generic_name = p.p_name)),
medicine AS (
  SELECT brand_id, brand_name, type, slug, dosage_form_id, generic_id, strength, manufacturer_id
  FROM medicine_pk),
mc AS (SELECT m.brand_id, m.brand_name, s.* FROM medicine_pk m JOIN sz s ON s.p_partkey = m.pk),
medicine_raw AS (
  SELECT brand_id,
    CASE WHEN fmt IN (0, 11, 14, 17, 19) THEN 'A single'
         WHEN fmt = 1 THEN 'B with pack'
         WHEN fmt = 2 THEN 'B plain'
         WHEN fmt IN (3, 8, 9, 16, 18) THEN 'A multiple'
         WHEN fmt = 15 OR fmt = 13 AND p_size % 5 = 0 THEN 'none'
         ELSE 'unpriced' END AS container_format,
    CAST(CASE WHEN fmt = 0 THEN big WHEN fmt IN (1, 2, 14, 17, 19) THEN u END AS DECIMAL(10,2))
      AS unit_price,
    CASE WHEN fmt = 0 THEN r0 || ': ৳ ' || {money('big')}
         WHEN fmt = 3 THEN r0 || ': ৳ ' || {money('big')} || ',' || r1 || ': ৳ '
                           || CAST(u AS VARCHAR)
         WHEN fmt IN (4, 5) THEN r0
         WHEN fmt IN (6, 7) THEN r0 || ',' || r1
         WHEN fmt IN (8, 11) THEN r0 || ': ৳ ' || CAST(u AS VARCHAR)
         WHEN fmt = 10 THEN r0 || ',' || r1 || ',' || r2
         WHEN fmt = 9 THEN r0 || ': ৳ ' || CAST(u AS VARCHAR) || ',' || r0 || ': ৳ ' || CAST(u AS VARCHAR)
         WHEN fmt = 12 THEN sale
         WHEN fmt = 13 AND p_size % 5 <> 0 THEN r0
         WHEN fmt = 14 THEN r0 || ',' || r1 || ': ৳ ' || CAST(u AS VARCHAR)
         WHEN fmt = 16 THEN r0 || ': ৳ ' || CAST(tenth AS VARCHAR) || ',' || r1 || ': ৳ ' || CAST(u AS VARCHAR) || '0'
         WHEN fmt = 17 THEN r0 || ':৳' || CAST(u AS VARCHAR)
         WHEN fmt = 18 THEN r0 || ': ৳ TBA,' || r1 || ': ৳ ' || CAST(u AS VARCHAR)
         WHEN fmt = 19 THEN c0 || ': ৳ ' || CAST(u AS VARCHAR)
    END AS package_container,
    CASE WHEN fmt IN (0, 8, 11, 14, 17, 19) THEN 1 WHEN fmt IN (3, 9, 16, 18) THEN 2 ELSE 0 END AS container_signs,
    nb, p_size, u
  FROM mc),
container_rows AS (
  SELECT brand_id, 0 AS pos, s0 AS container_size, big AS unit_price FROM mc WHERE fmt = 0
  UNION ALL SELECT brand_id, 0, NULL, u FROM mc WHERE fmt IN (1, 2)
  UNION ALL SELECT brand_id, 0, s0, big FROM mc WHERE fmt = 3
  UNION ALL SELECT brand_id, 1, s1, u FROM mc WHERE fmt = 3
  UNION ALL SELECT brand_id, 0, s0, NULL FROM mc WHERE fmt IN (4, 5, 6, 7, 10, 14)
  UNION ALL SELECT brand_id, 1, s1, NULL FROM mc WHERE fmt IN (6, 7, 10)
  UNION ALL SELECT brand_id, 2, s2, NULL FROM mc WHERE fmt = 10
  UNION ALL SELECT brand_id, 0, s0, u FROM mc WHERE fmt IN (8, 11)
  UNION ALL SELECT brand_id, 0, s0, u FROM mc WHERE fmt IN (9, 17)
  UNION ALL SELECT brand_id, 1, s0, u FROM mc WHERE fmt = 9
  UNION ALL SELECT brand_id, 0, s0, tenth FROM mc WHERE fmt = 16
  UNION ALL SELECT brand_id, 1, s1, u FROM mc WHERE fmt IN (16, 18)
  UNION ALL SELECT brand_id, 0, s0, NULL FROM mc WHERE fmt = 18
  UNION ALL SELECT brand_id, 0, k0, u FROM mc WHERE fmt = 19
  UNION ALL SELECT brand_id, 0, sale, NULL FROM mc WHERE fmt = 12
  UNION ALL SELECT brand_id, 0, s0, NULL FROM mc WHERE fmt = 13 AND p_size % 5 <> 0
  UNION ALL SELECT brand_id, 1, s1, u FROM mc WHERE fmt = 14),
medicine_package_container AS (
  SELECT CAST(row_number() OVER (ORDER BY brand_id, pos) AS BIGINT) AS package_container_id,
         brand_id, container_size, CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
         {_classify('container_size')} AS container_type
  FROM container_rows),
pack_rows AS (
  SELECT brand_id, i - 1 AS pos, CASE WHEN i = 1 AND p_size % 11 = 0 THEN NULL ELSE CAST(10 * i AS INTEGER) END AS pack_size,
         CASE WHEN i = 1 AND p_size % 17 = 0 THEN NULL ELSE CAST(u * 3 * i AS DECIMAL(10,2)) END AS pack_price
  FROM (SELECT brand_id, u, p_size, unnest(generate_series(1, nb)) AS i FROM mc WHERE nb > 0)),
medicine_package_size AS (
  SELECT CAST(row_number() OVER (ORDER BY brand_id, pos) AS BIGINT) AS package_size_id,
         brand_id, pack_size, pack_price
  FROM pack_rows),
generic_indication AS (
  SELECT CAST(row_number() OVER (ORDER BY generic_id, indication_id) AS BIGINT)
           AS generic_indication_id, generic_id, indication_id
  FROM (SELECT DISTINCT g.generic_id, i.indication_id
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) l
        JOIN part pp ON pp.p_partkey = l.l_partkey
        JOIN supplier s ON s.s_suppkey = l.l_suppkey
        JOIN nation n ON n.n_nationkey = s.s_nationkey
        JOIN generic g ON g.generic_name = pp.p_name
        JOIN indication i ON i.indication_name = n.n_name))
"""


def with_catalog(select: str) -> str:
    return "WITH " + CATALOG.strip() + "\n" + select.strip()
