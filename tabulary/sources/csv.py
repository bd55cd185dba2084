"""Delimited source files with declared schemas (survey A1-A4).

Never ``inferSchema``: each source has a fixed ``StructType``.  Executors
read file splits in parallel, of quoted files too; the header row is skipped;
UTF-8 with or without a byte-order mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quoted import file_names, parsed, quoted_records, read_quoted
from .staging import staged

S, I = T.StringType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Staging layouts of the six source files.
DRUG_CLASS = _schema(("Drug_Class_ID", I), ("Drug_Class_Name", S), ("Slug", S),
                     ("Generics_Count", I))
DOSAGE_FORM = _schema(("Dosage_Form_ID", I), ("Dosage_Form_Name", S), ("Slug", S),
                      ("Brand_Names_Count", I))
MANUFACTURER = _schema(("Manufacturer_ID", I), ("Manufacturer_Name", S), ("Slug", S),
                       ("Generics_Count", S), ("Brand_Names_Count", S))
INDICATION = _schema(("Indication_ID", I), ("Indication_Name", S), ("Slug", S),
                     ("Generics_Count", I))
GENERIC = _schema(("Generic_ID", S), ("Generic_Name", S), ("Slug", S), ("Drug_Class", S),
                  ("Indication", S))
MEDICINE = _schema(("Brand_ID", S), ("Brand_Name", S), ("Type", S), ("Slug", S),
                   ("Dosage_Form", S), ("Generic", S), ("Strength", S), ("Manufacturer", S),
                   ("Package_Container", S), ("Package_Size", S))

SCHEMAS = {"drug_class": DRUG_CLASS, "dosage_form": DOSAGE_FORM,
           "manufacturer": MANUFACTURER, "indication": INDICATION,
           "generic": GENERIC, "medicine": MEDICINE}
# Files whose fields may be quoted (FORMAT='CSV' in the modelled loads).
QUOTED = {"generic", "medicine"}


def read_source(spark: SparkSession, path: str, schema: T.StructType,
                quoted: bool = True, bad_rows: str = "FAILFAST") -> DataFrame:
    """Read one delimited file (or directory of files) with ``schema``.

    Empty fields become NULL.  With ``quoted`` a field may be wrapped in
    double quotes, with doubled quotes and line breaks inside; the file is
    read in parallel blocks all the same (``sources/quoted.py``).  Otherwise
    quotes are data.

    A row with a surplus or missing field, or a number that is none, fails the
    read, as it fails a bulk load; ``bad_rows="PERMISSIVE"`` reads what it can,
    and :func:`read_with_rejects` keeps such rows apart.
    """
    if quoted:
        df = read_quoted(spark, path, schema, bad_rows=bad_rows)
    else:
        df = (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
              .option("mode", bad_rows).option("columnPruning", False).option("quote", "\u0000").csv(path))
    # A byte-order mark on the header is skipped with the header; on a data
    # line it would stick to the first field, so strip it defensively.
    first = schema.fields[0]
    if isinstance(first.dataType, T.StringType):
        df = df.withColumn(first.name, F.regexp_replace(first.name, "^\ufeff", ""))
    return df


_BAD = "__bad"


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType,
                      quoted: bool = True) -> tuple[DataFrame, DataFrame]:
    """The good rows of the files at ``path`` and, kept apart, the bad ones:
    (file, record, reason), after one read whose result is staged.

    A row is bad if its quote isn't closed, it has a surplus or missing field
    (``fields``), or a value that its column's type can't hold (the first such
    column is named).  Rows of both tables add up to the records of the files;
    empty lines and headers are none.
    """
    wide = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    if quoted:
        records = quoted_records(spark, path).where("record <> '' AND NOT first").select("file", "open", "record")
        rows = records.withColumn("row", parsed("record", wide, "PERMISSIVE", columnNameOfCorruptRecord=_BAD))
    else:
        rows = (spark.read.schema(wide).option("header", True).option("encoding", "UTF-8").option("quote", "\u0000")
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).csv(path)
                .select(F.xxhash64("_metadata.file_path").alias("file"), F.lit(False).alias("open"),
                        F.col(_BAD).alias("record"), F.struct(*(f"`{f.name}`" for f in wide.fields)).alias("row")))
    bad = F.col("row")[_BAD].isNotNull() | F.col("open")
    # Read once more as text, and only where a row is bad, to tell why.
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wide.fields])
    quote = {} if quoted else {"quote": "\u0000"}
    said = F.when(bad, parsed("record", text, "PERMISSIVE", columnNameOfCorruptRecord=_BAD, **quote))
    value = F.coalesce(*(F.when(F.col("row")[f.name].isNull() & F.col("said")[f.name].isNotNull(), F.lit(f"value of {f.name}"))
                         for f in schema.fields), F.lit("value"))
    reason = F.when(F.col("open"), "quote not closed").when(F.col("said")[_BAD].isNotNull(), "fields").when(bad, value)
    checked = staged(rows.withColumn("said", said).select("file", "row", F.when(bad, F.col("record")).alias("record"),
                                                          reason.alias("reason")), "checked-rows")
    good = checked.where("reason IS NULL").select(*(F.col("row")[f.name].alias(f.name) for f in schema.fields))
    rejects = checked.where("reason IS NOT NULL").join(file_names(spark, path), "file").select(
        F.col("path").alias("file"), "record", "reason")
    return good, rejects


# Source file names.
FILE_NAMES = {"drug_class": "Drug_Class.csv", "dosage_form": "Dosage_Form.csv",
              "manufacturer": "Manufacturer.csv", "indication": "Indication.csv",
              "generic": "Generic.csv", "medicine": "Medicine.csv"}


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The staging sources from ``folder/<Name>.csv``.  The generic file is
    read once and serves both the generic load and the generic-indication
    junction (its ``Indication`` column)."""
    out = {k: read_source(spark, f"{folder.rstrip('/')}/{f}", SCHEMAS[k], k in QUOTED)
           for k, f in FILE_NAMES.items()}
    out["generic_indication"] = out["generic"].select(
        "Generic_Name", "Indication").filter("Indication IS NOT NULL")
    return out
