"""Writing tables, load counts and schema reports (survey A5, A6, A9, A10, A12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, name: str | None = None) -> int:
    """Overwrite ``path`` with ``df`` as Parquet and return the row count,
    observed during the write (no second pass).  Rerunning replaces the
    previous output (full refresh)."""
    obs = Observation(name or "rows")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def schema_report(df: DataFrame, table: str) -> list[tuple[str, str, str, str]]:
    """(table, column, data type, nullable) for each column, from the schema
    alone -- no data is read."""
    return [(table, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
            for f in df.schema.fields]


def schema_report_df(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    rows = [r for name, df in tables.items() for r in schema_report(df, name)]
    schema = T.StructType([T.StructField(n, T.StringType(), False)
                           for n in ("table_name", "column_name", "data_type", "is_nullable")])
    return spark.createDataFrame(rows, schema)
