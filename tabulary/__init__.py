"""tabulary: a PySpark library for building and checking a relational
product catalog from messy delimited sources.

Layout
------
sources/    reading delimited files with explicit schemas, writing tables,
            schema reports, driver-table analogues
functions/  Column -> Column helpers (text cleaning, packed price and
            container text, typo fixes, classification rules)
operators/  DataFrame -> DataFrame operators (dimensions, dense keys,
            foreign keys, junctions, child-table parsing, quality checks,
            reports)
plans/      whole pipelines (`build_catalog`, `validate`) and the registry
            of named queries used by ``__spark_entry__``
streaming/  nothing: every load in the modelled ETL is a whole-file batch
"""

__version__ = "0.1.0"

from .operators.dims import backfill_dimension, dedupe_by_key, load_dimension  # noqa: E402
from .operators.joins import build_junction, resolve_fk  # noqa: E402
from .operators.keys import with_dense_key  # noqa: E402
from .operators.quality import assert_checks  # noqa: E402
from .plans.catalog import (PUBLISHED_RESULTS, LazyCatalog, build_catalog,  # noqa: E402
                            quality_checks, validate, write_catalog)
from .sources.csv import read_source, read_sources  # noqa: E402

__all__ = ["PUBLISHED_RESULTS", "LazyCatalog", "assert_checks", "backfill_dimension",
           "build_catalog", "build_junction", "dedupe_by_key", "load_dimension",
           "quality_checks", "read_source", "read_sources", "resolve_fk", "validate",
           "with_dense_key", "write_catalog"]
