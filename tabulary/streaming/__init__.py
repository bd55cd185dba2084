"""Streaming: intentionally empty.

Every load of the modelled ETL is a whole-file batch with a full refresh of
its output; there are no watermarks, windows, state or late data to model.
Incremental sources can call ``tabulary.plans.catalog.build_catalog`` from a
batch job per arriving file set.
"""
