"""Retail and wholesale analytics as lazy PySpark plans.

``sources``    landing files -> typed DataFrames
``operators``  load strategies, the table store and shared aggregations
``plans``      the business questions, as functions ``(tables, as_of) -> DataFrame``
``jobs``       nightly refresh and resumable backfill
"""
