"""Queries bound to the Parquet test tables, each with its SQL twin where one exists."""

from habitscope.registry.catalog import oracle_texts, query_functions

__all__ = ["oracle_texts", "query_functions"]
