"""Registered queries over the supplied tables, each with its SQL check."""

import importlib

MODULES = ("url_queries", "page_queries", "value_queries", "index_queries", "file_queries", "job_queries")


def load():
    """(queries, SQL) by name."""
    from weblode.catalog import registry

    for name in MODULES:
        importlib.import_module(f"weblode.catalog.{name}")
    return registry.QUERIES, registry.ORACLES
