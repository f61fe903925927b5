"""Queries that can be checked against SQL on the given tables."""

import importlib

MODULES = ("quality", "reports", "merging", "values", "extraction", "storage", "history", "bitmaps")


def load():
    """Import all check modules and return the registry."""
    for name in MODULES:
        importlib.import_module(f"specloom.checks.{name}")
    from specloom.checks import base
    return base
