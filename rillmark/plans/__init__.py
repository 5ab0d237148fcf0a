"""Registered queries, one module per family; each has its DuckDB text beside it."""

import importlib

FAMILIES = ("statistics", "elementary", "distributions", "relational", "spatial", "power", "crops", "streams")


def load_all():
    """Import every family and return the filled registry."""
    for family in FAMILIES:
        importlib.import_module(f"rillmark.plans.{family}")
    return importlib.import_module("rillmark.plans.registry")
