"""The registered queries."""

from importlib import import_module

_MODULES = [
    "ledger_queries",
    "pixel_queries",
    "stream_queries",
    "quality_queries",
    "model_queries",
    "lake_queries",
    "sketch_queries",
    "keyed_queries",
]


def load():
    """Import every query module and return the catalogue they filled."""
    for name in _MODULES:
        import_module(f"tidelake.plans.{name}")
    return import_module("tidelake.plans.catalogue")
