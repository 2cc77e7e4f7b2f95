"""The registered queries, each next to the SQL that checks it."""

from importlib import import_module

from rillwork.plans.registry import REGISTERED, Query

MODULES = ("retail", "timeseries", "history", "logs", "keyed", "shapes", "files", "streams")


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"rillwork.plans.{module}")
    return dict(REGISTERED)
