"""Queries over the given tables, each with its SQL oracle where there is one."""

from importlib import import_module

GROUPS = ("clean", "windows", "gold", "incremental", "views", "quality", "models", "tables", "files", "streams")


def all_queries():
    from stratawell.registry.base import QUERIES

    for group in GROUPS:
        import_module(f"stratawell.registry.{group}")
    return dict(QUERIES)
