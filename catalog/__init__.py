"""Registered queries over the given tables, each with the SQL that gives the same rows."""

from importlib import import_module

MODULES = ["plans", "indicators", "bars", "book", "flow", "stats", "accounts", "streams"]


def _merged(attribute):
    out = {}
    for name in MODULES:
        part = getattr(import_module(f"catalog.{name}"), attribute)
        clash = set(out) & set(part)
        if clash:
            raise RuntimeError(f"registered twice: {clash}")
        out.update(part)
    return out


def all_queries():
    return _merged("QUERIES")


def all_oracles():
    return _merged("ORACLES")
