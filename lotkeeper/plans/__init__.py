"""Registered queries over the test tables, each next to its SQL check."""

from importlib import import_module

MODULES = ("cleaning", "matching", "availability", "merging", "extraction", "market",
           "intake", "recheck")


def all_queries():
    """(name -> query, name -> SQL) of every module."""
    from lotkeeper.plans.catalogue import ORACLES, QUERIES

    for name in MODULES:
        import_module(f"lotkeeper.plans.{name}")
    return QUERIES, ORACLES
