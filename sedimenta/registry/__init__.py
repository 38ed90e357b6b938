"""All registered queries.  Importing a module registers its queries."""

from importlib import import_module

from sedimenta.registry.base import ORACLES, QUERIES

MODULES = [
    "scans", "relational", "quality", "ordered", "changes", "business", "governance", "operations", "insight", "flows", "catalog",
]

for _name in MODULES:
    import_module(f"sedimenta.registry.{_name}")

__all__ = ["ORACLES", "QUERIES"]
