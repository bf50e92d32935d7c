"""All registered queries with their SQL counterparts."""

from cargolith.catalog import registry


def load():
    """Imports every catalogue module and returns (queries, sql)."""
    from importlib import import_module

    for name in registry.MODULES:
        import_module(f"cargolith.catalog.{name}")
    return registry.QUERIES, registry.SQL
