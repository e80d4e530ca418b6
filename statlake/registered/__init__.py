"""Queries over the driver tables, each with equivalent SQL."""

from statlake.registered import layouts, loads, models, operators, sources
from statlake.registered.base import Registry


def registry() -> Registry:
    merged = Registry()
    for module in (operators, models, sources, loads, layouts):
        merged.update(module.REGISTRY)
    return merged
