"""All named queries."""

from __future__ import annotations

from importlib import import_module

from orderlens.plans.registry import Registry

FAMILIES = ["risk", "vectors", "retrieval", "dialogue", "jobs", "models"]


def all_queries() -> Registry:
    merged = Registry()
    for family in FAMILIES:
        found = import_module(f"orderlens.plans.{family}").queries
        overlap = set(merged) & set(found)
        if overlap:
            raise ValueError(f"query names used twice: {sorted(overlap)}")
        merged.update(found)
    return merged
