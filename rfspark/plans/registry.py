"""All registered queries and their SQL checks, by area."""

from __future__ import annotations

import functools
import importlib

from rfspark.session import ship

AREAS = ["continuity", "scalars", "headers", "geometry", "blocks", "spectral", "linkbudget", "health", "catalogue", "feeds"]


def _gather(kind: str) -> dict:
    out = {}
    for area in AREAS:
        for name, item in getattr(importlib.import_module(f"rfspark.plans.{area}"), kind).items():
            if name in out:
                raise ValueError(f"query {name} is registered twice")
            out[name] = item
    return out


def _shipping(fn):
    @functools.wraps(fn)
    def run(spark, sf):
        ship(spark)
        return fn(spark, sf)

    return run


def queries() -> dict:
    return {name: _shipping(fn) for name, fn in _gather("QUERIES").items()}


def oracle_sql() -> dict:
    return _gather("ORACLE")
