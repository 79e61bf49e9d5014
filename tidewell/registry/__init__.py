"""Registered queries over the test tables, each with its check SQL."""

from __future__ import annotations

from . import checks, cleaning, incremental, merging, operations, statistics, storage

GROUPS = (cleaning, checks, statistics, merging, operations, storage, incremental)


def all_queries() -> dict:
    return {name: query for group in GROUPS for name, query in group.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql.strip() for group in GROUPS for name, sql in group.ORACLES.items()}
