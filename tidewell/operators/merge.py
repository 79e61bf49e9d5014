"""Keyed insert-or-update with a partial update set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .rules import duplicated_keys


class DuplicateKeys(Exception):
    """A batch holds the same key twice, so one row would be hit by two updates."""


def require_unique(delta: DataFrame, keys: Sequence[str]) -> None:
    repeated = duplicated_keys(delta, keys).orderBy(*keys).limit(5).collect()
    if repeated:
        shown = ", ".join(str(tuple(r)[: len(keys)]) for r in repeated)
        raise DuplicateKeys(f"Batch holds duplicate keys {list(keys)}: {shown}")


def upsert(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None
) -> DataFrame:
    """Base with the delta applied: new keys are inserted whole, known keys change only
    in ``update_columns`` (default: every non-key column).

    Both sides hold a key at most once, so the shuffle on the full key is even and a row
    never meets more than one partner.
    """
    keys = list(keys)
    values = [c for c in base.columns if c not in keys]
    updated = set(values if update_columns is None else update_columns)
    unknown = updated - set(values)
    if unknown:
        raise ValueError(f"Not columns of the base table: {sorted(unknown)}")
    old = base.select(*keys, F.struct(*values).alias("_old"))
    new = delta.select(*keys, F.struct(*values).alias("_new"))
    known, given = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    merged = []
    for name in values:
        before, after = F.col("_old")[name], F.col("_new")[name]
        take = given if name in updated else (given & ~known)
        merged.append(F.when(take, after).otherwise(before).alias(name))
    joined = old.join(new, keys, "full_outer").select(*keys, *merged)
    return joined.select(*base.columns)
