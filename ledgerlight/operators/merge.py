"""Keyed merges without a table format: a snapshot and its changes give the next snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str], sticky: Column | None = None) -> DataFrame:
    """The union by key: new values where they differ, old rows that are missing from new, and an action for each row.

    sticky: a condition on old columns (prefixed "old_") under which a row keeps all its values.
    """
    o = old.select(*[F.col(c).alias(f"old_{c}") for c in old.columns])
    n = new.select(*[F.col(c).alias(f"new_{c}") for c in new.columns])
    on = [o[f"old_{k}"] == n[f"new_{k}"] for k in keys]
    joined = o.join(n, on, "full_outer")
    held, came = F.col(f"old_{keys[0]}").isNotNull(), F.col(f"new_{keys[0]}").isNotNull()
    same = F.struct(*[F.col(f"old_{c}") for c in compare]).eqNullSafe(F.struct(*[F.col(f"new_{c}") for c in compare]))
    keep = ~came | (F.coalesce(sticky, F.lit(False)) & held if sticky is not None else F.lit(False))
    action = F.when(~held, "insert").when(~came, "missing").when(same, "same").when(keep, "kept").otherwise("update")
    columns = [F.when(keep, F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c) for c in new.columns]
    return joined.select(*columns, action.alias("action"))
