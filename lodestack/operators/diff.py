"""Keyed differences, merges and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fingerprint(*columns: Column) -> Column:
    """SHA-256 of the values in order; null and empty differ."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]), 256)


def keyed_diff(before: DataFrame, after: DataFrame, key: str, print_col: str) -> DataFrame:
    """(key, change): added, updated or deleted; keys with equal fingerprints are left out."""
    a = before.select(F.col(key).alias("_a"), F.col(print_col).alias("_fa"))
    b = after.select(F.col(key).alias("_b"), F.col(print_col).alias("_fb"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "deleted").when(~F.col("_fa").eqNullSafe(F.col("_fb")), "updated")
    return a.join(b, F.col("_a") == F.col("_b"), "full_outer").select(F.coalesce("_a", "_b").alias(key), change.alias("change")).where("change IS NOT NULL")


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(store: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """store with the rows of equal keys replaced and the others added."""
    return store.join(rows.select(keys).distinct(), keys, "left_anti").unionByName(rows)


def delete(store: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return store.join(gone.select(keys).distinct(), keys, "left_anti")


def apply_diff(before: DataFrame, after: DataFrame, key: str, print_col: str) -> DataFrame:
    """before brought to the state of after by its difference alone."""
    change = keyed_diff(before, after, key, print_col)
    kept = before.join(change, key, "left_anti")
    return kept.unionByName(after.join(change.where("change <> 'deleted'").select(key), key, "left_semi"))


def overlay(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Ledger merge: fields of new over those of old, by key; keys of either side stay."""
    a = old.select(*[F.col(c).alias(f"_o_{c}") for c in old.columns])
    joined = a.join(new, a[f"_o_{key}"] == new[key], "full_outer")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"_o_{c}")).alias(c) if c in new.columns else F.col(f"_o_{c}").alias(c) for c in old.columns])
