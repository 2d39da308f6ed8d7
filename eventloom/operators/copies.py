"""Copies of a key: one stays, equal copies are duplicates, differing copies all conflict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONFLICT, DUPLICATE = "conflicting_event_id", "duplicate_event_id"


def packed(columns: Sequence[str]) -> Column:
    """Business columns as one struct: its order is exact, and tells null from empty."""
    return F.struct(*columns)


def tag_copies(frame: DataFrame, key: Sequence[str], business: Sequence[str], provenance: str, reason: str = "rejection_reason") -> DataFrame:
    """Add the reason by windows over the key: one exchange, min and max of the packed struct.

    The struct decides conflicts exactly, without a hash. The copy with the smallest provenance
    (nulls last) stays.
    """
    whole = Window.partitionBy(*key)
    ordered = whole.orderBy(F.asc_nulls_last(provenance))
    numbered = frame.withColumns(
        {
            "__low": F.min(packed(business)).over(whole),
            "__high": F.max(packed(business)).over(whole),
            "__copy": F.row_number().over(ordered),
        }
    )
    differs = ~F.col("__low").eqNullSafe(F.col("__high"))
    return numbered.withColumn(reason, F.when(differs, CONFLICT).when(F.col("__copy") > 1, DUPLICATE)).drop("__low", "__high", "__copy")


def tag_copies_skewed(frame: DataFrame, key: Sequence[str], business: Sequence[str], provenance: str, reason: str = "rejection_reason") -> DataFrame:
    """The same rows as tag_copies, for keys with very many copies.

    Equal rows are counted before they are shuffled, keys are aggregated from those counts, and
    the counts are expanded again at the end: no task holds the copies of one key.
    """
    columns = frame.columns
    counted = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    keyed = counted.groupBy(*(F.col(k).alias(f"__k_{i}") for i, k in enumerate(key))).agg(
        F.min(packed(business)).alias("__low"),
        F.max(packed(business)).alias("__high"),
        F.min(F.struct(F.col(provenance).isNull().alias("late"), F.col(provenance).alias("at"))).alias("__first"),
    )
    on = [F.col(k).eqNullSafe(F.col(f"__k_{i}")) for i, k in enumerate(key)]
    joined = counted.join(keyed, on)
    conflict = ~F.col("__low").eqNullSafe(F.col("__high"))
    # Copies without conflict may still differ in other columns; the smallest of those rows stays.
    others = [c for c in columns if c not in key]
    first = F.col(provenance).eqNullSafe(F.col("__first.at"))
    ties = joined.filter(~conflict & first).groupBy(*(f"__k_{i}" for i in range(len(key)))).agg(F.min(F.struct(*others)).alias("__kept"))
    ties = ties.select("__kept", *(F.col(f"__k_{i}").alias(f"__t_{i}") for i in range(len(key))))
    placed = joined.join(ties, [F.col(f"__k_{i}").eqNullSafe(F.col(f"__t_{i}")) for i in range(len(key))], "left")
    keeps = ~conflict & F.coalesce(F.struct(*others).eqNullSafe(F.col("__kept")), F.lit(False))
    copies = placed.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    return copies.select(*columns, F.when(conflict, CONFLICT).when(~(keeps & (F.col("__i") == 1)), DUPLICATE).alias(reason))


def tag_copies_hashed(frame: DataFrame, key: Sequence[str], business: Sequence[str], provenance: str, reason: str = "rejection_reason") -> DataFrame:
    """The same rows again: one hash of a row decides most keys, without moving rows.

    Every key's copies, least and greatest hash are counted first. Different hashes are different copies; a
    hash skips nulls, so only the rows of keys with several copies of one hash are compared in full. Rows
    of keys without copies are never moved but to meet their verdict.
    """
    columns, ks = frame.columns, [f"__k_{i}" for i in range(len(key))]
    named = [F.col(k).alias(n) for k, n in zip(key, ks, strict=True)]
    digest = F.xxhash64(packed(business))
    several = frame.groupBy(*named).agg(F.count(F.lit(1)).alias("__n"), F.min(digest).alias("__low"), F.max(digest).alias("__high")).filter(F.col("__n") > 1)

    def meet(keys: DataFrame, how: str) -> DataFrame:
        return frame.join(keys, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, ks, strict=True)], how)

    doubtful = meet(several.filter(F.col("__low") == F.col("__high")).select(*ks), "inner")
    compared = doubtful.groupBy(*ks).agg((~F.min(packed(business)).eqNullSafe(F.max(packed(business)))).alias("__differs"))
    verdicts = several.filter(F.col("__low") != F.col("__high")).select(*ks, F.lit(True).alias("__differs")).unionByName(compared)
    alone = meet(several.select(*ks), "left_anti").select(*columns, F.lit(None).cast("string").alias(reason))
    place = F.row_number().over(Window.partitionBy(*ks).orderBy(F.asc_nulls_last(provenance)))
    copies = meet(verdicts, "inner").withColumn("__place", place)
    return alone.unionByName(copies.select(*columns, F.when(F.col("__differs"), CONFLICT).when(F.col("__place") > 1, DUPLICATE).alias(reason)))
