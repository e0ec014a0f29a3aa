"""Dense 0-based ids of stores and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.features import Stage


def dense_ids(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rank of every distinct ``key`` (an INTEGER), from 0.

    Keys are cut into blocks of 65,536 values. A key's rank is its position inside its block
    plus the number of keys in earlier blocks, so a ranking task sees at most 65,536 keys and
    the running total over blocks at most 65,536 rows, whatever the table holds.
    """
    block = F.shiftright(F.col(key), 16).alias("_block")
    keys = df.select(key).where(F.col(key).isNotNull()).distinct().select(key, block)
    ranked = keys.withColumn(
        "_place", F.row_number().over(Window.partitionBy("_block").orderBy(key))
    )
    sizes = keys.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    # Every block has an offset. As a left join it adds no filter to one side only, so both sides
    # read the same shuffled keys.
    return ranked.join(offsets, "_block", "left").select(
        key, (F.col("_offset") + F.col("_place") - 1).cast("int").alias(out)
    )


def with_entity_ids(df: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Attach ``store_id`` and ``item_id``. The id tables come from ``df`` as a whole."""
    for key, out in (("store_nbr", "store_id"), ("item_nbr", "item_id")):
        ids = dense_ids(df, key, out)
        if stage is not None:
            ids = stage(ids, out)
        df = df.join(ids, key, "left")
    return df


def with_saved_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Attach ``store_id`` and ``item_id`` from a table of entity_ids; -1 for keys it lacks."""
    for entity, key in (("store", "store_nbr"), ("item", "item_nbr")):
        known = ids.where(F.col("entity") == entity).select(
            F.col("nbr").alias(key), F.col("id").alias(f"{entity}_id")
        )
        df = df.join(known, key, "left").withColumn(
            f"{entity}_id", F.coalesce(f"{entity}_id", F.lit(-1))
        )
    return df


def entity_ids(df: DataFrame) -> DataFrame:
    """Both id tables in long form: (entity, nbr, id)."""
    stores = dense_ids(df, "store_nbr", "id").select(
        F.lit("store").alias("entity"), F.col("store_nbr").alias("nbr"), "id"
    )
    items = dense_ids(df, "item_nbr", "id").select(
        F.lit("item").alias("entity"), F.col("item_nbr").alias("nbr"), "id"
    )
    return stores.unionByName(items)
