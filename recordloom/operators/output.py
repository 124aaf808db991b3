"""Results for delivery: one row for each source 1 record with its ids as a list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import match_ids


def grouped(records: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """(source1_entity_id, column): each record's ids of both target sources, in order; empty if it has none."""
    own = records.where("src = 1").select(F.col("entity_id").alias("s1")).distinct()
    lists = pairs.select("s1", "cand").distinct().groupBy("s1").agg(F.array_join(F.array_sort(F.collect_list("cand")), ",").alias(column))
    return own.join(lists, "s1", "left").select(F.col("s1").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def merge(existing: DataFrame, pairs: DataFrame) -> DataFrame:
    """An existing (source1_entity_id, matched_entity_ids) with further pairs merged into the lists, sorted and distinct."""
    new = pairs.groupBy(F.col("s1").alias("source1_entity_id")).agg(F.collect_set("cand").alias("_new"))
    both = F.array_union(match_ids(F.col("matched_entity_ids")), F.coalesce("_new", F.array().cast("array<string>")))
    return existing.join(new, "source1_entity_id", "left").select("source1_entity_id", F.array_join(F.array_sort(both), ",").alias("matched_entity_ids"))


def checked(result: DataFrame, records: DataFrame) -> DataFrame:
    """result, if it has exactly one row for each source 1 record; else an error."""
    want, got = records.where("src = 1").select("entity_id").distinct().count(), result.count()
    if want != got:
        raise ValueError(f"{got} rows; source 1 has {want} records")
    return result
