"""Cleaning and profiles of records and match lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

TEXT_COLUMNS = ("business_name", "business_address", "country")
ID_COLUMNS = ("entity_id", "source1_entity_id")
LIST_COLUMN = "matched_entity_ids"


def add_normalized(df: DataFrame) -> DataFrame:
    """df with <column>_normalized appended for each text, id and match list column that it has; the others stay."""
    new = {f"{c}_normalized": text.normalized_text(F.col(c)) for c in TEXT_COLUMNS if c in df.columns}
    new |= {f"{c}_normalized": text.strip(F.coalesce(F.col(c), F.lit(""))) for c in ID_COLUMNS if c in df.columns}
    if LIST_COLUMN in df.columns:
        new[f"{LIST_COLUMN}_normalized"] = text.normalized_list(F.col(LIST_COLUMN))
    return df.withColumns(new)


def profile(df: DataFrame) -> DataFrame:
    """Of a cleaned table, in one pass: per source column its blank values, and how many its normalized column changed."""
    source = [c for c in df.columns if not c.endswith("_normalized")]
    changed = lambda c: F.sum((F.col(c) != F.col(f"{c}_normalized")).cast("long")) if f"{c}_normalized" in df.columns else F.lit(0).cast("long")
    rows = df.agg(F.count("*").alias("rows"), *[F.struct(F.lit(c).alias("column"), F.coalesce(F.sum((text.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "").cast("long")), F.lit(0)).alias("blank"), F.coalesce(changed(c), F.lit(0)).alias("changed")).alias(f"_{i}") for i, c in enumerate(source)])
    return rows.select("rows", F.explode(F.array(*[f"_{i}" for i in range(len(source))])).alias("p")).select("p.column", "rows", "p.blank", "p.changed")


def match_ids(c):
    """The non-empty items of a comma list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), text.strip), lambda x: x != "")


def match_list_profile(df: DataFrame) -> DataFrame:
    """One row: blank and other lists, with one and several ids, and lists that aren't blank but hold no id."""
    ids, blank = F.size(match_ids(F.col(LIST_COLUMN))), text.strip(F.coalesce(F.col(LIST_COLUMN), F.lit(""))) == ""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return df.agg(F.count("*").alias("rows"), n(blank).alias("blank"), n(~blank).alias("nonblank"), n(ids == 1).alias("one"), n(ids > 1).alias("many"), n(~blank & (ids == 0)).alias("unparseable"))


def match_list_examples(df: DataFrame, n: int = 3) -> DataFrame:
    """The first lists by id that hold an id."""
    return df.where(F.size(match_ids(F.col(LIST_COLUMN))) > 0).orderBy("source1_entity_id", LIST_COLUMN).limit(n)


def truth_pairs(df: DataFrame) -> DataFrame:
    """(src, s1, cand) of a ground truth table; ids of other prefixes than S2- and S3- are left out."""
    rows = df.select(text.strip(F.col("source1_entity_id")).alias("s1"), F.explode(match_ids(F.col(LIST_COLUMN))).alias("cand"))
    return rows.withColumn("src", F.when(F.col("cand").startswith("S2-"), 2).when(F.col("cand").startswith("S3-"), 3)).where("src is not null").select("src", "s1", "cand").distinct()


def count_check(counts: dict[str, tuple[int, int]]) -> dict[str, str]:
    """PASS or MISMATCH for each name's (found, expected) number of rows."""
    return {name: "PASS" if found == expected else "MISMATCH" for name, (found, expected) in counts.items()}


def id_kinds(ids) -> tuple:
    """A list's ids of source 2, of source 3, and all others."""
    return F.filter(ids, lambda x: x.startswith("S2-")), F.filter(ids, lambda x: x.startswith("S3-")), F.filter(ids, lambda x: ~x.startswith("S2-") & ~x.startswith("S3-"))
