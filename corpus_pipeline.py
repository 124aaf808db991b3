"""The corpus pipeline: five stages over `documents`, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import common, decontamination, jaccard_join, language_id, mixing, secret_scan

#: A document is rejected if its language can't be told (und), or less surely than this.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the model learns from those of them that carry one. Null, empty and letterless texts go. Rows that
    repeat stay, and so do null ids; each row's own columns stay as they are, whatever their names."""
    told = common.free(docs, "_told")
    out = language_id.predict(docs, language_id.fit(docs, F.lit(True)), told)
    return out.where((F.col(f"{told}.lang_pred") != "und") & (F.col(f"{told}.score") >= LEAST_SCORE)).select(*docs.columns)


def _rows_told_apart(docs: DataFrame, row: str, work: str) -> DataFrame:
    """docs with the column `row`: doc_id where it is one row's only, else a hash of doc_id and text, beyond 2**62; rows equal in both share it."""
    id_, again = common.free(docs, "_id"), common.free(docs, "_again")
    repeated = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(id_)).count().where("count > 1").select(id_, F.lit(True).alias(again))
    docs = docs.join(common.small(common.table(repeated, f"{work}/repeated")), F.col("doc_id") == F.col(id_), "left")
    mark = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return docs.withColumn(row, F.when(F.col("doc_id").isNull() | F.col(again).isNotNull(), mark).otherwise(F.col("doc_id").cast("long"))).drop(id_, again)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of similar shingles connect, the row with the smallest doc_id, those without doc_id last; of rows with the
    same doc_id, or none, and the same text one. Null and empty texts are like no other; an empty table gives none. Own columns stay, whatever
    their names."""
    work, row = common.shared_dir(spark), common.free(docs, "_row")
    told = _rows_told_apart(docs, row, work)
    joined = jaccard_join.join(told.select(F.col(row).alias("doc_id"), "text"), f"{work}-join").select(F.col("doc_id").alias("_row"), "component_id")
    # Only rows told apart by a hash can be alike in `row`, or stand out of order in it; in groups without them component_id is the least.
    ids = told.where(F.col(row) >= 1 << 62).select(F.col(row).alias("_row"), "doc_id").groupBy("_row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    ids = common.table(ids, f"{work}/ids")
    later = joined.where("_row <> component_id")
    mixed = common.small(common.table(joined.join(common.small(ids), "_row", "left_semi").select("component_id").distinct(), f"{work}/mixed"))
    members = joined.join(mixed, "component_id", "left_semi").distinct().join(common.small(ids), "_row", "left").withColumn("_id", F.when(F.col("n").isNull(), F.col("_row")).otherwise(F.col("doc_id")))
    kept = members.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("s")).select("component_id", F.col("s._row").alias("kept"))
    kept = common.small(common.table(kept, f"{work}/kept"))
    dropped = later.join(mixed, "component_id", "left_anti").select(F.col("_row").alias(row)).unionByName(members.join(kept, "component_id").where("_row <> kept").select(F.col("_row").alias(row)))
    rest = told.join(common.small(common.table(dropped, f"{work}/dropped")), row, "left_anti")
    alike = common.small(ids.where("n > 1").select(F.col("_row").alias(row)))
    one = rest.join(alike, row, "left_semi").groupBy(row).agg(F.min(F.struct(*docs.columns)).alias("s")).select("s.*")
    return rest.join(alike, row, "left_anti").select(*docs.columns).unionByName(one.select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows and null ids stay, and own columns, whatever their names."""
    leaks = common.free(docs, "_leaks")
    return decontamination.mark(docs, common.source(spark, sf_dir, "benchmark"), column=leaks).where(F.size(leaks) == 0).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked. A null text stays null; each row stays, its other columns as they are (n_chars follows a masked text)."""
    spans = common.free(docs, "_spans")
    return secret_scan.redact(secret_scan.scan(docs, secret_scan.train(docs), column=spans), column=spans).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document: a row for each row, repeated ones and those with null ids too."""
    return mixing.mix(docs, common.shared_dir(spark))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("mixture", mixture)]

#: Learned models and tilings are beyond SQL. Tests hold the pipeline against planted cases, and each stage's operator against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on its predecessor's written table; what a stage doesn't need any more is deleted."""
    work = common.shared_dir(spark)
    docs = common.source(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before = common.made()
        docs = common.table(stage(spark, docs, sf_dir), f"{work}/{k}_{name}")
        for path in common.made() - before:
            common.remove(spark, path)
        common.remove(spark, work, (f"{k}_{name}",))
    return docs
