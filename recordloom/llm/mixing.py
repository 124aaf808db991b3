"""Mixing sources to target weights by capped water-filling, then whole and fractional repetitions in a seeded order."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WEIGHTS, SHARE, MAX_EPOCHS, SEED = (3, 1, 2), 1.5, 2, "mix"
#: Rows of a bin, about: the order's key deals a source into bins by its first hexadecimal digits, as many as that needs. Only in one bin of
#: a source are rows put in order.
BIN_ROWS = 20_000


@F.arrow_udf(T.LongType())
def n_words(text: pa.Array) -> pa.Array:
    data, off = common.text_bytes(text)
    return pa.array(np.diff(common.word_bounds(data, off)[2]), pa.int64())


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: (source, source_size), a row for each source. Adds its target.

    All sources share `share` times all sizes by weight; no target passes max_epochs * source_size, and what is above goes to
    the others by weight until none is above. In order of cap / weight the capped sources come first, so that the first source
    that isn't capped settles all. Sums of whole numbers and one division: another engine gets the same bits.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights))).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    filled = ranked.select(
        "*",
        (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("w_left"),
        F.row_number().over(Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())).alias("at"),
    )
    settled = filled.withColumn("s", F.min(F.when(F.col("left") * F.col("w") <= F.col("cap") * F.col("w_left"), F.struct("at", "left", "w_left"))).over(every))
    return settled.select("source", "source_size", F.when(F.col("s").isNull() | (F.col("at") < F.col("s.at")), F.col("cap")).otherwise(F.col("w") * F.col("s.left") / F.col("s.w_left")).alias("target"))


def mix(docs: DataFrame, work: str, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """docs: (doc_id, text, source). Returns (doc_id, size, source_size, target, taken), a row for each row.

    A source of target t takes each of its documents t // source_size times, and the rest of t, in the order of
    md5(seed:doc_id), from whole documents and a part of the last one: what it takes is its target, rounded. A null source is a
    source of its own. A null or wordless text has size 0 and gives nothing. Repeated rows count each; null ids go as an empty id.
    Other columns are left out; an empty table gives none. What goes to one task is a row for each source.
    The order needs no sort of a source: bins by the key's first digits are summed, and only the bin where the rest ends is put in order.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = common.table(docs.select("doc_id", "source", F.coalesce(n_words("text"), F.lit(0)).alias("size"), key.alias("key")), f"{work}/sizes")
    digits = max(3, math.ceil(math.log(max(1, rows.count() / BIN_ROWS), 16)))
    rows = rows.withColumn("bin", F.substring("key", 1, digits))
    bins = common.table(rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), f"{work}/bins")
    plan = targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, share, max_epochs)
    total = F.floor(F.col("target") + 0.5)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(total / F.col("source_size"))).otherwise(F.lit(0))).withColumn("rest", total - F.col("whole") * F.col("source_size"))
    reach = bins.withColumn("bin_from", F.sum("bin_size").over(Window.partitionBy("source").orderBy("bin")) - F.col("bin_size"))
    plan, reach = common.table(plan, f"{work}/plan"), reach.withColumnsRenamed({"source": "_source", "bin": "_bin"})
    edge = plan.join(reach, plan["source"].eqNullSafe(reach["_source"]) & (F.col("bin_from") < F.col("rest")) & (F.col("rest") <= F.col("bin_from") + F.col("bin_size")), "left").drop("_source", "bin_size").withColumnRenamed("source", "_source")
    rows = rows.join(common.small(common.table(edge, f"{work}/edge")), rows["source"].eqNullSafe(F.col("_source"))).drop("_source")
    out = lambda df, extra: df.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"))
    whole = rows.where(F.col("_bin").isNull() | (F.col("bin") != F.col("_bin")))
    last = rows.where(F.col("bin") == F.col("_bin"))
    upto = F.sum("size").over(Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    room = F.col("rest") - F.col("bin_from") - (F.col("upto") - F.col("size"))
    return out(whole, F.when(F.col("bin") < F.col("_bin"), F.col("size")).otherwise(F.lit(0))).unionByName(out(last.withColumn("upto", upto), F.greatest(F.lit(0), F.least(F.col("size"), room))))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.source(spark, sf_dir, "documents"), common.shared_dir(spark))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, (2 * source_size)::DOUBLE AS cap FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS ord,
             (SELECT sum(source_size)::DOUBLE FROM s) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
             (SELECT sum(w) FROM r) - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left FROM r),
k AS (SELECT ord, left_, w_left FROM f WHERE left_ * w <= cap * w_left ORDER BY ord LIMIT 1),
t AS (SELECT f.source, f.source_size, CASE WHEN k.ord IS NULL OR f.ord < k.ord THEN f.cap ELSE f.w * k.left_ / k.w_left END AS target FROM f LEFT JOIN k ON true),
p AS (SELECT *, floor(target + 0.5)::BIGINT AS total FROM t),
q AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.total, CASE WHEN p.source_size > 0 THEN p.total // p.source_size ELSE 0 END AS whole,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before_
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, total - whole * source_size - before_)))::BIGINT AS taken FROM q
"""
