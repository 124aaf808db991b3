"""Evaluation: blocking recall, candidate statistics, F0.5 of each entity, and threshold searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import decide

LARGE = 100
PERCENTILES = (0.5, 0.9, 0.95, 0.99)


def fbeta(tp, predicted, truth, beta: float = 0.5):
    """1 if both sets are empty, 0 if one is or nothing is common."""
    p, r = tp / predicted, tp / truth
    return F.when((predicted == 0) & (truth == 0), 1.0).when((predicted == 0) | (truth == 0) | (tp == 0), 0.0).otherwise((1 + beta * beta) * p * r / (beta * beta * p + r))


def entity_scores(entities: DataFrame, truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """entities (s1), truth and predicted (s1, cand): per entity the counts and F-beta; what an entity lacks is an empty set."""
    t, p = truth.select("s1", "cand").distinct(), predicted.select("s1", "cand").distinct()
    both = t.withColumn("t", F.lit(1)).join(p.withColumn("p", F.lit(1)), ["s1", "cand"], "full")
    n = both.groupBy("s1").agg(F.count("t").alias("n_truth"), F.count("p").alias("n_predicted"), F.sum((F.col("t").isNotNull() & F.col("p").isNotNull()).cast("long")).alias("n_correct"))
    out = entities.select("s1").distinct().join(n, "s1", "left").fillna(0, ["n_truth", "n_predicted", "n_correct"])
    return out.withColumn("fbeta", fbeta(F.col("n_correct"), F.col("n_predicted"), F.col("n_truth"), beta))


def summary(scores: DataFrame) -> DataFrame:
    """One row: entities, macro F-beta, micro precision and recall, totals, and the part of entities with a prediction; zeros for none."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    x = scores.agg(F.count("*").alias("entities"), F.coalesce(F.avg("fbeta"), F.lit(0.0)).alias("macro_fbeta"), n("n_predicted"), n("n_truth"), n("n_correct"), F.coalesce(F.avg((F.col("n_predicted") > 0).cast("double")), F.lit(0.0)).alias("nonempty_rate"))
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return x.withColumns({"micro_precision": part("n_correct", "n_predicted"), "micro_recall": part("n_correct", "n_truth")})


def recall_metrics(records: DataFrame, truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per target source: how much of the truth the candidates retain, for pairs and for records, and how large they are."""
    pairs = candidates.select("src", "s1", "cand").distinct()
    hit = truth.join(pairs.withColumn("h", F.lit(1)), ["src", "s1", "cand"], "left")
    per = hit.groupBy("src", "s1").agg(F.count("*").alias("t"), F.count("h").alias("h"))
    a = per.groupBy("src").agg(F.sum("t").alias("true_ids"), F.sum("h").alias("retained_ids"), F.count("*").alias("truth_rows"), F.sum((F.col("h") > 0).cast("long")).alias("any_rows"), F.sum((F.col("h") == F.col("t")).cast("long")).alias("all_rows"))
    size = pairs.groupBy("src", "s1").agg(F.count("*").alias("n"))
    b = size.groupBy("src").agg(F.sum("n").alias("candidate_pairs"), F.count("*").alias("represented"), F.max("n").alias("largest"), F.sum((F.col("n") > LARGE).cast("long")).alias("large_rows"))
    own = records.where("src = 1").select("entity_id").distinct()
    out = a.join(b, "src", "full").crossJoin(F.broadcast(own.agg(F.count("*").alias("source1"))))
    out = out.fillna(0)
    return out.withColumn("zero_rows", F.col("source1") - F.col("represented")).withColumn("recall", F.when(F.col("true_ids") > 0, F.col("retained_ids") / F.col("true_ids")))


def recall_report(records: DataFrame, truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per target source, of candidates as they were written (pairs may repeat): rows, pairs and repeats; the truth's ids, rows, and rows of which any
    or all ids are retained, with their parts; and how many source 1 records have a candidate."""
    pairs = candidates.groupBy("src", "s1", "cand").agg(F.count("*").alias("n"))
    hit = truth.join(pairs.select("src", "s1", "cand", F.lit(1).alias("h")), ["src", "s1", "cand"], "left")
    per = hit.groupBy("src", "s1").agg(F.count("*").alias("t"), F.count("h").alias("h"))
    a = per.groupBy("src").agg(F.count("*").alias("truth_rows"), F.sum((F.col("h") > 0).cast("long")).alias("any_rows"), F.sum((F.col("h") == F.col("t")).cast("long")).alias("all_rows"), F.sum("t").alias("true_ids"), F.sum("h").alias("retained_ids"))
    of = pairs.groupBy("src", "s1").agg(F.sum("n").alias("rows"), F.count("*").alias("pairs"))
    b = of.groupBy("src").agg(F.sum("rows").alias("raw_rows"), F.sum("pairs").alias("pairs"), F.sum(F.col("rows") - F.col("pairs")).alias("duplicate_rows"), F.count("*").alias("represented"))
    one = records.where("src = 1").select("entity_id").distinct().agg(F.count("*").alias("source1"))
    out = a.join(b, "src", "full").crossJoin(F.broadcast(one)).fillna(0)
    part = lambda x, y: F.when(F.col(y) > 0, F.col(x) / F.col(y))
    return out.withColumns({"recall": part("retained_ids", "true_ids"), "row_recall": part("any_rows", "truth_rows"), "all_matches": part("all_rows", "truth_rows"), "represented_part": part("represented", "source1")})


def candidate_report(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per target source: source 1 records processed, those with and without a candidate, those with more than LARGE, all pairs, and the most of one."""
    n = lambda c: F.sum(c.cast("long"))
    return sizes(records, candidates).groupBy("src").agg(F.count("*").alias("processed"), n(F.col("n") > 0).alias("represented"), n(F.col("n") == 0).alias("zero_rows"), n(F.col("n") > LARGE).alias("large_rows"), F.sum("n").alias("pairs"), F.max("n").alias("largest"))


def validation_report(best: DataFrame) -> DataFrame:
    """The chosen thresholds' row of the grid with its micro precision and recall."""
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return best.withColumns({"micro_precision": part("n_correct", "n_predicted"), "micro_recall": part("n_correct", "n_truth")})


def missing_truth(truth: DataFrame, candidates: DataFrame, n: int | None = None) -> DataFrame:
    """Truth that no block retains, in order; the first n."""
    out = truth.join(candidates.select("src", "s1", "cand"), ["src", "s1", "cand"], "left_anti")
    return out if n is None else out.orderBy("src", "s1", "cand").limit(n)


def retained_by_method(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    return truth.join(candidates, ["src", "s1", "cand"]).groupBy("src", "blocking_method").agg(F.count("*").alias("pairs"))


def duplicate_pairs(pairs: DataFrame) -> DataFrame:
    """Per source: rows, distinct pairs and repeats."""
    n = pairs.groupBy("src").agg(F.count("*").alias("rows"), F.countDistinct("s1", "cand").alias("pairs"))
    return n.withColumn("repeats", F.col("rows") - F.col("pairs"))


def sizes(records: DataFrame, candidates: DataFrame, zero: bool = True) -> DataFrame:
    """Candidates of each source 1 record in each target source, with or without records that have none."""
    n = candidates.groupBy("src", "s1").agg(F.count("*").alias("n"))
    if not zero:
        return n
    every = records.where("src = 1").select(F.col("entity_id").alias("s1")).distinct().join(F.broadcast(records.sparkSession.createDataFrame([(2,), (3,)], "src int")))
    return every.join(n, ["src", "s1"], "left").fillna(0, ["n"]).select("src", "s1", "n")


def histogram(size: DataFrame) -> DataFrame:
    return size.groupBy("src", "n").agg(F.count("*").alias("records"))


def percentiles(size: DataFrame, points=PERCENTILES) -> DataFrame:
    """Per source the value at rank floor((rows - 1) * p) + 1, from the histogram: its size is that of the distinct counts, not of the records."""
    w = Window.partitionBy("src").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    h = histogram(size).withColumn("upto", F.sum("records").over(w)).withColumn("total", F.sum("records").over(Window.partitionBy("src")))
    at = lambda p: F.min(F.when(F.col("upto") >= F.floor((F.col("total") - 1) * p) + 1, F.col("n")))
    return h.groupBy("src").agg(F.min("n").alias("least"), F.max("n").alias("most"), *[at(p).alias(f"p{round(100 * p)}") for p in points])


def threshold_search(spark: SparkSession, entities: DataFrame, truth: DataFrame, scored: DataFrame, thresholds, strategies, n_truth: DataFrame | None = None) -> DataFrame:
    """A row for each threshold and (strategy, top_k, margin), the best macro F0.5 first, then fewer predictions, then in the order given.
    n_truth: (s1, n_truth), how many pairs of the truth each entity has, where truth holds only those that are among the scored pairs.

    Pairs are ranked once and meet the settings, a small table, in one pass: pairs above a threshold come first by rank, whichever it is.
    Entities without a prediction count 1 if they have no truth and else 0, and are only counted."""
    for strategy, _, _ in strategies:
        decide.known(strategy)
    settings = [(i * len(strategies) + j, float(t), s, k, float(m)) for i, t in enumerate(thresholds) for j, (s, k, m) in enumerate(strategies)]
    grid = F.broadcast(spark.createDataFrame(settings, "grid int, threshold double, strategy string, top_k int, margin double"))
    t = truth.select("s1", "cand").distinct()
    every = entities.select("s1").distinct().join(t.groupBy("s1").agg(F.count("*").alias("n_truth")) if n_truth is None else n_truth, "s1", "left").fillna(0, ["n_truth"])
    own = Window.partitionBy("s1")
    pairs = scored.select("s1", "cand", "score").distinct().withColumns({"rank": F.row_number().over(own.orderBy(F.desc("score"), "cand")), "best": F.max("score").over(own)})
    pairs = pairs.join(t.withColumn("h", F.lit(1)), ["s1", "cand"], "left").join(every, "s1")
    within = F.when((F.col("strategy") == "top_k") & F.col("top_k").isNotNull(), F.col("rank") <= F.col("top_k")).when(F.col("strategy") == "margin", F.col("best") - F.col("score") <= F.col("margin")).otherwise(F.lit(True))
    per = pairs.join(grid, (F.col("score") >= F.col("threshold")) & within).groupBy("grid", "s1").agg(F.count("*").alias("p"), F.count("h").alias("c"), F.first("n_truth").alias("t"))
    of = per.groupBy("grid").agg(F.sum(fbeta(F.col("c"), F.col("p"), F.col("t"))).alias("f"), F.sum("p").alias("n_predicted"), F.sum("c").alias("n_correct"), F.count("*").alias("some"), F.sum((F.col("t") == 0).cast("long")).alias("none"))
    totals = every.agg(F.count("*").alias("entities"), F.coalesce(F.sum("n_truth"), F.lit(0)).alias("n_truth"), F.coalesce(F.sum((F.col("n_truth") == 0).cast("long")), F.lit(0)).alias("bare"))
    x = grid.join(of, "grid", "left").fillna(0, ["f", "n_predicted", "n_correct", "some", "none"]).join(F.broadcast(totals))
    part = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    c = F.col
    x = x.select("grid", "threshold", "strategy", "top_k", "margin", "entities", part(c("f") + c("bare") - c("none"), c("entities")).alias("macro_fbeta"), "n_predicted", "n_truth", "n_correct", part(c("some"), c("entities")).alias("nonempty_rate"), part(c("n_correct"), c("n_predicted")).alias("micro_precision"), part(c("n_correct"), c("n_truth")).alias("micro_recall"))
    return x.orderBy(F.desc("macro_fbeta"), "n_predicted", "grid")


def threshold_grid(spark: SparkSession, entities: DataFrame, truth: DataFrame, scored: DataFrame, thresholds) -> DataFrame:
    """The macro F0.5 of each pair of thresholds (source 2, source 3), as a cube: counts of each entity, source and threshold first.

    Only entities with a pair above the least threshold meet the thresholds, which two small tables hold; all others count the same
    whatever the thresholds are (1 if they have no truth, else 0), and are only counted.
    """
    grid = F.broadcast(spark.createDataFrame([(i, float(t)) for i, t in enumerate(thresholds)], "i int, t double"))
    n_truth = truth.distinct().groupBy("s1").agg(F.count("*").alias("n_truth"))
    every = entities.select("s1").distinct().join(n_truth, "s1", "left").fillna(0, ["n_truth"])
    hit = scored.where(F.col("score") >= float(min(thresholds))).join(truth.distinct().withColumn("h", F.lit(1)), ["src", "s1", "cand"], "left").join(every, "s1")
    cube = hit.join(grid, F.col("score") >= F.col("t")).groupBy("s1", "src", "i").agg(F.count("*").alias("p"), F.count("h").alias("c"), F.first("n_truth").alias("n_truth"))
    # Per entity both sources' counts by threshold, as maps: a threshold that no pair passes is absent.
    side = lambda s: F.map_from_entries(F.collect_list(F.when(F.col("src") == s, F.struct("i", F.struct("p", "c"))))).alias(f"m{s}")
    some = cube.groupBy("s1").agg(F.first("n_truth").alias("n_truth"), side(2), side(3))
    x = some.join(grid.select(F.col("i").alias("i2"), F.col("t").alias("t2"))).join(grid.select(F.col("i").alias("i3"), F.col("t").alias("t3")))
    n = lambda s, k: F.coalesce(F.try_element_at(f"m{s}", F.col(f"i{s}"))[k], F.lit(0))
    x = x.withColumns({"n_predicted": n(2, "p") + n(3, "p"), "n_correct": n(2, "c") + n(3, "c")})
    of = x.groupBy("t2", "t3").agg(F.sum(fbeta(F.col("n_correct"), F.col("n_predicted"), F.col("n_truth"))).alias("f"), F.sum("n_predicted").alias("n_predicted"), F.sum("n_correct").alias("n_correct"), F.count("*").alias("some"), F.sum((F.col("n_truth") == 0).cast("long")).alias("none"))
    totals = every.agg(F.count("*").alias("entities"), F.coalesce(F.sum("n_truth"), F.lit(0)).alias("n_truth"), F.coalesce(F.sum((F.col("n_truth") == 0).cast("long")), F.lit(0)).alias("bare"))
    cells = grid.select(F.col("t").alias("t2")).join(grid.select(F.col("t").alias("t3"))).join(of, ["t2", "t3"], "left").fillna(0, ["f", "n_predicted", "n_correct", "some", "none"]).join(F.broadcast(totals)).where("entities > 0")
    return cells.select("t2", "t3", ((F.col("f") + F.col("bare") - F.col("none")) / F.col("entities")).alias("macro_fbeta"), "n_predicted", "n_correct", "n_truth")


def best_thresholds(grid: DataFrame) -> DataFrame:
    """The first best pair: of equals the lowest threshold of source 2, then of source 3."""
    return grid.orderBy(F.desc("macro_fbeta"), "t2", "t3").limit(1)
