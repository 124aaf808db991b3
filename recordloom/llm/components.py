"""Connected components of a table of links, by large and small stars; nothing but the number of changes reaches the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: Links (counted) up to which one task joins the forests; beyond, all tasks do in rounds.
ONE_TASK = 500_000


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the smallest node that it is connected to, itself left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        if (rx == ry).all():
            break
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while not (root[root] == root).all():
            root = root[root]
    on = root != np.arange(len(nodes))
    return nodes[on], nodes[root[on]]


def _local(batches):
    a, b, held = [], [], 0
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held > 2_000_000:
            u, v = _forest(np.concatenate(a), np.concatenate(b))
            if len(u) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                u, v = u[:0], v[:0]
            a, b, held = [u], [v], len(u)
    if a:
        u, v = _forest(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def components(links: DataFrame, work: str, rounds: int = 60) -> DataFrame:
    """links: (u, v), long. Returns (node, component) for each linked node; a component is named by its smallest node.

    Each task first replaces its links by a forest; then every node's neighbours are linked to the smallest of them, larger ones
    and smaller ones in turn, until nothing changes. A component's size shrinks by a constant factor a round, so that 60 rounds
    settle any number of nodes; if they don't, an error says so.
    """
    links = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    settled = links.limit(ONE_TASK + 1).count() <= ONE_TASK
    if settled:
        now = common.table(links.repartition(1).mapInArrow(_local, "u long, v long"), f"{work}/one")
    else:
        now = common.table(links.mapInArrow(_local, "u long, v long").distinct(), f"{work}/0")
        if now.limit(ONE_TASK + 1).count() <= ONE_TASK:
            now, settled = common.table(now.repartition(1).mapInArrow(_local, "u long, v long"), f"{work}/one"), True
    for k in range(0 if settled else rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = common.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{work}/{k}m")
        large = both.where("v > u").join(common.small(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = common.table(large, f"{work}/{k}l")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = common.table(down.groupBy("u").agg(F.min("v").alias("m")), f"{work}/{k}n")
        joined = down.join(common.small(least), "u")
        after = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = common.table(after, f"{work}/{k + 1}")
        settled = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = after
        if settled:
            break
    if not settled:
        raise RuntimeError(f"components aren't settled after {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
