"""Jaccard join of word shingles by partitioning the universe: pigeonhole over hashed segments in size bands, exact verification.

Two sets of sizes a, b with a Jaccard similarity of 3/4 or more differ in at most (a + b) / 7 elements. The smaller one's size band
sets a number m of segments, and a hash deals every shingle to one of them. Sets that differ in at most H elements agree in m - H
segments or more. So each set indexes only H + 1 of its segments: those that come first in one order of all segment subsets, the
cheapest ones (most rare elements, most elements). In that order what both sets leave out of their common subsets is a beginning of
at most m - H - 1 of them, so that one at least is indexed by both. Where H is at most 1 one segment and its one-deletion
neighbourhood are cheaper, and are indexed instead.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

WORDS = 5
#: Documents, about, of the sample that names frequent shingles; they only set the order above, never what is found.
SAMPLE_DOCS, FREQUENT, FREQUENT_MOST = 8000, 0.0005, 400_000
#: Signatures, about, that one bucket takes; that a task holds back before it sends them.
BUCKET, FLUSH = 750_000, 500_000
#: So many documents of one flush that share a signature become a list, of which only the first goes on to the signature's bucket.
#: Members of a list at most.
LOCAL, CUT = 8, 5_000
#: Rounds that compare a group's members with one of them, before all that are still apart are compared; that comes at once
#: where it means no more pairs than this.
STARS, PAIRS = 6, 200_000
#: Bits of a parity sketch. Members of a group, about, that meet as many others in one task; a larger group is cut into such blocks.
BITS, MEET = 1024, 1000


def _bands() -> list[int]:
    lo, out = 1, []
    while lo < 1 << 40:
        out.append(lo)
        lo = max(lo + 1, lo * 4 // 3 + 1)
    return out


BANDS = _bands()


def _most(band: int) -> int:
    """The most elements that a set of the band, as the smaller one, and its partner can differ in."""
    n = BANDS[band + 1] - 1
    return (n + 4 * n // 3) // 7


def n_segments(band: int) -> int:
    h = _most(band)
    return 1 if h <= 1 else h + 1 + max(5, 2 * h // 5)


def signatures(x: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """x: a set's distinct shingle hashes. The signatures that it indexes, for its own band and, as a larger partner, for the one below."""
    n = len(x)
    if not n:
        return np.zeros(0, np.uint64)
    rare = np.ones(n, bool)
    if len(frequent):
        at = np.searchsorted(frequent, x)
        rare = frequent[np.minimum(at, len(frequent) - 1)] != x
    own = bisect_right(BANDS, n) - 1
    out = []
    for band in (own, own - 1):
        if band < 0 or band < own and BANDS[own] - 1 < (3 * n + 3) // 4:
            continue
        most = (n + 4 * n // 3) // 7 if band == own else (n + BANDS[own] - 1) // 7
        m = n_segments(band)
        salt = common.mix(np.array([7919 * band + 1, 7919 * band + 2], np.uint64))
        code = common.mix(x ^ salt[0])
        if m == 1:
            whole = code.sum(dtype=np.uint64)
            subsets = np.append(whole - code, whole) if _most(band) else np.array([whole])
            out.append(common.mix(subsets + salt[1]))
            continue
        seg = ((code >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
        size = np.bincount(seg, minlength=m)
        light = np.bincount(seg[rare], minlength=m)
        order = np.argsort(seg, kind="stable")
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(common.mix(code[order]), out=sums[1:])
        ends = np.cumsum(size)
        sig = common.mix(sums[ends] - sums[ends - size] + common.mix(np.arange(m, dtype=np.uint64) + salt[1]))
        out.append(sig[np.lexsort((sig, -size, -light))[: most + 1]])
    return np.concatenate(out)


def _sets(column):
    """Each row's distinct shingle hashes, in order."""
    hashes, first = common.words(column)
    grams, begin = common.shingles(hashes, first, WORDS)
    for k in range(len(begin) - 1):
        yield np.unique(grams[begin[k] : begin[k + 1]])


def sketch(x: np.ndarray) -> bytes:
    """For each of BITS places whether an odd number of the set's elements hash to it. An element that only one of two sets has changes
    one bit, so that sketches differ in no more bits than the sets in elements: similar sets in at most (a + b) / 7."""
    return np.packbits(np.bincount((x % np.uint64(BITS)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()


def _may_link(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sets of n and m elements with these sketches (rows of 64-bit words) can be similar."""
    return (np.minimum(n, m) * 4 >= np.maximum(n, m) * 3) & (np.bitwise_count(x ^ y).sum(axis=-1) <= (n + m) // 7)


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), BITS // 64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) * 4 < max(len(a), len(b)) * 3:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both) > 0


def _digests(batches):
    import hashlib

    for batch in batches:
        hashes, first = common.words(batch.column("text"))
        grams, begin = common.shingles(hashes, first, WORDS)
        n, key, bits = [], [], []
        for k in range(len(begin) - 1):
            g = np.unique(grams[begin[k] : begin[k + 1]])
            n.append(len(g))
            key.append(hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None)
            bits.append(sketch(g) if len(g) else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bits, pa.binary())], ["doc_id", "n_shingles", "key", "sketch"])


_PLAIN, _FIRSTS, _LISTS = 0, 1, 2


def _postings(frequent, buckets: int):
    """Rows (bucket, kind, ids, sigs). A signature that many documents of a flush share is aggregated before the shuffle: they become a
    list, which goes to a bucket by its content (kind 2: ids the members, sigs what they share), and its first member stands for them in
    the signature's bucket (kind 1), so that what one signature brings there grows with the flushes and not with its documents."""

    def packed(kind, d, s):
        order = np.argsort(s % np.uint64(buckets), kind="stable")
        d, s = d[order], s[order]
        bucket = (s % np.uint64(buckets)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(cuts[1:], len(bucket))
        # Differences of the ids are mostly 0, which shuffle files compress well.
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts], pa.int64()), pa.array(np.full(len(cuts), kind), pa.int32()), pa.array([np.diff(d[a:b], prepend=0).tobytes() for a, b in zip(cuts, ends)], pa.binary()), pa.array([s[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())], ["bucket", "kind", "ids", "sigs"])

    def task(batches):
        ids, sigs, held = [], [], 0

        def flush():
            d, s = np.concatenate(ids), np.concatenate(sigs)
            order = np.lexsort((d, s))
            ds, ss = d[order], s[order]
            cuts = np.flatnonzero(np.append(True, ss[1:] != ss[:-1]))
            size = np.diff(np.append(cuts, len(ss)))
            hot = size >= LOCAL
            lists: dict[bytes, list] = {}
            for a, n in zip(cuts[hot], size[hot]):
                lists.setdefault(ds[a : a + n].tobytes(), []).append(ss[a])
            plain = ~np.isin(s, ss[cuts[hot]])
            yield packed(_PLAIN, d[plain], s[plain])
            if lists:
                yield packed(_FIRSTS, ds[cuts[hot]], ss[cuts[hot]])
                members = [np.frombuffer(m, np.int64) for m in lists]
                where = [buckets + int(common.mix(m.view(np.uint64)).sum(dtype=np.uint64) % np.uint64(buckets)) for m in members]
                yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array([_LISTS] * len(members), pa.int32()), pa.array([np.diff(m, prepend=0).tobytes() for m in members], pa.binary()), pa.array([np.array(x, np.uint64).tobytes() for x in lists.values()], pa.binary())], ["bucket", "kind", "ids", "sigs"])

        for batch in batches:
            for doc, x in zip(batch.column("doc_id").to_pylist(), _sets(batch.column("text"))):
                s = signatures(x, frequent.value)
                ids.append(np.full(len(s), doc, np.int64))
                sigs.append(s)
                held += len(s)
                if held >= FLUSH:
                    yield from flush()
                    ids, sigs, held = [], [], 0
        if held:
            yield from flush()

    return task


def _groups(df: pd.DataFrame) -> pd.DataFrame:
    """A bucket's postings: the distinct pairs and lists of documents that share a signature, none longer than CUT (parts of a cut list share
    their first member). sigs: the signatures whose documents stand in more than one list; other lists are a signature's documents, all."""
    ids = [np.cumsum(np.frombuffer(x, np.int64)) for x in df["ids"]]
    sigs = [np.frombuffer(x, np.uint64) for x in df["sigs"]]
    more: dict[bytes, list] = {}
    pairs = np.zeros((0, 2), np.int64)
    if df["kind"].iat[0] == _LISTS:
        for m, s in zip(ids, sigs):
            more.setdefault(m.tobytes(), []).extend(s)
    else:
        many = np.repeat(df["kind"].to_numpy() == _FIRSTS, [len(x) for x in ids])
        ids, sigs = np.concatenate(ids), np.concatenate(sigs)
        order = np.lexsort((ids, sigs))
        ids, sigs, many = ids[order], sigs[order], many[order]
        cuts = np.flatnonzero(np.append(True, sigs[1:] != sigs[:-1]))
        size = np.diff(np.append(cuts, len(sigs)))
        many = np.add.reduceat(many.astype(np.int64), cuts) > 0
        two = cuts[(size == 2) & ~many]
        if len(two):
            pairs = np.unique(np.stack([ids[two], ids[two + 1]], 1), axis=0)
        on = (size > 2) | (size > 1) & many
        for a, n, hot in zip(cuts[on], size[on], many[on]):
            own = more.setdefault(ids[a : a + n].tobytes(), [])
            if hot or n > CUT:
                own.append(sigs[a])
    members, shared = [*pairs], [[]] * len(pairs)
    for m, s in more.items():
        m = np.unique(np.frombuffer(m, np.int64))
        if len(m) > 1:
            parts = [m] if len(m) <= CUT else [np.append(m[:1], m[a : a + CUT - 1]) for a in range(1, len(m), CUT - 1)]
            members += parts
            shared += [np.array(s, np.uint64).view(np.int64) if len(s) else []] * len(parts)
    return pd.DataFrame({"members": pd.Series(members, dtype=object), "sigs": pd.Series(shared, dtype=object)})


def _check(batches):
    for batch in batches:
        a, b = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        ok = [similar(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)) for p, q in zip(a, b)]
        yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))


def _may(batches):
    for batch in batches:
        on = _may_link(batch.column("n").to_numpy(), batch.column("m").to_numpy(), _words(batch.column("x")), _words(batch.column("y")))
        yield batch.select(["u", "v"]).filter(pa.array(on, pa.bool_()))


def _across(batches):
    """Two blocks of a group, or one block with itself, a row: the pairs across components that can be similar."""
    for batch in batches:
        flat, size = batch.column("g").flatten(), batch.column("g").value_lengths().to_numpy()
        ids, comp, n, block, ends = *(flat.field(c).to_numpy() for c in ("doc", "component", "n", "block")), np.cumsum(size)
        bits, low, high = _words(flat.field("sketch")), batch.column("low").to_numpy(), batch.column("high").to_numpy()
        for a, b, lo, hi in zip(ends - size, ends, low, high):
            at = np.arange(a, b)
            left = at[block[at] == lo]
            right = at[block[at] == hi]
            for i in range(0, len(left), step := max(1, 50_000 // max(1, len(right)))):
                j, k = np.meshgrid(left[i : i + step], right, indexing="ij")
                on = (comp[j] != comp[k]) if lo != hi else (comp[j] != comp[k]) & (ids[j] < ids[k])
                j, k = j[on], k[on]
                on = _may_link(n[j], n[k], bits[j], bits[k])
                u, v = ids[j[on]], ids[k[on]]
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])


def join(docs: DataFrame, work: str, count_links: bool = False) -> DataFrame:
    """docs: (doc_id, text). Returns (doc_id, n_shingles, component_id) for each row, and n_links where links are to be counted.

    A set: the distinct hashes of runs of five words (all words as one run if fewer); empty for null, empty and wordless texts,
    which link with nothing. Equal sets are one class, represented by its smallest doc_id. n_links counts all other documents whose
    sets are similar to the row's, equal ones included: for it all members of a group are compared, while components need only those that
    are still apart. Rows that share a doc_id count as one document where they link, and each is returned. A null doc_id takes no part:
    its component_id is null. Other columns are left out.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = common.table(docs.mapInArrow(_digests, "doc_id long, n_shingles long, key binary, sketch binary"), f"{work}/digests")
    known = every.where("key is not null and doc_id is not null")
    firsts = known.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    firsts = common.small(common.table(firsts, f"{work}/firsts"))
    later = known.select("key", "doc_id").join(firsts, "key").where("doc_id <> first").select(F.col("first").alias("u"), F.col("doc_id").alias("v"))
    later = common.table(later, f"{work}/copies")
    # Documents whose rows differ belong to several classes, which so become one component.
    several = known.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select(F.col("doc_id").alias("v"))
    texts = docs.where("doc_id is not null")
    alone = texts.join(common.small(later.select(F.col("v").alias("doc_id")).distinct()), "doc_id", "left_anti")

    stats = known.agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("size")).first()
    n_sets = stats["rows"] - later.count()
    n_elements = (stats["size"] or 0) * n_sets / max(1, stats["rows"])
    rate = int(min(1.0, SAMPLE_DOCS / max(n_sets, 1)) * (1 << 20))
    sample = alone.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate)

    def elements(batches):
        for batch in batches:
            x = [s.view(np.int64) for s in _sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))], ["x"])

    often = max(4, int(FREQUENT * min(SAMPLE_DOCS, n_sets)))
    with common.batch_rows(spark, common.BATCH_ROWS):
        frequent = sample.mapInArrow(elements, "x long").groupBy("x").count().where(F.col("count") >= often).orderBy(F.desc("count"), "x").limit(FREQUENT_MOST).select("x").toPandas()["x"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(np.sort(frequent.view(np.uint64)))

    buckets = max(12, int(0.62 * n_elements / BUCKET) + 1)
    postings = alone.mapInArrow(_postings(shared, buckets), "bucket long, kind int, ids binary, sigs binary")
    groups = postings.groupBy("bucket").applyInPandas(_groups, "members array<long>, sigs array<long>")
    groups = common.table(groups.withColumn("list", F.xxhash64("members")), f"{work}/groups")
    shared.unpersist()
    pairs = groups.select(F.col("members")[0].alias("u"), F.explode(F.slice("members", F.lit(2), F.size("members"))).alias("v"))
    lists = groups.where((F.size("members") > 2) | (F.size("sigs") > 0))

    sketches = known.select("doc_id", F.col("n_shingles").alias("n"), "sketch")
    tried = pairs.distinct()
    links = _verify(texts, sketches, tried, f"{work}/verify0")
    linked = later.join(several, "v", "left_semi").select("u", "v").unionByName(links)
    if count_links:
        rows = common.table(_of_groups(lists).join(lists.select("list", F.explode("members").alias("doc")), "list").select("group", "doc", F.col("doc").alias("component")).distinct(), f"{work}/rows0")
        more = _verify(texts, sketches, _exhaustive(rows, sketches, f"{work}/blocks0").distinct().join(tried, ["u", "v"], "left_anti"), f"{work}/verify_rest")
        links, linked = links.unionByName(more), linked.unionByName(more)
    comp = common.table(components(linked, f"{work}/components0"), f"{work}/comp0")
    last = False
    for k in () if count_links else range(1, STARS + 2):
        rows = common.table(_apart(lists, comp), f"{work}/rows{k}")
        apart = (rows.groupBy("group", "component").agg(F.count("*").alias("n")).groupBy("group").agg((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("n")).agg(F.sum("n")).first()[0] or 0) / 2
        if not apart:
            break
        last = last or apart <= PAIRS or k > STARS
        if not last:
            centre = rows.groupBy("group").agg(F.min(F.struct(F.xxhash64("doc", F.lit(k)).alias("h"), F.col("doc").alias("c"), F.col("component").alias("cc"))).alias("s")).select("group", "s.c", "s.cc")
            new = rows.join(centre, "group").where("component <> cc").select(F.least("doc", "c").alias("u"), F.greatest("doc", "c").alias("v"))
        else:
            new = _exhaustive(rows, sketches, f"{work}/blocks{k}")
        new = common.table(new.distinct().join(tried, ["u", "v"], "left_anti"), f"{work}/tried{k}")
        tried = tried.unionByName(new)
        more = _verify(texts, sketches, new, f"{work}/verify{k}")
        n_more = more.count()
        if n_more:
            comp = common.table(components(comp.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), f"{work}/components{k}"), f"{work}/comp{k}")
        if last:
            break
        last = n_more * 50 < new.count()  # few links are left to find
    return common.result(_named(every, later, several, comp, links if count_links else None, known, work), work)


def _of_groups(lists: DataFrame) -> DataFrame:
    """(list, group): the signatures whose documents the list holds a part of, or the list itself."""
    group = F.explode(F.when(F.size("sigs") > 0, F.col("sigs")).otherwise(F.array("list")))
    return lists.select("list", group.alias("group")).distinct()


def _apart(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """(group, doc, component) of the groups of three or more whose members aren't all in one component; of groups of the same members one.

    A group's lists share members, so that it is in one component if each of its lists is."""
    placed = lists.select("list", F.explode("members").alias("doc")).distinct().join(common.small(comp.withColumnRenamed("node", "doc")), "doc", "left").select("list", "doc", F.coalesce("component", "doc").alias("component"))
    open_ = placed.groupBy("list").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("list")
    group = _of_groups(lists)
    some = group.join(open_, "list").select("group").distinct()
    rows = group.join(some, "group", "left_semi").join(placed, "list").select("group", "doc", "component").distinct()
    mark = rows.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("h")).where("n > 2")
    return rows.join(mark.groupBy("n", "h").agg(F.min("group").alias("group")).select("group"), "group", "left_semi")


def _named(every: DataFrame, later: DataFrame, several: DataFrame, comp: DataFrame, links: DataFrame | None, known: DataFrame, work: str) -> DataFrame:
    """every with its component: a copy's is its class's, and that of a document of several classes its own, which holds them."""
    copies = later.join(several, "v", "left_anti").groupBy("v").agg(F.min("u").alias("node"))
    copies = copies.join(comp, "node", "left").select(F.col("v").alias("doc_id"), F.coalesce("component", "node").alias("component"))
    named = comp.withColumnRenamed("node", "doc_id").join(copies.select("doc_id"), "doc_id", "left_anti").unionByName(copies)
    out = every.join(common.small(common.table(named, f"{work}/named")), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), "key")
    if links is None:
        return out.drop("key")
    return out.join(common.small(_n_links(known, links, work)), "key", "left").select("doc_id", "n_shingles", "component_id", F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"))


def _n_links(known: DataFrame, links: DataFrame, work: str) -> DataFrame:
    """(key, n_links): of each class the documents linked with one of its documents. links: all those between classes' smallest doc_ids."""
    sizes = known.select("key", "doc_id").distinct().groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"))
    sizes = common.table(sizes, f"{work}/sizes")
    sides = links.distinct().select(F.explode(F.array(F.struct(F.col("u").alias("rep"), F.col("v").alias("other")), F.struct(F.col("v").alias("rep"), F.col("u").alias("other")))).alias("s")).select("s.*")
    other = sizes.select(F.col("rep").alias("other"), "size")
    linked = sides.join(common.small(other), "other").groupBy("rep").agg(F.sum("size").alias("linked"))
    return common.table(sizes.join(linked, "rep", "left").select("key", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), f"{work}/n_links")


def _exhaustive(rows: DataFrame, sketches: DataFrame, path: str) -> DataFrame:
    """rows: (group, doc, component). Pairs of a group's members in different components that can be similar. Blocks of a group meet two by two."""
    own = sketches.join(rows.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    cuts = rows.groupBy("group").agg(F.ceil(F.count("*") / MEET).alias("cuts"))
    placed = rows.join(cuts, "group").join(own.withColumnRenamed("doc_id", "doc"), "doc").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("cuts")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    cells = placed.groupBy("group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    held = cells.agg(F.collect_list(F.struct("doc", "component", "n", "block", "sketch")).alias("g"))
    return common.table(held.select("low", "high", "g").mapInArrow(_across, "u long, v long"), f"{path}_pairs", 10)


def _verify(texts: DataFrame, sketches: DataFrame, pairs: DataFrame, work: str) -> DataFrame:
    """Of the pairs (distinct) those whose sets are similar. Pairs whose sketches differ too much go first; only sets of documents in the
    others are made, once."""

    def two(pairs, sides, c):
        left, right = (sides.select(F.col("doc_id").alias(k), *[F.col(a).alias(b) for a, b in zip(c, n)]) for k, n in (("u", ("x", "n")), ("v", ("y", "m"))))
        return pairs.join(right, "v").join(left, "u")

    # Rows that share a doc_id may say a pair more than once.
    may = common.table(two(pairs, sketches, ("sketch", "n")).select("u", "v", "x", "y", "n", "m").mapInArrow(_may, "u long, v long"), f"{work}/may")
    need = may.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()

    def sets(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in _sets(batch.column("text"))], pa.binary())], ["doc_id", "x"])

    made = common.table(texts.join(common.small(need), "doc_id", "left_semi").mapInArrow(sets, "doc_id long, x binary").where("octet_length(x) > 0"), f"{work}/sets")
    return common.table(two(may.distinct(), made, ("x",)).select("u", "v", "x", "y").mapInArrow(_check, "u long, v long"), f"{work}/links", 25)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.source(spark, sf_dir, "documents"), common.shared_dir(spark))


OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 5 THEN [array_to_string(l, ' ')]
             ELSE list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.reached),
m AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
