"""Benchmark decontamination: shared-token seeds name pairs of document and item, greedy string tiling measures how much of the item is there."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Tokens of a seed, at most those of a tile; tokens of the shortest tile; part of an item's tokens that its tiles must cover.
SEED, TILE, COVERAGE = 3, 3, 0.6
#: Characters of benchmark text that are broadcast at once; a larger benchmark goes in blocks of about that size.
BLOCK_CHARS = 8_000_000
_MOD = (1 << 61) - 1
_BASE = 1_000_003_979
_BITS = 22
#: Places in items that are looked at at once, about: they bound a worker's memory.
_PLACES = 500_000


def _prefix(tokens) -> list[int]:
    out = [0]
    for t in tokens:
        out.append((out[-1] * _BASE + int(t) % _MOD) % _MOD)
    return out


def _grams(sums: list[int], free: list[tuple[int, int]], n: int) -> dict[int, list[int]]:
    """Karp-Rabin: where each hash of n tokens stands within the free stretches."""
    power, out = pow(_BASE, n, _MOD), {}
    for a, b in free:
        for i in range(a, b - n + 1):
            out.setdefault((sums[i + n] - sums[i] * power) % _MOD, []).append(i)
    return out


def _less(free: list[tuple[int, int]], a: int, b: int, least: int) -> list[tuple[int, int]]:
    return [s for x, y in free for s in ([(x, y)] if b <= x or y <= a else [(x, a), (b, y)]) if s[1] - s[0] >= least]


def tile(item: list[int], doc: list[int], least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, length) of the longest common matches that don't overlap, again and again.

    Whether a common match of n free tokens exists falls with n, so a binary search over Karp-Rabin hashes finds the longest.
    Matches are verified; equals go by place in the item, then in the document.
    """
    known = set(item)
    runs, begin = [], None
    for i, t in enumerate([*doc, None]):
        if t in known:
            begin = i if begin is None else begin
        elif begin is not None:
            runs += [(begin, i)] if i - begin >= least else []
            begin = None
    free_i, free_d, out = [(0, len(item))] if len(item) >= least else [], runs, []
    sums_i, sums_d = _prefix(item), _prefix(doc)
    bound = min(len(item), max((b - a for a, b in runs), default=0))
    while free_i and free_d and bound >= least:
        lo, hi = least - 1, bound
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if _grams(sums_i, free_i, mid).keys() & _grams(sums_d, free_d, mid).keys():
                lo = mid
            else:
                hi = mid - 1
        if lo < least:
            break
        places = _grams(sums_d, free_d, lo)
        mine = sorted((i, h) for h, at in _grams(sums_i, free_i, lo).items() if h in places for i in at)
        marked = 0
        for i, h in mine:
            if not any(a <= i and i + lo <= b for a, b in free_i):
                continue
            for j in places[h]:
                if any(a <= j and j + lo <= b for a, b in free_d) and item[i : i + lo] == doc[j : j + lo]:
                    out.append((i, j, lo))
                    free_i, free_d = _less(free_i, i, i + lo, least), _less(free_d, j, j + lo, least)
                    marked += 1
                    break
        bound = lo if marked else lo - 1
    return out


def _index(rows: list[tuple[int, str]], seed: int):
    """Token lists of the items, each token's item, and by length the seeds: an item's runs of `seed` tokens, or all of a shorter one.

    Of seeds of a length: the different ones, sorted, where each one's places begin, the places (tokens counted over all items), and a
    bit table that most other n-grams miss.
    """
    hashes, first = common.words(pa.array([t for _, t in rows], pa.large_string()), common.PUNCT)
    items = [(rows[k][0], hashes[first[k] : first[k + 1]]) for k in range(len(rows))]
    size = np.diff(first)
    parts = {}
    for n in np.unique(np.minimum(size[size > 0], seed)).tolist():
        grams, begin = common.shingles(hashes, first, n)
        owner = np.repeat(np.arange(len(rows)), np.diff(begin))
        place = first[owner] + np.arange(len(grams)) - begin[owner]
        fit = np.minimum(size, seed)[owner] == n
        grams, place = grams[fit], place[fit]
        order = np.lexsort((place, grams))
        keys, start = np.unique(grams[order], return_index=True)
        table = np.zeros(1 << _BITS, bool)
        table[keys >> np.uint64(64 - _BITS)] = True
        parts[n] = (keys, np.append(start, len(grams)), place[order], table)
    return items, np.repeat(np.arange(len(rows)), size), parts


def _candidates(hashes: np.ndarray, first: np.ndarray, items: list, owner: np.ndarray, parts: dict, coverage: float):
    """(row, item): the pairs whose shared seeds cover the given part of the item. Tiles consist of shared seeds, so no other pair's tiles can."""
    size = np.array([len(x) for _, x in items])
    for n, (keys, start, place, table) in parts.items():
        grams, begin = common.shingles(hashes, first, n)
        hits = np.flatnonzero(table[grams >> np.uint64(64 - _BITS)])
        at = np.minimum(np.searchsorted(keys, grams[hits]), len(keys) - 1)
        on = keys[at] == grams[hits]
        row = np.searchsorted(begin, hits[on], "right") - 1
        row, at = np.divmod(np.unique(row * len(keys) + at[on]), len(keys))
        count = start[at + 1] - start[at]
        ends = np.append(0, np.cumsum(count))
        a = 0
        while a < len(row):
            b = int(np.searchsorted(ends, ends[a] + _PLACES, "right")) - 1
            b = max(int(np.searchsorted(row, row[b])), int(np.searchsorted(row, row[a], "right"))) if b < len(row) else len(row)
            k = np.repeat(start[at[a:b]] - ends[a:b], count[a:b]) + np.arange(ends[a], ends[b])
            covered = np.unique(np.repeat(row[a:b], count[a:b])[:, None] * len(owner) + place[k][:, None] + np.arange(n))
            pair, tokens = np.unique(covered // len(owner) * len(items) + owner[covered % len(owner)], return_counts=True)
            pair = pair[tokens >= coverage * size[pair % len(items)]]
            yield from ((int(r), int(i)) for r, i in zip(*np.divmod(pair, len(items))))
            a = b


def _matcher(spark: SparkSession, rows: list[tuple[int, str]], seed: int, least: int, coverage: float):
    shared = spark.sparkContext.broadcast(_index(rows, min(seed, least)))
    kind = "array<struct<item_id: bigint, n_tiles: int, covered: int, item_tokens: int, coverage: double>>"
    fields = [("item_id", pa.int64()), ("n_tiles", pa.int32()), ("covered", pa.int32()), ("item_tokens", pa.int32()), ("coverage", pa.float64())]

    @F.arrow_udf(kind)
    def match(text: pa.Array) -> pa.Array:
        items, owner, parts = shared.value
        hashes, first = common.words(text, common.PUNCT)
        out: list[list] = [[] for _ in range(len(text))]
        pairs = _candidates(hashes, first, items, owner, parts, coverage)
        doc, at = [], -1
        for r, k in sorted(pairs):
            if r != at:
                doc, at = hashes[first[r] : first[r + 1]].tolist(), r
            item_id, item = items[k]
            tiles = tile(item.tolist(), doc, min(least, len(item)))
            covered = sum(n for *_, n in tiles)
            if covered >= coverage * len(item):
                out[r].append({"item_id": item_id, "n_tiles": len(tiles), "covered": covered, "item_tokens": len(item), "coverage": covered / len(item)})
        return pa.array(out, pa.list_(pa.struct(fields)))

    return match, shared


def mark(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, least: int = TILE, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS, column: str = "leaks", without: tuple[str, ...] = ()) -> DataFrame:
    """docs with `column`: the benchmark items of whose tokens the text's tiles cover the given part or more. It is written to the shared folder,
    without the columns named so. Each row gives one row; docs' own column of that name becomes <name>_input.

    Tokens: words without ASCII punctuation, A-Z lower-cased. Null text counts as empty and leaks nothing; an item of fewer tokens
    than a tile is found where it stands whole, one without tokens never; null ids stay null. Repeated items are each reported. A benchmark
    beyond block_chars goes in blocks of about that size, one after another: only one is on the driver and broadcast at a time.
    """
    spark, work = docs.sparkSession, common.shared_dir(docs.sparkSession)
    docs = common.make_room(docs, column.lower())
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    for b in range(blocks):
        rows = sorted((tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()), key=str)
        match, shared = _matcher(spark, rows, seed, least, coverage)
        found = match(F.coalesce(F.col("text"), F.lit("")))
        out = docs.withColumn(column, F.array_sort(F.concat(column, found)) if b else found)
        docs = common.table(out if b < blocks - 1 else out.drop(*without), f"{work}/{b}")
        shared.destroy()
        common.remove(spark, work, (f"{b}",))
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each leak: doc_id, item_id, tiles, covered tokens, the item's tokens and the part covered."""
    docs = common.source(spark, sf_dir, "documents").select("doc_id", "text")
    return mark(docs, common.source(spark, sf_dir, "benchmark"), without=("text",)).select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")
