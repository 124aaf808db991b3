import random

import pyarrow as pa
from pyspark.sql import functions as F

from recordloom.llm import common
from recordloom.llm import decontamination as dc


def _naive(item, doc, least):
    mi, md, out = set(), set(), 0
    while True:
        best, found = least, []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and i + n not in mi and j + n not in md:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best:
                    found.append((i, j))
        done = False
        for i, j in found:
            if all(i + k not in mi and j + k not in md for k in range(best)):
                mi |= {i + k for k in range(best)}
                md |= {j + k for k in range(best)}
                done = True
        if not done:
            return len(mi)


def test_tiling_against_naive():
    rng = random.Random(0)
    for _ in range(150):
        item, doc = [rng.randrange(4) for _ in range(rng.randrange(0, 14))], [rng.randrange(5) for _ in range(rng.randrange(0, 25))]
        tiles = dc.tile(item, doc, 2)
        assert all(item[i : i + n] == doc[j : j + n] for i, j, n in tiles)
        assert len({i + k for i, _, n in tiles for k in range(n)}) == sum(n for *_, n in tiles) == len({j + k for _, j, n in tiles for k in range(n)})
        assert sum(n for *_, n in tiles) == _naive(item, doc, 2)


def test_reordered_edited_and_clean(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = item.split()
    docs = [(1, f"start {item.upper()}, end"), (2, "x " + " ".join(w[6:]) + " y y " + " ".join(w[:6])), (3, " ".join(w[:5])), (4, None), (5, ""), (6, "nothing here " * 5000), (7, item), (7, item)]
    df = spark.createDataFrame([(a, b, 0) for a, b in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "two words")], "item_id long, text string")
    for block in (1 << 20, 10):
        got = {(r["doc_id"], x["item_id"], x["coverage"]) for r in dc.mark(df, bench, block_chars=block).collect() for x in r["leaks"]}
        assert got == {(1, 1, 1.0), (2, 1, 1.0), (7, 1, 1.0)}
    assert dc.mark(df.limit(0), bench.limit(0)).collect() == []
    own = dc.mark(df.withColumn("Leaks", F.lit("mine")), bench).collect()
    assert len(own) == len(docs) and {r["Leaks_input"] for r in own} == {"mine"}


def test_no_item_is_lost_to_seeds(spark, monkeypatch):
    rng = random.Random(3)
    w = [f"t{k}" for k in range(40)]
    changed = " ".join("other" if k % 4 == 3 else t for k, t in enumerate(w))
    docs = [(1, f"so {changed} on"), (2, "say Hello, world! again"), (3, "hello wide world"), (4, "unu"), (5, "hello")]
    docs += [(10 + i, " ".join(rng.choice(w[:9]) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    bench = [(1, " ".join(w)), (2, "hello world"), (3, "unu"), (4, ".,!")] + [(10 + i, " ".join(rng.choice(w[:9]) for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    tokens = lambda t: t.lower().replace(",", " ").replace("!", " ").replace(".", " ").split()
    want = set()
    for d, t in docs:
        for i, x in bench:
            n = len(tokens(x))
            if n and (covered := _naive(tokens(x), tokens(t), min(dc.TILE, n))) >= dc.COVERAGE * n:
                want.add((d, i, covered))
    assert {(1, 1, 30), (2, 2, 2), (4, 3, 1)} <= want and not any(i == 4 for _, i, _ in want)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = [(r["doc_id"], x["item_id"], x["covered"]) for r in dc.mark(df, spark.createDataFrame(bench, "item_id long, text string")).collect() for x in r["leaks"]]
    assert len(found) == len(set(found)) and set(found) == want, (len(found), len(want))
    # Candidates are the same, whatever number of places is looked at at once, and hold all that leak.
    index = dc._index(bench, dc.TILE)
    hashes, first = common.words(pa.array([t for _, t in docs]), common.PUNCT)
    once = set(dc._candidates(hashes, first, *index, dc.COVERAGE))
    monkeypatch.setattr(dc, "_PLACES", 1)
    assert sorted(dc._candidates(hashes, first, *index, dc.COVERAGE)) == sorted(once)
    assert {(docs[r][0], bench[i][0]) for r, i in once} >= {(d, i) for d, i, _ in want}
