import random
import time

import pytest

from recordloom.operators import evaluate, features, model
from recordloom.plans import views


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    names = ["Acme Steel Ltd", "Acme Steel", "North River Trading", "Blue House"]
    rows = [(i, f"{rng.choice(names)} {rng.randrange(6)}\n{rng.choice(['12 MG Road Pune', '77 Lake Street', 'short', ''])}\nrest {rng.randrange(3)}", "en") for i in range(90)]
    # Null and empty texts, and ids that stand for several rows.
    rows += [(90, None, "en"), (91, "", None), (92, "", "fr"), (93, "x\nshort\nrest 1", "en"), (93, "y\n77 LAKE STREET", "en"), (94, "x\nshort\nrest 1", "en"), (94, "z\n77 lake street", "en"), (94, "z\n12 mg road pune", "en")]
    path = str(tmp_path_factory.mktemp("scored"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{path}/documents.parquet")
    return path


def _shuffled(spark) -> set[str]:
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(disk.length()) if (name := disk.apply(i).getName()).startswith("shuffle_")}


def test_scored_in_parts_leaves_no_shuffle_files(spark, folder, monkeypatch):
    m = model.Model({2: views.FIXED, 3: views.FIXED}, {2: views.BIAS, 3: views.BIAS})
    want = sorted(map(tuple, model.score(features.pair_features(views.candidates(spark, folder), views.records(spark, folder)), m).select("src", "s1", "cand", "score").collect()))
    before = _shuffled(spark)
    monkeypatch.setattr(views, "ROUND_PAIRS", max(1, len(want) // 3))
    got = views.scored(spark, folder)
    for _ in range(40):
        if not (left := _shuffled(spark) - before):
            break
        time.sleep(0.5)
    assert not left
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, views.scored(spark, folder, 0.5).collect())) == [r for r in want if r[3] >= 0.5]


def test_truth_by_keys_is_the_truth(spark, folder):
    truth = views.truth(spark, folder).select("s1", "cand").distinct()
    keys = views.truth_keys(spark, folder).cache()
    sizes = {r["s1"]: r["n_truth"] for r in views.truth_sizes(keys).collect()}
    want = {r["s1"]: r["count"] for r in truth.groupBy("s1").count().collect()}
    assert sizes == want and len(want) > 10
    pairs = spark.createDataFrame([(f"S1-{a}", f"S{1 + b % 3}-{b}") for a in range(0, 95, 3) for b in range(95) if b % 3], "s1 string, cand string")
    among = views.truth_among(pairs, keys)
    assert sorted(map(tuple, among.collect())) == sorted(map(tuple, truth.collect()))
    some = pairs.where("hash(s1, cand) % 3 = 0").selectExpr("s1", "cand", "pmod(hash(cand, s1), 100) / 100D AS score")
    entities = pairs.select("s1").distinct()
    search = ([0.3, 0.6], [("threshold", None, 0.0), ("top_k", 2, 0.0), ("margin", None, 0.1)])
    whole = evaluate.threshold_search(spark, entities, truth, some, *search).collect()
    assert evaluate.threshold_search(spark, entities, views.truth_among(some.select("s1", "cand"), keys), some, *search, n_truth=views.truth_sizes(keys)).collect() == whole
    keys.unpersist()
