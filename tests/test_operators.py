import os
import zipfile

import pytest
from pyspark.sql import functions as F

from recordloom.operators import cleaning, decide, evaluate, model, output
from recordloom.sources import tsv


def test_tsv_round_trip(spark, tmp_path):
    rows = [("S1-1", 'say "hi"', " x\ty ", "NA"), ("S1-2", "", "line\nbreak", "")]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    tsv.write(df, str(tmp_path / "a"), ["entity_id"], single=True)
    assert [tuple(r) for r in tsv.read(spark, str(tmp_path / "a"), tsv.RECORD).orderBy("entity_id").collect()] == rows
    with pytest.raises(Exception):
        tsv.write(df, str(tmp_path / "a"))
    tsv.replace(df.limit(1), str(tmp_path / "a"))
    assert tsv.read(spark, str(tmp_path / "a"), tsv.RECORD).count() == 1


def test_files_of_whole_lines_are_split(spark, tmp_path):
    line = lambda i, name: f"S1-{i}\t{name}\t{'street ' * 10}{i}\tIN\n"
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    kinds = {"plain": ['say ""so""', '"a ""b"" c"'], "quoted": ['"two\nlines"', "x"], "carriage": ["a\r", "b"]}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        for kind, names in kinds.items():
            (tmp_path / kind).write_text("\ufeff" + head + "".join(line(i, names[i % 2]) for i in range(40_000)), newline="")
            df = tsv.read(spark, str(tmp_path / kind), tsv.RECORD)
            assert df.count() == 40_000 and df.select("entity_id").distinct().count() == 40_000
            assert (df.rdd.getNumPartitions() > 10) == (kind == "plain")
            if kind == "quoted":
                assert {r[0] for r in df.select("business_name").distinct().collect()} == {"two\nlines", "x"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_zip_and_discovery(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        for n in ("d/dataset/train/train_source1.tsv", "__MACOSX/dataset/train/train_source1.tsv", "d/dataset/test/other.tsv", "d/dataset/train/._train_source2.tsv"):
            z.writestr(n, "entity_id\n")
    got = tsv.unzip(spark, str(tmp_path / "x.zip"), str(tmp_path / "s"))
    assert [os.path.basename(p) for p in got] == ["train_source1.tsv"]
    assert tsv.find(spark, str(tmp_path / "s")) == got
    assert tsv.cleaned_name(got[0]) == os.path.join("train", "train_source1_cleaned.tsv")


def test_match_lists(spark):
    df = spark.createDataFrame([("a", ""), ("b", " "), ("c", "S2-1"), ("d", "S2-1, S3-2"), ("e", ", ,"), ("f", "S2-1,,S3-2"), ("g", "X-9")], "source1_entity_id string, matched_entity_ids string")
    assert cleaning.match_list_profile(df).first().asDict() == {"rows": 7, "blank": 2, "nonblank": 5, "one": 2, "many": 2, "unparseable": 1}
    assert {tuple(r) for r in cleaning.truth_pairs(df).collect()} == {(2, "c", "S2-1"), (2, "d", "S2-1"), (3, "d", "S3-2"), (2, "f", "S2-1"), (3, "f", "S3-2")}
    merged = output.merge(df, spark.createDataFrame([("c", "S3-1"), ("c", "S2-1"), ("z", "S2-2")], "s1 string, cand string"))
    assert dict(merged.where("source1_entity_id in ('a', 'c')").collect()) == {"a": "", "c": "S2-1,S3-1"}


@pytest.mark.parametrize("truth, predicted, want", [("", "", 1), ("a", "", 0), ("", "a", 0), ("a", "ab", 0.555556), ("ab", "a", 0.833333), ("a", "b", 0)])
def test_fbeta(spark, truth, predicted, want):
    make = lambda s: spark.createDataFrame([("e", c) for c in s], "s1 string, cand string")
    got = evaluate.entity_scores(spark.createDataFrame([("e",)], "s1 string"), make(truth), make(predicted)).first()
    assert round(got["fbeta"], 6) == want


@pytest.mark.parametrize("sizes, want", [([1, 2, 3, 4], (2, 3, 3, 3)), ([1, 1, 1, 9], (1, 1, 1, 1)), ([5], (5, 5, 5, 5))])
def test_percentiles(spark, sizes, want):
    df = spark.createDataFrame([(2, str(i), n) for i, n in enumerate(sizes)], "src int, s1 string, n long")
    r = evaluate.percentiles(df).first()
    assert (r["p50"], r["p90"], r["p95"], r["p99"]) == want


def test_decisions(spark):
    df = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.9), ("a", "z", 0.5), ("b", "x", 0.2)], "s1 string, cand string, score double")
    got = lambda *a, **k: {(r["s1"], r["cand"]) for r in decide.select(df, *a, **k).collect()}
    assert got(0.5) == {("a", "x"), ("a", "y"), ("a", "z")}
    assert got(0.5, "top_k", 1) == {("a", "x")}
    assert got(0.1, "margin", margin=0.0) == {("a", "x"), ("a", "y"), ("b", "x")}
    with pytest.raises(ValueError):
        decide.select(df, 0.5, "other")


def test_model_round_trip(spark, tmp_path):
    m = model.Model({2: [0.5] * 34}, {2: -1.0}, {2: 0.4})
    model.save(spark, m, str(tmp_path / "m"))
    assert model.load(spark, str(tmp_path / "m")) == m
    m.names = m.names[::-1]
    with pytest.raises(ValueError):
        model.score(spark.createDataFrame([(2,)], "src int"), m)
    assert len(model.THRESHOLDS) == 18 and model.THRESHOLDS[-1] == 0.9500000000000003


def test_sgd_follows_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((300, 34))
    y = (x[:, 0] > 0.7).astype(int)
    rows = [(2, f"S1-{i:04d}", "c", int(y[i]), *map(float, x[i])) for i in range(300)]
    df = spark.createDataFrame(rows, ["src", "s1", "cand", "label", *model.NAMES]).withColumn("src", F.col("src").cast("int"))
    w, b = model.train_sgd(df, 2)
    heavy, v, c = min(20.0, (300 - y.sum()) / max(1, y.sum())), np.zeros(34), 0.0
    for _ in range(3):
        e = (1 / (1 + np.exp(-(x @ v + c))) - y) * np.where(y > 0, heavy, 1.0)
        v, c = v - 0.05 * (x.T @ e / 300 + 1e-4 * v), c - 0.05 * e.sum() / 300
    assert np.allclose(w, v) and np.isclose(b, c)
