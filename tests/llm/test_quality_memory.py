import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from recordloom.llm import common, quality


@pytest.mark.parametrize("most", [1_000_000, 60])
def test_only_the_result_is_written_to_files(spark, monkeypatch, most):
    monkeypatch.setattr(quality, "MOST", most)
    rng = random.Random(4)
    texts = ["".join(rng.choice(["ab", "c ", "é", "bca", "xyz "]) for _ in range(rng.randrange(1, 30))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(7)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: written.append(path) or parquet(self, path, *a, **b))
    before, work = spark.sparkContext._jsc.getPersistentRDDs().size(), common.shared_dir(spark)
    got = quality.classify(docs, labels, work)
    # Executors start processes for each file that they write.
    assert written == [f"{work}/result"] and len(got.inputFiles()) == 1
    assert got.count() == 80 and not common._kept.get(work)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def _task(spark):
    """What counts n-grams in a Python worker."""

    class Texts:
        def mapInArrow(self, f, schema):
            self.f = f
            return self

        groupBy = agg = lambda self, *a: self

    return quality.count(Texts()).f


def test_counting_holds_different_ngrams_only(spark):
    task = _task(spark)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(1000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 50])], ["text"]) for i in range(0, 1000, 50)]
    assert sum(map(len, texts)) > 2_000_000
    tracemalloc.start()
    out = list(task(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 100, peak
    want = Counter(x for t in texts for x in Counter(("\n" * 4 + t)[i : i + 4] for i in range(1, len(t) + 1)).elements())
    assert sum(b.num_rows for b in out) == len(want)
    assert sorted(np.concatenate([b.column("c").to_numpy() for b in out])) == sorted(want.values())


def test_counts_are_whole_where_a_task_sends_them_on_early(spark, monkeypatch):
    monkeypatch.setattr(quality, "_WINDOW", 50)
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz漢é") for _ in range(rng.randrange(0, 300))) for _ in range(30)] + [None, ""]
    out = list(_task(spark)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    assert len(out) > 2
    got = Counter()
    for b in out:
        for g, c in zip(b.column("g4").to_pylist(), b.column("c").to_pylist()):
            got[g] += c
    want = Counter(("\n" * 4 + t)[i : i + 4] for t in texts if t for i in range(1, len(t) + 1))
    assert sorted(got.values()) == sorted(want.values())
