import random

from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm import common


def _stages(spark, docs, sf_dir):
    """Each stage's rows, as the driver runs them: written and read again."""
    work = common.shared_dir(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.table(stage(spark, docs, sf_dir), f"{work}/{name}")
        yield name, docs


def test_clashing_columns_repeated_rows_and_empty_tables(spark, tmp_path):
    extra = {c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) for c in ("spans", "_base", "_p", "score", "lang_pred", "leaks", "_told", "_row", "_id", "_again", "_leaks", "_spans", "_text", "component_id", "size", "key", "bin", "taken", "n", "s", "kept")}
    words = "the others wait there with nothing but time and water while we go on".split()
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(n))
    rows = [(i, f"{text(40)} password=abcdef12 tail", "en", f"s{i % 2}") for i in range(20)]
    rows += [rows[0], (None, text(30), "en", "s0"), (None, None, "en", None), (30, "", None, "s1")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns(extra)
    spark.createDataFrame([(1, text(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {"language": 22, "near_duplicates": 21, "decontaminate": 21, "secrets": 21, "mixture": 21}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, out in _stages(spark, docs, str(tmp_path)):
        got = out.collect()
        assert len(got) == want[name], name
        if name != "mixture":
            assert out.columns == docs.columns
            assert all(r[c] == f"{c} of {'null' if r['doc_id'] is None else r['doc_id']}" for r in got for c in extra), name
        if name == "secrets":
            assert all("abcdef12" not in r["text"] and r["n_chars"] == len(r["text"]) for r in got)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    for name, out in _stages(spark, docs.limit(0), str(tmp_path)):
        assert out.collect() == [], name


def test_planted_cases(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = {"en": [f"{a}th{b}" for a in "bdfgk" for b in ("er", "ing", "ow", "is")], "fr": [f"{a}eau{b}" for a in "bdfgk" for b in ("é", "que", "oir", "x")]}
    make = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) for _ in range(n))
    rows = [(i, make(lang, 80), lang, f"s{i % 3}") for i, lang in enumerate(["en", "fr"] * 30)]
    item = make("en", 60)
    rows += [(100, rows[0][1], "en", "s0"), (101, rows[1][1] + " beaux", "fr", "s1"), (102, f"{make('en', 20)} {item} {make('en', 20)}", "en", "s2"), (103, "12 34 %", "en", "s0"), (104, None, "en", "s0")]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(60))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "secrets", "mixture"]


def test_near_duplicates_keep_one_row_of_each(spark):
    rng = random.Random(9)
    make = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    t = [make() for _ in range(9)]
    near = lambda x: x + " tail"
    rows = [(1, t[0], "a"), (1, t[0], "b"), (1, t[0], "b"), (None, t[1], "a"), (None, t[1], "a"), (None, near(t[1]), "a")]  # repeated rows; near and equal texts without doc_id
    rows += [(5, t[2], "a"), (None, t[2], "a"), (None, near(t[2]), "a"), (9, near(t[2]), "a")]  # with and without doc_id
    rows += [(7, t[3], "a"), (7, t[4], "a")]  # different texts that share a doc_id
    rows += [(3, t[5], "a"), (3, near(t[5]), "a"), (4, t[5], "a")]  # a repeated doc_id comes first, too
    rows += [(None, None, "a"), (None, "", "a"), (20, None, "a"), (21, "", "a"), (-4, t[6], "a"), (22, near(t[6]), "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, df, "").collect()
    kept = sorted(((r["doc_id"], r["text"]) for r in got), key=str)
    three = [x for x in kept if x[0] == 3]
    assert len(three) == 1 and three[0][1] in (t[5], near(t[5]))
    none = [x for x in kept if x[0] is None and x[1]]
    assert len(none) == 1 and none[0][1] in (t[1], near(t[1]))
    assert sorted((x for x in kept if x not in three + none), key=str) == sorted([(1, t[0]), (5, t[2]), (7, t[3]), (7, t[4]), (None, None), (None, ""), (20, None), (21, ""), (-4, t[6])], key=str)
