import math
import random

from recordloom.llm import common, quality


def _corpus(spark):
    rng = random.Random(21)
    texts = ["".join(rng.choice(["ab", "c ", "é", "漢", "bca", "xyz "]) for _ in range(rng.randrange(1, 40))) for _ in range(90)]
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)] + [(90, None, "en"), (91, "", None), (5, texts[5], "en"), (5, "another ab", "en"), (None, "ab", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 70), 0) for i in range(90)], "doc_id long, quality int, toxic int")
    return docs, labels


def _sorted(df):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["lang"] or "", r["perplexity"] or 0.0, r["threshold"], r["keep"]) for r in df.collect()))


def test_all_trusted_texts_teach_and_a_large_model_goes_in_shards(spark, monkeypatch):
    docs, labels = _corpus(spark)
    taught, learn = [], quality.learn
    monkeypatch.setattr(quality, "TRAIN_BYTES", 200, raising=False)  # as the bound on what teaches was
    monkeypatch.setattr(quality, "learn", lambda texts, work: taught.append(texts.count()) or learn(texts, work))
    one = _sorted(quality.classify(docs, labels, common.shared_dir(spark)))
    held = docs.where("doc_id < 70 and pmod(xxhash64(doc_id, 'held'), 3) = 0").count()
    assert taught == [docs.where("doc_id < 70").count() - held]
    monkeypatch.setattr(quality, "MOST", 60)  # n-grams a shard: several shards, in each of which something is found
    many = _sorted(quality.classify(docs, labels, common.shared_dir(spark)))
    assert taught[1] == taught[0] and len(one) == len(many) == docs.count()
    for a, b in zip(one, many):
        assert a[:3] == b[:3] and a[5] == b[5] and math.isclose(a[3], b[3], rel_tol=1e-12) and math.isclose(a[4], b[4], rel_tol=1e-12)
