"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text; perplexity against thresholds by language.

The model's n-grams are of characters. Their counts, the counts of what stands before and after them, and each order's probabilities
are sharded by n-gram and meet in joins. All trusted texts but those held out for thresholds teach, whole. The finished model's n-grams,
ordered, with the logarithms of their probabilities and of what their contexts leave, are broadcast and each document's n-grams looked up;
a model of more than MOST n-grams goes in shards, one after another, and no n-gram is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Characters of the model's longest n-grams.
ORDER = 4
#: N-grams of the longest order, about, that are broadcast at once, with 12 bytes for each n-gram and context of each order. A shard has those of the
#: two longest orders whose last character but one and the character before it have a number of that shard, and the shorter ones all.
MOST = 1_000_000
#: A text passes if its perplexity is at most this quantile of the trusted texts of its language that didn't teach: of CALIBRATE trusted
#: documents one, chosen by a hash of doc_id, is held out for that. Of 0.97 and 0.99 the one with the better sum of keep and reject rates (README).
CALIBRATE = 3
QUANTILE = 0.97
_WINDOW = 1 << 18


def _grams(codes: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """For each n up to ORDER a number for the n characters that end at each place, none of them that of another order's."""
    return [common.mix(h + np.uint64(1000 + n)).view(np.int64) for n, h in enumerate(common.ngram_hashes(codes, begin, ORDER), 1)]


def _contexts(grams: list[np.ndarray], begin: np.ndarray) -> list[np.ndarray]:
    """For each n the number of what stands before the n-gram's last character: of no character 0, and at a text's start -n."""
    out = [np.zeros_like(grams[0])]
    for n, g in enumerate(grams[:-1], 2):
        c = np.empty_like(g)
        c[1:] = g[:-1]
        c[begin[begin < len(c)]] = -n
        out.append(c)
    return out


def count(texts: DataFrame) -> DataFrame:
    """(g1..gN, h1..hN, c): the different n-grams of the longest order with their contexts, those of their ends, and how often they stand in texts."""
    names = [f"{k}{n}" for k in "gh" for n in range(1, ORDER + 1)]

    def task(batches):
        held: list[np.ndarray] = []  # of each window only the different n-grams, and how often they stand there

        def out():
            rows = np.concatenate(held, axis=1)
            held.clear()
            _, first, at = np.unique(rows[ORDER - 1], return_index=True, return_inverse=True)
            n = np.bincount(at.ravel(), weights=rows[-1], minlength=len(first)).astype(np.int64)
            held.append(np.vstack([rows[:-1, first], n]))

        for batch in batches:
            codes, off = common.characters(*common.text_bytes(batch.column("text")))
            for i, j, a, b in common.windows(off, _WINDOW):
                lead = min(ORDER, a - int(off[i]))
                begin = off[i:j] - (a - lead)
                begin = begin[begin >= 0]
                grams = _grams(codes[a - lead : b], begin)
                _, first, n = np.unique(grams[-1][lead:], return_index=True, return_counts=True)
                held.append(np.vstack([*(x[first + lead] for x in [*grams, *_contexts(grams, begin)]), n]))
                if sum(x.shape[1] for x in held) > 2 * _WINDOW:
                    out()
                    if held[0].shape[1] > _WINDOW:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], [*names, "c"])
        if held:
            out()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], [*names, "c"])

    parts = texts.mapInArrow(task, ", ".join(f"{x} long" for x in [*names, "c"]))
    return parts.groupBy(f"g{ORDER}").agg(F.sum("c").alias("c"), *[F.first(x).alias(x) for x in names if x != f"g{ORDER}"])


def train(texts: DataFrame, work: str) -> list[tuple]:
    """texts: (text), trusted. Returns for each order, from 1: its n-grams, ascending, with the last character's log-probability, and their
    contexts, ascending, with the log of what they leave to the next lower order; and last the log-probability of a character never seen."""
    model = collected(*learn(texts, work))
    common.let_go(work)
    return model


def learn(texts: DataFrame, work: str) -> tuple[list[DataFrame], float]:
    """The model of `train` in tables, kept for `work`, one for each order, from 1: (g, h, p, gamma, w), w being what shards follow from, null for orders 1 and 2.

    Below the highest order a count is the number of different characters seen before; each order's discounts follow from how many
    n-grams have counts of 1 to 4; an order's shards meet those of its contexts and those of the next lower order in joins.
    """
    tables = {ORDER: common.kept(count(texts), work)[0]}
    for k in range(ORDER - 1, 0, -1):
        # The n-grams that end alike differ in what stands first; a row of each keeps its context and ends.
        rest = [f"{x}{n}" for x in "gh" for n in range(1, k + 1) if (x, n) != ("g", k)]
        tables[k], seen = common.kept(tables[k + 1].groupBy(f"g{k}").agg(F.count("*").alias("c"), *[F.first(x).alias(x) for x in rest]), work)
    uniform = 1 / (seen + 1)
    below, out = None, []
    for k in range(1, ORDER + 1):
        t = tables[k].select(F.col(f"g{k}").alias("g"), F.col(f"h{k}").alias("h"), "c", (F.col("h3") if k > 2 else F.lit(None).cast("long")).alias("w"), *([F.col(f"g{k - 1}").alias("e")] if k > 1 else []))
        of = t.agg(*[F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]).first()
        discount = _discount(F.col("c"), [of[f"n{i}"] or 0 for i in range(1, 5)])
        contexts = t.groupBy("h").agg(F.sum("c").alias("total"), F.sum(discount).alias("left"))
        p = t.join(contexts, "h").withColumns({"own": (F.col("c") - discount) / F.col("total"), "gamma": F.col("left") / F.col("total")})
        p = p.join(below, "e").withColumn("p", F.col("own") + F.col("gamma") * F.col("q")) if k > 1 else p.withColumn("p", F.col("own") + F.col("gamma") * F.lit(uniform))
        p, _ = common.kept(p.select("g", "h", "p", "gamma", "w"), work)
        below = p.select(F.col("g").alias("e"), F.col("p").alias("q"))
        out.append(p)
    return out, float(np.log(uniform))


def collected(tables: list[DataFrame], unseen: float, shard: int = 0, of: int = 1) -> list[tuple]:
    """The model in arrays, as `train` returns it; of several shards the one of that number."""
    out = []
    for p in tables:
        p = p if of == 1 else p.where(F.col("w").isNull() | (F.pmod("w", F.lit(of)) == shard))
        rows = p.select("g", "h", F.log("p").cast("float").alias("p"), F.log("gamma").cast("float").alias("gamma")).toPandas()
        left, rows = rows.drop_duplicates("h").sort_values("h"), rows.sort_values("g")
        out.append((rows["g"].to_numpy(np.int64), rows["p"].to_numpy(np.float32), left["h"].to_numpy(np.int64), left["gamma"].to_numpy(np.float32)))
    return [*out, unseen]


def _discount(c, n: list[int]):
    """Of a count of 1, of 2, and of 3 or more; n: how many n-grams have counts of 1 to 4."""
    n = [max(1, x) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    d = [min(0.95 * i, max(0.05 * i, i - (i + 1) * y * n[i] / n[i - 1])) for i in range(1, 4)]
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where x stands in the sorted keys, and whether it does."""
    at = np.searchsorted(keys, x)
    at[at == len(keys)] = 0
    return at, keys[at] == x if len(keys) else np.zeros(len(x), bool)


def log_probability(grams: list[np.ndarray], contexts: list[np.ndarray], model: list[tuple]) -> np.ndarray:
    """Of the last character of each place's n-grams: its own if the longest was taught, else what its context leaves of the next lower order's."""
    out = np.zeros(len(grams[0]))
    todo = np.arange(len(out))
    for k in range(ORDER, 0, -1):
        keys, own, heads, gamma = model[k - 1]
        # Equal n-grams are looked up once: a window's characters have few different ones.
        x, first, back = np.unique(grams[k - 1][todo], return_index=True, return_inverse=True)
        back = back.ravel()
        at, hit = _find(keys, x)
        value = np.where(hit, own[at] if len(own) else 0.0, 0.0)
        miss, where = _find(heads, contexts[k - 1][todo][first])
        value = np.where(~hit & where, gamma[miss] if len(gamma) else 0.0, value)
        out[todo] += value[back]
        todo = todo[~hit[back]]
    out[todo] += model[-1]
    return out


def _sums(text: pa.Array, model: list[tuple], shard: int = 0, of: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sum of log-probabilities, by itself, over the characters that the shard answers for, and how many characters it has in all."""
    codes, off = common.characters(*common.text_bytes(text))
    sums = np.zeros(len(off) - 1)
    for i, j, a, b in common.windows(off, _WINDOW):
        if b > a:
            lead = min(ORDER, a - int(off[i]))
            begin = off[i:j] - (a - lead)
            begin = begin[begin >= 0]
            grams = _grams(codes[a - lead : b], begin)
            contexts = [c[lead:] for c in _contexts(grams, begin)]
            grams = [g[lead:] for g in grams]
            if of == 1:
                logp = log_probability(grams, contexts, model)
            else:
                own = contexts[2] % of == shard
                logp = np.zeros(len(own))
                logp[own] = log_probability([g[own] for g in grams], [c[own] for c in contexts], model)
            sums[i:j] += common.row_sums(logp, np.clip(off[i : j + 1], a, b) - a)
    return sums, np.diff(off)


def perplexity(docs: DataFrame, model: list[tuple], column: str = "perplexity") -> DataFrame:
    """docs with `column` (perplexity of a character, over the whole text) added: null for null and empty texts. Each text's is summed by itself."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def measure(text: pa.Array) -> pa.Array:
        sums, size = _sums(text, shared.value)
        return pa.array(np.exp(-sums / np.maximum(size, 1)), pa.float64(), mask=size == 0)

    return docs.withColumn(column, measure(F.coalesce(F.col("text"), F.lit(""))))


def _shard_sums(shared, shard: int, of: int):
    @F.arrow_udf("struct<v: double, n: long>")
    def measure(text: pa.Array) -> pa.Array:
        sums, size = _sums(text, shared.value, shard, of)
        return pa.StructArray.from_arrays([pa.array(sums, pa.float64()), pa.array(size, pa.int64())], ["v", "n"])

    return measure


def perplexity_in_shards(docs: DataFrame, tables: list[DataFrame], unseen: float, of: int, work: str) -> DataFrame:
    """(doc_id, lang, perplexity), a row for each row of docs: texts are read once for each shard of the model, and only numbers are shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = None
    for shard in range(of):
        shared = docs.sparkSession.sparkContext.broadcast(collected(tables, unseen, shard, of))
        part = docs.select("doc_id", "lang", F.unhex(F.md5(text.cast("binary"))).alias("m"), F.lit(shard).alias("s"), _shard_sums(shared, shard, of)(text).alias("x"))
        part, _ = common.kept(part, work)
        shared.unpersist()  # not destroyed: what is lost with an executor is scored again
        parts = part if parts is None else parts.unionByName(part)
    # Rows of the same id and text have the same sums; they are counted and made again.
    own = parts.groupBy("doc_id", "lang", "m", "s").agg(F.first("x").alias("x"), F.count("*").alias("rows"))
    own = own.groupBy("doc_id", "lang", "m").agg(F.array_sort(F.collect_list(F.struct("s", "x.v"))).alias("v"), F.first("x.n").alias("n"), F.first("rows").alias("rows"))
    total = F.aggregate("v", F.lit(0.0), lambda t, x: t + x["v"])
    out = own.select("doc_id", "lang", F.when(F.col("n") > 0, F.exp(-total / F.col("n"))).alias("perplexity"), F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_"))
    return out.drop("_")


def classify(docs: DataFrame, labels: DataFrame, work: str, quantile: float = QUANTILE) -> DataFrame:
    """docs: (doc_id, text, lang), labels: (doc_id, quality, toxic). Returns doc_id, lang, perplexity, threshold and keep, a row for each row.

    Trusted: labelled quality 1 and not toxic, two thirds of which teach and one third sets thresholds (of a document's repeated labels all must say so; null ids and null labels don't). A
    language without trusted texts, null included, takes the threshold over all languages. Null and empty texts aren't kept; with nothing
    trusted nothing is, and threshold is null. Rows that repeat are each judged, and teach each. Other columns are left out.
    """
    docs = docs.select("doc_id", "text", "lang")
    said = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("_q"), F.max(F.coalesce("toxic", F.lit(0))).alias("_t")).where("_q = 1 and _t = 0").select("_id")
    said, _ = common.kept(said, work)
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(CALIBRATE)) == 0
    trusted = docs.select("doc_id", "text").join(common.small(said), F.col("doc_id") == F.col("_id"), "left_semi").where(~held).select("text")
    tables, unseen = learn(trusted, work)
    of = max(1, -(-tables[-1].count() // MOST))
    if of == 1:
        narrow = perplexity(docs, collected(tables, unseen)).select("doc_id", "lang", "perplexity")
    else:
        narrow = perplexity_in_shards(docs, tables, unseen, of, work)
    narrow, rows = common.kept(narrow, work)
    own = narrow.join(common.small(said), F.col("doc_id") == F.col("_id"), "left_semi").where("perplexity is not null")
    # Where no document was held out, those that taught must do.
    cuts = [F.coalesce(F.percentile_approx(F.when(held, F.col("perplexity")), quantile, 10_000), F.percentile_approx("perplexity", quantile, 10_000)).cast("double").alias("c")]
    limits = {r["lang"]: r["c"] for r in own.where("lang is not null").groupBy("lang").agg(*cuts).collect()}
    every = own.agg(*cuts).first()["c"]
    limits = docs.sparkSession.createDataFrame(list(limits.items()), "_lang string, _own double")
    out = narrow.join(common.small(limits), F.col("lang") == F.col("_lang"), "left").withColumn("threshold", F.coalesce("_own", F.lit(every).cast("double"))).drop("_lang", "_own")
    out = out.withColumn("keep", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
    return common.result(out.coalesce(max(1, -(-rows // common.FILE_ROWS))), work)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its perplexity, its language's threshold, and whether it is kept."""
    work = common.shared_dir(spark)
    return classify(common.source(spark, sf_dir, "documents"), common.source(spark, sf_dir, "labels"), work)
