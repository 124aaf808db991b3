"""Language identification: multinomial naive Bayes over hashed character n-grams, its log-probabilities broadcast, scored in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: n-grams of 1 to ORDERS characters, hashed to 2**BITS features; about so many documents (chosen by a hash of doc_id) teach.
ORDERS, BITS, SAMPLE_DOCS = 3, 15, 40_000
#: Documents, about, that teach a language at least: all of them if it has fewer.
LEAST_DOCS = 100
#: Languages of a block: with 2**BITS features each this bounds what is collected, broadcast and held at once (16 MB). All blocks are asked.
BLOCK_LANGS = 128
_WINDOW = 1 << 17
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_LOWER[48:58] = 48


def _features(codes: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """For each order, the feature of the n-gram that ends at each character; none reaches back over a text's beginning (`begin`, ascending)."""
    return [(common.mix(h + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64) for n, h in enumerate(common.ngram_hashes(codes, begin, ORDERS))]


def _piece(codes: np.ndarray, begin: np.ndarray, a: int, b: int) -> list[np.ndarray]:
    """The features of the characters [a, b) of texts that begin at `begin`; a text cut at a is read as if it weren't."""
    lead = int(min(ORDERS - 1, max(0, a - begin[0])))
    near = begin - (a - lead)
    return [f[lead:] for f in _features(codes[a - lead : b], near[near >= 0])]


def _characters(text) -> tuple[np.ndarray, np.ndarray]:
    """A text column's characters, A-Z lower-cased, white space as a space, any digit as 0, and each row's first."""
    data, off = common.text_bytes(text)
    return common.characters(_LOWER[data], off)


def train(labelled: DataFrame, known: dict[str, int] | None = None, bits: int = BITS) -> list:
    """labelled: (text, lang), lang not null. Returns blocks of languages in order, as broadcasts: languages, log priors, and the matrix
    of log-probabilities (language, feature). known: how many documents each language has, if only a sample of them teaches."""
    spark = labelled.sparkSession
    work = common.shared_dir(spark)

    def rows_of(total, docs):
        return pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "docs": pa.array([docs[k] for k in total], pa.int64()), "counts": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    def count(batches):
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            codes, off = _characters(batch.column("text"))
            for lang in set(langs.tolist()):
                rows = np.flatnonzero(langs == lang)
                docs[lang] = docs.get(lang, 0) + len(rows)
                sums = total.setdefault(lang, np.zeros(1 << bits, np.int64))
                for r in rows:
                    for a in range(int(off[r]), int(off[r + 1]), _WINDOW):
                        for f in _piece(codes, off[r : r + 1], a, min(a + _WINDOW, int(off[r + 1]))):
                            np.add.at(sums, f, 1) if len(f) < 64 else sums.__iadd__(np.bincount(f, minlength=1 << bits))
                if len(total) >= BLOCK_LANGS:
                    yield rows_of(total, docs)
                    total, docs = {}, {}
        yield rows_of(total, docs)

    parts = labelled.select("text", "lang").mapInArrow(count, "lang string, docs long, counts binary").where("docs > 0")

    def merge(df: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [df["lang"].iat[0]], "docs": [int(df["docs"].sum())], "counts": [sum(np.frombuffer(x, np.int64) for x in df["counts"]).tobytes()]})

    merged = common.table(parts.groupBy("lang").applyInPandas(merge, "lang string, docs long, counts binary"), f"{work}/languages")
    docs = {x["lang"]: x["docs"] for x in merged.select("lang", "docs").collect()}
    size = {k: (known or docs).get(k, n) for k, n in docs.items()}
    langs, every = sorted(docs), float(sum(size.values()))
    blocks = []
    for a in range(0, len(langs), BLOCK_LANGS):
        some = langs[a : a + BLOCK_LANGS]
        found = {x["lang"]: x["counts"] for x in merged.where(F.col("lang").between(some[0], some[-1])).select("lang", "counts").collect()}
        counts = np.array([np.frombuffer(found[k], np.int64) for k in some]) + 0.5
        logp = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
        blocks.append(spark.sparkContext.broadcast((some, np.log([size[k] / every for k in some]), logp)))
    common.remove(spark, work)
    return blocks


def _held(blocks: list):
    """The blocks' values, in a worker one at a time: of several, each is dropped after its turn."""
    for block in blocks:
        yield block.value
        if len(blocks) > 1 and hasattr(block, "_value"):
            del block._value


def predict(docs: DataFrame, blocks: list, column: str | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """docs with lang_pred and score added, the posterior of the predicted language, at even priors' odds tempered by the n-grams' overlap; or,
    if a column is named, with a struct of both. It is written to the shared folder, without the columns named so.

    `und` with score 0 if the text is null, empty or without a letter, or if nothing was taught. Whole texts count; lang and
    other columns are no inputs. A tie goes to the language that is first in code point order. Each row gives one row. docs' own columns
    of these names become lang_pred_input and score_input.
    """
    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def score(text: pa.Array) -> pa.Array:
        codes, off = _characters(text)
        rows = len(off) - 1
        top, rest, names = np.full(rows, -np.inf), np.zeros(rows), np.full(rows, "und", object)
        for langs, prior, logp in _held(blocks):
            sums = np.zeros((len(langs), rows))
            for i, j, a, b in common.windows(off, _WINDOW):
                if b > a:
                    features, at = _piece(codes, off[i:j], a, b), np.clip(off[i : j + 1], a, b) - a
                    for k in range(len(langs)):
                        weight = logp[k]
                        sums[k, i:j] += common.row_sums(sum(weight[f] for f in features), at)
            # An n-gram of each order ends at each character; they overlap, so that their evidence counts once.
            z = sums / ORDERS + prior[:, None]
            best, high = z.argmax(axis=0), z.max(axis=0)
            better = high > top  # of equals the earlier block's stands
            names[better] = np.array(langs, object)[best[better]]
            peak = np.maximum(top, high)
            rest = rest * np.exp(top - peak) + np.exp(z - peak).sum(axis=0)
            top = peak
        known = np.array(_has_letter(text), bool) & bool(blocks)
        names[~known] = "und"
        scores = np.where(known, 1 / np.maximum(rest, 1), 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    told = score(F.coalesce(F.col("text"), F.lit("")))
    if column:
        out = docs.withColumn(column, told)
    else:
        docs = common.make_room(docs, "lang_pred", "score")
        both = common.free(docs, "_told")
        out = docs.withColumn(both, told).withColumns({"lang_pred": F.col(f"{both}.lang_pred"), "score": F.col(f"{both}.score")}).drop(both)
    return common.result(out.drop(*without), common.shared_dir(docs.sparkSession))


def _has_letter(text: pa.Array) -> list[bool]:
    out = []
    for a in range(0, len(text), 64):
        for x in text.slice(a, 64).to_pylist():
            out.append(bool(x) and (any(c.isalpha() for c in x[:64]) or any(c.isalpha() for c in x)))
    return out


def fit(docs: DataFrame, teaches) -> list:
    """Train on the rows for which the column `teaches` holds and lang is not null: on about SAMPLE_DOCS of them, chosen by a hash, and of each
    language about LEAST_DOCS or, if it has fewer, all."""
    spark, text, lang = docs.sparkSession, F.col("text"), F.col("lang")
    known = docs.where(teaches & lang.isNotNull()).select("doc_id", text, lang)
    work = common.shared_dir(spark)
    sizes = common.table(known.groupBy("lang").agg(F.count("*").alias("_n")), f"{work}/sizes")
    size = {r["lang"]: r["_n"] for r in sizes.collect()}
    rate = min(1.0, SAMPLE_DOCS / max(1, sum(size.values())))
    if rate < 1:
        share = F.greatest(F.lit(rate), F.least(F.lit(1.0), LEAST_DOCS / F.col("_n")))
        chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < F.ceil(share * (1 << 20))
        known = known.join(common.small(sizes), "lang").where(chosen | (F.col("_n") <= LEAST_DOCS))
    blocks = train(known, size)
    common.remove(spark, work)
    return blocks


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.source(spark, sf_dir, "documents")
    held = common.crc_mod("doc_id", 3) == 1
    told = common.free(docs, "_told")
    out = predict(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("text")), fit(docs, ~held), told, ("text",))
    return out.select("doc_id", "held_out", f"{told}.lang_pred", f"{told}.score")
