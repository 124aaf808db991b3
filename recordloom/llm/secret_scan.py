"""Secret scans in DataFrame functions only: three fixed patterns, and runs of characters that a Markov model takes for random strings.

The model: two first-order character Markov models, one of random strings and one of ordinary words and identifiers, both
counted from labelled samples. A run of 20 or more token characters is a secret if the log-likelihood ratio of the two passes a
threshold. The ratio is a table of one weight for each pair of characters, so its size doesn't depend on the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: The limits of 20 and 24 characters may stand in these two patterns: a failing match of a run could not hide another.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex", "markov")
#: Documents, about, that the ordinary words are taken from (chosen by a hash of doc_id), and random strings of each style.
SAMPLE_DOCS, SAMPLE_RANDOM = 2000, 1500
#: In thousandths of a nat: a run must be e**12 times likelier as a random string.
THRESHOLD = 12_000


def _samples(docs: DataFrame) -> DataFrame:
    """Labelled strings (label 1: random). Ordinary: words of a bounded sample, alone, in camel case and joined with underscores."""
    rows = docs.count()
    chosen = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) < min(1.0, SAMPLE_DOCS / max(rows, 1)) * 2**32)
    plain = chosen.select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("w"))
    ordinary = plain.select(F.explode(F.array("w", F.lower("w"), F.upper("w"), F.concat("w", F.initcap("w")), F.concat(F.lower("w"), F.lit("_"), F.lower("w")), F.concat(F.lower("w"), F.lit("-"), F.lower("w")))).alias("s"), F.lit(0).alias("label"))
    ids = docs.sparkSession.range(SAMPLE_RANDOM).select(F.sha2(F.concat(F.lit("random:"), F.col("id").cast("string")), 256).alias("h"))
    raw = F.unhex("h")
    random = ids.select(F.explode(F.array(F.substring("h", 1, 40), F.translate(F.base64(raw), "=", ""), F.translate(F.base64(raw), "+/=", "-_"), F.upper(F.translate(F.base64(raw), "+/=", "")), F.translate(F.base64(raw), "+/=", ""))).alias("s"), F.lit(1).alias("label"))
    return ordinary.unionByName(random)


def train(docs: DataFrame) -> list[int]:
    """The weight of each pair of characters (row by row, first the former), in thousandths of a nat, for random against ordinary."""
    n = len(ALPHABET)
    pairs = _samples(docs).where(F.length("s") > 1).select("label", F.explode(F.expr("transform(sequence(1, length(s) - 1), i -> substr(s, i, 2))")).alias("p"))
    count = {(r["label"], r["p"]): r["n"] for r in pairs.groupBy("label", "p").agg(F.count("*").alias("n")).collect() if set(r["p"]) <= set(ALPHABET)}
    out = []
    for a in ALPHABET:
        sums = [sum(count.get((k, a + b), 0) for b in ALPHABET) for k in (0, 1)]
        out += [round(1000 * (math.log((count.get((1, a + b), 0) + 0.5) / (sums[1] + 0.5 * n)) - math.log((count.get((0, a + b), 0) + 0.5) / (sums[0] + 0.5 * n)))) for b in ALPHABET]
    return out


def _let(value: Column, body) -> Column:
    """body of the value, which is evaluated once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, op, zero, levels: int = 2) -> Column:
    """For each element what op makes of zero and all elements before it. Chunks' totals are accumulated in the same way, so that the work is in
    proportion to the elements (but for chunks of chunks, of which there are 1 / 1024)."""
    step = lambda chunk: F.aggregate(chunk, zero, op)
    if not levels:
        return F.aggregate(values, F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out")), lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def of(v: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _CHUNK).cast("int")), lambda j: step(F.slice(v, j * _CHUNK + 1, F.lit(_CHUNK))))
        place = lambda i: F.floor(i / _CHUNK).cast("int")
        return _let(_before(chunks, op, zero, levels - 1), lambda c: F.transform(v, lambda _, i: op(F.get(c, place(i)), step(F.slice(v, place(i) * _CHUNK + 1, i % _CHUNK)))))

    return _let(values, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(F.slice(F.array(zero), 1, 0)))


_CHUNK = 32
_SPAN = "struct<start:int,kind:int,end:int>"


def _found(text: Column, pattern: str, kind: int, passes=None) -> Column:
    """The spans of a pattern: as `split` gives what lies between the matches, running lengths give their places."""
    none = F.array().cast(f"array<{_SPAN}>")
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ok = passes(text) if passes else F.transform(match, lambda _: F.lit(True))
    parts = F.filter(F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(match, F.length).alias("len"), ok.alias("ok")), lambda p: p["len"].isNotNull())

    def spans(p: Column) -> Column:
        at = _before(F.transform(p, lambda x: x["gap"] + x["len"]), lambda a, b: a + b, F.lit(0))
        placed = F.zip_with(p, at, lambda x, a: F.struct((a + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (a + x["gap"] + x["len"]).alias("end"), x["ok"].alias("ok")))
        return F.transform(F.filter(placed, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    return F.when(text.rlike(pattern), _let(parts, spans)).otherwise(none)


def _apart(spans: Column) -> Column:
    """Of all spans, in order, those of the patterns, and the model's that overlap none of them: none that begins before ends after its start, and none
    that begins after does so before its end."""
    last = len(KINDS) - 1
    ends = _before(F.transform(spans, lambda s: F.when(s["kind"] < last, s["end"]).otherwise(F.lit(0))), lambda a, b: F.greatest(a, b), F.lit(0))
    far = F.lit(2**31 - 1)
    starts = F.reverse(_before(F.reverse(F.transform(spans, lambda s: F.when(s["kind"] < last, s["start"]).otherwise(far))), lambda a, b: F.least(a, b), far))
    rows = F.arrays_zip(spans.alias("s"), ends.alias("e"), starts.alias("f"))
    return F.transform(F.filter(rows, lambda r: (r["s"]["kind"] < last) | (r["e"] <= r["s"]["start"]) & (r["f"] >= r["s"]["end"])), lambda r: r["s"])


def _random(weights: list[int], threshold: int):
    """For each run in the text, whether its ratio passes the threshold."""
    n = len(ALPHABET)
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")  # folded to one constant

    def ratio(run: Column) -> Column:
        codes = F.transform(F.split(run, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
        pairs = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), lambda a, b: F.get(table, a * n + b))
        return F.aggregate(pairs, F.lit(0), lambda acc, w: acc + w)

    return lambda text: F.transform(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), lambda run: ratio(run) >= threshold)


def scan(docs: DataFrame, weights: list[int], threshold: int = THRESHOLD, column: str = "spans") -> DataFrame:
    """docs with `column`: array of (start, kind, end), code points, end exclusive, by start and then kind (index in KINDS).

    The model's spans are added where they overlap no span of a pattern. Null text counts as empty; each row gives one row, and its columns
    stay as they are (one that has the name of `column` becomes <name>_input). The work grows in proportion to text and matches.
    """
    docs = common.make_room(docs, column.lower())
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(_found(text, ASSIGN, 0, lambda t: F.transform(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda g: F.length(g) >= 6)), _found(text, ACCESS, 1), _found(text, HEX, 2))
    added = _found(text, RUN, 3, _random(weights, threshold))
    both = lambda b, a: F.when(F.size(a) == 0, F.array_sort(b)).otherwise(_let(F.array_sort(F.concat(b, a)), _apart))
    return docs.withColumn(column, _let(base, lambda b: _let(added, lambda a: both(b, a))))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """One row for each document: how many spans of each pattern, their digest, and all spans as text."""
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return scanned.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_joined(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"), _joined(spans).alias("spans"), count(3).alias("n_markov"))


def redact(scanned: DataFrame, mask: str = "[secret]", column: str = "spans") -> DataFrame:
    """The text with each span of `column` replaced by a mask (overlapping spans by one), n_chars set anew where something was replaced. The
    column goes, the others stay."""
    step = lambda acc, s: F.when(
        s["start"] >= acc["at"],
        F.struct(F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)).alias("out"), s["end"].alias("at")),
    ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at")))
    masked = F.aggregate(column, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda acc: F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, F.length("text"))))
    hit = F.size(column) > 0
    new = common.free(scanned, "_text")
    out = scanned.withColumn(new, F.when(hit, masked).otherwise(F.col("text")))
    if "n_chars" in scanned.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length(new).cast("long")).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col(new)).drop(new, column)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.source(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(scan(docs, train(docs)))
