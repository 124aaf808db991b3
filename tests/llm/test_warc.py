import hashlib
import pathlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import common, warc

FAKE = "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello"


def _trip(spark, rows, **read):
    work = common.shared_dir(spark)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, extra int")
    warc.write(df.repartition(2) if rows else df, f"{work}/a", work)
    for k, v in read.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        return {(r["page_id"], r["payload_digest"]): r for r in warc.read(spark, f"{work}/a", work).collect()}
    finally:
        for k in read:
            spark.conf.unset(k.replace("__", "."))


def test_round_trip_rejects_magic_in_payloads(spark):
    long = "é" * 200
    html = ["<p>a</p>", None, "", long, long, FAKE, "x" + FAKE * 3 + "\r\n\r\n", "WARC/1.0\r\n" + FAKE, long, "tail\r\n\r\n", "\r\n\r\n\r\n", "z" * 300_000]
    rows = [(i, None if i == 2 else f"http://h/{i} a\r\nb", h, 1) for i, h in enumerate(html)]
    for settings in ({}, {"spark__sql__files__maxPartitionBytes": "1000", "spark__sql__files__openCostInBytes": "1"}):
        got = _trip(spark, rows, **settings)
        assert len(got) == len(rows)
        for i, h in enumerate(html):
            raw = (h or "").encode()
            r = got[i, hashlib.sha256(raw).hexdigest()]
            assert r["payload_bytes"] == len(raw)
            assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if i in (4, 8) else ("response", None))


def test_nulls_ties_and_empty_table(spark):
    assert _trip(spark, []) == {}
    big = "b" * 100
    work = common.shared_dir(spark)
    df = spark.createDataFrame([(None, None, big), (5, "u", big), (5, "u", big), (6, "u", big), (7, "u", "s" * 99), (8, "u", "s" * 99)], "page_id long, url string, html string")
    warc.write(df, f"{work}/a", work)
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in warc.read(spark, f"{work}/a", work).collect())
    assert got == [("5", "response", None), ("5", "response", None), ("6", "revisit", 5), ("7", "response", None), ("8", "response", None), ("None", "revisit", 5)]


def test_chain_is_what_a_walk_finds():
    rng = np.random.default_rng(0)
    for _ in range(300):
        offset = np.unique(np.concatenate([[0], rng.integers(0, 60, 25)]))
        size, total = rng.integers(0, 12, len(offset)), int(rng.integers(60, 70))
        at, seen = 0, set()
        known = dict(zip(offset.tolist(), size.tolist()))
        while at in known and known[at] > 0 and (at + known[at] in known or at + known[at] == total):
            seen.add(at)
            at += known[at]
        assert set(offset[warc.chain(offset, size, total)].tolist()) == seen


@pytest.mark.parametrize("split", ["128m", "400k"])
def test_no_record_is_lost_to_line_ends(spark, split):
    tails = ["\r\n", "\r", "\r\n\r\n", "\r\n\r\nWARC/1.0\r\n", "\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n"]
    df = spark.range(20_000).select("id", F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 6), F.get(F.array(*[F.lit(t) for t in tails]), (F.col("id") % 5).cast("int"))).alias("html")).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), "html")
    work = common.shared_dir(spark)
    warc.write(df.coalesce(1), f"{work}/a", work)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read(spark, f"{work}/a", work).select("page_id", "payload_digest")
        want = df.select("page_id", F.sha2("html", 256).alias("payload_digest"))
        assert got.count() == 20_000 and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_damage_is_told(spark, tmp_path):
    work = common.shared_dir(spark)
    df = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 30) for i in range(20)], "page_id long, url string, html string")
    warc.write(df.coalesce(1), f"{work}/a", work)
    whole = b"".join(p.read_bytes() for p in sorted(pathlib.Path(f"{work}/a").glob("part-*")))
    at = whole.index(b"<p>7</p>")
    kinds = {"shortened": whole[:at] + whole[at + 10 :], "truncated": whole[: at + 25], "headless": b"junk" + whole, "changed": whole[:at] + b"<q>" + whole[at + 3 :], "longer": whole + b"x"}
    intact = {"shortened": 7, "truncated": 7, "headless": 0, "changed": 19, "longer": 19}
    for kind, data in kinds.items():
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "a.warc").write_bytes(data)
        with pytest.raises(warc.Damaged):
            warc.read(spark, f"{tmp_path}/{kind}", f"{work}/{kind}")
        got = warc.read(spark, f"{tmp_path}/{kind}", f"{work}/{kind}", damaged="report").collect()
        sound = {r["page_id"] for r in got if r["record_type"] == "response"}
        assert len(sound) == intact[kind] and len(got) == len(sound) + 1, kind
        assert sound == (set(range(20)) - {7} if kind == "changed" else set(range(intact[kind]))), kind
