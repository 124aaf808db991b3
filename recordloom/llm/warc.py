"""WARC archives as a Spark source and sink; the reader verifies the chain of record boundaries.

Writing: records are lines of the text sink whose separator is a record's end, so that the archives lie wherever Spark can write.
Reading: the text source cuts the archives at each version line ("WARC/1.0" and a line end, which can't overlap itself), in parallel and
within splits. A piece whose predecessor ends like a record is a candidate record, which names its successor's offset. Pointer jumping
from each file's start keeps the candidates that the chain reaches; a magic inside a payload isn't reached, and its piece goes back to
the record that holds it. A chain must end where its file ends, and payloads must have the digests that their records declare.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

VERSION, END = "WARC/1.0\r\n", "\r\n\r\n"
#: Payloads of fewer bytes are stored each time.
LEAST = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write(pages: DataFrame, path: str, work: str, least: int = LEAST) -> None:
    """Write a record for each (page_id, url, html); null html is an empty payload, null url an empty URI, a null page_id stays null.

    Of equal payloads of `least` bytes or more the one with the smallest page_id is stored and the others refer to it (rows that
    share that smallest page_id are all stored). Payloads aren't shuffled unless there are more revisits than may be broadcast.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), body.alias("body"), F.sha2(body, 256).alias("digest"))
    marks = common.table(rows.select("page_id", "digest", F.octet_length("body").alias("bytes")).where(F.col("bytes") >= least), f"{work}/digests")
    firsts = common.table(marks.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"), f"{work}/firsts")
    again = marks.join(common.small(firsts), "digest").where(F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))).select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "first").distinct()
    again = common.table(again, f"{work}/revisits")
    joined = rows.join(common.small(again), rows["page_id"].eqNullSafe(again["_id"]) & (rows["digest"] == again["_digest"]), "left")
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("body").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "body"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">\r\n"))
    record = F.concat(
        F.lit(VERSION + "WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        name(F.col("page_id")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: " + PROFILE + "\r\nWARC-Refers-To: "), name(F.col("first")))).otherwise(F.lit("\r\n")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )
    joined.select(record.alias("value")).write.option("lineSep", END).text(path)


def _field(head, name: str):
    return F.regexp_extract(head, f"(?im)^{name}: *([^\\r\\n]*)", 1)


def _parsed(df: DataFrame) -> DataFrame:
    """value: a record without its version line. Adds its fields, its payload, and how many bytes the record says it has (null: it doesn't say)."""
    parts = df.withColumn("_p", F.split("value", END, 3))
    head, http = F.get("_p", F.lit(0)), F.coalesce(F.get("_p", F.lit(1)), F.lit(""))
    rest = F.coalesce(F.get("_p", F.lit(2)), F.lit(""))
    number = lambda c, name: _field(c, name).try_cast("bigint")
    out = parts.withColumns({"length": number(head, "Content-Length"), "full_bytes": number(http, "Content-Length"), "_rest": rest, "_head": F.octet_length(head)})
    payload = F.when(F.col("_rest").endswith(END), F.expr("left(_rest, length(_rest) - 4)")).otherwise(F.col("_rest"))
    uri = lambda name: F.regexp_extract(_field(head, name), "^<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")
    return out.withColumns({"payload": payload, "page_id": uri("WARC-Record-ID"), "refers_to": uri("WARC-Refers-To"), "record_type": _field(head, "WARC-Type"), "url": _field(head, "WARC-Target-URI"), "declared": F.regexp_replace(_field(head, "WARC-Payload-Digest"), "^sha256:", "")}).withColumn(
        "record_bytes", F.col("_head") + F.col("length") + len(VERSION) + 2 * len(END)
    )


def chain(offset: np.ndarray, size: np.ndarray, total: int) -> np.ndarray:
    """Which candidates the chain from offset 0 reaches and which of them are whole. offset: of the candidates, ascending; size: of the whole
    record, or below 1 if unknown; total: the file's bytes.

    Pointer jumping: each round every candidate's pointer doubles its reach, and what reached ones point at is reached. A pointer leads to
    the candidate at its record's end, to the file's end (n), or nowhere (n + 1): such a record is broken, and the last that is reached.
    """
    n = len(offset)
    end = offset + size
    at = np.searchsorted(offset, end)
    jump = np.where((size > 0) & (at < n) & (offset[np.minimum(at, max(n - 1, 0))] == end), at, n + 1) if n else np.zeros(0, np.int64)
    jump = np.where((size > 0) & (end == total), n, jump)
    jump = np.append(jump, [n, n + 1])
    first = jump.copy()
    reach = np.zeros(n + 2, bool)
    reach[0] = n > 0 and offset[0] == 0
    for _ in range(max(1, n).bit_length() + 1):
        reach[jump[reach]] = True
        jump = jump[jump]
    return reach[:n] & (first[:n] <= n)


_FIELDS = "page_id long, refers_to long, record_type string, url string, declared string, full_bytes long, payload_bytes long, payload_digest string"
_CHAIN = f"file string, record long, part int, parts int, piece string, {_FIELDS}"
_COLUMNS = [c.split()[0] for c in _CHAIN.split(", ")]


def _reached(df: pd.DataFrame) -> pd.DataFrame:
    """One file's pieces in order: the records reached, each with the pieces that its payload runs over. Where the chain doesn't end at the
    file's end, a last row says so: record_type "damaged", record the offset from which on nothing is read, payload_bytes what that is."""
    df = df.sort_values(["block", "seq"], kind="stable").reset_index(drop=True)
    n = df["n"].to_numpy(np.int64)
    # A version line stands before each piece but the first, which is what stands before the first version line: nothing, in a sound file.
    offset = np.concatenate([[0], np.cumsum(n + len(VERSION))[:-1]]) - len(VERSION)
    total = int((n + len(VERSION)).sum()) - len(VERSION)
    before = np.concatenate([[False], df["ends"].to_numpy(bool)[:-1]])
    before[1:2] |= n[:1] == 0
    pieces = np.flatnonzero(before)
    kept = pieces[chain(offset[pieces], df["record_bytes"].fillna(0).to_numpy(np.int64)[pieces], total)]
    size = df["record_bytes"].fillna(0).to_numpy(np.int64)[kept]
    stop = np.searchsorted(offset, offset[kept] + size)
    rows = np.concatenate([np.arange(a, b) for a, b in zip(kept, stop)]) if len(kept) else np.zeros(0, np.int64)
    parts = stop - kept
    out = df.iloc[rows].copy()
    out["record"], out["parts"], out["part"] = np.repeat(offset[kept], parts), np.repeat(parts, parts), rows - np.repeat(kept, parts)
    read = int(offset[kept[-1]] + size[-1]) if len(kept) else 0
    out = out[_COLUMNS]
    if read < total:
        end = {"file": df["file"].iat[0], "record": read, "part": 0, "parts": 1, "record_type": "damaged", "payload_bytes": total - read}
        out = pd.concat([out.astype(object), pd.DataFrame([{c: end.get(c) for c in _COLUMNS}], dtype=object)], ignore_index=True)
    return out.astype(object).where(out.notna(), None)


class Damaged(ValueError):
    """An archive whose chain of records doesn't end at its end, or whose payloads don't have the declared digests."""


def read(spark: SparkSession, path: str, work: str, damaged: str = "raise") -> DataFrame:
    """The records of the archives under path: page_id, url, record_type, refers_to, declared digest, and of the payload its bytes and digest.

    For a revisit the two are of the payload that it stands for, as it declares them. damaged: "raise" (an error if any file is damaged)
    or "report": of a damaged file the records up to the damage, and for the rest a row of record_type "damaged" whose payload_bytes are
    those not read, its url the file; a response whose payload hasn't the declared digest has record_type "damaged", too. Files without a
    byte hold no record. What goes to one task for each file is a row of numbers for each piece, never a payload; payloads that a magic
    cut into pieces are put together from pieces found by their own digests.
    """
    if damaged not in ("raise", "report"):
        raise ValueError(f"damaged: {damaged}")
    lines = spark.read.option("lineSep", VERSION).text(path)
    raw = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    seen = _parsed(raw.withColumn("seq", F.monotonically_increasing_id()))
    seen = seen.select("file", "block", "seq", F.octet_length("value").cast("long").alias("n"), F.col("value").endswith(END).alias("ends"), F.sha2("value", 256).alias("piece"), "record_bytes", "page_id", "refers_to", "record_type", "url", "declared", "full_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    found = common.table(seen.groupBy("file").applyInPandas(_reached, _CHAIN), f"{work}/chain")
    keep = [c.split()[0] for c in _FIELDS.split(", ")]
    out = found.where("parts = 1").select("file", *keep)
    cut = found.where("parts > 1").select("file", "record", "part", "piece")
    if not cut.isEmpty():
        values = raw.withColumn("piece", F.sha2("value", 256)).join(common.small(cut.select("piece").distinct()), "piece", "left_semi").select("piece", "value").dropDuplicates(["piece"])
        pieces = common.table(values, f"{work}/pieces").join(cut, "piece")
        whole = pieces.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("part", "value"))).alias("p")).select("file", F.array_join("p.value", VERSION).alias("value"))
        out = out.unionByName(_parsed(whole).select("file", "page_id", "url", "record_type", "refers_to", "declared", "full_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")))
    revisit, response = F.col("record_type") == "revisit", F.col("record_type") == "response"
    out = out.withColumn("record_type", F.when(response & (F.col("declared") != "") & (F.col("declared") != F.col("payload_digest")), F.lit("damaged")).otherwise(F.col("record_type")))
    out = out.withColumns({"payload_bytes": F.when(revisit, F.col("full_bytes")).otherwise(F.col("payload_bytes")), "payload_digest": F.when(revisit, F.col("declared")).otherwise(F.col("payload_digest")), "url": F.when(F.col("record_type") == "damaged", F.col("file")).otherwise(F.col("url"))})
    out = common.table(out.select(*keep), f"{work}/records")
    if damaged == "raise":
        bad = [f"{r['url']}: {r['payload_bytes']} bytes" for r in out.where("record_type = 'damaged'").limit(5).collect()]
        if bad:
            raise Damaged("; ".join(bad))
    return out


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = common.shared_dir(spark)
    write(common.source(spark, sf_dir, "pages"), f"{work}/archives", work)
    out = read(spark, f"{work}/archives", work).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    common.remove(spark, work, ("records",))
    return out


OP1_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to FROM f
"""
