"""Blocking: keys of each record, fan-out limits, and the candidate pairs that share a block."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

EXACT = ("exact_name", "country_exact_name", "exact_address", "country_exact_address")
RANKED = ("country_name_token", "country_address_token")
#: Records of a target source that a block may hold; a record's rarest blocks of a ranked method that are used.
FANOUT, RANK = 50, 5
#: What the exact lookup says of its pairs, in the order that the format fixes.
LOOKUP_METHODS = "country_exact_name,exact_name,country_exact_address,exact_address"


def with_block_text(df: DataFrame) -> DataFrame:
    """Cleaned records with the block texts N and A, computed once for each record."""
    return df.withColumns({"N": text.block_text(F.col("business_name_normalized")), "A": text.block_text(F.col("business_address_normalized")), "C": text.strip(F.coalesce("country_normalized", F.lit("")))})


def keys(df: DataFrame, fast: bool = False) -> DataFrame:
    """(src, entity_id, method, block_key), distinct, of cleaned records; fast: the exact methods only.

    All methods' keys of a record are one array, exploded once, so that a record is read once whatever the number of methods.
    """
    df = with_block_text(df.where(F.coalesce("entity_id", F.lit("")) != ""))
    name, address, has_country = text.useful(F.col("N")), text.useful(F.col("A"), 8), text.useful(F.col("C"))
    none = F.array().cast("array<string>")
    df = df.withColumn("V", F.when(name, text.legal_variants(F.col("N"))).otherwise(none)).withColumn("W", F.when(address, F.array("A")).otherwise(none))
    lists = {"exact_name": F.col("V"), "exact_address": F.col("W")}
    country = {"country_exact_name": F.col("V"), "country_exact_address": F.col("W")}
    if not fast:
        n, a = (lambda least: text.informative_tokens(F.col("N"), text.NAME_STOP, least)), (lambda least: text.informative_tokens(F.col("A"), text.BLOCK_ADDRESS_STOP, least, True))
        df = df.withColumns({"n3": F.when(name, n(3)).otherwise(none), "n2": F.when(name, n(2)).otherwise(none), "a3": F.when(address, a(3)).otherwise(none), "a2": F.when(address, a(2)).otherwise(none)})
        pair = lambda c: F.when(F.size(c) > 0, F.array(F.array_join(F.slice(c, 1, 2), " "))).otherwise(none)
        lists |= {"name_prefix": F.transform(F.filter("V", lambda v: F.length(v) <= 24), lambda v: F.left(v, F.lit(10))), "name_token": F.col("n3"), "name_pair": pair(F.col("n3")), "address_token": F.col("a3"), "address_pair": pair(F.col("a3"))}
        country |= {"country_name_token": F.concat("n3", "n2"), "country_name_pair": pair(F.col("n3")), "country_address_token": F.concat("a3", "a2"), "country_address_pair": pair(F.col("a3"))}
    tag = lambda method, values: F.transform(values, lambda v: F.struct(F.lit(method).alias("method"), v.alias("block_key")))
    empty = F.array().cast("array<struct<method:string,block_key:string>>")
    of_country = F.concat(*[tag(m, F.transform(v, lambda x: text.country_key(F.col("C"), x))) for m, v in country.items()])
    every = F.concat(*[tag(m, v) for m, v in lists.items()], F.when(has_country, of_country).otherwise(empty))
    return df.select("src", "entity_id", F.explode(F.array_distinct(every)).alias("k")).select("src", "entity_id", "k.method", "k.block_key").distinct()


def block_counts(postings: DataFrame) -> DataFrame:
    """Records in each block of each target source."""
    return postings.where("src <> 1").groupBy("src", "method", "block_key").agg(F.count("*").alias("target_count"))


def ranked_blocks(postings: DataFrame, fanout: int | None = None) -> DataFrame:
    """Source 1's blocks that a target source has too, ranked by rarity within a record and method.

    A limit on the count may go before the ranking: the rank begins with the count. It also drops the hot keys before any join.
    """
    counts = block_counts(postings)
    if fanout:
        counts = counts.where(F.col("target_count") <= fanout)
    own = postings.where("src = 1").select(F.col("entity_id").alias("s1"), "method", "block_key")
    rank = F.row_number().over(Window.partitionBy("src", "s1", "method").orderBy("target_count", "block_key"))
    return own.join(counts, ["method", "block_key"]).withColumn("token_rank", rank).select("src", "s1", "method", "block_key", "target_count", "token_rank")


def eligible_blocks(postings: DataFrame, fanout: int = FANOUT, rank: int = RANK) -> DataFrame:
    """The blocks that are probed: at most `fanout` records, of the ranked methods the `rank` rarest. Only those methods are ranked."""
    ranked = F.col("method").isin(*RANKED)
    some = ranked_blocks(postings.where(ranked), fanout).where(F.col("token_rank") <= rank).drop("token_rank")
    counts = block_counts(postings.where(~ranked)).where(F.col("target_count") <= fanout)
    own = postings.where(~ranked & (F.col("src") == 1)).select(F.col("entity_id").alias("s1"), "method", "block_key")
    return some.unionByName(own.join(counts, ["method", "block_key"]).select("src", "s1", "method", "block_key", "target_count"))


def candidates(postings: DataFrame, fanout: int = FANOUT, rank: int = RANK) -> DataFrame:
    """(src, s1, cand, blocking_method): each pair once, its methods in order. A block gives at most `fanout` pairs a record."""
    return probed(eligible_blocks(postings, fanout, rank), postings)


def probed(probe: DataFrame, postings: DataFrame) -> DataFrame:
    """candidates, of eligible_blocks."""
    targets = postings.where("src <> 1").withColumnRenamed("entity_id", "cand")
    pairs = probe.join(targets, ["src", "method", "block_key"]).groupBy("src", "s1", "cand")
    return pairs.agg(F.array_join(F.array_sort(F.collect_set("method")), ",").alias("blocking_method"))


def exact_lookup(df: DataFrame) -> DataFrame:
    """(src, s1, cand, blocking_method) of records that agree in country, address and a variant of the name (no fan-out limit)."""
    base = with_block_text(df).withColumn("K", text.block_text(F.col("country_normalized"))).where((F.col("entity_id") != "") & (F.col("K") != "") & (F.length("A") >= 8))
    left = base.where("src = 1").select(F.col("entity_id").alias("s1"), "K", "A", F.explode(text.legal_variants(F.col("N"))).alias("V"))
    right = base.where("src <> 1 and N <> ''").select("src", F.col("entity_id").alias("cand"), "K", "A", F.explode(text.legal_variants(F.col("N"))).alias("V"))
    return left.distinct().join(right.distinct(), ["K", "A", "V"]).select("src", "s1", "cand").distinct().withColumn("blocking_method", F.lit(LOOKUP_METHODS))
