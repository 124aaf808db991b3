"""The 34 features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

# The features' names, in the order that a model's weights follow.
NAMES = """name_exact name_char_dice name_token_jaccard name_token_overlap_min name_token_containment name_informative_overlap
name_prefix_ratio name_suffix_ratio name_length_difference name_length_ratio name_missing_left name_missing_right
address_exact address_char_dice address_token_jaccard address_token_overlap_min address_token_containment address_digit_overlap
address_long_number_agreement address_prefix_ratio address_suffix_ratio address_length_difference address_length_ratio
address_missing_left address_missing_right country_exact country_missing_left country_missing_right
block_country_exact_name block_exact_name block_country_exact_address block_country_name_token block_country_address_token
candidate_count_log1p""".split()


def of_records(df: DataFrame, side: str) -> DataFrame:
    """Per record, before any join: texts, token sets and tagged bigrams, in columns that end with the side (l or r)."""
    name, address, country = (text.safe_text(F.col(f"{c}_normalized")) for c in ("business_name", "business_address", "country"))
    df = df.select("src", "entity_id", name.alias("n"), address.alias("a"), country.alias("c"))
    df = df.withColumns({"nt": text.tokens(F.col("n")), "at": text.tokens(F.col("a")), "nf": text.casefold(F.col("n")), "af": text.casefold(F.col("a"))})
    df = df.withColumns({"ng": text.character_codes(F.col("nf")), "ag": text.character_codes(F.col("af"))})
    df = df.withColumns({"ng": text.sorted_bigram_codes(F.col("ng")), "ag": text.sorted_bigram_codes(F.col("ag"))})
    df = df.withColumns({"ng": text.tagged_codes(F.col("ng")), "ag": text.tagged_codes(F.col("ag"))})
    df = df.withColumns({"ni": F.array_except("nt", text.words(text.NAME_STOP)), "ad": text.digit_tokens(F.col("at"))}).withColumn("al", F.filter("ad", lambda t: F.length(t) >= 4))
    return df.select("src", "entity_id", *[F.col(c).alias(f"{c}_{side}") for c in ("n", "a", "c", "nt", "at", "ng", "ag", "ni", "ad", "al")])


def pair_features(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """candidates (src, s1, cand, blocking_method) with their features; records are cleaned. Pairs of unknown records are left out."""
    return of_pairs(candidates, *sides(records))


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the features need of each record: of those of source 1 (s1, ...), and of the others (src, cand, ...)."""
    left = of_records(records.where("src = 1"), "l").drop("src").withColumnRenamed("entity_id", "s1")
    return left, of_records(records.where("src <> 1"), "r").withColumnRenamed("entity_id", "cand")


def of_pairs(candidates: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pair_features of records in the form that `sides` gives them. All candidates of a record must be there, as they are counted.

    Pairs are dealt by s1 once, for their count and for the join; in a stated number of parts, as features cost far more than their rows are
    wide: parts sized by bytes would be too few. A record has few pairs, by the fan-out limits."""
    dealt = candidates.repartition(int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s1")
    dealt = dealt.withColumn("candidate_count", F.count("*").over(Window.partitionBy("src", "s1")))
    p = dealt.join(left, "s1").join(right, ["src", "cand"])
    l, r = (lambda c: F.col(f"{c}_l")), (lambda c: F.col(f"{c}_r"))
    # What sets share and the texts' common ends serve several features each: columns of a projection before.
    p = p.withColumns({f"{c}_both": F.size(F.array_intersect(l(c), r(c))) for c in ("nt", "at", "ni", "ad", "ng", "ag")} | {f"{c}_{end}": f(l(c), r(c)) for c in ("n", "a") for end, f in (("prefix", text.common_prefix), ("suffix", text.common_suffix))})
    both = lambda c: F.col(f"{c}_both")
    flag = lambda c: c.cast("double")
    equal = lambda c: flag((l(c) != "") & (l(c) == r(c)))
    missing = lambda c: (flag(l(c) == ""), flag(r(c) == ""))
    affixes = lambda c: text.affix_ratios(l(c), r(c), F.col(f"{c}_prefix"), F.col(f"{c}_suffix"))
    methods = F.split("blocking_method", ",")
    has = lambda m: flag(F.array_contains(methods, m))
    name_tokens, address_tokens = (text.token_ratios(l(c), r(c), both(c)) for c in ("nt", "at"))
    values = [
        equal("n"), text.dice(l("ng"), r("ng"), both("ng")), *name_tokens, text.ratio(both("ni"), F.least(F.size(l("ni")), F.size(r("ni")))), *affixes("n"), *missing("n"),
        equal("a"), text.dice(l("ag"), r("ag"), both("ag")), *address_tokens,
        text.ratio(both("ad"), F.size(l("ad")) + F.size(r("ad")) - both("ad")), flag(F.arrays_overlap(l("al"), r("al"))),
        *affixes("a"), *missing("a"), equal("c"), *missing("c"),
        has("country_exact_name"), has("exact_name"), has("country_exact_address"), has("country_name_token"), has("country_address_token"),
        text.log_count(F.col("candidate_count")),
    ]
    return p.select("src", "s1", "cand", "blocking_method", "candidate_count", *[v.alias(n) for n, v in zip(NAMES, values, strict=True)])
