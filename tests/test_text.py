import pytest
from pyspark.sql import functions as F

from recordloom.functions import text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def two(spark, a, b, *fs):
    df = spark.createDataFrame([(a, b)], "l string, r string")
    return tuple(df.select(*[f.alias(f"y{i}") for i, f in enumerate(fs)]).first())


@pytest.mark.parametrize("raw, want", [("Acme (Pvt.) Ltd.", "acme pvt ltd"), ("A&B Co-op / West_End", "a b co-op / west_end"), ("ＡＣＭＥ　Ｌｔｄ", "acme ltd"), ("कंपनी", "क पन"), ("Straße 5", "strasse 5"), ("Café №5", "café no5"), ("ΟΔΟΣ", "οδοσ"), ("n/a", "n/a"), (None, "")])
def test_block_text(spark, raw, want):
    assert one(spark, raw, text.block_text) == want


def test_casefold_and_normalized_text(spark):
    odd = "ßŉǰΐİSTRASSE ſ µ ς Σ ﬃ Ǆ"
    assert one(spark, odd, text.casefold) == odd.casefold()
    assert one(spark, " A\x0b\x0cB \t\nC   D ", text.normalized_text) == "ab c d"
    assert one(spark, " S1-2, a,,b ", text.normalized_list) == "S1-2,a,,b"


@pytest.mark.parametrize("raw, want", [("acme private limited", {"acme private limited", "acme", "acme private"}), ("cisco", {"cis", "cisco"}), ("zinc", {"zinc"}), ("co", {"co"}), ("acme co ltd", {"acme co ltd", "acme co"}), ("na ltd", {"na ltd"})])
def test_legal_variants(spark, raw, want):
    assert set(one(spark, raw, text.legal_variants)) == want


def test_tokens(spark):
    assert one(spark, "the global steel trading company of pune ab", lambda c: text.informative_tokens(c, text.NAME_STOP, 3)) == ["global", "steel", "pune"]
    assert one(spark, "12 mg road 560001 near block 4b sector 221 bengaluru", lambda c: text.informative_tokens(c, text.BLOCK_ADDRESS_STOP, 3, True)) == ["560001", "221", "bengaluru", "block"]


@pytest.mark.parametrize("a, b, want", [("night", "nacht", 0.5), ("aaaa", "aa", 0.75), ("acme ltd", "acme limited", 0.636364), ("", "x", 0.0)])
def test_dice(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "l string, r string").withColumns({c: text.sorted_bigrams(text.casefold(F.col(c))) for c in "lr"}).withColumns({c: text.tagged(F.col(c)) for c in "lr"})
    assert round(df.select(text.dice(F.col("l"), F.col("r"))).first()[0], 6) == want


@pytest.mark.parametrize("a, b, want", [("", "", (1, 1, 0, 1)), ("abc", "", (0, 0, 1, 0)), ("acme ltd", "acme limited", (0.5, 0.083333, 0.333333, 0.666667))])
def test_affixes(spark, a, b, want):
    assert tuple(round(x, 6) for x in two(spark, a, b, *text.affix_ratios(F.col("l"), F.col("r")))) == want


@pytest.mark.parametrize("a, b, want", [("acme steel ltd", "acme ltd", (0.666667, 1, 1)), ("acme", "", (0, 0, 1)), ("", "acme", (0, 0, 0))])
def test_token_ratios(spark, a, b, want):
    assert tuple(round(x, 6) for x in two(spark, a, b, *text.token_ratios(text.tokens(F.col("l")), text.tokens(F.col("r"))))) == want


def test_validation_group(spark):
    rows = spark.createDataFrame([(f"S1-{i}",) for i in range(1, 8)], "x string").select(text.validation_group(F.col("x"))).collect()
    assert [r[0] for r in rows] == [2, 2, 0, 3, 4, 2, 4]


def test_id_number(spark):
    assert [one(spark, x, text.id_number) for x in ("S2-25", "S2-ab", "S2- -7x", "S2")] == [25, 0, -7, 0]
