"""Text columns: normalization, tokens, n-grams and string similarities. All but NFKC and BLAKE2b stay in the JVM."""

from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that carry no information, and texts that stand for a missing value.
NAME_STOP = ["and", "associates", "business", "company", "co", "corp", "corporation", "group", "inc", "incorporated", "international", "limited", "llc", "llp", "ltd", "of", "private", "public", "services", "solutions", "the", "trading"]
BLOCK_ADDRESS_STOP = ["avenue", "boulevard", "building", "district", "floor", "near", "opposite", "road", "sector", "street", "suite", "tower", "unit"]
PAIR_ADDRESS_STOP = ["apartment", "avenue", "block", "building", "city", "district", "floor", "near", "opposite", "road", "sector", "street", "suite", "town", "tower", "unit"]
LEGAL_SUFFIXES = ["private limited", "pvt ltd", "pvt. ltd.", "pvt limited", "limited", "llp", "ltd", "ltd.", "inc", "incorporated", "corporation", "company", "co", "associates", "group", "solutions", "services"]
BLOCK_PLACEHOLDERS = ["na", "n/a", "null", "none", "nil", "unknown", "undefined", "-"]
PAIR_PLACEHOLDERS = ["na", "n/a", "null", "none", "nil", "unknown", "-"]

TOKEN = "[\\p{L}\\p{N}][\\p{L}\\p{N}\\p{M}]*"
#: Tokens of a field that are indexed.
TOKENS = 8

# Characters whose case folding isn't their lower case, by Python's Unicode tables.
_FOLDS = {c: c.casefold() for c in map(chr, range(0x80, 0x110000)) if c.casefold() != c.lower()}
_ONE = {a: b for a, b in _FOLDS.items() if len(b) == 1}
_ONE["Σ"] = "σ"  # at a word's end its lower case would be another letter
_MORE = {a: b for a, b in _FOLDS.items() if len(b) > 1}
#: Digits in the sense of str.isdigit, as a character class.
DIGIT = "\\p{Nd}" + "".join(c for c in map(chr, range(0x110000)) if c.isdigit() and unicodedata.category(c) != "Nd")


def words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def casefold(c: Column) -> Column:
    """Full case folding: what folds to another single character is translated, what grows is replaced where it occurs, the rest is lower-cased."""
    pairs = F.expr("array(" + ", ".join(f"struct('{a}' AS a, '{b}' AS b)" for a, b in _MORE.items()) + ")")
    grown = F.aggregate(pairs, c, lambda text, p: F.replace(text, p["a"], p["b"]))
    c = F.when(c.rlike("[" + "".join(_MORE) + "]"), grown).otherwise(c)
    return F.lower(F.translate(c, "".join(_ONE), "".join(_ONE.values())))


def strip(c: Column) -> Column:
    """Without white space in Unicode's sense at both ends."""
    return F.regexp_replace(F.regexp_replace(c, "(?U)^\\s+", ""), "(?U)\\s+$", "")


def normalized_text(c: Column) -> Column:
    """Control characters deleted, white space collapsed and stripped, case folded; null counts as empty."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", "")
    return casefold(F.trim(F.regexp_replace(c, "(?U)\\s+", " ")))


def normalized_list(c: Column) -> Column:
    """A comma list with each item stripped; order, case and empty items stay."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(F.array_join(F.transform(F.split(c, ","), strip), ","))


@F.arrow_udf(T.StringType())
def _nfkc(c: pa.Array) -> pa.Array:
    return pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in c.to_pylist()], pa.string())


def block_text(c: Column) -> Column:
    """For keys: NFKC, case folding, and only letters, numbers and `- _ /` kept. Only texts beyond ASCII go to Python."""
    c = F.coalesce(c, F.lit(""))
    c = F.coalesce(_nfkc(F.when(c.rlike("[^\\x00-\\x7F]"), c)), c)
    c = F.regexp_replace(casefold(strip(c)), "(?U)[^\\p{L}\\p{N}\\s\\-_/]", " ")
    return F.trim(F.regexp_replace(c, "(?U)\\s+", " "))


def useful(c: Column, least: int = 2) -> Column:
    return (F.length(c) >= least) & ~F.lower(c).isin(BLOCK_PLACEHOLDERS)


def country_key(country: Column, value: Column) -> Column:
    return F.concat(country, F.lit("\x1f"), value)


def legal_variants(c: Column) -> Column:
    """The text and, for each legal suffix that it ends with (within a word too), the text without it."""
    suffixes = sorted({" ".join(s.replace(".", " ").split()) for s in LEGAL_SUFFIXES})
    cut = F.transform(words(suffixes), lambda s: F.when(F.endswith(c, s), F.trim(F.left(c, F.length(c) - F.length(s)))).otherwise(F.lit("")))
    return F.array_distinct(F.filter(F.concat(F.array(c), cut), lambda v: useful(v)))


def tokens(c: Column) -> Column:
    """Distinct runs of letters and numbers, marks allowed after the first."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0)))


def field_tokens(c: Column, stop: list[str], least: int, address: bool = False) -> Column:
    """The first of the tokens that aren't stop words: longest first, in addresses numbers first."""
    number = lambda t: t.rlike(f"^[{DIGIT}]+$")
    long = lambda t: F.length(t) >= least
    keep = (lambda t: F.when(number(t), F.length(t) >= 3).otherwise(long(t))) if address else long
    kept = F.filter(tokens(c), lambda t: keep(t) & ~F.array_contains(words(stop), t))
    key = lambda t: F.struct((F.when(number(t), 0).otherwise(1) if address else F.lit(0)).alias("k"), (-F.length(t)).alias("n"), t.alias("t"))
    return F.slice(F.transform(F.array_sort(F.transform(kept, key)), lambda s: s["t"]), 1, TOKENS)


def informative_tokens(c: Column, stop: list[str], least: int, address: bool = False) -> Column:
    """field_tokens of block text, or where there are none its words of that length that aren't stop words."""
    found = field_tokens(c, stop, least, address)
    rest = F.slice(F.filter(F.split(c, " "), lambda t: (F.length(t) >= least) & ~F.array_contains(words(stop), t)), 1, TOKENS)
    return F.when(F.size(found) > 0, found).otherwise(rest)


def safe_text(c: Column) -> Column:
    """Stripped, empty for null and for texts that stand for a missing value."""
    c = strip(F.coalesce(c, F.lit("")))
    return F.when(casefold(c).isin(PAIR_PLACEHOLDERS), F.lit("")).otherwise(c)


def sorted_bigrams(folded: Column) -> Column:
    """The bigrams of a case-folded text, white space collapsed, between two spaces; none of an empty text."""
    compact = F.trim(F.regexp_replace(folded, "(?U)\\s+", " "))
    inner = F.transform(F.sequence(F.lit(1), F.greatest(F.length(compact) - 1, F.lit(1))), lambda i: F.substr(compact, i, F.lit(2)))
    ends = F.array(F.concat(F.lit(" "), F.left(compact, F.lit(1))), F.concat(F.right(compact, F.lit(1)), F.lit(" ")))
    grams = F.when(F.length(compact) > 1, F.concat(inner, ends)).otherwise(ends)
    return F.when(compact == "", F.array().cast("array<string>")).otherwise(F.array_sort(grams))


def tagged(grams: Column) -> Column:
    """Each bigram of a sorted array as a number: its two characters and its occurrence (of up to 2**22 equal ones), so that a set of them is
    a multiset and is compared as numbers. grams must be a stored column."""
    code = lambda c, bits: F.shiftleft(F.ascii(c).cast("long"), bits)
    return F.transform(grams, lambda g, i: code(F.left(g, F.lit(1)), 43) + code(F.right(g, F.lit(1)), 22) + (i + 1 - F.array_position(grams, g)))


def character_codes(folded: Column) -> Column:
    """The characters' numbers of a case-folded text, white space collapsed, between two spaces; none of an empty text."""
    compact = F.trim(F.regexp_replace(folded, "(?U)\\s+", " "))
    codes = F.transform(F.split(F.concat(F.lit(" "), compact, F.lit(" ")), ""), lambda c: F.ascii(c).cast("long"))
    return F.when(compact == "", F.array().cast("array<bigint>")).otherwise(codes)


def sorted_bigram_codes(codes: Column) -> Column:
    """Each two neighbours of character_codes (a stored column) as a number, as in `tagged`; the numbers are sorted."""
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.sort_array(F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: F.shiftleft(a, 43) + F.shiftleft(b, 22)))


def tagged_codes(grams: Column) -> Column:
    """`tagged` of the same bigrams as sorted numbers (a stored column): no text is cut or compared."""
    return F.transform(grams, lambda g, i: g + (i + 1 - F.array_position(grams, g)))


def digit_tokens(all_tokens: Column) -> Column:
    return F.filter(all_tokens, lambda t: t.rlike(f"[{DIGIT}]"))


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(empty))


def dice(left: Column, right: Column, both: Column | None = None) -> Column:
    """Of tagged bigrams; 0 if both are empty. both: how many they share, where that is a stored column."""
    return ratio(2 * (F.size(F.array_intersect(left, right)) if both is None else both), F.size(left) + F.size(right))


def _common(left: Column, right: Column, part) -> Column:
    """Whether `part` of n characters agrees falls with n, so that a binary search over the powers of two finds the most."""
    both = F.least(F.length(left), F.length(right))
    powers = F.transform(F.sequence(F.floor(F.log2(F.greatest(both, F.lit(1)).cast("double"))).cast("int"), F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2.0), e).cast("int"))
    return F.aggregate(powers, F.lit(0), lambda n, p: F.when((n + p <= both) & (part(left, n + p) == part(right, n + p)), n + p).otherwise(n))


def common_prefix(left: Column, right: Column) -> Column:
    return _common(left, right, F.left)


def common_suffix(left: Column, right: Column) -> Column:
    return _common(left, right, F.right)


def affix_ratios(left: Column, right: Column, prefix: Column | None = None, suffix: Column | None = None) -> tuple[Column, Column, Column, Column]:
    """Common prefix and suffix, length difference and length ratio, by the longer length; (1, 1, 0, 1) for two empty texts. prefix, suffix:
    the common lengths, where those are stored columns."""
    hi, lo = F.greatest(F.length(left), F.length(right)), F.least(F.length(left), F.length(right))
    prefix, suffix = common_prefix(left, right) if prefix is None else prefix, common_suffix(left, right) if suffix is None else suffix
    return ratio(prefix, hi, 1.0), ratio(suffix, hi, 1.0), ratio(hi - lo, hi), ratio(lo, hi, 1.0)


def token_ratios(left: Column, right: Column, both: Column | None = None) -> tuple[Column, Column, Column]:
    """Of sets: Jaccard, overlap by the smaller one, and whether one contains the other (an empty right is contained, an empty left contains
    nothing). both: how many they share, where that is a stored column."""
    both, n, m = F.size(F.array_intersect(left, right)) if both is None else both, F.size(left), F.size(right)
    return ratio(both, n + m - both), ratio(both, F.least(n, m)), ((n > 0) & ((both == n) | (both == m))).cast("double")


def log_count(c: Column) -> Column:
    return F.log1p(F.greatest(F.lit(0), c).cast("double"))


def sigmoid(z: Column, clip: float = 30.0) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-clip), F.least(F.lit(clip), z))))


@F.arrow_udf(T.IntegerType())
def validation_group(entity_id: pa.Array) -> pa.Array:
    """0 to 4 by BLAKE2b of the id; group 0 validates."""
    digest = lambda x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8, person=b"aml-split").digest(), "big") % 5
    return pa.array([None if x is None else digest(x) for x in entity_id.to_pylist()], pa.int32())


def id_number(entity_id: Column) -> Column:
    """The number from the fourth character on, as far as there is one; else 0."""
    return F.coalesce(F.regexp_extract(F.substr(entity_id, F.lit(4)), "^\\s*([+-]?[0-9]+)", 1).try_cast("bigint"), F.lit(0))
