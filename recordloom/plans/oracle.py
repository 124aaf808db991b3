"""The registered queries in SQL: common table expressions, and for each query what it selects from them."""

from __future__ import annotations

from ..functions import text as t
from ..operators.features import NAMES
from .views import BIAS, FIXED

_list = lambda values: "[" + ", ".join("'" + v + "'" for v in values) + "]"
_TOKEN = "'[\\p{L}\\p{N}][\\p{L}\\p{N}\\p{M}]*'"


def _norm(x: str) -> str:
    return f"replace(lower(trim(regexp_replace(regexp_replace(coalesce({x}, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g'), '\\s+', ' ', 'g'))), 'ß', 'ss')"


def _block(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}\\s\\-_/]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _useful(x: str, least: int = 2) -> str:
    return f"(length({x}) >= {least} AND NOT list_contains({_list(t.BLOCK_PLACEHOLDERS)}, lower({x})))"


def _informative(x: str, stop: list[str], least: int, address: bool = False) -> str:
    number = "regexp_full_match(w, '\\p{Nd}+')"
    keep = f"CASE WHEN {number} THEN length(w) >= 3 ELSE length(w) >= {least} END" if address else f"length(w) >= {least}"
    first = f"CASE WHEN {number} THEN 0 ELSE 1 END" if address else "0"
    found = f"list_transform(list_sort(list_transform(list_filter(list_distinct(regexp_extract_all({x}, {_TOKEN})), lambda w: {keep} AND NOT list_contains({_list(stop)}, w)), lambda w: {{'k': {first}, 'n': -length(w), 't': w}}))[1:8], lambda s: s.t)"
    rest = f"list_filter(string_split({x}, ' '), lambda w: length(w) >= {least} AND NOT list_contains({_list(stop)}, w))[1:8]"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE {rest} END"


_SUFFIXES = sorted({" ".join(s.replace(".", " ").split()) for s in t.LEGAL_SUFFIXES})
_VARIANTS = f"list_distinct(list_filter(list_concat([bn], list_transform({_list(_SUFFIXES)}, lambda s: CASE WHEN ends_with(bn, s) THEN trim(left(bn, length(bn) - length(s))) ELSE '' END)), lambda v: {_useful('v')}))"
_NONE = "[]::VARCHAR[]"


def _keys(fast: bool) -> str:
    part = lambda method, values: f"SELECT src, entity_id, '{method}' AS method, unnest({values}) AS block_key FROM toks"
    own = lambda method, values: part(method, f"CASE WHEN hc THEN list_transform({values}, lambda v: c || chr(31) || v) ELSE {_NONE} END")
    pair = lambda x: f"CASE WHEN len({x}) > 0 THEN [array_to_string({x}[1:2], ' ')] ELSE {_NONE} END"
    out = [part("exact_name", "v"), own("country_exact_name", "v"), part("exact_address", "w"), own("country_exact_address", "w")]
    if not fast:
        out += [part("name_prefix", "list_transform(list_filter(v, lambda x: length(x) <= 24), lambda x: left(x, 10))"), part("name_token", "n3"), own("country_name_token", "list_concat(n3, n2)"), part("name_pair", pair("n3")), own("country_name_pair", pair("n3"))]
        out += [part("address_token", "a3"), own("country_address_token", "list_concat(a3, a2)"), part("address_pair", pair("a3")), own("country_address_pair", pair("a3"))]
    return " UNION ".join(out)


def _tagged(x: str) -> str:
    grams = f"list_sort(list_transform(range(1, length(' ' || {x} || ' ')), lambda i: substr(' ' || {x} || ' ', i, 2)))"
    return f"CASE WHEN {x} = '' THEN {_NONE} ELSE list_transform({grams}, lambda g, i: g || (i + 1 - list_position({grams}, g))::VARCHAR) END"


def _safe(x: str) -> str:
    return f"CASE WHEN list_contains({_list(t.PAIR_PLACEHOLDERS)}, {x}) THEN '' ELSE {x} END"


def _ratio(a: str, b: str, empty: str = "0.0") -> str:
    return f"CASE WHEN {b} > 0 THEN ({a})::DOUBLE / ({b}) ELSE {empty}::DOUBLE END"


_both = lambda x: f"len(list_intersect({x}l, {x}r))"
_union = lambda x: f"len(list_distinct(list_concat({x}l, {x}r)))"


def _affix(x: str) -> list[str]:
    hi, lo = f"greatest(length({x}l), length({x}r))", f"least(length({x}l), length({x}r))"
    prefix = lambda a, b: f"len(list_filter(range(1, {lo} + 1), lambda i: left({a}, i) = left({b}, i)))"
    return [_ratio(prefix(f"{x}l", f"{x}r"), hi, "1.0"), _ratio(prefix(f"reverse({x}l)", f"reverse({x}r)"), hi, "1.0"), _ratio(f"{hi} - {lo}", hi), _ratio(lo, hi, "1.0")]


def _tokens(x: str) -> list[str]:
    within = f"({_both(x)} = len({x}l) OR {_both(x)} = len({x}r))"
    return [_ratio(_both(x), _union(x)), _ratio(_both(x), f"least(len({x}l), len({x}r))"), f"(len({x}l) > 0 AND {within})::INT::DOUBLE"]


_flag = lambda x: f"({x})::INT::DOUBLE"
_has = lambda m: _flag(f"list_contains(string_split(blocking_method, ','), '{m}')")
FEATURES = [
    _flag("nl <> '' AND nl = nr"), _ratio(f"2 * {_both('ng')}", "len(ngl) + len(ngr)"), *_tokens("nt"), _ratio(_both("ni"), "least(len(nil), len(nir))"), *_affix("n"), _flag("nl = ''"), _flag("nr = ''"),
    _flag("al <> '' AND al = ar"), _ratio(f"2 * {_both('ag')}", "len(agl) + len(agr)"), *_tokens("aw"), _ratio(_both("ad"), _union("ad")), _flag(f"{_both('ax')} > 0"), *_affix("a"), _flag("al = ''"), _flag("ar = ''"),
    _flag("cl <> '' AND cl = cr"), _flag("cl = ''"), _flag("cr = ''"), _has("country_exact_name"), _has("exact_name"), _has("country_exact_address"), _has("country_name_token"), _has("country_address_token"), "ln(1 + candidate_count)",
]


def _candidates(keys: str) -> str:
    return f"""SELECT src, s1, cand, array_to_string(list_sort(list_distinct(list(method))), ',') AS blocking_method FROM (
      SELECT e.src, e.s1, k.entity_id AS cand, e.method FROM (
        SELECT *, row_number() OVER (PARTITION BY src, s1, method ORDER BY target_count, block_key) AS token_rank FROM (
          SELECT n.src, o.entity_id AS s1, o.method, o.block_key, n.target_count FROM {keys} o
          JOIN (SELECT src, method, block_key, count(*) AS target_count FROM {keys} WHERE src <> 1 GROUP BY ALL) n ON o.src = 1 AND n.method = o.method AND n.block_key = o.block_key)) e
      JOIN {keys} k ON k.src = e.src AND k.method = e.method AND k.block_key = e.block_key
      WHERE target_count <= 50 AND (e.method NOT IN ('country_name_token', 'country_address_token') OR token_rank <= 5)) GROUP BY src, s1, cand"""


candidates = _candidates


def _fbeta(tp: str, p: str, n: str) -> str:
    a, b = f"({tp}::DOUBLE / {p})", f"({tp}::DOUBLE / {n})"
    return f"CASE WHEN {p} = 0 AND {n} = 0 THEN 1.0::DOUBLE WHEN {p} = 0 OR {n} = 0 OR {tp} = 0 THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * {a} * {b} / (0.25::DOUBLE * {a} + {b}) END"


_SIDE = f"""SELECT src, entity_id, n, a, c, nt, aw, ng, ag, list_filter(nt, lambda w: NOT list_contains({_list(t.NAME_STOP)}, w)) AS ni,
  list_filter(aw, lambda w: regexp_matches(w, '\\p{{Nd}}')) AS ad, list_filter(aw, lambda w: regexp_matches(w, '\\p{{Nd}}') AND length(w) >= 4) AS ax
  FROM (SELECT *, list_distinct(regexp_extract_all(n, {_TOKEN})) AS nt, list_distinct(regexp_extract_all(a, {_TOKEN})) AS aw, {_tagged('n')} AS ng, {_tagged('a')} AS ag
        FROM (SELECT src, entity_id, {_safe('bname')} AS n, {_safe('baddr')} AS a, {_safe('ctry')} AS c FROM rec))"""
_COLS = ("n", "a", "c", "nt", "aw", "ng", "ag", "ni", "ad", "ax")

CTES = {
    "raw": "SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id, (1 + doc_id % 3)::INTEGER AS src, left(split_part(text, chr(10), 1), 60) AS business_name, left(split_part(text, chr(10), 2), 80) AS business_address, lang AS country, doc_id, text FROM documents",
    "rec": f"SELECT *, {_norm('business_name')} AS bname, {_norm('business_address')} AS baddr, {_norm('country')} AS ctry FROM raw",
    "blk": f"SELECT src, entity_id, {_block('bname')} AS bn, {_block('baddr')} AS ba, ctry AS c, {_useful('ctry')} AS hc FROM rec",
    "toks": f"""SELECT *, CASE WHEN {_useful('bn')} THEN {_VARIANTS} ELSE {_NONE} END AS v, CASE WHEN {_useful('ba', 8)} THEN [ba] ELSE {_NONE} END AS w,
      CASE WHEN {_useful('bn')} THEN {_informative('bn', t.NAME_STOP, 3)} ELSE {_NONE} END AS n3, CASE WHEN {_useful('bn')} THEN {_informative('bn', t.NAME_STOP, 2)} ELSE {_NONE} END AS n2,
      CASE WHEN {_useful('ba', 8)} THEN {_informative('ba', t.BLOCK_ADDRESS_STOP, 3, True)} ELSE {_NONE} END AS a3, CASE WHEN {_useful('ba', 8)} THEN {_informative('ba', t.BLOCK_ADDRESS_STOP, 2, True)} ELSE {_NONE} END AS a2 FROM blk""",
    "fast": _keys(True),
    "keys": _keys(False),
    "counts": "SELECT src, method, block_key, count(*) AS target_count FROM keys WHERE src <> 1 GROUP BY ALL",
    "ranked": "SELECT n.src, o.entity_id AS s1, o.method, o.block_key, n.target_count, row_number() OVER (PARTITION BY n.src, o.entity_id, o.method ORDER BY target_count, o.block_key)::INTEGER AS token_rank FROM keys o JOIN counts n ON o.src = 1 AND n.method = o.method AND n.block_key = o.block_key",
    "cand": _candidates("keys"),
    "cand_fast": _candidates("fast"),
    "truth": """SELECT b.src, a.entity_id AS s1, b.entity_id AS cand FROM raw a JOIN raw b ON a.src = 1 AND b.src <> 1 AND a.text = b.text UNION
      SELECT b.src, a.entity_id, b.entity_id FROM raw a JOIN raw b ON a.src = 1 AND b.src <> 1 AND length(a.business_address) >= 8 AND lower(a.business_address) = lower(b.business_address)""",
    "size0": "SELECT x.src, r.entity_id AS s1, count(k.cand) AS n FROM raw r CROSS JOIN (VALUES (2::INTEGER), (3::INTEGER)) x(src) LEFT JOIN cand k ON k.src = x.src AND k.s1 = r.entity_id WHERE r.src = 1 GROUP BY ALL",
    "side": _SIDE,
    "joined": "SELECT k.*, count(*) OVER (PARTITION BY k.src, k.s1) AS candidate_count, " + ", ".join(f"l.{c} AS {c}l, r.{c} AS {c}r" for c in _COLS) + " FROM cand k JOIN side l ON l.entity_id = k.s1 AND l.src = 1 JOIN side r ON r.entity_id = k.cand AND r.src = k.src",
    "feat": "SELECT src, s1, cand, blocking_method, candidate_count, " + ", ".join(f"{f} AS {n}" for f, n in zip(FEATURES, NAMES, strict=True)) + " FROM joined",
    "scored": "SELECT *, 1 / (1 + exp(-greatest(-30::DOUBLE, least(30::DOUBLE, " + " + ".join([f"({BIAS})::DOUBLE"] + [f"{n} * ({w})::DOUBLE" for n, w in zip(NAMES, FIXED)]) + ")))) AS score FROM feat",
    "lists": "SELECT r.entity_id AS source1_entity_id, coalesce(string_agg(x.cand, ',' ORDER BY x.cand), '') AS matched_entity_ids FROM raw r LEFT JOIN (SELECT DISTINCT s1, cand FROM truth) x ON x.s1 = r.entity_id WHERE r.src = 1 GROUP BY r.entity_id",
    "ents": "SELECT entity_id AS s1 FROM raw WHERE src = 1",
}


def sql(select: str) -> str:
    """select with the table expressions that it needs, in order."""
    import re

    need: set[str] = set()

    def add(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                need.add(name)
                add(CTES[name])

    add(select)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in need) + "\n" + select if need else select


def scores(pred: str) -> str:
    """Per entity, against the truth, of predicted (s1, cand)."""
    n = f"""SELECT e.s1, (SELECT count(DISTINCT cand) FROM truth t WHERE t.s1 = e.s1) AS n_truth, (SELECT count(DISTINCT cand) FROM ({pred}) p WHERE p.s1 = e.s1) AS n_predicted,
      (SELECT count(DISTINCT t.cand) FROM truth t JOIN ({pred}) p ON p.s1 = t.s1 AND p.cand = t.cand WHERE t.s1 = e.s1) AS n_correct FROM ents e"""
    return f"SELECT *, {_fbeta('n_correct', 'n_predicted', 'n_truth')} AS fbeta FROM ({n})"


def summary(pred: str) -> str:
    return f"""SELECT count(*) AS entities, round(coalesce(avg(fbeta), 0), 6) AS macro_fbeta, sum(n_predicted)::BIGINT AS n_predicted, sum(n_truth)::BIGINT AS n_truth, sum(n_correct)::BIGINT AS n_correct,
      round(avg((n_predicted > 0)::INT), 6) AS nonempty_rate, round(CASE WHEN sum(n_predicted) > 0 THEN sum(n_correct) / sum(n_predicted) ELSE 0 END, 6) AS micro_precision,
      round(CASE WHEN sum(n_truth) > 0 THEN sum(n_correct) / sum(n_truth) ELSE 0 END, 6) AS micro_recall FROM ({scores(pred)})"""


def grid(thresholds: list[float]) -> str:
    ts = ", ".join(f"({i}::INTEGER, ({x!r})::DOUBLE)" for i, x in enumerate(thresholds))
    cube = f"""SELECT c.src, c.s1, g.i, count(*) AS p, count(t.cand) AS c FROM scored c JOIN (VALUES {ts}) g(i, t) ON c.score >= g.t
      LEFT JOIN truth t ON t.src = c.src AND t.s1 = c.s1 AND t.cand = c.cand GROUP BY ALL"""
    return f"""WITH cube AS ({cube}), g(i, t) AS (VALUES {ts}), nt AS (SELECT e.s1, count(t.cand) AS n_truth FROM ents e LEFT JOIN truth t ON t.s1 = e.s1 GROUP BY e.s1),
      x AS (SELECT a.t AS t2, b.t AS t3, nt.n_truth, coalesce(c2.p, 0) + coalesce(c3.p, 0) AS n_predicted, coalesce(c2.c, 0) + coalesce(c3.c, 0) AS n_correct
            FROM nt CROSS JOIN g a CROSS JOIN g b LEFT JOIN cube c2 ON c2.src = 2 AND c2.s1 = nt.s1 AND c2.i = a.i LEFT JOIN cube c3 ON c3.src = 3 AND c3.s1 = nt.s1 AND c3.i = b.i)
      SELECT t2, t3, round(avg({_fbeta('n_correct', 'n_predicted', 'n_truth')}), 6) AS macro_fbeta, sum(n_predicted)::BIGINT AS n_predicted, sum(n_correct)::BIGINT AS n_correct, sum(n_truth)::BIGINT AS n_truth FROM x GROUP BY t2, t3"""
