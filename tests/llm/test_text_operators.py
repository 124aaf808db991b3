import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordloom.llm import common, html_extraction, jaccard_join, language_id, lm_scoring, mixing, quality, secret_scan
from recordloom.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], DOCS)


def _tokens(t):
    return (t or "").encode().lower().split()


@pytest.mark.parametrize("local, cut", [(8, 5000), (2, 4)])
def test_jaccard_join_against_brute_force(spark, monkeypatch, local, cut):
    monkeypatch.setattr(jaccard_join, "PAIRS", 10)
    monkeypatch.setattr(jaccard_join, "MEET", 7)
    monkeypatch.setattr(jaccard_join, "LOCAL", local)
    monkeypatch.setattr(jaccard_join, "CUT", cut)
    met = []
    exhaustive = jaccard_join._exhaustive
    monkeypatch.setattr(jaccard_join, "_exhaustive", lambda *a: met.append(1) or exhaustive(*a))
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(60)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a b"), (4, "A  b"), (5, "a b c")]
    passage = [f"p{k}" for k in range(30)]
    for i in range(6, 90):
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w[: rng.choice([7, 9, 12, 20, 40, 60])])))
    rows += [(100 + i, " ".join([f"u{rng.randrange(10**6)}" for _ in range(40)] + passage)) for i in range(20)]
    rows += [(200, rows[-1][1]), (201, rows[-1][1].upper()), (201, rows[-1][1])]
    sets = {}
    for i, t in rows:
        w = _tokens(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) > 0:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = [tuple(r)[:3] for r in jaccard_join.join(_docs(spark, rows).repartition(3), common.shared_dir(spark)).collect()]
    assert sorted(got) == sorted((i, len(sets[i]), find(i)) for i, _ in rows)
    assert met
    assert jaccard_join.join(_docs(spark, []), common.shared_dir(spark)).collect() == []


def test_sketches_never_part_similar_sets():
    rng = np.random.default_rng(6)
    word = lambda x: np.frombuffer(jaccard_join.sketch(x), np.uint64)
    for n in (1, 4, 7, 60, 900, 9000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for lost in {0, n // 8, n // 7, n // 4, n // 2}:
            b = np.unique(np.append(a[: n - lost], rng.integers(0, 2**63, lost // 3).astype(np.uint64)))
            if len(b) and jaccard_join.similar(a, b):
                assert jaccard_join._may_link(np.array([len(a)]), np.array([len(b)]), word(a)[None], word(b)[None]).all()


@pytest.mark.parametrize("one", [10**6, 0])
def test_components(spark, monkeypatch, one):
    from recordloom.llm import components as module

    monkeypatch.setattr("recordloom.llm.components.ONE_TASK", one)
    links = [(i, i + 1) for i in range(40)] + [(100, 3), (200, 201), (201, 200), (7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "u long, v long").repartition(3), common.shared_dir(spark)).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200} and module


def test_lm_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK", 1500)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "cat", "Sat", "on", "é", f"r{rng.randrange(40)}"]) for _ in range(rng.randrange(0, 30)))) for i in range(60)] + [(60, None), (61, " \n"), (62, "the cat " * 200), (62, "the cat"), (None, "the cat sat")]
    df = _docs(spark, rows).withColumn("train", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))).coalesce(2)
    one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in rows:
        if i is None or i % 3:
            w = [*_tokens(t), 0]
            one.update(w)
            two.update(zip([1, *w], w))
            three.update(zip([1, *w], w, w[1:]))
    n, v = sum(one.values()), len(one)
    entered = lambda h: one[0] if h == 1 else one[h]
    p1 = lambda w: (one[w] + 1) / (n + v + 1)
    p2 = lambda b, w: (two[b, w] + 5 * p1(w)) / (entered(b) + 5)
    p3 = lambda a, b, w: (three[a, b, w] + 2 * p2(b, w)) / (two[a, b] + 2)
    for h in ((1, b"the"), (b"the", b"cat"), (b"x", b"y")):
        assert math.isclose(sum(p3(*h, w) for w in one) + p3(*h, "unknown"), 1)
    want = []
    for i, t in rows:
        w = [*_tokens(t), 0]
        score = math.log10(p2(1, w[0])) + sum(math.log10(p3(*x)) for x in zip([1, *w], w, w[1:]))
        want.append((-1 if i is None else i, len(w), sum(one[x] > 0 for x in w), n, i is not None and i % 3 == 0, sum(math.log10(p1(x)) for x in w), score))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"], r["base_score"], r["score"]) for r in lm_scoring.score(df, common.shared_dir(spark), mu=(5.0, 2.0)).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5]) and math.isclose(g[6], w[6]), (g, w)
    assert lm_scoring.score(df.limit(0), common.shared_dir(spark)).collect() == []
    assert all(math.isclose(r["score"], 0.0, abs_tol=1e-9) for r in lm_scoring.score(df.withColumn("train", F.lit(None).cast("boolean")).where("text is null"), common.shared_dir(spark)).collect())


def test_lm_automaton_walk_in_stretches(monkeypatch):
    """Whatever the stretches, the walk gives each token what a walk over the whole texts gives it."""
    rng = np.random.default_rng(5)
    begin = np.array([0, 1, 40, 41, 300])
    tokens = np.append(rng.integers(0, 6, 299), 0).astype(np.uint64)
    tokens[begin[1:] - 1] = lm_scoring._END
    ngrams = [(np.bincount(at[:170], minlength=len(d)), at) for _, d, at, *_ in lm_scoring._keys(tokens, begin, 4, 40)]
    auto = lm_scoring.Automaton(ngrams, begin, 100, 6, (5.0, 2.0))
    whole = auto.walk(begin)
    monkeypatch.setattr(lm_scoring, "STRETCH", 7)
    assert np.allclose(auto.walk(begin), whole)


def test_secrets_against_python(spark):
    rng = random.Random(31)
    alphabet = secret_scan.ALPHABET
    piece = lambda: rng.choice(["password=abc123 ", "token: x1 ", 'secret = "zzzzzz" ', "AKIA" + "A" * 16, " AKIA" + "B" * 15, "é", "a1" * 12 + " ", " f", "token: token: abcdefgh ", "API_KEY='" + "9" * 6 + "' ", "".join(rng.choice(alphabet) for _ in range(rng.randrange(15, 60))) + rng.choice([" ", "", "\n", "."]), "ordinary_words_and_identifiers ", "my_api_key="])
    texts = ["password=abc123 token: x1 secret = \"zzzzzz\"", None, "", "k " + hashlib.sha256(b"q").hexdigest().upper()[:40], "word " * 4000 + "passwd=0123456789", ("ab" * 15 + " Qx7" * 1 + "Zk9" * 9 + " ") * 1500, "password=abc123;" * 2500]
    texts += ["".join(piece() for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    rows = _docs(spark, enumerate(texts)).withColumns({"Spans": F.lit("own"), "_base": F.lit(1), "_text": F.lit(2)})
    weights = secret_scan.train(_docs(spark, [(1, "ordinary words stand here and there " * 20)]))
    scanned = secret_scan.scan(rows, weights)
    assert {r["Spans_input"] for r in scanned.collect()} == {"own"}
    patterns = [(re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6), (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    run, n = re.compile("[A-Za-z0-9+/_=-]+"), len(alphabet)
    ratio = lambda x: sum(weights[alphabet.index(a) * n + alphabet.index(b)] for a, b in zip(x, x[1:]))
    masked = {r["doc_id"]: r for r in secret_scan.redact(scanned).collect()}
    total = 0
    for r in secret_scan.digest(scanned).collect():
        t = texts[r["doc_id"]] or ""
        base = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(patterns) for m in p.finditer(t) if ok(m))
        model = [(m.start(), 3, m.end()) for m in run.finditer(t) if len(m[0]) >= 20 and ratio(m[0]) >= secret_scan.THRESHOLD and not any(a < m.end() and m.start() < b for a, _, b in base)]
        say = lambda spans: ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(say(base).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["n_markov"]) == (*(sum(k == i for _, k, _ in base) for i in range(3)), len(model))
        assert r["spans"] == say(sorted(base + model))
        total += len(model)
        if base:
            assert masked[r["doc_id"]]["n_chars"] == len(masked[r["doc_id"]]["text"]) and "[secret]" in masked[r["doc_id"]]["text"]
    assert total > 50 and masked[1]["text"] is None and masked[2]["text"] == ""
    assert "AKIA" not in masked[0]["text"] and (masked[0]["_base"], masked[0]["_text"]) == (1, 2)
    assert secret_scan.digest(secret_scan.scan(rows.limit(0), secret_scan.train(rows.limit(0)))).collect() == []


def test_mixing(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, None if i == 5 else "w " * rng.randrange(0, 40), s) for i, s in enumerate(["a"] * 60 + ["b"] * 5 + [None] * 10 + ["c"] * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, common.shared_dir(spark)).collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    total, aims = collections.Counter(), {}
    name = {i: s for i, _, s in rows}
    for r in got:
        total[name[r["doc_id"]]] += r["taken"]
        aims[name[r["doc_id"]]] = r["target"]
    assert all(abs(total[s] - t) <= 1 for s, t in aims.items())
    assert math.isclose(sum(aims.values()), 1.5 * sum(len((t or "").split()) for _, t, _ in rows))
    assert sorted(mixing.mix(df, common.shared_dir(spark)).collect()) == sorted(got)
    assert mixing.mix(df.limit(0), common.shared_dir(spark)).collect() == []
    # Repeated rows, null ids and own columns: each row is one, and the bins' number changes nothing.
    odd = df.unionByName(df.where("doc_id < 9")).unionByName(df.where("doc_id > 95").withColumn("doc_id", F.lit(None).cast("long"))).withColumns({"size": F.lit("x"), "bin": F.lit(1), "_source": F.lit(1), "target": F.lit(0), "key": F.lit(1)})
    out = mixing.mix(odd, common.shared_dir(spark)).collect()
    assert len(out) == odd.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    monkeypatch.setattr(mixing, "BIN_ROWS", 0.001)
    assert sorted(map(str, mixing.mix(odd, common.shared_dir(spark)).collect())) == sorted(map(str, out))


def test_language(spark):
    rng = random.Random(4)
    make = lambda s: " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(30))
    parts = {"en": ["the", "ing", "wh", "or"], "fr": ["eau", "é", "ou", "que"]}
    rows = [(i, make(parts[k]), k) for i, k in enumerate(["en", "fr"] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fitted = language_id.fit(df, F.col("doc_id") < 40)
    assert all(r["lang"] == r["lang_pred"] and 0 <= r["score"] <= 1 for r in language_id.predict(df, fitted).collect())
    odd = spark.createDataFrame([(1, None, None), (2, "", None), (3, "12 %$ 3", None), (4, "the ing " * 300_000, None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language_id.predict(odd, fitted).orderBy("doc_id").collect()] == ["und", "und", "und", "en"]
    assert language_id.predict(odd, language_id.fit(df.limit(0), F.lit(True))).where("lang_pred <> 'und'").count() == 0
    # A long text cut into pieces has the features of the whole.
    data = common.characters(np.frombuffer("the eau é 漢字 ing que ".encode() * 40, np.uint8), np.array([0, 40 * 29]))[0]
    whole = language_id._features(data, np.zeros(1, np.int64))
    cut = [language_id._piece(data, np.zeros(1, np.int64), a, min(a + 7, len(data))) for a in range(0, len(data), 7)]
    assert all((np.concatenate([c[n] for c in cut]) == whole[n]).all() for n in range(language_id.ORDERS))
    # A text's prediction is the same whatever texts share its batch, to the last bit.
    short = spark.createDataFrame([(i, t) for i, t in enumerate(["é", "w", "", "th", None, "eau", "12", "ou", "g", "que the"] * 20)], "doc_id long, text string")
    beside = {tuple(r) for r in language_id.predict(short.coalesce(1), fitted).select("text", "lang_pred", "score").collect()}
    alone = {tuple(r) for r in language_id.predict(short.repartition(200, "doc_id"), fitted).select("text", "lang_pred", "score").collect()}
    assert beside == alone and len(beside) == 10


def test_quality(spark):
    rng = random.Random(5)
    good = [" ".join(rng.choice(["the", "house", "stands", "there", "and", "waits"]) for _ in range(80)) for _ in range(120)]
    junk = ["".join(rng.choice("QXZ#@!%&*") for _ in range(300)) for _ in range(10)]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, 1.0) for i, t in enumerate([*good, *junk, None, ""])], "doc_id long, text string, lang string, quality double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(121, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(docs, labels, common.shared_dir(spark)).collect()}
    assert len(got) == 132
    assert sum(got[i]["keep"] for i in range(120)) >= 117 and not any(got[i]["keep"] for i in range(120, 132))
    assert got[130]["perplexity"] is None
    # Empty tables, nothing trusted, null labels and ids, repeated rows, own columns.
    empty = quality.classify(docs.limit(0), labels, common.shared_dir(spark))
    assert empty.collect() == []
    nothing = quality.classify(docs, labels.where("quality = 5"), common.shared_dir(spark)).collect()
    assert len(nothing) == 132 and not any(r["keep"] for r in nothing) and {r["threshold"] for r in nothing} == {None}
    odd = docs.where("doc_id in (1, 2, 130)").unionByName(docs.where("doc_id = 1")).unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long"))).withColumns({"perplexity": F.lit(7), "_id": F.lit(1), "_lang": F.lit("x"), "keep": F.lit(1)})
    same = quality.classify(odd, labels.unionByName(spark.createDataFrame([(2, None, None), (None, 1, 0)], labels.schema)), common.shared_dir(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in same) == ["1", "1", "130", "2", "None"]


def test_html(spark):
    model = html_extraction.train(html_extraction.labelled_pages())
    page = '<html><head><title>t</title><script>var a="</p>";</script></head><nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>Top &amp; more</h1><p>One <b>two</b>\n three.<p>Four &eacute;</article><div class="comments"><p>nice one</p></div><footer>&copy; us</footer>'
    assert html_extraction.extract(page, model) == "Top & more One two three. Four é"
    df = spark.createDataFrame([(1, page, "x"), (2, None, "x"), (3, "", "x"), (4, "<p", "x"), (5, "<div>" * 3000 + "deep", "x")], "page_id long, html string, url string")
    rows = html_extraction.main_text(df, model).orderBy("page_id").collect()
    assert [r["n_chars"] == len(r["text"]) for r in rows] == [True] * 5 and rows[1]["text"] == "" == rows[2]["text"]
    own = html_extraction.main_text(df.withColumns({"text": F.lit("mine"), "N_CHARS": F.lit(-1)}).unionByName(df.withColumns({"text": F.lit("mine"), "N_CHARS": F.lit(-1)})), model).collect()
    assert len(own) == 10 and {(r["text_input"], r["N_CHARS_input"]) for r in own} == {("mine", -1)}
    assert html_extraction.main_text(df.limit(0), model).collect() == []
    # Sum-product against the sum over all labellings of a small tree.
    import itertools

    nodes = html_extraction.parse("<div><p>a</p><nav>b</nav></div><p>c c c</p>")
    weight = [sum(model.weight.get(f, 0.0) for f in html_extraction._features(n)) for n in nodes]
    place = {id(n): i for i, n in enumerate(nodes)}
    total = [[0.0, 0.0] for _ in nodes]
    for y in itertools.product((0, 1), repeat=len(nodes)):
        z = (0 if y[0] else -2.0) + sum(weight[i] * y[i] + model.pair[y[place[id(nodes[i].parent)]]][y[i]] for i in range(1, len(nodes)))
        for i, k in enumerate(y):
            total[i][k] += math.exp(z)
    assert np.allclose(html_extraction.marginals(nodes, model), [b / (a + b) for a, b in total])


def _kneser_ney(texts, order):
    """(p, alphabet size) of an interpolated modified Kneser-Ney model by its definition. An n-gram: (does the text's start stand before it, characters)."""
    grams = {n: collections.Counter() for n in range(1, order + 1)}
    for t in texts:
        grams[order].update((s, g) for n, g, s in _all_ngrams(t, order) if n == order)
    end = lambda x, n: (False, x[1][-n:]) if len(x[1]) >= n else x
    for n in range(order - 1, 0, -1):
        grams[n].update(end(x, n) for x in grams[n + 1])
    context = lambda x: (x[0], x[1][:-1])
    alphabet = len(grams[1])

    def p(x, n):
        if n == 0:
            return 1 / (alphabet + 1)
        x = end(x, n)
        lower = p(x, n - 1)
        total, left, own = 0, 0.0, 0.0
        of = [max(1, sum(c == i for c in grams[n].values())) for i in range(1, 5)]
        y = of[0] / (of[0] + 2 * of[1])
        d = [min(0.95 * i, max(0.05 * i, i - (i + 1) * y * of[i] / of[i - 1])) for i in range(1, 4)]
        for g, c in grams[n].items():
            if n == 1 or context(g) == context(x):
                total, left = total + c, left + d[min(c, 3) - 1]
                own += (c - d[min(c, 3) - 1]) if g == x else 0
        return (own + left * lower) / total if total else lower

    return p, alphabet


def test_quality_against_brute_force(spark):
    rng = random.Random(11)
    good = ["".join(rng.choice(["ab", "c ", "é", "漢", "bca"]) for _ in range(rng.randrange(1, 30))) for _ in range(25)]
    model = quality.train(spark.createDataFrame([(t,) for t in good], "text string").repartition(3), common.shared_dir(spark))
    p, alphabet = _kneser_ney(good, quality.ORDER)
    assert math.isclose(model[-1], -math.log(alphabet + 1))
    texts = [*good[:6], "abcab é", "zz漢z", "b", "", None, "caca ab" * 9]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["perplexity"] for r in quality.perplexity(docs, model).collect()}
    for t in texts:
        if not t:
            assert got[t] is None
            continue
        logs = [math.log(p((s, g), quality.ORDER)) for n, g, s in _all_ngrams(t, quality.ORDER) if n == quality.ORDER]
        assert math.isclose(got[t], math.exp(-sum(logs) / len(t)), rel_tol=1e-4), t
    for h in ("ab", "é漢b", "zq"):
        known = sorted({c for t in good for c in t})
        assert math.isclose(sum(p((False, h[-3:] + c), quality.ORDER) for c in [*known, "?"]), 1, rel_tol=1e-9)


def test_quality_perplexity_does_not_depend_on_its_batch(spark, monkeypatch):
    rng = random.Random(12)
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(0, 90))) for _ in range(80)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = quality.train(df.limit(40), common.shared_dir(spark))
    alone = {tuple(r) for r in quality.perplexity(df.repartition(60, "text"), model).collect()}
    assert {tuple(r) for r in quality.perplexity(df.coalesce(1), model).collect()} == alone


def test_quality_tells_all_characters_apart(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzBCDFGHJKLMNPQRSUVWXYZ") for _ in range(6)) for _ in range(60)]
    good = [" ".join([*(rng.choice(words) for _ in range(80)), "20481632", "~^`{}<>"]) for _ in range(60)]
    model = quality.train(spark.createDataFrame([(t,) for t in good], "text string"), common.shared_dir(spark))
    junk = ["".join(rng.choice(alphabet) for _ in range(600)) for alphabet in ("0123456789", "~^`{}<>", "BCDFGHJKLMNPQRSUVWXYZ", "13579 ", "漢字仮名")]
    got = {r["text"]: r["perplexity"] for r in quality.perplexity(spark.createDataFrame([(t,) for t in [*good, *junk]], "text string"), model).collect()}
    assert min(got[t] for t in junk) > 2 * max(got[t] for t in good)


def test_quality_threshold_is_the_quantile(spark, monkeypatch):
    monkeypatch.setattr(quality, "CALIBRATE", 1)  # all are held out: then those that teach set thresholds
    rng = random.Random(12)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["one", "two", "three", "quite", "other", "words"]) for _ in range(40)), "en" if i % 2 else "fr") for i in range(200)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 160), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels, common.shared_dir(spark)).collect()
    for lang in ("en", "fr"):
        own = sorted(r["perplexity"] for r in got if r["lang"] == lang and r["doc_id"] < 160)
        assert {r["threshold"] for r in got if r["lang"] == lang} == {own[math.ceil(quality.QUANTILE * len(own)) - 1]}
    assert all(r["keep"] == (r["perplexity"] <= r["threshold"]) for r in got)


def test_jaccard_join_counts_all_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MEET", 7)
    rng = random.Random(13)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, None), (1, "a b"), (2, "A b"), (3, "alone here")]
    for i in range(10, 50):
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(120)] = f"x{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    rows += [(100, rows[-1][1]), (101, rows[-2][1].upper()), (None, rows[-1][1])]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := _tokens(t)) else set() for i, t in rows if i is not None}
    near = lambda a, b: 100 * len(a & b) >= 75 * len(a | b) > 0
    want = {i: sum(near(sets[i], sets[j]) for j in sets if j != i) for i in sets}
    assert max(want.values()) > 30
    df = _docs(spark, rows).repartition(3)
    got = jaccard_join.join(df, common.shared_dir(spark), count_links=True).collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == {**want, None: 0} and len(got) == len(rows)
    plain = jaccard_join.join(df, common.shared_dir(spark))
    assert plain.columns == ["doc_id", "n_shingles", "component_id"] and sorted(map(str, plain.collect())) == sorted(map(str, (r for r in spark.createDataFrame(got).drop("n_links").collect())))


def test_language_keeps_rare_ones(spark, monkeypatch):
    rng = random.Random(14)
    parts = {f"l{k:03}": [chr(0x4E00 + 40 * k + i) for i in range(8)] for k in range(140)}
    make = lambda s: "".join(rng.choice(s) for _ in range(30))
    rows = [(k * 1000 + i, make(v), lang) for k, (lang, v) in enumerate(parts.items()) for i in range(2 if k % 7 == 3 else 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = {r["doc_id"]: tuple(r) for r in language_id.predict(df, language_id.fit(df, F.lit(True))).collect()}
    assert len(one) == len(rows) and all(r[2] == r[3] for r in one.values())
    # Few of all documents teach, but some of each language; blocks say the same as one matrix.
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 10)
    monkeypatch.setattr(language_id, "LEAST_DOCS", 4)
    monkeypatch.setattr(language_id, "BLOCK_LANGS", 33)
    for r in language_id.predict(df, language_id.fit(df, F.lit(True))).collect():
        assert tuple(r)[:4] == one[r["doc_id"]][:4] and math.isclose(r["score"], one[r["doc_id"]][4], rel_tol=1e-9)


def test_html_drops_only_raw_text():
    model = html_extraction.train(html_extraction.labelled_pages())
    page = "<nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>Top</h1><p>First words of the text stand here.</p>{}<p>Second words stand there.</p></article><footer>&copy; us</footer>"
    whole = "Top First words of the text stand here. Second words stand there."
    for mark in ('<svg width="1"/>', "<math />", '<svg><path d="M0"/><circle r="1"/>', "<svg><g><path/></svg>", "<math><mi/>", "<button>", "<select>", '<object data="x">', "<canvas>", "<noscript>", "<iframe src=x>", "<template>", "<script>var a = '<p>no</p>'</script>", "<style>p {}</style>"):
        assert html_extraction.extract(page.format(mark), model) == whole, mark
    for mark in ("<p>As <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math> holds.</p>", "<noscript><p>As x = 2 holds.</p></noscript>"):
        assert html_extraction.extract(page.format(mark), model) == whole.replace("stand here.", "stand here. As x = 2 holds."), mark


def _mix(x):
    m = (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ x >> 27) * 0x94D049BB133111EB & m
    return x ^ x >> 31


def _ngram(chars, start):
    """A hash of characters, by the definition: the last one's code plus a multiple of the former ones'; a text's start is 7."""
    h = 7 if start else None
    for c in chars:
        own = _mix(int.from_bytes(c.encode(), "little") + 301)
        h = own if h is None else (own + 0x9E3779B97F4A7C15 * h) & (1 << 64) - 1
    return h


def _all_ngrams(text, orders):
    """(n, characters, whether the text's start stands before them), for each character and n, as far as the text reaches back."""
    for i in range(len(text)):
        for n in range(1, orders + 1):
            a = max(0, i + 1 - n)
            yield n, text[a : i + 1], n > i + 1


def test_language_against_brute_force(spark):
    rng = random.Random(21)
    parts = {"a": "the wh 12", "b": "éa uoù", "c": "漢字仮 名"}
    rows = [(i, "".join(rng.choice(parts[k] + "e ") for _ in range(rng.randrange(1, 60))), k) for i, k in enumerate("abcab" * 12)] + [(90, None, "a"), (91, "A\tZ", None), (92, "9", "b"), (92, "9 é", "b")]
    df = spark.createDataFrame([(*r, "own", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, Score double")
    folded = lambda t: "".join(" " if c in "\t\n\x0b\x0c\r" else "0" if c in "0123456789" else c.lower() if c.isascii() else c for c in t or "")
    feature = lambda n, g, s: _mix((_ngram(g, s) + n - 1) & (1 << 64) - 1) >> 64 - language_id.BITS
    counts, docs = {k: collections.Counter() for k in "abc"}, collections.Counter()
    for i, t, k in rows:
        if k and i % 4:
            docs[k] += 1
            counts[k].update(feature(*x) for x in _all_ngrams(folded(t), language_id.ORDERS))
    total = {k: sum(c.values()) + 0.5 * 2**language_id.BITS for k, c in counts.items()}
    got = language_id.predict(df, language_id.fit(df, F.col("doc_id") % 4 != 0)).collect()
    assert len(got) == len(rows) and all(r["lang_pred_input"] == "own" and r["Score_input"] == 0.5 for r in got)
    found = sorted((r["doc_id"], r["text"] or "", r["lang_pred"], r["score"]) for r in got)
    for (i, t, lang, score), (j, u, _) in zip(found, sorted((i, t or "", 0) for i, t, _ in rows), strict=True):
        assert (i, t) == (j, u)
        z = {k: sum(math.log((counts[k][feature(*x)] + 0.5) / total[k]) for x in _all_ngrams(folded(t), language_id.ORDERS)) / language_id.ORDERS + math.log(docs[k] / sum(docs.values())) for k in "abc"}
        best = max(z, key=z.get)
        if not any(c.isalpha() for c in t):
            assert (lang, score) == ("und", 0)
        else:
            assert lang == best and math.isclose(score, 1 / sum(math.exp(v - z[best]) for v in z.values()), rel_tol=1e-4)
    assert language_id.predict(df.limit(0), []).collect() == []


def test_html_held_out_accuracy():
    model = html_extraction.train(html_extraction.labelled_pages())
    right = [0, 0, 0]
    for page in html_extraction.labelled_pages(100, seed=4242):
        nodes = html_extraction.parse(page)
        nodes[0].label = 1
        for n in nodes[1:]:
            n.label = n.parent.label if n.label is None else n.label
        for n, p in zip(nodes, html_extraction.marginals(nodes, model)):
            own = sum(len(x) for x in n.parts if isinstance(x, str))
            right = [right[0] + own * (p >= 0.5 and n.label), right[1] + own * (p >= 0.5), right[2] + own * n.label]
    assert right[0] / right[1] > 0.97 and right[0] / right[2] > 0.94


def test_html_is_read_once():
    import time

    model = html_extraction.train(html_extraction.labelled_pages(20))
    for make in (lambda n: "<p>x</div></span></q>" * n, lambda n: "<a \"x <p 'y " * n + ">", lambda n: "<a \"\"<a ''" * n + '">"', lambda n: "<x" * n):
        took = []
        for n in (3000, 12_000):
            began = time.process_time()
            html_extraction.extract(make(n), model)
            took.append(time.process_time() - began)
        assert took[1] < 10 * took[0] + 0.3
    assert html_extraction.extract('<p>one <b title="a > b">two</b> three <i x=">four</i> <p>five', model) == "one two three four five"


@pytest.mark.parametrize("window", [1, 5, 1 << 17])
def test_characters_by_definition(monkeypatch, window):
    """A row's characters begin at its first byte and at each byte that isn't a continuation; three of the bytes after a lead count."""
    monkeypatch.setattr(common, "_WINDOW", window)
    rng = np.random.default_rng(2)
    for _ in range(60):
        rows = [rng.choice(np.array([65, 0x80, 0xBF, 0xC3, 0xE2, 0xF0, 32], np.uint8), int(n)) for n in rng.integers(0, 12, int(rng.integers(0, 6)))]
        want, firsts = [], [0]
        for row in rows:
            own = []
            for k, b in enumerate(row.tolist()):
                if k and b & 0xC0 == 0x80:
                    own[-1].append(b)
                else:
                    own.append([b])
            want += [sum(b << 8 * i for i, b in enumerate(c[:4])) for c in own]
            firsts.append(len(want))
        codes, first = common.characters(np.concatenate([np.zeros(0, np.uint8), *rows]), np.cumsum([0, *map(len, rows)]))
        assert codes.tolist() == want and first.tolist() == firsts


def test_batches_are_bounded_and_settings_stand_again(spark):
    """A batch ends once it has the bytes, a text larger than that stands in it whole, and the session's limits come back."""
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    long, most = 100_000, common.BATCH_BYTES
    with common.batch_rows(spark, 1000):
        texts = spark.range(0, 120, 1, 1).select(F.expr(f"repeat('x', if(id = 7, {2 * most}, {long}))").alias("text"))
        got = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 120 and len(got) > 2
    assert all(r["size"] < most + 2 * long or r["size"] > 2 * most and r["n"] <= 8 for r in got)
    assert [spark.conf.get(k) for k in keys] == before
