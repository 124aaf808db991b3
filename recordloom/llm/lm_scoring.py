"""Language model scores: smoothed word n-grams as a weighted backoff automaton, walked once from left to right over each text.

States: the root, one for each word and one for each pair of words that training texts go on after (a text's start counts as a word
before it). A state h has an arc for each word w seen after it, weighing log10 p(w | h) and leading to the longest known context that
then ends the text so far, and a failure arc to the context without its first word, weighing the log10 of what h leaves to it:

    p(w | h) = (c(hw) + M * p(w | shorter h)) / (c(h) + M),  failure: M / (c(h) + M),  root: p(w) = (c(w) + 1) / (N + V + 1)

with M by h's length; the root has an arc for each word and one for any unknown word. Each state's probabilities sum to 1.

The model grows with the corpus and is never in one place. Texts are packed into blocks; each block asks the shards of the count
table for its distinct n-grams, giving its own counts with the question, and gets back the totals: the part of the automaton that its
walk can meet.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Words of the longest n-gram; strength of the shorter context's part in contexts of one and of two words.
ORDER, MU = 3, (100.0, 20.0)
#: Bytes of text in a block; bytes of text for each shard of the count table.
BLOCK, SHARD = 6_000_000, 12_000_000
#: Tokens of a stretch of text: all stretches of a block are walked side by side. After ORDER - 1 tokens of lead the state is the text's.
STRETCH = 512
_END, _START = (np.uint64(x) for x in common.mix(np.array([101, 102], np.uint64)))
_ONE, _TWO = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A3564E27F8862F | 1)
_ZSTD = pa.Codec("zstd", compression_level=7)


def _pack(batches):
    """Texts of one task, in blocks."""
    base, k = TaskContext.get().partitionId() << 32, 0
    ids, train, texts, held = [], [], [], 0

    def out():
        raw = b"".join(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([base + k], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([_ZSTD.compress(raw, asbytes=True)], pa.binary()), pa.array([len(raw)], pa.int64())],
            ["block", "ids", "train", "sizes", "data", "bytes"],
        )

    for batch in batches:
        data, off = common.text_bytes(batch.column("text"))
        raw = data.tobytes()
        for i, (doc, on) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("train").to_pylist())):
            ids.append(doc)
            train.append(on)
            texts.append(raw[off[i] : off[i + 1]])
            held += len(texts[-1]) + 16
            if held >= BLOCK:
                yield out()
                ids, train, texts, held, k = [], [], [], 0, k + 1
    if ids:
        yield out()


_PACKED = "block long, ids array<long>, train array<boolean>, sizes array<long>, data binary, bytes long"


def _tokens(sizes: np.ndarray, data: bytes, total: int) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a block, and each text's first (one entry more than texts)."""
    raw = pa.decompress(data, total, "zstd", asbytes=True) if total else b""
    off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(raw)])
    hashes, first = common.words(column)
    ends = first[1:] + np.arange(len(sizes))
    tokens = np.empty(len(hashes) + len(sizes), np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[ends] = True
    tokens[~is_end], tokens[is_end] = hashes, _END
    return tokens, np.concatenate([[0], ends + 1])


def bits_for(total: int) -> int:
    """Bits of the keys of pairs and longer n-grams: so many that one of the corpus' n-grams (a token takes two bytes or more) has
    the key of another one with a probability of about 2**-20."""
    return int(min(64, max(40, int(max(1, total // 2)).bit_length() + 20)))


def _ngrams(tokens: np.ndarray, begin: np.ndarray, bits: int):
    """For n of 1 to ORDER the key of the n-gram that ends at each token; a text's start stands before it once, and n-grams that would
    begin before that have the key of the next shorter one (a distinct one, which no count of the other meets)."""
    key = tokens
    yield key
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begin[:-1]] = _START
    for n in range(2, ORDER + 1):
        # The key of the n-gram: that of the (n - 1)-gram before the token, and the token.
        head = before if n == 2 else np.roll(key, 1)
        if n > 2:
            for back in range(n - 2):
                at = begin[:-1] + back
                head[at[at < begin[1:]]] = _START + np.uint64(back + 1)
        key = common.mix(head * _ONE + tokens * _TWO + np.uint64(n))
        yield key >> np.uint64(64 - bits)


def _keys(tokens: np.ndarray, begin: np.ndarray, shards: int, bits: int):
    """For each n the distinct keys in order, where each token's is among them, and by shard (a range of keys) where its keys begin and end."""
    for n, key in enumerate(_ngrams(tokens, begin, bits), 1):
        distinct, at = np.unique(key, return_inverse=True)
        high = distinct >> np.uint64((64 if n == 1 else bits) - 32)
        shard = ((high * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        yield n, distinct, at.ravel(), shard[cuts], cuts, np.append(cuts[1:], len(distinct))


def _thin(keys: np.ndarray) -> bytes:
    """Ascending keys in little space: differences, their bytes of equal weight together."""
    return pa.compress(np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _thick(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _ask(shards: int, bits: int):
    def task(batches):
        for batch in batches:
            for r in batch.to_pylist():
                tokens, begin = _tokens(np.array(r["sizes"], np.int64), r["data"], r["bytes"])
                taught = np.repeat(np.array(r["train"], bool), np.diff(begin))
                for n, distinct, at, shard, a, b in _keys(tokens, begin, shards, bits):
                    count = np.bincount(at[taught], minlength=len(distinct)).astype(np.uint32)
                    rows = len(shard)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["block"]] * rows, pa.int64()), pa.array([n] * rows, pa.int32()), pa.array(shard, pa.int64()), pa.array(b - a, pa.int64()), pa.array([_thin(distinct[x:y]) for x, y in zip(a, b)], pa.binary()), pa.array([pa.compress(count[x:y].tobytes(), "zstd", asbytes=True) for x, y in zip(a, b)], pa.binary())],
                        ["block", "kind", "shard", "n", "keys", "counts"],
                    )

    return task


def _answer(df: pd.DataFrame) -> pd.DataFrame:
    """One shard of the counts: sums over all blocks, given back to each block in the order that it asked in."""
    size = df["n"].to_numpy(np.int64)
    distinct, at = np.unique(np.concatenate([_thick(x, n) for x, n in zip(df["keys"], size)]), return_inverse=True)
    at = at.ravel()
    counts = np.concatenate([np.frombuffer(pa.decompress(x, 4 * n, "zstd", asbytes=True), np.uint32) for x, n in zip(df["counts"], size)])
    total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum(size)
    out = pd.DataFrame({"block": df["block"], "kind": df["kind"], "shard": df["shard"], "n": size, "totals": [pa.compress(total[at[b - k : b]].tobytes(), "zstd", asbytes=True) for b, k in zip(ends, size)], "known": 0, "sum": 0})
    out.loc[0, ["known", "sum"]] = int((total > 0).sum()), int(total.sum())
    return out


class Automaton:
    """States 0 (the root), then words (the last of them a text's start), then pairs of words, of a block. An arc's place is that of its
    n-gram among those of its length: of the arcs of each length the state that it leaves, where it leads, and its weight; -1 leaves no state."""

    def __init__(self, ngrams: list[tuple[np.ndarray, np.ndarray]], begin: np.ndarray, n: int, v: int, mu):
        """ngrams: for each length the totals of the block's distinct n-grams, and which of them ends at each token."""
        (word, w), (pair, p), (triple, t) = ngrams
        words, first = len(word), begin[:-1]
        root = (word + 1) / (n + v + 1)
        # A text's start was entered as often as ends were read in training.
        entered = np.append(word, word[w[begin[1] - 1]] if len(first) else 0).astype(float)
        before = np.concatenate([w[:1], w[:-1]])
        before[first] = words
        two, three = self._one(pair, p), self._one(triple, t)
        back, now = before[two], w[two]
        head, tail = p[three - 1], p[three]
        arc2 = (pair + mu[0] * root[now]) / (entered[back] + mu[0])
        arc3 = (triple + mu[1] * arc2[tail]) / (pair[head] + mu[1])
        inner = triple > 0
        inner[t[first]] = False  # at a text's first token there is no context of two words
        word_state = np.where(entered > 0, np.arange(1, words + 2), 0)
        pair_state = np.where(pair > 0, words + 2 + np.arange(len(pair)), 0)
        self.at = (t, p, w)
        self.source = (np.where(inner, pair_state[head], -1), np.where(pair > 0, word_state[back], -1), np.zeros(words, np.int64))
        self.to = (pair_state[tail], pair_state, word_state[:words])
        self.weight = (np.log10(arc3), np.log10(arc2), np.log10(root))
        self.least = (words + 2, 1, 0)
        self.fail = np.concatenate([np.zeros(words + 2, np.int64), word_state[now]])
        self.left = np.concatenate([[0.0], np.log10(mu[0] / (entered + mu[0])), np.log10(mu[1] / (pair + mu[1]))])
        self.start = int(word_state[words])

    @staticmethod
    def _one(totals: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each n-gram a token that it ends at."""
        out = np.zeros(len(totals), np.int64)
        out[at] = np.arange(len(at))
        return out

    def step(self, state: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each state, reading the token at its place: the next state, and the weights of the failure arcs and of the arc taken."""
        score, to, open_ = np.zeros(len(state)), np.zeros(len(state), np.int64), np.ones(len(state), bool)
        for at, source, target, weight, least in zip(self.at, self.source, self.to, self.weight, self.least):
            arc = at[place]
            hit = open_ & (source[arc] == state)
            score += np.where(hit, weight[arc], 0.0)
            to = np.where(hit, target[arc], to)
            open_ &= ~hit
            fails = open_ & (state >= least)
            score += np.where(fails, self.left[state], 0.0)
            state = np.where(fails, self.fail[state], state)
        return to, score

    def walk(self, begin: np.ndarray) -> np.ndarray:
        """The weight that the traversal gains at each token. Long texts go in stretches: after ORDER - 1 tokens the state depends on those only."""
        out = np.zeros(begin[-1])
        count = -(-np.diff(begin) // STRETCH)
        text = np.repeat(np.arange(len(count)), count)
        k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        lo = begin[text] + k * STRETCH
        hi = np.minimum(lo + STRETCH, begin[text + 1])
        lead = np.where(k > 0, np.minimum(ORDER - 1, lo - begin[text]), 0)
        at = lo - lead
        state = np.where(at == begin[text], self.start, 0).astype(np.int64)
        order = np.argsort(at - hi, kind="stable")  # the longest first
        at, lo, hi, state = at[order], lo[order], hi[order], state[order]
        size = hi - at
        for i in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-size, -i, "left"))  # those that have more than i tokens
            place = at[:n] + i
            state[:n], gained = self.step(state[:n], place)
            on = place >= lo[:n]
            out[place[on]] = gained[on]
        return out


def _walk(n: int, v: int, shards: int, bits: int, mu):
    def task(batches):
        for batch in batches:
            for r in batch.to_pylist():
                tokens, begin = _tokens(np.array(r["sizes"], np.int64), r["data"], r["bytes"])
                answer = {(x["kind"], x["shard"]): np.frombuffer(pa.decompress(x["totals"], x["n"] * 8, "zstd", asbytes=True), np.int64) for x in r["answers"]}
                ngrams = [(np.concatenate([answer[kind, s] for s in shard.tolist()]), at) for kind, _, at, shard, *_ in _keys(tokens, begin, shards, bits)]
                word, at = ngrams[0]
                score = Automaton(ngrams, begin, n, v, mu).walk(begin)
                base = np.log10((word + 1) / (n + v + 1))[at]
                sums = lambda x: np.add.reduceat(x, begin[:-1])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], pa.int64()), pa.array([not x for x in r["train"]], pa.bool_()), pa.array(np.diff(begin), pa.int64()), pa.array(sums((word > 0).astype(np.int64)[at]), pa.int64()), pa.array(np.full(len(begin) - 1, n), pa.int64()), pa.array(sums(base)), pa.array(sums(score))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return task


def score(docs: DataFrame, work: str, mu=MU) -> DataFrame:
    """docs: (doc_id, text, train). One row for each row: token counts, the base score and the automaton's score (log10).

    Tokens: words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, then one end. A null, empty or wordless text is its end alone. Rows
    that repeat count and are scored each, null ids too; a null `train` teaches nothing. With nothing to learn from, every token is unknown
    and each score is that of the root. Other columns are left out; an empty table gives none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("train", F.lit(False)).alias("train"))
    blocks = common.table(docs.mapInArrow(_pack, _PACKED), f"{work}/blocks")
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    shards, bits = max(12, total // SHARD + 1), bits_for(total)
    asked = blocks.mapInArrow(_ask(shards, bits), "block long, kind int, shard long, n long, keys binary, counts binary")
    answers = common.table(asked.groupBy("kind", "shard").applyInPandas(_answer, "block long, kind int, shard long, n long, totals binary, known long, sum long"), f"{work}/answers", 4)
    stats = answers.where("kind = 1").agg(F.sum("known").alias("v"), F.sum("sum").alias("n")).first()
    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("kind", "shard", "n", "totals")).alias("answers"))
    out = blocks.join(gathered, "block").mapInArrow(_walk(stats["n"] or 0, stats["v"] or 0, shards, bits, mu), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return common.result(out, work, 1)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = common.shared_dir(spark)
    docs = common.source(spark, sf_dir, "documents")
    held = F.coalesce(common.crc_mod("doc_id", 7) == 2, F.lit(False))
    return score(docs.select("doc_id", "text", (~held).alias("train")), work)
