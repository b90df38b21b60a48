"""Language ID (7): a linear-chain conditional random field over words.

Every word gets emission scores from hashed features (word identity as lexicon,
byte 2- and 3-grams of the bracketed word, prefix and suffix of four bytes);
learned transitions tie neighbouring words, so that code-switched text keeps
whole runs of one language. Forward-backward gives each word's marginal over
the languages, exactly and for any length: the chain is cut into blocks whose
transfer matrices are multiplied up first, then every block runs between its
entry and exit messages.

Training is numpy on the driver over a bounded sample: at most about
``per_lang`` labelled rows per language, each at most ``max_train_chars`` long
(both documented parameters; only training is sampled). Sequences are spliced from runs
of several languages, which is where the transitions learn to switch.

Results: the language with the largest mean marginal over words with letters.
A null text, an empty one or one without any letter is ``und`` with score 0.
With no labelled rows every text is ``und``. Repeated rows score alike; null
ids count as the text "" in the hold-out rule. Extra columns are passed through
unless they have a result's name, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, mix, slices, table, text_buffer, word_hashes, words_of
from .common import _LOWER

BUCKETS = 1 << 17
BLOCK = 128          # words of a chain handled between two messages
SEQUENCE = 64        # words of a training sequence
UNDETERMINED = "und"


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray      # (BUCKETS, languages)
    moves: np.ndarray        # (languages, languages), log scale


# ---- features ------------------------------------------------------------------

def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes that are ASCII letters or belong to a multi-byte character."""
    return ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128) | (data >= 0xC3)


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
    """Feature buckets of each word, one after the other, and where each word's begin."""
    n = ends - starts
    width = n + 2                                   # bracketed by two marks
    first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(width, out=first[1:])
    owner = np.repeat(np.arange(len(n)), width)
    at = np.arange(first[-1]) - first[owner]        # place in the bracketed word
    inner = (at > 0) & (at <= n[owner])
    chars = np.ones(first[-1] + 4, np.uint64)
    chars[np.flatnonzero(inner)] = data[(starts[owner] + at - 1)[inner]]
    left = width[owner] - at                        # bytes of the word from here on
    two = chars[:-4] | chars[1:-3] << np.uint64(8)
    three = two | chars[2:-2] << np.uint64(16)
    four = three | chars[3:-1] << np.uint64(24)
    seed = lambda x, k: mix(x + np.uint64(k << 40))
    found = [(owner[left >= 2], seed(two[left >= 2], 2)), (owner[left >= 3], seed(three[left >= 3], 3))]
    edge = (left >= 4) & ((at == 0) | (left == 4))   # prefix and suffix, their mark included
    found += [(owner[edge], seed(four[edge], 4)), (np.arange(len(n)), hashes)]
    owners = np.concatenate([a for a, _ in found])
    order = np.argsort(owners, kind="stable")
    buckets = (np.concatenate([b for _, b in found])[order] % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.searchsorted(owners[order], np.arange(len(n)))


def emissions(model: Crf, data, starts, ends, hashes) -> np.ndarray:
    """Scores (words, languages); features are looked up once per distinct word."""
    _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
    buckets, first = word_features(data, starts[at], ends[at], hashes[at])
    return np.add.reduceat(model.weights[buckets], first, axis=0)[back]


# ---- inference -----------------------------------------------------------------

def marginals(score: np.ndarray, moves: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Forward-backward marginals (words, languages) of chains of ``per_doc`` words."""
    total, k = score.shape
    if total == 0:
        return score
    e = np.exp(score - score.max(axis=1, keepdims=True))
    a = np.exp(moves)
    docs = np.flatnonzero(per_doc)
    begin = np.concatenate([[0], np.cumsum(per_doc)[:-1]])[docs]
    blocks = -(-per_doc[docs] // BLOCK)
    of = np.repeat(np.arange(len(docs)), blocks)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = begin[of] + nth * BLOCK
    size = np.minimum(BLOCK, per_doc[docs][of] - nth * BLOCK)
    rows = np.arange(len(of))
    order = np.argsort(-size, kind="stable")         # active blocks are a prefix
    live = [int(x) for x in np.searchsorted(-size[order], -np.arange(BLOCK), "left")]

    # the transfer matrix of each block
    through = np.tile(np.eye(k), (len(of), 1, 1))
    head = nth == 0
    for t in range(BLOCK):
        r = order[: live[t]]
        if not len(r):
            break
        m = through[r]
        moved = m @ a
        if t == 0:
            moved[head[r]] = m[head[r]]
        moved *= e[at[r] + t][:, None, :]
        through[r] = moved / moved.max(axis=(1, 2), keepdims=True)
    # messages into each block from the left and from the right
    into, out = np.full((len(of), k), 1.0 / k), np.ones((len(of), k))
    first = np.cumsum(blocks) - blocks
    for j in range(1, int(blocks.max())):
        b = first[blocks > j] + j
        v = np.einsum("bi,bij->bj", into[b - 1], through[b - 1])
        into[b] = v / v.sum(axis=1, keepdims=True)
    for j in range(int(blocks.max()) - 2, -1, -1):
        b = first[blocks > j + 1] + j
        v = np.einsum("bij,bj->bi", through[b + 1], out[b + 1])
        out[b] = v / v.sum(axis=1, keepdims=True)
    # inside the blocks
    fwd = np.empty_like(e)
    state = into.copy()
    for t in range(BLOCK):
        r = order[: live[t]]
        if not len(r):
            break
        v = state[r] @ a
        if t == 0:
            v[head[r]] = 1.0 / k
        v *= e[at[r] + t]
        v /= v.sum(axis=1, keepdims=True)
        state[r] = v
        fwd[at[r] + t] = v
    state = out
    for t in range(BLOCK - 1, -1, -1):
        r = order[: live[t]]
        if not len(r):
            continue
        here = state[r]
        fwd[at[r] + t] *= here
        v = (here * e[at[r] + t]) @ a.T
        state[r] = v / v.sum(axis=1, keepdims=True)
    del rows
    return fwd / fwd.sum(axis=1, keepdims=True)


# ---- training ------------------------------------------------------------------

def sample_hashes(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """The hash of each word of a sample, slice by slice: hashing takes some 50 times the bytes it is given, on the driver."""
    first = np.concatenate([[0], np.cumsum(per_doc)])
    parts = [word_hashes(data[offsets[i]: offsets[j]], starts[first[i]: first[j]] - offsets[i], ends[first[i]: first[j]] - offsets[i])
             for i, j in slices(offsets)]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def train(texts: list[str], labels: list[str], epochs: int = 3, rate: float = 0.3, seed: int = 7) -> Crf:
    """Stochastic gradient (AdaGrad) on the conditional log-likelihood of spliced sequences."""
    langs = sorted(set(labels))
    k, rng = len(langs), np.random.default_rng(seed)
    model = Crf(langs, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)))
    if k == 0:
        return model
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    data = _LOWER[data]
    starts, ends, per_doc = words_of(data, offsets)
    hashes = sample_hashes(data, offsets, starts, ends, per_doc)
    if len(hashes) == 0:
        return model
    gold = np.repeat(np.array([langs.index(x) for x in labels]), per_doc)
    # runs of 4 to SEQUENCE words in random order, spliced into sequences of SEQUENCE words
    cuts = [np.arange(0, 0)]
    begin = np.cumsum(per_doc) - per_doc
    for b, n in zip(begin.tolist(), per_doc.tolist(), strict=True):
        while n > 0:
            run = min(n, int(rng.integers(4, SEQUENCE + 1)))
            cuts.append(np.arange(b, b + run))
            b, n = b + run, n - run
    words = np.concatenate([cuts[i] for i in rng.permutation(len(cuts))])
    words = np.resize(words, -(-len(words) // SEQUENCE) * SEQUENCE).reshape(-1, SEQUENCE)
    hist_w, hist_m = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(words)), max(1, len(words) // 256)):
            w = words[batch].ravel()
            distinct, at, back = np.unique(hashes[w], return_index=True, return_inverse=True)
            buckets, first = word_features(data, starts[w[at]], ends[w[at]], distinct)
            score = np.add.reduceat(model.weights[buckets], first, axis=0)[back].astype(float)
            a, n = np.exp(model.moves), len(batch)
            e = np.exp(score - score.max(axis=1, keepdims=True)).reshape(n, SEQUENCE, k)
            f, b = np.empty_like(e), np.ones_like(e)
            for t in range(SEQUENCE):
                v = (f[:, t - 1] @ a if t else 1.0) * e[:, t]
                f[:, t] = v / v.sum(axis=1, keepdims=True)
            for t in range(SEQUENCE - 2, -1, -1):
                v = (b[:, t + 1] * e[:, t + 1]) @ a.T
                b[:, t] = v / v.sum(axis=1, keepdims=True)
            p = f * b
            p /= p.sum(axis=2, keepdims=True)
            y = gold[w].reshape(n, SEQUENCE)
            pair = f[:, :-1, :, None] * a * (b * e)[:, 1:, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            step = (seen - pair.sum(axis=(0, 1))) / n - 1e-3 * model.moves
            hist_m += step ** 2
            model.moves += rate * step / np.sqrt(hist_m)
            miss = -p.reshape(-1, k)
            miss[np.arange(len(w)), y.ravel()] += 1
            per_word = np.stack([np.bincount(back, miss[:, j], len(distinct)) for j in range(k)], 1) / n
            spread = np.repeat(per_word, np.diff(np.append(first, len(buckets))), axis=0)
            touched, into = np.unique(buckets, return_inverse=True)
            grad = np.stack([np.bincount(into, spread[:, j], len(touched)) for j in range(k)], 1)
            hist_w[touched] += grad ** 2
            model.weights[touched] += (rate * grad / np.sqrt(hist_w[touched])).astype(np.float32)
    return model


def fit(rows: DataFrame, per_lang: int = 400, max_train_chars: int = 20_000) -> Crf:
    """Learns from ``rows`` (text, lang): per language about ``per_lang`` rows, chosen by hash."""
    usable = rows.select("text", "lang").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNDETERMINED)
        & (F.length("text") <= max_train_chars) & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], [])
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, per_lang / n)])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    sample = (usable.where(draw < rate[F.col("lang")])
              .orderBy(F.xxhash64("text"), "lang").limit(2 * per_lang * len(counts)).collect())
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


# ---- scoring -------------------------------------------------------------------

def _any_letter(column: pa.Array, first: int, part: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts of a slice (lower-cased bytes ``part``, offsets ``at``, row ``first`` on) hold a letter."""
    plain = (part >= 97) & (part <= 122)
    # a text's first ASCII letter: where the next one is at its start, before its end
    places = np.flatnonzero(plain)
    found = np.searchsorted(places, at[1:]) > np.searchsorted(places, at[:-1])
    for i in np.flatnonzero(~found & (at[1:] > at[:-1])):               # no ASCII letter: rare
        found[i] = any(ch.isalpha() for ch in column[first + int(i)].as_py())
    return found


def label_slices(model: Crf, column: pa.Array):
    """For slices of a text column: (i, j, words per row, lettered words, marginals, lettered rows)."""
    data, offsets = text_buffer(column)
    for i, j in slices(offsets):
        part, at = _LOWER[data[offsets[i]: offsets[j]]], offsets[i: j + 1] - offsets[i]
        starts, ends, per_doc = words_of(part, at)
        letters = np.zeros(len(part) + 1, np.int32 if len(part) < 1 << 31 else np.int64)
        np.cumsum(_letters(part), out=letters[1:])
        p = np.zeros((0, len(model.langs)))
        if len(starts) and model.langs:
            p = marginals(emissions(model, part, starts, ends, word_hashes(part, starts, ends)), model.moves, per_doc)
        yield i, j, per_doc, letters[ends] > letters[starts], p, _any_letter(column, i, part, at)


def score_batch(model: Crf, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = [UNDETERMINED] * len(column), np.zeros(len(column))
    for i, j, per_doc, has, p, lettered in label_slices(model, column):
        if not len(p):
            continue
        owner = np.repeat(np.arange(j - i), per_doc)
        weight = has.astype(float)
        none = np.bincount(owner, weight, j - i) == 0
        weight[none[owner]] = 1.0                      # e.g. letters of other scripts only
        mass = np.stack([np.bincount(owner, p[:, c] * weight, j - i) for c in range(p.shape[1])], 1)
        mass /= np.maximum(np.bincount(owner, weight, j - i), 1e-9)[:, None]
        best = mass.argmax(axis=1)
        for d in np.flatnonzero(lettered & (per_doc > 0)):
            names[i + d] = model.langs[best[d]]
            scores[i + d] = min(1.0, mass[d, best[d]])
    return names, scores


def identify(docs: DataFrame, model: Crf) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; rows stay where they are (no shuffle)."""
    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)    # BUCKETS x languages floats: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = score_batch(shared.value, batch.column(batch.schema.get_field_index("text")))
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[f.name for f in schema.fields])

    return docs.select(*[F.col(f"`{f.name}`") for f in keep]).mapInArrow(run, schema)


def word_runs(docs: DataFrame, model: Crf) -> DataFrame:
    """Code-switched runs: (doc_id, run, lang, first_word, n_words) by each word's best marginal."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), {"doc_id": [], "run": [], "lang": [], "first_word": [], "n_words": []}
            for i, j, per_doc, _, p, _ in label_slices(shared.value, batch.column(1)):
                best, at = (p.argmax(axis=1) if len(p) else np.zeros(0, int)), 0
                for d, n in zip(range(i, j), per_doc.tolist(), strict=True):
                    mine, at = best[at: at + n], at + n
                    if not len(mine):
                        continue
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(mine)) + 1, [n]])
                    for r, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                        for c, v in zip(out, (ids[d], r, shared.value.langs[mine[a]], a, b - a), strict=True):
                            out[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["run"], pa.int32()), pa.array(out["lang"], pa.string()), pa.array(out["first_word"], pa.int64()), pa.array(out["n_words"], pa.int64())], names=list(out))

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, run int, lang string, first_word long, n_words long"))


def held_out():
    return crc_mod("doc_id", 3) == 1


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op7_language_id": op7_language_id}
ORACLES: dict[str, str] = {}
