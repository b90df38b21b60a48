"""Toxicity (1): a bidirectional gated recurrent network with attention pooling.

Inputs of a token: an embedding of the word (words of at least ``MIN_DOCS``
training documents, one shared by all others) beside the scaled sum of embeddings of its
characters' n-grams (hashed byte 3- to 5-grams of the bracketed word). A GRU reads
a window of ``WINDOW`` tokens from either side, attention weighs the states, and a
logistic unit scores the window. Windows overlap (one begins every ``STRIDE`` tokens, the
last one ends with the text) and cover every text whole; a passage of up to
``WINDOW - STRIDE + 1`` words lies whole in one of them. A document's score is
its highest window's, so one passage is enough.

Training is numpy on the driver (back-propagation through time, Adam), over a
bounded sample: ``per_class`` labelled rows of each class, chosen by hash, texts
of at most ``max_train_chars`` characters (documented parameters; only training
is sampled). The first third of the steps teaches every window its document's label, the
rest the highest one. Scoring needs no shuffle.

Defined cases: null, empty and word-less texts score 0.0; with no labelled rows
of both classes every text scores the share of positives seen (0.0 if none).
Null labels teach nothing; of repeated labels for one id the largest holds, and of repeated ids one text (the smallest hash) teaches. A null id counts as
the text "" in the hold-out rule. Extra columns pass through, results replace theirs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _LOWER, crc_mod, mix, slices, table, text_buffer, word_hashes, words_of

WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
GRAMS = 1 << 15
MIN_DOCS = 3
THRESHOLD = 0.3
_CHUNK = 4096            # windows scored in step


# ---- inputs ----------------------------------------------------------------------

def char_grams(data, starts, ends):
    """Hashed 3- to 5-grams of each bracketed word, and where each word's begin."""
    width = ends - starts + 2
    first = np.cumsum(width) - width
    owner = np.repeat(np.arange(len(width)), width)
    at = np.arange(int(width.sum())) - first[owner]
    inner = (at > 0) & (at < width[owner] - 1)
    chars = np.ones(len(at) + 4, np.uint64)
    chars[np.flatnonzero(inner)] = data[(starts[owner] + at - 1)[inner]]
    left = width[owner] - at
    code, owners, found = chars[:-4] | chars[1:-3] << np.uint64(8), [], []
    for n in (3, 4, 5):
        code = code | chars[n - 1: len(chars) - 5 + n] << np.uint64(8 * (n - 1))
        has = left >= n
        owners.append(owner[has])
        found.append(mix(code[has] + np.uint64(n << 48)))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(GRAMS)).astype(np.int64), np.searchsorted(owners[order], np.arange(len(width)))


def window_starts(per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, first token) of all windows; documents without words have none."""
    n = np.where(per_doc > WINDOW, -(-(per_doc - WINDOW) // STRIDE) + 1, (per_doc > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(per_doc)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    begin = np.cumsum(per_doc) - per_doc
    return doc, begin[doc] + np.minimum(k * STRIDE, np.maximum(per_doc[doc] - WINDOW, 0))


class Texts:
    """Tokens of texts: distinct words with their n-grams, and the word of each token."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = _LOWER[data]
        starts, ends, self.per_doc = words_of(data, offsets)
        self.hashes, at, self.words = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        self.grams, self.first = char_grams(data, starts[at], ends[at])
        self.many = np.diff(np.append(self.first, len(self.grams)))
        self.doc, self.start = window_starts(self.per_doc)
        self.stop = np.cumsum(self.per_doc)[self.doc] if len(self.doc) else self.start

    def tokens(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers (windows, WINDOW) and whether each is one."""
        at = self.start[windows, None] + np.arange(WINDOW)
        real = at < self.stop[windows, None]
        return np.where(real, at, self.start[windows, None]), real


# ---- network ---------------------------------------------------------------------

def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    def __init__(self, vocabulary: np.ndarray, seed: int = 11):
        rng, h, d = np.random.default_rng(seed), HIDDEN, WORD_DIM + CHAR_DIM
        normal = lambda *shape, s: (rng.normal(size=shape) * s).astype(np.float32)
        self.vocabulary = vocabulary                       # sorted hashes; row 0 is for all other words
        self.p = {"word": normal(len(vocabulary) + 1, WORD_DIM, s=0.1), "gram": normal(GRAMS, CHAR_DIM, s=0.1)}
        for side in "fb":
            self.p |= {f"w{side}": normal(d, 3 * h, s=0.4), f"c{side}": np.zeros(3 * h, np.float32),
                       f"u{side}": normal(h, 2 * h, s=0.3), f"v{side}": normal(h, h, s=0.3)}
        self.p |= {"att": normal(2 * h, ATTENTION, s=0.4), "key": normal(ATTENTION, s=0.4), "out": normal(2 * h, s=0.4), "bias": np.zeros(1, np.float32)}

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, t: Texts, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of distinct words ``used``, their n-grams and the scale of these."""
        many = t.many[used]
        first = np.cumsum(many) - many
        grams = t.grams[np.repeat(t.first[used] - first, many) + np.arange(int(many.sum()))]
        scale = (1 / np.sqrt(many)).astype(np.float32)
        chars = np.add.reduceat(self.p["gram"][grams], first, axis=0) * scale[:, None]
        return np.concatenate([self.p["word"][self.rows(t.hashes[used])], chars], 1), grams, scale

    def run(self, gates: dict[str, np.ndarray], real: np.ndarray, keep: list | None = None):
        """Logits of windows; ``gates`` holds (windows, WINDOW, 3*HIDDEN) inputs of either side."""
        n, h, p = len(real), HIDDEN, self.p
        states = np.empty((WINDOW, n, 2 * h), np.float32)
        whole = bool(real.all())
        for side, at in (("f", 0), ("b", h)):
            s = np.zeros((n, h), np.float32)
            steps = []
            for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
                a = gates[side][:, t]
                zr = _sigmoid(a[:, : 2 * h] + s @ p[f"u{side}"])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(a[:, 2 * h:] + (r * s) @ p[f"v{side}"])
                new = s + z * (c - s)
                if not whole:
                    new = np.where(real[:, t, None], new, s)
                if keep is not None:
                    steps.append((t, s, z, r, c))
                s = new
                states[t, :, at: at + h] = s
            if keep is not None:
                keep.append(steps)
        look = np.tanh(states @ p["att"])
        e = look @ p["key"]
        if not whole:
            e = np.where(real.T, e, -1e9)
        e = np.exp(e - e.max(axis=0))
        share = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnd->nd", share, states)
        if keep is not None:
            keep.append((states, look, share, pooled))
        return pooled @ p["out"] + p["bias"]

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {side: x @ self.p[f"w{side}"] + self.p[f"c{side}"] for side in "fb"}

    def scores(self, t: Texts, windows: np.ndarray) -> np.ndarray:
        """Logits of windows; the distinct words' gate inputs are computed once."""
        out, parts = np.empty(len(windows), np.float32), range(0, len(windows), _CHUNK)
        used = np.unique(np.concatenate([t.words[t.tokens(windows[i: i + _CHUNK])[0]].ravel() for i in parts]))
        per_word = self.gates(self.inputs(t, used)[0])
        place = np.zeros(len(t.hashes), np.int64)
        place[used] = np.arange(len(used))
        for i in parts:
            at, real = t.tokens(windows[i: i + _CHUNK])
            w = place[t.words[at]]
            out[i: i + _CHUNK] = self.run({s: g[w] for s, g in per_word.items()}, real)
        return out

    def gradients(self, t: Texts, windows: np.ndarray, y: np.ndarray, drop: np.ndarray) -> dict:
        """Of the mean logistic loss; ``drop`` hides the word embedding of tokens (n-grams stay)."""
        h, p, n = HIDDEN, self.p, len(windows)
        at, real = t.tokens(windows)
        w = t.words[at]
        used, back = np.unique(w, return_inverse=True)
        back = back.reshape(w.shape)
        vectors, grams, scale = self.inputs(t, used)
        sizes, chars = t.many[used], vectors[:, WORD_DIM:]
        rows = np.where(drop, 0, self.rows(t.hashes[used])[back])
        x = np.concatenate([p["word"][rows], chars[back]], 2)
        keep: list = []
        logit = self.run(self.gates(x), real, keep)
        steps, (states, look, share, pooled) = {"f": keep[0], "b": keep[1]}, keep[2]
        d = ((_sigmoid(logit) - y) / n).astype(np.float32)
        g = {"bias": np.array([d.sum()]), "out": pooled.T @ d}
        d_pool = d[:, None] * p["out"]
        d_states = share[:, :, None] * d_pool
        d_share = np.einsum("nd,tnd->tn", d_pool, states)
        d_e = share * (d_share - (share * d_share).sum(axis=0))
        g["key"] = np.einsum("tn,tnk->k", d_e, look)
        d_look = d_e[:, :, None] * p["key"] * (1 - look * look)
        g["att"] = np.einsum("tnd,tnk->dk", states, d_look)
        d_states = d_states + d_look @ p["att"].T
        d_x = np.zeros_like(x)
        for side, col in (("f", 0), ("b", h)):
            u, v = p[f"u{side}"], p[f"v{side}"]
            d_u, d_v, d_gate = np.zeros_like(u), np.zeros_like(v), np.zeros((n, WINDOW, 3 * h), np.float32)
            d_s = np.zeros((n, h), np.float32)
            for step, s, z, r, c in reversed(steps[side]):
                d_s = d_s + d_states[step, :, col: col + h]
                live = real[:, step, None]
                d_c = np.where(live, d_s * z * (1 - c * c), 0)
                d_z = np.where(live, d_s * (c - s) * z * (1 - z), 0)
                d_rs = d_c @ v.T
                d_r = d_rs * s * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], 1)
                d_u += s.T @ d_zr
                d_v += (r * s).T @ d_c
                d_gate[:, step] = np.concatenate([d_zr, d_c], 1)
                d_s = np.where(live, d_s * (1 - z), d_s) + d_rs * r + d_zr @ u.T
            g |= {f"u{side}": d_u, f"v{side}": d_v, f"c{side}": d_gate.sum(axis=(0, 1)), f"w{side}": np.einsum("ntd,ntk->dk", x, d_gate)}
            d_x += d_gate @ p[f"w{side}"].T
        d_x = np.where(real[:, :, None], d_x, 0)
        flat = d_x.reshape(-1, d_x.shape[2])
        d_char = np.stack([np.bincount(back.ravel(), flat[:, WORD_DIM + j], len(used)) for j in range(CHAR_DIM)], 1) * scale[:, None]
        g["gram"] = _gather(grams, np.repeat(d_char, sizes, axis=0))
        g["word"] = _gather(rows.ravel(), flat[:, :WORD_DIM])
        return g


def _gather(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of values by row."""
    distinct, back = np.unique(rows, return_inverse=True)
    return distinct, np.stack([np.bincount(back, values[:, j], len(distinct)) for j in range(values.shape[1])], 1)


def train(texts: list[str], labels: list[int], share: float = 0.5, steps: int = 300, docs_each: int = 40, rate: float = 0.02, seed: int = 5) -> Network | float:
    """A trained network, or the share of positives where there is only one class.

    Steps see both classes equally often; the bias then moves to ``share``, that of positives.
    """
    y = np.array(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    rng = np.random.default_rng(seed)
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    t = Texts(data, offsets)
    if not len(t.doc):
        return float(y.mean())
    owner = np.repeat(np.arange(len(y)), t.per_doc)
    pairs = np.unique(t.words * np.int64(len(y)) + owner)
    often = np.bincount(pairs // len(y), minlength=len(t.hashes)) >= MIN_DOCS
    net = Network(t.hashes[often])
    m = {k: np.zeros(v.shape) for k, v in net.p.items()}
    v2 = {k: np.zeros(v.shape) for k, v in net.p.items()}
    first = np.searchsorted(t.doc, np.arange(len(y) + 1))
    of_class = [np.flatnonzero((y == c) & (np.diff(first) > 0)) for c in (0, 1)]
    if not all(len(x) for x in of_class):
        return float(y.mean())
    for step in range(1, steps + 1):
        docs = np.concatenate([rng.choice(x, docs_each // 2) for x in of_class])
        windows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
        whose = np.repeat(np.arange(len(docs)), first[docs + 1] - first[docs])
        if step <= steps // 3:
            chosen = rng.permutation(len(windows))[: 6 * docs_each]
        else:
            logit = net.scores(t, windows)
            chosen = np.array([int(x[logit[x].argmax()]) for x in np.split(np.arange(len(windows)), np.cumsum(np.bincount(whose))[:-1])])
        drop = rng.random((len(chosen), WINDOW)) < 0.3
        g = net.gradients(t, windows[chosen], y[docs[whose[chosen]]], drop)
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, grad in g.items():
            at, grad = grad if isinstance(grad, tuple) else (slice(None), grad)
            m[k][at] = 0.9 * m[k][at] + 0.1 * grad
            v2[k][at] = 0.99 * v2[k][at] + 0.01 * grad * grad
            net.p[k][at] -= (lr * m[k][at] / (1 - 0.9 ** step) / (np.sqrt(v2[k][at] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    net.p["bias"] += np.float32(np.log(share / (1 - share)))
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1200, max_train_chars: int = 8_000) -> Network | float:
    """Learns from the rows of ``labels`` (doc_id, toxic) given: ``per_class`` of each class, by hash."""
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = {r["toxic"]: r["n"] for r in named.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    halves = [named.where(F.col("toxic") == c).orderBy(F.crc32(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(per_class) for c in (0, 1)]
    sample = F.broadcast(halves[0].union(halves[1]))            # 2 * per_class ids at most
    usable = docs.select("doc_id", "text").where((F.length("text") > 0) & (F.length("text") <= max_train_chars))
    # one text for each id, so that the driver gets 2 * per_class rows at most, whatever repeats
    one = usable.join(sample, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = sorted(one.collect(), key=lambda r: (r["doc_id"], r["text"]))
    share = (count.get(1, 0) + 1) / (count.get(0, 0) + count.get(1, 0) + 2)
    return train([r["text"] for r in rows], [int(r["toxic"]) for r in rows], share)


def score_column(net: Network | float, column: pa.Array) -> np.ndarray:
    data, offsets = text_buffer(column)
    out = np.zeros(len(column))
    for i, j in slices(offsets):
        t = Texts(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
        if not len(t.doc):
            continue
        best = np.full(j - i, -np.inf)
        np.maximum.at(best, t.doc, net.scores(t, np.arange(len(t.doc))) if isinstance(net, Network) else np.full(len(t.doc), np.log(max(net, 1e-9) / max(1 - net, 1e-9))))
        out[i:j] = np.where(np.isfinite(best), _sigmoid(np.where(np.isfinite(best), best, 0)), 0.0)
    return out


def score_toxicity(docs: DataFrame, net: Network | float, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; rows stay where they are (no shuffle)."""
    keep = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*keep, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(net)        # fixed tables and a vocabulary of the bounded sample

    def run(batches):
        for batch in batches:
            score = score_column(shared.value, batch.column(batch.schema.get_field_index("text")))
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[f.name for f in schema.fields])

    return docs.select(*[F.col(f"`{f.name}`") for f in keep]).mapInArrow(run, schema)


def held_out():
    return crc_mod("doc_id", 4) == 2


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score_toxicity(docs, net).select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict[str, str] = {}
