"""LM scoring (8): a weighted backoff automaton over smoothed word n-grams.

States are contexts (the last word, or the start of a text, where the training
texts know it) and the empty context. A state has an explicit arc for each
bigram seen in training and one failure arc to the empty state, whose arcs are
the words and one class for unknown words. Every arc of a word leads to the state
of that word, or to the empty one if training lacks it. One traversal from left to
right carries a state per document, looks up the state's arc for the next word, takes
the failure arc where there is none, moves on, and accumulates log10 weights.

Smoothing (a proper distribution over the V known words, the end and one
unknown class): unigrams give the unknown class the share n1/N of words seen
once (Good-Turing; at least 1/(N+1)); a context u mixes
p(v|u) = (1-m) c(uv)/c(u) + m p(v) with m = T/(T+c(u)), T the expected number of distinct
words among c(u) draws from the unigram counts. An unseen bigram therefore
weighs log m on the failure arc plus log p(v) in the empty state.

The model is never in one place. Documents are dealt into batches by their place in
the input, so that repeated rows spread like others. Each
batch asks buckets for its distinct n-grams, sending its own training counts
along; a bucket adds them up over all batches and answers with corpus totals;
the batch then builds just the automaton arcs its documents can take. A hot word
is one key per batch, whatever its count. A bucket that a batch has no n-gram for
gets no message from it, so messages are at most as many as the batches' distinct
n-grams: what is shuffled grows with the corpus. Counts of counts, 128 numbers, are
added up over all buckets and reach each batch in one row.

Null and empty texts have the end token only. With no training rows the model
gives every token the unknown weight of an empty corpus, log10 1. Repeated rows
score alike; a null id counts as the text "" in the hold-out rule. Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, hashed_words, importable, mix, n_groups, table

END = np.uint64(0x2545F4914F6CDD1D)      # the end token, and the state before a text
PAIR = np.uint64(0xA0761D6478BD642F)
BINS = 64                                # words by floor(log2(count))
BLOCK = 4096                             # tokens of a long document that one step range covers
BATCH_BYTES = 4 << 20                    # of stored input; more on larger executors

_REQUEST = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("level", pa.int32()),
                      ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("level", pa.int32()),
                     ("totals", pa.binary()), ("spectrum", pa.list_(pa.int64()))])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                     ("score", pa.float64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double",
             pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), kind)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text's words, then its end) and tokens per text."""
    parts, sizes = [], []
    for _, _, per_doc, h in hashed_words(column):
        out = np.full(len(h) + len(per_doc), END, np.uint64)
        ends = np.cumsum(per_doc + 1) - 1
        inner = np.ones(len(out), bool)
        inner[ends] = False
        out[inner] = h
        parts.append(out)
        sizes.append(per_doc + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(sizes)


def contexts(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token before each one; END stands before a text."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.cumsum(sizes) - sizes] = END
    return before


def _levels(h: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    return [h, mix(contexts(h, sizes) * PAIR + h)]


def ask(group: pa.Table, buckets: int) -> pa.Table:
    """A batch's distinct n-grams with its own training counts, by bucket."""
    h, sizes = tokens(group["text"])
    training = np.repeat(np.asarray(group["training"].combine_chunks()), sizes)
    out = []
    for level, keys in enumerate(_levels(h, sizes), 1):
        distinct, back = np.unique(keys, return_inverse=True)
        counts = np.bincount(back[training], minlength=len(distinct))
        to = (distinct % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        begin = np.flatnonzero(np.diff(to[order], prepend=-1))
        for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True):
            own = order[i:j]
            out.append((int(to[own[0]]), group["batch"][0].as_py(), level, distinct[own].tobytes(), _pack(counts[own].astype(np.uint64))))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _REQUEST, strict=True)], schema=_REQUEST)


def answer(group: pa.Table) -> pa.Table:
    """Corpus totals of the n-grams that each batch asked for; at level 0 the bucket's count spectrum."""
    out = []
    level = np.asarray(group["level"].combine_chunks())
    for want in np.unique(level):
        rows = np.flatnonzero(level == want)
        keys = [np.frombuffer(group["keys"][int(r)].as_py(), np.uint64) for r in rows]
        counts = [_unpack(group["counts"][int(r)].as_py(), np.uint64) for r in rows]
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, np.concatenate(counts).astype(float), len(distinct))
        if want == 1:
            seen = total[total > 0]
            of = np.floor(np.log2(seen)).astype(int)
            spectrum = np.concatenate([np.bincount(of, minlength=BINS), np.bincount(of, seen, BINS)])
            out.append((-1, group["bucket"][0].as_py(), 0, b"", spectrum.astype(np.int64).tolist()))
        at = 0
        for r, k in zip(rows, keys, strict=True):
            got = total[back[at: at + len(k)]].astype(np.uint64)
            at += len(k)
            out.append((group["batch"][int(r)].as_py(), group["bucket"][int(r)].as_py(), int(want), _pack(got), None))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ANSWER, strict=True)], schema=_ANSWER)


def expected_types(spectrum: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Expected distinct words among so many draws, by the unigram counts' spectrum."""
    words, mass = spectrum[:BINS], spectrum[BINS:]
    some = words > 0
    each = mass[some] / words[some] / max(mass.sum(), 1.0)
    return (words[some] * -np.expm1(draws[:, None] * np.log1p(-np.minimum(each, 1 - 1e-12)))).sum(axis=1)


class Automaton:
    """The states and arcs that one batch's documents can meet.

    State 0 is the empty context, state w + 1 the context of word slot w. ``arcs`` are the sorted
    numbers of explicit arcs, state * words + word, with their weights.
    """

    def __init__(self, word_counts: np.ndarray, pair_counts: np.ndarray, pair_context: np.ndarray,
                 pair_word: np.ndarray, spectrum: np.ndarray):
        """Corpus counts of word slots and of distinct pairs, with each pair's two word slots."""
        total, known = spectrum[BINS:].sum(), spectrum[:BINS].sum()
        once = max(spectrum[0], total / (total + 1)) / total if total else 1.0
        once = min(once, 0.999) if known else 1.0
        p = np.where(word_counts > 0, (1 - once) * word_counts / max(total, 1), once)
        sizes, slot = np.unique(word_counts, return_inverse=True)
        kinds = expected_types(spectrum, sizes) if known else np.zeros(len(sizes))
        back_off = np.where(sizes > 0, kinds / np.maximum(kinds + sizes, 1e-300), 1.0)[slot]
        self.words = len(word_counts)
        self.empty = np.log10(p)                                          # arcs of the empty state
        self.after = np.where(word_counts > 0, np.arange(1, self.words + 1), 0)   # where arcs of a word lead
        self.failure = np.concatenate([[0.0], np.log10(np.maximum(back_off, 1e-300))])
        seen = np.flatnonzero(pair_counts > 0)
        number = (pair_context[seen] + 1) * self.words + pair_word[seen]
        order = np.argsort(number)
        seen, self.arcs = seen[order], number[order]
        context, m = pair_context[seen], back_off[pair_context[seen]]
        self.weight = np.log10((1 - m) * pair_counts[seen] / word_counts[context] + m * p[pair_word[seen]])

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after reading a word each, and the weights of the arcs taken."""
        number = state * self.words + word
        arc = np.searchsorted(self.arcs, number)
        weight = np.empty(len(state))
        has = np.zeros(len(state), bool)
        inside = arc < len(self.arcs)
        has[inside] = self.arcs[arc[inside]] == number[inside]
        weight[has] = self.weight[arc[has]]
        fails = ~has                                                      # the failure arc, then the empty state's own
        weight[fails] = self.failure[state[fails]] + self.empty[word[fails]]
        return self.after[word], weight

    def traverse(self, words: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
        """log10 probability of each document, read from the state after word slot ``start``.

        Documents step together, one token at a time. A long one goes in blocks of ``BLOCK`` tokens side by
        side: an arc's word alone decides its end, so a block begins in the state after the token before it.
        """
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = (np.cumsum(sizes) - sizes)[owner] + nth * BLOCK
        left = np.minimum(sizes[owner] - nth * BLOCK, BLOCK)
        order = np.argsort(-left, kind="stable")
        begin, left = begin[order], left[order]
        state = self.after[np.where(nth[order] > 0, words[begin - 1], start)]
        running = np.zeros(len(order))
        for t in range(int(left[0]) if len(order) else 0):
            live = int(np.searchsorted(-left, -t, "left"))               # blocks longer than t
            state, weight = self.step(state[:live], words[begin[:live] + t])
            running[:live] += weight
        score = np.empty(len(order))
        score[order] = running
        return np.bincount(owner, score, len(sizes))


def score(docs: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    if docs.num_rows == 0:
        return _SCORED.empty_table()
    h, sizes = tokens(docs["text"])
    level, bucket = np.asarray(answers["level"].combine_chunks()), np.asarray(answers["bucket"].combine_chunks())
    spectrum = np.array(answers["spectrum"][int(np.flatnonzero(level == 0)[0])].as_py(), float)
    words, firsts, totals = None, [], []
    for want, keys in enumerate(_levels(h, sizes), 1):
        if want == 1:
            distinct, first, words = np.unique(keys, return_index=True, return_inverse=True)
        else:
            distinct, first = np.unique(keys, return_index=True)
        to = (distinct % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        rows = np.flatnonzero(level == want)
        lo, hi = np.searchsorted(to[order], bucket[rows], "left"), np.searchsorted(to[order], bucket[rows], "right")
        total = np.zeros(len(distinct))
        for r, i, j in zip(rows.tolist(), lo.tolist(), hi.tolist(), strict=True):
            total[order[i:j]] = _unpack(answers["totals"][r].as_py(), np.uint64)
        firsts.append(first)
        totals.append(total)
        del keys, distinct, to, order, total
    begin = np.cumsum(sizes) - sizes
    del h
    at_start = np.zeros(len(words), bool)
    at_start[begin] = True
    first, end = firsts[1], int(words[sizes[0] - 1])
    # the slot of the word before each distinct pair: the end's own slot stands for the start
    before = np.where(at_start[first], end, words[np.maximum(first - 1, 0)])
    model = Automaton(totals[0], totals[1], before, words[first], spectrum)
    del before, first, firsts
    n, v = spectrum[BINS:].sum(), spectrum[:BINS].sum()
    count = totals[0][words]
    with np.errstate(divide="ignore", invalid="ignore"):
        base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
    return pa.table([docs["doc_id"].cast(pa.int64()), docs["held_out"], pa.array(sizes, pa.int64()),
                     pa.array(np.add.reduceat((count > 0).astype(np.int64), begin), pa.int64()),
                     pa.array(np.full(len(sizes), int(n)), pa.int64()), pa.array(np.add.reduceat(base, begin)),
                     pa.array(model.traverse(words, sizes, end))], schema=_SCORED)


def score_texts(docs: DataFrame, held_out, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Scores every row of ``docs`` (doc_id, text); ``held_out`` rows teach nothing."""
    importable(docs.sparkSession)
    held = F.coalesce(held_out, F.lit(False))
    batches = n_groups(docs.select("text"), batch_bytes)
    buckets = batches
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches))
    dealt = docs.select(F.col("doc_id"), F.col("text"), held.alias("held_out"), (~held).alias("training"), deal.alias("batch"))
    asked = dealt.groupBy("batch").applyInArrow(lambda t: ask(t, buckets), _ddl(_REQUEST))
    answered = asked.groupBy("bucket").applyInArrow(answer, _ddl(_ANSWER))
    sums = answered.where("level = 0").select(F.posexplode("spectrum").alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n"))
    spectrum = sums.agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("s")).select(F.col("s.n").alias("s"))
    answers = answered.where("level > 0").unionByName(
        docs.sparkSession.range(batches).select(F.col("id").alias("batch"), F.lit(0).alias("bucket"), F.lit(0).alias("level"),
                                                F.lit(b"").alias("totals"), spectrum.scalar().alias("spectrum")))
    return (dealt.groupBy("batch").cogroup(answers.groupBy("batch"))
            .applyInArrow(lambda d, a: score(d, a, buckets), _ddl(_SCORED)))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, crc_mod("doc_id", 10) == 0)


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
ORACLES: dict[str, str] = {}
