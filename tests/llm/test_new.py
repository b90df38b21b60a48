"""Whitening, chat formatting and the Merkle manifest against plain versions written from their contracts."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from farebox.llm import chat, merkle, polynomial, sha256, whitening

from . import conftest


def collected(spark, tables, name):
    return E.queries()[name](spark, tables).collect()


def oracle(tables, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    return con.execute(E.oracle_sql()[name])


def same_rows(got, want):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


# ---- 11 --------------------------------------------------------------------------

def valid_vectors(rows):
    out = []
    for i, v in rows:
        if v is not None and len(v) == 4 and all(c is not None and math.isfinite(c) for c in v) and max(map(abs, v)) < 1e15:
            out.append((i, [math.floor(64 * c) + 1000000 for c in v]))
    return out


def test_whitening_equals_numpy(spark, tables):
    rows = valid_vectors(conftest.embeddings())
    distinct = np.array(sorted({tuple(x) for _, x in rows}), dtype=float)
    n, mean = len(distinct), distinct.mean(axis=0)
    away = distinct - mean
    values, axes = np.linalg.eigh(away.T @ away / n)
    values, axes = values[::-1], axes.T[::-1]
    got = collected(spark, tables, "op11_whitening")
    sums = [sum(int(c) for c in col) for col in distinct.T]
    by_component = {c: [r for r in got if r.component == c] for c in (1, 2, 3)}
    assert len(got) == 3 * len(rows)            # the constant entry has no variance
    for c, mine in by_component.items():
        want = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), (np.array(x) - mean) @ axes[c - 1] / math.sqrt(values[c - 1])) for i, x in rows]
        sign = math.copysign(1, sum(r.whitened for r in mine if r.vec_id == 97) * [w for i, _, w in want if i == 97][0])
        key = lambda t: (t[0] is None, t[0] or 0, t[1], round(t[2], 6))
        for (i, d, w), r in zip(sorted(want, key=key), sorted([(r.vec_id, r.deviation, sign * r.whitened) for r in mine], key=key)):
            assert (i, d) == r[:2] and w == pytest.approx(r[2], rel=1e-9, abs=1e-9)
        assert all(r.explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9) for r in mine)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_equal_vectors_give_no_components(spark):
    assert whitening.fit(spark.createDataFrame([(1, [1.0, 2.0])] * 5, "vec_id long, embedding array<float>"))[0] is None


def test_equal_eigenvalues_and_big_integers(spark):
    m, big = 10 ** 12, 1 << 60
    rows = [(0, [m, 0, 0]), (1, [-m, 0, 0]), (2, [0, m, 0]), (3, [0, -m, 0]), (4, [0, 0, big // 64])]
    model, distinct = whitening.fit(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>"))
    assert whitening.identity_error(model, distinct) < 1e-9 and len(model.roots) == 3
    out = whitening.whiten(spark.createDataFrame([(4, [0.0, 0.0, float(big // 64)])], "vec_id long, embedding array<double>"), model, 0.0).collect()
    assert [r.deviation for r in out] == [None] * 3       # exceeds a long


def test_sums_are_exact_across_parts():
    rng = random.Random(5)
    rows = np.array([[rng.randint(-(1 << 61), 1 << 61) for _ in range(3)] for _ in range(9000)])
    sums, outer = whitening._scatter(rows)
    exact = rows.astype(object)
    assert (sums == exact.sum(axis=0)).all() and (outer == exact.T @ exact).all()
    at, limb, part = whitening._limbs(outer.ravel())
    back = [0] * 9
    for a, k, v in zip(at, limb, part):
        back[a] += v << whitening._LIMB * k
    assert back == outer.ravel().tolist()


def test_polynomial_of_known_roots():
    roots = [0, 0, 3, 3, 3, 17, 10 ** 9, 10 ** 9 + 1, 10 ** 30]
    f = [1]
    for r in roots:
        f = [a - r * b for a, b in zip([0, *f], [*f, 0])]
    p = 2147483629
    q = np.diag(np.array(roots, object))
    u = np.eye(9, dtype=object) + np.tri(9, k=-1, dtype=int).astype(object)      # a similarity with determinant 1
    inverse = np.array(np.round(np.linalg.inv(u.astype(float))), dtype=int).astype(object)
    assert polynomial.charpoly_mod(((u @ q @ inverse) % p).astype(np.int64), p) == [c % p for c in f]
    g = polynomial.square_free(f)
    assert len(g) == 7 and polynomial.roots_above(f, 2, 0) == 7 and polynomial.roots_above(f, 7, 1) == 4
    found = polynomial.largest_roots(g, 9, 120)
    assert [(2 * near + (1 << shift)) >> shift + 1 for near, shift, _, _ in found] == [10 ** 30, 10 ** 9 + 1, 10 ** 9, 17, 3, 0]


# ---- 12 ----------------------------------------------------------------------------

def test_chat_equals_oracle(spark, tables):
    q = oracle(tables, "op12_chat")
    names = [d[0] for d in q.description]
    df = E.queries()["op12_chat"](spark, tables)
    same_rows(df.select(*names).collect(), q.fetchall())


def test_chat_equals_plain_version(spark, tables):
    rows = conftest.conversations() + [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    want = {}
    for c, t, r, x in rows:
        want.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    for r in collected(spark, tables, "op12_chat"):
        turns = [(a, b) for _, _, a, b in sorted(want[r.conv_id])]
        loss = "".join(x for role, x in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_blocks_and_spans(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "é<and>"), (1, 2, "assistant", "z")], "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(rows).first()
    assert out.formatted == "<turn>user<says>q</turn>\n<turn>assistant<says>é<\\and><and>z</turn>\n"
    assert [out.formatted[s.start: s.start + s.length] for s in out.loss] == ["é<\\and>", "z"]
    data = out.formatted.encode()
    assert [data[s.byte_start: s.byte_start + s.byte_length].decode() for s in out.loss] == ["é<\\and>", "z"]


def test_escape_is_reversible(spark):
    rng = random.Random(2)
    bits = ["<", "\\", "/", "turn>", "says>", "and>", "</turn>\n", "<and>", "x", "\n", "é"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u"))
    for r in df.collect():
        assert r.u == r.t and not any(m.strip() in r.e for m in (chat.OPEN, chat.SAYS, chat.AND, chat.CLOSE))


# ---- 13 ------------------------------------------------------------------------------

def plain_merkle(docs):
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf_of = lambda d, n: h("".join(map(field, (d[0], d[3], d[2], n, d[1]))))

    def tree(nodes):
        """The last node and each place's sides: (siblings before, siblings after) by level."""
        sides, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                run = nodes[p & ~1: (p & ~1) + 2]
                sides[i].append((run[: p & 1], run[(p & 1) + 1:]))
            at = [p >> 1 for p in at]
            nodes = [h("".join(nodes[i: i + 2])) for i in range(0, len(nodes), 2)]
        return nodes[0], sides

    langs = {}
    for d in docs:
        n = None if d[1] is None else len(d[1])
        hit = d[0] is not None and n is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0
        langs.setdefault(d[2], []).append((d[0] is not None, d[0] or 0, leaf_of(d, n), leaf_of(d, n + 1) if hit else None))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in sorted(langs[x], key=lambda r: r[:3])]) for x in order}
    root, top = tree([trees[x][0] for x in order])
    out = []
    for k, x in enumerate(order):
        for (known, i, leaf, forged), sides in zip(sorted(langs[x], key=lambda r: r[:3]), trees[x][1]):
            now, proof = forged or leaf, ""
            for before, after in sides + top[k]:
                now, proof = h("".join([*before, now, *after])), proof + "".join(before + after)
            out.append((i if known else None, leaf, trees[x][0], root, h(proof), now, now == root))
    return out


def test_merkle_equals_plain_version(spark, tables, odd_docs):
    same_rows([r[:7] for r in collected(spark, tables, "op13_merkle")], plain_merkle(odd_docs))


def test_merkle_equals_oracle(spark, tables):
    q = oracle(tables, "op13_merkle")
    names = [d[0] for d in q.description]
    same_rows(E.queries()["op13_merkle"](spark, tables).select(*names).collect(), q.fetchall())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 21])
def test_small_groups_make_the_same_tree(spark, n):
    """Several rounds: groups of four nodes."""
    rows = [(i, f"t{i}", f"l{i % 3}" if n > 8 else None, None) for i in range(n)]
    df = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(df, {"n_chars": F.when(hit, F.col("n_chars") + 1)}, chunk=2).collect()
    same_rows([r[:7] for r in got], plain_merkle(rows))


def test_repeated_rows_are_spread(spark):
    """Two thirds of all rows are one row: places split them, results are those of the plain version."""
    rows = [(5, "same", "en", "s")] * 2000 + [(i, f"t{i}", "en", "s") for i in range(1000)]
    df = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    assert {r[:7] for r in map(tuple, merkle.manifest(df, {"n_chars": F.when(F.col("doc_id") == -1, 0)}).collect())} \
        == {(i, a, b, c, d, c, True) for i, a, b, c, d, _, _ in plain_merkle(rows)}
    at = df.select(F.lit("x").alias("tree"), "doc_id")
    parts = merkle.numbered(at.coalesce(3), ["doc_id"]).groupBy("idx").count()
    assert parts.count() == 3000


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(min_size=64, max_size=64), min_size=1, max_size=4), st.integers(0, 3))
def test_states_resume(blocks, cut):
    cut = min(cut, len(blocks))
    state = sha256.start(1)
    for b in blocks[:cut]:
        state = sha256.absorb(state, np.frombuffer(b, np.uint8).reshape(1, 64))
    kept = np.frombuffer(merkle._words(state).tobytes(), "<u4").astype(np.uint32).reshape(1, 8)     # stored and read again
    for b in blocks[cut:]:
        kept = sha256.absorb(kept, np.frombuffer(b, np.uint8).reshape(1, 64))
    assert sha256.finish(kept, len(blocks))[0].tobytes() == hashlib.sha256(b"".join(blocks)).digest()
