"""Merkle dataset manifest (13): a SHA midstate tree over the rows of a table.

A leaf is the SHA-256 of a row's columns, each ``-`` if null, else its UTF-8
byte count, ``:`` and its text (integers decimal). Per tree (the lang), leaves
ascend by id; every two consecutive nodes (the last run: fewer, even one) become
the SHA-256 of their digests as hexadecimal text, until one is left: the
subroot. Subroots, ordered by lang (null first, bytewise), make the top tree in
the same way, and its last node is the root.

Method: a digest as text is one block of the hash. While a parent is built, the
hash state before each of its child slots is copied and retained. To fold a
replaced leaf into a new root, the retained state before its slot is resumed
with the replacement and the siblings to its right only; nothing left of it is
hashed again. States are eight words (see ``sha256``), so that they are rows of
a table like digests and travel to whoever folds.

Scale: ids are ranged over all tasks and numbered by part offsets, so a hot lang
is no group. Nodes go up ``CHUNK`` levels at a time: an aligned run of 2**CHUNK
nodes is one group of bounded size, whatever its lang, and hands on one node.
Going down, a group takes the path of its own top node (one row) and each of
its nodes gets the levels inside; leaves are folded there, all levels of a
group's leaves at once. Rounds grow with the logarithm of the largest tree; one
number of it comes to the driver.

Defined cases: null ids come first, equal ids stand in the order of their
leaves, and repeated rows are leaves of their own; a null id is never tampered
with; a null lang is a tree of its own; one leaf is its own subroot and one
subroot the root, with no siblings (their proof is the hash of the empty text);
extra columns are ignored; an empty table has no nodes. One added to the
largest 64-bit n_chars is written as the next integer.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import sha256
from .common import importable, n_groups, table, written

#: Levels that one group of nodes goes up at a time.
CHUNK = 12
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MOD = 7
#: How a node stands in its parent: alone, before a right sibling, behind a left one.
ALONE, LEFT, RIGHT = 0, 1, 2
_NODE = "tree string, idx long, n long, digest binary"
_PATH = "tree string, idx long, key string, codes binary, siblings binary, states binary, subroot binary, root binary"
_FOLDED = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
           "position long")


def height(n: int) -> int:
    """Levels above ``n`` nodes."""
    return max(0, n - 1).bit_length()


# ---- leaves and places ---------------------------------------------------------------

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of a row (binary)."""
    return F.unhex(F.sha2(F.concat(*[_field(fields[c]) for c in COLUMNS]), 256))


def tree_key(lang: Column) -> Column:
    """A text that orders as lang does, null first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def _count_rows(batches):
    """Adds the part and the row's place among its tree's rows of this part; rows come sorted by tree."""
    part, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        trees = batch.column("tree").to_numpy(zero_copy_only=False)
        size = len(trees)
        if size == 0:
            continue
        starts = np.flatnonzero(np.r_[True, trees[1:] != trees[:-1]])
        begin = np.repeat(starts, np.diff(np.r_[starts, size]))
        place = np.arange(size) - begin
        if trees[0] == last:
            place[begin == 0] += n
        last, n = trees[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(size, part, np.int32)), pa.array(place)],
                                         names=[*batch.schema.names, "part", "place"])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (a written table) with their place ``idx`` in their ``tree`` by ``order`` and the tree's size ``n``."""
    # rows equal in all columns are told apart by where the table holds them, so that they split too
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    keys = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order], F.col("at")]
    ranged = rows.repartitionByRange(n_groups(rows, 4 << 20), *keys).sortWithinPartitions(*keys).drop("at")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema) + ", part int, place long"
    placed = written(ranged.mapInArrow(_count_rows, schema), "merkle-places")
    parts = placed.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(tree).alias("n"))
    return (placed.join(parts, ["tree", "part"]).withColumn("idx", F.col("before") + F.col("place"))
            .drop("part", "place", "before"))


# ---- one group: an aligned run of nodes and the levels above it ---------------------------

def _digests(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def climb(digests: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Digests of each level from ``digests`` up, and per level the states retained behind each parent's first child."""
    nodes, states = [digests], []
    for _ in range(levels):
        now = nodes[-1]
        # before the first slot the state is the start; behind the first child it is kept for the second slot
        kept = sha256.absorb(sha256.start((len(now) + 1) // 2), sha256.hex_blocks(now[0::2]))
        pairs = len(now) // 2
        up = sha256.finish(sha256.absorb(kept[:pairs], sha256.hex_blocks(now[1::2])), 2)
        if len(now) % 2:
            up = np.concatenate([up, sha256.finish(kept[pairs:], 1)])
        nodes.append(up)
        states.append(kept)
    return nodes, states


def path_inside(nodes: list[np.ndarray], states: list[np.ndarray]):
    """For each level: how every bottom node's ancestor stands, its sibling (zeros if alone) and the state before its slot."""
    at = np.arange(len(nodes[0]))
    for level, kept in enumerate(states):
        now, p = nodes[level], at >> level
        code = np.where(p & 1, RIGHT, np.where(p + 1 < len(now), LEFT, ALONE)).astype(np.uint8)
        sibling = now[np.minimum(p ^ 1, len(now) - 1)]
        yield code, np.where((code == ALONE)[:, None], np.uint8(0), sibling), np.where((code == RIGHT)[:, None], kept[p >> 1], sha256.START)


def fold_level(digests: np.ndarray, code: np.ndarray, sibling: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Parents of ``digests``: resume the state before the slot with the node, then its right sibling if it has one."""
    after = sha256.absorb(state, sha256.hex_blocks(digests))
    left, alone = np.flatnonzero(code == LEFT), np.flatnonzero(code == ALONE)
    if len(left):
        after[left] = sha256.absorb(after[left], sha256.hex_blocks(sibling[left]))
    up = sha256.finish(after, 2)
    if len(alone):
        up[alone] = sha256.finish(after[alone], 1)
    return up


def _sorted(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by("idx")


def _up(chunk: int):
    def up(key, nodes):
        nodes = _sorted(nodes)
        n = nodes.column("n")[0].as_py()
        top = climb(_digests(nodes.column("digest")), min(chunk, height(n)))[0][-1]
        return pa.table([[key[0].as_py()], [key[1].as_py()], [(n + (1 << chunk) - 1) >> chunk], [top[0].tobytes()]],
                        schema=pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]))
    return up


def _words(states: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(states).astype("<u4").view(np.uint8)


def _down_paths(chunk: int):
    """Paths of a group's nodes: the levels inside the group, then its top node's path."""
    def down(key, nodes, above):
        if not len(nodes) or not len(above):
            return pa.table([pa.array([], t) for t in _PATH_ARROW.types], schema=_PATH_ARROW)
        nodes, top = _sorted(nodes), above.to_pylist()[0]
        levels = list(path_inside(*climb(_digests(nodes.column("digest")), min(chunk, height(nodes.column("n")[0].as_py())))))
        rows = range(len(nodes))
        codes = [bytes(c[i] for c, _, _ in levels) + top["codes"] for i in rows]
        siblings = [b"".join(s[i].tobytes() for c, s, _ in levels if c[i] != ALONE) + top["siblings"] for i in rows]
        states = [b"".join(_words(m[i]).tobytes() for c, _, m in levels if c[i] == RIGHT) + top["states"] for i in rows]
        return pa.table([nodes.column("tree"), nodes.column("idx"), nodes.column("key"), codes, siblings, states,
                         [top["subroot"]] * len(nodes), [top["root"]] * len(nodes)], schema=_PATH_ARROW)
    return down


_PATH_ARROW = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("key", pa.string()), ("codes", pa.binary()),
                         ("siblings", pa.binary()), ("states", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])
_FOLDED_ARROW = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
                           ("folded_root", pa.string()), ("verified", pa.bool_()), ("position", pa.int64())])


def _steps_above(top: dict):
    """The levels of a stored path: (code, sibling, state), the same for the whole group."""
    siblings, states = memoryview(top["siblings"]), memoryview(top["states"])
    for code in top["codes"]:
        sibling, state = np.zeros(32, np.uint8), sha256.START
        if code != ALONE:
            sibling, siblings = np.frombuffer(siblings[:32], np.uint8), siblings[32:]
        if code == RIGHT:
            state, states = np.frombuffer(states[:32], "<u4").astype(np.uint32), states[32:]
        yield code, sibling, state


def _fold(chunk: int):
    """Results of a group's leaves: each leaf, or what replaces it, folded up to the root."""
    def fold(key, nodes, above):
        if not len(nodes) or not len(above):
            return pa.table([pa.array([], t) for t in _FOLDED_ARROW.types], schema=_FOLDED_ARROW)
        nodes, top = _sorted(nodes), above.to_pylist()[0]
        leaves, m = _digests(nodes.column("digest")), len(nodes)
        now = leaves.copy()
        for i, b in enumerate(nodes.column("altered").to_pylist()):
            if b is not None:
                now[i] = np.frombuffer(b, np.uint8)
        inside = list(path_inside(*climb(leaves, min(chunk, height(nodes.column("n")[0].as_py())))))
        for code, sibling, state in inside:
            now = fold_level(now, code, sibling, state)
        for code, sibling, state in _steps_above(top):
            now = fold_level(now, np.full(m, code, np.uint8), np.broadcast_to(sibling, (m, 32)), np.broadcast_to(state, (m, 8)))
        rest = top["siblings"].hex().encode()
        has = np.stack([c != ALONE for c, _, _ in inside], 1) if inside else np.zeros((m, 0), bool)
        text = np.stack([sha256.hex_blocks(s) for _, s, _ in inside], 1) if inside else np.zeros((m, 0, 64), np.uint8)
        proofs = [hashlib.sha256((text[i] if has[i].all() else text[i][has[i]]).tobytes() + rest).hexdigest() for i in range(m)]
        root = np.frombuffer(top["root"], np.uint8)
        return pa.table([nodes.column("doc_id"), [b.tobytes().hex() for b in leaves], [top["subroot"].hex()] * m, [top["root"].hex()] * m, proofs,
                         [b.tobytes().hex() for b in now], pa.array((now == root).all(axis=1)), nodes.column("idx")], schema=_FOLDED_ARROW)
    return fold


# ---- forests ---------------------------------------------------------------------------------

def _chunk_of(chunk: int) -> Column:
    return F.shiftright("idx", chunk).alias("chunk")


def build(nodes: DataFrame, chunk: int = CHUNK) -> list[DataFrame]:
    """Tables of nodes (tree, idx, n, digest), each 2**chunk times smaller; in the last, every tree has its root only."""
    rounds, most = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while True:
        rows = rounds[-1].select("tree", "idx", "n", "digest")
        if len(rounds) > 1:
            rows = rows.where("n > 1")
        up = rows.groupBy("tree", _chunk_of(chunk)).applyInArrow(_up(chunk), _NODE)
        rounds.append(written(up, "merkle-nodes"))
        most = (most + (1 << chunk) - 1) >> chunk
        if most <= 1:
            return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's root."""
    out = rounds[1]
    for r in rounds[2:]:
        out = out.unionByName(r)
    return out.where("n = 1").select("tree", "digest")


def descend(rounds: list[DataFrame], root_paths: DataFrame, bottom, schema: str, chunk: int = CHUNK) -> DataFrame:
    """``bottom`` applied to each group of the first table with its top node's path; ``root_paths`` are the paths above roots."""
    above = None
    for r in range(len(rounds) - 1, 0, -1):
        here = rounds[r].withColumn("key", F.lit(None).cast("string"))
        paths = here.where("n = 1").select("tree", "idx").join(root_paths.drop("idx"), "tree").select(*_PATH_ARROW.names)
        if above is not None:
            paths = paths.unionByName(_grouped(here.where("n > 1"), above, _down_paths(chunk), _PATH, chunk))
        above = written(paths, "merkle-paths")
    return _grouped(rounds[0], above, bottom, schema, chunk)


def _grouped(nodes: DataFrame, above: DataFrame, fn, schema: str, chunk: int) -> DataFrame:
    return (nodes.groupBy("tree", _chunk_of(chunk)).cogroup(above.withColumnRenamed("idx", "chunk").groupBy("tree", "chunk"))
            .applyInArrow(fn, schema))


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs`` (``COLUMNS`` and more): its leaf, subroot, root, proof and the root its leaf folds to.

    ``altered`` maps columns to what a forger would put there (null: row as it is): the fold then starts from that row's leaf.
    """
    importable(docs.sparkSession)
    own = {c: F.col(f"`{c}`") for c in COLUMNS}
    forged = F.lit(None).cast("binary")
    if altered:
        changed = {c: F.coalesce(altered[c].cast("string"), own[c].cast("string")) if c in altered else own[c] for c in COLUMNS}
        forged = F.when(F.coalesce(*[v.cast("string") for v in altered.values()]).isNotNull(), leaf(changed))
    leaves = written(docs.select(tree_key(F.col("lang")).alias("tree"), "doc_id", leaf(own).alias("digest"), forged.alias("altered")), "merkle-leaves")
    nodes = written(numbered(leaves, ["doc_id", "digest"]), "merkle-numbered")
    rounds = build(nodes, chunk)
    subroots = written(roots(rounds).select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest"), "merkle-subroots")
    top_nodes = written(numbered(subroots, ["key"]), "merkle-subroots-numbered")
    top = build(top_nodes, chunk)
    nothing = F.lit(b"")
    root = roots(top).select("tree", F.lit(0).cast("long").alias("idx"), F.lit(None).cast("string").alias("key"), nothing.alias("codes"),
                             nothing.alias("siblings"), nothing.alias("states"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    top_paths = descend(top, root, _down_paths(chunk), _PATH, chunk)
    over = (top_paths.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("idx"), F.lit(None).cast("string").alias("key"),
                             "codes", "siblings", "states", "root")
            .join(roots(rounds).withColumnRenamed("digest", "subroot"), "tree"))
    return descend(rounds, written(over.select(*_PATH_ARROW.names), "merkle-over"), _fold(chunk), _FOLDED, chunk)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MOD == 0
    return manifest(docs, {"n_chars": F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1)})


_LEAF = "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in COLUMNS) + ")"
#: CRC-32 by its table; digits of the id are single bytes.
_CRC_TABLE = ("SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) "
              "ELSE c // 2 END, i)) AS crc_table")
_CRC = ("xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT), "
        "lambda c, b: xor(c // 256, crc_table[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)")
ORACLE = f"""
WITH RECURSIVE leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF} AS h, CASE WHEN {_CRC} % {TAMPER_MOD} = 0
        THEN {_LEAF.replace('n_chars', '(n_chars::DECIMAL(20,0) + 1)')} END AS altered FROM documents, ({_CRC_TABLE})),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
up(tree, lvl, idx, n, h) AS (SELECT tree, 0, idx, n, h FROM placed
    UNION ALL SELECT tree, any_value(lvl) + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, idx // 2),
subroots AS (SELECT tree, lvl AS top, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
above(lvl, idx, n, h) AS (SELECT 0, idx, n, h FROM subroots
    UNION ALL SELECT any_value(lvl) + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM above WHERE n > 1 GROUP BY idx // 2),
nodes AS (SELECT tree, lvl, idx, h FROM up WHERE n > 1 UNION ALL SELECT s.tree, s.top + a.lvl, a.idx, a.h FROM subroots s, above a),
steps AS (SELECT tree, top, idx AS sub_idx, (SELECT max(lvl) FROM above) AS more FROM subroots),
fold(tree, place, lvl, idx, h, proof) AS (SELECT tree, idx, 0, idx, coalesce(altered, h), '' FROM placed
    UNION ALL SELECT f.tree, f.place, f.lvl + 1, f.at // 2, sha256(CASE WHEN f.at % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), f.proof || coalesce(s.h, '')
    FROM (SELECT fold.*, CASE WHEN lvl = top THEN sub_idx ELSE idx END AS at FROM fold JOIN steps USING (tree) WHERE lvl < top + more) f
    LEFT JOIN nodes s ON s.tree = f.tree AND s.lvl = f.lvl AND s.idx = xor(f.at, 1))
SELECT p.doc_id, p.h AS leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified, p.idx AS position
FROM placed p JOIN subroots s USING (tree) JOIN steps t USING (tree) JOIN fold f ON f.tree = p.tree AND f.place = p.idx AND f.lvl = t.top + t.more,
    (SELECT h FROM above WHERE n = 1) r
"""

QUERIES = {"op13_merkle": op13_merkle}
ORACLES = {"op13_merkle": ORACLE}
