"""The pipeline, stage by stage, against plain versions over what the stage before kept."""

import collections
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import regex

import corpus_pipeline
from farebox.llm import decontaminate, langid, mixing, records
from farebox.llm.common import written

from .test_brute import item_shingles, plain_components, plain_fingerprint


def whole(rows):
    return collections.Counter(tuple(r) for r in rows)


def spoken(rows, model):
    """Each text alone: its language holds at least the share of its words."""
    for r in rows:
        names, scores = langid.score_batch(model, pa.array([r["text"]], pa.string()))
        if names[0] != langid.UNDETERMINED and scores[0] >= corpus_pipeline.MIN_SHARE:
            yield r


def firsts(rows):
    """(least id) of each group of near copies; null ids come last."""
    group = plain_components([plain_fingerprint(r["text"], corpus_pipeline.SHINGLE_WORDS) for r in rows], corpus_pipeline.MAX_BITS)
    order = lambda d: (d is None, d or 0)
    return [min((r["doc_id"] for r, h in zip(rows, group, strict=True) if h == g), key=order) for g in set(group)], len(set(group))


def leaks(text, items):
    find = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    x = find(text)
    for item in items:
        w = find(item)
        n = len(w)
        if not n or not x:
            continue
        b, k = item_shingles(w, n), min(5, n)
        for s in range(max(len(x) - n, 0) + 1):
            part = x[s:s + n]
            a = collections.Counter(" ".join(part[i:i + k]) for i in range(len(part) - k + 1))
            if a and (a & b).total() / (a | b).total() >= 0.8:
                return True
    return False


def copies(rows):
    """How often the mix takes each row, by the DuckDB statement of the mixing operator."""
    con = duckdb.connect()
    documents = pa.table({"doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "text": pa.array([r["text"] for r in rows], pa.string()),  # noqa: F841
                          "source": pa.array([r["source"] for r in rows], pa.string())})
    con.register("documents", documents)
    return collections.Counter({(d, n): c for d, n, c in con.sql(f"SELECT doc_id, size, sum(copies)::INT FROM ({mixing.ORACLE}) GROUP BY ALL").fetchall() if c})


def test_every_stage_and_the_whole(spark, tables):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = langid.fit(docs)
    kept = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, tables), name)
        kept[name] = docs.collect()
    # language: rows pass or go whole
    assert whole(kept["language_id"]) == whole(spoken(kept["documents"], model))
    assert 0 < len(kept["language_id"]) < len(kept["documents"])
    # near copies: one whole row of each group, of its smallest id
    least, groups = firsts(kept["language_id"])
    assert len(kept["near_dedup"]) == groups < len(kept["language_id"]) and whole(kept["near_dedup"]) <= whole(kept["language_id"])
    assert sorted(map(str, (r["doc_id"] for r in kept["near_dedup"]))) == sorted(map(str, least))
    # benchmark: clean rows stay whole, the others go
    items = [r["text"] for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    clean = [r for r in kept["near_dedup"] if not leaks(r["text"], items)]
    assert whole(kept["decontaminate"]) == whole(clean) and len(clean) < len(kept["near_dedup"])
    # mixing: whole rows as often as the plan says
    size = lambda r: len(regex.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode()))
    assert collections.Counter((r["doc_id"], size(r)) for r in kept["mix_sources"]) == copies(kept["decontaminate"])
    assert set(map(tuple, kept["mix_sources"])) <= set(map(tuple, kept["decontaminate"]))
    # token records: ids of whole texts, laid end to end by doc_id
    library = Tokenizer.from_file(records.production_tokenizer())
    pack = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 0]
    ids = [(r["doc_id"], pack(r["text"])) for r in kept["mix_sources"]]
    want = collections.Counter((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids)
    for rows in (kept["token_records"], corpus_pipeline.run(spark, tables).collect()):
        rows = sorted(rows, key=lambda r: r["start"])
        assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
        assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1].tolist()]
        named = [r["doc_id"] for r in rows if r["doc_id"] is not None]
        assert named == sorted(named)


def test_decontamination_sql_covers_documents_shorter_than_an_item():
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in (5, 7, 16, 40, 59)}
    docs = {100 * n + c: w[:n - c] for n, w in items.items() for c in (0, 1, 2, 3, 6, 12) if c < n}
    docs |= {100 * n + 50: w[1:] for n, w in items.items()} | {100 * n + 51: ["x", "y", *w, "z"] for n, w in items.items()}
    con, want = duckdb.connect(), {}
    con.register("documents", pa.table({"doc_id": list(docs), "text": [" ".join(w) for w in docs.values()]}))
    con.register("benchmark", pa.table({"item_id": list(items), "text": [" ".join(w) for w in items.values()]}))
    for d, x in docs.items():
        n = d // 100
        b = item_shingles(items[n], n)
        for s in range(max(len(x) - n, 0) + 1):
            a = item_shingles(x[s:s + n], n)
            like = (a & b).total() / (a | b).total()
            if like >= 0.8 and like > want.get((d, n), (0, 0, 0))[2]:
                want[d, n] = (s, min(len(x), n), like)
    got = con.sql(decontaminate.ORACLE).fetchall()
    assert {(d, i): tuple(r) for d, i, *r in got} == want and len(got) == len(want) and (4001, 40) in want and (4051, 40) in want
