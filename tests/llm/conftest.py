"""Small tables with every awkward case, as Parquet folders that queries read."""

import os
import random
import tempfile

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, score string, position string, key string, "
        "h string, id string, fp string, row string, part string, batch string, start string, lang_pred string, word int")
LANGS = {"en": ("the of and to in is that for".split(), "ing er th on st re".split()),
         "de": ("der die und den nicht ist das mit".split(), "ung sch ei ich heit ver".split()),
         "fr": ("le la les des et que dans pour".split(), "eau eux oi tion que é".split())}


def sentence(rng, lang, n):
    common, parts = LANGS[lang]
    return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(n))


def documents(seed=1, n=60):
    """(doc_id, text, lang, source) rows: prose in three languages, copies, shared passages, and edge cases."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(LANGS))
        rows.append([i, sentence(rng, lang, rng.choice([3, 20, 80, 150])), lang, f"s{rng.randint(0, 3)}"])
    passage = sentence(rng, "en", 70)
    for i in (4, 9, 17, 33):
        rows[i][1] += " " + passage
    rows[12][1] = rows[5][1]
    rows[40][1] = rows[5][1]
    rows[41][1] = rows[6][1].replace(" ", "  \n\t") + "\r\n"
    odd = [None, "", " \n\t ", "word", "12 34 !!", "žluťoučký kůň 漢字", "a b  c", "x" * 300, "ß" * 40 + " É",
           "no. No, no\n\n\nno  'll '", "<|endoftext|> end", "\x00 \x01", sentence(rng, "de", 3000), "'" * 50, "the " * 20_000 + "end"]
    for text in odd:
        rows.append([len(rows), text, rng.choice([None, "en"]), rng.choice([None, "s0", "z"])])
    rows.append([None, "an id that is null in the table", "en", "s1"])
    rows.append([None, None, None, None])
    rows.append(list(rows[7]))                        # a repeated row
    rows.append([8, "another text under an id that is taken", "en", "s2"])
    return [tuple(r) for r in rows]


def embeddings():
    """Awkward vectors of four entries: null, short, null and non-finite entries, huge ones, copies and equal integers."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1), rng.gauss(0, 0.3), 0.5, rng.gauss(1, 2)]) for i in range(50)]
    rows += [(50 + i, [*rows[i][1]]) for i in range(20)] + [(80, [c + 1e-6 for c in rows[3][1]])]
    rows += [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [1.0, float("nan"), 2.0, 3.0]), (93, [1.0, 2.0, float("inf"), 3.0]), (94, []),
             (95, [1.0] * 5), (96, [1e300, 0.0, 0.0, 0.0]), (None, [0.0, 1.0, 0.5, -1.0]), (7, rows[7][1]), (97, [4000.0, -3000.25, 0.5, 1.0])]
    return rows


def conversations():
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a<turn>b"), (1, 2, "assistant", "second <and> \\ part"), (1, 3, "user", ""),
            (2, 1, "assistant", None), (2, 0, None, "no role"), (3, 5, "tool</turn>\n", "x <says> y\n</turn>\n"), (None, 0, "user", "lost"),
            (4, None, "user", "no turn"), (4, 0, "assistant", "é漢<\\/turn>"), (4, 0, "assistant", "same turn"), (4, 0, "assistant", "same turn"),
            (5, 0, "assistant", "x" * 100_000 + "<"), (-7, 9, "user", "more"), (6, 0, "", "empty role"), (6, 1, None, "joins it")]
    return rows + [(8, i, ("user", "assistant", "assistant")[i % 3], f"turn {i} <") for i in range(700)]


def write_tables(spark, folder, docs, benchmark=None, labels=None, pages=None, vectors=None, chats=None):
    spark.createDataFrame([(*r, "x", 1) for r in vectors or []], "vec_id long, embedding array<double>, key string, n int").repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(*r, "x", 1) for r in chats or []], "conv_id long, turn long, role string, text string, blocks string, loss int").repartition(3).write.parquet(f"{folder}/conversations.parquet")
    full = [(*r, None if r[1] is None else len(r[1]), *["x"] * 11, 7) for r in docs]
    spark.createDataFrame(full, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark or [], "item_id long, text string, doc_id string, w int").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels or [], "doc_id long, quality int, toxic int, text string").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(pages or [], "page_id long, url string, html string, kept string, type string").repartition(2).write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture(scope="session")
def odd_docs():
    return documents()


@pytest.fixture(scope="session")
def tables(spark, odd_docs):
    docs = odd_docs
    bench = [(1, docs[0][1], "d", 1), (2, " ".join(docs[3][1].split()[:30]), "d", 1), (3, None, "d", 1), (4, "", "d", 1), (5, "!!", "d", 1),
             (6, "word", "d", 1), (None, docs[10][1].upper(), "d", 1), (7, docs[0][1], "d", 1)]
    labels = [(i, 1, int(i % 3 == 0), "t") for i in range(40)] + [(3, 0, None, "t"), (None, 1, 1, "t"), (5, 1, 1, "t")]
    pages = [(i, f"http://h{i % 3}/p {i}", f"<p>{i % 7}</p>" * (i % 4), "k", "t") for i in range(40)]
    pages += [(100, None, None, "k", "t"), (101, " ", "", "k", "t"), (None, "http://x/", "<p>2</p><p>2</p>", "k", "t"), (None, "u", "only null ids", "k", "t"),
              (None, "u", "only null ids", "k", "t"), (102, "dns:é", "é" * 5000, "k", "t"), (39, "http://h0/p 39", "<p>4</p>" * 3, "k", "t")]
    return write_tables(spark, tempfile.mkdtemp(prefix="llm-tables-") + "/t", docs, bench, labels, pages, embeddings(), conversations())


@pytest.fixture(scope="session")
def empty_tables(spark):
    return write_tables(spark, tempfile.mkdtemp(prefix="llm-empty-") + "/t", [])


@pytest.fixture(scope="session")
def real():
    return os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")
