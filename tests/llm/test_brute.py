"""Results against plain single-process versions written from the contracts."""

import base64
import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
import regex
import xxhash

import __spark_entry__ as E
from farebox.llm import arc, decontaminate, ngrams, records, simhash, spotsigs, substrings, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def crc(doc_id, mod):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def rows_of(spark, tables, name):
    return E.queries()[name](spark, tables).collect()


def same(got, want):
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


# ---- 2 ---------------------------------------------------------------------------

def test_records_equal_whole_text_encoding(spark, tables, odd_docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(records.production_tokenizer())
    order = sorted(odd_docs, key=lambda r: (r[0] is None, r[0] or 0))
    got = sorted(map(tuple, rows_of(spark, tables, "op2_token_records")), key=lambda r: r[1])
    want = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for d, t, _, _ in order]
    assert [r[0] for r in got] == [d for d, _ in want]
    start = 0
    for r in got:
        assert r[1] == start
        start += r[2]
    pack = lambda ids: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    same([(r[0], r[2], r[3]) for r in got], [(d, *pack(ids)) for d, ids in want])


def test_pieces_equal_whole_texts():
    import random
    from tokenizers import Tokenizer
    path = records.production_tokenizer()
    library, codec, rng = Tokenizer.from_file(path), records.Encoder(path), random.Random(4)
    some = ["a", "B", "é", "1", " ", "  ", "\n", "\t", ",", ".", "'s", "ll", "'", "!", " \n", "\n\n", "　", "\x1c", "—", "x.", "y,", "<|endoftext|>"]
    for _ in range(4000):
        text = "".join(rng.choices(some, k=rng.randint(1, 12)))
        assert np.frombuffer(codec.batch([text])[0], codec.kind).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], text


def test_checksums_and_framing(tmp_path):
    assert records.crc32c(np.frombuffer(b"123456789", np.uint8), np.array([0, 9]))[0] == 0xE3069283
    payloads = [b"", b"a", b"abc", b"abcd", bytes(1023), bytes(1024), bytes(range(256)) * 20]
    data, index = records.frame(payloads)
    assert records.unframe(data) == (payloads, len(data))
    assert [data[o: o + n][12:-4] for o, n in index.tolist()] == payloads
    # the header and the check of it are TFRecord's
    assert data[:8] == (0).to_bytes(8, "little")
    crc32c = int(records.crc32c(np.zeros(8, np.uint8), np.array([0, 8]))[0])
    assert int.from_bytes(data[8:12], "little") == ((crc32c >> 15 | crc32c << 17) + 0xA282EAD8) % 2**32
    broken = bytearray(data)
    broken[-20] ^= 1
    with pytest.raises(ValueError):
        records.unframe(bytes(broken))


def test_shuffled_reads(spark, tables, odd_docs, tmp_path):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    manifest = records.write_records(docs, f"file://{tmp_path}/rec", records.production_tokenizer(), shard_bytes=2000).collect()
    assert len(manifest) > 3 and sum(r["records"] for r in manifest) == len(odd_docs)
    library, texts = Tokenizer.from_file(records.production_tokenizer()), collections.defaultdict(set)
    for d, t, _, _ in odd_docs:
        texts[d].add(tuple([*library.encode(t or "", add_special_tokens=False).ids, 0]))
    for r in manifest:
        for payload in records.read_at(r["path"], list(range(r["records"]))[::-1]):
            doc_id, ids = records.decode(payload, r["kind"])
            assert tuple(ids.tolist()) in texts[doc_id]


# ---- 3 ---------------------------------------------------------------------------

def plain_fingerprint(text, size=3):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(prints, bits=2):
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_simhash(spark, tables, odd_docs):
    prints = [plain_fingerprint(t) for _, t, _, _ in odd_docs]
    group = plain_components(prints)
    least = {g: min((d for (d, *_), h in zip(odd_docs, group, strict=True) if h == g and d is not None), default=None) for g in group}
    same(rows_of(spark, tables, "op3_simhash_dedup"), [(d, f"{p:016x}", least[g]) for (d, *_), p, g in zip(odd_docs, prints, group, strict=True)])


@pytest.mark.parametrize(("bits", "hot"), [(2, 64), (2, 3), (1, 64), (1, 2), (0, 64)])
def test_links_of_crowded_fingerprints(spark, bits, hot):
    import random
    rng, prints = random.Random(bits), set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(15):
            y = x
            for _ in range(rng.randint(0, 3)):
                y ^= 1 << rng.randrange(64)
            prints.add(y)
            x = y if rng.random() < 0.3 else x
    prints = sorted(prints)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    links = simhash.links(spark.createDataFrame([(signed(x),) for x in prints], "fp long"), bits, hot)
    root = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    want = collections.defaultdict(set)
    for x, g in zip(prints, plain_components(prints, bits), strict=True):
        want[g].add(root.get(signed(x), signed(x)))
    assert all(len(v) == 1 for v in want.values()) and len({next(iter(v)) for v in want.values()}) == len(want)


def test_golay_code():
    patterns, found = simhash.golay()
    assert collections.Counter(found.tolist()) == {1: 277, 6: 1771}      # 1 + 23 + 253 leaders of weight below 3
    codewords = [x for x in range(1 << 12)]
    encoded = [(m << 11) ^ int(simhash._remainder(np.array([m << 11]))[0]) for m in codewords]
    assert min(x.bit_count() for x in encoded if x) == 7


# ---- 4 ---------------------------------------------------------------------------

def plain_signatures(text):
    w, anchors = regex.findall(r"\p{L}+", (text or "").lower()), set(spotsigs.ANCHORS)
    content = [i for i, x in enumerate(w) if x not in anchors]
    return {tuple(w[j] for j in content[n:n + 2]) for n, i in enumerate(content) if i == 0 or w[i - 1] in anchors}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_spotsigs(spark, tables, odd_docs):
    order = sorted([r for r in odd_docs if r[0] is not None and r[0] != 8 and r[0] != 7], key=lambda r: r[0])
    folder = f"{tables}-spot"
    spark.createDataFrame([(r[0], r[1]) for r in order], "doc_id long, text string").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r for r in rows_of(spark, folder, "op4_spotsigs")}
    prints = {}
    for i, (d, t, *_) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r, own = got[d], plain_signatures(t)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(likeness(own, plain_signatures(edited)))
        assert r["near_next"] == pytest.approx(likeness(own, plain_signatures(after)))
        prints.setdefault(frozenset(own), set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in prints.values()) and len(set.union(*prints.values())) == len(prints)


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_similar_spotsigs(spark, tables, odd_docs, threshold):
    members, pairs = spotsigs.similar(spark.read.parquet(f"{tables}/documents.parquet"), threshold)
    fp = {frozenset(plain_signatures(t)) for _, t, _, _ in odd_docs} - {frozenset()}
    want = sum(likeness(a, b) >= threshold for a in fp for b in fp if a != b) // 2
    assert pairs.count() == want > 0 and members.count() == len(odd_docs)


def followers(rows):
    """(doc_id, text, next text) of plain rows; ids ascending, null last, one id's texts by their hash as Spark has it."""
    hashed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63) - (1 << 63)
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, r[0] or 0, hashed(r[1])))
    return [(d, t, order[(i + 1) % len(order)][1]) for i, (d, t) in enumerate(order)]


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_next_documents_with_null_and_repeated_ids(spark, odd_docs, ranges):
    rows = [(d, t) for d, t, *_ in odd_docs] + [(None, f"null id {i}") for i in range(40)] + [(5, f"id 5 again {i}") for i in range(40)]
    rows += [(-3, "below zero"), (-(1 << 63), "least"), ((1 << 63) - 1, "most"), (8, "\u6f22\U0001f600"), (None, "null id 7"), (5, "id 5 again 3")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, key string").repartition(5)
    same(spotsigs.with_next(docs, ranges).collect(), followers(rows))


def test_spotsigs_of_awkward_ids_equal_brute_force(spark, tables, odd_docs):
    want = []
    for d, t, after in followers([(d, t) for d, t, *_ in odd_docs]):
        edited = t[: len(t) - len(t) // 2] + after[:len(t) // 2]
        own = plain_signatures(t)
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(own, plain_signatures(edited)), 9), round(likeness(own, plain_signatures(after)), 9)))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows_of(spark, tables, "op4_spotsigs")]
    same(got, want)


def test_similar_spotsigs_in_a_large_group_of_near_copies(spark):
    """A third of all rows are near copies with sets of their own, as many again exact copies; all links are kept."""
    import random
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("bcdfgklmnprst", k=6))
    base = [word() for _ in range(80)]
    texts = [" ".join(f"the {word() if rng.random() < 0.06 else a} {b}" for a, b in zip(base[::2], base[1::2], strict=True)) for _ in range(400)]
    texts += [texts[0]] * 400 + [" ".join(f"of {word()} {word()}" for _ in range(rng.randint(1, 60))) for _ in range(400)]
    members, pairs = spotsigs.similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    sets = {frozenset(plain_signatures(t)) for t in texts}
    order = list(sets)
    want = sum(likeness(a, b) >= 0.8 for i, a in enumerate(order) for b in order[:i])
    assert pairs.count() == want > 20_000
    assert members.select("fp").distinct().count() == len(sets) and members.count() == len(texts)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 0.9])
def test_lengths_of_similar_sets_lie_in_neighbouring_ranges(spark, threshold):
    from pyspark.sql import functions as F
    span = [None] + [r[0] for r in spark.range(1, 3001).select(spotsigs.length_range(F.col("id"), threshold)).collect()]
    for n in range(1, 3001):
        smallest = max(1, -int(-(n * threshold - 1e-9) // 1))
        assert span[smallest] in (span[n], span[n] - 1)


# ---- 5 ---------------------------------------------------------------------------

def test_mixing_meets_targets(spark, tables, odd_docs):
    rows = rows_of(spark, tables, "op5_source_mixing")
    same([(r["doc_id"], r["size"]) for r in rows], [(d, len(words(t))) for d, t, _, _ in odd_docs])
    sizes, longest = collections.Counter(), collections.Counter()
    for _, t, _, s in odd_docs:
        sizes[s] += len(words(t))
        longest[s] = max(longest[s], len(words(t)))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goal, weight = dict.fromkeys(order, 0.0), {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free = 1.5 * sum(sizes.values()), set(order)
    while free:                           # share by weight; cap; share the excess again
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        for s in over or free:
            goal[s] = 2.0 * sizes[s] if over else level * weight[s]
            left -= goal[s]
        free -= over or free
    by_size = collections.defaultdict(int)
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * r["copies"]
        by_size[r["source_size"], round(r["target"], 6)] += r["taken"]
    for s in order:
        alike = [x for x in order if (sizes[x], round(goal[x], 6)) == (sizes[s], round(goal[s], 6))]
        assert abs(by_size[sizes[s], round(goal[s], 6)] - sum(goal[x] for x in alike)) <= sum(longest[x] for x in alike) / 2 + 1e-6
    again = rows_of(spark, tables, "op5_source_mixing")
    same(rows, again)


def test_positions_follow_the_schedules(spark):
    from pyspark.sql import functions as F
    from farebox.llm import mixing
    for place, knots in enumerate(mixing.SCHEDULES):
        got = [r[0] for r in spark.range(0, 101).select(mixing.position(F.lit(place), F.col("id") / 100)).collect()]
        t = np.linspace(0, 1, 20001)
        y = np.interp(t, *zip(*knots, strict=True))
        done = np.concatenate([[0], np.cumsum((y[1:] + y[:-1]) / 2)])
        assert np.allclose(got, np.interp(np.arange(101) / 100, done / done[-1], t), atol=2e-4)


# ---- 6 ---------------------------------------------------------------------------

@pytest.mark.parametrize("most, filed", [(decontaminate.MOST_BROADCAST, decontaminate.MOST_FILED), (decontaminate.MOST_BROADCAST, 0), (0, 0)])
def test_decontamination(spark, tables, odd_docs, most, filed):
    docs, bench = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): (r["first_word"], r["n_words"], r["similarity"]) for r in decontaminate.contaminated(docs, bench, most_broadcast=most, most_filed=filed).collect()}
    find, want = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower()), {}
    for item in bench.collect():
        w = find(item["text"])
        n, k = len(w), min(5, len(w))
        b = collections.Counter(" ".join(w[i:i + k]) for i in range(n - k + 1)) if n else {}
        for d, t, _, _ in odd_docs:
            x = find(t)
            for s in range(len(x) - n + 1 if n else 0):
                a = collections.Counter(" ".join(x[s + i:s + i + k]) for i in range(n - k + 1))
                like = (a & b).total() / (a | b).total()
                if like >= 0.8 and like > want.get((d, item["item_id"]), (0, 0, 0))[2]:
                    want[d, item["item_id"]] = (s, n, like)
    assert got == want and len(want) >= 5
    hit = {d for d, _ in want}
    assert sorted({r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} - {None}) == sorted({d for d, *_ in odd_docs} - hit - {None})


def test_near_item_is_found(spark):
    w = [f"word{i}" for i in range(60)]
    changed = [*w[:58], "other", "words"]
    docs = spark.createDataFrame([(1, "x y z " + " ".join(changed) + " tail"), (2, " ".join(w[:30])), (3, " ".join(w[::-1]))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(9, " ".join(w))], "item_id long, text string")).collect()
    # the best window of 60 words has 54 of 56 shingles, or shifts further; only document 1 is near
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, 9)] and got[0]["similarity"] == pytest.approx(54 / 58)


def item_shingles(w, n):
    k = min(5, n)
    return collections.Counter(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))


@pytest.mark.parametrize("most", [decontaminate.MOST_BROADCAST, 0])
def test_item_with_swapped_halves_is_found(spark, most):
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in (40, 50, 59, 100)}
    around = [f"other{i}" for i in range(70)]
    docs = {n: [*around[:n % 7], *w[n // 2:], *w[:n // 2], *around] for n, w in items.items()}
    want = {}
    for n, x in docs.items():
        for s in range(len(x) - n + 1):
            a, b = item_shingles(x[s:s + n], n), item_shingles(items[n], n)
            like = (a & b).total() / (a | b).total()
            if like >= 0.8 and like > want.get(n, (0, 0, 0))[2]:
                want[n] = (s, n, like)
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    texts = spark.createDataFrame([(n, " ".join(x)) for n, x in docs.items()], "doc_id long, text string")
    got = decontaminate.contaminated(texts, bench, most_broadcast=most).collect()
    assert {r["doc_id"]: (r["first_word"], r["n_words"], r["similarity"]) for r in got if r["doc_id"] == r["item_id"]} == want and len(got) == len(want) == 4
    assert decontaminate.clean(texts, bench, most_broadcast=most).count() == 0


@pytest.mark.parametrize("most", [decontaminate.MOST_BROADCAST, 0])
def test_documents_shorter_than_an_item(spark, most):
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in (5, 7, 16, 40, 59)}
    docs = {100 * n + c: w[:n - c] for n, w in items.items() for c in (1, 2, 3, 6, 12) if c < n}
    docs |= {100 * n + 50: w[1:] for n, w in items.items()} | {100 * n + 51: [*w[:n - 2], "other"] for n, w in items.items()}
    want = {}
    for d, x in docs.items():
        n = d // 100
        a, b = item_shingles(x, n), item_shingles(items[n], n)
        like = (a & b).total() / (a | b).total()
        if like >= 0.8:
            want[d, n] = (0, len(x), like)
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    texts = spark.createDataFrame([(d, " ".join(x)) for d, x in docs.items()], "doc_id long, text string")
    got = decontaminate.contaminated(texts, bench, most_broadcast=most).collect()
    assert {(r["doc_id"], r["item_id"]): (r["first_word"], r["n_words"], r["similarity"]) for r in got} == want and (4001, 40) in want and len(want) > 8
    assert {r["doc_id"] for r in decontaminate.clean(texts, bench, most_broadcast=most).collect()} == set(docs) - {d for d, _ in want}


# ---- 8 ---------------------------------------------------------------------------

def test_language_model(spark, tables, odd_docs):
    texts = [(d, [*WORD.findall(lower(t)), None]) for d, t, _, _ in odd_docs]
    count = collections.Counter(w for d, ws in texts if crc(d, 10) for w in ws)
    pair = collections.Counter(p for d, ws in texts if crc(d, 10) for p in zip([None, *ws], ws, strict=False))
    n, v = count.total(), len(count)
    once = sum(c == 1 for c in count.values()) / n
    bins = collections.defaultdict(lambda: [0, 0])
    for c in count.values():
        bins[int(math.log2(c))][0] += 1
        bins[int(math.log2(c))][1] += c
    kinds = lambda c: sum(k * (1 - (1 - m / k / n) ** c) for k, m in bins.values())
    p = lambda w: (1 - once) * count[w] / n if count[w] else once

    def log_p(u, w):
        if not count[u]:
            return math.log10(p(w))
        m = kinds(count[u]) / (kinds(count[u]) + count[u])
        return math.log10((1 - m) * pair[u, w] / count[u] + m * p(w))

    got = rows_of(spark, tables, "op8_lm_scoring")
    want = [(d, crc(d, 10) == 0, len(ws), sum(count[w] > 0 for w in ws), n) for d, ws in texts]
    same([tuple(r)[:5] for r in got], want)
    values = lambda rows: sorted(((r[0] is None, r[0] or 0, r[1], r[2]) for r in rows))
    model = [(d, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), sum(log_p(u, w) for u, w in zip([None, *ws], ws, strict=False))) for d, ws in texts]
    for a, b in zip(values((r["doc_id"], r["base_score"], r["score"]) for r in got), values(model), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9)
    # a proper distribution: the words, the end and one unknown class sum to one in every context
    context = next(w for w in count if count[w] > 5)
    assert sum(10 ** log_p(context, w) for w in [*count, b"\x01unknown"]) == pytest.approx(1)


def test_batches_of_any_size_agree(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    from pyspark.sql import functions as F
    a, b = (sorted(map(str, ngrams.score_texts(docs, F.col("doc_id") % 2 == 0, size).select("doc_id", "n_known", F.round("score", 6)).na.fill(-1).collect())) for size in (200, 1 << 30))
    assert a == b


# ---- 9 ---------------------------------------------------------------------------

def plain_repeats(rows, width=50):
    order = lambda d: math.inf if d is None else d
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            first[key] = min(first.get(key, math.inf), order(d))
    for d, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < order(d):
                gone[i:i + width] = [True] * width
        yield d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()


def test_substring_dedup(spark, tables, odd_docs):
    same(rows_of(spark, tables, "op9_substring_dedup"), plain_repeats(odd_docs))


def test_narrow_windows_and_small_batches(spark, tables, odd_docs):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    same(substrings.remove_repeats(docs, width=6, mer=2, batch_bytes=500).collect(), plain_repeats(odd_docs, 6))


def test_a_line_with_few_windows_in_each_slice_is_counted(spark):
    """One document a task: no slice has more windows of the hot line than one place gives, all together have many."""
    import random
    import pyarrow as pa
    rng = random.Random(5)
    low = lambda line: substrings.runs(substrings._hashes(pa.array([line])), 5).min()
    line = min((" ".join(f"hot{rng.randint(0, 999)}" for _ in range(10)) for _ in range(3000)), key=low)
    body = lambda: " ".join(f"w{rng.randint(0, 99999)}" for _ in range(60))
    rows = [(i, f"{body()} {line} {body()}") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(24, "doc_id")
    assert [len(k) for k in substrings.crowded(docs, 50, 5, 23 * 40)] == [1]
    assert substrings.crowded(docs, 50, 5, 24 * 46) == []
    # counted exactly: one key for each window of every text, equal windows of a slice once
    h = substrings._hashes(pa.array([rows[0][1]]))
    one = substrings.crowds(pa.array([rows[0][1]] * 30), 50, 5, [])
    starts = substrings.window_starts(np.array([len(h)]), 50)
    want = collections.Counter(substrings.minimisers(h, starts, 50, 5).view(np.int64).tolist())
    got = dict(zip(one["low"].to_pylist(), one["windows"].to_pylist(), strict=True))
    assert got.keys() == want.keys() and all(want[k] <= n <= 46 for k, n in got.items())


# ---- 10 --------------------------------------------------------------------------

def test_a_hot_line_is_spread_over_buckets(spark):
    import random
    import pyarrow as pa
    import zstandard
    rng = random.Random(3)
    low = lambda line: substrings.runs(substrings._hashes(pa.array([line])), 5).min()
    line = min((" ".join(f"hot{rng.randint(0, 999)}" for _ in range(10)) for _ in range(2000)), key=low)
    body = lambda: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(60))
    rows = [(i, f"{body()} {line} {body()}" if i % 3 == 0 else f"{body()} {body()}") for i in range(900)]
    shared = body()
    rows += [(900 + i, f"{body()} {line} {shared}") for i in range(40)]          # repeats among the crowded windows
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt, n = substrings._dealt(docs, 4_000)

    def largest(most):
        seen = collections.Counter()
        for r in substrings._packed(dealt, n, 50, 5, most).collect():
            meta = np.frombuffer(zstandard.decompress(r["meta"]), np.int64).reshape(-1, 6)
            seen[r["bucket"]] += int((meta[:, 4] - 49).sum())
        return max(seen.values()) / (sum(seen.values()) / n)

    # a bucket holds about 600 windows, and keys of up to 500 stay together
    assert largest(1 << 40) > 20 and largest(500) < 4
    for most in (500, 0):
        same(substrings.remove_repeats(docs, batch_bytes=4_000, most_windows=most).collect(), plain_repeats(rows))


@pytest.mark.parametrize("least", [0, 9])
def test_warc(spark, tables, tmp_path, least):
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    legacy = arc.write_arc(pages, f"file://{tmp_path}/arc", version=1 if least else 2)
    got = arc.read_warc(arc.convert(legacy, f"file://{tmp_path}/warc", least))
    rows, best = pages.collect(), {}
    for r in rows:
        h = (r["html"] or "").encode()
        if r["page_id"] is not None and len(h) >= least:
            best[h] = max(best.get(h, -1), r["page_id"])
    want = []
    for r in rows:
        h = (r["html"] or "").encode()
        to = best.get(h)
        to = None if to == r["page_id"] else to
        want.append((r["page_id"], len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if to is None else "revisit", to))
    same(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(), want)
    ids = [r[0] for r in got.select("record_id").collect()]
    assert len(set(ids)) == len(ids) and {r[0] for r in got.select("date").collect()} == {"2000-01-01T00:00:00Z"}


def test_arc_versions_and_types(tmp_path):
    http = b"HTTP/1.0 200 OK\nContent-Type: text/html\n\n<p>body</p>"
    v2 = arc.arc_version_block("two.arc", 2, "19970101000000") + arc.arc_record(2, "http://a/ b", "1.2.3.4", "19970102030405", "text/html", http) + b"\n"
    v2 += arc.arc_record(2, "dns:a", "1.2.3.4", "199701", "text/dns", b"a 1.2.3.4")
    for name, data in (("plain", v2), ("gzip", b"".join(arc._member(x) for x in (v2[:90], v2[90:])))):
        path = tmp_path / name
        path.write_bytes(data)
        got = [arc.describe(f, b, str(i)) for i, (f, b) in enumerate(arc.parse_arc(arc.Stream(str(path), chunk=7)))]
        assert [r["type"] for r in got] == ["warcinfo", "response", "resource"]
        assert (got[1]["uri"], got[1]["date"], got[1]["payload"]) == ("http://a/ b", "1997-01-02T03:04:05Z", b"<p>body</p>")
        assert got[2]["date"] == "1997-01-01T00:00:00Z" and got[2]["payload"] == b"a 1.2.3.4"
        assert got[1]["payload_digest"] == base64.b32encode(hashlib.sha1(b"<p>body</p>").digest()).decode()


# ---- SQL on the given tables -------------------------------------------------------

def test_oracles_on_given_tables(spark, real):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{real}/{t}.parquet')")
    for name in ("op5_source_mixing", "op6_decontamination"):
        df = E.queries()[name](spark, real)
        want = con.execute(E.oracle_sql()[name]).df()
        assert sorted(df.columns) == sorted(want.columns)
        same(df.select(*sorted(df.columns)).collect(), want[sorted(df.columns)].astype(object).where(want[sorted(df.columns)].notna(), None).itertuples(index=False))


# ---- 1 and 7: training -------------------------------------------------------------

def test_toxicity_gradients():
    import pyarrow as pa
    from farebox.llm.common import text_buffer
    t = toxicity.Texts(*text_buffer(pa.array(["a bad word here " * 9, "fine words only x", "one"])))
    net = toxicity.Network(t.hashes)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) * 3
    windows, y = np.arange(len(t.doc)), np.array([1.0, 0, 0, 1][: len(t.doc)])
    hide = np.zeros((len(windows), toxicity.WINDOW), bool)
    g = net.gradients(t, windows, y, hide)

    def loss():
        z = net.scores(t, windows).astype(float)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    for k, grad in g.items():
        at, value = ((int(grad[0][0]), 1), grad[1][0, 1]) if isinstance(grad, tuple) else (tuple(s // 2 for s in grad.shape), grad[tuple(s // 2 for s in grad.shape)])
        keep, step = net.p[k][at], 0.02
        net.p[k][at] = keep + step
        up = loss()
        net.p[k][at] = keep - step
        down = loss()
        net.p[k][at] = keep
        assert value == pytest.approx((up - down) / (2 * step), rel=0.1, abs=2e-4), k


def test_toxicity_windows_cover_and_overlap():
    doc, start = toxicity.window_starts(np.array([0, 5, 32, 33, 200]))
    for d, n in ((1, 5), (2, 32), (3, 33), (4, 200)):
        begin = [0, 0, 5, 37, 70][d]
        s = start[doc == d] - begin
        seen = sorted({i for a in s.tolist() for i in range(a, min(a + toxicity.WINDOW, n))})
        assert seen == list(range(n)) and (np.diff(s) < toxicity.WINDOW).all()
    assert not (doc == 0).any()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in rows_of(spark, sf, "op1_toxicity") if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in rows) / len(rows)
    assert right >= 0.85 and all(0 <= r["score"] <= 1 for r in rows)
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in rows_of(spark, sf, "op7_language_id") if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) / len(rows) >= 0.97


def test_crf_marginals():
    from farebox.llm import langid
    rng = np.random.default_rng(0)
    lengths, k = np.array([3, 0, 1, langid.BLOCK * 2 + 5, langid.BLOCK]), 3
    score, moves = rng.normal(size=(lengths.sum(), k)), rng.normal(size=(k, k))
    got, at = langid.marginals(score, moves, lengths), 0
    for n in lengths.tolist():
        e, a = np.exp(score[at:at + n]), np.exp(moves)
        f, b = np.zeros((n, k)), np.ones((n, k))
        for t in range(n):
            f[t] = e[t] * (f[t - 1] @ a if t else 1)
            f[t] /= f[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = a @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        want = f * b
        assert np.allclose(got[at:at + n], want / want.sum(axis=1, keepdims=True) if n else want)
        at += n


def test_code_switching(spark, real):
    """Runs of languages in spliced texts come out as runs."""
    from farebox.llm import langid
    from .conftest import sentence
    import random
    rng = random.Random(2)
    train = [(sentence(rng, lang, 60), lang) for lang in ("en", "de", "fr") for _ in range(40)]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    mixed = " ".join([sentence(rng, "en", 40), sentence(rng, "de", 50), sentence(rng, "fr", 30)])
    runs = langid.word_runs(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).orderBy("run").collect()
    assert [r["lang"] for r in runs] == ["en", "de", "fr"]
    assert all(abs(r["first_word"] - x) <= 2 for r, x in zip(runs, (0, 40, 90), strict=True))


def test_messages_go_to_own_buckets_only():
    import pyarrow as pa
    group = pa.table({"text": ["a b c", None], "training": [True, False], "batch": pa.array([4, 4], pa.int64())})
    asked = ngrams.ask(group, 1000).to_pylist()
    assert len(asked) <= 4 + 5 and {r["level"] for r in asked} == {1, 2}          # words and the end; pairs
    assert sum(len(r["keys"]) // 8 for r in asked) == 4 + 5


def test_traversal_carries_states(monkeypatch):
    """The automaton's arcs, one document and one token at a time, with and without blocks."""
    rng = np.random.default_rng(3)
    n_words, sizes = 12, np.array([1, 40, 3, 1, 17])
    words = rng.integers(0, n_words, sizes.sum())
    count = np.array([0.0, 0, *rng.integers(1, 30, n_words - 2)])
    context, word = (x.ravel() for x in np.meshgrid(np.arange(n_words), np.arange(n_words)))
    pairs = np.where((count[context] > 0) & (count[word] > 0), rng.integers(0, 3, len(word)), 0).astype(float)
    spectrum = np.zeros(2 * ngrams.BINS)
    of = np.log2(count[2:]).astype(int)
    spectrum[:ngrams.BINS] = np.bincount(of, minlength=ngrams.BINS)
    spectrum[ngrams.BINS:] = np.bincount(of, count[2:], ngrams.BINS)
    model = ngrams.Automaton(count, pairs, context, word, spectrum)
    arcs = {(int(a // n_words), int(a % n_words)): w for a, w in zip(model.arcs, model.weight, strict=True)}
    assert {(s - 1, w) for s, w in arcs} == {(c, w) for c, w, k in zip(context, word, pairs, strict=True) if k}
    want, at = [], 0
    for n in sizes.tolist():
        state, total = int(model.after[5]), 0.0
        for w in words[at: at + n].tolist():
            total += arcs.get((state, w), model.failure[state] + model.empty[w])
            state = int(model.after[w])
        want.append(total)
        at += n
    for block in (ngrams.BLOCK, 1, 7):
        monkeypatch.setattr(ngrams, "BLOCK", block)
        assert model.traverse(words, sizes, 5) == pytest.approx(want, rel=1e-12)


def test_a_table_of_one_repeated_row_scores_alike(spark):
    from pyspark.sql import functions as F
    rows = [(1, "one two three one two")] * 300 + [(2, "two words"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for size in (50, 1 << 30):
        got = collections.Counter(tuple(r) for r in ngrams.score_texts(docs, F.col("doc_id") == 2, size).select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("score", 6)).collect())
        assert sorted(got.values()) == [1, 1, 300] and all(k[3] == 300 * 6 + 1 for k in got)


def test_toxicity_learns_one_text_of_an_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, share: seen.append((texts, labels)) or 0.5)
    docs = spark.createDataFrame([(1, f"text {i % 9}") for i in range(400)] + [(2, "good"), (3, ""), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 1, 2, 3, 4)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, per_class=5)
    toxicity.fit(docs.repartition(7), labels, per_class=5)
    assert seen[0] == seen[1] and seen[0][1] == [1, 0] and len(seen[0][0]) == 2
