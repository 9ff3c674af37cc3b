"""The training-data operators against brute force, libraries, round trips and held-out labels."""

import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from paperloom.llm import balltree, bpe, common, components, html_crf, labelled_pages, line_rules, mil_quality, packing, queries, simhash, similar, token_rollup, token_store, toxicity
from paperloom.llm.html_blocks import blocks_of
from paperloom.llm.tokens import LibraryEncoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["a", "b", " ", "  ", "\n", "é", "ß", "<|endoftext|>", "'s", "12", "!!", "日本", "İ", " ", "\t", "\x1c", "Σ", "é", "😀", "\x85", "the ", "Ing", "x" * 5, "***", "|", "<|startoftext|>", "<|"]


def docs_of(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", (sources or {}).get(i, "s"), len(t or "")) for i, t in enumerate(texts)], DOCS)


def odd_texts(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(n)]


EDGE = [None, "", " \n\t ", "one", "one two", "x" * 5000, "a b " * 3000, *odd_texts(40)]


def edge_table(spark):
    """Nulls in every column, repeated rows and ids, and columns whose names the operators use too."""
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(EDGE)] + [(None, None, None, None, None), (3, "one", "en", "s", 0), (3, "other", None, None, None), (None, "some words here", "en", None, 1)]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as fp", "'x' as score", "2 as kept", "3 as w", "'y' as host", "4 as ids", "5 as task", "6 as row")


# --- tokens ------------------------------------------------------------------------------------


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_memo_equals_library(path):
    library, memo = Tokenizer.from_file(path), LibraryEncoder(path)
    for text in [*odd_texts(3000), *(t for t in EDGE if t)]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(memo.ids(text), memo.dtype).tolist() == want, text[:80]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_rank_bpe_equals_library(text):
    text = text.encode("utf-8", "ignore").decode()
    library = test_rank_bpe_equals_library.__dict__.setdefault("t", Tokenizer.from_file(BYTE))
    own = bpe.vocabulary(BYTE)
    want = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == want
    assert own.decode(want) == library.decode(want, skip_special_tokens=False) == text


def test_long_words_merge_alike():
    own, r = bpe.vocabulary(BYTE), random.Random(5)
    for _ in range(200):
        word = bytes(r.choice(b"aabehinstr \xc3\xa9") for _ in range(r.randint(1, 100)))
        assert own.merge_short(word) == own.merge_long(word)
    assert len(own.encode("ab" * 50_000)) > 0


def test_op8(spark):
    table = edge_table(spark)
    library = Tokenizer.from_file(BYTE)
    got = sorted(map(repr, ((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digest(table, BYTE).collect())))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in table.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append(repr((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))))
    assert got == sorted(want)
    back = bpe.decode_documents(bpe.encode_documents(table.where("doc_id is not null"), BYTE), BYTE)
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((r["doc_id"], r["text"] or "") for r in table.where("doc_id is not null").collect())


def test_shard_round_trip():
    r, out = random.Random(1), io.BytesIO()
    docs = [(i if i % 7 else None, np.array([r.randrange(50_000) for _ in range(400_000 if i == 5 else r.choice((0, 1, 50, 3000)))], "<u2")) for i in range(60)]
    writer = token_store.ShardWriter(out, 2)
    for doc_id, ids in docs:
        writer.add(doc_id, ids.tobytes())
    writer.close()
    shard = token_store.ShardReader(out)
    assert shard.doc_ids == [d for d, _ in docs]
    for k in r.sample(range(60), 60):
        assert shard.read(k).tolist() == docs[k][1].tolist()
    alone = token_store.ShardReader(out)
    alone.read(59)
    assert alone.frames_read <= 1 < len(alone.sums)
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True) as whole:
        assert whole.read() == b"".join(x.tobytes() for _, x in docs)
    data = bytearray(out.getvalue())
    data[30] ^= 255
    with pytest.raises(Exception):  # noqa: B017
        token_store.ShardReader(io.BytesIO(bytes(data))).read(0)


def test_op1(spark):
    table = edge_table(spark)
    got = sorted(token_store.store_and_read(table, WORD).collect(), key=lambda r: r["start"])
    library = Tokenizer.from_file(WORD)
    rows = sorted(table.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, (r["text"] or "").encode()))
    start = 0
    assert len(got) == len(rows)
    for r, row in zip(got, rows, strict=True):
        ids = [*library.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
    assert token_store.store_and_read(table.limit(0), WORD).count() == 0


# --- packing -----------------------------------------------------------------------------------


def test_op10(spark):
    table = edge_table(spark)
    library = Tokenizer.from_file(BYTE)
    pieces = packing.pack(table, BYTE).collect()
    want = Counter((r["doc_id"], tuple([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0])) for r in table.collect())
    sizes = Counter()
    seen = {}
    for p in pieces:
        sizes[p["sequence_id"]] += p["length"]
        seen.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for runs in seen.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
    assert sorted(sizes) == list(range(len(sizes)))
    assert sum(sizes.values()) == sum(len(ids) * n for (_, ids), n in want.items())
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes.values())
    ids_of = {}
    for doc_id, ids in want:
        ids_of.setdefault((doc_id, len(ids)), []).append(ids)
    for p in pieces:
        assert any(zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4")) == p["ids_crc32"] for ids in ids_of[p["doc_id"], p["doc_tokens"]])
    assert packing.pack(table.limit(0), BYTE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=6), st.integers(0, 3), st.randoms())
def test_mixture_is_a_schedule(sizes, how, r):
    weights = None if how == 0 else [r.randint(0, 5) for _ in sizes]
    m = packing.Mixture(sizes, weights, window=700)
    taken = []
    for q, size in enumerate(sizes):
        at = 0
        while at < size:
            n = min(size - at, r.randint(1, 900))
            got = list(m.pieces(q, at, n))
            assert sum(x for _, x, _ in got) == n
            taken += [(place, x, q) for _, x, place in got]
            at += n
    taken.sort()
    assert [p for p, _, _ in taken] == np.concatenate([[0], np.cumsum([n for _, n, _ in taken])[:-1]]).tolist()
    if how == 0:  # each window holds the sources' shares to within a token
        for w in range(m.total // 700):
            for q, size in enumerate(sizes):
                assert abs(m.at(w + 1)[0][q] - (w + 1) * 700 * size / m.total) < 1


@pytest.mark.parametrize("how", ["own shares", "targets", "power", "few queues"])
def test_op10_pieces_and_mixture(spark, how):
    """The pieces of each document partition its ids; windows hold the target mixture while sources last, and sources without a queue of their own their proportions."""
    r = random.Random(11)
    sources = [None, "a", "b", "c", *(f"z{i}" for i in range(12))]
    rows, tokens = [], Counter()
    library = Tokenizer.from_file(BYTE)
    for i in range(500):
        source = sources[i % 4] if i % 3 else sources[4 + i // 3 % 12]
        text = " ".join(r.choices("alpha beta gamma delta epsilon".split(), k=r.randint(0, 1500)))
        rows.append((i, text, "en", source, 0))
        tokens[source] += len(library.encode(text, add_special_tokens=False).ids) + 1
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    targets = {"a": 3, None: 1, "z5": 1}
    options = {"own shares": {}, "targets": {"targets": targets, "max_queues": 8}, "power": {"power": 0.5}, "few queues": {"max_queues": 4}}[how]
    pieces = packing.pack(table, BYTE, **options).collect()
    of = {}
    for p in pieces:
        of.setdefault(p["doc_id"], []).append((p["start"], p["length"], p["doc_tokens"]))
    assert set(of) == set(range(500))
    for runs in of.values():
        at = 0
        for start, length, _ in sorted(runs):
            assert start == at and length > 0
            at += length
        assert at == runs[0][2]
    size, window = sum(tokens.values()), packing.WINDOW * packing.SEQUENCE
    assert sum(p["length"] for p in pieces) == size
    served = Counter()
    for p in pieces:
        served[p["window"], p["source"]] += p["length"]
    if how == "targets":
        first = {s: served[0, s] for s in sources}
        dry = [s for s in targets if first[s] == tokens[s]]
        fit = [s for s in targets if s not in dry]
        for x in fit:
            for y in fit:
                assert abs(first[x] / targets[x] - first[y] / targets[y]) <= len(sources)
    elif how == "own shares":
        # a window's place in the stream is off by less than a token a queue
        assert all(abs(served[0, s] - window * n / size) <= len(sources) for s, n in tokens.items())
    elif how == "power":
        weights = {s: n**0.5 for s, n in tokens.items()}
        going = [s for s in tokens if served[0, s] < tokens[s]]
        rates = [served[0, s] / weights[s] for s in going]
        assert max(rates) - min(rates) < 0.02 * max(rates)
    else:  # at least ten sources share a queue: each is served to within a document of its share
        assert all(abs(served[0, s] - window * n / size) < 2000 for s, n in tokens.items())


# --- SimHash -----------------------------------------------------------------------------------


def apart(a, b):
    """Differing bits of two fingerprints, given as lists of words."""
    return sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(a, b, strict=True))


def signed(words):
    return np.array([w & (1 << 64) - 1 for w in words], np.uint64).view(np.int64).tolist()


def groups_of(items, linked):
    """The least item of each item's connected group."""
    group = {x: x for x in items}

    def root(x):
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for i, x in enumerate(items):
        for y in items[:i]:
            if linked(x, y):
                a, b = root(x), root(y)
                group[max(a, b)] = min(a, b)
    return {x: root(x) for x in items}


@pytest.mark.parametrize("size, words", [(3, 1), (5, 4)])
def test_fingerprint_by_the_letter(size, words):
    import xxhash

    for text in ("", None, " \n", "a", "One two", "the cat sat on the Cat SAT on\x0bmat É É", "a b c " * 40, " ".join(f"w{i * i % 977}" for i in range(3000))):
        found = simhash.WORDS.findall((text or "").translate(simhash.LOWER))
        shingles = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))] if found else []
        hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
        got = simhash.fingerprint(text, size, words)
        for k in range(words):
            each = (simhash.mixed(hashes, k) if k else hashes).tolist()
            assert got[k] == (sum((sum(h >> b & 1 for h in each) * 2 > len(each)) << b for b in range(64)) if each else 0)


@pytest.mark.parametrize("cover", [simhash.CONTRACT, simhash.FINER])
def test_anchors_cover(cover):
    """Any two fingerprints within 3 bits meet at one's home, and every anchor is within radius plus threshold."""
    r = np.random.default_rng(0)
    fps = r.integers(-(2**63), 2**63 - 1, (30, 1))
    row, key, excess = simhash.anchors(fps, cover)
    assert (np.bincount(row[excess == 0]) == 1).all() and len(set(zip(row.tolist(), key.tolist(), strict=True))) == len(row)
    for i, (x,) in enumerate(fps.tolist()):
        mine = set(key[row == i].tolist())
        home = int(key[(row == i) & (excess == 0)][0])
        shift, bit, spans = sum(c.length for c in cover.codes), 0, []
        for c in cover.codes:  # the anchor's key holds its blocks in order, each of the fingerprint's next bits
            shift -= c.length
            spans.append((shift, bit, c))
            bit += c.length
        for a in (mine if i < 2 else ()):
            assert sum(max(0, bin((a >> s ^ x >> b) & (1 << c.length) - 1).count("1") - c.radius) for s, b, c in spans) <= 3
        for _ in range(20):
            y = x
            for b in r.choice(64, r.integers(0, 4), replace=False):
                y ^= 1 << int(b)
            _, k, e = simhash.anchors(np.array([signed([y])]), cover)
            assert home in k.tolist() and int(k[e == 0][0]) in mine


@pytest.mark.parametrize("cover, hot", [(simhash.CONTRACT, simhash.HOT), (simhash.CONTRACT, 7), (simhash.FINER, simhash.HOT)])
def test_links_by_brute_force(spark, cover, hot):
    r = np.random.default_rng(1)
    base = r.integers(-(2**63), 2**63 - 1, 30)
    fps = set(base.tolist())
    for x in base[:12]:
        for _ in range(25):  # a crowd around each: chains of links
            y = int(x)
            for b in r.choice(64, r.integers(1, 5), replace=False):
                y ^= 1 << int(b)
            fps.update(signed([y]))
    fps = sorted(fps)
    want = groups_of(fps, lambda x, y: apart([x], [y]) <= 3)
    distinct = spark.createDataFrame([(x,) for x in fps], "fp long")
    if hot < 100:  # hot anchors are dealt, and every pair still meets
        codes = [q["code"] for q in simhash.dealt(distinct, cover, hot, 1).select("code").distinct().collect()]
        assert {c & 3 for c in codes} == {0, 1, 2} and max(codes) >= 4
    edges = simhash.links(distinct, cover, hot, 1).toDF("a", "b")
    got = {q["node"]: q["root"] for q in components.components(edges).collect()}
    assert {x: got.get(x, x) for x in fps} == want


def test_forest():
    r = np.random.default_rng(7)
    for n in (2, 50, 400):
        a, b = r.integers(0, n, n), r.integers(0, n, n)
        x, y = simhash.forest(a, b)
        edges = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
        want = groups_of(range(n), lambda i, j: (min(i, j), max(i, j)) in edges)  # noqa: B023
        assert dict(zip(x.tolist(), y.tolist(), strict=True)) == {i: root for i, root in want.items() if i != root}
    assert len(simhash.forest(np.zeros(0, int), np.zeros(0, int))[0]) == 0


def test_op2(spark):
    table = edge_table(spark)
    rows = table.collect()
    fp = [simhash.fingerprint(r["text"]) for r in rows]
    comp = groups_of(range(len(rows)), lambda i, j: apart(fp[i], fp[j]) <= 3)
    want = Counter()
    for i, r in enumerate(rows):
        ids = [rows[j]["doc_id"] for j in range(len(rows)) if comp[j] == comp[i] and rows[j]["doc_id"] is not None]
        want[r["doc_id"], f"{fp[i][0]:016x}", min(ids) if ids else None] += 1
    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(table).collect())
    assert got == want
    assert simhash.near_duplicates(table.limit(0)).count() == 0


def shingles_of(text, size=5):
    w = simhash.WORDS.findall((text or "").translate(simhash.LOWER))
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b):
    x, y = shingles_of(a), shingles_of(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_lightest_forest():
    r = np.random.default_rng(3)
    for n, m in ((1, 0), (2, 1), (30, 20), (30, 200), (200, 900)):
        a, b, w = r.integers(0, n, m), r.integers(0, n, m), r.integers(0, 9, m)
        keep = similar.lightest_forest(a, b, w)
        label, total = list(range(n)), 0
        for x, y, z in sorted(zip(w.tolist(), a.tolist(), b.tolist(), strict=True)):
            if label[y] != label[z]:
                old, total = label[z], total + x
                label = [label[y] if v == old else v for v in label]
        assert w[keep].sum() == total and len(keep) == n - len(set(label))
        again = groups_of(range(n), lambda i, j, e=set(zip(a[keep].tolist(), b[keep].tolist(), strict=True)): (i, j) in e or (j, i) in e)
        assert len(set(again.values())) == len(set(label))


def numbered_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    fps = simhash.fingerprints(docs.withColumn("row_key", simhash.row_key()), simhash.SIMILAR, "row_key")
    nodes = fps.groupBy(*simhash.SIMILAR.names, "row_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("least"))
    return docs, common.stored(nodes.withColumn("number", F.col("least.doc_id")), "nodes")


def test_links_are_verified(spark):
    """Pairs from 0.6 up: none below 0.8 is linked, nearly all above are; a large group of near copies costs fewer pairs than its square."""
    r = random.Random(12)
    vocabulary = ["".join(r.choices("abcdefghij", k=5)) for _ in range(400)]
    texts, pairs = [], []
    for k in range(240):
        words = r.choices(vocabulary, k=250)
        other = list(words)
        for at in r.sample(range(250), 2 + k % 12):
            other[at] = "changed"
        pairs.append((2 * k, 2 * k + 1))
        texts += [" ".join(words), " ".join(other)]
    values = {p: jaccard(texts[p[0]], texts[p[1]]) for p in pairs}
    base = r.choices(vocabulary, k=250)
    group = []
    for _ in range(300):
        near = list(base)
        near[r.randrange(250)] = "changed"
        group.append(" ".join(near))
    group = list(dict.fromkeys(group))
    same = " ".join(["same"] * 300)  # the same fingerprint, as over half the shingles are one
    odd = [f"{same} {' '.join(r.choices(vocabulary, k=250))}" for _ in range(2)]
    docs, nodes = numbered_texts(spark, texts + group + odd + ["", None, "one two", "One  two", "one three"])
    edges = similar.candidates(nodes).count()
    links = [(x["a"], x["b"]) for x in similar.links(docs, nodes).collect()]
    every = texts + group + odd + ["", None, "one two", "One  two", "one three"]
    assert all(jaccard(every[a], every[b]) >= 0.8 for a, b in links)
    root = groups_of(range(len(every)), lambda i, j, e=set(links): (j, i) in e)
    found = {p: root[p[0]] == root[p[1]] for p in pairs}
    low, high = [found[p] for p in pairs if values[p] < 0.8], [found[p] for p in pairs if values[p] >= 0.8]
    assert len(low) > 60 and not any(low) and len(high) > 60 and np.mean(high) >= 0.9
    assert np.mean([found[p] for p in pairs if values[p] >= 0.9]) > 0.97
    members = range(len(texts), len(texts) + len(group))
    assert len({root[i] for i in members}) == 1 and edges < 20 * len(every)
    n = len(texts) + len(group)
    assert root[n] != root[n + 1] and root[n + 3] == root[n + 2] and root[n + 5] == root[n + 4] != root[n + 6]


def test_links_do_not_hang_on_candidates(spark, monkeypatch):
    """Where anchors show nothing, all texts of 0.8 and more are joined still, frequent shingles and blank texts too, and no others."""
    r = random.Random(4)
    texts = ["", " ", None, "one two", "One  two", "one three", " ".join(["same"] * 40), " ".join(["same"] * 50)]
    often = " ".join(f"o{i}" for i in range(60))
    for k in range(30):
        words = [f"w{r.randrange(900)}" for _ in range(r.choice([30, 90, 200]))]
        other = list(words)
        for at in r.sample(range(len(words)), 1 + k % 8):
            other[at] = "changed"
        texts += [" ".join(words), " ".join(other), f"{often} {' '.join(words[: 1 + k])}"]
    docs, nodes = numbered_texts(spark, texts)
    monkeypatch.setattr(similar, "candidates", lambda nodes, *_: nodes.select(F.col("number").alias("a"), F.col("number").alias("b"), F.lit(0).alias("bits")).limit(0))
    monkeypatch.setattr(similar, "TOLD_BY", 1)
    links = {(x["a"], x["b"]) for x in similar.links(docs, nodes).collect()}
    numbers = sorted(x["number"] for x in nodes.collect())
    assert links == {(a, b) for a in numbers for b in numbers if a < b and jaccard(texts[a] or "", texts[b] or "") >= 0.8} and len(links) > 40


def test_links_grow_with_a_group_not_its_square(spark, monkeypatch):
    """Where all pairs of a group are candidates and alike, a few links for each text join it whole; a text that is alike to few is joined too."""
    r = random.Random(9)
    base = [f"w{r.randrange(5000)}" for _ in range(200)]
    texts = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in range(160)]
    texts += [" ".join(f"v{r.randrange(5000)}" for _ in range(200)) for _ in range(3)]
    docs, nodes = numbered_texts(spark, texts)
    pair = nodes.select(F.col("number").alias("a")).crossJoin(nodes.select(F.col("number").alias("b"))).where("a < b")
    monkeypatch.setattr(similar, "candidates", lambda nodes, *_: pair.withColumn("bits", F.pmod(F.xxhash64("a", "b"), F.lit(40)).cast("int")))
    links, roots = similar.joined(docs, nodes)
    assert links.count() <= (similar.NEXT + 1) * len(texts)
    assert all(jaccard(texts[x["a"]], texts[x["b"]]) >= 0.8 for x in links.collect())
    assert {x["node"]: x["root"] for x in roots.collect()} == dict.fromkeys(range(160), 0)


def test_texts_alike_by_less_stay(spark, sf_dir):
    """Documents of a similarity from 0.6 to 0.79 all stay; of one from 0.9 one goes."""
    r = random.Random(5)
    rows, want = [], []
    for k in range(40):
        words = [f"w{r.randrange(5000)}" for _ in range(200)]
        other = list(words)
        for at in r.sample(range(200), 2 if k < 10 else 10):
            other[at] = "changed"
        j = jaccard(" ".join(words), " ".join(other))
        assert j >= 0.9 if k < 10 else 0.5 < j < 0.8
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        want += [2 * k] if k < 10 else [2 * k, 2 * k + 1]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    assert sorted(x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()) == want


def test_similar_texts_meet(spark):
    """Texts that share 0.8 and more of their five-word shingles: most pairs are found, from 0.9 on nearly all; others are not."""
    r = random.Random(12)
    vocabulary = ["".join(r.choices("abcdefghij", k=5)) for _ in range(400)]
    shingles = lambda t: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    texts, pairs = [], []
    for k in range(160):
        words = r.choices(vocabulary, k=250)
        other = list(words)
        for at in r.sample(range(250), 2 + k % 5):
            other[at] = "changed"
        one, two = " ".join(words), " ".join(other)
        a, b = shingles(one), shingles(two)
        pairs.append((2 * k, 2 * k + 1, len(a & b) / len(a | b)))
        texts += [one, two]
    fps = {signed(simhash.fingerprint(t, 5, 4))[0]: i for i, t in enumerate(texts)}
    distinct = spark.createDataFrame([(*signed(simhash.fingerprint(t, 5, 4)),) for t in texts], "fp0 long, fp1 long, fp2 long, fp3 long")
    found = {tuple(sorted((fps[e["a0"]], fps[e["b0"]]))) for e in simhash.links(distinct, simhash.SIMILAR).collect()}
    assert found <= {(a, b) for a, b, _ in pairs}
    rate = lambda low: np.mean([(a, b) in found for a, b, j in pairs if j >= low])
    assert min(j for *_, j in pairs) < 0.83 and rate(0.8) > 0.85 and rate(0.9) > 0.97


# --- quality -----------------------------------------------------------------------------------


def test_attention_gradient():
    r = np.random.default_rng(0)
    m = mil_quality.GatedAttention(1)
    x, starts, y = r.normal(size=(9, mil_quality.FEATURES)), np.array([0, 2, 5]), np.array([1.0, 0, 1])
    loss = lambda: -np.mean(y * np.log(m.forward(x, starts)[0]) + (1 - y) * np.log(1 - m.forward(x, starts)[0]))
    for k, g in m.gradient(x, starts, y).items():
        i = tuple(r.integers(0, n) for n in g.shape)
        old = m.p[k][i]
        m.p[k][i] = old + 1e-6
        up = loss()
        m.p[k][i] = old - 1e-6
        down = loss()
        m.p[k][i] = old
        assert abs((up - down) / 2e-6 - g[i]) < 1e-6


def test_op3_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op3_attention_quality(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got)
    good, bad = [r["score"] for r in got if r["quality"]], [r["score"] for r in got if not r["quality"]]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.93


def test_op3_edges(spark):
    table = edge_table(spark)
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    got = mil_quality.score_documents(table, labels).collect()
    assert len(got) == table.count() and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    # Null, empty and blank texts are one passage of zeros; repeated rows score alike; a long text has all its passages.
    assert len({by[i][0]["score"] for i in (0, 1, 2)}) == 1 and by[0][0]["passages"] == 1
    assert sorted(r["score"] for r in by[3])[0] == sorted(r["score"] for r in by[3])[1] or len({r["score"] for r in by[3]}) == 2
    assert by[6][0]["passages"] == -(-6000 // mil_quality.PASSAGE)
    assert [r["held_out"] for r in by[None]] == [False, False]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, rows in by.items() if i is not None for r in rows)
    none = mil_quality.score_documents(table, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert mil_quality.score_documents(table.limit(0), labels).count() == 0


def brute_metrics(text):
    text = text or ""
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    places = {p for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(places)


def test_op4(spark):
    prose = lambda k, n=60: " ".join(f"w{k}x{i}" for i in range(n))
    line = "Share this page with your many friends"
    texts = [*EDGE, *(f"{line}\n{prose(k)}" for k in range(30)), *([f"{line}\n" * 9 + prose(99, 8)]), *([f"{line}\n{prose(7)}"] * 5), "a b c d a b c # #\nx\nx\n \nx"]
    table = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in line_rules.verdicts(table).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_metrics(t), i
        n, _, _, _, again = brute_metrics(t)
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
        lost = 7 * (t or "").count(line)
        assert r["n_removed_words"] == lost
        assert r["kept"] == (not r["base_failed"] and not (lost and (n - lost < 50 or n - lost < 0.5 * n)))
    kept = {r["doc_id"]: r for r in line_rules.cleaned(table).collect()}
    assert set(kept) == {i for i, r in got.items() if r["kept"]}
    assert all(line not in r["text"] and r["n_chars"] == len(r["text"]) for r in kept.values())
    edges = edge_table(spark)
    by_row = lambda r: repr((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]))
    assert sorted(map(by_row, line_rules.verdicts(edges).collect())) == sorted(repr((r["doc_id"], *brute_metrics(r["text"]))) for r in edges.collect())
    # Rows without a source are a host of their own: 30 of its 31 documents hold the line, and none of the others.
    nameless = spark.createDataFrame([(k, f"{line}\n{prose(k)}" if k < 30 else prose(k), "en", None if k < 31 else "h", 0) for k in range(40)] + [(50, f"{line}\n{prose(50)}", "en", "h", 0)], DOCS)
    assert {r["doc_id"]: r["n_removed_words"] for r in line_rules.verdicts(nameless).collect()} == {k: 7 * (k < 30) for k in [*range(40), 50]}
    # Copies under different ids are documents each; a repeated row is one; by texts all of them are one.
    copies = spark.createDataFrame([(k, f"{line}\n{prose(1)}", "en", "h", 0) for k in range(30)] + [(40 + k, prose(40 + k), "en", "h", 0) for k in range(40)] + [(99, f"{prose(99)}\nother line", "en", "h", 0)] * 30 + [(None, f"third\n{prose(5)}", "en", "h", 0)] * 30, DOCS)
    assert {r["doc_id"]: r["n_removed_words"] for r in line_rules.verdicts(copies).collect()} == {**{k: 67 for k in range(30)}, **{40 + k: 0 for k in range(40)}, 99: 0, None: 0}
    assert {r["n_removed_words"] for r in line_rules.with_verdict(copies, by_text=True).collect()} == {0} and line_rules.cleaned(copies).count() == copies.count()
    assert line_rules.cleaned(edges).columns == edges.columns
    assert line_rules.verdicts(edges.limit(0)).count() == 0


def test_op4_is_native(spark, sf_dir):
    plan = queries.op4_line_frequency(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- search ------------------------------------------------------------------------------------


def brute_top_k(rows, k=5):
    """Each query (id and vector) with its best (score, id) in order."""
    good = [(i, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for q, v in {x for x in good if x[0] % 50 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))[:k]
        if best:
            want[q, tuple((-s, i) for s, i in best)] += 1
    return want


def got_top_k(df):
    by = {}
    for x in df.collect():
        by.setdefault((x["query"], x["query_id"]), {})[x["rank"]] = (x["score"], x["vec_id"])
    assert all(sorted(b) == list(range(1, len(b) + 1)) for b in by.values())
    return Counter((q, tuple(b[r] for r in sorted(b))) for (_, q), b in by.items())


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40}, {"shard_rows": 60, "part_rows": 25, "block_rows": 3}])
def test_op5(spark, sizes):
    """Odd rows, repeated ids with different and equal vectors, ties, and a third of all rows equal."""
    r = np.random.default_rng(2)
    centres = 3 * r.normal(size=(6, 8))
    rows = [(i, [float(x) for x in (centres[i % 6] + r.normal(size=8)).astype(np.float32)]) for i in range(700)]
    rows += [(1000 + i, rows[11][1]) for i in range(350)]
    rows += [(700, None), (750, [None] * 8), (800, [float("nan")] * 8), (850, [float("inf")] * 8), (900, [1.0, 2.0]), (950, [1.0, 1.0]), (100, rows[3][1]), (100, rows[100][1]), (None, rows[4][1]), (1400, []), (1450, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as shard", "3 as query", "4 as to")
    assert got_top_k(balltree.top_k(table, **sizes)) == brute_top_k(rows)
    assert balltree.top_k(table.limit(0)).count() == 0


def test_op5_large_integers(spark):
    """Scores beyond 2^53 stay exact."""
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.integers(-(10**6), 10**6, 4)]) for i in range(120)]
    assert got_top_k(balltree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))) == brute_top_k(rows)
    tree = balltree.BallTree(np.arange(300), r.integers(-(10**8), 10**8, (300, 4)), leaf=10)
    assert (10**8) ** 2 * 4 > balltree.EXACT
    q = r.integers(-(10**8), 10**8, (5, 4))
    there, scores, ids = tree.search(np.full(5, -1), q, np.full(5, -np.inf), 3)
    every = q @ tree.points.T
    assert there.all() and all(scores[i].tolist() == sorted(every[i].tolist())[:-4:-1] for i in range(5))


def test_op5_prunes():
    """Leaves whose bound lies below the kth score aren't scored: with clusters most are left out."""
    r = np.random.default_rng(5)
    points = np.concatenate([1000 * r.normal(size=(1, 16)) + 5 * r.normal(size=(500, 16)) for _ in range(20)]).astype(np.int64)
    tree, scored = balltree.BallTree(np.arange(len(points)), points, leaf=50), [0]

    class Counting(np.ndarray):
        def __getitem__(self, k):
            if isinstance(k, slice):
                scored[0] += 1
            return np.asarray(self)[k]

    tree.ids = tree.ids.view(Counting)
    there, scores, _ = tree.search(np.full(4, -1), points[:4], np.full(4, -np.inf), 5)
    assert (scores == np.sort(points[:4] @ points.T, axis=1)[:, :-6:-1]).all() and there.all()
    assert 0 < scored[0] < len(tree.spans) / 3
    # Inner nodes are closed by the kth score of the first leaf, in the first round already.
    assert tree.opened < 4 * sum(len(radii) for _, radii, _ in tree.balls) / 3


# --- pages -------------------------------------------------------------------------------------


def test_crf_by_brute_force():
    from itertools import product

    r = np.random.default_rng(3)
    crf = html_crf.Crf()
    crf.pairs, crf.ends = r.normal(size=(2, 2)), r.normal(size=2)
    for n in (1, 2, 6):
        s = r.normal(size=(n, 2))
        value = lambda y: crf.ends[y[0]] + sum(s[i, y[i]] for i in range(n)) + sum(crf.pairs[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        paths = list(product((0, 1), repeat=n))
        assert tuple(crf.viterbi(s)) == max(paths, key=value)
        weight = np.exp([value(y) for y in paths])
        single, _ = crf.marginals(s)
        assert np.allclose(single[:, 1], [sum(w for y, w in zip(paths, weight, strict=True) if y[i]) / weight.sum() for i in range(n)])


def test_op6_on_pages(spark, sf_dir):
    import html
    import re

    got = {r["page_id"]: r for r in queries.op6_html_crf(spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want)


def test_op6_held_out_pages(page_model):
    """Pages that the model hasn't seen, of the generator it was fitted on; all of one stream, so that they differ."""
    model, source = page_model, labelled_pages.Pages(777)
    pages = [source.page() for _ in range(500)]
    assert len(set(pages)) == 500
    wrong = total = 0
    for names, labels in html_crf.labelled(pages):
        wrong += sum(a != b for a, b in zip(model.viterbi(model.scores(names)), labels, strict=True))
        total += len(labels)
    assert wrong < 0.01 * total


PLAIN_PAGES = [
    ("<article><p>Good story text.</p> more</article>", "Good story text. more"),
    ("<html><body><p>One plain paragraph of text here.</p><p>And the second one follows it.</p></body></html>", "One plain paragraph of text here. And the second one follows it."),
    ("<body><div id='story'><p>The story begins here and goes on.</p><p>It ends.</p></div></body>", "The story begins here and goes on. It ends."),
    ("<body><article><p>Single paragraph article.</p></article></body>", "Single paragraph article."),
    ("<body><article><p>Text before <svg><path d='M0'/></svg> and after.</p></article></body>", "Text before and after."),
    ("<p>Only this.</p>", "Only this."),
    ("Just words without a tag.", "Just words without a tag."),
    ("<body><h1>A title</h1><p>First.</p><p>Second.</p></body>", "A title First. Second."),
    ("<body><div><div><p>Deep text of a page in plain boxes.</p><p>Again some text here.</p></div></div></body>", "Deep text of a page in plain boxes. Again some text here."),
    ("<body><nav><a href=/>Home</a> <a href=/b>Blog</a></nav><p>Some text that is the page.</p><p>More of that text.</p><footer>&copy; 2020 Site</footer></body>", "Some text that is the page. More of that text."),
    ("<body><div class='cookie-notice'>We use cookies. <button>OK</button></div><div class='post-content'><h1>Title here</h1><p>Body text one.</p><ul><li>item one</li><li>item two</li></ul></div><div class='comments'><h3>Comments</h3><p>I liked it a lot.</p></div></body>", "Title here Body text one. item one item two"),
    ("<body><header><h1>Site name</h1></header><main><h2>Heading</h2><p>Main text of this page, with <a href=/x>a link</a> in it.</p></main><aside><h3>Related</h3><ul><li><a href=/1>One</a></li></ul></aside></body>", "Heading Main text of this page, with a link in it."),
    ("<body><div><a href=/>Home</a> | <a href=/n>News</a></div><div><h1>Tram</h1><p>The council voted on Tuesday to extend the line to the harbour.</p><p>Residents said that they would appeal.</p></div><div>Copyright 2024</div></body>", "Tram The council voted on Tuesday to extend the line to the harbour. Residents said that they would appeal."),
    ("<body><table><tr><td class='menu'><a href=/>Home</a><br><a href=/n>News</a></td><td class='content'><h1>Tram</h1><p>The council voted on Tuesday to extend the line.</p><p>Residents would appeal.</p></td></tr></table></body>", "Tram The council voted on Tuesday to extend the line. Residents would appeal."),
    ("<body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>Shop</a></li></ul></nav><footer>Copyright</footer></body>", ""),
]


@pytest.fixture(scope="module")
def page_model():
    return html_crf.default_model()


def test_op6_plain_pages(page_model):
    for page, want in PLAIN_PAGES:
        assert html_crf.main_text(page_model, page) == want


def test_op6_deep_and_odd_pages(page_model):
    """Time grows with the page's length whatever its depth; references don't reach over tags; table and heading ends."""
    import time

    texts = lambda page: [b.text for b in blocks_of(page)]
    assert texts("<p>AT&am<b>p;</b> x&amp;y &lt;b&gt;</p>") == ["AT&am" + "p; x&y <b>"]
    assert texts("<h2>one</h3><p>two") == ["one", "two"] and [b.node.tag for b in blocks_of("<h2>one</h3><p>two")] == ["h2", "p"]
    rows = blocks_of("<table><tr><td>a<td>b<tr><td>c</table>d")
    assert [(b.text, [t for t, _ in b.path]) for b in rows] == [("a", ["table", "tr", "td"]), ("b", ["table", "tr", "td"]), ("c", ["table", "tr", "td"]), ("d", [])]
    began = time.time()
    for page in ("<div class='a b'>x " * 50_000, "".join(f"<div class='w{i}'><li>x</i>" for i in range(30_000)), "<noscript>" * 50_000 + "x", "<button>x" * 20_000):
        html_crf.main_text(page_model, page)
    assert time.time() - began < 60
    assert len(html_crf.main_text(page_model, "<article><p>" + "word and word. " * 200_000 + "</p></article>")) > 2_900_000


def test_op6_edges(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>unclosed <b>one<p>two &amp; &am &#233;"), (3, "u", "<<<>>> <a href='"), (3, "u", "plain &lt;text&gt;")], "page_id long, url string, html string").selectExpr("*", "1 as text")
    got = html_crf.extract(pages).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_crf.extract(pages.limit(0)).count() == 0
    assert [b.text for b in blocks_of("<div>a<br>b <i>c</i>&nbsp;d<script>x</script><ul><li>e<li>f</ul></div>")] == ["a b c d", "e", "f"]


def test_op6_drops_raw_text_only(page_model):
    texts = lambda page: [b.text for b in blocks_of(page)]
    for icon in ('<svg class="i" />', "<svg/>", "<math/>", '<svg a="b"/>', "<svg><path d='M0'/></svg>", "<svg><style/><path></svg>", "<svg><svg></svg></svg>"):
        assert texts(f"<article><p>one {icon} two</p><p>three</p></article>") == ["one two", "three"]
    for tag in ("select", "object", "canvas", "audio", "video", "svg", "math", "noscript", "template"):
        assert texts(f"<article><p>one</p><{tag}><p>two</p><p>three</p></article><p>four</p>") == ["one", "two", "three", "four"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x = 2 holds"]
    assert texts("<p>one</p><object data=a><p>fallback</p></object><p>two</p>") == ["one", "fallback", "two"]
    assert texts("<p>one <svg width=5/><text>label</text></svg> two</p>") == ["one label two"]
    for tag in ("script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"):
        assert texts(f"<p>one</p><{tag}>x <p>y</{tag}><p>two</p>") == ["one", "two"]
        assert texts(f"<p>one</p><{tag}>x <p>two</p>") == ["one"]
    assert texts("<p>one</p><noscript>x</noscript><template><p>y</p></template><p>two</p>") == ["one", "two"]
    model = page_model
    page = labelled_pages.Pages(5).page().replace(labelled_pages.MARK, "")
    want = html_crf.main_text(model, page)
    assert want and html_crf.main_text(model, page.replace("<body>", '<body><svg class="icon"/>')) == want


# --- toxicity ----------------------------------------------------------------------------------


def test_ordinal_gradient_and_order():
    r = np.random.default_rng(4)
    rows = [([int(i) for i in np.flatnonzero(r.random(5) < 0.4)], float(r.random())) for _ in range(300)]
    grade = np.array([min(3, len(x)) for x, _ in rows])
    link = toxicity.CumulativeLink(5, 3).fit(rows, grade)
    assert (np.diff(link.c) > 0).all()
    p = link.cumulative(rows)
    assert (np.diff(p, axis=1) <= 0).all()
    assert np.corrcoef(p.sum(1), grade)[0, 1] > 0.9


def test_op7_planted(spark):
    r = random.Random(6)
    clean = lambda: " ".join("".join(r.choices("etaoinsr", k=5)) for _ in range(r.randint(5, 400)))
    rows = []
    for i in range(500):
        words = clean().split()
        toxic = i % 6 == 0
        for _ in range(r.randint(1, 4) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(("zwumble", "zwumbling", "Grokhead!", "GROKHEAD")))
        rows.append((i, " ".join(words), "en", "s", 0, int(toxic)))
    table = spark.createDataFrame(rows, DOCS + ", toxic int")
    labels = table.where("doc_id % 2 = 0").select("doc_id", "toxic")
    got = {x["doc_id"]: x for x in toxicity.grade_documents(table, labels).collect()}
    assert [got[r[0]]["toxic"] for r in rows] == [bool(r[5]) for r in rows]
    assert all((x["grade"] > 0) == x["toxic"] and 0 <= x["severity"] <= 3 for x in got.values())
    kept = toxicity.clean(table, labels)
    assert kept.columns == table.columns and kept.where("toxic = 1").count() == 0 and kept.count() == sum(not r[5] for r in rows)


def test_op7_edges(spark):
    table = edge_table(spark)
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, toxic int")
    assert toxicity.grade_documents(table, labels).count() == table.count()
    assert toxicity.clean(table, labels.limit(0)).count() == table.count()
    both = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (5, None)], "doc_id long, toxic int")  # repeated labels, and an id on several rows
    got = toxicity.grade_documents(table, both).collect()
    assert len(got) == table.count() and all(0 <= r["severity"] <= toxicity.GRADES and r["toxic"] == (r["p_toxic"] >= 0.5) for r in got)
    assert {(r["severity"], r["grade"], r["toxic"]) for r in toxicity.grade_documents(table, labels.limit(0)).collect()} == {(0.0, 0, False)}
    assert toxicity.grade_documents(table.limit(0), labels).count() == 0


def test_op3_reads_whole_passages():
    """Capitals anywhere in a passage count, whatever lower case does to a letter's length; long words keep their shape."""
    encoder, at = mil_quality.Encoder(), mil_quality.SHAPES + 9
    small, late = ["a" * 40] * 95, ["a" * 40] * 94 + ["B" * 40]
    assert encoder.passage(small)[at] == 0 and encoder.passage(late)[at] == 40 / 3800
    dotted = encoder.passage(["İ", *["word"] * 95])[at]
    assert dotted == 1 / 381
    assert mil_quality.shape("a" * 30 + "1" + "b" * 30) == mil_quality.shape("a1b") != mil_quality.shape("a" * 61)


def test_op3_op7_held_out_at_scale(spark):
    """Figures on a larger table, with the labels of every fifth document kept back."""
    sf = "/root/testdata/sf0.1"
    labels, docs = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op3_attention_quality(spark, sf).join(labels, "doc_id").where("held_out").collect()
    bad = np.array([r["score"] for r in got if not r["quality"]])
    assert np.mean([(bad < r["score"]).mean() for r in got if r["quality"]]) > 0.99
    graded = toxicity.grade_documents(docs, labels.where("doc_id % 5 <> 0")).withColumnRenamed("toxic", "found").join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
    hits = [r["found"] for r in graded if r["toxic"]]
    false = [r["found"] for r in graded if not r["toxic"]]
    assert np.mean(hits) > 0.95 and np.mean(false) < 0.01
    # Grades follow how toxic the text is, not only whether it is: all of them occur.
    assert {r["grade"] for r in graded if r["found"]} == {1, 2, 3}


# --- rollups -----------------------------------------------------------------------------------


def test_op9(spark, tmp_path):
    table = edge_table(spark)
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in token_rollup.maintained_totals(table, f"file://{tmp_path}/ledger", (WORD, "w"), (BYTE, "b"), "lang <> 'en' or source is null").collect()}
    rows = table.collect()
    first = {}
    for r in rows:
        if r["text"] is not None and r["doc_id"] is not None:
            first[r["text"]] = min(first.get(r["text"], r["doc_id"]), r["doc_id"])
    gone = {r["doc_id"] for r in rows if r["text"] in first and r["doc_id"] is not None and r["doc_id"] > first[r["text"]]}
    want = {}
    for r in rows:
        if r["doc_id"] in gone:
            continue
        moved = (r["lang"] is not None and r["lang"] != "en") or r["source"] is None
        t, v = (byte, "b") if moved else (word, "w")
        n, tokens = want.get((r["source"], r["lang"], v), (0, 0))
        want[r["source"], r["lang"], v] = n + 1, tokens + len(t.encode(r["text"] or "", add_special_tokens=False).ids)
    assert got == want


def test_ledger(spark, tmp_path):
    ledger = token_rollup.Ledger(spark, f"file://{tmp_path}/ledger")
    counts = spark.createDataFrame([(1, "a", "en", "v", 5), (2, "a", "en", "v", 7), (3, None, "en", "v", None)], "doc_id long, source string, lang string, version string, tokens long")
    assert ledger.totals().count() == 0
    assert ledger.commit("one", token_rollup.inserts(counts))
    assert not ledger.commit("one", token_rollup.inserts(counts))
    assert ledger.commit("two", token_rollup.deletes(counts.where("doc_id = 2")))
    assert ledger.commit("none", token_rollup.inserts(counts.limit(0)))
    ledger.compact()
    for again in ("one", "two", "none"):
        assert not ledger.commit(again, token_rollup.inserts(counts))
    assert ledger.commit("three", token_rollup.revisions(counts.where("doc_id = 1"), counts.where("doc_id = 1").withColumn("tokens", F.lit(6).cast("long"))))
    assert {(r["source"], r["docs"], r["tokens"]) for r in ledger.totals().collect()} == {("a", 1, 6), (None, 1, 0)}
    # What is listed grows with what came since the last compaction, and ids stay committed through several.
    listed = lambda: {x: len(list((tmp_path / "ledger" / x).iterdir())) for x in ("deltas", "entries", "folds")}
    for round_ in range(3):
        for k in range(3):
            assert ledger.commit(f"{round_}-{k}", token_rollup.inserts(counts.where("doc_id = 1")))
        before = listed()
        ledger.compact()
        assert listed()["deltas"] == listed()["entries"] == listed()["folds"] == 1 and before["entries"] >= 4
        assert {(r["source"], r["docs"], r["tokens"]) for r in ledger.totals().collect()} == {("a", 1 + 3 * (round_ + 1), 6 + 15 * (round_ + 1)), (None, 1, 0)}
    ledger.compact()  # nothing to fold
    for again in ("one", "two", "none", "three", *(f"{i}-{k}" for i in range(3) for k in range(3))):
        assert not ledger.commit(again, token_rollup.inserts(counts))
    assert listed() == {"deltas": 1, "entries": 1, "folds": 1}


# --- pipeline ----------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.grade_documents(docs, labels).where("toxic").collect()}
    left = docs.where(~F.col("doc_id").isin(*toxic) if toxic else F.lit(True))
    left = line_rules.cleaned(left)
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    comp = groups_of(sorted(texts), lambda i, j: jaccard(texts[i], texts[j]) >= 0.8)
    near = groups_of(sorted(texts), lambda i, j: jaccard(texts[i], texts[j]) >= 0.9)  # of these hardly any is missed
    library = Tokenizer.from_file(BYTE)
    got = Counter()
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r["doc_id"]] += r["length"]
    assert {i for i in texts if comp[i] == i} <= set(got) <= {i for i in texts if near[i] == i}
    assert dict(got) == {i: len(library.encode(texts[i], add_special_tokens=False).ids) + 1 for i in got}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near-duplicates", "packing"]


def test_pipeline_edges(spark, sf_dir):
    """Nulls in every column, repeated rows and ids, long texts and clashing names; an empty table stays empty."""
    for table in (edge_table(spark), edge_table(spark).limit(0)):
        docs, ids = table, Counter(r["doc_id"] for r in table.collect())
        for _, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.count()
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == table.columns and docs.count() <= before
            assert all(n <= ids[i] for i, n in Counter(r["doc_id"] for r in docs.collect()).items())
        # Only the two texts of many words pass the base rules, but for one of repeated words alone.
        assert {r["text"] for r in docs.collect()} <= {t for t in EDGE if t and len(t.split()) >= 50}
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_keeps_one_row_of_each_component(spark, sf_dir):
    """Null and repeated ids, against brute force over rows."""
    long = [" ".join(random.Random(k).choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=300)) for k in range(6)]
    near = " ".join([*long[0].split()[:150], "mu", *long[0].split()[151:]])
    given = [(None, long[0]), (None, near), (None, long[1]), (None, long[1]), (3, long[1]), (None, long[2]), (7, long[3]), (7, long[1]), (7, long[3]), (8, near), (8, long[0]), (None, long[4]), (None, long[4]), (9, long[4]), (5, long[5]), (5, long[5]), (None, None), (None, ""), (None, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(given)], DOCS).repartition(3)
    root = groups_of(range(len(given)), lambda i, j: jaccard(given[i][1], given[j][1]) >= 0.8)
    groups = [{i for i in root if root[i] == g} for g in set(root.values())]
    kept = [r["n_chars"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()]
    for group in groups:
        stay = [n for n in kept if n in group]
        ids = [given[n][0] for n in group if given[n][0] is not None]
        assert len(stay) == 1 and given[stay[0]][0] == min(ids, default=None)
    assert len(kept) == len(groups)


def test_few_open_pairs_meet_with_their_sets(spark):
    """Marks differ in no more bits than sets do; texts that only share a beginning of their shingles aren't held against each other."""
    r = np.random.default_rng(5)
    for n, m, common in [(0, 0, 0), (0, 3, 0), (1, 1, 1), (64, 65, 60), (90, 130, 80), (500, 520, 500), (3000, 5000, 2500)]:
        both = r.integers(-(1 << 63), (1 << 63) - 1, n + m - common)
        x, y = np.sort(both[:n]), np.sort(both[n - common :])
        assert similar.apart(similar.mark(x), similar.mark(y)) == similar.apart(similar.mark(y), similar.mark(x)) <= len(np.setxor1d(x, y))
        assert 8 * len(similar.mark(x)) >= n
    shared = " ".join(f"s{i}" for i in range(60))
    texts = [f"{shared} {' '.join(f'w{k}x{i}' for i in range(60))}" for k in range(24)]
    texts += [f"{texts[0]} more", f"{texts[1]} more"]
    docs, nodes = numbered_texts(spark, texts)
    roots = spark.createDataFrame([], "node long, root long")
    assert {(x["a"], x["b"]) for x in similar.met_by_prefix(docs, nodes, roots).collect()} == {(0, 24), (1, 25)}


def test_candidates_grow_with_a_group_not_with_its_tasks(spark):
    """However many tasks a group of near copies is dealt to, a few candidates of each text are kept, its nearest among them."""
    r = random.Random(17)
    base = [f"w{r.randrange(5000)}" for _ in range(200)]
    docs, nodes = numbered_texts(spark, [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in range(160)])
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        pairs = [(x["a"], x["b"]) for x in similar.candidates(nodes).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(pairs) == len(set(pairs)) <= 8 * 160 and all(a < b for a, b in pairs)
    assert {x for pair in pairs for x in pair} == set(range(160))


def test_copies_that_are_not_alike_do_not_meet(spark, monkeypatch):
    """Copies of one text that differ in too much don't meet by what they share; those of other lengths that are alike do, all of them."""
    r = random.Random(31)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(300):
        words = list(base)
        for at in r.sample(range(150), 4 + k % 3):
            words[at] = f"own{k}x{at}"
        texts.append(" ".join(words))
    other = [f"v{i}" for i in range(120)]
    texts += [" ".join([*other[:n], *(f"more{n}x{i}" for i in range(n % 4))]) for n in range(60, 120)]
    docs, nodes = numbered_texts(spark, texts)
    met, judged = [], similar.may_be_alike
    monkeypatch.setattr(similar, "may_be_alike", lambda pairs, *rest: judged(met.append(pairs) or pairs, *rest))
    found = {(x["a"], x["b"]) for x in similar.met_by_prefix(docs, nodes, spark.createDataFrame([], "node long, root long")).collect()}
    alike = {(a, b) for a in range(300, 360) for b in range(a + 1, 360) if jaccard(texts[a], texts[b]) >= 0.8}
    assert alike <= found and len(alike) > 500
    assert met[0].where("a < 300").count() <= 300
