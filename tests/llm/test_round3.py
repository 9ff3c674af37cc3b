"""Source divergence, periodic runs and URL filters against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import periodic_runs, queries, source_divergence, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["*", "1 as term", "'x' as place", "2 as n", "3 as vector", "4 as runs", "5 as collapsed", "6 as value", "'y' as item", "7 as rank"]


def same_as_sql(spark, tmp_path, name, **tables):
    """A query over tables equals its SQL."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.write.parquet(str(tmp_path / f"{table}.parquet"))
        con.execute(f"create view {table} as select * from '{tmp_path / table}.parquet/*.parquet'")
    df = queries.QUERIES[name](spark, str(tmp_path))
    got = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr([dict(zip(columns, r, strict=True))[c] for c in df.columns]) for r in got.fetchall())
    have = sorted(repr([r[c] for c in df.columns]) for r in df.collect())
    assert have == want
    return have


# --- source divergence -------------------------------------------------------------------------


def divergence(rows, min_docs=10, top=10):
    """The audit by dense sums, in plain Python."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = {}, Counter(), set()
    for text, lang, source in rows:
        found = term.findall((text or "").translate(low))
        groups.add((lang or "", source or ""))
        counts.setdefault((lang or "", source or ""), Counter()).update(found)
        docs.update((lang or "", t) for t in set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        own, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pair = sorted(((sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s), key=lambda x: (-x[0], x[1].encode()))
            told = sorted(((f(own[s][t], q[t]), t) for t in kept if counts[lang, s][t] and own[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, v, k) for part, xs in (("pair", pair), ("term", told)) for k, (v, item) in enumerate(xs, 1)]
    return sorted(out)


def test_op11(spark, tmp_path):
    r = random.Random(1)
    words = [*"The the cat Dog É é ÉÉ straße 日本 İ x1y a_b".split(), *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(i, " ".join(r.choices(words[: r.randint(3, len(words))], k=r.randint(0, 40))), r.choice(["en", "fr", None]), r.choice(["a", "b", "é", "", None, "z"]), 0) for i in range(400)]
    rows += [(500, "alone words", "xx", "one", 0), (501, None, "yy", "p", 0), (502, "", "yy", "q", 0), (502, "", "yy", "q", 0), (None, "A" * 70000 + " the", "en", "a", None), (504, "\x00\t12 !", "yy", "r", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = sorted(map(tuple, source_divergence.audit(docs.selectExpr(*CLASHING)).collect()))
    assert got == divergence([(x[1], x[2], x[3]) for x in rows]) and len(got) > 80
    assert sum(x[2] == "pair" and x[4] == 0 for x in got) == 6  # of yy, which keeps no term
    assert sorted(map(tuple, source_divergence.audit(docs, min_docs=1, top=3).collect())) == divergence([(x[1], x[2], x[3]) for x in rows], 1, 3)
    assert source_divergence.audit(docs.limit(0)).count() == 0


def test_op11_equals_sql(spark, tmp_path):
    r = random.Random(2)
    words = [f"{a}{b}" for a in "abcdé" for b in "xyzÜ"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 30))), r.choice("ef"), r.choice("stuv"), 0) for i in range(300)]
    assert len(same_as_sql(spark, tmp_path, "op11_source_divergence", documents=spark.createDataFrame(rows, DOCS))) > 80


def test_op11_partial_sums(spark, monkeypatch):
    """A task that passes its sums on early, and big counts, change nothing."""
    rows = [(i, f"a b{i % 7} c", "en", "ab"[i % 2], 0) for i in range(200)]
    rows = [(i, re.sub(r"\d", lambda m: "pqrstuv"[int(m[0])], t), *rest) for i, t, *rest in rows]
    monkeypatch.setattr(source_divergence, "HELD", 5)
    got = sorted(map(tuple, source_divergence.audit(spark.createDataFrame(rows, DOCS)).collect()))
    assert got == divergence([(x[1], x[2], x[3]) for x in rows])
    big = spark.createDataFrame([(5 * 10**12, 9 * 10**12, 10**6)], "c long, n long, v long")
    assert big.select(source_divergence.share(F.col("c"), F.col("n"), F.col("v"))).first()[0] == 1 + 10**9 * (5 * 10**12 + 2) // (9 * 10**12 + 2 * 10**6)


# --- periodic runs -----------------------------------------------------------------------------


def runs_by_force(w, least=24, repeats=3):
    found = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, repeats * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda x: (x[0], x[2]))


def run_texts(r, n):
    texts = []
    for _ in range(n):
        w = []
        for _ in range(r.randint(0, 5)):
            k = r.random()
            if k < 0.7:
                p = [r.choice("abc") for _ in range(r.randint(1, 12))]
                w += (p * r.randint(1, 30))[: r.randint(0, 150)]
            else:
                w += [r.choice("ab" if k < 0.85 else "abcdefgh") for _ in range(r.randint(0, 60))]
        texts.append(w)
    return texts


@pytest.mark.parametrize("lying", [False, True])
@pytest.mark.parametrize("least, repeats", [(24, 3), (6, 2)])
def test_runs_equal_brute_force(monkeypatch, lying, least, repeats):
    """Also where the first hashes take unequal stretches for equal, and with small chunks of pairs."""
    if lying:
        monkeypatch.setattr(periodic_runs, "BASES", (np.uint64(1),))
    monkeypatch.setattr(periodic_runs, "PAIRS_AT_ONCE", 50)
    r, n = random.Random(3), 0
    for _ in range(60):
        texts = run_texts(r, r.randint(1, 6))
        want = [runs_by_force(w, least, repeats) for w in texts]
        n += sum(map(len, want))
        assert periodic_runs.runs_of(texts, least, repeats) == want
    assert n > 100


def test_op12(spark):
    r = random.Random(5)
    gap = lambda: r.choice([" ", "\n", "\t\x0b ", "  "])
    texts = ["".join(x + gap() for x in w) for w in run_texts(r, 150)] + [None, "", " \n\t ", "one", "x " * 5000, "é à " * 40, "a\u00a0b " * 30]
    rows = [(i * 7, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "a b " * 40, None, None, None), (7, texts[0], "en", "s", 0), (7, texts[0], "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr(*CLASHING)
    got = [tuple(x) for x in periodic_runs.digest(periodic_runs.find(docs, edited=periodic_runs.planted)).collect()]
    want, planted = [], 0
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for doc_id, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and w:
            g, n, own = h // 10, len(w), list(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = runs_by_force(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc_id, len(runs), *told, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    assert sorted(got, key=repr) == sorted(want, key=repr) and planted > 5
    assert periodic_runs.find(docs.limit(0)).count() == 0
    plain = periodic_runs.find(docs.where("doc_id is null")).first()
    assert plain["collapsed"] == "a b" and [tuple(x) for x in plain["runs"]] == [(0, 80, 2)]


# --- URL filters -------------------------------------------------------------------------------


def likelihood(urls, text, order=url_filter.ORDER):
    """The log-likelihood of a text by a model of some URLs, with strings and dictionaries."""
    n, after = Counter(), {}
    framed = ["\x02" + u + "\x03" for u in urls]
    for u in framed:
        for t in range(1, len(u)):
            for k in range(min(order, t) + 1):
                n[u[t - k : t + 1]] += 1
                after.setdefault(u[t - k : t], Counter())[u[t]] += 1
    least = max(url_filter.MIN_SEEN, -(-sum(len(u) - 1 for u in framed) // url_filter.SHARE))
    total, text = 0.0, "\x02" + text + "\x03"
    for t in range(1, len(text)):
        p = 1 / url_filter.ALPHABET
        for k in range(min(order, t) + 1):
            context = text[t - k : t]
            seen = {c: m for c, m in after.get(context, {}).items() if m >= least}
            if seen:
                back = len(after[context]) + sum(after[context].values()) - sum(seen.values())
                p = (seen.get(text[t], 0) + back * p) / (sum(seen.values()) + back)
        total += math.log(p)
    return total


def test_url_models_equal_dictionaries(spark):
    r = random.Random(7)
    url = lambda bad: f"{r.choice(['casino', 'bets', 'pills'] if bad else ['garden', 'school', 'library'])}{r.randint(0, 9)}.example/é/{r.randint(0, 99)}"
    urls = [(url(k), 0) for k in (0,) for _ in range(80)] + [(url(1), 1) for _ in range(60)]
    rows = spark.createDataFrame([(u, u.split("/")[0], bool(k)) for u, k in urls], "shown string, host string, rejected boolean")
    parted = rows.select("shown", F.col("rejected").cast("int").alias("kind"), F.pmod(F.xxhash64("host"), F.lit(2)).cast("int").alias("part")).distinct()
    found = url_filter.models(url_filter.gram_counts(parted).cache())
    of = {(w, k): sorted(x["shown"] for x in parted.collect() if x["kind"] == k and x["part"] != w) for w in range(3) for k in range(2)}
    asked = ["garden1.example/é/5", "casino9.example/é/77", "", "x", "new.example.org/путь", "casino" * 300]
    for key, model in found.items():
        got = np.concatenate([model.log_likelihoods(url_filter.Grams(asked[:3])), model.log_likelihoods(url_filter.Grams(asked[3:]))])
        assert np.allclose(got, [likelihood(of[key], t) for t in asked], rtol=1e-9)
    judged = url_filter.fitted(rows)
    ratios, p = judged.judged(asked)
    assert p[0] < 0.1 < 0.9 < p[1] and p[2] == 0 and ratios[0] > 0 > ratios[1]
    want = [(likelihood(of[2, 0], t) - likelihood(of[2, 1], t)) / (len(t) + 1) for t in asked]
    assert np.allclose(ratios, want)


def test_url_models_hang_on_shares_not_on_size(spark, monkeypatch):
    """Counts a thousand times as large keep the same grams, those seen once in the small table too, and so do shares at the limit."""
    r = random.Random(3)
    urls = sorted({(f"{r.choice(['casino', 'garden'])}{r.randint(0, 99)}.example/{r.randint(0, 999)}", k % 2, k // 2 % 2) for k in range(80)})
    small = url_filter.gram_counts(spark.createDataFrame(urls, "shown string, kind int, part int")).cache()
    large = small.withColumn("n", F.col("n") * 1000)
    every = small.where("kind = 1").select("gram").distinct().count()
    for share in (url_filter.SHARE, 200):
        monkeypatch.setattr(url_filter, "SHARE", share)
        one, other = url_filter.models(small), url_filter.models(large)
        assert all(np.array_equal(one[k].grams, other[k].grams) for k in one)
        assert (len(one[2, 1].grams) == every) == (share > 200)


def rule_by_force(url, rules):
    """(host, path, rule, verdict) as the rules have it."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fit)[1:] if fit else (None, None))


def test_op13(spark, tmp_path):
    r = random.Random(8)
    tail = lambda: r.choice(["", "/", "?a=/b", "#x", ".html", "?u=http://other.org/", "/é"])
    urls = [f"{r.choice(['http', 'HTTPS'])}://{r.choice(['m.', 'WWW.', '', 'a.b.'])}{r.choice('casino garden school bets'.split())}.{r.choice(['example.org', 'example.com', 'Example.net', 'org', 'com'])}/{r.choice(['en', 'de', 'fr', 'es'])}/{r.randint(1, 200)}{tail()}" for _ in range(600)]
    odd = [None, "", "no scheme", "://", "http://", "http://org", "http://org/", "http://xorg/", "http://a.org?x/", "http://com/fr", "http://com/fr/", "a://b://c.org/d", "http://ÀB.org/\n/x?y", "http://k.com/de/" + "x" * 40000, "http://u.net/" + "y" * 40000]
    rows = [(i, u, "<p>") for i, u in enumerate(urls + odd)] + [(None, urls[0], None), (3, urls[3], "x"), (3, urls[3], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = [tuple(x) for x in queries.op13_url_filter(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows)
    want = Counter((i, *rule_by_force(u, queries.URL_RULES)[:3]) for i, u, _ in rows)
    assert Counter(x[:4] for x in got) == want
    by = {(x[0], x[3]): x for x in got}
    for i, u, _ in rows:
        host, path, rule, verdict = rule_by_force(u, queries.URL_RULES)
        x = by[i, rule]
        if rule:
            assert x[4] == verdict and x[5] is None
        else:
            assert x[4] == ("block" if x[6] >= 0.5 else "allow")
            if not u or "://" not in u or u.endswith("://"):
                assert x[4] == "allow" and x[6] == 0
    # The models by dictionaries give the same ratios.
    shown = lambda u: rule_by_force(u, [])[0] + u.split("://", 1)[1][len(rule_by_force(u, [])[0]) :]
    kinds = {v: {shown(u) for _, u, _ in rows if rule_by_force(u, queries.URL_RULES)[3] == v} for v in ("allow", "block")}
    few = [x for x in got if x[3] is None and x[6]][:12]
    for x in few:
        u = next(u for i, u, _ in rows if i == x[0] and rule_by_force(u, queries.URL_RULES)[2] is None)
        if len(u) < 500:
            t = shown(u)
            assert abs(x[5] - (likelihood(kinds["allow"], t) - likelihood(kinds["block"], t)) / (len(t) + 1)) < 1e-9
    extra = url_filter.judge(pages.selectExpr("*", "1 as host", "2 as rule", "3 as shown", "'v' as verdict"), [])
    assert {x["verdict"] for x in extra.collect()} == {"allow"}  # without rules nothing is learnt
    assert url_filter.judge(pages.limit(0), [url_filter.Rule("block", "com", "/")]).count() == 0


def test_op13_tells_unseen_hosts(spark, sf_dir):
    """Ratios of URLs that rules decide, by models that haven't seen their hosts: accepted ones lie above rejected ones."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet".replace("sf0.001", "sf0.1"))
    parts = url_filter.ruled(url_filter.with_parts(pages.select("page_id", "url")), [url_filter.Rule(*x) for x in queries.URL_RULES]).where("ruling is not null")
    rows = [(x["shown"], x["ruling"] == "block", x["part"]) for x in parts.select("shown", "ruling", F.pmod(F.xxhash64("host"), F.lit(2)).alias("part")).distinct().collect()]
    for part in (0, 1):
        learnt = spark.createDataFrame([(t, str(i), bad) for i, (t, bad, p) in enumerate(rows) if p != part], "shown string, host string, rejected boolean")
        held = [(t, bad) for t, bad, p in rows if p == part]
        ratios, _ = url_filter.fitted(learnt).judged([t for t, _ in held])
        good, bad = (ratios[np.array([b for _, b in held]) == k] for k in (False, True))
        assert np.mean(good[:, None] > bad[None, :]) > 0.99
