"""Golden values, twins in plain Python, and edge cases."""

import difflib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.functions import arrow_udfs, jsonx, rules, text
from paperloom.operators import folds, joins, metrics, providers, sweep, windows
from paperloom.sources import readers, writers
from paperloom.streaming import streams


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "f, given, want",
    [
        (text.normalize_eval, "مُحَمَّد  إبراهيم ٢٠٢٤", "محمد ابراهيم 2024"),
        (text.normalize_eval, " القاهرة، ", "القاهره،"),
        (lambda c: text.normalize_eval(c, edges=True), " القاهرة، ", "القاهره"),
        (text.normalize_vqa, "سؤال: على المستشفى!", "سءال علي المستشفي"),
        (text.normalize_asr, "سؤال قائمة إلى", "سوال قايمه الي"),
        (text.normalize_ocr, "  Napa - 500 Mg. ", "napa  500 mg"),
        (text.replace_words, "محتاج علاج دلوقتي ٥٠٠ جنيه القاهرة", "أحتاج علاج الآن ٥٠٠ جنيه القاهرة"),
        (text.slug, "meta-llama/llama 4!", "meta-llama_llama_4"),
        (text.slug, "", "model"),
        (text.squeeze, None, ""),
        (jsonx.without_trailing_commas, '{"a":[1,2, ],}', '{"a":[1,2]}'),
        (jsonx.strip_fences, '```json\n{"a":1}\n```', '{"a":1}'),
        (jsonx.lenient_object, "no json", "{}"),
    ],
)
def test_golden_text(spark, f, given, want):
    assert one(spark, f(F.col("t")), t=given) == want


@pytest.mark.parametrize("answer, want", [("", 0.0), ("غير واضح", 0.45), ("روشتة طبية", 0.95), ("هذه صورة لروشتة طبية واضحة", 0.9)])
def test_confidence(spark, answer, want):
    assert one(spark, text.answer_confidence(F.col("t")), t=answer) == want


def test_numbers_and_words(spark):
    assert one(spark, F.transform(text.numbers(F.col("t")), lambda x: x.cast("long")), t="٥٠٠ و 12 و 500") == [12, 500]
    assert one(spark, text.number_words(F.col("t")), t="معي خمسة") == "معي five"
    assert one(spark, text.clock(F.lit(3725.9))) == "010205"
    assert one(spark, text.truncate_tail(F.lit("x" * 1000))) == "[...]" + "x" * 900


def test_flatten(spark):
    df = spark.createDataFrame([(1, '{"b":{"y":[1,{"z":null}],"x":{}},"a":[]}'), (2, "nonsense"), (3, None)], "id long, p string")
    got = {(r["path"], r["value"]) for r in jsonx.flatten(df, "id", "p").collect()}
    assert got == {("a", "[]"), ("b.y[0]", "1"), ("b.y[1].z", None)}


@pytest.mark.parametrize("ai, same, other, q, want", [(0.25, False, False, 0.9, (0.145, "low")), (0.72, False, False, 0.88, (0.384, "low")), (0.9, True, True, 0.2, (0.91, "high")), (0.9, False, True, 0.0, (0.95, "high"))])
def test_risk(spark, ai, same, other, q, want):
    r = one(spark, rules.risk_profile(F.lit(ai), F.lit(same), F.lit(other), F.lit(q)))
    assert (r["risk_score"], r["risk_level"]) == want


def test_quality(spark):
    assert one(spark, rules.quality_score(F.lit(300.0), F.lit(1.0))) == 0.7
    assert one(spark, rules.quality_score(F.lit(900.0), F.lit(1.0))) == 0.55


def test_ratios(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(arrow_udfs.sequence_ratio("a", "b")).collect()]
    assert got == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in (("abcd", "bcde"), ("tide", "diet"), ("diet", "tide"), ("", "x"))]
    assert arrow_udfs.token_set("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100.0
    assert arrow_udfs.token_set("", "x") == 0.0


def test_balanced():
    assert arrow_udfs.balanced('say {"a": "}"} more }') == '{"a": "}"}'
    assert arrow_udfs.balanced("[1]") == "[1]"
    assert arrow_udfs.balanced("none") is None


def test_word_distance(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    r = random.Random(1)
    pairs = [(" ".join(r.choices("alpha بيت gamma x".split(), k=r.randint(0, 9))), " ".join(r.choices("alpha بيت gamma x".split(), k=r.randint(0, 9)))) for _ in range(60)]
    got = [x[0] for x in spark.createDataFrame(pairs, "a string, b string").coalesce(1).select(metrics.word_distance(F.col("a"), F.col("b"))).collect()]
    assert got == [distance(a.split(), b.split()) for a, b in pairs]


def test_whole_texts_of_all_languages(spark, tmp_path):
    """Error rates and fuzzy_best_match_sequence against brute force over texts longer than 120 characters and not in ASCII."""
    from paperloom.plans.catalogue import QUERIES

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    r = random.Random(9)
    docs = [(i, " ".join(r.choices("alpha été größe بيت eta e x señal".split(), k=r.choice([3, 60, 150]))), "fr de es en".split()[i % 4], "s") for i in range(24)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, t) for i, t, *_ in docs], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = {}
    for i, t, lang, _ in docs:
        pred = (t.replace("e", ""), t.replace("a", "o"), t)[i % 3]
        n, edits, words, letters = want.get(lang, (0, 0, 0, 0))
        want[lang] = n + 1, edits + distance(pred.split(), t.split()), words + len(t.split()), letters + distance(pred, t)
    t = F.col("text")
    read = F.when(F.col("doc_id") % 3 == 0, F.replace(t, F.lit("e"), F.lit(""))).when(F.col("doc_id") % 3 == 1, F.replace(t, F.lit("a"), F.lit("o"))).otherwise(t)
    rates = metrics.error_rates(spark.read.parquet(str(tmp_path / "documents.parquet")).select("lang", read.alias("pred"), t.alias("gold")), ["lang"])
    assert {x["lang"]: (x["samples"], x["word_edits"], x["words"], x["char_edits"]) for x in rates.collect()} == want
    dropped = lambda t: [w for w in t.split() if w in ("the", "and", "der", "die", "de", "la", "que", "les", "of", "un")]
    assert {x["lang"]: x["word_edits"] for x in QUERIES["wer_micro"](spark, str(tmp_path)).collect()} == {lang: sum((len(dropped(t)), len(dropped(t)), sum("e" in w for w in t.split()), 0)[i % 4] for i, t, x, _ in docs if x == lang) for lang in want}
    best = {}
    for i, t, *_ in docs:
        w = t.split(" ")
        target = " ".join(w[3:5])
        target = target.replace("e", "a").replace("o", "") if i % 2 else target
        tokens = [(x, 0, k) for k, x in enumerate(w)] + [(f"{x} {y}", 1, k) for k, (x, y) in enumerate(zip(w, w[1:], strict=False))]
        score = lambda x, target=target: round(difflib.SequenceMatcher(None, target, x).ratio(), 6)
        best[i] = min((-score(x), pair, k, x) for x, pair, k in tokens)
    assert {x["document_id"]: (x["score"], x["text"]) for x in QUERIES["fuzzy_best_match_sequence"](spark, str(tmp_path)).collect()} == {i: (-b[0], b[3]) for i, b in best.items()}


def test_token_f1(spark):
    assert round(one(spark, metrics.token_f1(F.lit("a a b"), F.lit("a b c"))), 4) == 0.6667


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("rows_a_task", [7, 1000])
@pytest.mark.parametrize("keys", [0, 1, 3])
def test_interval_overlap(spark, closed, rows_a_task, keys):
    """Every pair once, in one range and in many, with intervals over everything, empty and reversed ones, ties and repeated rows."""
    r = random.Random(2)
    kind = lambda p: f"{p}_id long, {p}_k string, {p}_start double, {p}_end double"
    spans = [[(i, r.choice("abc"[: max(1, keys)]), float(s), float(s + r.randint(-3, 40))) for i, s in enumerate(r.choices(range(200), k=60))] + [(90, "a", -5.0, 500.0), (91, "a", 7.0, 7.0), (91, "a", 7.0, 7.0), (92, None, 1.0, 300.0), (93, "a", None, 5.0)] for _ in range(2)]
    got = sweep.overlap(*(spark.createDataFrame(x, kind(p)) for x, p in zip(spans, "lr", strict=True)), on=["k"] if keys else [], closed=closed, rows_a_task=rows_a_task)
    over = lambda s, e, t, u: u >= s and t <= e if closed else u > s and t < e
    want = Counter((a, x) for a, j, s, e in spans[0] for x, k, t, u in spans[1] if None not in (s, t) and (not keys or j == k is not None) and over(s, e, t, u))
    assert Counter((x["l_id"], x["r_id"]) for x in got.collect()) == want


def test_intervals_are_carried_in_proportion(spark):
    """One interval over everything reaches all ranges; short ones only their own."""
    rows = [(i, float(i), i + 1.5) for i in range(2000)] + [(-1, -1.0, 5000.0)]
    left, right = spark.createDataFrame(rows, "l_id long, l_start double, l_end double"), spark.createDataFrame(rows, "r_id long, r_start double, r_end double")
    pairs = sweep.overlap(left, right, rows_a_task=100)
    assert pairs.count() == 2000 + 2 * 1999 + 2 * 2000 + 1


@pytest.mark.parametrize("rows_a_task", [3, 8192])
def test_catalog_match_scores_every_row(spark, rows_a_task):
    r = random.Random(5)
    words = "panadol brufen aspirin augmentin ventolin cetal بنادول congestal extra forte plus night".split()
    catalog = [(i, " ".join(r.sample(words, r.randint(1, 3))), r.choice([None, "", " Tablet ", "syrup"])) for i in range(40)] + [(50, "Panadol", None), (49, "panadol", None)]
    typo = lambda w: w[: (k := r.randrange(len(w)))] + r.choice(["", "x", "e"]) + w[k + 1 :]
    queries = [(i, typo(r.choice(words))) for i in range(40)] + [(100 + i, " ".join(typo(w) for w in r.sample(words, 2))) for i in range(40)] + [(200, "panadl"), (201, "panadol nigth"), (202, ""), (203, None), (204, "zzz")]
    got = joins.catalog_match(spark.createDataFrame(queries, "query_id long, query string"), spark.createDataFrame(catalog, "row_id long, a string, b string"), ["a", "b"], names_a_task=rows_a_task)
    want = {}
    for i, q in queries:
        scores = [(-round(arrow_udfs.token_set((q or "").strip().lower(), n.strip().lower()), 6), row) for row, *both in catalog for n in both if n and n.strip()]
        if -min(scores)[0] >= 75:
            want[i] = (min(scores)[1], -min(scores)[0])
    assert 200 in want and {x["query_id"]: (x["row_id"], x["score"]) for x in got.collect()} == want


def test_greedy_accept(spark):
    r = random.Random(3)
    items = [(i, r.random()) for i in range(80)]
    edges = [(max(a, b), min(a, b)) for a, b in (r.sample(range(80), 2) for _ in range(70))]
    taken, want = [], {}
    for i, ai in items:
        hit = [e for e in taken if (i, e) in edges]
        want[i] = "ai" if ai >= 0.7 else "duplicate" if hit else "accepted"
        if want[i] == "accepted":
            taken.append(i)
    got = folds.greedy_accept(spark.createDataFrame(items, "item long, ai double"), spark.createDataFrame(edges, "item long, earlier long"))
    assert {x["item"]: x["decision"] for x in got.collect()} == want


def test_greedy_accept_index_by_brute_force(spark, tmp_path):
    """A group in which many vectors have over 50 nearer neighbours than the accepted one, copies, and no vector at all."""
    import numpy as np

    from paperloom.plans.catalogue import QUERIES

    r = np.random.default_rng(8)
    unit = lambda v: (v / np.linalg.norm(v)).astype("f4").tolist()
    centres = r.normal(size=(3, 8))
    rows = [(i, unit(centres[i % 3] + 0.35 * r.normal(size=8))) for i in range(320)]
    rows += [(320 + i, rows[7 * i % 90][1]) for i in range(60)] + [(400 + i, [0.1] * 8) for i in range(3)] + [(410, None), (411, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    want, taken = {}, []
    for i, v in rows:
        hit = [] if v is None else [e for e, w in taken if w is not None and round(float(np.dot(np.array(v, float), np.array(w, float))), 6) >= 0.4]
        want[i] = ("ai", None) if i % 101 / 100 >= 0.7 else ("duplicate", min(hit)) if hit else ("accepted", None)
        if want[i][0] == "accepted":
            taken.append((i, v))
    got = QUERIES["greedy_accept_index"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and {x["item"]: (x["decision"], x["like"]) for x in got} == want
    v = spark.read.parquet(str(tmp_path / "embeddings.parquet")).withColumn("ai", (F.col("vec_id") % 101) / 100)
    got = folds.accept_vectors(v, 0.4, first=40).collect()  # in blocks
    assert len(got) == len(rows) and {x["item"]: (x["decision"], x["like"]) for x in got} == want


@pytest.mark.parametrize("finish", [0, 20, 10**6])
def test_greedy_accept_rounds(spark, finish):
    """By rounds alone, by rounds and a fold, by a fold alone: a chain, a star and random edges."""
    r = random.Random(21)
    items = [(i, r.random() * 0.8) for i in range(120)]
    edges = {(i + 1, i) for i in range(30)} | {(i, 40) for i in range(41, 60)} | {(max(a, b), min(a, b)) for a, b in (r.sample(range(60, 120), 2) for _ in range(60))}
    taken, want = set(), {}
    for i, ai in items:
        hit = [e for x, e in edges if x == i and e in taken]
        want[i] = ("ai", None) if ai >= 0.7 else ("duplicate", min(hit)) if hit else ("accepted", None)
        if want[i][0] == "accepted":
            taken.add(i)
    got = folds.greedy_accept(spark.createDataFrame(items, "item long, ai double"), spark.createDataFrame(sorted(edges), "item long, earlier long"), finish=finish)
    assert {x["item"]: (x["decision"], x["like"]) for x in got.collect()} == want


def test_stream_history_is_the_batch_history(spark, tmp_path):
    """Arabic and long turns, blanks, and turns that come in several micro-batches."""
    long = "word " * 300
    turns = [(1, 1, "مرحبا", "أهلا"), (1, 2, "what?", long), (1, 3, "", ""), (1, 4, " a \u00a0 b ", None), (2, 1, "", "answer"), (2, 2, long, "سؤال"), (2, 3, "end", "x"), (3, 1, None, None)]
    schema = "conv_id long, turn long, question string, answer string"
    table = spark.createDataFrame(turns, schema)
    want = {r["conv_id"]: (r["n_turns"], r["history"]) for r in folds.chat_history(table).collect()}
    for k in range(1, 5):
        table.where(f"turn = {k}").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    histories = streams.keyed_history(stream)
    query = histories.writeStream.outputMode("update").format("memory").queryName("histories").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.table("histories").collect()
    last = {}
    for r in rows:
        if r["n_turns"] >= last.get(r["conv_id"], (0, ""))[0]:
            last[r["conv_id"]] = (r["n_turns"], r["history"])
    assert last == want


@pytest.mark.parametrize("given, want", [('{"a":1}', True), (" [1] ", True), ("null", True), ("1", True), ('"x"', True), ('{"a":1} and {}', False), ('{"a":1},{"b":2}', False), ('{"a":1}] [{}', False), ('{"a":1}} {"b":{}', False), ('{"a":1},"y":2', False), ("", False), (None, False), ("{", False)])
def test_is_json(spark, given, want):
    assert one(spark, jsonx.is_json(F.col("t")), t=given) is want
    assert (one(spark, jsonx.kind(F.col("t")), t=given) is not None) is want
    assert want or not (given or "").endswith("{}") or one(spark, jsonx.lenient_object(F.col("t")), t=given) == "{}"


def test_flatten_is_whole(spark):
    """Depth, number of rows, number forms, repeated names, and what isn't JSON."""
    import json

    deep = "[" * 300 + "1" + "]" * 300
    rows = [(1, deep), (2, '{"a":1.50,"b":-0,"c":1e3,"d":true,"e":" x  y ","f":{},"g":"","a":2}'), (3, "NaN"), (4, "[1,]"), (5, '"text"'), (6, json.dumps(list(range(50_000)))), (None, "[null]")]
    got = {}
    for r in jsonx.flatten(spark.createDataFrame(rows, "id long, p string"), "id", "p").collect():
        got.setdefault(r["id"], []).append((r["path"], r["value"], r["vtype"]))
    assert got.pop(6) == [(f"[{k}]", str(k), "number") for k in range(50_000)]
    assert got == {1: [("[0]" * 300, "1", "number")], 2: [("a", "2", "number"), ("b", "0", "number"), ("c", "1000.0", "number"), ("d", "true", "boolean"), ("e", "x y", "string"), ("g", None, "null")], 5: [("", "text", "string")], None: [("[0]", None, "null")]}


def test_compared_fields(spark):
    pred = spark.createDataFrame([(1, '{"a":1,"b":"x","c":null,"d":true}'), (2, '{"a":1}'), (4, "bad")], "id long, p string")
    gold = spark.createDataFrame([(1, '{"a":1.0,"b":"y","e":2,"d":1}'), (3, '{"a":1}'), (4, '{"a":1}')], "id long, p string")
    got = {(r["id"], r["path"]): r["correct"] for r in joins.compared_fields(jsonx.flatten(pred, "id", "p"), jsonx.flatten(gold, "id", "p"), "id").collect()}
    assert got == {(1, "a"): True, (1, "b"): False, (1, "c"): True, (1, "d"): True, (1, "e"): False}


def test_edit_distances():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    r = random.Random(4)
    for _ in range(300):
        a, b = ("".join(r.choices("abé ", k=r.randint(0, 12))) for _ in range(2))
        assert arrow_udfs.edits(a, b) == slow(a, b)
        lcs = difflib.SequenceMatcher(None, a, b)  # a lower bound only, so the longest is counted anew
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        assert arrow_udfs.common_length(a, b) == row[-1] >= sum(m.size for m in lcs.get_matching_blocks())


def test_agents(spark, tmp_path):
    from paperloom.operators import agents

    images = spark.createDataFrame([(1, 0, "a.png", "نص"), (1, 1, "b.png", None)], "case_id long, pos int, image_path string, ocr string")
    rows = agents.answer_questions(images, "medical", ["What?"]).collect()
    assert sorted((r["image_id"], r["question_type"]) for r in rows) == [(f"IMG-00{k}", t) for k in (1, 2) for t in ("image_text_consistency", "question")]
    assert agents.overall_confidence(agents.answer_questions(images.limit(0), "x", ["What?"])).count() == 0
    replies = spark.createDataFrame([(1, [("s", "a"), (None, "done"), ("s", "no")]), (2, [("s", str(k)) for k in range(9)]), (3, [])], "case_id long, replies array<struct<tool:string,content:string>>")
    assert {r["case_id"]: (r["model_calls"], len(r["used"]), r["last"]) for r in agents.tool_loop(replies).collect()} == {1: (2, 1, "done"), 2: (6, 5, "5"), 3: (0, 0, "")}
    m = one(spark, agents.with_evidence(F.create_map(F.lit("cold"), F.lit("c"), F.lit("search"), F.lit("s")), "search", F.lit("t")))
    assert m == {"cold": "c", "search": "t"}
    assert one(spark, agents.web_query(F.lit("x"))) == "x في مصر" and one(spark, agents.web_query(F.lit("x مصر"))) == "x مصر"
    docs = spark.createDataFrame([("d1", "i"), ("d2", "j")], "document_id string, image string")
    first = agents.read_in_phases(docs.limit(1), str(tmp_path / "t"), str(tmp_path / "r")).collect()
    again = agents.read_in_phases(docs, str(tmp_path / "t"), str(tmp_path / "r")).collect()
    assert len(first) == 1 and sorted(r["document_id"] for r in again) == ["d1", "d2"]
    asked = spark.createDataFrame([("q", ""), ("it?", "Q: x A: y")], "question string, history string")
    assert [r["question_alone"] for r in agents.rewritten(asked).collect()] == ["q", "it?"]


def test_image_recipes(spark):
    from paperloom.operators import images

    kinds = ["clean_document", "medical_photo", "dark_scene", "underexposed_phone", "general"]
    rows = [(k, 70.0, 30.0, 120.0, 100.0) for k in kinds] + [(k, 150.0, 60.0, 200.0, 400.0) for k in kinds]
    df = spark.createDataFrame(rows, "kind string, mean double, std double, spread double, sharpness double")
    steps = [r["s"] for r in df.coalesce(1).select(images.planned(F.col("kind"), {c: F.col(c) for c in ("mean", "std", "spread", "sharpness")}).alias("s")).collect()]
    assert steps[0] == ["light_sharpen"] and steps[1] == ["clahe", "gentle_sharpen"] and steps[2] == steps[7] == ["clahe", "sharpen"] and steps[4] == ["gamma_1.2", "clahe", "unsharp_mask"]
    assert steps[3] == ["shadow_correction", "gamma_1.3", "white_balance", "clahe", "bilateral_denoise", "morph_closing", "unsharp_mask"]
    assert steps[8] == ["shadow_correction", "clahe", "bilateral_denoise", "unsharp_mask"] and steps[5] == steps[6] == steps[9] == ["none"]
    g = np.arange(24.0).reshape(4, 6) ** 2
    halves = one(spark, images.half_difference(F.array(*map(F.lit, g.ravel().tolist())), 6))
    assert abs(halves - max(abs(g[:2].mean() - g[2:].mean()), abs(g[:, :3].mean() - g[:, 3:].mean()))) < 1e-9
    assert one(spark, images.half_difference(F.array(F.lit(5.0)), 1)) == 0
    pages = spark.createDataFrame([("d", 1, "PASS", 400.0), ("d", 2, "WARNING", 200.0)], "doc string, page int, tier string, sharpness double")
    assert tuple(images.page_summary(pages, "doc").first()) == ("d", 2, 1, [2], 300.0, "WARNING")
    v = providers.call(spark.createDataFrame([("a",)], "t string"), "embed_image", ["t"], "e").first()["e"]
    assert len(v) == 512 and abs(sum(x * x for x in v) - 1) < 1e-5
    b = providers.call(spark.createDataFrame([("a",)], "t string"), "detect", ["t"], "b").first()["b"]
    assert len(b) == 2 and 0 <= b[0]["conf"] <= 1


def test_inquiry(spark):
    rows = spark.createDataFrame([(1, ["vqa", "vqa"]), (2, ["search", "vqa", "search"]), (3, ["report"])], "case_id long, steps array<string>")
    assert {r["case_id"]: r["path"] for r in folds.inquiry(rows).collect()} == {1: "vqa>report", 2: "search>vqa>report", 3: "report"}


def test_sources(spark, tmp_path):
    (tmp_path / "a.srt").write_text("1\n00:00:01,500 --> 00:00:02,000\n<i>Hi</i>\nthere\n\n2\n00:01:00,000 --> 00:01:01,000\n\n")
    got = [(r["start_ms"], r["end_ms"], r["text"]) for r in readers.read_captions(spark, str(tmp_path)).collect()]
    assert got == [(1500, 2000, "Hi there")]
    assert readers.column_roles(["ID", "IMAGE", "MEDICINE_NAME"]) == ("IMAGE", "MEDICINE_NAME")
    files = spark.createDataFrame([("/a/1.wav",), ("/a/1.txt",), ("/a/2.wav",)], "path string")
    assert [r["stem"] for r in joins.paired_media(files, [".wav"], ".txt").collect()] == ["/a/1"]
    assert readers.json_or_empty(spark, str(tmp_path / "missing.json"), "a string").count() == 0
    jobs = spark.createDataFrame([("x.png", None)], "p string, q string").select(F.lit(None).cast("string").alias("audio_base64"), F.lit("data:audio/wav;base64,QUJD").alias("voice_base64"), F.lit(None).cast("array<string>").alias("images_base64"), F.array("p", F.lit("!!")).alias("images"))
    r = readers.job_inputs(jobs).first()
    assert (r["voice"], r["image_inputs"], r["skipped"]) == ("QUJD", ["x.png"], 1)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id long, v string")
    path = str(tmp_path / "t")
    assert writers.append_missing(rows, path, "id") == 2
    assert writers.append_missing(rows, path, "id") == 0
    writers.write_lines(rows, rules.yolo_line(F.lit(3), F.struct(*(F.lit(0.5).alias(x) for x in ("xc", "yc", "w", "h")))), str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).first()[0] == "3 0.500000 0.500000 0.500000 0.500000"
    report = writers.report("m", rows.agg(F.count("*").alias("n")), rows).collect()
    assert [r["content"] for r in report if r["part"] == "summary"] == ['{"n":3}'] and sum(r["part"] == "result" for r in report) == 3


def test_providers(spark):
    df = spark.createDataFrame([("b a",), ("a b",), ("",)], "t string")
    v = [r["e"] for r in providers.call(df, "embed", ["t"], "e").collect()]
    assert v[0] == v[1] and sum(v[2]) == 0
    m = spark.range(1).select(providers.merged_passes(F.create_map(F.lit("a"), F.lit("1")), F.array(F.create_map(F.lit("a"), F.lit("2"), F.lit("b"), F.lit("3")))).alias("m")).first()["m"]
    assert m == {"a": "1", "b": "3"}


def test_streams_match_tables(spark, sf_dir):
    stream = streams.windowed(streams.event_stream(spark, sf_dir))
    table = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {tuple(r) for r in streams.run_to_table(stream, "stream_windows").collect()}
    want = {tuple(r) for r in streams.windowed(table).collect()}
    assert got <= want and len(got) > 0.95 * len(want)
    once = streams.run_to_table(streams.deduplicated(streams.event_stream(spark, sf_dir), ["event_id"]), "stream_once")
    assert once.count() == table.count()


def test_similarity_over_many_centres(spark):
    """Both similarity joins equal brute force over many small shards: clusters, a hot vector, ties, rows that take no part."""
    r = np.random.default_rng(5)
    middles = r.normal(size=(12, 8))
    x = middles[r.integers(0, 12, 500)] * r.uniform(0.5, 2, (500, 1)) + r.normal(size=(500, 8)) * 0.05
    x[::3] = x[0]
    x[1] = 0
    x = np.round(x, 2)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0, None] + [0.0] * 6), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (None, [1.0] * 8)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    s = np.round(x @ x.T, 6)
    np.fill_diagonal(s, -np.inf)
    order = [sorted(range(500), key=lambda j, i=i: (-s[i, j], j)) for i in range(500)]
    for k, bar in ((3, None), (3, 4.0), (200, None), (600, 1.0)):
        for rows_a_task in (16, 8192):
            got = {(a, b, n): c for a, b, c, n in (tuple(t) for t in joins.top_k_similar(v, v, k, bar, rows_a_task).collect())}
            want = {(i, j, n + 1): s[i, j] for i in range(500) for n, j in enumerate(order[i][: min(k, 499)]) if bar is None or s[i, j] >= bar}
            assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in got)
    for bar in (3.0, 9.0):
        pairs = [tuple(t) for t in joins.alike_pairs(v, bar, 16).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == {(i, j) for i in range(500) for j in range(i) if s[i, j] >= bar}


def test_similarity_skips_centres(spark):
    """Of clusters far from each other a query visits few."""
    r = np.random.default_rng(6)
    x = (np.eye(16) * 5)[r.integers(0, 16, 400)] + r.normal(size=(400, 16)) * 0.05
    v = spark.createDataFrame([(i, t.tolist()) for i, t in enumerate(x)], "vec_id long, embedding array<double>")
    centres = joins.Centres(v, 10)
    asked = v.select("vec_id", "embedding", F.lit(-1).alias("seen"), F.lit(20.0).alias("bar"))
    assert centres.visits(asked).count() < 0.25 * 400 * len(centres.points)


def test_empty_tables(spark):
    v = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert joins.top_k_similar(v, v, 3).count() == 0
    t = spark.createDataFrame([], "k long, o long, v string")
    assert windows.drop_repeats(t, ["k"], ["o"], "v").count() == 0
    assert metrics.fraud_summary(spark.createDataFrame([], "passed boolean, ai boolean, same boolean, other boolean, error boolean")).first()["pass_rate"] == "0.0%"


def test_plans(spark, sf_dir):
    """Filters and columns reach the scan; top-k keeps a limit within groups."""
    from paperloom.plans.catalogue import QUERIES

    plan = QUERIES["user_pushdown"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(label,3)" in plan and "embedding" not in plan.split("ReadSchema")[1]
    assert "CartesianProduct" not in QUERIES["interval_overlap"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_files(spark, tmp_path):
    from paperloom.sources import files

    (tmp_path / "in" / "x").mkdir(parents=True)
    (tmp_path / "in" / "x" / "BC_1.txt").write_text("a")
    assert files.find_scan_folder(str(tmp_path), ["none"]).name == "x"
    assert files.pick(["/b/Train.csv", "/a/test.csv"], "train") == "/b/Train.csv"
    archive = files.zip_folder(str(tmp_path / "in"), str(tmp_path / "a.zip"))
    assert files.unzip(archive, str(tmp_path / "out")) == ["x/BC_1.txt"]
    calls = []

    def call(x):
        calls.append(x)
        if len(calls) == 1:
            raise OSError
        return x * 2

    assert list(files.throttled([1, 2], call, gap=0, sleep=lambda s: None)) == [2, 4]
    states = iter(["QUEUED", "COMPLETED"])
    assert files.poll(lambda: next(states), sleep=lambda s: None) == "COMPLETED"
    rows = spark.createDataFrame([(1, 0.7), (2, 0.2), (3, None)], "id long, s double")
    good, rest = files.score_split(rows, "s", 0.6)
    assert (good.count(), rest.count()) == (1, 2)
    record = spark.createDataFrame([('{"ids":{"child_national_id":"5"},"personal_and_other":{"child":{"name":""}}}',)], "p string")
    assert files.present_fields(record, "p").first()["present"] == ["child_national_id"]
    listing = spark.createDataFrame([("/d/a.png",)], "path string")
    got = files.resolved(spark.createDataFrame([("q\\a.png",), ("z.png",)], "p string"), "p", listing)
    assert {r["p"]: r["resolved"] for r in got.collect()} == {"q\\a.png": "/d/a.png", "z.png": None}
    assert files.run_counts(spark.createDataFrame([(True,), (False,)], "saved boolean")).first() == (1, 1)
    both = providers.call(spark.createDataFrame([("a b", "b c")], "x string, y string"), "text_similarity", ["x", "y"], "s")
    assert both.first()["s"] == 0.5


def test_image_kernels(spark):
    import numpy as np

    g = np.arange(25, dtype=float).reshape(5, 5) ** 2
    inner = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    assert arrow_udfs.variance_of_laplacian(g) > 0 and inner.std() == 0
    df = spark.createDataFrame([([float(x) for x in g.ravel()], 5)], "p array<double>, w int")
    s = df.select(arrow_udfs.image_stats("p", "w").alias("s")).first()["s"]
    assert abs(s["mean"] - g.mean()) < 1e-9 and s["clipped"] == int(((g <= 0) | (g >= 255)).sum())
    out = df.select(arrow_udfs.enhanced("p", F.lit(1.0)).alias("e")).first()["e"]
    assert min(out) == 0 and max(out) == 255
    packed = spark.createDataFrame([([1.5, -2.0],)], "v array<float>").select(arrow_udfs.unpack_floats(arrow_udfs.pack_floats("v")).alias("v"))
    assert packed.first()["v"] == [1.5, -2.0]


def test_json_records(spark):
    r = one(spark, jsonx.certificate_defaults(F.lit('{"ids":{"other_ids":[{"label_ar":"x","value":"1","more":2},5]},"birth_certificate":{"serial_number":"9"}}')))
    assert r["birth_certificate"]["serial_number"] == "9" and r["personal_and_other"]["child"]["name"] is None and r["review_required"] is False
    import json

    empty = json.loads(one(spark, jsonx.fallback_record(F.lit("d"), F.array(F.lit("a.png")), F.lit("bad"))))
    assert len(empty) == 35 and empty["review_notes"] == ["bad"] and empty["assets"] == [] and empty["phone"] is None
    fixed = one(spark, jsonx.repaired_search(F.lit("nothing")))
    assert fixed["pricing"] == "[]" and fixed["raw_fallback"] == "nothing"
    m = one(spark, jsonx.metadata(F.lit('"{\\"a\\":\\"1\\"}"'), F.create_map(F.lit("a"), F.lit("2"))))
    assert m == {"a": "2"}
    texts = spark.createDataFrame([('[[[[0,0]],["one",0.9]],{"rec_texts":["two"]}]',), ("bad",)], "j string").select(arrow_udfs.harvest_texts("j").alias("t")).collect()
    assert [r["t"] for r in texts] == [["one", "two"], []]
