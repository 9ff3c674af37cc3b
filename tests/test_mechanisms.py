"""Turn rounds, schemas, indexes, stores, sinks, streams and selection against sequential or exhaustive twins."""

import datetime as dt
import difflib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.functions import arrow_udfs, jsonx, schemas
from paperloom.functions import constants as K
from paperloom.operators import components, dialogue, folds, joins, providers, selection
from paperloom.sources import part_log, vector_pages, writers
from paperloom.sources.keyed_store import KeyedStore
from paperloom.sources.part_log import BatchTable, Entry, Part
from paperloom.streaming import streams


@pytest.fixture
def url(tmp_path):
    return f"file://{tmp_path}"


# --- conversations (STA7) ----------------------------------------------------------------------


def test_rounds_equal_a_sequential_run(spark, url):
    """Each conversation by itself, a turn after the other, in plain Python."""
    import re

    r = random.Random(2)
    words = "alpha beta gamma بيت delta نور epsilon zeta".split()
    passages = [(i, str(i), "ar" if i % 3 == 0 else "en", f"{r.choice(words)} {i}?", " ".join(r.choices(words, k=6)), ["t"]) for i in range(9)]
    said = lambda: " ".join(r.choices(words, k=r.randint(0, 25)))
    turns = [(c, k, said() if k % 4 else f"  {said()}\n") for c in range(5) for k in range(r.randint(1, 5))] + [(None, 0, "alpha"), (None, 1, None), (7, 3, "beta"), (7, 3, "beta")]
    got = dialogue.converse(spark.createDataFrame(turns, "conv_id long, turn int, question string"), spark.createDataFrame(passages, "vec_id long, faq_id string, lang string, question string, answer string, tags array<string>"), 3, folder=f"{url}/run")
    rows = got.collect()
    embed, chat, rewriter = providers.stub_embedder(), providers.stub_chat(), providers.stub_rewriter()
    import pandas as pd

    vector = lambda t: np.asarray(embed(pd.DataFrame({"t": [t]}))[0], float)
    store = [(p, vector(f"passage: Q: {p[3]}\nA: {p[4]}\nFAQ ID: {p[1]}\nTags: t")) for p in passages]
    squeeze = lambda t: " ".join((t or "").split())
    arabic = lambda t: bool(re.search("[؀-ۿ]", t))
    want = []
    for conv in {t[0] for t in turns}:
        history = ""
        for _, turn, question in sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1], t[2] or "")):
            q = query = squeeze(question)
            lang = "ar" if arabic(q or history) else "en"
            if q and history:
                reply = json.loads(rewriter(pd.DataFrame({"h": [history], "q": [q]}))[0].removeprefix("Here it is: "))
                new = squeeze(reply["rewrite"])
                query = new if reply["depends"] and new and len(new) <= max(40, int(len(q) * 2.2)) else q
            v = vector(f"query: {query}")
            near = sorted(store, key=lambda s: (-round(float(v @ s[1]), 6), s[0][0]))[:6]
            hits = ([s[0] for s in near if s[0][2] == lang] + [s[0] for s in near if s[0][2] != lang])[:3]
            blocks = [("س: {3}\nج: {4}\nالمصدر: {4}" if h[2] == "ar" else "Q: {3}\nA: {4}\nSource: {4}").format(*h) for h in hits]
            reply = chat(pd.DataFrame({"p": ["\n\n".join(filter(None, [dialogue.TASK["ar" if arabic(query) else "en"], query, "\n\n---\n\n".join(blocks)]))]}))[0]
            answer = re.sub(r"[^؀-ۿ0-9\s.،؛:!؟()\-/]", "", reply) or (K.INSUFFICIENT_AR if lang == "ar" else K.INSUFFICIENT_EN)
            entity = min((h[3] for h in hits), key=len)
            history = streams.after_turn(history, q, f"({entity}) {answer}" if entity not in answer else answer)
            want.append((conv, turn, q, query, [h[1] for h in hits], answer, history))
    have = [tuple(x[c] for c in ("conv_id", "turn", "question", "query", "ids", "answer", "history")) for x in rows]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_rounds_go_on_where_they_ended(spark, url):
    """A second run over the same folder asks nothing again; a lost round is made anew, and the index once."""
    calls = []

    class Counted(dialogue.Index):
        def __init__(self, *args):
            calls.append(1)
            super().__init__(*args)

    turns = spark.createDataFrame([(c, k, f"q {c} {k}") for c in range(3) for k in range(3)], "conv_id long, turn int, question string")
    passages = spark.createDataFrame([(1, "1", "en", "q?", "a", [])], "vec_id long, faq_id string, lang string, question string, answer string, tags array<string>")
    own, dialogue.Index = dialogue.Index, Counted
    try:
        first = sorted(map(tuple, dialogue.converse(turns, passages, folder=f"{url}/r").collect()), key=repr)
        assert len(calls) == 1 and len(first) == 9
        again = sorted(map(tuple, dialogue.converse(turns, passages, folder=f"{url}/r").collect()), key=repr)
        assert len(calls) == 1 and again == first
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{url}/r/rounds/n=3/_SUCCESS")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
        assert sorted(map(tuple, dialogue.converse(turns, passages, folder=f"{url}/r").collect()), key=repr) == first and len(calls) == 2
    finally:
        dialogue.Index = own
    empty = dialogue.converse(turns.limit(0), passages, folder=f"{url}/none")
    assert empty.count() == 0 and empty.columns == ["conv_id", "turn", "question", "query", "ids", "answer", "history"]
    nothing = dialogue.converse(turns, passages.limit(0), folder=f"{url}/no-passages").collect()
    assert len(nothing) == 9 and {x["answer"] for x in nothing} == {K.INSUFFICIENT_EN}


# --- schemas (JSN13) ---------------------------------------------------------------------------


def errors_of(spark, schema, *records):
    rows = spark.createDataFrame([(r if isinstance(r, (str, type(None))) else json.dumps(r),) for r in records], "p string").coalesce(1)
    return [x["e"] for x in rows.select(schemas.compiled(schema)(F.col("p")).alias("e")).collect()]


def test_case_schema(spark):
    good = {k: None for k in schemas.case_schema()["properties"]}
    good.update(document_id="d", source_files=["a"], page_count=1, family_members=[], attachments=[], assets=[], uncertain_fields=[], review_required=False, review_notes=[])
    member = dict.fromkeys(K.MEMBER_FIELDS, "x")
    bad = {**good, "family_members": [member, {**member, "age": 5}, {k: v for k, v in member.items() if k != "age"}, "none"], "page_count": 0, "zz": 1, "aa": 2}
    got = errors_of(spark, schemas.case_schema(), good, bad, {**good, "page_count": 1.0, "document_id": ""}, "[]", "{", None)
    assert got[0] == [] and got[2] == ["document_id: '' should be non-empty"] and got[3] == ["<root>: [] is not of type 'object'"] and got[4] == got[5] == ["<root>: is not JSON"]
    assert got[1] == [
        "<root>: Additional properties are not allowed ('aa', 'zz' were unexpected)",
        "family_members.1.age: 5 is not of type 'string', 'null'",
        "family_members.2: 'age' is a required property",
        "family_members.3: 'none' is not of type 'object'",
        "page_count: 0 is less than the minimum of 1",
    ]


def test_schema_keywords(spark):
    schema = {
        "type": "object",
        "$defs": {"small": {"type": "number", "exclusiveMaximum": 10}},
        "properties": {
            "e": {"enum": ["a", 1, None, True]}, "c": {"const": "x"}, "p": {"pattern": "^a+$", "maxLength": 2}, "l": {"minItems": 2, "maxItems": 3, "items": {"items": {"$ref": "#/$defs/small"}}},
            "any": {"anyOf": [{"type": "string"}, {"type": "integer", "minimum": 5}]}, "all": {"allOf": [{"minimum": 1}, {"maximum": 2}]}, "it's": {"type": "boolean"},
        },
        "additionalProperties": {"type": "integer"},
    }
    records = [
        {"e": "a", "c": "x", "p": "aa", "l": [[1], []], "any": 5, "all": 1.5, "it's": True, "more": 3},
        {"e": "b", "c": "y", "p": "ab c", "l": [[1, "z", 10]], "any": 4, "all": 3, "it's": "no", "more": 1.5},
        {"e": 1.0, "l": [1, 2, 3, 4]}, {"e": False, "any": None}, {"e": True}, {"e": None},
    ]
    got = errors_of(spark, schema, *records)
    assert got[0] == got[4] == got[5] == []
    assert got[1] == sorted([
        "e: 'b' is not one of ['a', 1, None, True]", "c: 'x' was expected", "p: 'ab c' does not match '^a+$'", "p: 'ab c' is too long", 'l: [[1,"z",10]] is too short',
        "l.0.1: 'z' is not of type 'number'", "l.0.2: 10 is greater than or equal to the minimum of 10".replace("minimum", "maximum"), "any: 4 is not valid under any of the given schemas",
        "all: 3 is greater than the maximum of 2", "it's: 'no' is not of type 'boolean'", "more: 1.5 is not of type 'integer'",
    ])
    assert got[2] == ["l: [1,2,3,4] is too long"] and got[3] == ["any: None is not valid under any of the given schemas", "e: False is not one of ['a', 1, None, True]"]
    for wrong in ({"uniqueItems": True}, {"properties": {"a": {"not": {}}}}, {"$ref": "#/$defs/a", "$defs": {"a": {"$ref": "#/$defs/a"}}}):
        with pytest.raises(ValueError):
            errors_of(spark, wrong, {"a": 1})


# --- nearest names and best tokens (JOI13, JOI12) ----------------------------------------------


@pytest.mark.parametrize("accept", [67, 75, 90])
def test_name_index_loses_nothing(accept):
    r = random.Random(accept)
    words = ["".join(r.choices("abcde", k=r.randint(1, 6))) for _ in range(40)] + ["بيت", "é", "a"]
    names = sorted({" ".join(r.choices(words, k=r.randint(1, 4))) for _ in range(400)})
    index, scored = joins.NameIndex(names, list(range(len(names)))), 0
    for _ in range(300):
        query = " ".join(w[: (k := r.randrange(len(w)))] + r.choice(["", "x", w[k]]) + w[k + 1 :] for w in r.choices(words, k=r.randint(1, 4)))
        every = [round(arrow_udfs.token_set(query, n), 6) for n in names]
        found, n = index.best(query, accept)
        scored += n
        have = {(i, round(x, 6)) for i, x in found}
        if max(every) >= accept:
            best = {(i, x) for i, x in enumerate(every) if x == max(every)}
            assert best <= have and all(x <= max(every) for _, x in have)
        else:
            assert all(x < accept for _, x in have)
    assert scored < 0.2 * 300 * len(names)


def test_distances_take_a_row_at_a_time(spark):
    """Whole texts and their words stay Arrow arrays but for the row that is compared."""
    import pyarrow as pa

    held = []

    def read(x):
        held.append(x)
        return x.as_py()

    assert arrow_udfs._distances(pa.array(["abc", None, "", "same"]), pa.array(["abd", "x", "xy", "same"]), read).to_pylist() == [1, None, 2, 0]
    assert len(held) == 4  # what is null or equal is never read
    rows = spark.createDataFrame([(["a", "b"], ["b"]), ([], ["a", None]), (None, ["a"])], "a array<string>, b array<string>")
    assert [x[0] for x in rows.coalesce(1).select(arrow_udfs.list_distance("a", "b")).collect()] == [1, 2, None]


def test_splits_compare_each_reading_once(spark, sf_dir):
    from paperloom.plans.catalogue import QUERIES

    plan = QUERIES["splits_union_metrics"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("EvalPython") == 1


def test_name_index_scores_many_at_once(monkeypatch):
    """Candidates are scored in blocks, as ``token_set`` scores them; only long ones are scored one by one."""
    r = random.Random(3)
    words = ["".join(r.choices("abcde éب", k=r.randint(1, 9))) for _ in range(60)]
    names = [" ".join(r.choices(words, k=r.randint(1, 9))) for _ in range(200)] + ["", "  ", "x" * 300, " ".join(f"w{i}" for i in range(40)), "y" * 70]
    index = joins.NameIndex(names, list(range(len(names))))
    for query in names[::3] + ["a" * 63, "a" * 64, "b " + "a" * 61, "zz", names[0] + "s"]:
        assert index._scores(query, np.arange(len(names))).tolist() == [arrow_udfs.token_set(query, n) for n in names]
    short = [f"http site{i % 7} example org en {i}" for i in range(400)]
    index = joins.NameIndex(short, list(range(400)))
    monkeypatch.setattr(joins, "token_set", None)
    assert [index.best(n.replace("e", "a"), 75)[0][0][0] for n in short[::40]] == list(range(0, 400, 40))


def test_name_index_scores_few_of_like_names():
    """Addresses share most pairs of letters; misspelt ones without a near name are told from nearly all by their letters, and nothing is lost."""
    r = random.Random(8)
    hosts = ["".join(r.choices(["th", "er", "ing", "tion", "st", "bl"], k=2)) for _ in range(20)]
    names = sorted({f"http{r.choice(['', 's'])} {r.choice(['www ', 'm ', ''])}{r.choice(hosts)} example {r.choice(['com', 'org', 'net'])} {r.choice(['en', 'de'])} {r.randrange(10**5)}{r.choice(['', ' html', ' page 2 ref x'])}" for _ in range(1500)})
    index, scored = joins.NameIndex(names, list(range(len(names)))), 0
    queries = [n.replace("e", "a").replace("o", "u") for n in names[::15]] + [n + "s" for n in names[::75]] + [n[1:] for n in names[1::75]] + [names[7], ""]
    for query, (found, n) in zip(queries, index.bests(queries, 75), strict=True):
        every = [round(arrow_udfs.token_set(query, x), 6) for x in names]
        best = {(i, x) for i, x in enumerate(every) if x == max(every)} if max(every) >= 75 else set()
        assert best <= {(i, round(x, 6)) for i, x in found} and (best or not found)
        scored += n
    assert scored < 0.03 * len(queries) * len(names)
    # A score known from elsewhere leaves out what is below, and only that.
    known = [max(arrow_udfs.token_set(query, x) for x in names) if k % 2 else 99.0 for k, query in enumerate(queries)]
    for query, floor, (found, n), (again, m) in zip(queries, known, index.bests(queries, 75), index.bests(queries, 75, known), strict=True):
        want = {x for x in found if round(x[1], 6) >= round(max(floor, 75), 6)}
        assert m <= n and want <= set(again) and all(x[1] >= floor - 3e-6 for x in again)


def test_catalog_shards_take_known_scores(spark, monkeypatch):
    """Names that share a rare word are scored before the shards, which then score next to nothing more; rows are those of one shard."""
    r = random.Random(9)
    names = [(i, f"http {r.choice(['www', 'm'])} {r.choice(['thering', 'ststion', 'blth'])} example {r.choice(['com', 'org'])} {r.randrange(10**6)} html") for i in range(1200)] + [(5000, "  "), (5001, None)]
    queries = [(i, n.replace("e", "a") if i % 2 else n[1:]) for i, n in names[:1200:8]] + [(9000, ""), (9001, None), (9002, "zz qq")]
    q, c = spark.createDataFrame(queries, "query_id long, query string"), spark.createDataFrame(names, "row_id long, name string")
    one = {x["query_id"]: x for x in joins.catalog_match(q, c, ["name"], with_cost=True).collect()}
    many = {x["query_id"]: x for x in joins.catalog_match(q, c, ["name"], names_a_task=100, with_cost=True).collect()}
    assert one.keys() == many.keys() and all((one[k]["row_id"], one[k]["score"]) == (many[k]["row_id"], many[k]["score"]) for k in one)
    assert all(many[i]["row_id"] == i for i, _ in names[:1200:8])
    monkeypatch.setattr(joins, "_by_rare_words", lambda asked, entries, tasks: asked.select("text", F.lit(None).cast("double").alias("known"), F.lit(0).cast("long").alias("scored")))
    alone = {x["query_id"]: x for x in joins.catalog_match(q, c, ["name"], names_a_task=100, with_cost=True).collect()}
    assert all((alone[k]["row_id"], alone[k]["score"]) == (many[k]["row_id"], many[k]["score"]) for k in alone)
    assert 3 * sum(x["scored"] for x in many.values()) < sum(x["scored"] for x in alone.values())


def test_catalog_reports_what_it_scored(spark):
    r = random.Random(4)
    names = [(i, " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(3))) for i in range(600)]
    queries = [(i, n[:-1]) for i, n in names[::6]] + [(9000, "zzzz"), (9001, None)]
    got = joins.catalog_match(spark.createDataFrame(queries, "query_id long, query string"), spark.createDataFrame(names, "row_id long, name string"), ["name"], names_a_task=200, with_cost=True).collect()
    by = {x["query_id"]: x for x in got}
    assert all(by[i]["row_id"] == i for i, _ in names[::6]) and by[9000]["row_id"] is None and by[9001]["scored"] == 0
    assert sum(x["scored"] for x in got) < 0.05 * 600 * 100


def test_best_token_bound(spark):
    """The bound only leaves out what can't win: the same rows as when all pairs are scored."""
    r = random.Random(6)
    word = lambda: "".join(r.choices("aeinrst😀بé ", k=r.randint(0, 9)))
    tokens = [(d, k, word()) for d in range(12) for k in range(r.randint(1, 25))] + [(3, 99, "x" * 600), (3, 100, None)]
    fields = [(d, f, word() if f != "long" else "x" * 590) for d in range(13) for f in ("a", "b", "long")]
    t, f = spark.createDataFrame(tokens, "document_id long, pos int, text string"), spark.createDataFrame(fields, "document_id long, field string, target string")
    got = joins.best_token_match(f, t, with_cost=True).collect()
    seen = {}
    for d, field, target in fields:
        own = [(k, x or "") for e, k, x in tokens if e == d]
        own_null = [(k, x) for e, k, x in tokens if e == d]
        pairs = [(x or "", 0, k) for k, x in own] + [(" ".join(y for y in (own_null[i][1], own_null[i + 1][1]) if y is not None), 1, own[i][0]) for i in range(len(own) - 1) if own_null[i + 1][1] is not None]
        if pairs:
            seen[d, field] = min((-round(difflib.SequenceMatcher(None, target, x).ratio(), 6), p, k, x) for x, p, k in pairs), len(pairs)
    assert {(x["document_id"], x["field"]): (-x["score"], x["text"] or "") for x in got} == {k: (b[0], b[3]) for k, (b, _) in seen.items()}
    letters = "abcdefghijklmnopqrstuvwxyz"
    tokens = [(1, k, "".join(r.choices(letters, k=6))) for k in range(80)]
    fields = [(1, str(k), t[:2] + "é" + t[3:]) for _, k, t in tokens[::8]]
    got = joins.best_token_match(spark.createDataFrame(fields, "document_id long, field string, target string"), spark.createDataFrame(tokens, "document_id long, pos int, text string"), with_cost=True).collect()
    assert {x["field"]: x["text"] for x in got} == {str(k): t for _, k, t in tokens[::8]} and sum(x["scored"] for x in got) < 0.1 * sum(x["pairs"] for x in got)


# --- stores and sinks (SNK6, SNK8, STA8) -------------------------------------------------------


def test_keyed_store_equals_a_replay(spark, url):
    store = KeyedStore(spark, f"{url}/store", "id", "id long, v string, e array<float>")
    assert store.snapshot().count() == 0 and not store.compact()
    r, want, seen = random.Random(1), {}, {}
    rows_of = lambda rows: spark.createDataFrame(rows, "e array<float>, id long, v string")
    for step, what in enumerate("uududcuuddcudv"):
        if what == "u":
            rows = [([float(step)], i, f"{step}-{i}") for i in r.sample(range(30), 8)]
            store.upsert(rows_of(rows + rows[:2]))
            want.update({i: v for _, i, v in rows})
        elif what == "d":
            ids = r.sample(range(40), 5)
            store.delete(spark.createDataFrame([(i,) for i in ids], "id int"))
            want = {i: v for i, v in want.items() if i not in ids}
        elif what == "c":
            assert store.compact()
        else:
            assert store.vacuum(keep=2) > 0
        assert {x["id"]: x["v"] for x in store.snapshot().collect()} == want
        seen[store.log.entry().version] = dict(want)
    assert len(store.log.versions()) == 2
    for version in store.log.versions():
        assert {x["id"]: x["v"] for x in store.snapshot(version).collect()} == seen[version]
    plan = store.of_user("v", "x")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(v,x)" in plan
    with pytest.raises(Exception, match="has no id"):
        store.upsert(rows_of([([1.0], None, "x")]))


def test_readers_and_writers_during_compaction(spark, url):
    """A reader keeps its snapshot; what is put in while a compaction writes is a delta after it; the second of two compactions gives up."""
    store = KeyedStore(spark, f"{url}/store", "id", "id long, v string")
    rows_of = lambda *ids, v="a": spark.createDataFrame([(i, v) for i in ids], "id long, v string")
    store.upsert(rows_of(1, 2, 3))
    store.upsert(rows_of(2, v="b"))
    reader = store.snapshot()
    other = KeyedStore(spark, f"{url}/store", "id", "id long, v string")
    write = store.log.write

    def slow(rows):
        name = write(rows)
        other.upsert(rows_of(3, v="late"))
        other.delete(rows_of(1).select("id"))
        return name

    store.log.write = slow
    assert store.compact()
    store.log.write = write
    assert {x["id"]: x["v"] for x in reader.collect()} == {1: "a", 2: "b", 3: "a"}
    assert {x["id"]: x["v"] for x in store.snapshot().collect()} == {2: "b", 3: "late"}
    assert [p.base for p in store.log.entry().parts] == [True, False, False]

    def overtaken(rows):
        name = write(rows)
        assert other.compact()
        return name

    store.log.write = overtaken
    assert not store.compact()
    assert {x["id"]: x["v"] for x in store.snapshot().collect()} == {2: "b", 3: "late"}


def test_an_entry_has_one_writer(spark, url):
    log = part_log.PartLog(spark, f"{url}/log-of-two")
    assert log._entered(Entry(1, (Part("x", 1),))) and not log._entered(Entry(1, (Part("y", 1),)))
    assert log.entry().parts == (Part("x", 1),)
    entered = log.enter(lambda last: Entry(0, (*last.parts, Part("z", last.version + 1)), {"run": 3}))
    assert entered.version == 2 and log.entry().done == {"run": 3} and log.entry(1).parts == (Part("x", 1),)


def test_batches_are_added_once(spark, url):
    """Killed between writing and entering, a stream gives each row once after its restart, and reads nothing of what is there."""
    schema = "id long, v string"
    for k in range(4):
        spark.createDataFrame([(10 * k + i, "x") for i in range(5)], schema).coalesce(1).write.mode("append").parquet(f"{url}/in")
    table = BatchTable(spark, f"{url}/out", schema)
    enter, fails, seen = table.log.enter, [2], []

    def failing(change):
        if fails and len(seen) == fails[0]:
            fails.clear()
            raise OSError("killed after the files, before the entry")
        seen.append(1)
        return enter(change)

    table.log.enter = failing

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{url}/in")
        stream.writeStream.foreachBatch(table.sink("s")).option("checkpointLocation", f"{url}/check").trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception):  # noqa: B017
        run()
    assert table.rows().count() < 20
    run()
    assert sorted(x["id"] for x in table.rows().collect()) == sorted(10 * k + i for k in range(4) for i in range(5))
    assert not table.add("s", 0, spark.createDataFrame([(1, "again")], schema))
    assert table.fold() and not table.fold() and len(table.log.entry().parts) == 1 and table.rows().count() == 20
    assert table.log.vacuum() >= 4 and table.rows().count() == 20 and not table.add("s", 1, spark.createDataFrame([(1, "again")], schema))


def test_autosave_goes_on(spark, url):
    table, asked = BatchTable(spark, f"{url}/saved", "id long"), []

    def batch(k):
        def make():
            asked.append(k)
            if k == 2 and asked.count(2) == 1:
                raise OSError
            return spark.createDataFrame([(k,)], "id long")

        return make

    with pytest.raises(OSError):
        writers.autosave([batch(k) for k in range(4)], table, "run")
    assert writers.autosave([batch(k) for k in range(4)], table, "run") == 2 and asked == [0, 1, 2, 2, 3]
    assert sorted(x["id"] for x in table.rows().collect()) == [0, 1, 2, 3]


# --- pages of vectors (SRC14, SRC15) -----------------------------------------------------------


def test_vector_pages(spark, url, tmp_path):
    """One user's pages are the only ones read: the others may be broken; columns that aren't wanted aren't decoded."""
    rows = [(str(i), f"user/{i % 3} é", {"k": "v", "n": None} if i % 2 else {}, [float(i), 0.5]) for i in range(50)] + [("no vector", "u", {}, [])]
    store = spark.createDataFrame(rows, "embedding_id string, user_id_hash string, metadata map<string,string>, embedding array<float>")
    vector_pages.save_pages(store, f"{url}/api", rows_a_page=7)
    got = {x["embedding_id"]: (x["user_id_hash"], x["metadata"], x["embedding"]) for x in vector_pages.read_pages(spark, f"{url}/api").collect()}
    assert got == {i: (u, m, e) for i, u, m, e in rows if e}
    assert vector_pages.read_pages(spark, f"{url}/api", ["embedding_id"]).rdd.getNumPartitions() == 8
    for page in (tmp_path / "api" / "all").iterdir():
        page.write_text("broken")
    mine = vector_pages.read_pages(spark, f"{url}/api", user="user/1 é")
    assert sorted(int(x["embedding_id"]) for x in mine.collect()) == list(range(1, 50, 3)) and mine.rdd.getNumPartitions() == 3
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan or "user_id_hash" not in plan.split("Filter (")[1].split("BatchScan")[0].replace("isnotnull(user_id_hash", "")
    assert vector_pages.read_pages(spark, f"{url}/api", user="nobody").count() == 0
    plain = [{"id": "1", "embedding": "!!!! no base64", "metadata": '{"a": {"b": 1}}', "userIdHash": "x"}, {"id": "2"}, 5]
    for name, reply in (("list", plain), ("data", {"data": plain})):
        (tmp_path / name / "all").mkdir(parents=True)
        (tmp_path / name / "all" / "pages").write_text("1")
        (tmp_path / name / "all" / "0").write_text(json.dumps(reply))
        assert [(x["embedding_id"], x["metadata"]) for x in vector_pages.read_pages(spark, f"{url}/{name}", ["embedding_id", "metadata"]).collect()] == [("1", {"a": '{"b": 1}'})]


# --- streams (STA6) ----------------------------------------------------------------------------


def test_turns_in_order(spark, url):
    """Turns shuffled over several micro-batches within the watermark give the histories of the ordered fold."""
    r, start = random.Random(4), dt.datetime(2024, 1, 1)
    schema = "conv_id long, ts timestamp, turn long, question string, answer string"
    rows = [(c, start + dt.timedelta(minutes=3 * k, seconds=c), k, f"q{c} {k} " + "x" * r.randint(0, 200), None if k == 2 else f"a {k}") for c in range(6) for k in range(8)]
    shuffled = sorted(rows, key=lambda x: x[1] + dt.timedelta(minutes=r.uniform(-4, 4)))
    assert shuffled != sorted(rows, key=lambda x: x[1])
    end = (99, start + dt.timedelta(days=1), 0, "end", "end")
    chunks = [shuffled[i : i + 8] for i in range(0, len(shuffled), 8)] + [[end]]
    for k, chunk in enumerate(chunks):
        spark.createDataFrame(chunk, schema).coalesce(1).write.parquet(f"{url}/in/{k:03d}")
    old = spark.conf.get(streams.ROCKSDB[0])
    spark.conf.set(*streams.ROCKSDB)
    try:
        # Files by number: one micro-batch after the other.
        for k in range(len(chunks)):
            stream = spark.readStream.schema(schema).parquet(f"{url}/seen/*")
            spark.read.parquet(f"{url}/in/{k:03d}").coalesce(1).write.parquet(f"{url}/seen/{k:03d}")
            out = streams.ordered_history(stream).writeStream.format("parquet").option("path", f"{url}/out").option("checkpointLocation", f"{url}/check").outputMode("append")
            out.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(streams.ROCKSDB[0], old)
    told = spark.read.parquet(f"{url}/out")
    last = told.groupBy("conv_id").agg(F.max_by(F.struct("n_turns", "history"), "n_turns").alias("b")).select("conv_id", "b.*")
    got = {x["conv_id"]: (x["n_turns"], x["history"]) for x in last.collect()}
    want = {x["conv_id"]: (x["n_turns"], x["history"]) for x in folds.chat_history(spark.createDataFrame(rows, schema)).collect()}
    assert got == want and told.count() > 6


# --- selection (AGG19) -------------------------------------------------------------------------


@pytest.mark.parametrize("few, accuracy", [(10**6, 10_000), (300, 100), (40, 1000)])
def test_percentiles(spark, few, accuracy):
    """Exact on values that are all different, on ties, by group, with nulls, whatever the number of rounds."""
    df = spark.range(6000).select(F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"), F.when(F.col("id") % 7 == 0, 1.5).when(F.col("id") % 11 == 0, None).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(1000003)) / 50000)).alias("v"))
    df = df.union(spark.createDataFrame([(9, None), (8, 2.0)], "g long, v double"))
    points = [0, 0.1, 0.5, 0.9, 0.999, 1]
    got = {(x["g"], x["point"]): x["value"] for x in selection.percentiles(df, "v", points, ["g"], accuracy, few).collect()}
    values = {}
    for g, v in df.where("v is not null").collect():
        values.setdefault(g, []).append(v)
    want = {(g, float(p)): float(np.quantile(x, p)) for g, x in values.items() for p in points}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1e-9 * abs(want[k]) for k in want)
    both = spark.range(2000).select(F.when(F.col("id") < 1000, 1.0).otherwise(2.0).alias("v"))
    assert [x["value"] for x in selection.percentiles(both, "v", [0.5], few=100).collect()] == [1.5]
    assert selection.percentiles(df.limit(0), "v", [0.5]).count() == 0


# --- searches and records ----------------------------------------------------------------------


def test_terms_within(spark):
    """As ``in`` has it: in any case, at any place, letters of several bytes, line ends, blanks and nulls."""
    from paperloom.operators import agents

    r = random.Random(3)
    terms = ["ab", "Abc", "é\nb", "بيت", "aa", "", None, "zzz", "ab"]
    queries = [(i, "".join(r.choices("abcABé\nبيتz", k=r.randint(0, 12)))) for i in range(200)] + [(900, None), (901, "x" * 5000 + "AB")]
    got = agents.terms_within(spark.createDataFrame(queries, "query_id long, query string"), spark.createDataFrame([(t,) for t in terms], "term string"))
    rows = [tuple(x) for x in got.collect()]
    want = {(i, t) for i, q in queries for t in terms if t and q and t.lower() in q.lower()}
    assert len(rows) == len(want) and set(rows) == want and len(want) > 50
    assert agents.terms_within(spark.createDataFrame(queries, "query_id long, query string"), spark.createDataFrame([("",)], "term string")).count() == 0


def test_completed_records(spark):
    """What is missing, empty or nought is filled in; all else stays for the schema to judge."""
    def done(payload):
        rows = spark.createDataFrame([(payload,)], "p string").select(jsonx.completed(F.col("p"), F.lit("d"), F.array(F.lit("a"))).alias("r"))
        text = rows.first()["r"]
        return None if text is None else json.loads(text)

    empty = done("{}")
    assert empty == {"document_id": "d", "source_files": ["a"], "page_count": 1, "review_required": False, **{k: [] for k in K.LIST_FIELDS}}
    given = {"document_id": 5, "page_count": "two", "source_files": None, "assets": {}, "family_members": [{"age": 1}], "review_required": "no", "more": [None, {"é": 1.5}]}
    assert done(json.dumps(given)) == {**empty, **given, "source_files": ["a"], "assets": [], "review_required": True}
    assert done("[1]") is None and done("{") is None and done(None) is None


# --- components --------------------------------------------------------------------------------


def roots_of(edges):
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if None not in (a, b) and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("hub", [3, components.HUB])
def test_components(spark, hub):
    r = random.Random(hub)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i + 1, i) for i in range(400, 460)] + [(500, 500 + i) for i in range(1, 80)] + [(7, None), (None, None), (5, 5), (900, 900)]
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(edges, "a long, b long"), hub=hub).collect()}
    assert got == roots_of(edges)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_stays_in_many_tasks(spark):
    """A star's edges aren't brought together by their hub."""
    star = spark.range(0, 40_000, 1, 8).select((F.col("id") + 1).alias("u"), F.lit(0).cast("long").alias("v"))
    both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = {hub: components._star(both, hub).where("u = 0").select(F.spark_partition_id().alias("task")).groupBy("task").count().collect() for hub in (1000, None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sum(x["count"] for x in rows[1000]) == 40_000 and max(x["count"] for x in rows[1000]) <= 5_000 and len(rows[None]) == 1


def test_providers_get_bounded_slices(spark):
    """However many rows an Arrow batch has, a provider gets at most ``ROWS`` of them, and every row has its answer."""
    @providers.register("sizes_of_slices", "long")
    def sizes():
        return lambda b: b.iloc[:, 0] * 10_000 + len(b)

    got = providers.call(spark.range(0, 2500, 1, 1), "sizes_of_slices", ["id"], "size").collect()
    assert [r["size"] // 10_000 for r in got] == list(range(2500))
    assert max(r["size"] % 10_000 for r in got) <= providers.ROWS
