import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators import chunking, extraction, fusion, graph, layout, metrics, retrieval, stores, tables, validation
from quire.schema import ExtractionSchema, adapt_chunks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# Layout


def test_two_columns_read_left_first():
    boxes = [(0, 0, 100, 100), (200, 10, 300, 90), (0, 105, 100, 200), (200, 95, 300, 200)]
    assert layout.reading_order(boxes) == [0, 2, 1, 3]


def test_gap_under_the_least_is_no_cut():
    assert layout.widest_gap([(0, 10), (29, 40)]) is None and layout.widest_gap([(0, 10), (30, 40)]) == 20
    boxes = [(119, 5, 200, 10), (0, 5, 100, 10), (0, 0, 100, 4)]
    assert layout.reading_order(boxes) == [2, 1, 0]


def test_first_of_equal_gaps():
    assert layout.widest_gap([(0, 10), (40, 50), (80, 90)]) == 25


def test_gap_before_the_first_span_doesnt_count():
    assert layout.widest_gap([(100, 110), (0, 0)]) is None


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 400)] * 4), max_size=25))
def test_order_is_a_permutation(corners):
    boxes = [(min(a, c), min(b, d), max(a, c), max(b, d)) for a, b, c, d in corners]
    assert sorted(layout.reading_order(boxes)) == list(range(len(boxes)))


def test_xy_cut_over_pages(spark):
    rng = random.Random(1)
    rows = []
    for doc in range(20):
        for page in (1, 2):
            for i in range(rng.randint(1, 12)):
                x, y = rng.randrange(0, 2000, 50), rng.randrange(0, 3000, 50)
                rows.append((f"d{doc}", page, i, (float(x), float(y), x + 200.0, y + 30.0, 2480.0, 3508.0), f"{i}"))
    frame = spark.createDataFrame(rows, f"document_id string, page_number int, region_index int, bbox {layout.BBOX}, text string").repartition(3)
    got = {(r.document_id, r.page_number, r.text): r.region_index for r in layout.xy_cut_order(frame).collect()}
    for key in {(r[0], r[1]) for r in rows}:
        own = [r for r in rows if (r[0], r[1]) == key]
        for place, i in enumerate(layout.reading_order([r[3][:4] for r in own])):
            assert got[(*key, own[i][4])] == place
    assert layout.xy_cut_order(frame.limit(0)).count() == 0


def test_crops(spark):
    box = layout.bbox(F.lit(2), F.lit(2), F.lit(98), F.lit(98), F.lit(100), F.lit(100))
    assert tuple(one(spark, layout.crop_box(box))) == (0, 0, 100, 100)
    assert one(spark, layout.crop_path(F.lit("s"), F.lit("d"), F.lit(7), F.lit(3), F.lit("table"))) == "s/d/page_007_region_03_table.png"
    assert [one(spark, layout.upscale_factor(F.lit(h))) for h in (1753, 1754)] == [2, 1]


# Chunks

REGIONS = "document_id string, page_number int, region_index int, region_type string, text string, cropped_image_path string"


def chunked(spark, rows):
    return chunking.chunk_regions(spark.createDataFrame([("d", *r, f"p{r[0]}-{r[1]}") for r in rows], REGIONS)).orderBy("chunk_index").collect()


def test_greedy_merge(spark):
    got = chunked(spark, [(1, i, "text", "x" * n) for i, n in enumerate([900, 500, 200, 1600, 10])])
    assert [r.region_indexes for r in got] == [[0, 1], [2], [3], [4]] and [r.chunk_index for r in got] == [0, 1, 2, 3]
    assert got[0].raw_text == "x" * 900 + " " + "x" * 500 and got[0].cropped_image_path == "p1-0"


def plain_chunks(regions):
    """An independent fold."""
    out, held = [], None
    for i, (kind, text) in enumerate(regions):
        if kind == "text":
            if held is not None and sum(len(regions[j][1]) for j in held) + len(text) <= 1500:
                held.append(i)
            else:
                held = [i]
                out.append(held)
        else:
            held = None
            if kind != "caption":
                out.append([i])
    return out


def test_merge_against_a_plain_fold(spark):
    rng = random.Random(6)
    kinds = ["text"] * 6 + ["table", "figure", "header", "caption", "other"]
    pages = {p: [(rng.choice(kinds), "y" * rng.choice([0, 10, 400, 700, 1501])) for _ in range(rng.randint(1, 20))] for p in range(1, 25)}
    got = chunked(spark, [(p, i, k, t) for p, rs in pages.items() for i, (k, t) in enumerate(rs)])
    assert [r.region_indexes for r in got] == [g for p in sorted(pages) for g in plain_chunks(pages[p])]
    assert all(len(r.raw_text.replace(" ", "")) <= 1500 or len(r.region_indexes) == 1 for r in got)


def test_captions(spark):
    got = chunked(spark, [(1, 0, "caption", "orphan"), (1, 1, "figure", ""), (1, 2, "caption", " a"), (1, 3, "text", "t"), (1, 4, "caption", "b "), (1, 5, "caption", " "), (2, 0, "caption", "c"), (2, 1, "header", "h")])
    assert [(r.content_type, r.caption, r.metadata_only) for r in got] == [("figure", "a b", False), ("text", None, False), ("header", None, True)]


def bridged(spark, pages):
    rows = [(f"c{p}-{i}", "d", p, 10 * p + i, t, "text", False) for p, texts in pages.items() for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "chunk_id string, document_id string, page_number int, reading_order_index int, raw_text string, content_type string, metadata_only boolean")
    return {r.chunk_id: r.page_break_context for r in chunking.page_break_context(frame).collect()}


def test_page_breaks(spark):
    assert bridged(spark, {1: ["x.", "all par"], 2: ["ties on", "z"]}) == {"c1-1": "[...continues on page 2: ties on]", "c2-0": "[...continued from page 1: all par]"}
    assert bridged(spark, {1: ["a"], 2: ["b"], 3: ["c"]}) == {"c1-0": "[...continues on page 2: b]", "c2-0": "[...continues on page 3: c]", "c3-0": "[...continued from page 2: b]"}
    assert bridged(spark, {1: ["days. "], 2: ["b "], 4: ["c"]}) == {}
    assert bridged(spark, {1: ["w" * 60 + " \n"], 2: [" " + "v" * 60]}) == {"c1-0": f"[...continues on page 2:  {'v' * 49}]", "c2-0": f"[...continued from page 1: {'w' * 50}]"}


# Tables


def parsed(spark, text):
    row = one(spark, tables.parse_markdown(F.lit(text)))
    return row.headers, row.rows


def test_markdown(spark):
    assert parsed(spark, "|Col1|Col2|\n|---|---|\n|A|B|") == (["Col1", "Col2"], [["A", "B"]])
    assert parsed(spark, "a|b\n1|2\n-|-\n:-|-:\n\n| x ||y |") == (["a", "b"], [["1", "2"], [":-", "-:"], ["x", "", "y"]])
    assert parsed(spark, "no pipes") == ([], []) and parsed(spark, "|||") == ([""], [])
    cells = one(spark, tables.build_cells(F.array(F.lit("h")), F.array(F.array(F.lit("v")))))
    assert [tuple(c) for c in cells] == [(0, 0, 1, 1, "h", True), (1, 0, 1, 1, "v", False)]


def test_responses(spark):
    none_s, none_a, none_aa, none_c = (F.lit(None).cast(t) for t in ("string", "array<string>", "array<array<string>>", f"array<{tables.CELL}>"))
    row = one(spark, tables.table_from_response(none_a, none_aa, none_c, none_s, F.lit("no pipes")))
    assert (row.headers, row.rows, row.markdown) == ([], [], "no pipes")
    row = one(spark, tables.table_from_response(F.array(F.lit("a")), F.array(F.array(F.lit("1"))), none_c, none_s, none_s))
    assert row.markdown == "| a |\n| --- |\n| 1 |" and len(row.cells) == 2
    row = one(spark, tables.table_from_response(none_a, none_aa, none_c, F.lit("|a|\n|1|"), none_s))
    assert (row.headers, row.rows) == (["a"], [["1"]])


@pytest.mark.parametrize("ending,goes_on", [("Grand Total", False), ("x", True), ("the sum is", False), ("summary", True), ("", True)])
def test_continuation(spark, ending, goes_on):
    rows = [("d", 1, 0, "table", ending), ("d", 2, 1, "table", "z"), ("d", 2, 2, "text", ""), ("d", 3, 3, "table", "q")]
    got = tables.continuations(spark.createDataFrame(rows, "document_id string, page_number int, reading_order_index int, content_type string, ending string")).orderBy("page_number", "reading_order_index").collect()
    assert [(r.is_continuation, r.continuation_confidence) for r in got] == [(False, 0.0), (goes_on, 0.9 if goes_on else 0.0), (False, 0.0), (False, 0.0)]


def test_figures_that_are_tables(spark):
    assert not one(spark, tables.looks_like_table(F.lit("a|\nb|\nc"))) and one(spark, tables.looks_like_table(F.lit("a|\nb|\n|c")))
    assert one(spark, tables.looks_like_table(F.lit(None).cast("string"))) is False


# Extraction and validation


@pytest.mark.parametrize("text,raw", [('```json\n{"raw_text": "a"}\n```', "a"), ('{"raw_text": "a"}', "a"), ("[1]", ""), ("oops", ""), (None, ""), ('```\n{"raw_text": "a"}', "a")])
def test_answers(spark, text, raw):
    assert one(spark, extraction.parse_answer(F.lit(text).cast("string"))).raw_text == raw


def test_structured_data(spark):
    assert one(spark, extraction.structured_data(F.lit('{"text": "t", "language": "en", "fields": {"a": 1}}'))) == '{"a":1}'
    assert one(spark, extraction.structured_data(F.lit('{"text": "t", "language": "en"}'))) == '{"language":"en"}'


def test_prompt(spark):
    got = one(spark, extraction.prompt(F.lit("text"), {"text": ("sys ", " over")}, " suf", ExtractionSchema(fields={"k": "v"}, entity_types=("ORG",))))
    assert got == "sys\n\nover\n\nsuf\n\nAlso extract the following schema fields as JSON keys:\n  \"k\": \"v\"\n\nRestrict entity types to: ORG. Return them in the 'entities' key as described above."


def test_populate(spark):
    rows = [("figure", '{"raw_text": "|a|\\n|b|\\n|c|", "markdown": "|a|\\n|b|"}', False), ("figure", '{"description": "cat"}', False), ("formula", '{"latex": "x"}', False), ("header", '{"text": "no"}', True)]
    chunks = spark.createDataFrame(rows, "content_type string, answer string, metadata_only boolean").withColumn("raw_text", F.lit("own"))
    got = extraction.populate(chunks).collect()
    assert [r.content_type for r in got] == ["table", "figure", "formula", "header"] and got[0].table_data.headers == ["a"]
    assert (got[1].image_description, got[2].formula_latex, got[3].raw_text, got[3].overview) == ("cat", "x", "own", None)


def test_retries():
    waits, answers = [], iter([(503, ""), (429, ""), (200, "ok")])
    assert extraction.with_retry(lambda: next(answers), waits.append) == "ok" and waits == [1.0, 2.0]
    assert extraction.with_retry(lambda: (500, ""), waits.append) == "{}" and waits == [1.0, 2.0, 1.0, 2.0, 4.0]
    with pytest.raises(RuntimeError):
        extraction.with_retry(lambda: (400, ""), waits.append)


class Improving:
    """Gives no overview until it is asked to correct."""

    def answer(self, prompt, text):
        good = "CORRECTION REQUIRED (overview_present)" in prompt and text != "never"
        return '{"overview": "o"}' if good else "{}"


def test_correction_loop(spark):
    rows = spark.createDataFrame([("a", "text", "p", "sometimes"), ("b", "text", "p", "never")], "chunk_id string, content_type string, prompt string, raw_text string")
    call = lambda df: extraction.call_model(df, Improving())
    got = {r.chunk_id: r for r in validation.validate_and_correct(call(rows), call).collect()}
    assert [(got[k].passes, got[k].correction_applied, got[k].confidence_score, got[k].prompt) for k in "ab"] == [(1, True, 1.0, "p"), (2, True, 0.0, "p")]
    counts = validation.corrections(spark.createDataFrame(list(got.values()))).collect()
    assert {(r.region_type, r.pass_number): r.n for r in counts} == {("text", 1): 2, ("text", 2): 1}


def test_rules(spark):
    rows = [("table", ["a", "b"], [["1"], ["2", "3"]], "", "x"), ("table", ["a"], [], "", " "), ("formula", None, None, " ", "x"), ("text", None, None, None, "x")]
    frame = spark.createDataFrame(rows, "kind string, headers array<string>, rows array<array<string>>, latex string, overview string")
    assert [r.f for r in frame.select(validation.failing(F.col("kind"), F.col).alias("f")).collect()] == [["row_column_count"], ["overview_present"], ["latex_present"], []]


# Schema and stores


def test_adapting_is_idempotent(spark):
    old = spark.createDataFrame([("c", "p", 4)], "chunk_id string, image_path string, chunk_index int")
    new = adapt_chunks(old)
    row = new.first()
    assert (row.cropped_image_path, row.reading_order_index, row.entities, row.correction_applied, row.schema_version) == ("p", 4, [], False, 2)
    assert adapt_chunks(new).collect() == new.collect()
    with pytest.raises(Exception, match="unsupported"):
        adapt_chunks(old.withColumn("schema_version", F.lit(3))).collect()


def test_upserts(spark, tmp_path):
    store = stores.TableStore(spark, f"file://{tmp_path}/t", ["k"], ["v"])
    assert store.read() is None
    store.upsert(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string"))
    store.upsert(spark.createDataFrame([(2, "B", "Y"), (3, "c", "z"), (3, "c2", "z2")], "k int, v string, w string"), order="v")
    assert sorted(tuple(r) for r in store.read().collect()) == [(1, "a", "x"), (2, "B", "y"), (3, "c2", "z2")]

    def broken(_):
        raise OSError("disk is full")

    before = store.version()
    with pytest.raises(Exception):
        store.upsert(store.read().withColumn("v", F.raise_error(F.lit("no")).cast("string")))
    assert store.version() == before and store.read().count() == 3 and broken


def test_manifest_and_retry(spark):
    wrote = {"postgres": [], "mongo": []}
    fail = {"postgres"}

    def sink(name):
        def write(rows):
            if name in fail:
                raise OSError("down")
            wrote[name] += [r.document_id for r in rows.collect()]

        return write

    docs = spark.createDataFrame([("d1",), ("d2",)], "document_id string")
    sinks = {n: sink(n) for n in wrote}
    first = stores.write_to_sinks(docs, sinks, ["mongodb", "postgres"])
    assert {tuple(r) for r in first.collect()} == {(d, "mongo", "ok", None) for d in ("d1", "d2")} | {(d, "postgres", "error", "OSError: down") for d in ("d1", "d2")}
    fail.clear()
    stores.write_to_sinks(docs, sinks, None, only_failed=first)
    assert {k: sorted(v) for k, v in wrote.items()} == {"mongo": ["d1", "d2"], "postgres": ["d1", "d2"]}
    assert stores.select_sinks(stores.SINKS, ["mongodb", "VECTOR"]) == ["mongo", "vector"]


def test_point_id(spark):
    assert int(one(spark, stores.point_id(F.lit("ffffffff-0000-4000-8000-000000000001")))) == 18446744069414600704


# Retrieval, graph, fusion


def test_cursor_walk(spark):
    rows = spark.range(101).select(F.format_string("%04d", "id").alias("chunk_id"))
    seen, cursor, sizes = [], None, []
    while True:
        page = retrieval.keyset_page(rows, "chunk_id", 50, cursor, count=True)
        seen += [r.chunk_id for r in page.rows]
        sizes.append(len(page.rows))
        assert page.total == 101
        cursor = page.next_cursor
        if cursor is None:
            break
    assert sizes == [50, 50, 1] and len(set(seen)) == 101
    with pytest.raises(ValueError):
        retrieval.keyset_page(rows, "chunk_id", 50, "%%%")


def test_full_offset_page_has_a_cursor(spark):
    page = retrieval.offset_page(spark.range(10), ["id"], 10)
    assert page.next_cursor is not None and retrieval.offset_page(spark.range(10), ["id"], 10, page.next_cursor).rows == []


@pytest.mark.parametrize(
    "spec,ids",
    [
        ({"a": 1}, [1]), ({"a": {"$gt": 1, "$lte": 3}}, [2, 3]), ({"a": None}, [4]), ({"a": {"$ne": 1}}, [2, 3, 4]), ({"a": {"$in": [1, None]}}, [1, 4]), ({"a": {"$nin": [1, 2]}}, [3, 4]),
        ({"a": {"$exists": False}}, [4]), ({"$or": [{"a": 1}, {"b": "z"}]}, [1, 3]), ({"$nor": [{"a": 1}]}, [2, 3, 4]), ({"c": {"$elemMatch": {"x": {"$gte": 5}, "y": "q"}}}, [2]), ({}, [1, 2, 3, 4]),
    ],
)
def test_filters(spark, spec, ids):
    rows = [(1, 1, "x", []), (2, 2, "y", [(5, "q"), (1, "r")]), (3, 3, "z", [(5, "r"), (1, "q")]), (4, None, None, None)]
    frame = spark.createDataFrame(rows, "id int, a int, b string, c array<struct<x:int,y:string>>")
    assert sorted(r.id for r in frame.where(retrieval.compile_filter(spec)).collect()) == ids


def test_built_in_filters_win(spark):
    frame = spark.createDataFrame([("a", "text", 0.9, "one two"), ("b", "table", 0.1, "two")], "document_id string, content_type string, confidence_score double, overview string")
    got = retrieval.documents_query(frame, {"content_type": "text"}, "TWO three", ["table"])
    assert [r.document_id for r in got.collect()] == ["b"]
    with pytest.raises(ValueError):
        retrieval.compile_filter({"a": {"$foo": 1}})


def test_vectors(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "id int, vector array<float>")
    got = retrieval.vector_search(frame, [2.0, 0.0], "id", 10).collect()
    assert [(r.id, round(r.similarity_score, 6)) for r in got] == [(1, 1.0), (3, 0.707107), (2, 0.0)]
    assert [r.id for r in retrieval.vector_scores(frame, [1.0, 0.0], min_score=0.5).collect()] == [1, 3]


def test_traversal_depths(spark):
    m = spark.createDataFrame([("c1", "e1", "T"), ("c1", "e2", "T"), ("c2", "e2", "T"), ("c2", "e3", "T"), ("c3", "e3", "T")], "chunk_id string, text string, type string")
    reach = lambda depth, kind=None: sorted(r.chunk_id for r in graph.entity_chunks(m, "e1", kind, depth).collect())
    assert reach(1) == reach(2) == ["c1"] and reach(3) == reach(4) == ["c1", "c2"] and reach(5) == ["c1", "c2", "c3"] and reach(3, "U") == []
    chunks = spark.createDataFrame([(f"c{i}", "d", i) for i in (1, 2, 3)], "chunk_id string, document_id string, reading_order_index int")
    page = retrieval.traverse_page(retrieval.traverse(chunks, m, "e1", depth=5), 2)
    assert [r.chunk_id for r in page.rows] == ["c1", "c2"] and page.total == 3
    assert retrieval.traverse_page(retrieval.traverse(chunks, m, "e1", depth=5), 2, page.next_cursor).next_cursor is None
    assert retrieval.traverse(chunks, m, sql="select c.* from chunks c join mentions using (chunk_id) where text = 'e3'").count() == 2


def ranks(spark, name, order, keys):
    return fusion.ranked(spark.createDataFrame([(k, i + 1) for i, k in enumerate(keys)], "chunk_id string, rank int"), "chunk_id", name, order)


def test_fusion(spark):
    got = fusion.fuse([ranks(spark, "mongo", 0, "ABC"), ranks(spark, "vector", 1, "ADXYB")]).collect()
    assert [r.chunk_id for r in got] == list("ABDCXY") and got[0].rrf_score == 1 / 61 + 1 / 61 and got[1].rrf_score == 1 / 62 + 1 / 65
    assert got[0].sources == ["mongo", "vector"] and got[-1].rrf_score == 0.015625
    tie = fusion.fuse([ranks(spark, "a", 0, "P"), ranks(spark, "b", 1, "Q")]).collect()
    assert [r.chunk_id for r in tie] == ["P", "Q"]
    repeat = fusion.fuse([ranks(spark, "a", 0, "XX")]).first()
    assert repeat.rrf_score == 1 / 61 + 1 / 62 and repeat.sources == ["a", "a"]


def test_failing_adapter_is_left_out(spark):
    good = lambda: spark.createDataFrame([("A", 1)], "chunk_id string, rank int")
    bad = lambda: good().withColumn("rank", F.raise_error(F.lit("down")).cast("int"))
    assert fusion.search({"bad": bad, "good": good}, []).first().sources == ["good"]
    assert fusion.search({"bad": bad, "good": good}, ["bad"]) is None


def test_graph_tables(spark):
    entities = [[("x", None, "x"), ("x", None, "x"), ("", "T", ""), (None, "T", "")], [("x", "T", "x")]]
    chunks = spark.createDataFrame([("c1", entities[0]), ("c2", entities[1])], f"chunk_id string, entities array<{graph.__name__ and 'struct<text:string,type:string,value:string>'}>")
    assert sorted(tuple(r) for r in graph.mentions(chunks).collect()) == [("c1", "x", "UNKNOWN"), ("c2", "x", "T")]


def test_histogram(spark):
    frame = spark.createDataFrame([(0.0,), (0.05,), (0.5,), (None,), (2.0,)], "v double")
    assert {r.le: r.n for r in metrics.histogram(frame, "v", (0.0, 0.5, 1.0)).collect()} == {0.0: 1, 0.5: 3, 1.0: 3, None: 4}
