import hashlib
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.operators import extraction, graph, layout, metrics, stores, tables, validation
from quire.plans import engine
from quire.providers import HashEmbedder, Retrying
from quire.sources.text import paginate
from quire.streaming import ingest


def test_ingest_of_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("First line here.\n| h | i |\n| --- | --- |\n| 1 | 2 |\nLast line goes on")
    (folder / "copy.txt").write_text("First line here.\n| h | i |\n| --- | --- |\n| 1 | 2 |\nLast line goes on")
    (folder / "b.html").write_text("<p>Hello <b>World</b></p>")
    (folder / "m.eml").write_bytes(b"Subject: s\n\nMail body text.")
    (folder / "x.pdf").write_bytes(b"%PDF")
    files = stores.first_of_content(engine.routing.read_files(spark, str(folder)))
    result = engine.Pipeline().run(engine.file_pages(files))
    docs = result.documents.collect()
    assert len(docs) == 4 and {(d.format, d.processing_status) for d in docs} == {("text", "complete"), ("email", "complete"), ("pdf", "review_required")}
    assert next(d.error for d in docs if d.format == "pdf") == "no pages from a file of format pdf"
    chunks = {(r.content_type, r.raw_text): r for r in result.chunks.collect()}
    table = next(r for (kind, _), r in chunks.items() if kind == "table")
    assert table.table_data.headers == ["h", "i"] and table.table_data.rows == [["1", "2"]] and all(r.confidence_score == 1.0 for r in chunks.values())
    again = engine.Pipeline().run(engine.file_pages(files), stored=result.documents)
    assert again.chunks.count() == 0
    wrote = []
    outcome = engine.ingest(spark, [str(folder)], targets=["mongodb"], pipeline=engine.Pipeline(sinks={"mongo": lambda rows: wrote.append(rows.count())}))
    assert outcome.count() == 4 and wrote == [4]


def test_stream_replay(spark, tmp_path):
    rows = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h1")], "source_path string, content_hash string")
    store = stores.TableStore(spark, f"file://{tmp_path}/documents", ["content_hash"])
    for n in range(3):
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        ingest.start(ingest.source(spark, str(tmp_path / "in"), rows.schema, 10), store, str(tmp_path / "checkpoint")).awaitTermination()
        assert sorted((r.content_hash, r.source_path, r.processing_status) for r in store.read().collect()) == [("h1", "a", "complete"), ("h2", "b", "complete")]
    assert store.version() == 1  # the later replays found nothing new


class PdfReader:
    def pages(self, content, path):
        if b"bad" in content:
            raise ValueError("broken file")
        return [("", {"page_label": "1"}, content)]


class Detector:
    def size(self, image):
        return 1000, 1000

    def detect(self, image):
        # Two columns, a weaker double of the first box, and one that is too weak.
        return [(3, 500, 100, 900, 300, 0.9), (0, 100, 100, 400, 300, 0.8), (0, 105, 100, 400, 300, 0.7), (0, 0, 0, 9, 9, 0.1)]


class Cropper:
    def crop(self, image, x0, y0, x1, y1):
        return f"{x0:.0f}-{y0:.0f}-{x1:.0f}-{y1:.0f}".encode()


class Model:
    def answer(self, prompt, text):
        return json.dumps({"text": text or "seen", "overview": "An overview.", "markdown": "| a |\n| --- |\n| 1 |", "entities": [{"text": "Acme", "type": "ORG", "value": "Acme"}]})


def test_everything_is_written(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("One line here\nAnother line.")
    (folder / "scan.pdf").write_bytes(b"image")
    (folder / "bad.pdf").write_bytes(b"bad")
    (folder / "old.doc").write_bytes(b"old")
    sinks = stores.default_stores(spark, f"file://{tmp_path}/out", HashEmbedder())
    manifest = stores.TableStore(spark, f"file://{tmp_path}/manifest", ["document_id", "sink"])
    pipeline = engine.Pipeline(extractor=Model(), sinks=sinks, readers={"pdf": PdfReader()}, detector=Detector(), cropper=Cropper(), manifest=manifest)
    outcome = {r.document_id: r.processing_status for r in engine.ingest(spark, [str(folder)], pipeline=pipeline).collect()}
    mongo, graph, vectors = sinks["mongo"], sinks["neo4j"], sinks["vector"].table.read().collect()
    docs = {r.source_path.rsplit("/")[-1]: r for r in mongo.documents.read().collect()}
    assert set(docs) == {"a.txt", "scan.pdf", "bad.pdf", "old.doc"} and len(outcome) == 4
    assert docs["bad.pdf"].error == "ValueError: broken file" and docs["old.doc"].error.startswith("ValueError: not a .docx")
    assert {n: outcome[d.document_id] for n, d in docs.items()} == {"a.txt": "complete", "scan.pdf": "complete", "bad.pdf": "review_required", "old.doc": "review_required"}
    scan = docs["scan.pdf"].document_id
    regions = mongo.regions_of(scan).collect()
    assert [(r.region_index, r.region_type, r.detector_confidence) for r in regions] == [(0, "text", 0.8), (1, "table", 0.9)]
    assert regions[0].content_hash == hashlib.sha256(b"92-92-408-308").hexdigest()
    chunks = mongo.chunks_of(scan).collect()
    assert [(c.content_type, c.raw_text) for c in chunks] == [("text", "seen"), ("table", "seen")]
    assert mongo.get_chunk(chunks[1].chunk_id).first().table_data.rows == [["1"]] and mongo.get_chunk("none").count() == 0
    assert mongo.find_by_hash(docs["a.txt"].content_hash).first().document_id == docs["a.txt"].document_id
    assert [r.chunk_id for r in graph.children(docs["scan.pdf"].content_hash).collect()] == [c.chunk_id for c in chunks]
    assert [(r.text, r.type, r.n_chunks) for r in graph.entities().collect()] == [("Acme", "ORG", 3)]
    assert [(r.from_id, r.to_id) for r in graph.next_chunk.read().collect()] == [(chunks[0].chunk_id, chunks[1].chunk_id)]
    assert len(vectors) == 3 and {v.overview for v in vectors} == {"An overview."} and all(len(v.vector) == 64 for v in vectors)
    assert {(r.sink, r.status) for r in manifest.read().collect()} == {(s, "ok") for s in stores.SINKS} and manifest.read().count() == 16
    assert [step for step, _ in pipeline.timings.rows] == ["read", "extract", "write"]
    # A second run finds all of it stored, says so, and writes nothing.
    before = mongo.chunks.version()
    again = engine.ingest(spark, [str(folder)], pipeline=engine.Pipeline(extractor=Model(), readers={"pdf": PdfReader()}), stored=mongo.documents.read())
    assert {r.document_id: r.processing_status for r in again.collect()} == outcome and mongo.chunks.version() == before


def test_word_and_image_files(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = f'<w:document {w}><w:body><w:p><w:r><w:t>Hello </w:t><w:t>there</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr><w:tr><w:tc><w:p/></w:tc><w:tc><w:p><w:r><w:t>2</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>end</w:t><w:br w:type="page"/><w:t>Page two</w:t></w:r></w:p></w:body></w:document>'
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as book:
        book.writestr("word/document.xml", body)
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBBBBBI", 13, b"IHDR", 640, 480, 8, 2, 0, 0, 0, 0) + struct.pack(">I4sIIBI", 9, b"pHYs", 11811, 11811, 1, 0) + struct.pack(">I4sI", 0, b"IEND", 0)
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H5sHBHHBB", 16, b"JFIF\0", 257, 1, 72, 72, 0, 0) + b"\xff\xc0" + struct.pack(">HBHHB", 8, 8, 30, 40, 0)
    (tmp_path / "i.png").write_bytes(png)
    (tmp_path / "j.jpg").write_bytes(jpeg)
    (tmp_path / "k.webp").write_bytes(b"RIFF")
    rows = {(r.source_path.rsplit("/")[-1], r.page_number): r for r in engine.file_pages(engine.routing.read_files(spark, str(tmp_path))).collect()}
    assert rows["d.docx", 1].native_text == "Hello there\n| a | b |\n| --- | --- |\n|  | 2 |\nend" and rows["d.docx", 2].native_text == "Page two"
    assert rows["i.png", 1].metadata == {"dpi": "300.0", "width": "640", "height": "480"} and rows["i.png", 1].image == png
    assert rows["j.jpg", 1].metadata == {"dpi": "72.0", "width": "40", "height": "30"} and rows["k.webp", 1].metadata == {"dpi": "150.0"}


class Steps:
    deskew = staticmethod(lambda image: image + b"1")
    denoise = staticmethod(lambda image: image + b"2")
    contrast = staticmethod(lambda image: image + b"3")
    enlarge = staticmethod(lambda image, factor: image * factor)


def test_image_steps(spark):
    pages = spark.createDataFrame([(1, bytearray(b"a"), {"height": "1000"}), (2, bytearray(b"b"), {"height": "3508"}), (3, None, None)], "page_number int, image binary, metadata map<string,string>")
    got = {r.page_number: r.image and bytes(r.image) for r in layout.preprocess(pages, Steps()).collect()}
    assert got == {1: b"a123a123", 2: b"b123", 3: None}


def test_store_log(spark, tmp_path):
    """Bytes written a batch don't grow with the table; writers that meet both count; null keys match."""
    store = stores.TableStore(spark, f"file://{tmp_path}/t", ["k"], ["v"], compact_after=6)
    batch = lambda n: spark.createDataFrame([(i, f"{n}", f"w{n}") for i in range(n * 10, n * 10 + 20)], "k long, v string, w string")
    for n in range(4):
        store.upsert(batch(n))
    sizes = [e["bytes"] for e in store._entries()]
    assert len(sizes) == 4 and max(sizes) < 1.2 * min(sizes)
    got = {r.k: (r.v, r.w) for r in store.read().collect()}
    assert got == {i: (str(min(i // 10, 3)), f"w{max(i // 10 - 1, 0)}") for i in range(50)}
    other = stores.TableStore(spark, f"file://{tmp_path}/t", ["k"], ["v"])
    mine, theirs = store._write(batch(7)), other._write(batch(9))
    taken = store._commit(mine)
    other._numbers = lambda: list(range(taken))  # it listed the log before the other committed
    assert other._commit(theirs) == taken + 1 and store.read().count() == 90
    nothing = spark.createDataFrame([(None, "x", "y")], "k long, v string, w string")
    store.upsert(nothing)
    assert store.read().where("k is null").count() == 1 and len(store._entries()) == 7 or "covers" in store._entries()[0]
    store.upsert(nothing)
    assert store.read().where("k is null").count() == 1 and store.read().count() == 91
    assert {r.k for r in store.matching(batch(9)).collect()} == set(range(90, 110))
    store.compact()
    store.vacuum()
    assert len(store._entries()) == 1 and store.read().count() == 91 and len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_codecs(spark):
    rows = spark.createDataFrame([(1, ["a"], {"k": "v"}), (2, None, None)], "id int, list array<string>, told map<string,string>")
    text = stores.encode_rows(rows)
    assert [tuple(r) for r in text.orderBy("id").collect()] == [(1, '["a"]', '{"k":"v"}'), (2, "[]", "{}")]
    assert [tuple(r) for r in stores.decode_rows(text, rows.schema).orderBy("id").collect()] == [(1, ["a"], {"k": "v"}), (2, [], {})]


def test_counters(spark):
    manifest = spark.createDataFrame([("a", "mongo", "ok"), ("a", "vector", "error"), ("b", "vector", "error")], "document_id string, sink string, status string")
    assert [tuple(r) for r in metrics.write_failures(manifest).collect()] == [("vector", 2)]
    files = spark.createDataFrame([("h1",), ("h1",), ("h2",), ("h3",)], "content_hash string")
    assert metrics.dedup_hits(files).first().n == 1 and metrics.dedup_hits(files, files.where("content_hash = 'h3'")).first().n == 2


def test_retrying_extractor():
    told, waits = iter([(503, ""), (200, "{}x")]), []
    assert Retrying(lambda prompt, text: next(told), waits.append).answer("p", "t") == "{}x" and waits == [1.0]


def test_windowed_counts(spark, tmp_path):
    spark.sql("select timestamp_ntz'2024-01-01 00:01:00' ts, 'a' event_type union all select timestamp_ntz'2024-01-01 01:00:00', 'b'").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp_ntz, event_type string").parquet(str(tmp_path / "in"))
    query = ingest.windowed_counts(stream).writeStream.format("memory").queryName("counts").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.event_type, r.n) for r in spark.table("counts").collect()} == {("a", 1)}  # the later window stays open until a watermark passes it


def exchanges(df):
    """How many shuffles the plan of a table has."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_texts_shuffle_once(spark):
    """Regions and the fold come from a page's row; only numbering and page breaks deal chunks out."""
    rows = [("d", "p", "d", "txt", n, f"{n} one\n| a |\n| b |\n| c |\nlast") for n in (1, 2)]
    pages = spark.createDataFrame(rows, "document_id string, source_path string, content_hash string, format string, page_number int, native_text string")
    result = engine.Pipeline().run(pages)
    assert exchanges(layout.virtual_regions(pages)) == 0 and exchanges(result.regions) == 0 and exchanges(result.chunks) == 1
    assert exchanges(stores.embed_chunks(result.chunks, HashEmbedder())) == 1
    assert exchanges(result.chunks.select("document_id", "overview", "chunk_id")) == 1
    got = [(r.page_number, r.chunk_index, r.content_type, r.raw_text, r.page_break_context) for r in result.chunks.orderBy("chunk_index").collect()]
    assert got == [
        (1, 0, "text", "1 one", None), (1, 1, "table", "| a |\n| b |\n| c |", None), (1, 2, "text", "last", "[...continues on page 2: 2 one]"),
        (2, 3, "text", "2 one", "[...continued from page 1: last]"), (2, 4, "table", "| a |\n| b |\n| c |", None), (2, 5, "text", "last", None),
    ]


def test_partitions_grow_with_pages(spark, monkeypatch):
    """A task sorts the chunks of so many bytes of pages, whatever the session's number of partitions."""
    rows = [(f"d{d}", f"p{d}", f"d{d}", "txt", n, f"{n} one of {d}\nlast") for d in range(40) for n in (1, 2)]
    pages = spark.createDataFrame(rows, "document_id string, source_path string, content_hash string, format string, page_number int, native_text string")
    told = lambda r: sorted((c.document_id, c.chunk_id, c.chunk_index, c.raw_text, c.page_break_context or "") for c in r.chunks.collect())
    few = engine.Pipeline().run(pages)
    monkeypatch.setattr(stores, "SORTED_BYTES", 200, raising=False)
    many = engine.Pipeline().run(pages)
    assert exchanges(few.chunks) == exchanges(many.chunks) == 1
    assert "REPARTITION_BY_NUM" in many.chunks._jdf.queryExecution().executedPlan().toString()
    assert told(few) == told(many) and len(told(few)) == 80


def test_tasks_read_so_many_pages(spark, monkeypatch):
    """What a task lays out, and sorts by bucket to store it, is bounded in bytes, whatever the session's splits."""
    word = lambda i: hashlib.sha256(str(i).encode()).hexdigest()
    rows = [(f"d{d}", f"p{d}", f"d{d}", "txt", 1, "\n".join(word(d * 50 + i) for i in range(45))) for d in range(1500)]
    pages = spark.createDataFrame(rows, "document_id string, source_path string, content_hash string, format string, page_number int, native_text string").coalesce(1)
    told = lambda r: r.regions.agg(F.count("*"), F.sum(F.xxhash64("region_id", "text", F.col("bbox.y0")).cast("decimal(38,0)"))).first()
    tasks = lambda r: r.regions.groupBy(F.spark_partition_id()).count().count()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = engine.Pipeline().run(pages)
    monkeypatch.setattr(stores, "SORTED_BYTES", 256 << 10, raising=False)
    cut = engine.Pipeline().run(pages)
    assert tasks(cut) >= 4 > tasks(whole) and told(cut) == told(whole) and told(cut)[0] == 1500 * 45
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_unique_pages_do_not_meet(spark):
    """Where there is one file a content, its pages aren't dealt out and sorted to find the first."""
    plans, write = [], stores.write_and_read
    rows = [("d", "p", "d", "txt", n, f"{n} one\nlast") for n in (1, 2)]
    pages = spark.createDataFrame(rows, "document_id string, source_path string, content_hash string, format string, page_number int, native_text string")

    def noted(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(stores, "write_and_read", noted)
        told = [sorted(map(str, engine.Pipeline().run(pages, unique=u).chunks.collect())) for u in (False, True)]
    assert told[0] == told[1] and len(told[0]) == 2
    windows = ["Window" in p for p in plans if "__first" in p or "native_text" in p and "answer" not in p]
    assert windows == [True, False]


def moved(spark) -> int:
    """Bytes that all stages so far shuffled, spilled to disk and wrote."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    gateway = spark.sparkContext._gateway
    told = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    stages = [told.apply(i) for i in range(told.size())]
    return sum(s.shuffleWriteBytes() + s.diskBytesSpilled() + s.outputBytes() for s in stages)


@pytest.mark.parametrize("sink", ["mongo", "neo4j"])
def test_bytes_moved(spark, tmp_path, sink):
    """What an ingest shuffles and writes, as a multiple of its texts."""
    word = lambda i: hashlib.md5(str(i).encode()).hexdigest()[: 3 + i % 9]
    texts = ["\n".join(" ".join(word(d * 9000 + k * 90 + i) for i in range(14)) for k in range(100)) for d in range(120)]
    rows = [(str(d), str(d), str(d), "txt", t) for d, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "document_id string, source_path string, content_hash string, format string, text string")
    pipeline = engine.Pipeline(sinks=stores.default_stores(spark, f"file://{tmp_path}/out", HashEmbedder()))
    before = moved(spark)
    told = pipeline.write(pipeline.run(paginate(docs)), [sink])
    assert [r.status for r in told.select("status").distinct().collect()] == ["ok"]
    ratio = (moved(spark) - before) / sum(map(len, texts))
    assert ratio < {"mongo": 8, "neo4j": 5}[sink]


def test_answers_are_parsed_once(spark):
    """Checks and fields of an answer come from one parse of it."""
    answer = json.dumps({"overview": "o", "markdown": "a|b\n--|--\n1|2"})
    rows = spark.createDataFrame([("table", "t", "p", False, answer)], "content_type string, raw_text string, prompt string, metadata_only boolean, answer string")
    plans = []

    def write(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stores.write_and_read(df)

    done = validation.validate_and_correct(rows, None, write=write, max_passes=0, fill=extraction.populate)
    assert plans[0].count("from_json(StructField(text,") == 1
    assert done.select("table_data.headers", "table_data.rows", "confidence_score").first() == (["a", "b"], [["1", "2"]], 1.0)


def test_tables_are_parsed_once(spark):
    """The lines of a table are cut once, however many of its parts are taken from them."""
    parsed = spark.createDataFrame([("a|b\n--|--\n1|2",)], "t string").select(tables.parse_markdown(F.col("t")).alias("x"))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("u2028") == 1 and parsed.first().x == (["a", "b"], [["1", "2"]])


def test_edges_come_from_nodes(spark, tmp_path):
    """A chunk's mentions are distinct in its row, and edges that join nodes are those of the nodes written."""
    entities = [("Ann", "PERSON", "a"), ("Ann", "PERSON", "b"), ("Ann", None, "c"), ("", "ORG", "d"), (None, "ORG", "e")]
    chunks = spark.createDataFrame([("c1", entities), ("c2", None), ("c3", [])], "chunk_id string, entities array<struct<text:string,type:string,value:string>>")
    assert exchanges(graph.mentions(chunks, unique=True)) == 0
    want = [("c1", "Ann", "PERSON"), ("c1", "Ann", "UNKNOWN")]
    assert sorted(map(tuple, graph.mentions(chunks, unique=True).collect())) == sorted(map(tuple, graph.mentions(chunks).collect())) == want
    store = stores.TableStore(spark, f"file://{tmp_path}/t", ["k"])
    first = store.upsert(spark.range(3).selectExpr("id AS k", "rand() AS v"))
    assert sorted(first.collect()) == sorted(store.read().collect())


def test_words_are_hashed_once():
    from quire import providers

    providers._word_hash.cache_clear()
    assert HashEmbedder().embed("some words are some") == HashEmbedder().embed("words some some are")
    assert providers._word_hash.cache_info().misses == 3


def test_copies_of_a_file_are_read_once(spark, tmp_path):
    rows = [("d", path, "d", "txt", 1, "a\nb") for path in ("y", "x")]
    pages = spark.createDataFrame(rows, "document_id string, source_path string, content_hash string, format string, page_number int, native_text string")
    pipeline = engine.Pipeline(sinks=stores.default_stores(spark, f"file://{tmp_path}/out", HashEmbedder()))
    told = pipeline.write(pipeline.run(pages))
    assert {(r.sink, r.status) for r in told.collect()} == {(s, "ok") for s in stores.SINKS}
    mongo = pipeline.sinks["mongo"]
    assert [(r.source_path, r.total_pages) for r in mongo.documents.read().collect()] == [("x", 1)]
    assert [r.text for r in mongo.regions_of("d").collect()] == ["a", "b"] and [r.raw_text for r in mongo.chunks_of("d").collect()] == ["a b"]


def test_filters_fit_their_files(spark, tmp_path):
    """A Bloom filter of a few keys takes no MB."""
    store = stores.TableStore(spark, f"file://{tmp_path}/t", ["k"], bloom=["v"])
    store.upsert(spark.range(100).selectExpr("id AS k", "sha2(string(id), 256) AS v"))
    assert sum(e["bytes"] for e in store._entries()) < 1_000_000


def test_long_page(spark):
    """More lines than an array block holds, against a plain reckoning."""
    lines = ["|" if i % 7 in (2, 3, 4) else "" if i % 5 == 0 else "x" * (i % 240) for i in range(700)]
    page = spark.createDataFrame([("d", 1, "\n".join(lines))], "document_id string, page_number int, native_text string")
    want, top, i = [], 0, 0
    while i < len(lines):
        n = 3 if lines[i : i + 3] == ["|"] * 3 else 1
        rows = sum(max(-(-len(x) // 100), 1) for x in lines[i : i + n])
        if n == 3 or lines[i]:
            want.append(("table" if n == 3 else "text", "\n".join(lines[i : i + n]), 120.0 + 36 * top, 120.0 + 36 * (top + rows)))
        top, i = top + rows, i + n
    got = [(r.region_type, r.text, r.bbox.y0, r.bbox.y1) for r in layout.virtual_regions(page).orderBy("region_index").collect()]
    assert got == want


def test_registry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and len(names) > 60
    assert json.dumps(sorted(names)) and F is not None
