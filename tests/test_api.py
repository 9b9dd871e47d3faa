import pytest
from pyspark.sql import functions as F

from quire.operators import layout, stores
from quire.plans.api import Retrieval
from quire.providers import HashEmbedder
from quire.schema import ENTITY

TEXTS = ["the harbour wall of Dover", "a red kite over Dover", "harbour dues and ledgers", "nothing else"]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(f"c{i}", f"d{i % 2}", i, "text", t, 1.0 if i else 0.2, '{"k": %d}' % i, [("Dover", "LOCATION", "Dover")] if "Dover" in t else []) for i, t in enumerate(TEXTS)]
    chunks = spark.createDataFrame(rows, f"chunk_id string, document_id string, reading_order_index int, content_type string, overview string, confidence_score double, structured_data string, entities array<{ENTITY}>")
    vectors = stores.embed_chunks(chunks, HashEmbedder())
    assert vectors.columns[-1] == "vector"
    return Retrieval(chunks, stores.write_and_read(vectors))


def ids(page):
    return [r.chunk_id for r in page.rows]


def test_pages(found):
    page = found.structured(jsonpath="$.k ? (@ >= 1)", limit=2, count=True)
    assert ids(page) == ["c1", "c2"] and page.total == 3
    assert ids(found.structured(jsonpath="$.k ? (@ >= 1)", limit=2, cursor=page.next_cursor)) == ["c3"]
    assert ids(found.documents({"document_id": "d0"}, "harbour", min_confidence=0.5)) == ["c2"]
    assert ids(found.vector("harbour dues and ledgers", limit=1)) == ["c2"]
    assert ids(found.graph("Dover", depth=1)) == ["c0", "c1"] and ids(found.graph(document_id="d1")) == ["c1", "c3"]


def test_fused(found):
    page = found.fused("harbour wall of Dover", top_k=3)
    assert ids(page)[0] == "c0" and set(page.rows[0].sources) == {"text", "vector", "graph"} and page.total == 3
    assert set(ids(found.fused("harbour", include_adapters=["text"]))) == {"c0", "c2"}
    assert ids(found.fused("Dover", metadata_filter={"document_id": "d1"}, include_adapters=["graph"])) == ["c1"]


class Boxes:
    def detect(self, image):
        return [(3, 0, 0, 10, 10, 0.9), (0, 0, 20, 10, 30, 0.2), (99, 0, 40, 10, 50, 0.5)]

    def size(self, image):
        return 100, 200


def test_detector(spark):
    pages = spark.createDataFrame([("d", 1, b"png")], "document_id string, page_number int, image binary")
    rows = layout.detect_regions(pages, Boxes()).orderBy("region_index").collect()
    assert [(r.region_index, r.region_type, r.bbox.page_height) for r in rows] == [(0, "table", 200.0), (1, "text", 200.0)]
    full = layout.full_page_regions(pages.withColumn("native_text", F.lit("x"))).first()
    assert (full.region_type, full.detector_confidence, full.bbox.x1) == ("text", 1.0, 2480.0)
