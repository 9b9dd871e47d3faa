import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from quire.llm import simhash
from quire.llm.queries import queries, tokenizer_path
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_toxicity import corpus


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """A small corpus with planted copies, near copies, benchmark passages and toxic documents."""
    rows, labels = corpus(600)
    passage = "one benchmark passage that nobody else would write down in quite this very order of words at all"
    docs = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in rows]
    docs += [(1000 + i, docs[i][1], "en", "src0", 1) for i in range(1, 30, 2)]
    docs += [(2000, passage, "en", "src1", 1), (2001, docs[1][1][:60] + " " + passage, "en", "src1", 1), (2002, None, "en", "src1", None), (2003, "", None, None, 0), (2004, "  ", "en", "src2", 0), (2005, docs[2][1] * 30 + passage, "en", "src2", 0)]
    path = tmp_path_factory.mktemp("sf")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, d)) for d in docs], schema), path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": [i for i, _ in labels], "quality": [1] * len(labels), "toxic": pa.array([y for _, y in labels], pa.int32())}), path / "labels.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [passage]}), path / "benchmark.parquet")
    return str(path), docs, dict(labels), passage


def test_stages(spark, folder):
    path, docs, labels, passage = folder
    frame = spark.read.parquet(f"{path}/documents.parquet")
    seen = [frame]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.materialize(stage(spark, frame, path), name)
        assert frame.columns == seen[0].columns
        seen.append(frame)
    ids = [{r.doc_id for r in f.collect()} for f in seen]
    toxic = {i for i, y in labels.items() if y}
    gone = ids[0] - ids[1]
    copies_of_toxic = {d for d in ids[0] if 1000 <= d < 2000 and labels[d - 1000]}
    assert len(gone & toxic) > 0.95 * len(toxic) and len(gone - toxic - copies_of_toxic) <= 3
    # Near copies: the smallest of each component of what is left stays.
    texts = {d[0]: d[1] for d in docs}
    prints = {i: simhash.fingerprint(texts[i]) for i in ids[1]}
    label = {i: i for i in ids[1]}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    order = sorted(ids[1])
    for k, a in enumerate(order):
        for b in order[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    assert ids[2] == {i for i in order if find(i) == i}
    flags = {r[0]: r[2] > 0 for r in brute_hits([(i, texts[i]) for i in ids[2]], [(1, passage)])}
    assert ids[3] == {i for i in ids[2] if not flags[i]} and flags[2000] and ids[2] - ids[3] == {i for i in flags if flags[i]}
    # The mix takes each source near its target, no document more than three times.
    counts: dict = {}
    for r in seen[4].collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert set(counts) <= ids[3] and max(counts.values()) <= 3
    # The shards hold the mix in order.
    from tokenizers import Tokenizer

    library, at, expected = Tokenizer.from_file(tokenizer_path()), 0, []
    for i in sorted(counts):
        for _ in range(counts[i]):
            tokens = library.encode(texts[i] or "", add_special_tokens=False).ids + [2]
            expected.append((i, at, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
            at += len(tokens)
    last = corpus_pipeline.STAGES[-1][1](spark, seen[4], path)
    assert sorted(tuple(r)[:4] for r in last.collect()) == expected
    assert sorted(tuple(r)[:4] for r in corpus_pipeline.run(spark, path).collect()) == expected


def test_empty_table(spark, folder, tmp_path):
    path = folder[0]
    for name in ("documents", "labels", "benchmark"):
        pq.write_table(pq.read_table(f"{path}/{name}.parquet").slice(0, 0), tmp_path / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_that_share_an_identifier_or_have_none(spark, folder, tmp_path):
    """Null and repeated doc_ids, a very long text, nulls in every column, names that operators use inside."""
    path, _, _, passage = folder
    for name in ("labels", "benchmark"):
        pq.write_table(pq.read_table(f"{path}/{name}.parquet"), tmp_path / f"{name}.parquet")
    own = lambda k, n=40: " ".join(f"u{k}w{i}" for i in range(n))
    rows = [(3, own(1)), (5, own(1)), (5, own(2)), (5, own(2)), (9, own(3)), (None, own(4)), (None, own(5)), (None, own(5)), (11, own(6, 200_000)), (12, None), (13, ""), (14, own(7) + passage), (None, passage), (15, own(8))]
    docs = [(i, t, None if i == 15 else "en", None if i == 15 else "a", None, "x", 1, 2.5, "y", 7) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, row int, size double, copies string, block long"
    frame = spark.createDataFrame(docs, schema).coalesce(1)
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.materialize(stage(spark, frame, str(tmp_path)), name)
        assert frame.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        seen.append(sorted(str((r.doc_id, r.text)) for r in frame.collect()))
    told = lambda *kept: sorted(str(k) for k in kept)
    assert seen[0] == told(*rows)
    single = [(3, own(1)), (5, own(2)), (9, own(3)), (None, own(4)), (None, own(5)), (11, own(6, 200_000)), (12, None), (14, own(7) + passage), (None, passage), (15, own(8))]
    assert seen[1] == told(*single)
    clean = [r for r in single if passage not in (r[1] or "")]
    assert seen[2] == told(*clean)
    assert set(seen[3]) <= set(seen[2]) and max(seen[3].count(r) for r in seen[3]) <= 3
    shards = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in shards) == sorted(str(r.doc_id) for r in frame.collect())


def test_registry():
    assert [f"op{n}" for n in range(1, 11)] == [name.split("_")[0] for name in queries()]
    assert "quire.llm" in sys.modules and len(corpus_pipeline.STAGES) == 5
