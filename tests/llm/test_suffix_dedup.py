import hashlib
import random

import numpy as np
import pytest

from quire.llm import suffix_dedup as sd


def brute(rows, window=100):
    """Rows (doc_id, text), doc_ids unique and not null."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            w = raw[i : i + window]
            if w in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "café", "stone", "a", "river", "中文", "x" * 30]
    passages = [" ".join(rng.choices(words, k=rng.randint(10, 90))) for _ in range(8)] + ["-" * 330, "ab" * 120]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(rng.randint(0, 5))]
        text = " ".join(parts)
        if rng.random() < 0.2 and texts:
            text = rng.choice(texts) + text[: rng.randint(0, 200)]
        texts.append(text)
    return [(i * 3 - 5, t) for i, t in enumerate(texts)]


def got(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


@pytest.mark.parametrize("seed,hot", [(1, 1 << 30), (2, 3000), (3, 300)])
def test_against_all_windows(spark, seed, hot):
    rows = corpus(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(sd.dedup(frame, hot_bytes=hot)) == brute(rows)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order(seed):
    rng = random.Random(seed)
    raw = bytes(rng.choices(b"ab" if seed % 2 else b"abcde \xff", k=rng.randint(1, 700)))
    text = np.frombuffer(raw, dtype=np.uint8)
    order = sd.two_stage(text, 100).tolist()
    assert sorted(order) == list(range(len(raw)))
    assert [raw[i : i + 100] for i in order] == sorted(raw[i : i + 100] for i in range(len(raw)))


def test_long_document(spark, monkeypatch):
    text = " ".join(str(i * 7919 % 100_003) for i in range(400)) * 3
    rows = [(1, text), (2, text[500:4000])]
    monkeypatch.setattr(sd, "BUFFER", 1500)
    found = list(zip(*[np.concatenate(x) for x in zip(*[[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in _batches(rows)])]))
    assert found
    assert got(sd.dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def _batches(rows):
    import pyarrow as pa

    captured = {}

    class Fake:
        def mapInArrow(self, run, schema):
            captured["run"] = run

    sd._anchors(Fake(), 100)
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    return captured["run"]([batch])


def test_odd_rows(odd_docs, no_docs):
    rows = sd.dedup(odd_docs).collect()
    assert len(rows) == 10 and sd.dedup(no_docs).count() == 0
    by = {r.doc_id: r for r in rows}
    assert (by[2].n_bytes, by[2].n_removed, by[2].n_spans) == (0, 0, 0)
    assert by[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert (by[6].n_bytes, by[6].n_removed, by[6].n_spans) == (150_000, 149_995, 1)


def test_a_line_in_very_many_contexts(spark):
    """One line in every document: its anchors are hot at every level, down to whole windows."""
    rng = random.Random(4)
    line = "this line of some eighty characters stands in every single document of the corpus, "
    rows = [(i, f"{rng.random()} {rng.choice('ab')}{line}{rng.choice('xyz')} {rng.choice(['tail one', 'tail two'])} " + line * rng.randint(0, 2)) for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for hot in (1, 4000):
        assert got(sd.dedup(frame, hot_bytes=hot)) == brute(rows)
