import hashlib
import random
import re

import pytest

from quire.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    windows = {}
    for item_id, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item_id)
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (x := tuple(w[i : i + k])) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[x]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "café", "stone", "a", "river", "中文", "x1", "no", "yes"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 4, 5, 6, 12, 13, 14, 40]))) for i in range(12)] + [(100, None), (3, text(20)), (None, text(15))]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 40))]
        if rng.random() < 0.5:
            w = (rng.choice(items)[1] or "").split(" ")
            parts.append(" ".join(w[rng.randint(0, 2) :]).upper())
        docs.append((i, " ".join(parts + [text(rng.randint(0, 200))])))
    return docs + [(7, docs[7][1]), (None, text(30)), (90, None), (91, "")], items


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("seed,block_bytes", [(1, 1 << 20), (2, 1 << 20), (3, 400)])
def test_against_all_windows(spark, seed, block_bytes):
    docs, items = made(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontam.scan(d, b, block_bytes=block_bytes)) == brute(docs, items)
    kept = lambda share: sorted(str((r.doc_id, r.text)) for r in decontam.remove_contaminated(d, b, least_share=share, block_bytes=block_bytes).collect())
    flags = [(i, t, *brute([(i, t)], items)[0][2:6:3]) for i, t in docs]
    assert kept(0.05) == sorted(str((i, t)) for i, t, _, many in flags if not many)
    assert kept(0.0) == sorted(str((i, t)) for i, t, n_hit, _ in flags if not n_hit)


def test_one_passage_in_a_long_text_is_enough(spark):
    item = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, "x " * 5000 + item + " y" * 5000), (2, "x " * 10_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in decontam.remove_contaminated(docs, items).collect()] == [2]
    assert not decontam.scan(docs, items).where("contaminated").count()


def test_small_shards(monkeypatch):
    docs, items = made(5)
    monkeypatch.setattr(decontam._shards, "__defaults__", (200,))
    bench = decontam.Benchmark(items)
    found = list(decontam._hits([t for _, t in docs], lambda: [bench]))
    assert [(n, h) for n, h, _ in found] == [brute([d], items)[0][1:3] for d in docs]


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_longest_matches(spark, block_bytes):
    item = [f"w{i}" for i in range(30)]
    text = " ".join(["a", "b", *item[5:25], "c", *item[15:], *item[:12], "Short", "ONE."])
    docs = spark.createDataFrame([(1, text), (2, "short one short"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, "short one"), (9, "")], "item_id long, text string")
    got = {tuple(r) for r in decontam.matches(docs, items, block_bytes=block_bytes).collect()}
    assert got == {(1, "7", 5, 2, 20), (1, "7", 15, 23, 15), (1, "8", 0, 50, 2), (2, "8", 0, 0, 2)}


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    assert decontam.scan(odd_docs, items).count() == 10 and decontam.scan(no_docs, items).count() == 0
    assert decontam.scan(odd_docs, items.limit(0)).where("contaminated or n_hit > 0").count() == 0
    kept = decontam.remove_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == 7
