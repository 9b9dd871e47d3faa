import random

import numpy as np
import pytest

from quire.llm import simhash


def brute_components(pairs_of, values):
    label = {v: v for v in values}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in pairs_of:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def brute_fingerprint(text):
    import re

    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "A b", "One", "a b c", "the The THE cat " * 50, "é É x\x0by z"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def near_values(n, seed):
    rng = random.Random(seed)
    values = {0, (1 << 64) - 1}
    while len(values) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            values.add(v)
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
    return sorted(values)


@pytest.mark.parametrize("hot", [1_000_000, 2])
def test_components_against_all_pairs(spark, hot):
    values = near_values(400, hot)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2]
    expected = brute_components(pairs, signed)
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), hot=hot)
    got = {r.node: r.component for r in simhash.components(links).collect()}
    assert {v: got.get(v, v) for v in signed} == expected


def test_chunked_frontier(monkeypatch):
    values = np.array(near_values(300, 5), dtype=np.uint64)
    whole = simhash.trie_links(np.zeros(len(values), np.int64), values)
    monkeypatch.setattr(simhash, "FRONTIER", 7)
    assert (simhash.trie_links(np.zeros(len(values), np.int64), values) == whole).all()


def test_odd_rows(spark, odd_docs, no_docs):
    rows = simhash.classes(odd_docs).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[1].component_id == by[4].component_id == 1
    assert {by[i].component_id for i in (2, 3, 7)} == {2} and by[2].fingerprint == "0" * 16
    assert by[None].component_id is None
    kept = simhash.keep_representatives(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 6, 8, 9]
    assert simhash.classes(no_docs).count() == 0 and simhash.keep_representatives(no_docs).count() == 0


def test_representatives_are_rows(spark):
    a, b, c = "one text of a few words here", "quite another text with other words", "a third that stands alone in this set"
    kept = lambda rows: sorted(str((r.doc_id, r.text)) for r in simhash.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string, __x string")).collect())
    told = lambda *rows: sorted(str(r) for r in rows)
    assert kept([(3, a, ""), (5, a, ""), (5, b, ""), (9, c, "")]) == told((3, a), (5, b), (9, c))
    assert kept([(5, a, ""), (5, b, "")]) == told((5, a), (5, b))
    assert kept([(5, a, ""), (5, a, ""), (None, a, ""), (None, b, ""), (None, b, "")]) == told((5, a), (None, b))
