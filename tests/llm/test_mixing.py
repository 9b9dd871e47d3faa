import re

import numpy as np
import pytest

from quire.llm import mixing


def brute_targets(sizes):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        out = {s: 3.0 * sizes[s] if s in full else left * weight[s] / rest for s in names}
        more = {s for s in names if s not in full and out[s] > 3 * sizes[s]}
        if not more:
            return out
        full |= more


def rows_of(n=3000, seed=4):
    rng = np.random.default_rng(seed)
    names = ["a", "b", "é", "zz", None]
    share = [0.6, 0.02, 0.2, 0.1, 0.08]
    return [(i, "w " * int(min(400, rng.pareto(1.2) * 20)), names[rng.choice(5, p=share)]) for i in range(n)]


@pytest.mark.parametrize("block", [40, 2000])
def test_targets_and_totals(spark, block):
    rows = rows_of()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(frame, block=block).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    sizes = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    targets = brute_targets(sizes)
    assert len(got) == len(rows) and all(r["size"] == size[r.doc_id] and r.source_size == sizes[r.source] for r in got)
    taken, docs = {}, {}
    for r in got:
        assert r.target == pytest.approx(targets[r.source]) and r.taken == r.copies * r["size"] <= 3 * r["size"]
        assert r.copies in (int(r.target / r.source_size + 1e-9), int(r.target / r.source_size + 1e-9) + 1)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        docs[r.source] = docs.get(r.source, 0) + r.copies
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(n for i, n in size.items() if rows[i][2] == s) / 2  # what landing may leave
        assert abs(docs[s] - t / sizes[s] * sum(x == s for _, _, x in rows)) <= 2
    again = mixing.mix(frame.repartition(2), block=block).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in got)


def test_capped_source(spark):
    rows = [(1, "a b", "s1"), (2, "c " * 1000, "s2"), (3, "d " * 1000, "s3")]
    got = {r.source: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert (got["s1"].target, got["s1"].copies) == (6.0, 3)
    assert got["s2"].target == pytest.approx(1996 * 2 / 5) and got["s3"].target == pytest.approx(1996 * 3 / 5)


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    p, sizes = np.full(500, 0.37), np.sort(rng.integers(0, 1000, 500))[::-1].astype(float)
    out = mixing.flight(p, sizes, np.random.default_rng(3), land=False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and out @ sizes == pytest.approx(p @ sizes)
    means = np.mean([mixing.flight(np.full(6, 0.4), np.array([9.0, 7, 5, 3, 2, 1]), np.random.default_rng(i), False) for i in range(3000)], axis=0)
    assert np.abs(means - 0.4).max() < 0.03  # the flight keeps every inclusion probability
    landed = mixing.flight(p, sizes, np.random.default_rng(3), land=True)
    assert set(landed) <= {0.0, 1.0} and abs(landed.sum() - p.sum()) <= 1 and abs(landed @ sizes - p @ sizes) <= 2


def test_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == 10 and {r["size"] for r in got if r.doc_id in (2, 3, 7)} == {0}
    assert mixing.mix(no_docs).count() == 0 and mixing.repeat_rows(no_docs).count() == 0
    repeated = mixing.repeat_rows(odd_docs)
    assert repeated.columns == odd_docs.columns
    by: dict = {}
    for r in got:
        by[r.doc_id] = by.get(r.doc_id, 0) + r.copies
    found: dict = {}
    for r in repeated.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {k: v for k, v in by.items() if v}
