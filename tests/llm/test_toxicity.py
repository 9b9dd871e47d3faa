import math
import random
import re
import zlib

import pytest

from quire.llm import toxicity


def corpus(n, seed=1):
    """Documents of made-up words; the toxic ones hold one bad word in one sentence."""
    rng = random.Random(seed)
    parts = ["ka", "lo", "mi", "ren", "tus", "vo", "sil", "da"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(word() for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(2, 15))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["grobian", "zilchum" + word(), "Pest!"])
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus(1500)
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, dict(labels), toxicity.train(toxicity.sample(docs, marks))


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    rows = toxicity.score(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_only_rows_outside_the_fold_are_learned_from(spark):
    rows, labels = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels], "doc_id long, toxic int")
    assert toxicity.sample(docs, marks) == toxicity.sample(docs, flipped)
    assert len(toxicity.sample(docs, marks, sample_docs=50)) == 50


def test_offending_sentences(trained):
    docs, labels, model = trained
    found = toxicity.locate(docs, model).collect()
    bad = [r for r in found if any(b in r.text for b in ("grobian", "zilchum", "Pest"))]
    assert len(bad) / len(found) > 0.9 and len({r.doc_id for r in bad}) / sum(labels.values()) > 0.9


def test_long_clean_text_stays_clean(trained):
    _, _, model = trained
    rows, _ = corpus(5000, seed=9)
    assert model.score(" ".join(t for i, t in rows if i % 4)) < 0.5


def test_odd_rows(spark, odd_docs, no_docs, trained):
    model = trained[2]
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == 10 and all(r.score == model.empty for r in rows if r.doc_id in (2, 3, 7))
    assert not next(r for r in rows if r.doc_id is None).held_out
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.remove_toxic(odd_docs, model).columns == odd_docs.columns
    none = toxicity.train(toxicity.sample(odd_docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")))
    assert toxicity.score(odd_docs, none).where("score > 0").count() == 0


def brute_score(text, model):
    """The noisy-or written out: no sums of logarithms, no cache of words."""
    fold = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    bags = [w for s in re.split(r"[.!?\n]+", text or "") if (w := re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(s)))]
    if not bags:
        return model.empty
    none = 1.0
    for words in bags:
        z = model.bias - math.log(len(bags))
        for w in words:
            z += sum(model.weights.get(f.encode(), 0.0) for f in [w, *("^" + w[:n] for n in range(3, 7) if n < len(w))])
        none *= 1 - 1 / (1 + math.exp(-z))
    return 1 - none


def test_scores_against_brute_force(trained):
    docs, _, model = trained
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert model.weights
    for r in toxicity.score(docs, model).collect():
        assert r.score == pytest.approx(brute_score(texts[r.doc_id], model), abs=1e-9)


def test_training_climbs_the_likelihood_that_scoring_uses():
    rows, labels = corpus(200)
    rows = [(t, y) for (_, t), (_, y) in zip(rows, labels)]

    def loss(model):
        return -sum(math.log(max(1e-12, s if y else 1 - s)) for t, y in rows for s in [brute_score(t, model)])

    assert loss(toxicity.train(rows, steps=60)) < 0.5 * loss(toxicity.train(rows, steps=5)) < loss(toxicity.train(rows, steps=0))


def test_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    whole = toxicity.sample(docs, marks)
    assert toxicity.sample(docs, marks, total_bytes=10_500) == whole[:10]
    assert toxicity.sample(docs, marks, sample_bytes=999) == []
