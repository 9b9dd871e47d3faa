import random
import re
import zlib

import numpy as np
import pytest

from quire.llm import sstable, token_rollup
from quire.llm.bpe import Encoder
from quire.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pieces_equal_whole_texts(library):
    rng = random.Random(3)
    parts = [" ", "\n", "\t", "a", "Bc", "é", "ß", "1", "٣", "²", ",", ".", "'s", "'", "!", "-", "_", "<|endoftext|>", "\r", "\xa0", "中", "🙂", "́", "\x1c", " "]
    enc = Encoder(tokenizer_path())
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(6000)]
    whole = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in Encoder(tokenizer_path()).encode_all(texts)] == whole
    for text in texts[:2000]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_full_cache(monkeypatch, library):
    from quire.llm import bpe

    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "OTHER_ENTRIES", 3)
    enc = Encoder(tokenizer_path())
    for text in ["a b c d e f g h", "one two three four five six, seven. eight", "a b c", "(a) b!! c?? d:: e;;"] * 3:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(enc.plain) <= 3 and len(enc.others) <= 3


def test_shards(spark, odd_docs, no_docs, library):
    manifest = sstable.write_shards(odd_docs, tokenizer_path())
    got = sorted((tuple(r)[:4] for r in sstable.read_shards(manifest).collect()), key=lambda r: r[1])
    rows = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    at, expected = 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == expected
    assert sstable.read_shards(sstable.write_shards(no_docs, tokenizer_path())).count() == 0


def test_lookup(spark, library):
    rows = [(i * 7 - 300, f"document {i} " * (i % 5)) for i in range(400)] + [(70, "twice"), (70, "twice again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    shards = [sstable.open_shard(r.path) for r in sstable.write_shards(frame, tokenizer_path()).collect()]
    texts: dict = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    for i in range(-310, 2500):
        found = [ids.tolist() for s in shards for ids in s.get(i)]
        assert sorted(found) == sorted(library.encode(t, add_special_tokens=False).ids + [2] for t in texts.get(i, []))


def test_many_blocks(tmp_path):
    path = tmp_path / "x.sst"
    ids = [np.arange(i % 900, dtype=np.uint32) * 60 for i in range(700)]
    with path.open("wb") as out:
        writer = sstable.Writer(out, 2)
        for i, x in enumerate(ids):
            writer.add(sstable.key_of(i * 3), x)
        writer.finish()
    shard = sstable.open_shard(str(path))
    assert len(shard.index) > 5 and [i for i, _ in shard] == [i * 3 for i in range(700)]
    assert all((a == b).all() for (_, a), b in zip(shard, ids))
    assert (shard.get(300)[0] == ids[100]).all() and shard.get(301) == [] and shard.get(-1) == [] and shard.get(10**9) == []
    with pytest.raises(ValueError):
        (tmp_path / "y.sst").write_bytes(path.read_bytes()[:-20] + b"\0" * 20)
        sstable.open_shard(str(tmp_path / "y.sst"))


def totals(frame):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in frame.collect()}


def test_rollup_commits_once(spark):
    counts = spark.createDataFrame([("a", "en", "v1", 5), ("a", "en", "v1", 7), (None, None, "v1", None)], "source string, lang string, version string, tokens long")
    rollup = token_rollup.Rollup(spark)
    assert totals(rollup.totals()) == {}
    assert rollup.commit("b1", token_rollup.inserts(counts)) and not rollup.commit("b1", token_rollup.inserts(counts))
    assert totals(rollup.totals()) == {("a", "en", "v1"): (2, 12), (None, None, "v1"): (1, 0)}
    old, new = counts.where("tokens = 7"), spark.createDataFrame([("a", "en", "v2", 9)], counts.schema)
    assert rollup.commit("b2", token_rollup.revisions(old, new))
    rollup.compact()
    assert not rollup.commit("b2", token_rollup.revisions(old, new)) and rollup.batches() == {"b1", "b2"}
    assert rollup.commit("b3", token_rollup.deletes(counts.where("tokens = 5"))) and rollup.commit("empty", token_rollup.inserts(counts.limit(0)))
    expected = {("a", "en", "v2"): (1, 9), (None, None, "v1"): (1, 0)}
    assert totals(rollup.totals()) == expected
    rollup.compact()
    assert totals(token_rollup.Rollup(spark, rollup.folder).totals()) == expected
    with pytest.raises(ValueError):
        rollup.commit("../x", token_rollup.inserts(counts))


def test_two_writers_and_two_compactors(spark):
    """Each prepares before the other has published: one wins, and nothing is lost or counted twice."""
    part = lambda n: token_rollup.inserts(spark.createDataFrame([("a", "en", "v", n)], "source string, lang string, version string, tokens long"))
    one = token_rollup.Rollup(spark)
    two = token_rollup.Rollup(spark, one.folder)
    staged = [r._stage("log/b", part(7)) for r in (one, two)]
    assert one._publish("b", staged[0]) and not two._publish("b", staged[1])
    first = one.prepare()
    assert two.commit("c", part(1))
    second = two.prepare()  # it has seen one batch more
    assert one.publish(*first) and not two.publish(*second)
    assert one.batches() == two.batches() == {"b", "c"} and totals(two.totals()) == {("a", "en", "v"): (2, 8)}
    assert two.compact() and not one.commit("c", part(1)) and not one.commit("b", part(7))
    assert totals(one.totals()) == {("a", "en", "v"): (2, 8)} and one._names("log") == []
    # A batch that was staged before a compaction took it up isn't published after it.
    late = two._stage("log/c", part(1))
    assert not two._publish("c", late) and totals(one.totals()) == {("a", "en", "v"): (2, 8)}
    # A writer lost between creating its marker and naming its folder.
    three = one._stage("log/d", part(5))
    assert one._mark("log/d", "") and three and totals(two.totals()) == {("a", "en", "v"): (3, 13)}


def test_maintained_totals_equal_a_recount(odd_docs, no_docs, library):
    got = totals(token_rollup.maintain(odd_docs, tokenizer_path(), "bpe"))
    rows = odd_docs.select("doc_id", "text", "source", "lang").collect()
    first: dict = {}
    for r in rows:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    expected: dict = {}
    for r in rows:
        text = r.text or ""
        if r.doc_id is not None and r.doc_id > first[text]:
            continue
        for version, n in (("words@1", len(re.findall(r"[^\x20\x09-\x0D]+", text))), ("bpe@2", len(library.encode(text, add_special_tokens=False).ids) + 1)):
            a, b = expected.get((r.source, r.lang, version), (0, 0))
            expected[r.source, r.lang, version] = (a + 1, b + n)
    assert got == expected
    assert totals(token_rollup.maintain(no_docs, tokenizer_path(), "bpe")) == {}
