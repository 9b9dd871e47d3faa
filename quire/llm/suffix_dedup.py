"""Exact substring dedup: every byte covered by a 100-byte string that also starts earlier goes.

1. Anchors. Every window of 100 bytes has one anchor, the 24-byte string in it of the least hash (the
   leftmost of equals). It depends on the window's content alone, so equal windows have equal anchors.
   Consecutive windows with one anchor form a run: some 130 bytes of text, one record of hashes and place.
2. Equal runs (same anchor hash and same XXH3 of their bytes, two independent 64-bit hashes) repeat as a
   whole: all but the first are marked. Equal runs of one buffer are settled before the shuffle, so a text in
   millions of documents sends a record a buffer, not a document. Records are dealt out by both hashes, so
   an anchor that stands in very many contexts isn't one task's.
3. Anchors left with one run can't repeat and end here. Of those that stand in several different runs, the first
   occurrence of each run is fetched and these texts, some megabytes at a time, are made into a suffix array by
   two-stage sorting: suffixes smaller than their successors are sorted directly (to window depth), all others
   are induced by one scan of the buckets. Neighbours with a common prefix of 100 bytes are equal windows; all
   but the earliest are marked. The runs of an anchor with more text than ``hot_bytes`` are cut first into runs of
   a longer anchor (60, then 92 bytes), and sorted by these; what is still as large goes by whole windows.
4. Marks are united by document and the kept bytes hashed.

Texts are shuffled twice (3 and 4), by document.

Cases: null text is empty: no bytes, no spans; documents are ordered by doc_id, null last, and rows
with one doc_id by a hash of their text; repeated rows are one document, each row gets its result;
an empty table gives no row; other columns are ignored. A document of any length is cut into
overlapping buffers, which changes where runs end and not which windows are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialize, no_worker_state

WINDOW = 100
GRAM = 24
BUFFER = 1 << 22
PLACE_BITS = 23
ARRAY_BYTES = 1 << 21
HOT_BYTES = 2 << 20
LONGER_GRAMS = (60, 92)
SEPARATOR = 0xFF  # in no UTF-8 text
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1


class Powers:
    """Powers of BASE and its inverse modulo 2**64, and a random number for each byte."""

    def __init__(self, n: int):
        self.power, self.inverse = (np.full(n + 1, b, dtype=U) for b in (BASE, pow(BASE, -1, 1 << 64)))
        for x in (self.power, self.inverse):
            x[0] = 1
            np.cumprod(x, dtype=U, out=x)
        self.byte = np.random.default_rng(1).integers(0, 1 << 64, 256, dtype=U)


_powers: list[Powers] = []


def powers() -> Powers:
    if not _powers:
        _powers.append(Powers(BUFFER + WINDOW + 16))
    return _powers[0]


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ U(salt)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def runs(data: np.ndarray, first: np.ndarray, last: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Runs of windows with one anchor in a buffer whose documents start at ``first`` and end at ``last``:
    (start, number of windows, anchor hash, text hash)."""
    from xxhash import xxh3_64_intdigest

    n, p = len(data), powers()
    long_ = last - first >= window
    first, last = first[long_], last[long_]
    if not len(first):
        return [np.zeros(0, np.int64)] * 2 + [np.zeros(0, U)] * 2
    prefix = np.zeros(n + 1, dtype=U)
    np.cumsum(p.byte[data] * p.power[:n], out=prefix[1:])
    grams = n - gram + 1
    g = mix((prefix[gram:] - prefix[:grams]) * p.inverse[:grams], 0x51)
    key = g & U(~((1 << PLACE_BITS) - 1) & (1 << 64) - 1) | np.arange(grams, dtype=U)
    span, width = window - gram + 1, 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
    anchor = (key & U((1 << PLACE_BITS) - 1)).astype(np.int64)
    change = np.zeros(n + 1, dtype=np.int8)
    change[first] += 1
    change[last - window + 1] -= 1
    valid = np.cumsum(change[: len(anchor)], dtype=np.int8) > 0
    begins = np.r_[True, anchor[1:] != anchor[:-1]]
    begins[first] = True
    start = np.flatnonzero(begins & valid)
    stop = np.minimum(np.r_[start[1:], n], (last - window + 1)[np.searchsorted(first, start, side="right") - 1])
    end = stop + window - 1
    raw = memoryview(data)
    text = np.fromiter([xxh3_64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())], dtype=U, count=len(start))
    return start, stop - start, g[anchor[start]], text


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of intervals by document, sorted."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    new_doc = np.r_[True, doc[1:] != doc[:-1]]
    group = np.cumsum(new_doc) - 1
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * far) - group * far
    new = np.r_[True, start[1:] > reach[:-1]] | new_doc
    at = np.flatnonzero(new)
    return doc[at], start[at], reach[np.r_[at[1:] - 1, len(doc) - 1]]


def key8(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as a big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    out = np.zeros(len(text), dtype=U)
    for k in range(8):
        out |= padded[k : k + len(text)].astype(U) << U(56 - 8 * k)
    return out


def two_stage(text: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """All suffixes of ``text`` in order, to ``depth`` bytes at least (equals beyond: any order)."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    # Type: smaller than its successor, or not; a run of one byte takes the type of its end.
    differs = np.r_[text[1:] != text[:-1], True]
    where = np.where(differs, np.arange(n), n)
    next_ = np.minimum.accumulate(where[::-1])[::-1]
    smaller = np.zeros(n, dtype=bool)
    inner = next_ < n - 1
    smaller[inner] = text[next_[inner]] < text[next_[inner] + 1]
    # First stage: sort the smaller ones directly, eight bytes at a time, as long as some are equal.
    words = np.concatenate([key8(text), np.zeros(depth + 8, dtype=U)])
    order = np.flatnonzero(smaller)
    order = order[np.argsort(words[order], kind="stable")]
    apart = np.r_[True, words[order[1:]] != words[order[:-1]]] if len(order) else np.zeros(0, bool)
    for at in range(8, depth + 7, 8):
        with_next = np.r_[~apart[1:], False] | ~apart if len(order) else apart
        slots = np.flatnonzero(with_next)
        if not len(slots):
            break
        group = np.cumsum(apart)[slots]
        keys = words[order[slots] + at]
        again = np.lexsort((keys, group))
        order[slots], keys = order[slots][again], keys[again]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])]
        apart[slots] |= new
    # Second stage: scan the buckets in order; each suffix places its predecessor if that isn't smaller.
    direct = np.searchsorted(text[order], np.arange(257)) if len(order) else np.zeros(257, np.int64)
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def place(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            chars = text[before]
            by = np.argsort(chars, kind="stable")
            before, chars = before[by], chars[by]
            cuts = np.r_[0, np.flatnonzero(chars[1:] != chars[:-1]) + 1, len(chars)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                pending[int(chars[a])].append(before[a:b])

    pending[int(text[-1])].append(np.array([n - 1]))
    for c in range(256):
        while pending[c]:
            wave = np.concatenate(pending[c])
            pending[c] = []
            out.append(wave)
            place(wave)
        own = order[direct[c] : direct[c + 1]]
        if len(own):
            out.append(own)
            place(own)
    return np.concatenate(out)


def repeats(text: np.ndarray, order: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For neighbours in ``order``: whether their common prefix is ``window`` bytes or more."""
    words = np.concatenate([key8(text), np.zeros(window, dtype=U)])
    same = np.zeros(max(0, len(order) - 1), dtype=bool)
    at = np.arange(len(same))
    for offset in [*range(0, window - 7, 8), *([window - 8] if window % 8 else [])]:
        at = at[words[order[at] + offset] == words[order[at + 1] + offset]]
    same[at] = True
    return same


def array_marks(texts: list[bytes], doc: np.ndarray, start: np.ndarray, window: int = WINDOW):
    """Marks of the runs' windows that also start earlier in one of them, by a suffix array of all."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    text = np.frombuffer(b"".join(x for t in texts for x in (t, b"\xff")), dtype=np.uint8)
    base = np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    left = np.repeat(base + sizes, sizes + 1) - np.arange(len(text))
    order = two_stage(text, window)
    order = order[left[order] >= window]
    same = repeats(text, order, window)
    group = np.r_[0, np.cumsum(~same)] if len(order) else np.zeros(0, np.int64)
    own = owner[order]
    place = start[own] + order - base[own]
    by = np.lexsort((place, doc[own], group))
    later = np.r_[False, group[by][1:] == group[by][:-1]] if len(by) else np.zeros(0, bool)
    # The same place may stand in two runs only if buffers overlap: then it isn't later than itself.
    docs, places = doc[own][by], place[by]
    lead = np.maximum.accumulate(np.where(later, 0, np.arange(len(by)))) if len(by) else by
    later &= (docs != docs[lead]) | (places != places[lead])
    return merged(docs[later], places[later], places[later] + window)


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """Anchor records (h, t, doc_id, at = start * 128 + windows), and marks with t null (at = start, h: end)."""

    def run(batches):
        import pyarrow as pa

        def flush(waiting):
            waiting.sort(key=lambda x: (x[0], x[1]))
            data = np.frombuffer(b"".join(x for _, _, b in waiting for x in (b, b"\xff")), dtype=np.uint8)
            sizes = np.array([len(b) for _, _, b in waiting], dtype=np.int64)
            first = np.cumsum(sizes + 1) - (sizes + 1)
            ids, offsets = np.array([i for i, _, _ in waiting], dtype=np.int64), np.array([o for _, o, _ in waiting], dtype=np.int64)
            start, count, h, t = runs(data, first, first + sizes, window)
            own = np.searchsorted(first, start, side="right") - 1
            doc, place = ids[own], start - first[own] + offsets[own]
            order = np.lexsort((np.arange(len(h)), t, h))
            again = np.r_[False, (h[order][1:] == h[order][:-1]) & (t[order][1:] == t[order][:-1])] if len(order) else np.zeros(0, bool)
            repeat = np.zeros(len(h), dtype=bool)
            repeat[order] = again
            md, ms, me = merged(doc[repeat], place[repeat], place[repeat] + count[repeat] + window - 1)
            once = ~repeat
            columns = [np.r_[h[once].view(np.int64), me], np.r_[t[once].view(np.int64), np.zeros(len(md), np.int64)], np.r_[doc[once], md], np.r_[place[once] * 128 + count[once], ms]]
            arrays = [pa.array(c) for c in columns]
            arrays[1] = pa.array(columns[1], mask=np.r_[np.zeros(once.sum(), bool), np.ones(len(md), bool)])
            return pa.RecordBatch.from_arrays(arrays, ["h", "t", "doc_id", "at"])

        waiting, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode()
                for offset in range(0, max(1, len(raw) - window + 1), BUFFER - window):
                    part = raw[offset : offset + BUFFER - 1]
                    if len(part) < window:
                        continue
                    if size + len(part) + 1 > BUFFER and waiting:
                        yield flush(waiting)
                        waiting, size = [], 0
                    waiting.append((doc_id, offset, part))
                    size += len(part) + 1
        if waiting:
            yield flush(waiting)

    return docs.mapInArrow(run, "h long, t long, doc_id long, at long")


def _groups(records: DataFrame, window: int) -> DataFrame:
    """Marks (h null: doc_id, start, end) and the first occurrence of each run (h, doc_id, start, end)."""

    def run(batches):
        import pyarrow as pa

        def settle(h, t, doc, at, passed):
            start, end = at >> 7, (at >> 7) + (at & 127) + window - 1
            first = np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])] if len(h) else np.zeros(0, bool)
            if last is not None and len(h):
                first[0] = (h[0], t[0]) != last
            md, ms, me = merged(*(np.r_[a, b] for a, b in zip((doc[~first], start[~first], end[~first]), passed)))
            none = np.r_[np.ones(len(md), bool), np.zeros(first.sum(), bool)]
            columns = [pa.array(np.r_[np.zeros(len(md), np.int64), h[first]], mask=none), *(pa.array(np.r_[a, b[first]]) for a, b in ((md, doc), (ms, start), (me, end)))]
            return pa.RecordBatch.from_arrays(columns, ["h", "doc_id", "start", "end"])

        last = None
        no_worker_state()
        for batch in batches:
            marks = batch.filter(batch.column(1).is_null())
            batch = batch.filter(batch.column(1).is_valid())
            passed = [marks.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 0)]
            h, t, doc, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield settle(h, t, doc, at, passed)
            if len(h):
                last = (h[-1], t[-1])

    # Marks are dealt out by document, records by run.
    dealt = records.repartition(F.when(F.col("t").isNotNull(), F.xxhash64("h", "t")).otherwise(F.xxhash64("doc_id")))
    return dealt.sortWithinPartitions("h", "t", "doc_id", "at").mapInArrow(run, "h long, doc_id long, start long, end long")


def _split(pieces: DataFrame, gram: int, window: int) -> DataFrame:
    """The same windows in runs of a longer anchor: (h, doc_id, start, piece); h tells both anchors."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h, doc, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            raw = batch.column(3).to_pylist()
            for a in range(0, len(raw), 1024):
                some = raw[a : a + 1024]
                data = np.frombuffer(b"".join(x for r in some for x in (r, b"\xff")), dtype=np.uint8)
                sizes = np.array([len(r) for r in some], dtype=np.int64)
                first = np.cumsum(sizes + 1) - (sizes + 1)
                start, count, g, _ = runs(data, first, first + sizes, window, gram)
                own = np.searchsorted(first, start, side="right") - 1
                told = mix(g ^ h[a + own].view(U), gram).view(np.int64)
                cut = [some[i][s : s + n] for i, s, n in zip(own.tolist(), (start - first[own]).tolist(), (count + window - 1).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(told), pa.array(doc[a + own]), pa.array(place[a + own] + start - first[own]), pa.array(cut, pa.binary())], ["h", "doc_id", "start", "piece"])

    return pieces.mapInArrow(run, PIECES)


PIECES = "h long, doc_id long, start long, piece binary"


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, doc_id, start, piece) of the runs to compare."""
    by_doc = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("h", "start", "end")).alias("runs"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out: tuple[list, list, list, list] = ([], [], [], [])
                for doc_id, text, found in zip(*(c.to_pylist() for c in part.columns)):
                    raw = text.encode()
                    for r in found:
                        for column, value in zip(out, (r["h"], doc_id, r["start"], raw[r["start"] : r["end"]])):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["h", "doc_id", "start", "piece"])

    return docs.join(by_doc, "doc_id").select("doc_id", "text", "runs").mapInArrow(run, PIECES)


def _compare(pieces: DataFrame, window: int) -> DataFrame:
    """Marks (doc_id, start, end) from suffix arrays of whole anchors' texts."""

    def run(batches):
        import pyarrow as pa

        def settle(rows):
            doc, start = np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in array_marks([r[3] for r in rows], doc, start, window)], ["doc_id", "start", "end"])

        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= ARRAY_BYTES and row[0] != last:
                    yield settle(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
                last = row[0]
        if rows:
            yield settle(rows)

    return pieces.repartition("h").sortWithinPartitions("h").mapInArrow(run, "doc_id long, start long, end long")


def _compare_windows(pieces: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very much text: equal windows meet by a shuffle of the windows."""
    places = pieces.select("doc_id", "start", "piece", F.explode(F.sequence(F.lit(0), F.length("piece") - window)).alias("j"))
    places = places.select("doc_id", (F.col("start") + F.col("j")).alias("start"), F.expr(f"substring(piece, j + 1, {window})").alias("w"))
    first = places.groupBy("w").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    later = places.join(first, "w").where(F.struct("doc_id", "start") > F.col("first"))
    return later.select("doc_id", "start", (F.col("start") + window).alias("end"))


def _finish(docs: DataFrame, marks: DataFrame) -> DataFrame:
    by_doc = marks.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("marks"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for name, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                spans: list[list[int]] = []
                for start, end in sorted((m["start"], m["end"]) for m in found or ()):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                digest, at = hashlib.sha256(), 0
                for start, end in spans:
                    digest.update(raw[at:start])
                    at = end
                digest.update(raw[at:])
                rows.append((name, len(raw), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 4 + [pa.string()])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = docs.join(by_doc, "doc_id", "left").select("name", "text", "marks")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup(docs: DataFrame, window: int = WINDOW, hot_bytes: int = HOT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("name"), F.col(text_col).alias("text"))
    odd = docs.groupBy("name").count().where("name is null or count > 1")
    if odd.limit(1).count():  # number the documents in their order; rows of one range ascend with its number
        texts = docs.withColumn("hash", F.xxhash64("text"))
        ids = texts.select("name", "hash").distinct().orderBy(F.col("name").asc_nulls_last(), "hash").withColumn("doc_id", F.monotonically_increasing_id())
        ids = materialize(ids.withColumnsRenamed({"name": "n", "hash": "h"}), "suffix-ids")
        docs = texts.join(ids, F.col("name").eqNullSafe(F.col("n")) & (F.col("hash") == F.col("h"))).select("doc_id", "name", "text")
        unique = docs.dropDuplicates(["doc_id"])
    else:
        docs = docs.withColumn("doc_id", F.col("name"))
        unique = docs
    found = materialize(_groups(_anchors(unique.select("doc_id", "text"), window), window), "suffix-groups")
    firsts = found.where("h is not null")
    # Joins below have one row a key on the right, from a written table, so a hot anchor's side may be split.
    per = firsts.groupBy("h").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bytes"))
    per = materialize(per.where("n > 1"), "suffix-anchors")
    pieces = _texts(unique.select("doc_id", "text"), firsts.join(per.select("h"), "h"))
    marks = [found.where("h is null").select("doc_id", "start", "end")]
    hot = per.where(F.col("bytes") > hot_bytes).select("h")
    for gram in (*LONGER_GRAMS, None):
        if hot.limit(1).count() == 0:
            marks.append(_compare(pieces, window))
            break
        pieces = materialize(pieces, "suffix-pieces")
        marks.append(_compare(pieces.join(hot, "h", "left_anti"), window))
        pieces = pieces.join(hot.withColumn("hot", F.lit(True)), "h").drop("hot")
        if gram is None:
            marks.append(_compare_windows(pieces, window))
            break
        # Equal runs of the longer anchor: the first stands for all, the others are marked.
        cut = materialize(_split(pieces, gram, window), "suffix-cut")
        first = materialize(cut.groupBy("h", "piece").agg(F.min(F.struct("doc_id", "start")).alias("first")), "suffix-first")
        later = cut.join(first, ["h", "piece"]).where(F.struct("doc_id", "start") > F.col("first"))
        marks.append(later.select("doc_id", "start", (F.col("start") + F.length("piece")).alias("end")))
        pieces = first.select("h", "first.doc_id", "first.start", "piece")
        hot = materialize(pieces.groupBy("h").agg(F.sum(F.length("piece")).alias("bytes")).where(F.col("bytes") > hot_bytes).select("h"), "suffix-hot")
    told = marks[0]
    for more in marks[1:]:
        told = told.unionByName(materialize(more, "suffix-marks"))
    return _finish(docs, told)
