"""Benchmark decontamination with suffix arrays of the training text.

Each shard (some millions of words of one task) becomes a suffix array over word numbers:
positions sorted by the words that follow, to the depth of a window. Every suffix of a benchmark
item, cut at the window's length, is then looked up by binary search; the interval between its
bounds lists every place where it stands. Places that follow each other in item and document are
parts of one longest verbatim match; what is hit, and by which item, comes from these matches.

A suffix that can't match is left out of the array: words outside the benchmark's vocabulary get
number 0, and a suffix is kept only if its first words form word pairs that the benchmark has.

The benchmark goes to the executors in blocks of at most ``block_bytes`` of text, each a broadcast. The
documents are read once, without a shuffle; a shard is searched with one block after the other, and a
worker holds one block at a time.

Cases: null or wordless text of a document: no words, no hits, not contaminated; a wordless item
has no window; an item without item_id hits words but isn't listed; repeated rows each get their
row; repeated item_ids are one item; a very long text is a shard of its own, as its words' numbers are
held at once (4 bytes a word); empty tables give no rows, or no hits; other columns are ignored, or
kept by ``remove_contaminated``, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ALNUM_TABLE, no_worker_state

WINDOW = 13
BLOCK_BYTES = 2 << 20  # some hundred bytes of memory for each word
SHARD_WORDS = 2 << 20
PAIR_BITS = 22


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(ALNUM_TABLE).split()


class Benchmark:
    """Windows of a block of items, ready for the search."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.ids, sizes = [item_id for item_id, _ in items], []
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        for at, (_, text) in enumerate(items):
            ids = [number(w) for w in words_of(text)]
            n = min(window, len(ids))
            sizes.append(n)
            for i in range(len(ids) - n + 1 if n else 0):
                places.setdefault(tuple(ids[i : i + n]), []).append((at, i))
        windows = list(places)
        self.sizes = np.array(sizes, dtype=np.int64)
        # Places of window w: place_items and place_words from place_starts[w] to place_starts[w + 1].
        self.place_starts = np.cumsum([0, *map(len, places.values())])
        self.place_items, self.place_words = np.array([p for own in places.values() for p in own], dtype=np.int64).reshape(-1, 2).T
        self.lengths = np.array([len(w) for w in windows], dtype=np.int64)
        ids = np.zeros((len(windows), window + window % 2), dtype=np.uint64)
        for row, w in zip(ids, windows):
            row[: len(w)] = w
        top = ids.copy()
        for row, w in zip(top, windows):
            row[len(w) :] = 0xFFFFFFFF
        self.low, self.high = pack(ids), pack(top)
        self.single = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        self.short = np.zeros(1 << PAIR_BITS, dtype=bool)
        self.long = np.zeros(1 << PAIR_BITS, dtype=bool)
        for w in windows:
            if len(w) == 1:
                self.single[w[0]] = True
            elif len(w) < 5:
                self.short[pair(np.array(w[0]), np.array(w[1]))] = True
            else:
                a = np.array(w)
                self.long[pair(a[:-1], a[1:])] = True


def pair(a, b):
    return (a.astype(np.int64) * 0x9E3779B1 + b.astype(np.int64) * 0x85EBCA6B) >> 8 & (1 << PAIR_BITS) - 1


def pack(ids: np.ndarray) -> np.ndarray:
    """Two word numbers to one sort key."""
    return ids[:, 0::2].astype(np.uint64) << np.uint64(32) | ids[:, 1::2].astype(np.uint64)


def suffix_array(ids: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and the sort keys in that order."""
    n, width = len(ids), bench.low.shape[1] * 2
    padded = np.concatenate([ids, np.zeros(width + 1, dtype=ids.dtype)])
    code = pair(padded[:-1], padded[1:])
    run = bench.long[code]
    run = run[:-1] & run[1:]
    run[:-2] &= run[2:]
    keep = bench.single[ids] | bench.short[code[:n]] | run[:n]
    at = np.flatnonzero(keep & (ids != 0))
    keys = np.empty((len(at), width // 2), dtype=np.uint64)
    for k in range(width // 2):
        keys[:, k] = padded[at + 2 * k].astype(np.uint64) << np.uint64(32) | padded[at + 2 * k + 1].astype(np.uint64)
    order = np.lexsort(keys.T[::-1])
    return at[order], keys[order]


def bound(keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """For each wanted key the number of keys below it (``after``: or equal to it)."""
    low = np.zeros(len(wanted), dtype=np.int64)
    high = np.full(len(wanted), len(keys), dtype=np.int64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        less = np.full(len(wanted), after)
        there = keys[np.minimum(middle, len(keys) - 1)]
        for k in range(keys.shape[1] - 1, -1, -1):
            less = np.where(there[:, k] == wanted[:, k], less, there[:, k] < wanted[:, k])
        low = np.where(open_ & less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    return low


def search(ids: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """Every place of every window in a shard: (positions, window numbers)."""
    if not len(bench.lengths) or not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    positions, keys = suffix_array(ids, bench)
    if not len(positions):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = bound(keys, bench.low, False), bound(keys, bench.high, True)
    count = last - first
    which = np.repeat(np.arange(len(count)), count)
    slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return positions[slot], which


def maximal(at: np.ndarray, which: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Longest verbatim matches from the places of windows in a shard: (item number, item word, shard
    word, words). Windows that follow each other in both texts are parts of one match."""
    count = np.diff(bench.place_starts)[which]
    slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bench.place_starts[which], count)
    item, word, place = bench.place_items[slot], bench.place_words[slot], np.repeat(at, count)
    order = np.lexsort((place, place - word, item))
    item, word, place = item[order], word[order], place[order]
    if not len(item):
        return item, word, place, place
    goes_on = (item[1:] == item[:-1]) & (place[1:] == place[:-1] + 1) & (word[1:] == word[:-1] + 1)
    first = np.flatnonzero(np.r_[True, ~goes_on])
    windows = np.diff(np.r_[first, len(item)])
    return item[first], word[first], place[first], bench.sizes[item[first]] + windows - 1


def _shard_matches(texts: list[str | None], blocks) -> tuple[np.ndarray, list[tuple]]:
    """Of one shard: where each text's words start (and where the last one's end), and for each block its
    items' identifiers and its matches, places in words of the shard. One word lies between texts."""
    found, starts = [], None
    for block in blocks:
        get, zero = block.vocabulary.get, repeat(0)
        parts, gap = [], np.zeros(1, dtype=np.int32)
        for text in texts:
            words = words_of(text)
            parts += [np.fromiter(map(get, words, zero), dtype=np.int32, count=len(words)), gap]
        if starts is None:
            starts = np.cumsum([0, *(len(p) + 1 for p in parts[::2])])
        ids = np.concatenate(parts) if parts else gap
        found.append((block.ids, maximal(*search(ids, block), block)))
    return starts, found


def _shards(batch_texts: list[str | None], most: int = SHARD_WORDS * 6):
    """Slices of a batch's texts of some ``most`` characters each (a longer text is alone)."""
    at = size = 0
    for i, text in enumerate(batch_texts):
        n = len(text or "")
        if size and size + n > most:
            yield at, i
            at, size = i, 0
        size += n
    yield at, len(batch_texts)


def _hits(texts: list[str | None], blocks):
    """For each text: number of words, of words in a match, and the identifiers of matching items."""
    for a, z in _shards(texts):
        starts, found = _shard_matches(texts[a:z], blocks())
        change = np.zeros(starts[-1] + 1, dtype=np.int64)
        of: dict[int, set[str]] = {}
        for ids, (item, _, place, n) in found:
            np.add.at(change, place, 1)
            np.add.at(change, place + n, -1)
            doc = np.searchsorted(starts, place, side="right") - 1
            for d, i in set(zip(doc.tolist(), item.tolist())):
                if ids[i] is not None:
                    of.setdefault(d, set()).add(str(ids[i]))
        hit = np.r_[0, np.cumsum(np.cumsum(change) > 0)]
        for d in range(z - a):
            yield int(starts[d + 1] - starts[d] - 1), int(hit[starts[d + 1]] - hit[starts[d]]), of.get(d, set())


def _blocks(benchmark: DataFrame, window: int, block_bytes: int, item_col: str, text_col: str):
    """A function that gives, in a worker, the blocks one after the other; the driver holds one at a time too."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // block_bytes) or 1
    parts = [items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) for b in range(n)]
    shared = [spark.sparkContext.broadcast(Benchmark([tuple(r) for r in part.collect()], window)) for part in parts]

    def blocks():
        for b in shared:
            yield b.value
            if len(shared) > 1:
                del b._value  # read again from the worker's local copy when needed

    return blocks


def _batch(rows: list[tuple], schema: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    names = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(list(zip(*rows)) or [()] * len(names), names)], [n for n, _ in names])


HITS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
#: A document counts as contaminated in ``scan`` if a twentieth of its words or more are hit.
LEAST_SHARE = 20


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document."""
    blocks = _blocks(benchmark, window, block_bytes, item_col, "text")

    def run(batches):
        no_worker_state()
        for batch in batches:
            rows = []
            for doc_id, (n, n_hit, items) in zip(batch.column(0).to_pylist(), _hits(batch.column(1).to_pylist(), blocks)):
                rows.append((doc_id, n, n_hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), n_hit > 0 and LEAST_SHARE * n_hit >= n))
            yield _batch(rows, HITS)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, HITS)


MATCHES = "doc_id long, item_id string, item_word long, doc_word long, n_words long"


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The longest verbatim matches of a window or more and where they stand in item and document, in
    words from 0: doc_id, item_id, item_word, doc_word, n_words."""
    blocks = _blocks(benchmark, window, block_bytes, item_col, "text")

    def run(batches):
        no_worker_state()
        for batch in batches:
            doc_ids, texts, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for a, z in _shards(texts):
                starts, found = _shard_matches(texts[a:z], blocks())
                for ids, told in found:
                    for item, word, place, n in zip(*(c.tolist() for c in told)):
                        d = int(np.searchsorted(starts, place, side="right")) - 1
                        rows.append((doc_ids[a + d], None if ids[item] is None else str(ids[item]), word, place - int(starts[d]), n))
            yield _batch(rows, MATCHES)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, MATCHES)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = 0.0, block_bytes: int = BLOCK_BYTES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without those that a longest match touches: any match at all, or,
    with a ``least_share``, matches of that share of their words. Order within a file is kept."""
    at = docs.columns.index(text_col)
    blocks = _blocks(benchmark, window, block_bytes, "item_id", "text")

    def run(batches):
        import pyarrow as pa

        no_worker_state()
        for batch in batches:
            keep = [not (n_hit and n_hit >= least_share * n) for n, n_hit, _ in _hits(batch.column(at).to_pylist(), blocks)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
