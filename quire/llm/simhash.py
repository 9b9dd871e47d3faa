"""SimHash near-duplicates by a binary trie self-join.

Fingerprints: 64 bits over all shingles of the whole text; documents with one fingerprint are one
node from then on, so groups of exact copies cost nothing further.

Join: two fingerprints within k bits agree on at least one of k + 1 bands of bits, so each goes to
k + 1 shards, one for each band's value. In a shard the sorted fingerprints are a binary trie. The
join walks pairs of its nodes together from the root: equal branches keep the number of differing
bits, unequal ones add one, and a pair is pruned once the budget is exceeded. A shard with more than
``hot`` fingerprints is split again by bands of its other bits (any pair still meets, exactly).
A fingerprint has at most 1 + 64 + 64 * 63 / 2 others within two bits, so the pairs are linear in the
number of fingerprints; a task unites them as they come and gives one link for each fingerprint at most.

Components of the links then give each document the smallest identifier it can reach.

Cases: null and empty texts have fingerprint zero and link like any other; rows without identifier
link too, and a component without any identifier has a null id; repeated rows each get their row;
a very long text is one string and 8 bytes a word in its task; an empty table gives none; other columns are
ignored, or kept by ``keep_representatives``, whatever their names (two leading underscores are its own).
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import materialize, no_worker_state
from quire.llm.graph import components

SHINGLE = 3
SEED = 42
BUDGET = 2
HOT_SHARD = 1_000_000
BUFFER_ROWS = 500_000
FRONTIER = 2_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxh64_intdigest(flat, SEED)], dtype="<u8")
    else:
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        ends = starts[shingle:]
        hashes = np.fromiter([xxh64_intdigest(flat[a : b - 1], SEED) for a, b in zip(starts, ends)], dtype="<u8", count=len(ends))
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = np.unpackbits(hashes[i : i + (1 << 15)].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += part.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches):
        import pyarrow as pa

        no_worker_state()
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with __fp."""
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        no_worker_state()
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "__fp"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())]))


def unite(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i and j; a label is the least member's number."""
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels[:] = further


def trie_links(shards: np.ndarray, values: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """Labels of a forest over ``values`` (uint64, sorted within equal runs of ``shards``): two
    values of one shard within ``budget`` bits get one label (the least position)."""
    n = len(values)
    labels = np.arange(n)
    bounds = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1], True])
    low, high = bounds[:-1], bounds[1:]
    many = high - low > 1
    low, high = low[many], high[many]
    if not len(low):
        return labels
    stack = [(63, np.stack([low, high, low, high, np.zeros_like(low)]))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        level, front = stack.pop()
        if front.shape[1] > FRONTIER:
            half = front.shape[1] // 2
            stack += [(level, front[:, half:]), (level, front[:, :half])]
            continue
        single = (front[1] - front[0] == 1) & (front[3] - front[2] == 1)
        leaf = front[:, single]
        near = np.bitwise_count(values[leaf[0]] ^ values[leaf[2]]) <= budget
        unite(labels, leaf[0][near], leaf[2][near])
        front = front[:, ~single]
        if not front.shape[1]:
            continue
        if level < 0:  # equal values; each occurs once a shard, unless rows repeat
            for a, b in ((0, 2), (0, 1), (2, 3)):
                unite(labels, front[a], front[b] - (b in (1, 3)))
            continue
        if level not in ones:
            ones[level] = np.r_[0, np.cumsum(values >> np.uint64(level) & np.uint64(1), dtype=np.int64)]
        count = ones[level]
        a0, a1, b0, b1, d = front
        am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
        same = a0 == b0
        parts = [
            np.stack([a0, am, b0, bm, d]), np.stack([am, a1, bm, b1, d]),
            np.stack([a0, am, bm, b1, d + 1]), np.stack([am, a1, b0, bm, d + 1])[:, ~same],
        ]
        front = np.concatenate(parts, axis=1)
        own = (front[0] == front[2]) & (front[1] - front[0] == 1)  # a leaf and itself
        front = front[:, (front[0] < front[1]) & (front[2] < front[3]) & (front[4] <= budget) & ~own]
        stack.append((level - 1, front))
    return labels


def _bands(k: int, width: int, start: int = 0) -> list[tuple[int, int]]:
    """(shift, bits) of k + 1 bands of ``width`` bits from bit ``start`` on."""
    cuts = [start + width * i // (k + 1) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _part(shift: int, bits: int):
    return F.shiftrightunsigned("fp", shift).bitwiseAND((1 << bits) - 1)


def links(nodes: DataFrame, budget: int = BUDGET, hot: int = HOT_SHARD) -> DataFrame:
    """(a, b) of a forest that joins all fingerprints within ``budget`` bits, from distinct ``fp``."""
    bands = _bands(budget, 64)
    keyed = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(F.lit(i), _part(*b)).alias("shard")) for i, b in enumerate(bands)])).alias("k")).select("fp", "k.band", "k.shard")
    crowded = keyed.groupBy("shard").count().where(F.col("count") > hot).select("shard").collect()  # at most 3 rows for each ``hot`` fingerprints
    if crowded:
        mark = keyed.sparkSession.createDataFrame(crowded, "shard long").withColumn("crowded", F.lit(True))
        keyed = keyed.join(F.broadcast(mark), "shard", "left")
        again = []
        for i, (shift, bits) in enumerate(bands):
            rest = [(s, b) for j, (s, b) in enumerate(bands) if j != i]
            # Bands of the 64 - bits others: those below and above, each cut so that budget + 1 parts cover all.
            parts = [p for s, b in rest for p in _bands(budget, b, s)]
            groups = [parts[g :: budget + 1] for g in range(budget + 1)]
            again.append(F.array(*[F.xxhash64(F.col("shard"), F.lit(g), *[_part(*p) for p in ps]) for g, ps in enumerate(groups)]))
        shard = F.when(F.col("crowded"), F.element_at(F.array(*again), F.col("band") + 1)).otherwise(F.array("shard"))
        keyed = keyed.select("fp", F.explode(shard).alias("shard"))

    def run(batches):
        import pyarrow as pa

        shards, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def join(s, v):
            order = np.lexsort((v, s))
            s, v = s[order], v[order]
            labels = trie_links(s, v, budget)
            own = np.flatnonzero(labels != np.arange(len(v)))
            signed = v.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[own]), pa.array(signed[labels[own]])], ["a", "b"])

        for batch in batches:
            shards = np.concatenate([shards, batch.column(0).to_numpy(zero_copy_only=False)])
            values = np.concatenate([values, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(shards) >= BUFFER_ROWS:
                cut = int(np.searchsorted(shards, shards[-1]))  # the last shard may go on
                if cut:
                    yield join(shards[:cut], values[:cut])
                    shards, values = shards[cut:], values[cut:]
        if len(shards):
            yield join(shards, values)

    placed = keyed.select("shard", "fp").repartition("shard").sortWithinPartitions("shard")
    return placed.mapInArrow(run, "a long, b long")


def placed(nodes: DataFrame, budget: int = BUDGET, hot: int = HOT_SHARD) -> DataFrame:
    """(fp, first) for each fingerprint of ``nodes`` (fp, least): the smallest ``least`` of its component."""
    reached = components(links(nodes, budget, hot)).withColumnRenamed("node", "fp")
    linked = nodes.join(reached, "fp")
    least = linked.groupBy("component").agg(F.min("least").alias("first"))
    linked = linked.join(least, "component").select("fp", "first", F.lit(True).alias("linked"))
    found = nodes.join(linked, "fp", "left").select("fp", F.when(F.col("linked"), F.col("first")).otherwise(F.col("least")).alias("first"))
    return materialize(found, "simhash-classes")


def classes(docs: DataFrame, budget: int = BUDGET, shingle: int = SHINGLE, hot: int = HOT_SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of ``docs``."""
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = prints.join(placed(nodes, budget, hot), "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))


def keep_representatives(docs: DataFrame, budget: int = BUDGET, shingle: int = SHINGLE, hot: int = HOT_SHARD) -> DataFrame:
    """The rows of ``docs``, all columns: one of each component, that of the smallest doc_id (null last).

    Rows are numbered and written with their fingerprints, so the choice is of rows: of rows with one
    doc_id and near texts the first written stays, and rows with one doc_id and different texts are
    documents of their own. What goes is told by row number, a key that no two rows share.
    """
    names = docs.columns
    rows = materialize(with_fingerprints(docs, shingle).withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("doc_id"), F.col("__row").alias("row"))
    nodes = materialize(rows.groupBy(F.col("__fp").alias("fp")).agg(F.min(order).alias("least")), "simhash-nodes")
    stays = placed(nodes, budget, hot).select(F.col("first.row").alias("__row")).distinct()
    gone = materialize(rows.select("__row").join(stays, "__row", "left_anti"), "simhash-gone")
    return rows.join(gone, "__row", "left_anti").select(names)
