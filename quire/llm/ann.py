"""Approximate nearest neighbours with score-aware anisotropic product quantisation.

Vectors are cut into pairs of components, each pair coded by one of 16 centres (four bits). Centres
and codes minimise a loss that weighs the part of a residual parallel to its vector more than the
part across it, since only the parallel part changes the inner products that matter for the top of
a ranking. A query becomes a table of its inner products with all centres; scanning adds table
entries by code (two codes, a byte, at a time) to the scanned score, inner product minus half the squared
length. Over all rows together, those with one of the ``rerank`` best scores of a query go to exact reranking in
double precision; how rows are dealt out to tasks and batches has no part in that.

The centres are fitted on the driver to a sample of ``sample`` vectors at most, chosen by a hash of
the identifier; every vector is indexed. The queries are taken in blocks of ``query_block``, the only
data that is broadcast (some 2 MB at 64 components); each block scans the whole index once. A task returns
what its own ``rerank`` best scores have, with the exact distance, so the shuffle holds some ``rerank`` rows
for each query and task. Recall is measured in tests; ``rerank`` of the number of vectors or more is exact.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
without identifier or whose length isn't the commonest (of equals, the shorter). Equal distances go
to the smaller identifier; equal vectors have one score and count once, by their k + 1 smallest identifiers. A
repeated identifier counts once, with its least vector; an empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import materialize, no_worker_state

SAMPLE = 8_192
CENTRES = 16
PARALLEL_THRESHOLD = 0.2
ROUNDS = 8
RERANK = 512
QUERY_BLOCK = 4_096
QUERIES_AT_ONCE = 64
K = 10


@dataclass
class Codebook:
    centres: np.ndarray  # pairs x 16 x 2
    extra: float  # how much more a parallel residual weighs

    @property
    def dim(self) -> int:
        return self.centres.shape[0] * 2

    def encode(self, vectors: np.ndarray, rounds: int = 2) -> np.ndarray:
        """Codes (rows x pairs) by coordinate descent on the anisotropic loss."""
        parts, unit = _parts(vectors)
        codes = np.empty(parts.shape[:2], dtype=np.uint8)
        for m in range(parts.shape[1]):
            codes[:, m] = ((parts[:, m, None] - self.centres[m]) ** 2).sum(2).argmin(1)
        rows = np.arange(len(parts))
        along = np.empty(codes.shape)
        for m in range(parts.shape[1]):
            along[:, m] = ((parts[:, m] - self.centres[m][codes[:, m]]) * unit[:, m]).sum(1)
        total = along.sum(1)
        for _ in range(rounds):
            for m in range(parts.shape[1]):
                residual = parts[:, m, None] - self.centres[m]
                own = (residual * unit[:, m, None]).sum(2)
                rest = total - along[:, m]
                codes[:, m] = ((residual**2).sum(2) + self.extra * (rest[:, None] + own) ** 2).argmin(1)
                along[:, m] = own[rows, codes[:, m]]
                total = rest + along[:, m]
        return codes


def _padded(vectors: np.ndarray) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, vectors.shape[1] % 2)))


def _parts(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    vectors = _padded(np.asarray(vectors, dtype=np.float64))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors.reshape(len(vectors), -1, 2), unit.reshape(len(vectors), -1, 2)


def fit(sample: np.ndarray, rounds: int = ROUNDS, threshold: float = PARALLEL_THRESHOLD, seed: int = 7) -> Codebook:
    """Centres for the anisotropic loss; each centre solves its own weighted least squares."""
    parts, unit = _parts(sample)
    n, pairs = parts.shape[:2]
    extra = max(0.0, (2 * pairs - 1) * threshold**2 / (1 - threshold**2) - 1)
    rng = np.random.default_rng(seed)
    centres = np.stack([parts[rng.choice(n, CENTRES, replace=n < CENTRES), m] for m in range(pairs)])
    book = Codebook(centres, extra)
    for _ in range(rounds):
        codes = book.encode(sample, 1)
        rows = np.arange(n)
        residual = parts - book.centres[np.arange(pairs)[None], codes]
        along = (residual * unit).sum(2)
        total = along.sum(1)
        for m in range(pairs):
            u, rest = unit[:, m], total - along[:, m]
            # (I + extra u u') c = x + extra u (u.x + rest), summed over a centre's rows
            left = np.zeros((CENTRES, 2, 2))
            right = np.zeros((CENTRES, 2))
            np.add.at(left, codes[:, m], np.eye(2) + extra * u[:, :, None] * u[:, None, :])
            np.add.at(right, codes[:, m], parts[:, m] + extra * u * ((u * parts[:, m]).sum(1) + rest)[:, None])
            used = np.bincount(codes[:, m], minlength=CENTRES) > 0
            book.centres[m, used] = np.linalg.solve(left[used], right[used][:, :, None])[:, :, 0]
            along[:, m] = ((parts[:, m] - book.centres[m][codes[rows, m]]) * u).sum(1)
            total = rest + along[:, m]
    return book


def _usable(ids, column, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, identifiers, vectors) of those that take part."""
    import pyarrow as pa
    import pyarrow.compute as pc

    whole = pc.and_(pc.is_valid(ids), pc.fill_null(pc.equal(pc.list_value_length(column), dim), False))
    rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    kept, column = ids.take(pa.array(rows)).to_numpy(zero_copy_only=False), column.take(pa.array(rows))
    values = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    vectors = values.reshape(len(rows), dim)  # a null component has become NaN
    good = np.isfinite(vectors).all(1) & (vectors != 0).any(1)
    return rows[good], kept[good], vectors[good]


def search(vectors: DataFrame, is_query, k: int = K, rerank: int = RERANK, sample: int = SAMPLE, query_block: int = QUERY_BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest found for each row that
    the Column function ``is_query`` picks by its identifier, among all other rows."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).where("vec_id is not null and size(vector) > 0")
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], empty)
    dim, n = lengths["d"], lengths["count"]
    if rows.groupBy("vec_id").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    share = min(1 << 20, -(-(sample << 20) // n))
    picked = rows.where(F.size("vector") == dim).where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share).limit(2 * sample).toArrow()
    _, names, fitted = _usable(picked.column(0).combine_chunks(), picked.column(1).combine_chunks(), dim)
    if not len(fitted):
        return spark.createDataFrame([], empty)
    fitted = fitted[np.argsort(names, kind="stable")]  # reruns fit the same centres
    book = spark.sparkContext.broadcast(fit(fitted))  # 16 centres a pair

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            at, ids, found = _usable(batch.column(0), batch.column(1), dim)
            codes = book.value.encode(found) if len(found) else np.zeros((0, -(-dim // 2)), np.uint8)
            codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
            packed = codes[:, 0::2] | codes[:, 1::2] << 4
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), batch.column(1).take(pa.array(at)), pa.array([c.tobytes() for c in packed], pa.binary())], ["vec_id", "vector", "code"])

    kind = rows.schema["vector"].dataType.simpleString()
    index = materialize(rows.mapInArrow(encode, f"vec_id long, vector {kind}, code binary"), "ann-index")
    wanted = index.where(is_query(F.col("vec_id"))).select("vec_id", "vector")
    blocks = -(-wanted.count() // query_block)
    found = None
    for b in range(blocks):
        block = wanted.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        _, ids, queries = _usable(block.column(0).combine_chunks(), block.column(1).combine_chunks(), dim)
        shared = spark.sparkContext.broadcast((ids, queries))
        part = index.mapInArrow(_scanner(book, shared, dim, k, rerank), "query_id long, scanned float, vec_id long, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], empty)
    best = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.col("scanned").desc()))
    found = found.withColumn("best", best).where(F.col("best") <= rerank)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _tables(centres: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of queries with all pairs of neighbouring centres: queries x bytes x 256."""
    parts = _padded(queries).reshape(len(queries), -1, 2)
    one = np.einsum("qmd,mcd->qmc", parts, centres)
    one = np.pad(one, ((0, 0), (0, one.shape[1] % 2), (0, 0)))
    return (one[:, 1::2, :, None] + one[:, 0::2, None, :]).reshape(len(queries), -1, 256).astype(np.float32)


def _best(scanned: np.ndarray, exact: np.ndarray, ids: np.ndarray, rerank: int, k: int) -> np.ndarray:
    """Which rows of one query have one of the ``rerank`` best scanned scores, with at most k + 1 rows, those of
    the smallest identifiers, for equal vectors."""
    order = np.lexsort((ids, exact, -scanned))
    s, e = scanned[order], exact[order]
    new = np.r_[True, s[1:] != s[:-1]]
    alike = np.r_[True, (s[1:] == s[:-1]) & (e[1:] == e[:-1])]
    alike[0] = False
    start = np.maximum.accumulate(np.where(alike, 0, np.arange(len(s))))
    return order[(np.cumsum(new) <= rerank) & (np.arange(len(s)) - start <= k)]


def _scanner(book, shared, dim: int, k: int, rerank: int):
    def scan(batches):
        import pyarrow as pa

        no_worker_state()
        query_ids, queries = shared.value
        none = np.zeros(0, np.float32), np.zeros(0), np.zeros(0, np.int64)
        best: list = [none] * len(query_ids)
        for batch in batches:
            if not batch.num_rows:
                continue
            _, ids, vectors = _usable(batch.column(0), batch.column(1), dim)
            vectors = np.ascontiguousarray(vectors)
            codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
            # Equal vectors are scanned as one; the k + 1 smallest identifiers of each stand for it (one may be
            # the query's own).
            _, first, group = np.unique(vectors.view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
            members = np.lexsort((ids, group))
            counts = np.bincount(group)
            begins = np.cumsum(counts) - counts
            own, counts = ids[members], np.minimum(counts, k + 1)
            vectors, codes = vectors[first], codes[first]
            half = ((vectors**2).sum(1) / 2).astype(np.float32)
            n = len(vectors)
            for at in range(0, len(query_ids), QUERIES_AT_ONCE):
                tables = _tables(book.value.centres, queries[at : at + QUERIES_AT_ONCE])
                scores = np.tile(-half, (tables.shape[0], 1))
                for m in range(tables.shape[1]):
                    scores += tables[:, m].take(codes[:, m], axis=1)
                keep = min(rerank + 1, n)  # one may be the query itself
                least = np.partition(scores, n - keep, axis=1)[:, n - keep]
                for q in range(tables.shape[0]):
                    old = best[at + q]
                    near = np.flatnonzero(scores[q] >= least[q])
                    while len(near) < n and len(np.unique(scores[q][near])) <= rerank:  # ties: go on to different scores
                        near = np.flatnonzero(scores[q] >= np.partition(scores[q], n - min(n, 2 * len(near)))[n - min(n, 2 * len(near))])
                    if np.count_nonzero(np.diff(old[0])) + 1 >= rerank:  # as many held already; old[0] falls
                        near = near[scores[q][near] >= old[0][-1]]
                    distance = np.sqrt(((vectors[near] - queries[at + q]) ** 2).sum(1))
                    n_ids = counts[near]
                    slots = np.arange(n_ids.sum()) - np.repeat(np.cumsum(n_ids) - n_ids, n_ids) + np.repeat(begins[near], n_ids)
                    new = np.repeat(scores[q][near], n_ids), np.repeat(distance, n_ids), own[slots]
                    other = new[2] != query_ids[at + q]
                    all_ = [np.concatenate([a, b[other]]) for a, b in zip(old, new)]
                    if len(all_[0]):
                        kept = _best(*all_, rerank, k)
                        best[at + q] = tuple(x[kept] for x in all_)
        counts = [len(i) for _, _, i in best]
        for at in range(0, len(query_ids), QUERIES_AT_ONCE):
            some = slice(at, at + QUERIES_AT_ONCE)
            if sum(counts[some]):
                columns = [np.repeat(query_ids[some], counts[some]).astype(np.int64), *(np.concatenate(x) for x in zip(*((s, i, e) for s, e, i in best[some])))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "scanned", "vec_id", "score"])

    return scan
