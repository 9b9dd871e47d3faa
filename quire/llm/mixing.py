"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target share over its size gives each of its documents the same expected number of
copies: a whole part, which all get, and a fraction, which is the document's inclusion probability.
The flight phase of the cube method turns the fractions into 0 or 1: three documents at a time move
along the null space of their two balancing constraints (tokens and documents), which leaves both
totals as they are, until one of the three is decided. At most two documents remain, the landing.

For scale the flight runs in blocks of a source: each block leaves at most two undecided documents,
which go to the next level's blocks, until a source has one block and lands. Documents go by falling
size, so sizes next to each other are alike; landing takes the rounding, and then a few exchanges of two
documents, that come nearest to the source's tokens. Random numbers come from source, level and block, so reruns agree.

Cases: null text has size 0; a null source is a source of its own, ordered last; documents of size
0 take part in the document total; repeated rows are documents of their own; a very long text only counts, in one
pass; an empty table gives no row; other columns are ignored, or kept by ``repeat_rows``, whatever their
names (two leading underscores are its own).
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import SPACE_WORD, materialize

BLOCK = 2_000
MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
SEED = 20_240_229
BROADCAST_SOURCES = 100_000
TINY = 1e-9
EXCHANGES = 8


def flight(p: np.ndarray, sizes: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Move fractions ``p`` to 0 or 1, keeping sum(p) and sum(p * sizes); at most two stay
    fractional, and none if ``land``. Documents are taken in the order given."""
    out = [float(x) for x in p]
    size = [float(x) for x in sizes]
    open_ = [i for i, x in enumerate(out) if TINY < x < 1 - TINY]
    for i, x in enumerate(out):
        if x <= TINY or x >= 1 - TINY:
            out[i] = float(round(x))
    draws = iter(rng.random(len(open_) + 3).tolist())
    waiting = iter(open_)
    active: list[int] = []
    while True:
        while len(active) < 3 and (i := next(waiting, None)) is not None:
            active.append(i)
        if len(active) < 3:
            break
        a, b, c = active
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, x in zip(active, u):
            if x > 0:
                up, down = min(up, (1 - out[i]) / x), min(down, out[i] / x)
            elif x < 0:
                up, down = min(up, out[i] / -x), min(down, (1 - out[i]) / -x)
        step = up if next(draws) * (up + down) < down else -down
        rest = []
        for i, x in zip(active, u):
            out[i] += step * x
            if out[i] <= TINY or out[i] >= 1 - TINY:
                out[i] = float(round(out[i]))
            else:
                rest.append(i)
        active = rest
    if land and active:
        due = sum(out[i] * size[i] for i in active), sum(out[i] for i in active)
        ways = [[(w >> k) & 1 for k in range(len(active))] for w in range(1 << len(active))]
        best = min(ways, key=lambda w: (abs(sum(x * size[i] for x, i in zip(w, active)) - due[0]), abs(sum(w) - due[1]), w))
        for i, x in zip(active, best):
            out[i] = float(x)
    if land and open_:
        due = sum(p[i] * size[i] for i in open_)
        for _ in range(EXCHANGES):
            if not _exchange(out, size, open_, due):
                break
    return np.array(out)


def _exchange(out: list[float], size: list[float], units: list[int], due: float) -> bool:
    """A last step of landing: of all exchanges of a document that is in for one that is out the one,
    if any, that brings the token total nearest to ``due``; the document total stays."""
    error = sum(out[i] * size[i] for i in units) - due
    inside = np.array([i for i in units if out[i] == 1.0])
    outside = np.array(sorted((i for i in units if out[i] == 0.0), key=lambda i: size[i]))
    if not len(inside) or not len(outside):
        return False
    sizes, have = np.array([size[i] for i in outside]), np.array([size[i] for i in inside])
    at = np.searchsorted(sizes, have - error)
    best = (abs(error) - TINY, -1, -1)
    for other in (np.maximum(at - 1, 0), np.minimum(at, len(sizes) - 1)):
        left = np.abs(error - have + sizes[other])
        k = int(left.argmin())
        if left[k] < best[0]:
            best = (left[k], int(inside[k]), int(outside[other[k]]))
    if best[1] >= 0:
        out[best[1]], out[best[2]] = 0.0, 1.0
    return best[1] >= 0


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, n_docs, source_size, target) of (source, size): shares by weight of all sizes, no target
    above ``most`` times its source's size, the excess shared again by weight.

    Filling by weight is a level: sources are full in order of size / weight, and the level is what
    is left for the others over their weights. These windows go over one row for each source."""
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    per = per.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")))
    per = per.withColumn("full", F.col("source_size") * most)
    order = Window.orderBy(F.col("full") / F.col("weight"), "at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("left", F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("full").over(before), F.lit(0)))
    per = per.withColumn("level", F.col("left") / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("open", F.col("full") > F.col("level") * F.col("weight"))
    first = F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("full") / F.col("weight"))).over(Window.partitionBy())
    return per.select("source", "n_docs", "source_size", F.least(F.col("full").cast("double"), F.coalesce(first * F.col("weight"), F.col("full").cast("double"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, block: int = BLOCK, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for each row of ``docs``."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(SPACE_WORD)), F.lit(0)).cast("long")
    sizes = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), F.monotonically_increasing_id().alias("row"))
    return mix_sizes(materialize(sizes, "mix-sizes"), weights, most, block, seed).drop("row")


def mix_sizes(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The same from a written table (doc_id, source, size, row), where no two rows share a row number."""
    sources = materialize(targets(sizes, weights, most), "mix-sources")
    few = sources.count() <= BROADCAST_SOURCES
    table = sources.withColumnRenamed("source", "__source")
    rows = sizes.join(F.broadcast(table) if few else table, F.col("source").eqNullSafe(F.col("__source")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    whole = F.floor(rate + TINY)
    # A block's number comes from the document alone, so it doesn't depend on how rows are dealt out; only
    # documents without an identifier, which are alike, go by their row.
    key = F.coalesce("doc_id", "row")
    rows = rows.select(
        "doc_id", "source", "size", "row", "source_size", "target", whole.alias("whole"), F.greatest(rate - whole, F.lit(0.0)).alias("p"),
        F.pmod(F.xxhash64(key, "size", F.lit(seed)), F.ceil(F.col("n_docs") / block)).alias("block"), F.ceil(F.col("n_docs") / block).alias("blocks"),
    )
    schema = "doc_id long, source string, size long, row long, source_size long, target double, whole long, p double, block long, blocks long"

    def fly(level: int):
        def run(group):
            import pyarrow as pa

            source, number, blocks = group["source"][0].as_py(), group["block"][0].as_py(), group["blocks"][0].as_py()
            sizes_, ids = group["size"].to_numpy(), group["doc_id"].to_pylist()
            mixed = np.array([zlib.crc32(f"{seed}|{i}".encode()) for i in ids], dtype=np.int64)
            known = np.array([-1 if i is None else i for i in ids], dtype=np.int64)
            order = np.lexsort((known, mixed, -sizes_))
            rng = np.random.default_rng([seed, level, number, zlib.crc32(repr(source).encode())])
            p = group["p"].to_numpy().copy()
            p[order] = flight(p[order], sizes_[order], rng, land=blocks == 1)
            return group.set_column(group.schema.get_field_index("p"), "p", pa.array(p))

        return run

    done, level = None, 0
    while True:
        flown = materialize(rows.groupBy("source", "block").applyInArrow(fly(level), schema), "mix-flight")
        decided = flown.where("p = 0 or p = 1")
        done = decided if done is None else done.unionByName(decided)
        left = flown.where("p > 0 and p < 1")
        if left.limit(1).count() == 0:
            break
        # Two rows at most from each block.
        level += 1
        fewer = F.ceil(F.col("blocks") * 2 / block)
        rows = left.withColumn("block", F.pmod(F.xxhash64(key, "size", F.lit(seed + level)), fewer)).withColumn("blocks", fewer)
    copies = (F.col("whole") + F.col("p").cast("long")).cast("long")
    return done.select("doc_id", "source", "size", "row", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes it (not at all, or up to ``most`` times).

    Rows are numbered and written with their sizes; the copies come back to them by that number, so rows that
    share an identifier, or have none, are told apart. Both sides are shuffled by it, whatever their size.
    """
    names = docs.columns
    size = F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0)).cast("long")
    rows = materialize(docs.withColumns({"__size": size, "__row": F.monotonically_increasing_id()}), "mix-rows")
    sizes = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("__size").alias("size"), F.col("__row").alias("row"))
    taken = mix_sizes(sizes, weights, most).where("copies > 0").select(F.col("row").alias("__row"), F.col("copies").alias("__copies"))
    joined = rows.join(materialize(taken, "mix-taken").hint("merge"), "__row")
    return joined.select(*names, F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__copy")).select(names)
