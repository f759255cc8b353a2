"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index: every vector goes to the nearest of some centres, its residual is turned by one
random rotation and only the signs are kept, packed, with two correction scalars (the
residual's length, and its inner product with its own code). Centres are fitted on a
bounded sample of about ``SAMPLE`` vectors; every vector is indexed.

Search: every query meets the codes of every cell. Its inner product with every residual is
estimated from the packed bits and the scalars, with an error bound. Vectors whose lower
bound of the distance exceeds the k-th smallest upper bound are set aside, the others are
reranked with exact distances in double precision. Nothing but these bounds leaves a vector
out.

Of equal vectors only the k + 1 with the smallest ids can be among k neighbours of
anything, so the others are not indexed, and equal queries are searched once. Cells are
gathered or cut into blocks of about ``BLOCK`` vectors and queries are dealt over parts of
about ``QUERIES``, so no task grows with a cell, however crowded, or with the queries.

Defined results: vectors that are null, zero or hold null or non-finite components take
no part, neither do those whose size is not the most frequent one (ties: the smaller);
of several rows of one query id the smallest vector is searched; a query is not its own
neighbour, other rows are, also equal ones; an id that several rows carry may appear once
per row; a query without any other vector has no rows; tables may be empty; extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citegraph.llm.common import materialize

SAMPLE = 20_000
BLOCK, QUERIES = 16_384, 16_384
#: Queries whose bounds are in memory at a time.
SLICE = 64
#: Vectors per cell aimed at, and the largest number of cells.
CELL, MAX_CELLS = 800, 4096
#: Half-width of the bounds in standard deviations of the estimate.
SIGMAS = 3.0
K_MEANS_ROUNDS = 8


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.col(embedding)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.forall("v", number) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    first = sizes.first()
    return rows.where(F.size("v") == (first.d if first else 0))


def matrix(column) -> np.ndarray:
    """A list column of equal sizes as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


def k_means(sample: np.ndarray, cells: int) -> np.ndarray:
    own = np.random.default_rng(11)
    centres = sample[own.choice(len(sample), cells, replace=False)].copy()
    for _ in range(K_MEANS_ROUNDS):
        nearest = squared(sample, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=cells)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(5).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, residual lengths and the residuals' inner products with their codes."""
    residual = x - centre
    length = np.sqrt((residual * residual).sum(1))
    turned = (residual / np.maximum(length, 1e-300)[:, None]) @ turn
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(1) / math.sqrt(x.shape[1])


def bounds(codes, length, own, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances, queries by vectors, from the codes."""
    d = queries.shape[1]
    residual = queries - centre
    far = np.sqrt((residual * residual).sum(1))
    turned = ((residual / np.maximum(far, 1e-300)[:, None]) @ turn).astype(np.float32)
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    own = np.maximum(own, 1e-6)
    estimate = (turned @ signs.T) / math.sqrt(d) / own
    width = SIGMAS * np.sqrt(np.maximum(1 - own * own, 0)) / own / math.sqrt(max(d - 1, 1)) + 1e-5
    base, scale = far[:, None] ** 2 + length**2, 2 * far[:, None] * length
    return base - scale * np.minimum(estimate + width, 1), base - scale * np.maximum(estimate - width, -1)


def blocks_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per cell its first block and the number of blocks it is dealt over, and the number of all blocks.

    Small cells share a block, large ones have several of their own.
    """
    first, dealt = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    block, held = 0, 0
    for cell, n in enumerate(counts.tolist()):
        if held and held + n > BLOCK:
            block, held = block + 1, 0
        first[cell] = block
        if n > BLOCK:
            dealt[cell] = math.ceil(n / BLOCK)
            block += int(dealt[cell])
        else:
            held += n
    return first, dealt, block + (held > 0)


def nearest(ids, x, cell, codes, length, own, queries, centres, turn, k: int):
    """Per query the positions and exact distances of its k nearest, by distance, then id.

    The vectors are in the order of ``cell``.
    """
    found, starts = np.unique(cell, return_index=True)
    ends = [*starts[1:], len(ids)]
    for start in range(0, len(queries), SLICE):
        some = queries[start : start + SLICE]
        parts = [bounds(codes[a:b], length[a:b], own[a:b], some, centres[c], turn) for c, a, b in zip(found, starts, ends, strict=True)]
        low, high = (np.concatenate(p, axis=1) for p in zip(*parts, strict=True))
        for i, q in enumerate(some):
            limit = np.partition(high[i], k - 1)[k - 1] if len(ids) > k else math.inf
            at = np.flatnonzero(low[i] <= limit)
            gap = x[at] - q
            exact = np.sqrt((gap * gap).sum(1))
            best = np.lexsort((ids[at], exact))[:k]
            yield at[best], exact[best]


def neighbours(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` (Euclidean distance) of the ``k`` nearest per query, nearest first.

    ``is_query`` is a condition over ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    alike = Window.partitionBy("v").orderBy("vec_id")
    index = materialize(rows.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k + 1).drop("_n"))
    asked = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = materialize(asked.withColumn("asked", F.min("query_id").over(Window.partitionBy("v"))))

    n = index.count()
    draw = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30))
    sample = matrix(index.where(draw < min(1.0, SAMPLE / max(n, 1)) * (1 << 30)).select("v").toArrow().column("v"))
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    cells = max(1, min(MAX_CELLS, len(sample) // 4, n // CELL))
    centres, turn = k_means(sample, cells), rotation(sample.shape[1])
    shared = spark.sparkContext.broadcast((centres, turn))

    def indexed(batches):
        centres, turn = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            cell = squared(x, centres).argmin(1)
            codes, length, own = encode(x, centres[cell], turn)
            columns = [*batch.columns, pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "code", "length", "own"])

    kind = dict(rows.dtypes)["v"]
    coded = index.select("vec_id", "v").mapInArrow(indexed, f"vec_id bigint, v {kind}, cell int, code binary, length double, own double")
    coded = materialize(coded)
    # at most ``MAX_CELLS`` rows
    counts = np.zeros(cells, np.int64)
    for row in coded.groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    first, dealt, blocks = blocks_of(counts)
    once = asked.where("query_id = asked").select("asked", "v")
    parts = max(1, math.ceil(once.count() / QUERIES))
    of_cell = lambda numbers: F.element_at(F.lit(numbers.tolist()), F.col("cell") + 1)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = coded.withColumn("block", of_cell(first) + F.pmod(F.xxhash64("vec_id", "v"), of_cell(dealt)))
    left = left.withColumn("part", every(parts))
    right = once.withColumn("part", F.pmod(F.xxhash64("asked"), F.lit(parts)).cast("bigint")).withColumn("block", every(blocks))

    def searched(key, own: pa.Table, queries: pa.Table) -> pa.Table:
        centres, turn = shared.value
        out_query, out_id, out_score = [], [], []
        if own.num_rows and queries.num_rows:
            own = own.sort_by("cell")
            ids, x = own.column("vec_id").to_numpy(), matrix(own.column("v"))
            codes = np.frombuffer(b"".join(own.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
            cell, length, inner = (own.column(c).to_numpy() for c in ("cell", "length", "own"))
            found = nearest(ids, x, cell, codes, length, inner, matrix(queries.column("v")), centres, turn, k + 1)
            for q, (at, exact) in zip(queries.column("asked").to_pylist(), found, strict=True):
                out_query += [q] * len(at)
                out_id += ids[at].tolist()
                out_score += exact.tolist()
        return pa.table({"asked": pa.array(out_query, pa.int64()), "vec_id": pa.array(out_id, pa.int64()), "score": pa.array(out_score, pa.float64())})

    keys = ("block", "part")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(searched, "asked bigint, vec_id bigint, score double")
    closest = Window.partitionBy("asked").orderBy("score", "vec_id")
    found = found.withColumn("_n", F.row_number().over(closest)).where(F.col("_n") <= k + 1).drop("_n")
    pairs = asked.select("query_id", "asked").join(found, "asked").where("query_id <> vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
