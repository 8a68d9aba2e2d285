"""Approximate nearest neighbours by shifted space-filling curves.

Each curve projects the vectors on DIMS random orthogonal directions, brings
the coordinates to even scale (ranks of a bounded sample), shifts them and
takes their place on a Hilbert curve as the key. The keys of a curve are cut
into `blocks` ranges; a query meets the rows of its own range and of `halo`
neighbours on either side (the ends are joined), over all curves. Pairs are
scored in double precision on the original vectors; windows merge per query.

Ranges are dealt out in tiles of at most about TILE rows by TILE queries, so no
task holds a range. Of equal vectors the top + 1 smallest ids are indexed: no
other copy can be among the nearest. The sample (SAMPLE rows, the first by
hash) only fits scales and range limits; every row is indexed.

Cases: vectors that are null, zero, of another length than most, or hold null
or non-finite components take no part, as query or candidate; repeated rows are
one candidate; with few rows there is one range, so every candidate is met; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugekeep.llm.common import bounded_batches

DIMS, BITS = 4, 8
CURVES, BLOCKS, HALO = 5, 8, 1
SAMPLE, TILE = 20_000, 4096
LEAST_BLOCK = 64


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of non-negative integers
    (transposed form: undo the rotations bit by bit, Gray-code, interleave)."""
    x = x.astype(np.int64).copy()
    d, top = x.shape[1], 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(d):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    turn, q = np.zeros(len(x), np.int64), top
    while q > 1:
        turn ^= np.where((x[:, d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


class Curves:
    """Projections, scales and range limits, fitted on a sample."""

    def __init__(self, sample: np.ndarray, curves: int, blocks: int, seed: int):
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        dims = min(DIMS, d)
        self.of = [np.linalg.qr(rng.normal(size=(d, dims)))[0] for _ in range(curves)]
        self.shift = [rng.random(dims) * 0.25 for _ in range(curves)]
        self.scale = [np.sort(sample @ p, axis=0) for p in self.of]
        self.limits = []
        for c in range(curves):
            keys = np.sort(self.key(sample, c))
            self.limits.append(keys[[len(keys) * i // blocks for i in range(1, blocks)]])

    def key(self, x: np.ndarray, c: int) -> np.ndarray:
        y = x @ self.of[c]
        rank = np.column_stack([np.searchsorted(s, v) / len(s) for s, v in zip(self.scale[c].T, y.T, strict=True)])
        cell = (0.75 * rank + self.shift[c]) * (1 << BITS)
        return hilbert(np.minimum(cell.astype(np.int64), (1 << BITS) - 1), BITS)

    def block(self, x: np.ndarray, c: int) -> np.ndarray:
        return np.searchsorted(self.limits[c], self.key(x, c), side="right")


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.empty((0, 1))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the components."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def nearest(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """(query id, id, score) of each query's `top` nearest rows."""
    order = np.argsort(x_id, kind="stable")
    x, x_id = x[order], x_id[order]
    rough = q @ x.T
    rough[q_id[:, None] == x_id[None, :]] = -np.inf
    k = min(top, rough.shape[1])
    least = np.partition(rough, -k, axis=1)[:, -k]
    # near the limit the exact scores decide
    row, col = np.nonzero((rough >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & np.isfinite(rough))
    score = exact_scores(q[row], x[col])
    by = np.lexsort((x_id[col], -score, row))
    row, col, score = row[by], col[by], score[by]
    first = np.searchsorted(row, row, side="left")
    keep = np.arange(len(row)) - first < top
    return q_id[row[keep]], x_id[col[keep]], score[keep]


def neighbours(vectors: DataFrame, is_query, top: int = 20, curves: int = CURVES, blocks: int = BLOCKS, halo: int = HALO,
               seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the `top` nearest found of every row for
    which the condition `is_query` (on vec_id) holds."""
    spark = vectors.sparkSession
    bounded_batches(spark, 10_000)
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    inf = F.lit(float("inf"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0)
    rows = rows.filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(sound)
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    out = "query_id bigint, vec_id bigint, score double"
    if not size:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("v") == size[0].d).select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    total = size[0]["count"]
    blocks = max(1, min(blocks, total // LEAST_BLOCK))
    sample = _matrix(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow().column("v"))
    sent = spark.sparkContext.broadcast(Curves(sample, curves, blocks, seed))
    chunks = max(1, -(-total // (blocks * TILE)))
    copies = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.distinct().withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= top + 1).drop("copy")

    def placed(df: DataFrame) -> DataFrame:
        def run(batches):
            for b in batches:
                x = _matrix(b.column("v"))
                if not b.num_rows:
                    continue
                for c in range(curves):
                    yield pa.RecordBatch.from_arrays(
                        [b.column("vec_id"), b.column("v"), pa.array(np.full(b.num_rows, c, np.int32)),
                         pa.array(sent.value.block(x, c).astype(np.int32))], ["vec_id", "v", "curve", "block"])
        return df.mapInArrow(run, "vec_id bigint, v array<double>, curve int, block int")

    def piece(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    ahead = sorted({h % blocks for h in range(-halo, halo + 1)})
    asked = rows.filter(is_query).distinct()
    tiles = ["curve", "block", "chunk", "qchunk"]
    qchunks = max(1, -(-total * len(ahead) // (20 * blocks * TILE)))
    base = placed(kept).select("vec_id", "v", "curve", "block", piece(chunks).alias("chunk"),
                               F.explode(F.sequence(F.lit(0), F.lit(qchunks - 1))).alias("qchunk"), F.lit(False).alias("q"))
    query = (placed(asked).withColumn("h", F.explode(F.array(*map(F.lit, ahead))))
             .select("vec_id", "v", "curve", F.pmod(F.col("block") + F.col("h"), F.lit(blocks)).alias("block"),
                     F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), piece(qchunks).alias("qchunk"), F.lit(True).alias("q")))

    def tile(table):
        is_q = table.column("q").to_numpy(zero_copy_only=False)
        x, ids = _matrix(table.column("v")), table.column("vec_id").to_numpy()
        if is_q.all() or not is_q.any():
            got = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        else:
            got = nearest(x[is_q], ids[is_q], x[~is_q], ids[~is_q], top)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, got), strict=True)))

    found = base.unionByName(query).groupBy(*tiles).applyInArrow(tile, out).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
