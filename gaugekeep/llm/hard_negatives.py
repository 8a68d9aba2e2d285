"""Hard-negative mining by Kronecker-packed products.

Components become integers x = floor(256 * c). Component j of several candidates
is put into the fields of one wide integer, biased so that no field is negative;
an anchor's biased component j multiplies that integer once, and the products are
summed over j. A field is as wide as the largest sum needs, so none spills into
the next; unpacked and freed of the biases it is the exact inner product. Fields
lie in words of 64 bits: two at 256 steps, 64 dimensions and components up to 1.

Every anchor meets every candidate in tiles of at most about TILE anchors by TILE
candidates, in two passes: the first scores candidates of the anchor's own label
and keeps the best positives, the second scores the others and keeps the best
negatives within each positive's band. A tile keeps only its best rows for each
anchor (and positive); windows merge the tiles' rows. The passes read stored
tables, of integer vectors and of the anchors' positives. As every anchor is scored against every row, work grows
with anchors times rows, as stated by the task; what is shuffled grows with rows
times (anchors / TILE).

Cases: rows whose id, label or vector is null, or whose vector holds null or
non-finite components, take no part, nor do vectors of another length than most
(of two lengths as frequent, the smaller counts) and empty ones; a row that is
repeated, or an id that stands for several rows, counts once, as the smallest
(label, vector); ties go to the smaller id; anchors without a positive and
positives without a negative in their band give no rows; an empty table gives no
rows. Components so large that a score might pass 2^62 are an error. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugekeep.llm.common import stored

SCALE = 256
TILE, LEAST_TILE, ANCHORS_AT_ONCE = 16_384, 1024, 16
LEAST = np.iinfo(np.int64).min


class Packed:
    """Candidates packed by component; `scores(a)` are the inner products with the rows of `a`."""

    def __init__(self, x: np.ndarray, limit: int):
        self.n, d = x.shape
        self.bias = limit
        self.width = (d * (2 * limit) ** 2).bit_length()
        self.fields = max(1, 64 // max(1, self.width))
        self.sums = x.sum(1)
        words = -(-self.n // self.fields)
        full = np.zeros((words * self.fields, d), np.uint64)
        full[:self.n] = x + limit
        full = full.reshape(words, self.fields, d)
        self.words = np.zeros((d, words), np.uint64)
        for f in range(self.fields):
            self.words |= (full[:, f] << np.uint64(f * self.width)).T

    def scores(self, a: np.ndarray) -> np.ndarray:
        biased = (a + self.bias).astype(np.uint64)
        # one product for each anchor, component and word: `fields` candidates at once
        wide, product = np.zeros((2, len(a), self.words.shape[1]), np.uint64)
        for j, word in enumerate(self.words):
            wide += np.multiply(biased[:, j, None], word, out=product)
        out = np.empty((len(a), self.words.shape[1], self.fields), np.int64)
        mask = np.uint64((1 << self.width) - 1)
        for f in range(self.fields):
            out[:, :, f] = (wide >> np.uint64(f * self.width)) & mask
        # (a + b)(x + b) = a x + b a + b x + b b, summed over the components
        freed = self.bias * a.sum(1)[:, None] + self.bias * self.sums[None, :] + a.shape[1] * self.bias ** 2
        return out.reshape(len(a), -1)[:, :self.n] - freed


def best(scores: np.ndarray, top: int):
    """(rows, columns) of the rows' largest scores but LEAST, one rank after the
    other, `top` in all; of equal scores the first column. Overwrites `scores`."""
    every = np.arange(len(scores))
    for _ in range(min(top, scores.shape[1])):
        at = scores.argmax(1)
        on = scores[every, at] > LEAST
        if not on.any():
            return
        yield every[on], at[on]
        scores[every, at] = LEAST


# ------------------------------------------------------------------ Spark side


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 1), np.int64)


def integer_rows(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, x array<int>): one row per id, of those that take part."""
    v = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[label_col].cast("long").alias("label"),
                    rows[vector_col].cast("array<double>").alias("v"))
    inf = F.lit(float("inf"))
    v = v.dropna(subset=["vec_id", "label", "v"]).filter(
        F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)) & (F.size("v") > 0))
    # beyond an int the limit below is passed anyway
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(2.0 ** 31 - 1)), F.lit(-2.0 ** 31))).cast("int"))
    one = v.select("vec_id", F.struct("label", x.alias("x")).alias("r")).groupBy("vec_id").agg(F.min("r").alias("r"))
    return one.select("vec_id", "r.label", "r.x")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, lowest: int = 50, highest: int = 95,
         relabel: Column | None = None, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor`: condition on vec_id; `relabel`: the label that counts, by vec_id
    and label; a negative's score is from `lowest` to `highest` hundredths of the
    positive's."""
    spark = rows.sparkSession
    ints = integer_rows(rows, id_col, label_col, vector_col)
    if relabel is not None:
        ints = ints.withColumn("label", relabel.cast("long"))
    ints = stored(ints, "negatives-rows")
    none = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                     "positive_score bigint, negative_score bigint")
    size = (ints.groupBy(F.size("x").alias("d"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"),
                 F.max(F.array_max("x")).alias("high"), F.min(F.array_min("x")).alias("low"))
            .orderBy(F.desc("n"), "d").limit(1).collect())
    if not size:
        return none
    d, limit = size[0].d, max(size[0].high, -size[0].low, 1)
    if d * limit ** 2 * max(100, highest) >= 1 << 62:
        raise ValueError(f"components of up to {limit} in {d} dimensions: scores would not fit a long")
    ints = ints.filter(F.size("x") == d)
    # tiles of at most about TILE rows, smaller ones where there are few rows, so that all cores have work
    chunks = max(-(-size[0].n // TILE), min(16, -(-size[0].n // LEAST_TILE)))
    sides = -(-max(1, size[0].anchors) // TILE)
    number = F.xxhash64("vec_id")
    tiles = ["chunk", "side"]
    candidates = ints.select(
        F.pmod(number, F.lit(chunks)).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(sides - 1))).alias("side"),
        "vec_id", "label", "x").groupBy(*tiles)
    anchors = ints.filter(is_anchor)

    def asked(df: DataFrame):
        return df.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                         F.pmod(number, F.lit(sides)).cast("int").alias("side"), *df.columns).groupBy(*tiles)

    def loaded(base, query):
        """Candidates by (label, id), anchors by label: what ties choose, the smaller id, comes first within a label."""
        ids, label = base.column("vec_id").to_numpy(), base.column("label").to_numpy()
        order = np.lexsort((ids, label))
        q_label = query.column("label").to_numpy()
        q_order = np.argsort(q_label, kind="stable")
        return (ids[order], label[order], _matrix(base.column("x"))[order].astype(np.int64), q_order,
                query.column("vec_id").to_numpy()[q_order], q_label[q_order], _matrix(query.column("x"))[q_order].astype(np.int64))

    def own(base, query):
        """The tile's best candidates of the anchors' own labels."""
        found = [(np.empty(0, np.int64),) * 3]
        if base.num_rows and query.num_rows:
            ids, label, x, _, q_ids, q_label, q = loaded(base, query)
            for value in np.unique(q_label):
                lo, hi = np.searchsorted(label, value), np.searchsorted(label, value, side="right")
                if lo == hi:
                    continue
                packed = Packed(x[lo:hi], limit)
                first, last = np.searchsorted(q_label, value), np.searchsorted(q_label, value, side="right")
                for i in range(first, last, ANCHORS_AT_ONCE):
                    j = min(i + ANCHORS_AT_ONCE, last)
                    s = packed.scores(q[i:j])
                    s[q_ids[i:j, None] == ids[None, lo:hi]] = LEAST
                    values = s.copy()
                    found += [(q_ids[i:j][r], ids[lo:hi][c], values[r, c]) for r, c in best(s, positives)]
        got = [np.concatenate(c) for c in zip(*found)]
        return pa.table(dict(zip(("vec_id", "positive_id", "positive_score"), map(pa.array, got), strict=True)))

    def others(base, query):
        """The tile's best candidates of other labels in each positive's band."""
        found = [(np.empty(0, np.int64),) * 5]
        if base.num_rows and query.num_rows:
            ids, label, x, q_order, q_ids, q_label, q = loaded(base, query)
            by_id = np.argsort(ids, kind="stable")
            ids, label = ids[by_id], label[by_id]
            packed = Packed(x[by_id], limit)
            lists = query.column("positives").take(pa.array(q_order)).combine_chunks()
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            p_ids, p_scores = (lists.flatten().field(k).to_numpy() for k in ("positive_id", "positive_score"))
            for i in range(0, len(q), ANCHORS_AT_ONCE):
                j = min(i + ANCHORS_AT_ONCE, len(q))
                s = packed.scores(q[i:j])
                s[q_label[i:j, None] == label[None, :]] = LEAST
                held = ends[i + 1:j + 1] - ends[i:j]
                for k in range(int(held.max(initial=0))):
                    on = np.nonzero(held > k)[0]
                    at = ends[i:j][on] + k
                    p = p_scores[at, None]
                    values = s[on]
                    sound = (values > LEAST) & (values * 100 >= p * lowest) & (values * 100 <= p * highest)
                    banded = np.where(sound, values, LEAST)
                    found += [(q_ids[i:j][on][r], p_ids[at][r], p_scores[at][r], ids[c], values[r, c]) for r, c in best(banded, negatives)]
        got = [np.concatenate(c) for c in zip(*found)]
        names = "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"
        return pa.table(dict(zip(names, map(pa.array, got), strict=True)))

    def first(df: DataFrame, keys: list[str], score: str, tie: str, top: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    near = asked(anchors).cogroup(candidates).applyInArrow(
        lambda q, c: own(c, q), "vec_id bigint, positive_id bigint, positive_score bigint")
    near = first(near, ["vec_id"], "positive_score", "positive_id", positives)
    # an anchor's positives are a list of at most `positives`
    lists = near.groupBy("vec_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    found = stored(anchors.join(lists, "vec_id"), "negatives-positives")
    hard = asked(found).cogroup(candidates).applyInArrow(
        lambda q, c: others(c, q),
        "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    return first(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(*none.columns)
