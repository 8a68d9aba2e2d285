"""Toxicity by class-conditional Kneser-Ney word models.

Each class (toxic, ordinary) has discounted word counts from the labelled
documents; what the discount frees goes to one backoff shared by both classes,
whose counts are continuation counts (in how many labelled documents, the
contexts of these models, a word was seen):

    P_c(w) = max(n_c(w) - D, 0) / N_c + D T_c / N_c * (k(w) + A) / (K + A V)

with V = VOCABULARY, or the number of different words and one if that is more; so
a rare word, backed off in both, says little. A document's log-likelihood
ratio is normalised by length over the whole text, over its best window of
WINDOW words and over its best word; a logistic curve on these three, fitted
on labelled documents whose words were not counted, gives the score.

The counts cover the labelled documents of folds 1 to 3; fold 4 calibrates the
curve and is not counted, fold 0 is held out. Where fold 4 lacks one of the classes,
FIXED_CURVE stands in for the fitted curve. Counts are a stored table with one row
for each different word (its 64-bit hash), which grows with the labelled documents. Tasks hold its HEAD most frequent words; if there are more,
the words that a task doesn't find are joined to the table, and the documents they
stand in are finished after the join, with the ratios in those windows that could be
the best whatever the words' ratios are: the scores are those of the whole table at
every size. Labels, language, source
and id are inputs of no score.

Cases: a null or empty text has ratio 0; long texts are taken whole; repeated
rows score alike; documents with several labels take the largest; without
toxic or without ordinary documents in folds 1 to 3 every score is 0; an empty
table gives no rows; null ids belong to no fold and are scored; other columns of
any name are passed on or not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugekeep.llm.common import bounded_batches, stored, texts

HEAD = 1 << 20  # words that every task holds, 12 bytes each
DISCOUNT, PRIOR, VOCABULARY = 0.75, 5.0, 1 << 20
WINDOW = 5
FOLDS, CALIBRATION_FOLD = 5, 4  # fold 0 is held out
CALIBRATION_ROWS = 20_000  # different texts of each class
FIXED_CURVE = np.array([-4.0, 1.0, 1.0, 0.5])
WORD_CACHE = 80_000
COUNT_BLOCK = 250_000  # words counted in one go, some 100 bytes each; their sums meet in the task's aggregate


def words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return re.findall(r"[^\W\d_]+", text.lower())


def word_hash(word: str) -> int:
    h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


class _Cache(dict):
    """What `of` gives for a word; starts anew when full."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word: str):
        if len(self) >= WORD_CACHE:
            self.clear()
        x = self[word] = self.of(word)
        return x


@dataclass
class Head:
    """Log P_toxic / P_ordinary of the most frequent words."""

    hashes: np.ndarray  # ascending
    ratios: np.ndarray
    unseen: float  # of a word that the table lacks
    peak: float  # no word beside these has more
    whole: bool  # the table has no other words

    def ratio(self, word: str) -> float:
        """NaN where only the table can tell."""
        h = word_hash(word)
        at = int(np.searchsorted(self.hashes, h))
        if at < len(self.hashes) and self.hashes[at] == h:
            return float(self.ratios[at])
        return self.unseen if self.whole else np.nan


@dataclass
class Model:
    head: Head | None  # None: a class has no documents
    table: DataFrame | None = None  # h, r of all words, if the head isn't whole
    weights: np.ndarray | None = None  # of the logistic curve, bias first


def features(r: np.ndarray) -> tuple[float, float, float]:
    """Mean, best window's mean and best of the words' ratios."""
    if not len(r):
        return 0.0, 0.0, 0.0
    sums = np.cumsum(np.concatenate([[0.0], r]))
    w = min(WINDOW, len(r))
    return sums[-1] / len(r), (sums[w:] - sums[:-w]).max() / w, r.max()


def score(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -700, 700)))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic curve, bias first, by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), grad)
        w -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def fold(id_col: str):
    """crc32 of the id as text, modulo FOLDS."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def _counts(rows: DataFrame) -> DataFrame:
    """(h, toxic, ordinary, seen) of every word hash: its occurrences in the two
    classes' documents and the number of documents it stands in."""

    def run(batches):
        of = _Cache(word_hash)
        held, size = [], 0

        def out():
            h, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            n = np.array([len(x) for x, _ in held])
            toxic = np.repeat([y for _, y in held], n)
            doc = np.repeat(np.arange(len(held)), n)
            pairs = np.unique(doc * len(h) + at)
            sums = [np.bincount(x, minlength=len(h)) for x in (at[toxic], at[~toxic], pairs % len(h))]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (h, *sums)], ["h", "toxic", "ordinary", "seen"])

        for b in batches:
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                w = words(t)
                held.append((np.fromiter(map(of.__getitem__, w), np.int64, len(w)), y == 1))
                size += len(w)
                if size >= COUNT_BLOCK:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return (rows.select("text", "toxic").mapInArrow(run, "h bigint, toxic bigint, ordinary bigint, seen bigint")
            .groupBy("h").agg(*(F.sum(c).alias(c) for c in ("toxic", "ordinary", "seen"))))


def _word_ratios(counts: DataFrame) -> Model:
    """The model of these counts, without weights."""
    s = counts.agg(*(F.sum(c).alias(c) for c in ("toxic", "ordinary", "seen")), F.count_if(F.col("toxic") > 0).alias("tt"),
                   F.count_if(F.col("ordinary") > 0).alias("to"), F.count("*").alias("words")).collect()[0]
    if not s.toxic or not s.ordinary:
        return Model(None)
    shared = (F.col("seen") + PRIOR) / (s.seen + PRIOR * max(VOCABULARY, s.words + 1))

    def p(n: str, total: int, types: int) -> Column:
        return (F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) + DISCOUNT * types * shared) / total

    table = counts.select("h", (F.col("toxic") + F.col("ordinary")).alias("n"),
                          F.ln(p("toxic", s.toxic, s.tt) / p("ordinary", s.ordinary, s.to)).cast("float").alias("r"))
    whole = s.words <= HEAD
    top = (table if whole else table.orderBy(F.desc("n"), "h").limit(HEAD)).select("h", "n", "r").toArrow()
    h, r = top.column("h").to_numpy(), top.column("r").to_numpy()
    order = np.argsort(h)
    unseen = peak = float(np.float32(np.log(s.tt / s.toxic) - np.log(s.to / s.ordinary)))
    if not whole:
        least = int(top.column("n").to_numpy().min())
        peak = max(unseen, table.filter(F.col("n") <= least).agg(F.max("r")).collect()[0][0])
    return Model(Head(h[order], r[order], unseen, peak, whole), None if whole else table.select("h", "r"))


def _parts(r: np.ndarray, text_words: list[str], peak: float) -> tuple:
    """What a text with unknown ratios (NaN), none above `peak`, needs besides them:
    number of words, sum of the known ones, best known window and word, the ratios
    in windows that may be better (infinity between runs of them), which unknown
    word stands at each NaN there, and the unknown words' hashes."""
    lost = np.isnan(r)
    n, w = len(r), min(WINDOW, len(r))
    if not lost.any():
        return n, *features(r), [], [], []
    known = np.where(lost, 0.0, r)
    sums, holes = (np.cumsum(np.concatenate([[0], x])) for x in (known, lost))
    inside, gaps = sums[w:] - sums[:-w], holes[w:] - holes[:-w]
    best = inside[gaps == 0].max(initial=-np.inf) / w
    may = np.flatnonzero((gaps > 0) & ((inside + gaps * peak) / w > best - 1e-6))
    kept = np.zeros(n + 1, np.int64)
    np.add.at(kept, may, 1)
    np.add.at(kept, may + w, -1)
    keep = np.flatnonzero(np.cumsum(kept[:-1]) > 0)
    runs = np.insert(r[keep], np.flatnonzero(np.diff(keep) > 1) + 1, np.inf)
    at = np.flatnonzero(lost)
    return (n, known.sum(), best, np.max(r[~lost], initial=-np.inf), runs.astype(np.float32), holes[keep[lost[keep]]],
            [word_hash(text_words[i]) for i in at])


def _finished(n: int, total: float, best: float, top: float, runs: np.ndarray, spots: np.ndarray, found: np.ndarray) -> tuple[float, float, float]:
    """Features from `_parts` and the ratios of the unknown words, in order."""
    runs[np.isnan(runs)] = found[spots]
    w = min(WINDOW, n)
    for run in np.split(runs, np.flatnonzero(np.isinf(runs))):
        run = run[~np.isinf(run)]
        if len(run) >= w:
            sums = np.cumsum(np.concatenate([[0.0], run]))
            best = max(best, (sums[w:] - sums[:-w]).max() / w)
    return (total + found.sum()) / n, best, max(top, found.max())


_FEATURES = "a double, b double, c double"


def with_features(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` with the features a, b, c in place of `text`."""
    sent = rows.sparkSession.sparkContext.broadcast(model.head)
    others = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in others]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)

    def ratios(batch, of) -> Iterator[tuple[np.ndarray, list[str]]]:
        for t in batch.column("text").to_pylist():
            w = words(t or "")
            yield np.fromiter(map(of.__getitem__, w), np.float64, len(w)), w

    def whole(batches):
        of = _Cache(sent.value.ratio)
        for b in batches:
            x = np.array([features(r) for r, _ in ratios(b, of)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *(pa.array(x[:, i]) for i in range(3))], [*names, *"abc"])

    if model.head.whole:
        return rows.mapInArrow(whole, schema + _FEATURES)

    parts = ["n", "total", "best", "top", "runs", "spots", "lost"]
    types = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.float32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    parts_schema = "n bigint, total double, best double, top double, runs array<float>, spots array<int>, lost array<bigint>"

    def head_only(batches):
        head = sent.value
        of = _Cache(head.ratio)
        for b in batches:
            got = [_parts(r, w, head.peak) for r, w in ratios(b, of)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *(pa.array([g[i] for g in got], t) for i, t in enumerate(types))],
                                             [*names, *parts])

    def finish(batches):
        for b in batches:
            x = np.array([_finished(n, total, best, top, np.array(runs, float), np.array(spots, int), np.array(found, float))
                          for n, total, best, top, runs, spots, found in
                          zip(*(b.column(c).to_pylist() for c in [*parts[:-1], "found"]), strict=True)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *(pa.array(x[:, i]) for i in range(3))], [*names, *"abc"])

    # the row's number is fixed by being written
    first = stored(rows.mapInArrow(head_only, schema + parts_schema).withColumn("__row", F.monotonically_increasing_id()), "toxicity-head")
    passed = [F.col(f"`{c}`") for c in names]
    # of a text without unknown words total, best and top are the features
    known = first.filter(F.size("lost") == 0).select(*passed, F.col("total").alias("a"), F.col("best").alias("b"), F.col("top").alias("c"))
    lost = first.select(F.col("__row").alias("row"), F.posexplode("lost").alias("i", "lost_h"))
    # both sides grow: no broadcast hint, skewed words are split by AQE
    found = (lost.join(model.table.hint("merge"), F.col("lost_h") == F.col("h"), "left")
             .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("r", F.lit(model.head.unseen).cast("float")).alias("r")))).alias("f"))
             .select("row", F.col("f.r").alias("found")))
    rest = first.filter(F.size("lost") > 0).select("__row", *passed, *parts[:-1])
    both = rest.join(found, F.col("__row") == F.col("row")).select(*passed, *parts[:-1], "found")
    return known.unionAll(both.mapInArrow(finish, schema + _FEATURES))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of the labelled documents outside fold 0."""
    bounded_batches(docs.sparkSession)
    known = (labels.select(labels["doc_id"].alias("id"), labels["toxic"].alias("toxic")).filter("toxic IN (0, 1)")
             .groupBy("id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("fold", fold("id")).filter("fold <> 0"))
    src = texts(docs, id_col, text_col)
    # a merge join at every size: labels are not bounded, so they are never broadcast
    rows = stored(src.join(known.hint("merge"), src.doc_id == known.id).select("text", "toxic", "fold"), "toxicity-train")
    model = _word_ratios(stored(_counts(rows.filter(F.col("fold") != CALIBRATION_FOLD)), "toxicity-counts"))
    if model.head is None:
        return model
    # copies of a text count once; where a class has more texts than the bound, the bias makes up for those left
    # out. Texts become three numbers where they are read, so that only these are ranked.
    given = rows.filter(F.col("fold") == CALIBRATION_FOLD).select("toxic", F.xxhash64("text").alias("th"), "text")
    different = stored(with_features(given, model).distinct(), "toxicity-calibrate")
    there = {r.toxic: r["count"] for r in different.groupBy("toxic").count().collect()}
    found = {}
    for y in there:
        got = different.filter(F.col("toxic") == y).orderBy("th", *"abc").limit(CALIBRATION_ROWS).toArrow()
        found[y] = np.column_stack([got.column(c).to_numpy() for c in "abc"])
    if len(found) < 2:
        model.weights = FIXED_CURVE
        return model
    model.weights = logistic(np.concatenate([found[0], found[1]]), np.repeat([0.0, 1.0], [len(found[0]), len(found[1])]))
    model.weights[0] += np.log(there[1] / len(found[1])) - np.log(there[0] / len(found[0]))
    return model


def _score(model: Model) -> Column:
    w = [float(x) for x in model.weights]
    z = F.lit(w[0]) + w[1] * F.col("a") + w[2] * F.col("b") + w[3] * F.col("c")
    return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z))))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    bounded_batches(docs.sparkSession)
    src = texts(docs, id_col, text_col)
    if model.head is None:
        out = src.select("doc_id", F.lit(0.0).alias("score"))
    else:
        out = with_features(src, model).select("doc_id", _score(model).alias("score"))
    return out.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def ordinary(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` without the rows that the model calls toxic, columns unchanged."""
    bounded_batches(docs.sparkSession)
    if model.head is None:
        return docs
    if not model.head.whole:  # the toxic texts by their digest, since the rows were scored without their other columns
        key = F.sha2(docs[text_col], 256)
        bad = (with_features(docs.select(key.alias("bad_text"), docs[text_col].alias("text")), model)
               .filter(_score(model) >= 0.5).select("bad_text").distinct())
        return docs.join(bad.hint("merge"), key.eqNullSafe(bad.bad_text), "left_anti")
    sent = docs.sparkSession.sparkContext.broadcast((model.head, model.weights))

    def run(batches):
        head, weights = sent.value
        of = _Cache(head.ratio)
        for b in batches:
            x = np.array([features(np.array([of[w] for w in words(t or "")])) for t in b.column(text_col).to_pylist()]).reshape(-1, 3)
            yield b.filter(pa.array(score(x, weights) < 0.5))

    return docs.mapInArrow(run, docs.schema)
