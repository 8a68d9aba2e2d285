"""Removal of byte strings that repeat anywhere in the collection, exact.

A byte is removed if some `length`-byte string that covers it also starts at
another place of the collection. Strings never cross documents.

Suffixes are brought together by anchors: of the k-byte grams inside a window
of `length` bytes, the one with the least hash (the leftmost on ties) depends on
the window's bytes alone, so equal windows have equal anchors at equal places.
Each run of windows with one anchor is a segment (at most 2 * length - k bytes).

1. Segments that are equal throughout repeat as a whole. They are told by their
   anchor's 64-bit hash and 64 bits over all their bytes (polynomials modulo two
   primes: modulo a power of two, long texts with a pattern like Thue and Morse's
   would have equal ones); copies inside one batch are settled before
   the shuffle, so a passage that many documents share reaches the task of its
   anchor once per batch.
2. Segments that share an anchor but differ are fetched from the texts and lined
   up at the anchor. Going from the last column to the first, each round inserts
   one symbol per segment in front of its suffix and updates the sorted order of
   the collection's suffixes (its Burrows-Wheeler transform) with the common
   prefixes of neighbours: equal symbols keep their order, and the new common
   prefix is one more than the least of those passed over. After the round of a
   column, neighbours with a common prefix of `length` or more are repeats that
   start there. Only bytes decide here.

Whole documents are not inserted column by column: that takes one round per
byte of the longest document. A round here covers a batch of segments inside a
task, and the files that are read in sequence are the sorted shuffle files.

Cases: a null or empty text and texts shorter than `length` lose nothing; long
texts are taken whole; repeated rows lose everything they share; an empty table
gives no rows; columns beside id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.llm.common import bounded_batches, stored, texts

GRAM = 24
# Window starts hashed at a time; positions within fit the low bits of a key.
CHUNK, POS_BITS = 1 << 18, 20
# Bytes of texts joined before hashing; copies within are settled at once.
BUFFER = 8 << 20
# Segments sorted together, and the group size from which windows are counted.
BATCH_SEGMENTS, HOT_GROUP = 8192, 50_000
BASE = 0x9E3779B97F4A7C15
# (modulus, base) of the segments' hashes; a modulus below 2^32 keeps products within 64 bits.
PRIMES = ((4294967291, 2654435769), (4294967279, 3266489917))
ODD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
SPANS = "k1 bigint, k2 bigint, b bigint, e bigint"


def _powers(base: int, n: int, modulus: int = 1 << 64) -> np.ndarray:
    """1, base, base^2, ..."""
    out = np.ones(n, np.uint64)
    at = 1
    while at < n:  # twice as many each round
        more = out[:min(at, n - at)] * np.uint64(pow(base, at, modulus))
        out[at:at + len(more)] = more if modulus == 1 << 64 else more % np.uint64(modulus)
        at += len(more)
    return out


_POWERS: list = []


def _tables() -> list:
    """Powers and those of the inverse: of BASE, and of each of PRIMES."""
    if not _POWERS:
        n = CHUNK + 4096
        _POWERS.extend((_powers(b, n, m), _powers(pow(b, -1, m), n, m)) for m, b in ((1 << 64, BASE), *PRIMES))
    return _POWERS


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(ODD[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(ODD[1])
    return x ^ (x >> np.uint64(32))


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of x[i:i+w] for every i, by running minima from both sides of
    blocks of w."""
    n = len(x)
    pad = np.full(-n % w, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def segments(raw: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, segment hash, first window, number of windows, anchor's
    offset for each segment of a buffer; `valid` marks window starts that lie
    in one document."""
    (_, i1), *primes = _tables()
    out = []
    for c in range(0, max(0, len(raw) - length + 1), CHUNK):
        part = raw[c:c + CHUNK + length - 1].astype(np.uint64) + np.uint64(1)
        n = len(part)
        s1, *sums = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * p[:n], dtype=np.uint64)]) for p, _ in _tables())
        gram = _mixed((s1[GRAM:] - s1[:-GRAM]) * i1[:n - GRAM + 1])
        key = ((gram >> np.uint64(POS_BITS)) << np.uint64(POS_BITS)) | np.arange(len(gram), dtype=np.uint64)
        least = _window_min(key, length - GRAM + 1)
        ok = valid[c:c + len(least)]
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])
        start = np.flatnonzero(change)
        stop = np.append(start[1:], len(least))
        keep = ok[start]
        start, stop = start[keep], stop[keep]
        at = (least[start] & np.uint64((1 << POS_BITS) - 1)).astype(np.int64)
        end = stop + length - 1
        h1, h2 = ((t[end] - t[start]) % np.uint64(m) * inverse[start] % np.uint64(m)
                  for t, (_, inverse), (m, _) in zip(sums, primes, PRIMES, strict=True))
        size = (stop - start).astype(np.uint64)
        own = _mixed((h1 << np.uint64(32)) | h2) ^ _mixed(size * np.uint64(ODD[0]) + (at - start).astype(np.uint64))
        out.append((gram[at], own, start + c, stop - start, at - start))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _found(src: DataFrame, length: int) -> DataFrame:
    """Segments of all texts. Copies within a buffer: one goes on as `multi`,
    the others are `done`."""

    def run(batches):
        held, size = [], 0

        def out():
            raw = np.frombuffer(b"".join([t for _, _, t in held]), np.uint8)
            ends = np.cumsum([len(t) for _, _, t in held])
            valid = np.zeros(len(raw), bool)
            for e, (_, _, t) in zip(ends.tolist(), held, strict=True):
                if len(t) >= length:
                    valid[e - len(t):e - length + 1] = True
            h, g, s, runs, off = segments(raw, valid, length)
            doc = np.searchsorted(ends, s, side="right")
            k1, k2 = (np.array([x[i] for x in held], np.int64)[doc] for i in (0, 1))
            s = s - np.concatenate([[0], ends[:-1]])[doc]
            order = np.lexsort((g, h))
            same = np.zeros(len(h), bool)
            same[1:] = (h[order][1:] == h[order][:-1]) & (g[order][1:] == g[order][:-1])
            done, multi = np.zeros(len(h), bool), np.zeros(len(h), bool)
            done[order] = same
            first = ~same & np.append(same[1:], False)
            multi[order] = first
            h = h.astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (done, np.where(done, k1, h), h, g.astype(np.int64), k1, k2, s, runs, off, multi | done)],
                ["done", "route", "h", "g", "k1", "k2", "s", "runs", "off", "multi"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "text")), strict=True):
                held.append((row[0], row[1], row[2].encode("utf-8", "surrogatepass")))
                size += len(held[-1][2])
                if size >= BUFFER:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return src.select("k1", "k2", "text").mapInArrow(
        run, "done boolean, route bigint, h bigint, g bigint, k1 bigint, k2 bigint, s bigint, runs bigint, off bigint, multi boolean")


def _grouped(found: DataFrame) -> DataFrame:
    """Segments that share their anchor with another one. `multi`: an equal
    segment exists; `lead`: first of its equals in a group that has others.

    Rows come sorted by anchor and segment hash and are streamed: a run is
    judged by its neighbours, so groups may have any size."""

    def run(batches):
        state = {"h": None, "g": None, "mixed": False}
        cols = ["done", "h", "g", "k1", "k2", "s", "runs", "off", "multi"]
        held = None

        def out(x, nxt):
            h, g, multi = x["h"], x["g"], x["multi"].copy()
            free = ~x["done"]
            hp = np.append([state["h"] is not None and h[0] == state["h"]], h[1:] == h[:-1])
            gp = hp & np.append([state["g"] is not None and g[0] == state["g"]], g[1:] == g[:-1])
            hn = np.append(h[1:] == h[:-1], nxt is not None and nxt[0] == h[-1])
            gn = hn & np.append(g[1:] == g[:-1], nxt is not None and nxt[1] == g[-1])
            multi |= free & (gp | gn)
            # the last row of each class leads it, if another class of the group comes
            # after it (its successor) or came before it (a change inside the group)
            group = np.cumsum(~hp)
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[0] = state["mixed"]
            np.logical_or.at(mixed, group[hp & ~gp], True)
            lead = free & ~gn & (hn | mixed[group])
            state.update(h=int(h[-1]), g=int(g[-1]), mixed=bool(mixed[group[-1]]))
            keep = multi | lead | x["done"]
            return pa.RecordBatch.from_arrays(
                [pa.array(v[keep]) for v in (x["h"], x["k1"], x["k2"], x["s"], x["runs"], x["off"], multi | x["done"], lead)],
                ["h", "k1", "k2", "s", "runs", "off", "multi", "lead"])

        for b in batches:
            x = {c: b.column(c).to_numpy(zero_copy_only=False) for c in cols}
            if held is not None:
                x = {c: np.append(held[c], x[c]) for c in cols}
            if not len(x["h"]):
                continue
            held = {c: v[-1:] for c, v in x.items()}
            if len(x["h"]) > 1:
                yield out({c: v[:-1] for c, v in x.items()}, (int(x["h"][-1]), int(x["g"][-1])) if not x["done"][-1] else None)
        if held is not None:
            yield out(held, None)

    return (found.repartition(F.col("route")).sortWithinPartitions(F.col("done").desc(), "h", "g")
            .mapInArrow(run, "h bigint, k1 bigint, k2 bigint, s bigint, runs bigint, off bigint, multi boolean, lead boolean"))


def repeats(rows: list[bytes], off: np.ndarray, runs: np.ndarray, length: int) -> np.ndarray:
    """For segments lined up at their anchors, whether the window that starts in
    a column also starts in that column of another segment.

    Column by column from the last: one symbol per segment is put before its
    suffix, `order` is the sorted order of the suffixes, common[i] the common
    prefix of order[i-1] and order[i]."""
    n, lead = len(rows), int(off.max())
    begin = lead - off
    width = int((begin + runs).max()) + length - 1
    grid = np.zeros((n, width), np.uint16)
    for i, r in enumerate(rows):
        grid[i, begin[i]:begin[i] + len(r)] = np.frombuffer(r, np.uint8).astype(np.uint16) + 1
    marked = np.zeros((n, width - length + 1), bool)
    order, common = np.arange(n), np.zeros(n, np.int64)
    for c in range(width - 1, -1, -1):
        symbol = grid[order, c]
        by = np.argsort(symbol, kind="stable")
        # least common prefix passed over between two rows that become neighbours
        lo, hi = by[:-1] + 1, by[1:]
        alike = (symbol[by[1:]] == symbol[by[:-1]]) & (symbol[by[1:]] > 0)
        new = np.zeros(n, np.int64)
        if alike.any():
            table, level = [common], 1
            span = np.where(alike, hi - lo + 1, 1)
            while 2 * level <= span.max():
                last = table[-1]
                table.append(np.minimum(last[:-level], last[level:]))
                level *= 2
            power = np.log2(span).astype(np.int64)
            at = np.flatnonzero(alike)
            for p in np.unique(power[at]):
                k = at[power[at] == p]
                new[k + 1] = 1 + np.minimum(table[p][lo[k]], table[p][hi[k] - (1 << p) + 1])
        order, common = order[by], new
        if c < marked.shape[1]:
            far = common >= length
            both = far | np.append(far[1:], False)
            marked[order[both], c] = True
    return marked


def _spans_of(batch: list, length: int) -> tuple[list, ...]:
    """(k1, k2, b, e) of the repeated windows of a batch of segments."""
    off, runs = (np.array([x[i] for x in batch], np.int64) for i in (4, 5))
    marked = repeats([x[6] for x in batch], off, runs, length)
    edge = np.diff(np.pad(marked.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    begin = off.max() - off
    s = np.array([x[3] for x in batch], np.int64)
    k1, k2 = (np.array([x[i] for x in batch], np.int64) for i in (1, 2))
    return k1[row], k2[row], s[row] + first - begin[row], s[row] + stop - 1 - begin[row] + length


def _sliced(src: DataFrame, leads: DataFrame, length: int) -> DataFrame:
    """The bytes of segments."""
    wanted = leads.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "s", "off", "runs")).alias("want"))
    joined = src.join(wanted, ["k1", "k2"])

    def run(batches):
        for b in batches:
            out = []
            for k1, k2, text, want in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "text", "want")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                out += [(w["h"], k1, k2, w["s"], w["off"], w["runs"], raw[w["s"]:w["s"] + w["runs"] + length - 1]) for w in want]
            cols = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols[:6]] + [pa.array(list(cols[6]), pa.binary())],
                                             ["h", "k1", "k2", "s", "off", "runs", "seg"])

    return joined.mapInArrow(run, "h bigint, k1 bigint, k2 bigint, s bigint, off bigint, runs bigint, seg binary")


def _by_columns(segs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        held, names = [], ["k1", "k2", "b", "e"]

        def out():
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _spans_of(held, length)], names)

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("h", "k1", "k2", "s", "off", "runs", "seg")), strict=True):
                if len(held) >= BATCH_SEGMENTS and row[0] != held[-1][0]:
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    return segs.repartition(F.col("h")).sortWithinPartitions("h").mapInArrow(run, SPANS)


def _by_windows(segs: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different segments: the windows
    themselves are counted, so that no task gets a whole group."""

    def run(batches):
        for b in batches:
            out = [(int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), k1, k2, s + i)
                   for k1, k2, s, runs, seg in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "s", "runs", "seg")), strict=True)
                   for i in range(runs) for d in [hashlib.blake2b(seg[i:i + length], digest_size=16).digest()]]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], ["w1", "w2", "k1", "k2", "b"])

    windows = segs.mapInArrow(run, "w1 bigint, w2 bigint, k1 bigint, k2 bigint, b bigint")
    many = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    return windows.join(many, ["w1", "w2"]).select("k1", "k2", "b", (F.col("b") + length).alias("e"))


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return out


def repeated_spans(src: DataFrame, length: int) -> DataFrame:
    """(k1, k2, b, e): byte ranges covered by repeated strings, not merged."""
    flagged = stored(_grouped(_found(src, length)), "repeat-segments")
    whole = flagged.filter("multi").select("k1", "k2", F.col("s").alias("b"), (F.col("s") + F.col("runs") + length - 1).alias("e"))
    leads = flagged.filter("lead")
    hot = leads.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > HOT_GROUP).select("h")
    spans = whole.union(_by_columns(_sliced(src, leads.join(hot, "h", "left_anti"), length), length))
    if not hot.isEmpty():
        spans = spans.union(_by_windows(_sliced(src, leads.join(hot, "h"), length), length))
    return spans


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64("text", "doc_id", F.lit(1))})


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with_text
    adds kept_text (what is left, bytes of cut characters dropped) and spans."""
    if not GRAM <= length <= 4096:
        raise ValueError(f"length must be from {GRAM} to 4096")
    bounded_batches(docs.sparkSession)
    src = _keyed(texts(docs, id_col, text_col))
    spans = repeated_spans(src, length).groupBy("k1", "k2").agg(F.collect_set(F.struct("b", "e")).alias("spans"))
    joined = src.join(spans, ["k1", "k2"], "left")
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += ", kept_text string, spans array<struct<b:bigint,e:bigint>>" if with_text else ""

    def run(batches):
        for batch in batches:
            n, removed, count, sha, kept_texts, all_spans = [], [], [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                cuts = _merged((x["b"], x["e"]) for x in found or ())
                kept, at = [], 0
                for b, e in cuts:
                    kept.append(raw[at:b])
                    at = e
                rest = b"".join([*kept, raw[at:]])
                n.append(len(raw))
                removed.append(len(raw) - len(rest))
                count.append(len(cuts))
                sha.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept_texts.append(rest.decode("utf-8", "ignore"))
                    all_spans.append([{"b": b, "e": e} for b, e in cuts])
            cols = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, removed, count)), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols += [pa.array(kept_texts, pa.string()),
                         pa.array(all_spans, pa.list_(pa.struct([("b", pa.int64()), ("e", pa.int64())])))]
                names += ["kept_text", "spans"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)


def without_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with repeated strings cut out of the text (the bytes of a character
    that is cut through go too); columns unchanged, a null text stays null."""
    bounded_batches(docs.sparkSession)
    spans = repeated_spans(_keyed(texts(docs, id_col, text_col)), length)
    spans = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("b", "e")).alias("spans")).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("spans").alias("__spans"))
    rows = _keyed(docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), F.struct("*").alias("row")))
    joined = rows.join(spans, (F.col("k1") == F.col("__k1")) & (F.col("k2") == F.col("__k2")), "left")
    joined = joined.select(*(F.col("row")[c].alias(c) for c in docs.columns), "__spans")

    def run(batches):
        for batch in batches:
            out = []
            for text, found in zip(batch.column(text_col).to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                if found:
                    raw, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
                    for b, e in _merged((x["b"], x["e"]) for x in found):
                        kept.append(raw[at:b])
                        at = e
                    text = b"".join([*kept, raw[at:]]).decode("utf-8", "ignore")
                out.append(text)
            cols = [pa.array(out, pa.string()) if c == text_col else batch.column(c) for c in docs_columns]
            yield pa.RecordBatch.from_arrays(cols, docs_columns)

    docs_columns = list(docs.columns)
    return joined.mapInArrow(run, docs.schema)
