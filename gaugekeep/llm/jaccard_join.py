"""Join of near-identical documents: Jaccard likeness of word shingles, exact.

Tiles. A document's shingles, hashed, are ordered by hash, very frequent ones
last. With |A| = a, a document B of likeness >= t shares one of the first
a - ceil(t a) + 1 shingles of A (the prefix). A tile is the set of different
texts that have one shingle in both prefixes, in bands of set size.

1. Links to leaders: in a tile every member is paired with the first member of
   its size band and of the band before, so a tile of n members gives at most
   2 n pairs. Pairs whose sizes or bitmaps rule a link out go; for the others
   the sorted shingle arrays are intersected. Components follow.
2. What is left: tiles whose members lie in more than one component. There all
   pairs across components are compared by set size and by the bit counts of
   the bitmaps, block by block. Rounds emit each member's most promising pair
   while that merges components; a last round emits every pair that the bounds
   cannot rule out and that is not known yet. So a group of n near copies takes
   about n pairs a round, not n^2.

Tiles with equal members count once.

Copies of one shingle set are one node, so no group of copies is expanded.
The bitmap has one bit per hash class, the parity of the shingles in it: each
shingle that only one side has flips at most one bit, so
|A symmetric difference B| >= popcount(A xor B), which bounds the overlap from
above by (a + b - popcount) / 2.

Cases: null, empty or white text has no shingles and no links and is its own
component; fewer words than a shingle are one shingle; texts of any length are
taken whole; repeated rows fall into one component; an empty table gives no
rows; columns beside id and text are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugekeep.llm.common import bounded_batches, connected_components, stored, texts

# Nodes a worker remembers as met; beyond it the set starts anew.
MET_NODES = 300_000
# Bytes hashed in one go, and the longest word of them; longer words are hashed one by one
# (a polynomial modulo 2^64 is weak for long words: Thue and Morse's, from 1,024 bytes).
SLAB, LONG_WORD = 1 << 18, 64
# Frequent shingles put last in the order (a bounded list; any order is exact):
# those that HOT_LEAST different texts of a block of COUNT_BLOCK shingles have.
HOT_SHINGLES, HOT_LEAST = 100_000, 3
COUNT_BLOCK = 2_000_000
# Bits of the filter that tells which documents may be needed again.
FILTER_BITS = 1 << 23
BITMAP_WORDS = 16
BLOCK = 2048
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


SPACES = b" \t\n\v\f\r"


def _byte_codes() -> np.ndarray:
    """A random odd number per byte, A-Z as a-z, white space 0."""
    code = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    code[ord("A"):ord("Z") + 1] = code[ord("a"):ord("z") + 1]
    code[list(SPACES)] = 0
    return code


_CODE = _byte_codes()
_POWER = np.cumprod(np.full(LONG_WORD, MIX[0], np.uint64))


def _long_hash(word: bytes) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh3_64_intdigest(word.lower()))


def _slab_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word: a polynomial of the byte codes, mixed."""
    x = _CODE[np.frombuffer(data, np.uint8)]
    inside = np.zeros(len(x) + 2, bool)
    inside[1:-1] = x != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.uint64), start
    place = np.arange(start[0], len(x))
    place -= np.repeat(start, np.diff(start, append=len(x)))
    np.minimum(place, LONG_WORD - 1, out=place)
    x = x[start[0]:]
    x *= _POWER[place]
    h = _mixed(np.add.reduceat(x, start - start[0]))
    for i in np.flatnonzero(end - start > LONG_WORD):
        h[i] = _long_hash(data[start[i]:end[i]])
    return h, start


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of `data`, in slabs that end at white space."""
    import re

    space = re.compile(b"[ \t-\r]")
    hashes, starts, at = [], [], 0
    while at < len(data):
        upto = min(at + SLAB, len(data))
        if upto < len(data):  # the word at the border stays whole
            found = space.search(data, upto)
            upto = found.start() if found else len(data)
        if upto - at > 2 * SLAB:  # a word longer than a slab: it goes alone
            begin = 1 + max(data.rfind(bytes([c]), at, at + SLAB) for c in SPACES)
            if begin > at:
                upto = begin
            else:
                hashes.append(np.array([_long_hash(data[at:upto])]))
                starts.append(np.array([at]))
                at = upto
                continue
        h, start = _slab_hashes(data[at:upto])
        hashes.append(h)
        starts.append(start + at)
        at = upto
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(batch: list[str], width: int = 5):
    """Sorted distinct hashes of each text's word shingles (A-Z lower-cased,
    words parted by the ASCII white space)."""
    at = 0
    while at < len(batch):
        upto, chars = at, 0
        while upto < len(batch) and (upto == at or chars + len(batch[upto]) <= SLAB):
            chars += len(batch[upto])
            upto += 1
        raw = [t.encode("utf-8", "surrogatepass") for t in batch[at:upto]]
        h, start = word_hashes(b" ".join(raw))
        limits = np.searchsorted(start, np.cumsum([0, *(len(r) + 1 for r in raw)])).tolist()
        full = _windows(h, width)
        for a, b in zip(limits, limits[1:], strict=False):
            if b - a >= width:
                s = np.sort(full[a:b - width + 1])
                fresh = np.ones(len(s), bool)
                np.not_equal(s[1:], s[:-1], out=fresh[1:])
                yield s[fresh]
            else:
                yield _windows(h[a:b], b - a) if b > a else np.empty(0, np.uint64)
        at = upto


def _windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k words in a row."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, k, np.uint64)
    for i in range(k):  # order matters: each place has its own odd factor
        out += h[i:i + n] * np.uint64((MIX[0] * (2 * i + 1) * (2 * i + 3)) & 0xFFFFFFFFFFFFFFFF | 1)
    return _mixed(out)


def shingles(text: str, width: int = 5) -> np.ndarray:
    """The shingle set of one text."""
    return next(shingle_sets([text], width))


def node_of(s: np.ndarray) -> int:
    """64-bit name of a shingle set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else 0


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity of the shingles per hash class, BITMAP_WORDS * 64 classes."""
    bits = np.bincount((s & np.uint64(BITMAP_WORDS * 64 - 1)).astype(np.int64), minlength=BITMAP_WORDS * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def _least_overlap(a, b, percent: int):
    """Shared shingles that a link needs: 100 o >= percent (a + b - o)."""
    return -((-percent * (a + b)) // (100 + percent))


def frequent(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that `x` (sorted in place) holds HOT_LEAST times or more, ascending, and how
    often; most stand once, so nothing is kept for those."""
    x.sort()
    again = np.flatnonzero(x[HOT_LEAST - 1:] == x[:max(0, len(x) - HOT_LEAST + 1)])
    u, c = np.unique(x[again], return_counts=True)
    return u, c + HOT_LEAST - 1


def hot_shingles(src: DataFrame, width: int) -> np.ndarray:
    """The most frequent shingles: each task reports those that many of its
    documents have, the largest sums are kept (HOT_SHINGLES at most)."""

    def run(batches):
        parts, held = {}, 0  # by node: copies count once

        def counted():
            u, c = frequent(np.concatenate(list(parts.values())))
            top = np.argsort(-c, kind="stable")[:HOT_SHINGLES // 4]
            return pa.RecordBatch.from_arrays(
                [pa.array(u[top].astype(np.int64)), pa.array(c[top].astype(np.int64))], ["token", "n"])

        for b in batches:
            for x in shingle_sets(b.column("text").to_pylist(), width):
                if parts.setdefault(node_of(x), x) is x:
                    held += len(x)
                if held >= COUNT_BLOCK:
                    yield counted()
                    parts, held = {}, 0
        if parts:
            yield counted()

    rows = (src.select("text").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "token").limit(HOT_SHINGLES).collect())
    return np.sort(np.array([r.token for r in rows], dtype=np.int64).astype(np.uint64))


def _prefixes(src: DataFrame, hot: np.ndarray, percent: int, width: int) -> DataFrame:
    """Per document: key, node, set size, bitmap and prefix. Of the copies that a
    task meets only the first has a prefix, so copies are not sent on."""
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        met: set[int] = set()
        for b in batches:
            node, size, prefix, bits = [], [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), width):
                n = len(s)
                need = -(-percent * n // 100)
                node.append(node_of(s))
                size.append(n)
                bits.append(bitmap(s).tobytes())
                if node[-1] in met:
                    s = s[:0]
                elif len(hot) and n:
                    late = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
                    s = np.concatenate([s[~late], s[late]])[:n - need + 1]
                else:
                    s = s[:n - need + 1]
                if len(met) >= MET_NODES:
                    met.clear()
                met.add(node[-1])
                prefix.append(s.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), b.column("key"), pa.array(node, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(bits, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))], ["doc_id", "th", "key", "node", "n", "bits", "prefix"])

    return src.mapInArrow(run, f"doc_id {id_type}, th bigint, key bigint, node bigint, n bigint, bits binary, prefix array<bigint>")


def _tile_rows(rows: DataFrame, percent: int) -> DataFrame:
    """Members of tiles with two or more members, each with up to two leaders.

    Rows come sorted by tile and size; a task streams them and keeps one row
    and the current leaders, whatever the size of a tile."""
    ratio = np.log(100 / percent) if percent < 100 else 1.0

    def run(batches):
        held = None  # the last row seen: it needs its successor to be judged
        before_token = None  # token of the row before the held one
        lead = (None, None, 0, 0, 0, 0)  # token, band, leader, its size, last band's leader, its size

        def out(token, node, n, nxt):
            nonlocal before_token, lead
            m = len(token)
            new_token = np.ones(m, bool)
            new_token[1:] = token[1:] != token[:-1]
            new_token[0] = before_token is None or token[0] != before_token
            alone = new_token & np.append(token[1:] != token[:-1], nxt is None or token[-1] != nxt)
            band = np.floor(np.log(n) / ratio).astype(np.int64)
            new_band = np.ones(m, bool)
            new_band[1:] = new_token[1:] | (band[1:] != band[:-1])
            new_band[0] = new_token[0] or lead[1] != band[0]
            l1, n1, l2, n2 = (np.zeros(m, np.int64) for _ in range(4))
            starts = np.flatnonzero(new_band)
            cur = lead
            for s, e in zip(np.append([0] if not len(starts) or starts[0] else [], starts).astype(int),
                            np.append(starts if len(starts) and starts[0] else starts[1:], m).astype(int), strict=True):
                if new_band[s]:
                    last = (cur[2], cur[3]) if not new_token[s] else (0, 0)
                    cur = (int(token[s]), int(band[s]), int(node[s]), int(n[s]), *last)
                l1[s:e], n1[s:e], l2[s:e], n2[s:e] = cur[2:]
            lead = cur
            before_token = int(token[-1])
            k = ~alone
            return pa.RecordBatch.from_arrays(
                [pa.array(x[k]) for x in (token, node, n, l1, n1, l2, n2)], ["token", "node", "n", "l1", "n1", "l2", "n2"])

        for b in batches:
            token, node, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("token", "node", "n"))
            if held is not None:
                token, node, n = (np.append(h, x) for h, x in zip(held, (token, node, n), strict=True))
            if not len(token):
                continue
            same = np.append((token[1:] == token[:-1]) & (node[1:] == node[:-1]), False)  # one row per member
            token, node, n = token[~same], node[~same], n[~same]
            held = token[-1:], node[-1:], n[-1:]
            if len(token) > 1:
                yield out(token[:-1], node[:-1], n[:-1], int(token[-1]))
        if held is not None:
            yield out(*held, None)

    spec = "token bigint, node bigint, n bigint, l1 bigint, n1 bigint, l2 bigint, n2 bigint"
    return rows.repartition(F.col("token")).sortWithinPartitions("token", "n", "node").mapInArrow(run, spec)


def _fits(a: str, b: str, percent: int):
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _bounded(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the bit counts do not rule out."""
    p = pairs.join(maps.toDF("a", "na", "ba"), "a").join(maps.toDF("b", "nb", "bb"), "b")

    def run(batches):
        for t in batches:
            if not t.num_rows:
                continue
            ba, bb = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint64).reshape(t.num_rows, -1) for c in ("ba", "bb"))
            na, nb = (t.column(c).to_numpy() for c in ("na", "nb"))
            apart = np.bitwise_count(ba ^ bb).sum(axis=1).astype(np.int64)
            keep = pa.array((na + nb - apart) // 2 >= _least_overlap(na, nb, percent))
            yield pa.RecordBatch.from_arrays([t.column("a").filter(keep), t.column("b").filter(keep)], ["a", "b"])

    return p.mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, src: DataFrame, nodes: DataFrame, percent: int, width: int) -> DataFrame:
    """The links among `pairs`: sorted arrays intersected. Texts travel packed
    and are cut into shingles where they meet: packed text is a fraction of
    the size of its shingle hashes, which do not compress."""
    of = nodes.select("node", "key")
    named = pairs.select("a", "b").join(of.toDF("a", "ka"), "a").join(of.toDF("b", "kb"), "b")
    packed = _packed(src, named.select(F.explode(F.array("ka", "kb")).alias("key")).distinct())
    p = named.join(packed.toDF("ka", "ta"), "ka").join(packed.toDF("kb", "tb"), "kb").select("a", "b", "ta", "tb")

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress

        @lru_cache(maxsize=32)
        def items(raw: bytes) -> np.ndarray:
            return shingles(unpack(raw).decode("utf-8", "surrogatepass"), width)

        for t in batches:
            a, b = t.column("a").to_numpy(), t.column("b").to_numpy()
            keep = np.zeros(t.num_rows, bool)
            for i, (x, y) in enumerate(zip(t.column("ta"), t.column("tb"), strict=True)):
                x, y = items(x.as_py()), items(y.as_py())
                o = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * o >= percent * (len(x) + len(y) - o)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return p.mapInArrow(run, "a bigint, b bigint")


def _packed(src: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, packed): the compressed texts of the documents with these keys (and
    of a few more), one row a key. A filter of FILTER_BITS bits, whatever the
    input's size, tells a scan which documents may be wanted; the joins that
    follow decide."""
    at = F.pmod("key", F.lit(FILTER_BITS))
    words = (keys.select(F.floor(at / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, CAST(pmod(key, {FILTER_BITS}) % 64 AS INT))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits"))).toArrow()
    filled = np.zeros(FILTER_BITS // 64, np.int64)
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    sent = src.sparkSession.sparkContext.broadcast(filled)

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            place = np.mod(b.column("key").to_numpy(), FILTER_BITS)
            maybe = pa.array((sent.value[place // 64] >> (place % 64)) & 1 == 1)
            found = [pack(t.encode("utf-8", "surrogatepass")) for t in b.column("text").filter(maybe).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key").filter(maybe), pa.array(found, pa.binary())], ["key", "packed"])

    return src.select("key", "text").mapInArrow(run, "key bigint, packed binary").groupBy("key").agg(F.any_value("packed").alias("packed"))


def _different(tiles: DataFrame) -> DataFrame:
    """Of tiles with the same members one."""
    sums = tiles.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                      F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    return tiles.join(sums.groupBy("m", "x", "y").agg(F.min("token").alias("token")).select("token", "m"), "token")


def _left_over(tiles: DataFrame, comps: DataFrame, maps: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Pairs across components, in tiles with more than one, that neither set
    sizes nor bitmaps rule out: all, or for each member the best of its tile. A tile larger than BLOCK is dealt out in
    pairs of blocks, so no task holds it whole."""
    t = tiles.filter("m > 2").select("token", "m", "node", "n").join(comps, "node", "left").select(
        "token", "m", "node", "n", F.coalesce("comp", "node").alias("comp"))
    mixed = t.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 <> c2").select("token")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    t = t.join(mixed, "token").join(maps.select("node", "bits"), "node").withColumn("blocks", blocks)
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # block i meets blocks j: cell (min, max) of the triangle
    t = (t.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
         .select("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "n", "comp", "bits"))

    def run(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        node, n, comp, mine = (table.column(c).to_numpy() for c in ("node", "n", "comp", "mine"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(node), -1)
        one, two = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        a, b = [], []
        for from_, to in ((one, two),) if i == j else ((one, two), (two, one)):
            for x in from_:
                y = to[(comp[to] != comp[x]) & (100 * n[to] >= percent * n[x]) & (100 * n[x] >= percent * n[to])]
                if not len(y):
                    continue
                most = (n[y] + n[x] - np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1).astype(np.int64)) // 2
                ok = most >= _least_overlap(n[y], n[x], percent)
                y, most = y[ok], most[ok]
                if best_only and len(y) > 1:
                    share = most / (n[y] + n[x])
                    y = y[[np.lexsort((node[y], -share))[0]]]
                a.append(np.full(len(y), node[x]))
                b.append(node[y])
        a, b = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (a, b))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return t.groupBy("token", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def _linked(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """Per document: doc_id, th (text hash), n and g, its group (null without words)."""
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    src = texts(docs, id_col, text_col).withColumns({"th": F.xxhash64("text"), "key": F.xxhash64("doc_id", "text")})
    hot = hot_shingles(src, width)
    own = stored(_prefixes(src, hot, percent, width), "jaccard-prefixes")
    rows = own.select(F.explode("prefix").alias("token"), "node", "n")
    tiles = stored(_different(stored(_tile_rows(rows, percent), "jaccard-tiles")), "jaccard-tiles")
    members = tiles.select("node").distinct()
    nodes = own.join(members, "node", "left_semi").groupBy("node").agg(
        F.min("n").alias("n"), F.min("key").alias("key"), F.first("bits").alias("bits"))
    nodes = stored(nodes, "jaccard-nodes")
    maps = nodes.select("node", "n", "bits")
    leaders = F.explode(F.array(F.struct(F.col("l1").alias("y"), F.col("n1").alias("m")),
                                F.struct(F.col("l2").alias("y"), F.col("n2").alias("m")))).alias("l")
    led = (tiles.select(F.col("node").alias("x"), "n", leaders).filter("l.y <> x AND l.m > 0").filter(_fits("n", "l.m", percent))
           .select(F.least("x", "l.y").alias("a"), F.greatest("x", "l.y").alias("b")).distinct())
    pairs = stored(_bounded(led, maps, percent), "jaccard-pairs")
    links = stored(_verified(pairs, src, nodes, percent, width), "jaccard-links")
    comps = connected_components(links)
    best_only = True
    while True:
        rest = stored(_left_over(tiles, comps, maps, percent, best_only).join(pairs, ["a", "b"], "left_anti"), "jaccard-pairs")
        more = stored(_verified(rest, src, nodes, percent, width), "jaccard-links")
        pairs = pairs.union(rest)
        found = not more.isEmpty()
        if found:
            links = links.union(more)
            comps = connected_components(links)
        if not best_only:
            break
        best_only = found
    own = own.select("doc_id", "th", "node", "n").join(comps, "node", "left")
    return own.withColumn("g", F.when(F.col("n") > 0, F.coalesce("comp", "node")))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: component_id is the
    smallest id reachable by links of likeness >= percent / 100."""
    own = _linked(docs, percent, width, id_col, text_col)
    least = own.filter("g IS NOT NULL").groupBy(F.col("g").alias("of")).agg(F.min("doc_id").alias("least"))
    return own.join(least, own.g == least.of, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each group: the smallest id (then the smallest
    text hash); of repeated rows one. Documents without words stay. Columns unchanged."""
    own = _linked(docs, percent, width, id_col, text_col)
    keep = (own.filter("g IS NOT NULL").groupBy("g").agg(F.min(F.struct("doc_id", "th")).alias("r"))
            .select(F.col("r.doc_id").alias("__id"), F.col("r.th").alias("__th"), F.lit(True).alias("__group")))
    empty = own.filter("g IS NULL").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.lit(False).alias("__group")).distinct()
    rows = docs.select(F.struct("*").alias("__row"), docs[id_col].alias("__doc"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("__hash"))
    kept = keep.union(empty)
    rows = rows.join(kept, rows["__doc"].eqNullSafe(kept["__id"]) & (rows["__hash"] == kept["__th"]))
    same = Window.partitionBy("__id", "__th").orderBy(F.xxhash64("__row"))
    rows = rows.withColumn("__nth", F.when(F.col("__group"), F.row_number().over(same)).otherwise(1)).filter("__nth = 1")
    return rows.select(*(F.col("__row")[c].alias(c) for c in docs.columns))
