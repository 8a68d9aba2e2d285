"""Operators against plain versions on small tables and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugekeep.llm import ann, bpe, jaccard_join, packing, pii, sharding, simhash, suffix_dedup, toxicity, url_filter
from gaugekeep.llm.registry import BPE_FILE, PACK_FILE, RULES, SHARDS, pre_tokens, tokenizer


def pairs(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["docs", "odd_docs", "no_docs"])
def table(request):
    return request.getfixturevalue(request.param)


def key(rows):
    return sorted(rows, key=repr)


# ---------------------------------------------------------------- packing


def test_packing(table):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer(PACK_FILE))
    got = packing.pack(table, tokenizer(PACK_FILE), with_ids=True).collect()
    want = {}
    for i, t in pairs(table):
        want.setdefault(i, []).append(tok.encode(t, add_special_tokens=False).ids + [2])
    windows, docs = {}, {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append((r.start, list(r.ids), r.doc_tokens))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 4096
    assert set(docs) == set(want)
    for i, pieces in docs.items():
        if len(want[i]) == 1:
            assert [x for _, ids, _ in sorted(pieces) for x in ids] == want[i][0]
            assert {n for *_, n in pieces} == {len(want[i][0])}
        assert sum(len(ids) for _, ids, _ in pieces) == sum(map(len, want[i]))


def test_packing_is_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        window = int(rng.integers(3, 20))
        pos = [0, *np.cumsum(rng.integers(1, window + 1, 25)).tolist()]
        penalty = rng.integers(0, 5, len(pos)).tolist()

        def cost(i, j):
            n = pos[j] - pos[i]
            if n == window and not window & (window - 1):
                return 0
            return window - n

        best = [0] + [10 ** 9] * (len(pos) - 1)
        for j in range(1, len(pos)):
            for i in range(j):
                if pos[j] - pos[i] <= window:
                    best[j] = min(best[j], best[i] + cost(i, j) + (penalty[j] if j < len(pos) - 1 else 0))
        cuts = packing.cut(pos, penalty, window)
        at = {p: i for i, p in enumerate(pos)}
        total = sum(cost(at[a], at[b]) + (penalty[at[b]] if b != pos[-1] else 0) for a, b in zip(cuts, cuts[1:]))
        assert total == best[-1] and cuts[0] == 0 and cuts[-1] == pos[-1]


def test_packing_wastes_little(docs):
    got = packing.pack(docs.coalesce(1), tokenizer(PACK_FILE)).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    used = sum(r.n for r in got)
    assert sum(4096 if r.n & (r.n - 1) else r.n for r in got) <= 1.01 * used + 4096


# ---------------------------------------------------------------- repeats


def repeats_by_force(rows, length):
    seen = {}
    for k, (_, t) in enumerate(rows):
        raw = t.encode()
        for p in range(len(raw) - length + 1):
            seen.setdefault(raw[p:p + length], []).append((k, p))
    cover = [bytearray(len(t.encode())) for _, t in rows]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                cover[k][p:p + length] = b"\x01" * length
    out = []
    for (i, t), c in zip(rows, cover):
        raw = t.encode()
        kept = bytes(b for b, x in zip(raw, c) if not x)
        spans = len(re.findall(rb"\x01+", bytes(c)))
        out.append((i, len(raw), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [24, 200])
def test_repeats(table, length):
    got = [tuple(r) for r in suffix_dedup.remove_repeats(table, length).collect()]
    assert key(got) == key(repeats_by_force(pairs(table), length))


def test_repeats_in_small_steps(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 100, n)).decode() for n in (9, 33, 70, 120)]
    rows = [(i, "".join(words[j] for j in rng.integers(0, 4, 8))[: int(rng.integers(0, 500))]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "HOT_GROUP", 3)
    got = [tuple(r) for r in suffix_dedup.remove_repeats(df, 40).collect()]
    assert key(got) == key(repeats_by_force(rows, 40))
    out = suffix_dedup.without_repeats(df, 40)
    assert out.columns == df.columns and out.count() == len(rows)
    assert {hashlib.sha256(r.text.encode()).hexdigest() for r in out.collect()} == {g[4] for g in got}


# ---------------------------------------------------------------- Jaccard


def shingle_set(t):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components_by_force(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                    up[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return [(i, len(sets[a]), least.get(root(a)) if sets[a] else i) for a, (i, _) in enumerate(rows)]


def test_jaccard(table):
    got = [tuple(r) for r in jaccard_join.near_duplicates(table).collect()]
    assert key(got) == key(components_by_force(pairs(table)))


def test_jaccard_of_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [list(rng.choice(vocabulary, n)) for n in (4, 5, 6, 12, 40, 90, 91)]
    rows = []
    for i in range(220):
        w = list(bases[i % len(bases)])
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(0, len(w)))] = str(rng.choice(vocabulary))
        rows.append((1000 - i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = components_by_force(rows)
    got = [tuple(r) for r in jaccard_join.near_duplicates(df).collect()]
    assert key(got) == key(want)
    kept = {r.doc_id for r in jaccard_join.one_of_each(df).collect()}
    assert kept == {c for _, _, c in want}


def test_one_of_each_keeps_columns(odd_docs):
    out = jaccard_join.one_of_each(odd_docs)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert sum(r.text == "the same text of some seven words" for r in rows) == 1
    assert sum(not (r.text or "").strip() for r in rows) == 3


# ---------------------------------------------------------------- BPE


def test_bpe(table):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer(BPE_FILE))
    want = []
    for i, t in pairs(table):
        ids = tok.encode(t, add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.encode_decode(table, tokenizer(BPE_FILE), pre_tokens()).collect()]
    assert key(got) == key(want)


def test_bpe_pieces():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(tokenizer(BPE_FILE)), bpe.load(tokenizer(BPE_FILE), pre_tokens())
    rng = np.random.default_rng(9)
    for alphabet in ("ab", "the rain", "éüß日本", " \n\t", "aaaaaaab", "0123."):
        for n in (1, 2, 3, 7, 30, 200):
            for _ in range(20):
                t = "".join(rng.choice(list(alphabet), n))
                ids = tok.encode(t, add_special_tokens=False).ids
                assert own.ids(t) == ids and own.decode(ids) == t


# ---------------------------------------------------------------- SimHash


def test_simhash(table):
    got = simhash.fingerprint_edits(table).collect()
    rows = sorted(pairs(table), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    assert len(got) == len(rows)
    texts_ = [t for _, t in rows]
    want = []
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[:len(t) - half] + texts_[(k + 1) % len(rows)][:half]).encode()).hexdigest()))
    assert key((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == key(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 16 for r in got)


def test_simhash_votes(spark):
    texts_ = ["one two two three", "", "lonelylongwordofmanyletters", "a a a b"]
    rows = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    got = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.fingerprints(rows, ["doc_id"], "text").collect()}
    hashes = {w: h & (1 << 64) - 1 for w, h in spark.createDataFrame(sorted({(w,) for t in texts_ for w in t.split()}), "w string")
              .select("w", F.xxhash64("w")).collect()}
    for i, t in enumerate(texts_):
        want = 0
        for bit in range(64):
            vote = sum(min(16, len(w)) * (1 if hashes[w] >> bit & 1 else -1) for w in t.split())
            want |= (vote > 0) << bit
        assert got.get(i, 0) == want


def test_near_fingerprints(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-(1 << 63), 1 << 63, 40, dtype=np.int64)
    fps = [int(x) for x in base]
    for x in base:
        for _ in range(3):
            y = int(x)
            for b in rng.integers(0, 64, int(rng.integers(0, 6))):
                y ^= 1 << int(b)
            fps.append((y + (1 << 63)) % (1 << 64) - (1 << 63))
    want = {(a, b): bin((a ^ b) & (1 << 64) - 1).count("1") for a in set(fps) for b in set(fps) if a < b}
    df = spark.createDataFrame([(f,) for f in fps] + [(None,)], "fp long")
    for r in (0, 3):
        got = {(x.a, x.b): x.distance for x in simhash.near_fingerprints(df, r, 5).collect()}
        assert got == {k: v for k, v in want.items() if v <= r}


# ---------------------------------------------------------------- PII

FIXTURE = ["mail a.b+c@x-y.example.org, or _d@e.f_g@h.i and @no a@b a@b.", "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 0300.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111",
           "+1 (234) 567-8901 +12 3 +49.30.1234567890123456", "é\U0001F600 +44 20 7946 0958 x\n4111111111111111", "1" * 5000 + " " + "a" * 5000 + "." * 100, "a@b.c" * 50]


def base_by_force(t):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]
    spans = [(m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(rules) for m in re.finditer(p, t) if ok(m[0])]
    return [(k, s, e) for s, _, k, e in sorted(spans)]


def check_pii(df):
    got = pii.find_pii(df).collect()
    want = []
    for i, t in pairs(df):
        spans = base_by_force(t)
        n = [sum(k == kind for k, *_ in spans) for kind in pii.KINDS]
        want.append((i, *n, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()))
    assert key((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == key(want)
    by_id = {}
    for i, t in pairs(df):
        by_id.setdefault(i, set()).update(f"{k}:{s}:{e}" for k, s, e in base_by_force(t))
    for r in got:
        assert {x for x in r.spans.split(",") if x and not x.startswith("term:")} <= by_id[r.doc_id]
    return got


def test_pii(table):
    check_pii(table)


def test_pii_patterns(spark):
    check_pii(spark.createDataFrame(list(enumerate(FIXTURE)), "doc_id long, text string"))


def test_pii_terms(spark):
    rows = [(i, f"Der Gutsherr Zorbanek schreibt an zor@mail.example.org und wartet, {i}") for i in range(6)]
    rows += [(10 + i, f"Der Nachbar schreibt an a{i}@mail.example.org und wartet, und der wartet schon") for i in range(60)]
    rows += [(100 + i, f"der und an schreibt wartet {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in check_pii(df)}
    at = rows[0][1].index("Zorbanek")
    assert f"term:{at}:{at + 8}" in got[0].split(",")
    assert "term" not in got[10] and not got[100]
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert clean[10] == rows[6][1].replace("a0@mail.example.org", "[email]") and clean[100] == rows[-30][1]
    assert "zor" not in clean[0].lower() and "[email]" in clean[0]


def test_pii_terms_of_single_documents(spark):
    """Entities of one document; terms at the head, short, with digits, in other documents."""
    rows = [(i, f"nothing of note stands here and there, {'der' if i % 2 else 'die'} {i}") for i in range(60)]
    rows += [(60, "Qo wrote first. " + "nothing of note " * 30 + "one@mail.example.org and there. " + "here " * 30 + "usr77 qo"),
             (61, "Vex nothing two@mail.example.org"), (62, "here, vex: two@mail.example.org"), (63, "nothing of VEX here"),
             (64, "pair of three@mail.example.org"), (65, "pair and there")]
    copies = [(200 + i, rows[60][1]) for i in range(5)] + [(300 + i, rows[61][1]) for i in range(9)]
    df = spark.createDataFrame(rows + [rows[60]] * 5 + copies, "doc_id long, text string")  # copies of a text count once
    got = {r.doc_id: [x.split(":")[1:] for x in r.spans.split(",") if x.startswith("term:")] for r in check_pii(df)}
    of = dict(rows + copies)
    terms = {i: [of[i][int(a):int(b)] for a, b in x] for i, x in got.items() if x}
    for i, _ in copies:
        assert got.pop(i) == got[60 if i < 300 else 61] and terms.pop(i)
    assert terms == {60: ["Qo", "wrote", "first", "usr77", "qo"], 61: ["Vex"], 62: ["vex"], 63: ["VEX"]}
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert clean[63] == "nothing of [term] here" and clean[65] == "pair and there" and clean[60].startswith("[term] [term] [term]. nothing")


def test_pii_terms_on_given_documents(docs):
    """Every marked word against counts by hand, on documents whose entities stand in one or two."""
    rows = sorted(set(pairs(docs)))
    different = sorted({t for _, t in rows})
    words, held = {}, {}
    for k, t in enumerate(different):
        for w in {w for w in re.findall(r"\w+", t.lower())}:
            words.setdefault(w, set()).add(k)
        for kind, a, b in base_by_force(t):
            held.setdefault((kind, t[a:b].lower()), set()).add(k)
    n, strong = len(different), {}
    for e in held.values():
        for w in {w for k in e for w in re.findall(r"\w+", different[k].lower())}:
            both, of_w = len(words[w] & e), len(words[w])
            if (both + len(e) / n) / (of_w + 1) >= 0.5 and both / of_w * n / len(e) >= 16:
                strong[w] = True
    want = []
    for i, t in rows:
        spans = base_by_force(t)
        want += [(i, m.start(), m.end()) for m in re.finditer(r"\w+", t) if m[0].lower() in strong and not any(a < m.end() and m.start() < b for _, a, b in spans)]
    got = [(r.doc_id, *map(int, x.split(":")[1:])) for r in pii.find_pii(docs).collect() for x in r.spans.split(",") if x.startswith("term:")]
    assert want and key(set(got)) == key(set(want))


def test_pii_keeps_columns(odd_docs):
    out = pii.sanitised(odd_docs)
    assert out.columns == odd_docs.columns and key(map(tuple, out.collect())) == key(map(tuple, odd_docs.collect()))


# ---------------------------------------------------------------- toxicity


def test_toxicity(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.train(docs, labels)).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(got) == docs.count()
    held = [(got[i].score, y) for i, y in truth.items() if i in got and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    right = sum((s >= 0.5) == y for s, y in held) / len(held)
    assert right > 0.93


def test_toxicity_calibrates_on_different_texts(spark, monkeypatch):
    """Copies of one text do not fill the calibration sample."""
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 20)
    docs = spark.createDataFrame([(i, ("a calm and kind day", "you vile moron there")[i % 2]) for i in range(400)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    model = toxicity.train(docs, labels)
    assert model.weights is not None
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.scored(docs, model).collect())


def test_toxicity_without_toxic_documents_to_calibrate(spark):
    """Toxic documents in folds 1 to 3 only: a fixed curve, not 0 for all."""
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in range(600)}
    toxic = {i: int(i % 3 == 0 and fold[i] in (1, 2, 3)) for i in fold}
    docs = spark.createDataFrame([(i, "you vile moron there" if y else f"a calm and kind day {i}") for i, y in toxic.items()], "doc_id long, text string")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.train(docs, labels)).collect()}
    assert all(got[i].predicted == y for i, y in toxic.items())
    assert min(r.score for i, r in got.items() if toxic[i]) > max(r.score for i, r in got.items() if not toxic[i])


def toxicity_by_force(train, texts_):
    """Features of texts from labelled (id, text, toxic) rows, word by word."""
    def model(rows):
        n, k = (Counter(), Counter()), Counter()
        for _, t, y in rows:
            ws = re.findall(r"[^\W\d_]+", t.lower())
            n[y].update(ws)
            k.update(set(ws))
        big, v, d = sum(k.values()) + 5.0 * max(1 << 20, len(k) + 1), [sum(c.values()) for c in n], 0.75

        def p(w, y):
            return (max(n[y][w] - d, 0) + d * len(n[y]) * (k[w] + 5.0) / big) / v[y]

        return lambda w: math.log(p(w, 1) / p(w, 0))

    def three(t, of):
        r = [of(w) for w in re.findall(r"[^\W\d_]+", t.lower())]
        m = min(5, len(r))
        return (sum(r) / len(r), max(sum(r[i:i + m]) / m for i in range(len(r) - m + 1)), max(r)) if r else (0.0, 0.0, 0.0)

    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    first = model([x for x in train if fold(x[0]) in (1, 2, 3)])
    rest = {(y, three(t, first)) for i, t, y in train if fold(i) == 4}
    weights = toxicity.logistic(np.array([x for _, x in sorted(rest)]), np.array([float(y) for y, _ in sorted(rest)]))
    return [1 / (1 + math.exp(-(weights[0] + np.dot(weights[1:], three(t, first))))) for t in texts_]


@pytest.mark.parametrize("head", [None, 3000, 40])
def test_toxicity_by_force(spark, monkeypatch, head):
    """The scores of plain models, also where tasks hold only some of the words."""
    if head:
        monkeypatch.setattr(toxicity, "HEAD", head)
    d = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([None, "", "unheard", "x y", "123 !", "zzzq " * 3000, "zzzq a b c d e f g h zzzr"])], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(extra)
    truth = {}
    for r in labels.collect():
        if r.toxic in (0, 1):
            truth[r.doc_id] = max(r.toxic, truth.get(r.doc_id, 0))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = toxicity_by_force([(i, t, truth[i]) for i, t in rows if i in truth], [t for _, t in rows])
    model = toxicity.train(docs, labels)
    assert model.head.whole == (head is None)
    got = toxicity.scored(docs, model).collect()
    assert len(got) == len(rows)
    have = {r.doc_id: r.score for r in got}
    assert all(abs(have[i] - w) < 1e-6 for (i, _), w in zip(rows, want, strict=True))
    kept = {r.doc_id for r in toxicity.ordinary(docs, model).collect()}
    assert kept == {i for i, s in have.items() if s < 0.5}


def test_toxicity_of_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 0), (8, 1), (9, 0), (None, 1), (3, None), (5, 1), (2, 0)], "doc_id long, toxic int")
    for df in (odd_docs, no_docs):
        for some in (labels, labels.filter("false"), labels.filter("toxic = 0")):
            model = toxicity.train(df, some)
            out = toxicity.scored(df, model).collect()
            assert len(out) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
            kept = toxicity.ordinary(df, model)
            assert kept.columns == df.columns and kept.count() == sum(r.predicted == 0 for r in out)


# ---------------------------------------------------------------- URLs


def split_by_force(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match("[^?#]*", rest[len(host):])[0]


def rule_by_force(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?y#z", "http://example.org/en/12", "http://x.org", "http://x.org/", "ftp://com/fr/",
            "http://xcom/fr/", "http://x.com/de/" + "a" * 20_000, "http://a.net?q=/fr/", "http://É.com/fr/#://b", "http://a.net/de/1", "http://a.net/de/1"]
    urls += [f"https://{h}{i}.example.{t}/{lang}/{i}" for i in range(12) for h in ("a", "bb") for t in ("com", "org", "net") for lang in ("fr", "de", "en", "es")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(pages, RULES, url_filter.labelled_by_rules(pages, RULES)).collect()}
    for i, u in enumerate(urls):
        host, path = split_by_force(u)
        rule, verdict = rule_by_force(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
    # what the labelled addresses show carries over to hosts without a rule
    share = {}
    for lang in ("fr", "de"):
        v = [r.verdict for r in got.values() if r.host.endswith(".net") and r.path.startswith(f"/{lang}/")]
        share[lang] = v.count("block") / len(v)
    assert share["de"] > share["fr"] == 0
    none = pages.filter("false")
    assert url_filter.judge(none, RULES, url_filter.labelled_by_rules(none, RULES)).count() == 0


# ---------------------------------------------------------------- sharding


def test_sharding(table):
    want = sharding.lookup_table(SHARDS)
    rows = sharding.place(table, SHARDS).collect()
    assert len(rows) == table.count()
    for r in rows:
        slot = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:8], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, SHARDS[want[slot]])


def test_sharding_is_even_and_steady():
    table = sharding.lookup_table(SHARDS)
    share = np.bincount(table)
    assert share.max() - share.min() <= 1 and len(table) == sharding.SLOTS
    fewer = sharding.lookup_table(SHARDS[:-1])
    moved = np.mean([a != b for a, b in zip(table, fewer) if a != len(SHARDS) - 1])
    assert moved < 0.1


# ---------------------------------------------------------------- neighbours


def nearest_by_force(rows, top):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    good = list({(i, v.tobytes()): (i, v) for i, v in good}.values())
    out = {}
    for i, v in good:
        if i % 20 == 0:
            scored = sorted((-sum(float(a) * float(b) for a, b in zip(v, w)), j) for j, w in good if j != i)
            out[i] = [(j, -s) for s, j in scored[:top]]
    return out


def test_neighbours(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = nearest_by_force([(r.vec_id, r.embedding) for r in df.collect()], 20)
    got = {}
    for r in ann.neighbours(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = sum(len({j for _, j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {(q, j): s for q, w in want.items() for j, s in w}
    for q, w in got.items():
        assert [r for r, *_ in sorted(w)] == list(range(1, len(w) + 1))
        # Python's sum() compensates rounding, the operator adds in order: both are double precision
        assert all(abs(exact.get((q, j), s) - s) < 1e-12 for _, j, s in w)


def test_neighbours_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [2.0, 2.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]),
            (40, [float("inf"), 1.0]), (7, [1.0, 0.0]), (6, [1.0, 0.0]), (None, [1.0, 1.0]), (60, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.neighbours(df, F.col("vec_id") % 20 == 0, top=3).collect())
    assert got == [(0, 1, 5, 2.0), (0, 2, 6, 1.0), (0, 3, 7, 1.0), (20, 1, 5, 2.0), (20, 2, 0, 1.0), (20, 3, 6, 1.0)]
    assert ann.neighbours(df.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_shingle_sets_of_odd_texts():
    """Sizes equal those of word tuples; equal words hash alike wherever they stand."""
    import random

    def plain(text: str) -> int:
        words = text.encode("utf-8").lower().split()
        k = min(5, len(words))
        return len({tuple(words[i:i + k]) for i in range(len(words) - k + 1)}) if words else 0

    rng = random.Random(1)
    parts = ["a", "B", "\u00e9", "x1", " ", "  ", "\n", "\t", "Zz", "\x0b", "\x1c", "\x85", "w" * 5000]
    batch = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(300)]
    batch += ["", "   ", "q" * 1_500_000, "a b " + "q" * 900_000 + " c d e f " + "R" * 700_000 + " z",
              "a b c d", " ".join(str(i % 977) for i in range(200_000))]
    sets = list(jaccard_join.shingle_sets(batch))
    assert [len(s) for s in sets] == [plain(t) for t in batch]
    assert all((jaccard_join.shingles(t) == s).all() for t, s in zip(batch, sets, strict=True))
    assert (jaccard_join.shingles("A B  c\tD e") == jaccard_join.shingles("a b c d e")).all()


# ------------------------------------------------- texts that fool polynomials


def thue_morse(n, a="a", b="b"):
    """A word and its complement: equal under any polynomial of an odd base modulo 2^64."""
    t = [bin(i).count("1") & 1 for i in range(n)]
    return "".join((a, b)[x] for x in t), "".join((b, a)[x] for x in t)


@pytest.mark.parametrize("n", [64, 128, 1024, 2048, 4096, 8192])
def test_long_words_that_differ_are_not_linked(n):
    one, two = thue_morse(n)
    assert jaccard_join.node_of(jaccard_join.shingles(one)) != jaccard_join.node_of(jaccard_join.shingles(two))


def test_near_duplicates_of_thue_morse_words(spark):
    rows = [(i, w) for i, w in enumerate([*thue_morse(2048), *thue_morse(2048)])]
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 1}


def test_long_repeats_of_thue_morse_texts(spark):
    one, two = thue_morse(1024)
    pad = "".join(chr(33 + (i * i) % 90) for i in range(588))
    docs = spark.createDataFrame([(0, pad + one + pad), (1, pad + two + pad), (2, "x" + pad + one + pad)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs, length=2200).collect()}
    assert got == {0: 2200, 1: 0, 2: 2200}
