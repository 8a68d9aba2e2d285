"""The pipeline against chained plain versions, with planted rows."""

import re
from collections import Counter

import corpus_pipeline
from gaugekeep.llm import pii, toxicity
from gaugekeep.llm.registry import PACK_FILE, tokenizer

VILE = "you vile moron you filthy idiot"
PASSAGE = " ".join(f"passage{i} shared" for i in range(60))


def tables(docs):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.limit(60).collect()]
    rows += [(1000 + i, f"{VILE} number {i} {VILE}", "en", "planted", 0) for i in range(40)]
    base = " ".join(f"word{i}" for i in range(120))
    rows += [(2000, base, "en", "s", 0), (2001, base, "en", "s", 0), (2002, base + " more", "en", "s", 0), (2003, "word5 " + base[:400], "en", "s", 0)]
    rows += [(3000 + i, f"{' '.join(f'own{i}x{j}' for j in range(90))} {PASSAGE} after{i}", "en", "s", 0) for i in range(3)]
    rows += [(4000, "write to kestrel@mail.example.org or 10.1.2.3", "en", "s", 0), (4001, None, "en", None, None), (4002, "", "en", "s", 0), (None, "no id at all", "en", "s", 0)]
    rows.append(rows[-1])
    labels = [(i, int(1000 <= i < 2000)) for i, *_ in rows if i is not None and i % 3]
    return rows, labels


def one_of_each(rows):
    """Components of Jaccard >= 0.8 over five-word shingles; the smallest (id, then any) stays."""
    def shingles(t):
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i]:
            c = find(i)
            best[c] = min(best.get(c, (doc is not None, doc or 0, i)), (doc is not None, doc or 0, i))
    return [r for i, r in enumerate(rows) if not sets[i] or best[find(i)][2] == i]


def without_repeats(rows, length=200):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for (doc, text), t in zip(rows, raw, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore")
        out.append((doc, text if text is None else kept))
    return out


def test_pipeline_equals_plain_stages(spark, scratch, docs):
    from tokenizers import Tokenizer

    rows, labels = tables(docs)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.createDataFrame(rows, schema)
    table.write.parquet(scratch + "/documents.parquet")
    spark.createDataFrame([(i, None, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(scratch + "/labels.parquet")
    got = corpus_pipeline.run(spark, scratch).collect()

    model = toxicity.train(table, spark.read.parquet(scratch + "/labels.parquet"))
    bad = Counter((r.doc_id) for r in toxicity.scored(table, model).collect() if r.predicted)
    assert {i for i in bad if 1000 <= i < 2000} == set(range(1000, 1040)) and not {i for i in bad if i >= 2000}
    left = [(r[0], r[1]) for r in rows if r[0] not in bad]
    left = without_repeats(one_of_each(left))
    ids = {i for i, _ in left}
    assert 2000 in ids and not ids & {2001, 2002} and {3000, 3001, 3002} <= ids
    assert sum(PASSAGE in (t or "") for _, t in left) == 0  # every copy of the passage goes
    clean = pii.sanitised(spark.createDataFrame(left, "doc_id long, text string")).collect()
    assert not any("@mail.example" in (r.text or "") for r in clean)
    tok = Tokenizer.from_file(tokenizer(PACK_FILE))
    want = Counter((r.doc_id, len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in clean)
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    assert sum(r.length for r in got) == sum(n * k for (_, n), k in want.items())


def test_pipeline_on_empty_tables(spark, scratch, docs):
    docs.filter("false").write.parquet(scratch + "/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(scratch + "/labels.parquet")
    assert corpus_pipeline.run(spark, scratch).collect() == []


def test_stages_keep_columns(spark, odd_docs, scratch):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(scratch + "/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, scratch)
        assert out.columns == odd_docs.columns, name
        assert out.count() >= 8
