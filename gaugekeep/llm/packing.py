"""Packing of tokenised documents into fixed windows by dynamic programming.

The documents of a split, in order of doc_id, form one token stream. Windows of
at most `window` tokens are cut from it so that padding plus truncation
penalties is least. Cuts may lie at document ends (no penalty), at sentence
ends, and, in stretches without either, at token positions in between. With
f(j) the least cost of a packing that ends at cut j,

    f(j) = penalty(j) + window - pos(j) + min(f(i) + pos(i)),  pos(j) - pos(i) <= window

and the minimum is the head of a monotone queue, so a split costs one pass.
A window whose length is a power of two needs no padding; those transitions
are looked up by position.

There is no shuffle: every scan task packs its own split, block by block, and
hands the unfinished last window to the next block, so only one window a task
ends short. sequence_id is the task's number and a counter: a lost task gives
the same ids again.

Ids come from the tokenizers library; a worker keeps those of the words it has
seen (bounded), since the tokenizer drops white space and treats words alone.

Cases: a null or empty text is the end id alone; texts of any length are taken
whole; repeated rows or ids are separate documents; an empty table gives no
rows; null ids are kept and sort first.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugekeep.llm.common import bounded_batches, texts

# Tokens of a block; the queue and its back-pointers cover one block.
BLOCK_TOKENS = 1 << 20
# Cost of a cut in tokens of padding.
SENTENCE_CUT, FORCED_CUT = 8, 64
# Shortest window that is kept unpadded for being a power of two.
LEAST_POWER = 256
# Words that a worker keeps with their ids (as many older ones beside them), some 200 bytes
# each, and the longest of them; characters of the texts split at a time.
WORD_CACHE, LONGEST_CACHED, SLICE_CHARS = 300_000, 48, 1 << 21
# Marks that the tokenizer keeps apart from letters before them, in one run.
MARKS = ".,;:!?"


class Words:
    """Ids of texts, by the tokenizers library, word by word.

    A word is what stands between white space, which the tokenizer drops. Of a word of
    letters and marks behind them the two parts are told apart, as the tokenizer's own
    pre-tokenisation does, so its ids are those of its parts in turn; other words go to
    the library whole. Words not met while WORD_CACHE others were are forgotten."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters = re.compile(r"(?<!\S)[a-zà-öø-ÿ]+(?!\S)").findall
        self.only_letters = re.compile(r"[a-zà-öø-ÿ]+").fullmatch
        # what the tokenizer's byte level makes of the letters
        self.bytes_of = {ord(c): self.tok.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xE0, 0x100)) if c != "÷"}

    def _encode(self, units: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]

    def _encode_letters(self, units: list[str]) -> list[bytes]:
        """The same for lower-case letters alone, which its model gets at once."""
        tokenize = self.tok.model.tokenize
        shown = [u if u.isascii() else u.translate(self.bytes_of) for u in units]
        return [array("I", [t.id for t in tokenize(u)]).tobytes() for u in shown]

    def learn(self, new: set[str]) -> None:
        """Adds words that `words` lacks."""
        known, older = self.words, self.older
        back = new.intersection(older)
        known.update(zip(back, map(older.__getitem__, back), strict=True))
        # letters alone, found at once; the others one by one
        plain = new.intersection(self.letters(" ".join(new.difference(back))))
        marked, whole = [], []
        for w in new.difference(back).difference(plain):
            stem = w.rstrip(MARKS)
            low = stem.lower()
            if not (self.only_letters(low) and len(low) == len(stem)):
                whole.append(w)
                continue
            marked.append((w, low, w[len(stem):]))
            if low not in known:
                if (ids := older.get(low)) is not None:
                    known[low] = ids
                else:
                    plain.add(low)
        units = list(plain)
        known.update(zip(units, self._encode_letters(units), strict=True))
        known.update(zip(whole, self._encode(whole), strict=True))
        tails = [t for t in {t for _, _, t in marked if t} if t not in known]
        known.update(zip(tails, self._encode(tails), strict=True))
        for w, low, tail in marked:
            known[w] = known[low] + known[tail] if tail else known[low]

    def ids(self, batch: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text; only some texts are split at a time."""
        for some in slices(batch, SLICE_CHARS):
            split = [split_words(t) for t in some]
            new = set(chain.from_iterable(split)).difference(self.words)
            self.learn(new)
            yield from [b"".join(map(self.words.__getitem__, s)) for s in split]
            for w in [w for w in new if len(w) > LONGEST_CACHED]:
                stem = w.rstrip(MARKS)
                for x in (w, stem.lower(), w[len(stem):]):
                    self.words.pop(x, None)
            if len(self.words) > WORD_CACHE:
                self.older, self.words = self.words, {}


def split_words(text: str) -> list[str]:
    """What stands between white space, in lower case where each character has its own
    and none is composed of others, so that the tokenizer would do the same."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python alone
        return text.split(" ")
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.split()
    return text.lower().split()


def slices(texts: list[str], size: int) -> Iterator[list[str]]:
    """Runs of texts of at least `size` characters, but for the last."""
    some, n = [], 0
    for t in texts:
        some.append(t)
        n += len(t)
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some


@lru_cache(maxsize=2)
def load(path: str) -> Words:
    return Words(path)


@lru_cache(maxsize=2)
def sentence_ids(path: str) -> np.ndarray:
    """Per id, whether the token ends a sentence."""
    vocab = load(path).tok.get_vocab()
    out = np.zeros(max(vocab.values()) + 1, bool)
    out[[i for t, i in vocab.items() if t.removesuffix("</w>") and not t.removesuffix("</w>").strip(".!?")]] = True
    return out


def cut(pos: list[int], penalty: list[int], window: int) -> list[int]:
    """Cut positions of the cheapest packing of the stream pos[0] .. pos[-1].

    `pos` ascends with steps of at most `window`; penalty[j] is paid for a cut
    at pos[j] (the last is free)."""
    n = len(pos)
    cost, back = [0] * n, [0] * n
    at = {p: i for i, p in enumerate(pos)}
    powers = []
    p = window
    while p >= min(LEAST_POWER, window) and p & (p - 1) == 0:
        powers.append(p)
        p >>= 1
    queue: deque[int] = deque([0])
    key = [0] * n  # cost + position, ascending in the queue
    key[0] = pos[0]
    for j in range(1, n):
        here = pos[j]
        low = here - window
        while pos[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        best = key[i] + window - here
        if not penalty[j]:  # unpadded windows that end where a document does
            for p in powers:
                k = at.get(here - p)
                if k is not None and cost[k] < best:
                    best, i = cost[k], k
        cost[j], back[j] = best + (penalty[j] if j < n - 1 else 0), i
        key[j] = k = cost[j] + here
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    cuts, j = [pos[-1]], n - 1
    while j:
        j = back[j]
        cuts.append(pos[j])
    return cuts[::-1]


def cut_points(ids: np.ndarray, ends: np.ndarray, enders: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Where the stream may be cut, with penalties: document ends, sentence
    ends, and every token in stretches longer than half a window without one."""
    penalty = np.full(len(ids) + 1, -1, dtype=np.int64)
    penalty[1:][enders[ids]] = SENTENCE_CUT
    penalty[ends] = 0
    penalty[0] = 0
    pos = np.flatnonzero(penalty >= 0)
    gaps = np.flatnonzero(np.diff(pos) > max(1, window // 2))
    for g in gaps:
        inside = penalty[pos[g] + 1:pos[g + 1]]
        inside[:] = FORCED_CUT
    if len(gaps):
        pos = np.flatnonzero(penalty >= 0)
    return pos.tolist(), penalty[pos].tolist()


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of documents in windows: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset (and ids)."""
    bounded_batches(docs.sparkSession)
    src = texts(docs, id_col, text_col)
    src = src.sortWithinPartitions("doc_id", "text")
    id_field = src.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_field}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint") + (", ids array<int>" if with_ids else "")

    def run(batches):
        from pyspark import TaskContext

        words, enders = load(tokenizer_path), sentence_ids(tokenizer_path)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 32
        end = np.array([end_id], dtype="<u4").tobytes()
        # documents whose tokens are not all placed: id, ids, tokens placed
        open_docs: list[list] = []
        held = 0

        def flush(final: bool):
            nonlocal sequence, open_docs, held
            if not open_docs:
                return None
            stream = np.concatenate([d[1][d[2]:] for d in open_docs])
            ends = np.cumsum([len(d[1]) - d[2] for d in open_docs])
            cuts = cut(*cut_points(stream, ends, enders, window), window)
            if not final and len(cuts) > 2:
                cuts.pop()  # the last window may still be filled
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            d, at = 0, 0
            for upto in cuts[1:]:
                begin = at
                while at < upto:
                    doc = open_docs[d]
                    take = min(len(doc[1]) - doc[2], upto - at)
                    ids = doc[1][doc[2]:doc[2] + take]
                    out["doc_id"].append(doc[0])
                    out["start"].append(doc[2])
                    out["length"].append(take)
                    out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    out["doc_tokens"].append(len(doc[1]))
                    out["sequence_id"].append(sequence)
                    out["offset"].append(at - begin)
                    if with_ids:
                        out["ids"].append(ids.astype(np.int32))
                    doc[2] += take
                    at += take
                    if doc[2] == len(doc[1]):
                        d += 1
                sequence += 1
            open_docs = open_docs[d:]
            held = sum(len(x[1]) - x[2] for x in open_docs)
            if not with_ids:
                del out["ids"]
            types = [id_type] + [pa.int64()] * 6 + ([pa.list_(pa.int32())] if with_ids else [])
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

        id_type = None
        for b in batches:
            id_type = b.schema.field("doc_id").type
            ids_of = b.column("doc_id").to_pylist()
            for doc, ids in zip(ids_of, words.ids(b.column("text").to_pylist()), strict=True):
                open_docs.append([doc, np.frombuffer(ids + end, dtype="<u4"), 0])
                held += len(open_docs[-1][1])
                if held >= BLOCK_TOKENS:
                    yield flush(False)
        if (rest := flush(True)) is not None:
            yield rest

    return src.mapInArrow(run, schema)
