"""Byte-level BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a piece of text the BPE encoding has one last token.
An Aho-Corasick automaton over the vocabulary yields the tokens that end at
each position; the one whose left neighbour (the last token of the prefix
before it) can stand next to it under the merge order is that last token.
Back-pointers from the end give the ids.

Pieces come from the tokenizer's own pre-tokenisation pattern, so the work per
piece is short; each Python worker keeps the encoded form of the pieces it has
seen (bounded, see PIECE_CACHE). There is no shuffle: a task streams its split.

Cases: a null text is empty (0 tokens, hash of the empty string); texts of any
length are taken whole; repeated rows give repeated results; columns beside id
and text are not read.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from gaugekeep.llm.common import bounded_batches, texts

# Encoded pieces a worker keeps; beyond it the cache starts anew (speed only).
PIECE_CACHE = 1_000_000
# Longer pieces are encoded each time they occur.
LONGEST_CACHED = 64
NEVER = 1 << 60


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return [table[b] for b in range(256)]


class ByteBpe:
    """Vocabulary, merge ranks and the automaton of one tokenizer file."""

    def __init__(self, path: str, pattern: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        vocab = spec["model"]["vocab"]
        chars = _byte_chars()
        back = {c: b for b, c in enumerate(chars)}
        self.mapped = str.maketrans({chr(b): c for b, c in enumerate(chars)})
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {i: bytes(back[c] for c in t) for t, i in vocab.items() if t not in self.special}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        # rank of the merge that makes a token (-1: a single byte), its two parts, rank of each pair
        self.made, self.parts, self.pair = dict.fromkeys(vocab.values(), -1), {}, {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            token, pair = vocab[left + right], (vocab[left], vocab[right])
            if token not in self.parts:
                self.made[token], self.parts[token] = rank, pair
            self.pair.setdefault(pair, rank)
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            if t not in self.special and (len(t) == 1 or i in self.parts):
                self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.split = regex.compile(pattern).findall
        self.between = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.seen: dict[str, tuple[int, str, bytes]] = {}

    def stand(self, x: int, y: int) -> bool:
        """Whether x and y can be neighbours in an encoding: going back in merge
        time along x's right edge and y's left edge, no pair that touches the
        border may have a merge due before one of its two is merged away."""
        due_x = due_y = NEVER
        made, parts, pair = self.made, self.parts, self.pair
        while True:
            rank = pair.get((x, y))
            if rank is not None and rank < due_x and rank <= due_y:
                return False
            rx, ry = made[x], made[y]
            if rx < 0 and ry < 0:
                return True
            if ry >= rx:  # of two merges of one rank the left comes first
                due_y, y = ry, parts[y][0]
            else:
                due_x, x = rx, parts[x][1]

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of one piece: the last token of every prefix, then back."""
        shown = piece.encode().decode("latin-1").translate(self.mapped)
        last, start = [-1] * len(shown), [0] * len(shown)
        stand = self.stand
        for end, (token, n) in self.automaton.iter(shown):
            if last[end] >= 0:
                continue
            begin = end - n + 1
            if not begin or last[begin - 1] >= 0 and stand(last[begin - 1], token):
                last[end], start[end] = token, begin
        ids, at = [], len(shown) - 1
        while at >= 0:
            ids.append(last[at])
            at = start[at] - 1
        return ids[::-1]

    def _piece(self, piece: str) -> tuple[int, str, bytes]:
        ids = self.piece_ids(piece)
        out = len(ids), ",".join(map(str, ids)), b"".join(map(self.bytes.__getitem__, ids))
        if len(piece) <= LONGEST_CACHED:
            if len(self.seen) >= PIECE_CACHE:
                self.seen.clear()
            self.seen[piece] = out
        return out

    def encoded(self, text: str) -> list[tuple[int, str, bytes]]:
        """Per piece: number of ids, ids as decimal text, decoded bytes."""
        get, make, out = self.seen.get, self._piece, []
        for k, part in enumerate(self.between.split(text) if self.special else [text]):
            if k % 2:
                i = self.special[part]
                out.append((1, str(i), self.bytes[i]))
            else:
                out += [get(p) or make(p) for p in self.split(part)]
        return out

    def ids(self, text: str) -> list[int]:
        return [int(i) for _, s, _ in self.encoded(text) for i in s.split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_decode(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row (and ids, decoded)."""
    bounded_batches(docs.sparkSession)
    src = texts(docs, id_col, text_col)
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches):
        bpe = load(tokenizer_path, pattern)
        for b in batches:
            n, ids_sha, text_sha, all_ids, decoded = [], [], [], [], []
            for t in b.column("text").to_pylist():
                got = bpe.encoded(t)
                ids = ",".join([x[1] for x in got])
                raw = b"".join([x[2] for x in got]).decode("utf-8", "replace")
                n.append(sum([x[0] for x in got]))
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(raw.encode()).hexdigest())
                if with_ids:
                    all_ids.append([int(i) for i in ids.split(",")] if ids else [])
                    decoded.append(raw)
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                    pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return src.mapInArrow(run, schema)
