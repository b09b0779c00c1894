"""Byte-level BPE: a segment tree over the ranks of adjacent pairs.

Every distinct pre-token is encoded once. Its tree holds, at each leaf, the merge rank of
the pair that starts there (with the position, so that ties go left); the root is the next
merge, and a merge changes three leaves and their paths only. Pre-tokens of one tree
size are encoded side by side as rows of arrays; one of any length has a tree of its own
size, so a text that is a single long word costs n log n.

Empty or null text: no ids, decoded text empty. The special token's string in a text
is one id, as the library's default has it. Repeated rows and ids give repeated results.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

_PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: The same for texts of Latin-1 characters without the few that the two engines class otherwise.
_LATIN = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
_UNLIKE = bytes([0x1C, 0x1D, 0x1E, 0x1F, 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE])
_NONE = np.int64(1) << 62
#: Pre-tokens a Python worker remembers before it starts anew (bounds its memory).
REMEMBERED = 600_000
#: Array cells of one batch of trees.
CELLS = 1 << 21


def _alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def pre_tokens(text: str) -> list[str]:
    """The text cut into the pieces that merges never cross."""
    try:
        latin = text.encode("latin-1")
    except UnicodeEncodeError:
        return _PATTERN.findall(text)
    plain = len(latin.translate(None, _UNLIKE)) == len(latin)
    return (_LATIN if plain else _PATTERN).findall(text)


class BpeTokenizer:
    """Vocabulary, merges and special tokens of a tokenizer file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, byte_of = spec["model"], _alphabet()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.pieces: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            if token not in self.special:
                self.pieces[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in byte_of.items():
            self.byte_id[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.split = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special else None
        )
        self.known: dict[str, bytes] = {}

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, _NONE where there is none (or b is no symbol: -1)."""
        key = a << 32 | np.maximum(b, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], _NONE)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if w:
                by_size.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(i)
        for size, rows in by_size.items():
            step = max(1, CELLS // size)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                for i, ids in zip(part, self._trees([words[i] for i in part], size)):
                    out[i] = ids
        return out

    def _trees(self, words: list[bytes], size: int) -> list[bytes]:
        n = len(words)
        lens = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size)
        inside = np.arange(size) < lens[:, None]
        sym = np.where(inside, self.byte_id[raw], -1)
        after = np.full((n, size + 1), size, np.int64)  # next symbol's place; size: none
        after[:, :size] = np.where(np.arange(1, size + 1) < lens[:, None], np.arange(1, size + 1), size)
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), _NONE, np.int64)
        rank = self.pair_rank(sym[:, :-1], sym[:, 1:])
        tree[:, size : 2 * size - 1] = np.where(rank < _NONE, rank * size + np.arange(size - 1), _NONE)
        half = size
        while half > 1:
            tree[:, half // 2 : half] = np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2])
            half //= 2
        flat, sym_f, after_f, before_f = tree.ravel(), sym.ravel(), after.ravel(), before.ravel()
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            root = flat[live * (2 * size) + 1]
            i, r = root % size, root // size
            s0, a0, t0 = live * size, live * (size + 1), live * (2 * size)
            j = after_f[a0 + i]
            k = after_f[a0 + j]
            sym_f[s0 + i] = self.merged[r]
            sym_f[s0 + j] = -1
            after_f[a0 + i] = k
            before_f[a0 + k] = i
            p = before_f[a0 + i]
            new, has = sym_f[s0 + i], p >= 0
            next_sym = np.where(k < size, sym_f[s0 + np.minimum(k, size - 1)], -1)
            rank_i = self.pair_rank(new, next_sym)
            rank_p = self.pair_rank(np.where(has, sym_f[s0 + np.maximum(p, 0)], -1), new)
            flat[t0 + size + j] = _NONE
            flat[t0 + size + i] = np.where(rank_i < _NONE, rank_i * size + i, _NONE)
            p = np.where(has, p, i)
            flat[t0 + size + p] = np.where(has, np.where(rank_p < _NONE, rank_p * size + p, _NONE), flat[t0 + size + i])
            for leaf in (j, i, p):
                node = (leaf + size) >> 1
                while node[0] >= 1:
                    flat[t0 + node] = np.minimum(flat[t0 + 2 * node], flat[t0 + 2 * node + 1])
                    node = node >> 1
            live = live[flat[t0 + 1] < _NONE]
        left = sym >= 0
        ids = sym[left].astype("<u4").tobytes()
        ends = (np.cumsum(left.sum(1)) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        parts: list[list[str]] = []
        for t in texts:
            if self.split is not None and any(s in t for s in self.special):
                parts.append([x for k, piece in enumerate(self.split.split(t))
                              for x in ([piece] if k % 2 else pre_tokens(piece))])
            else:
                parts.append(pre_tokens(t))
        # a special token stands outside the merges wherever the split has found it
        fixed = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        new = list(set().union(*parts).difference(self.known)) if parts else []
        self.known.update(zip(new, self.encode_words([w.encode() for w in new])))
        self.known.update(fixed)
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _tokenizer(content: str) -> BpeTokenizer:
    return BpeTokenizer(content)


def load(path: str) -> str:
    """A tokenizer file's content (bounded: a vocabulary of some 1.5 MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(docs: DataFrame, content: str, with_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, sha256 of ids and of the decoded text;
    with ``with_ids`` also the ids themselves. ``content``: see load(), broadcast once."""
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        tok = _tokenizer(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            coded = tok.encode_batch(texts)
            ids = [np.frombuffer(c, "<u4") for c in coded]
            cols = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                "decoded_sha256": pa.array(
                    [hashlib.sha256(tok.decode(x).encode()).hexdigest() for x in ids]),
            }
            if with_ids:
                cols["ids"] = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(cols)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<long>" if with_ids else ""))
