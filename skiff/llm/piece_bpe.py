"""SentencePiece merge vocabularies: a score-ordered agenda of adjacent symbol pairs.

A text is written with one space before it, spaces as U+2581, and starts as single characters.
The agenda (a heap) holds each adjacent pair that is a piece, best score first and leftmost among
equals; taking one joins it and puts the two pairs beside it on the agenda; an entry whose symbols
have changed since is skipped. Characters without a piece become their UTF-8 bytes.

Texts are cut where no piece can reach across: before a space that follows something else, and
between characters that no chain of pieces connects (letters of one script, punctuation). Each
distinct segment is merged once and remembered, and so is each distinct word. Inside Arrow batches
words or whole texts can be checked against the sentencepiece library.

Handled: merge-type models with byte fallback, identity normaliser and only normal, byte, control
and unknown pieces; another model is refused with ValueError. Empty or null text: the begin and end
ids, decoded text empty. Strings such as "<s>" in a text are plain text. Repeated rows and ids
give repeated results, other columns are not read, and an empty table stays empty. A text
that is one segment of n characters takes n log n.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Segments a Python worker remembers before it starts anew (bounds its memory).
REMEMBERED = 600_000
#: Fixed values of the model file format: piece types, and the fields read here.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_MERGE_TYPE, _UNK_SURFACE = 2, " ⁇ "
_SPACED = re.compile(" +[^ ]+| +")


def _fields(data: bytes):
    """(field number, value) of a message of the model file: integers, or bytes as they stand."""
    at = 0

    def integer():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = integer()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, integer()
            continue
        size = {1: 8, 5: 4}.get(kind) or integer()
        yield tag >> 3, data[at : at + size]
        at += size


class PieceTokenizer:
    """Pieces, scores and ids of a model file's content."""

    def __init__(self, content: bytes):
        self.names: list[str] = []
        kinds, scores, trainer, norm = [], [], {}, {}
        for field, value in _fields(content):
            if field == _PIECE:
                piece = dict(_fields(value))
                self.names.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0" * 4))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == _TRAINER:
                trainer = dict(_fields(value))
            elif field == _NORMALIZER:
                norm = dict(_fields(value))
        if (trainer.get(3) != _MERGE_TYPE or not trainer.get(35) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}
                or norm.get(2) or not norm.get(3, 1) or norm.get(4, 1) or not norm.get(5, 1) or trainer.get(24)):
            raise ValueError("only merge-type models with byte fallback, identity normaliser and plain pieces are handled")
        self.bos, self.eos = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown = kinds.index(UNKNOWN)
        self.unk_surface = trainer[44].decode() if 44 in trainer else _UNK_SURFACE
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.names, kinds)) if k == NORMAL}
        best = sorted({scores[i] for i in self.ids.values()}, reverse=True)
        place = {s: r for r, s in enumerate(best)}
        #: Agenda order of each piece that a pair can make: the place of its score (0 is the best,
        #: equal scores equal), room for the pair's position, and the piece's length.
        self.order = {p: place[scores[i]] << 40 | len(p) for p, i in self.ids.items() if 1 < len(p) < 1 << 8}
        self.byte_ids = {int(p[3:-1], 16): i for i, (p, k) in enumerate(zip(self.names, kinds)) if k == BYTE}
        self.packed = {p: struct.pack("<I", i) for p, i in self.ids.items()}
        self.byte_packed = [struct.pack("<I", self.byte_ids[b]) for b in range(256)]
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        #: Bytes of each id in a decoded text (control: none).
        self.surface: list[bytes] = [p.replace(SPACE, " ").encode() for p in self.names]
        for i, k in enumerate(kinds):
            if k == CONTROL:
                self.surface[i] = b""
            elif k == BYTE:
                self.surface[i] = bytes([self.byte_of[i]])
        self.surface[self.unknown] = self.unk_surface.encode()
        self.control = {i for i, k in enumerate(kinds) if k == CONTROL}
        across = any(a != SPACE and b == SPACE for p in self.order for a, b in zip(p, p[1:]))
        self.cut = None if across else re.compile("|".join(self._runs()))
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        #: With a library every word is checked in the batch that brings it; ``odd`` holds those
        #: that differ, and ``agrees`` tells for each text of the last batch whether it has none.
        self.library, self.odd, self.agrees = None, set(), []

    def _runs(self) -> list[str]:
        """Patterns of segments: spaces and then characters of one kind, where two characters are
        of one kind if some piece holds them side by side, directly or through others."""
        kind: dict[str, str] = {}

        def root(c):
            while kind.setdefault(c, c) != c:
                c = kind[c]
            return c

        for p in self.order:
            for a, b in zip(p, p[1:]):
                if b != SPACE:
                    kind[root(b)] = root(b if a == SPACE else a)
        kinds: dict[str, list[str]] = {}
        for c in sorted(kind):
            kinds.setdefault(root(c), []).append(re.escape(c))
        chars = ["".join(k) for k in kinds.values()]
        return [f"{SPACE}*[{k}]+" for k in chars] + [f"{SPACE}+", f"[^{SPACE}{''.join(chars)}]+"]

    def merge(self, segment: str) -> list[str]:
        """The segment's final symbols, by the agenda."""
        sym, n, order = list(segment), len(segment), self.order.get
        agenda = [e + (k << 8) for k, pair in enumerate(map(str.__add__, sym, sym[1:])) if (e := order(pair))]
        if not agenda:
            return sym
        if n >= 1 << 32:
            raise ValueError("a segment of 2**32 characters or more")
        agenda.sort()  # a heap from the start
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            entry = pop(agenda)
            i = entry >> 8 & 0xFFFFFFFF
            j = after[i]
            if j >= n or not sym[i]:
                continue
            joined = sym[i] + sym[j]
            if len(joined) != entry & 255:
                continue  # one of the two has been joined to something since
            sym[i] = joined
            sym[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if e := order(joined + sym[k]):
                    push(agenda, e + (i << 8))
            if i:
                h = before[i]
                if e := order(sym[h] + joined):
                    push(agenda, e + (h << 8))
        return [s for s in sym if s]

    def _learned(self, segment: str) -> bytes:
        """Ids of a segment met for the first time."""
        get = self.packed.get
        coded = [get(s) or b"".join(map(self.byte_packed.__getitem__, s.encode())) for s in self.merge(segment)]
        self.known[segment] = out = b"".join(coded)
        return out

    def _coded(self, spaced: str) -> bytes:
        """Ids of a text written with U+2581, cut into segments, each merged once."""
        known, learned = self.known, self._learned
        parts = self.cut.findall(spaced) if self.cut else [spaced]
        return b"".join([known[s] if s in known else learned(s) for s in parts])

    def _words(self, text: str) -> list[str] | None:
        """The text's words without the one space before each (further spaces stay); none where
        spaces written as U+2581 may join across words."""
        if not text or not self.cut or SPACE in text:
            return None
        words = text.split(" ")
        return words if "" not in words else [w[1:] for w in _SPACED.findall(" " + text)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text without begin and end, as little-endian unsigned 32-bit integers."""
        for memory in (self.known, self.words):
            if len(memory) > REMEMBERED:
                memory.clear()
        parts = [self._words(t) for t in texts]
        new = list(set().union(*filter(None, parts)).difference(self.words))
        for word in new:
            self.words[word] = self._coded(SPACE + word.replace(" ", SPACE))
        get = self.words.__getitem__
        coded = [b"".join(map(get, p)) if p else self._coded(SPACE + t.replace(" ", SPACE)) if t else b"" for p, t in zip(parts, texts)]
        if self.library is None:
            return coded
        new = [w for w in new if w]  # the library takes no space alone, so texts that end in one are checked whole
        whole = [k for k, p in enumerate(parts) if not p or not p[-1]]
        theirs = self.library.encode(new + [texts[k] for k in whole], num_threads=1)
        self.odd.update(w for w, ids in zip(new, theirs) if struct.pack(f"<{len(ids)}I", *ids) != get(w))
        self.agrees = [not self.odd or self.odd.isdisjoint(p or ()) for p in parts]
        for k, ids in zip(whole, theirs[len(new) :]):
            self.agrees[k] = struct.pack(f"<{len(ids)}I", *ids) == coded[k]
        return coded

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes joined, the space added before the text removed."""
        lead = 0
        while lead < len(ids) and ids[lead] in self.control:
            lead += 1
        drop = int(lead < len(ids) and ids[lead] not in self.byte_of and ids[lead] != self.unknown and self.names[ids[lead]].startswith(SPACE))
        surface = list(map(self.surface.__getitem__, ids))
        try:
            return b"".join(surface).decode()[drop:]
        except UnicodeDecodeError:  # not from encode(): each byte that starts no character reads as U+FFFD
            return self._repaired(ids, surface)[drop:]

    def _repaired(self, ids: list[int], surface: list[bytes]) -> str:
        out, run = [], b""
        for i, part in zip([*ids, -1], [*surface, b""]):
            if i in self.byte_of:
                run += part
                continue
            while run:
                for size in range(1, 5):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                run = run[size:]
            out.append(part.decode())
        return "".join(out)


@lru_cache(maxsize=1)
def _library(content: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=content)


@lru_cache(maxsize=2)
def tokenizer(content: bytes, checked: bool = False) -> PieceTokenizer:
    """A worker's tokenizer; a ``checked`` one compares its words with the library's."""
    tok = PieceTokenizer(content)
    tok.library = _library(content) if checked else None
    return tok


def load(path: str) -> bytes:
    """A model file's content (bounded: a vocabulary of some 0.5 MB)."""
    with open(path, "rb") as f:
        return f.read()


CHECKS = (None, "words", "texts")


def encode_decode(docs: DataFrame, content: bytes, with_ids: bool = False, check: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens with begin and end, sha256 of ids and of the
    decoded text; with ``with_ids`` the ids. ``check`` adds whether the sentencepiece library
    agrees, Arrow batch by Arrow batch: "words" gives it every word when a worker first meets it
    (and whole texts that are no sequence of words), "texts" gives it every whole text and
    compares the decoded text as well. ``content``: see load(), broadcast once."""
    if check not in CHECKS:
        raise ValueError(f"check is one of {CHECKS}")
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        tok = tokenizer(shared.value, check == "words")
        begin, end = (struct.pack("<I", i) for i in (tok.bos, tok.eos))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            coded = [begin + c + end for c in tok.encode_batch(texts)]
            ids = [np.frombuffer(c, "<u4").tolist() for c in coded]
            decoded = list(map(tok.decode, ids))
            cols = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array(list(map(len, ids)), pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
            }
            if with_ids:
                cols["ids"] = pa.array(ids, pa.list_(pa.int64()))
            if check == "words":
                cols["agrees"] = pa.array(tok.agrees, pa.bool_())
            elif check:
                lib = _library(shared.value)
                theirs = lib.encode(texts, add_bos=True, add_eos=True, num_threads=1)
                back = lib.decode(theirs, num_threads=1) if theirs else []
                cols["agrees"] = pa.array([a == b and c == d for a, b, c, d in zip(ids, theirs, decoded, back)], pa.bool_())
            yield pa.RecordBatch.from_pydict(cols)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += (", ids array<long>" if with_ids else "") + (", agrees boolean" if check else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
