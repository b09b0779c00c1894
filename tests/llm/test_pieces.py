"""Piece encoding against the sentencepiece library, alignment against a plain loop."""

import collections
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skiff.llm import align, bpe, piece_bpe
from skiff.llm.queries import op12_sentencepiece, op13_alignment, vocabulary

SF = "/root/testdata/sf0.01"
TEXTS = st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("abthe  ▁\n\t.,'é中<s>\x00")), max_size=60)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.load(vocabulary("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tokenizer(model):
    return piece_bpe.PieceTokenizer(model)


@pytest.fixture(scope="module")
def library(model):
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_proto=model)


def coded(tokenizer, text):
    return np.frombuffer(tokenizer.encode_batch([text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_equal_library(tokenizer, library, text):
    ids = coded(tokenizer, text)
    assert ids == library.encode(text)
    assert tokenizer.decode([1, *ids, 2]) == library.decode([1, *ids, 2])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 270), st.integers(0, 31_999)), max_size=20))
def test_any_ids_decode_as_the_library_does(tokenizer, library, ids):
    assert tokenizer.decode(ids) == library.decode(ids)


def test_long_segments_and_runs_of_spaces(tokenizer, library):
    for text in ("the" * 60_000, "z" * 100_000, " " * 5_001, "a" + "  " * 900 + "b ", "▁▁ ▁x ▁", "one\n\n two  three "):
        assert coded(tokenizer, text) == library.encode(text)


def test_cuts_change_nothing(tokenizer, model):
    """Merging the whole text as one segment gives the same symbols."""
    whole = piece_bpe.PieceTokenizer(model)
    whole.cut = None
    for text in ("Hello, wor-ld! I'm (not) 42 years.", "Привет, мир 中文 取 ok", "x  y   z.\n\tq"):
        assert coded(tokenizer, text) == coded(whole, text)


def test_other_models_are_refused(model):
    with pytest.raises(ValueError):
        piece_bpe.PieceTokenizer(model[: len(model) // 2])


def test_piece_rows(spark, awkward, nothing, model, library):
    rows = piece_bpe.encode_decode(awkward, model, with_ids=True, check="texts").collect()
    texts = awkward.collect()
    assert len(rows) == len(texts) and all(r.agrees for r in rows)
    for r, t in zip(rows, texts):
        want = library.encode(t.text or "", add_bos=True, add_eos=True)
        assert (r.doc_id, r.ids, r.n_tokens) == (t.doc_id, want, len(want))
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()
    words = piece_bpe.encode_decode(awkward, model, check="words").collect()
    assert [r.ids_sha256 for r in words] == [r.ids_sha256 for r in rows] and all(r.agrees for r in words)
    for check in piece_bpe.CHECKS:
        assert piece_bpe.encode_decode(nothing, model, check=check).count() == 0


def test_op12_agrees_with_the_library_on_every_document(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = piece_bpe.encode_decode(docs, model, check="texts")
    by_word = op12_sentencepiece(spark, SF)
    assert whole.where("agrees").count() == by_word.where("agrees").count() == docs.count()
    assert by_word.drop("agrees").exceptAll(whole.drop("agrees")).count() == 0


def test_a_word_that_differs_is_reported(model):
    tok = piece_bpe.PieceTokenizer(model)

    class Other:
        def encode(self, texts, num_threads):
            return [[7] if t in ("strange", "a\u2581b") else np.frombuffer(piece_bpe.PieceTokenizer.encode_batch(tok_plain, [t])[0], "<u4").tolist() for t in texts]

    tok_plain, tok.library = piece_bpe.PieceTokenizer(model), Other()
    tok.encode_batch(["a strange text", "a text", "", "a\u2581b"])
    assert tok.agrees == [False, True, True, False]
    tok.encode_batch(["no", "strange"])
    assert tok.agrees == [True, False]


# ------------------------------------------------------------------ alignment
def plain_alignment(texts, model):
    """The contract's columns for each text, by plain loops over the two libraries' tokens."""
    tokenizers, sentencepiece = pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")
    side_a = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_proto=model)
    byte_of = bpe._alphabet()

    def piece(p):
        code = re.fullmatch("<0x(..)>", p)
        return bytes([int(code[1], 16)]) if code else p.replace("▁", " ").encode()

    found, held = [], collections.Counter()
    for text in texts:
        groups = None
        if text:
            a = side_a.encode(" " + text, add_special_tokens=False)
            ids = [a.ids, side_b.encode(text)]
            parts = [[bytes(byte_of[c] for c in t) for t in a.tokens], [piece(side_b.id_to_piece(i)) for i in ids[1]]]
            if all(b"".join(p) == (" " + text).encode() for p in parts):
                ends = [np.cumsum(list(map(len, p))).tolist() for p in parts]
                groups, at = [], [0, 0]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    to = [sum(e <= cut for e in side) for side in ends]
                    groups.append([ids[k][at[k] : to[k]] for k in (0, 1)])
                    at = to
        links = collections.Counter((x, y) for a, b in groups or [] for x in a for y in b)
        held.update(links.keys())
        found.append((groups, links))
    best = collections.Counter()
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for groups, links in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        out.append((sum(len(g[0]) for g in groups or []), sum(len(g[1]) for g in groups or []), len(groups or []), sum(links.values()),
                    sum(m for p, m in links.items() if held[p] == best[p[0]]), sum(m * held[p] for p, m in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def same_as_plain(rows, docs, model):
    want = plain_alignment([d.text for d in docs], model)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows), key=key) == sorted(((d.doc_id, *w) for d, w in zip(docs, want)), key=key)


def test_alignment_of_awkward_rows(spark, awkward, nothing, model, monkeypatch):
    odd = spark.createDataFrame(
        [(20, "has ▁ inside"), (21, " " * 3_000 + "x"), (22, "<s> and <|endoftext|> are text"), (23, "naïve 中文 \U0001f642\n\n  tabs\t"), (24, " ")],
        "doc_id long, text string")
    docs = awkward.select("doc_id", "text").union(odd).cache()
    content = bpe.load(vocabulary("byte_bpe_50k.json"))
    same_as_plain(align.align(docs, content, model).collect(), docs.collect(), model)
    assert align.align(nothing, content, model).count() == 0
    # small blocks, and groups expanded by distinct ids, give the same
    monkeypatch.setattr(align, "BLOCK_BYTES", 100)
    aligner = align.Aligner(content, model)
    usual = aligner.align(["a" + " " * 999 + "b", "plain words"])
    monkeypatch.setattr(align, "MANY_LINKS", 0)
    for x, y in zip(usual[1:], aligner.align(["a" + " " * 999 + "b", "plain words"])[1:]):
        assert x.tolist() == y.tolist()


def test_op13_equals_plain_loops(spark, model):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    same_as_plain(op13_alignment(spark, small).collect(), docs, model)
