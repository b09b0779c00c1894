"""BPE, secrets, quality and toxicity: library, brute force and held-out accuracy."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skiff.llm import bpe, quality, secrets, toxicity
from skiff.llm.queries import op2_toxicity, op5_secrets, op6_quality, tokenizer_content, vocabulary

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.BpeTokenizer(tokenizer_content())


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab 's\n\t_1<|>²\x1c")), max_size=60))
def test_bpe_equals_library(tokenizer, library, text):
    ids = np.frombuffer(tokenizer.encode_batch([text])[0], "<u4")
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert tokenizer.decode(ids) == text


def test_bpe_rows(spark, awkward, nothing, library):
    rows = bpe.encode_decode(awkward, tokenizer_content(), with_ids=True).collect()
    texts = awkward.collect()
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts):
        want = library.encode(t.text or "", add_special_tokens=False).ids
        assert (r.doc_id, r.ids, r.n_tokens) == (t.doc_id, want, len(want))
        assert r.decoded_sha256 == hashlib.sha256((t.text or "").encode()).hexdigest()
    assert bpe.encode_decode(nothing, tokenizer_content()).count() == 0


def base_spans(text):
    """The contract's patterns, searched plainly."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secrets_base_spans(spark, awkward):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op5_secrets(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        spans = base_spans(d.text or "")
        r = got[d.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(secrets.written(spans).encode()).hexdigest()
        assert set(secrets.written(spans).split(",")) <= set(r.spans.split(","))
    assert secrets.find_secrets(awkward).count() == awkward.count()


def test_lexer_propagates_names_and_redacts(awkward):
    text = 'base = "Zx81kQ9vTTe2"\nmyToken = base + "tail88AA"\nport: 5432\npassword = changeme\n'
    assert [text[a:b] for a, b in secrets.lex(text)] == ["Zx81kQ9vTTe2", "tail88AA"]
    assert "hunter2" not in secrets.redact_text("password = hunter2xyz")
    kept = secrets.redact(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


@pytest.mark.parametrize("query, label", [(op6_quality, "quality"), (op2_toxicity, "toxic")])
def test_classifiers_held_out(spark, query, label):
    rows = query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r[label] for r in rows])
    assert len(rows) > 300 and right > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_classifiers_without_labels_and_awkward_rows(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        model = module.fit(awkward, none)
        assert module.score_frame(awkward, model).count() == awkward.count()
        assert module.score_frame(nothing, model).count() == 0
    assert quality.keep_good(awkward, quality.fit(awkward, none), 0.5).columns == awkward.columns


def test_misspellings_share_grams():
    import pyarrow as pa

    texts = [f"the river is {'stupid idiot' if k % 3 == 0 else 'calm water'} number{k}" for k in range(300)]
    model = toxicity.fit_texts(pa.array(texts), np.array([int(k % 3 == 0) for k in range(300)]))
    from skiff.llm.common import text_pieces

    _, raw, off = next(text_pieces(pa.array(["such a stupiid idioot", "calm waters here"])))
    bad, good = model.score_texts(raw, off)
    assert bad > 0.5 > good


def test_tree_scores_equal_a_plain_descent():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)).round(1)  # many ties at thresholds
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0.3).astype(float)
    model = quality.BoostedTrees(trees=12, depth=3).fit(x, y)

    def descend(row):
        total = model.start
        for feature, threshold, value in zip(model.feature, model.threshold, model.value):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node - (2**model.depth - 1)]
        return 1 / (1 + np.exp(-total))

    fresh = np.concatenate([x, rng.normal(size=(100, 5)), np.full((1, 5), 1e9), np.full((1, 5), -1e9)])
    np.testing.assert_allclose(model.score(fresh), [descend(r) for r in fresh], rtol=1e-12)
    assert len(model.score(np.zeros((0, 5)))) == 0


def test_passage_scores_equal_a_plain_loop():
    import pyarrow as pa

    from skiff.llm.common import text_pieces

    rng = np.random.default_rng(4)
    model = toxicity.SubwordSoftmax()
    model.constant, model.bias, model.word = None, -1.5, rng.normal(size=toxicity.BUCKETS)
    texts = ["", " \n ", "one", "Stupid " * 3, " ".join(f"w{k % 13}ord{k % 5}" for k in range(50)), "ünïcode wörds and <tags>", None]
    _, raw, off = next(text_pieces(pa.array(texts)))

    def word_score(word):
        data = np.frombuffer(word, np.uint8)
        grams, first = toxicity.word_grams(data, np.array([0]), np.array([len(data)]))
        return model.word[grams].mean()

    want = []
    for t in texts:
        s = [word_score(w) for w in re.findall(rb"[^ \t\n\x0b\x0c\r]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))]
        parts = [s[k : k + toxicity.PASSAGE] for k in range(0, len(s), toxicity.PASSAGE)]
        best = max((sum(p) / max(len(p), min(toxicity.PASSAGE, len(s))) for p in parts), default=0.0)
        want.append(1 / (1 + np.exp(-(model.bias + best))))
    np.testing.assert_allclose(model.score_texts(raw, off), want, rtol=1e-9)
