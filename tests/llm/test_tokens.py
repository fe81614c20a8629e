"""Token counts against two tokenizer libraries, whole and split texts, ties and unknowns."""

from __future__ import annotations

import random

import pytest

from tests.llm import edge
from tillsight.llm import tokencount
from tillsight.llm.tokencount import MARK, Counter, Vocabulary, read_vocabulary


def library(vocabulary: Vocabulary):
    """The same model in the tokenizers library: it gets marked text and does not split it."""
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    pieces = [("<unk>", min(0.0, vocabulary.least)), *vocabulary.pieces]
    if vocabulary.byte_fallback:
        pieces += [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    model = Tokenizer(Unigram(pieces, 0, vocabulary.byte_fallback))
    return lambda t: len(model.encode(MARK + t.replace(" ", MARK), add_special_tokens=False).ids) if t else 0


TEXTS = [t or "" for _, t, *_ in edge.documents()] + [
    "a", " ", "  ", " a", "a ", "a  b", "   lead and trail   ", "x" * 500, "née \U0001f600\U0001f600 日本語 ▁ a▁b ▁▁", "\n\n\t tab", "١٢٣",
]


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary()


def test_against_library(vocabulary):
    want, counter = library(vocabulary), Counter(vocabulary)
    for t in TEXTS:
        assert counter.tokens(t) == want(t), t[:60]


def test_against_sentencepiece(vocabulary):
    """The file's pieces as a unigram model of that library. It sums in single precision, so
    texts are short and the score of -1e9 that one piece has is set to -40000."""
    model = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor

    proto = model.ModelProto()
    with open(tokencount.VOCABULARY, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40000.0)
    sp = SentencePieceProcessor(model_proto=proto.SerializeToString())
    counter = Counter(Vocabulary([(p, max(s, -40000.0)) for p, s in vocabulary.pieces], -40000.0, True))
    for t in TEXTS:
        if len(t) < 500:
            assert counter.tokens(t) == len(sp.encode(t)), t


@pytest.mark.parametrize("fallback", [False, True])
def test_ties_and_unknowns(fallback):
    r = random.Random(1)
    for _ in range(40):
        pieces = {"".join(r.choice("abc" + MARK) for _ in range(r.randint(1, 4))): float(-r.randint(0, 3)) for _ in range(12)}
        vocabulary = Vocabulary(sorted(pieces.items()), min(pieces.values()), fallback)
        want, counter = library(vocabulary), Counter(vocabulary)
        for _ in range(40):
            t = "".join(r.choice("abcdé ") for _ in range(r.randint(0, 30)))
            assert counter.tokens(t) == want(t), (pieces, t)


def test_slices_and_full_table(vocabulary, monkeypatch):
    counter = Counter(vocabulary)
    want = [counter.tokens(t) for t in TEXTS]
    monkeypatch.setattr(tokencount, "SLICE", 7)
    monkeypatch.setattr(tokencount, "KEPT", 5)
    assert [Counter(vocabulary).tokens(t) for t in TEXTS] == want


def test_rows(spark, vocabulary):
    docs = edge.frame(spark)
    counter = Counter(vocabulary)
    got = tokencount.token_counts(docs, vocabulary)
    assert got.columns == ["doc_id", "n_tokens"]
    key = lambda r: (r[0] is None, r)
    want = [(i, counter.tokens(t)) for i, t, *_ in edge.documents()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert tokencount.token_counts(edge.frame(spark, []), vocabulary).count() == 0
