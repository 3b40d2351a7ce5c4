import random
import time

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from spanfold.llm import sentencepieces
from spanfold.llm.queries import piece_model

ALPHABET = "ab  c\n\t é▁xthe ing ößЖ中\U0001d4d3\x00'"


@pytest.fixture(scope="module")
def model():
    return piece_model()


@pytest.fixture(scope="module")
def texts(small_docs):
    chance = random.Random(2)
    odd = ["".join(chance.choice(ALPHABET) for _ in range(chance.randint(0, 40))) for _ in range(500)]
    return [r.text for r in small_docs.limit(60).collect()] + odd + ["", " ", "   ", "a" * 500, " " * 100 + "x"]


def test_ids_of_the_library(model, texts):
    library = sentencepiece.SentencePieceProcessor(model_proto=model.file)
    found = sentencepieces.TextEncoder(model).encode(texts)
    assert [f.tolist() for f in found] == [library.encode(t) for t in texts]
    decoder = sentencepieces.TextDecoder(model)
    assert [decoder.decode(f) for f in found] == [t.replace("▁", " ") for t in texts]


@pytest.mark.parametrize("run", [" ", "\t", "▁", "  x", "a "])
def test_long_runs(model, run):
    """A million characters of one kind, in seconds."""
    text = "word" + run * (1_000_000 // len(run)) + "end"
    library = sentencepiece.SentencePieceProcessor(model_proto=model.file)
    began = time.process_time()
    (found,) = sentencepieces.TextEncoder(model).encode([text])
    assert time.process_time() - began < 60
    assert found.tolist() == library.encode(text)


def test_merging_in_order(model):
    """The heap merges as a scan over all pairs does."""
    encoder = sentencepieces.WordEncoder(model)
    chance = random.Random(8)

    def scanned(word):
        parts = list(word)
        while True:
            fits = [
                (-model.scores[model.ids[a + b]], n) for n, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                if a + b in model.ids
            ]
            if not fits:
                return parts
            at = min(fits)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    for _ in range(400):
        word = "".join(chance.choice("▁▁ateinrs0=-") for _ in range(chance.randrange(1, 30)))
        assert encoder._merged(word) == scanned(word)


def test_unigram_score_is_the_best(model):
    proto = sentencepiece_model_pb2.ModelProto.FromString(model.file)
    proto.trainer_spec.model_type = 1
    unigram = sentencepieces.parse(proto.SerializeToString())
    words = sorted({"▁the", "▁there", "▁thereby", "▁houses", "▁überaus", "▁xyz"})

    def best(word):
        score = {0: 0.0}
        for end in range(1, len(word) + 1):
            score[end] = max(
                score[begin] + unigram.scores[unigram.ids[word[begin:end]]]
                for begin in range(end) if word[begin:end] in unigram.ids
            )
        return score[len(word)]

    for word, ids in sentencepieces.WordEncoder(unigram).encode(words):
        assert sum(unigram.scores[i] for i in ids) == best(word)


def test_forgetting_changes_nothing(model, texts, monkeypatch):
    whole = [f.tolist() for f in sentencepieces.TextEncoder(model).encode(texts)]
    monkeypatch.setattr(sentencepieces, "REMEMBERED_BYTES", 10_000)
    monkeypatch.setattr(sentencepieces, "REMEMBERED_PAIRS", 20)
    encoder = sentencepieces.TextEncoder(model)
    assert [encoder.encode([t])[0].tolist() for t in texts] == whole


def test_edge_cases(edge_docs, no_docs, model):
    encoded = sentencepieces.encode(edge_docs, model, same="same")
    decoded = sentencepieces.decode(encoded, model).collect()
    assert len(decoded) == edge_docs.count()
    for row in decoded:
        assert row.decoded == row.text and row.same is (None if row.text is None else True)
        assert row.ids is None if row.text is None else (row.text != "" or row.ids == [])
    assert sentencepieces.encode(no_docs, model).count() == 0
