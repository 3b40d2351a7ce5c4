import random

import numpy as np

from spanfold.llm import minhash, passages


def laid(seed):
    """Words of 1 to 30 bytes of any value, blanks of all six kinds around and between them."""
    chance = random.Random(seed)
    blanks = b" \t\n\x0b\x0c\r"
    letters = [b for b in range(256) if b not in blanks]
    gaps = [bytes(chance.choices(blanks, k=chance.randint(1, 3))) for _ in range(3000)]
    return b"".join(g + bytes(chance.choices(letters, k=chance.randint(1, 30))) for g in gaps)


def test_placed_words_are_those_of_split():
    for data in (laid(1), laid(2) + b" \n", b"one", b" ", b""):
        starts, ends = minhash.word_places(data)
        assert [data[b:e] for b, e in zip(starts, ends, strict=True)] == data.split()


def test_placed_hashes_are_those_of_words():
    for data in (laid(3), laid(4) + b" \n", b"one", b" ", b""):
        found = minhash.placed_hashes(data, *minhash.word_places(data))
        assert found.dtype == np.uint64 and (found == minhash.word_hashes(data.split())).all()


def test_short_words_of_passages_are_hashed_together(monkeypatch):
    texts = [laid(5), "Grüße aus dem Wald. ".encode() * 40]
    expected = minhash.word_hashes(b"\n".join(texts).split())
    one_by_one = []
    by_word = minhash._word_hash
    monkeypatch.setattr(minhash, "_word_hash", lambda w: one_by_one.append(w) or by_word(w))
    words = passages.laid_out(texts, passages.WORDS)
    assert (words.hashes == expected).all()
    assert one_by_one and all(len(w) > 16 for w in one_by_one)


def test_code_points_of_words():
    texts = ["Grüße  aus 中文 \U0001d4d3 é".encode(), b"", b"plain words", "ß".encode()]
    words = passages.laid_out(texts, 1)
    every = np.arange(len(words.starts))
    spans = zip(words.owner, words.begin(every), words.stop(every), strict=True)
    assert [texts[t].decode()[b:e] for t, b, e in spans] == [w for t in texts for w in t.decode().split()]
