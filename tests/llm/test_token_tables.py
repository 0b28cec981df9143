"""The tables of op4's encoder are emptied apart."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from vitalwatch.llm import tokens
from vitalwatch.llm.tokens import Encoder, Places


def test_parts_stay_when_the_words_go():
    path = public_tokenizers.path("word_bpe_49k.json")
    letters = "abcdefghij"
    runs = [x + y + z for x in letters for y in letters for z in "klm"]
    texts = [" ".join(f"{a}-{b}" for b in runs[:200]) + " Été naïve l'eau <s> ABC ab1c  x" for a in runs[:60]]
    small, asked = Encoder(path, most=1000), []
    library = small._library
    small._library = lambda some: asked.append(len(some)) or library(some)
    for text in texts:
        ids, lengths = small.encode([text])
        want = small.load().encode(text, add_special_tokens=False).ids
        assert np.array_equal(ids, want) and lengths.tolist() == [len(want)]
    assert len(small.words) <= 1000 + 210  # emptied many times over
    assert sum(asked) < 300  # each run went through the library once


def test_a_word_of_many_texts_is_looked_up_once():
    class Counted(Places):
        asked = 0

        def __getitem__(self, text):
            self.asked += 1
            return super().__getitem__(text)

    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.words = Counted()
    texts = pa.array(["the cat, the dog", None, "", "the cat\x0bsat \xa0 on\tthe  mat. ", "don't <b> Straße. 12"] * 50)
    for column in (texts, texts.filter(pc.invert(pc.match_substring(texts.fill_null(""), "\x0b")))):
        encoder.words.asked = 0
        ids, lengths = encoder.encode(column)
        want = [encoder.load().encode(t or "", add_special_tokens=False).ids for t in column.to_pylist()]
        assert ids.tolist() == [i for w in want for i in w] and lengths.tolist() == [len(w) for w in want]
        assert encoder.words.asked < 20  # 750 times when each place of a text was looked up


def test_runs_of_texts_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "SOME_BYTES", 10)
    texts = pa.array(["a" * 4, None, "b" * 6, "c" * 30, "", "d" * 5, "e" * 6])
    assert list(tokens.some(texts)) == [(0, 3), (3, 1), (4, 2), (6, 1)]
    assert list(tokens.some(texts.slice(3, 2))) == [(0, 1), (1, 1)]
    monkeypatch.setattr(tokens, "SOME", 2)
    assert list(tokens.some(texts)) == [(0, 2), (2, 1), (3, 1), (4, 2), (6, 1)]
