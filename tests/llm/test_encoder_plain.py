"""Words of letters go to the model by the short way, and ids are still those of whole texts."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from strata.llm.tokens import Encoder

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")
BITS = ["a", "The", "Straße", "ÜBER", "ΣΟΦΟΣ", "İstanbul", "été", "́x", "ﬁne", "日本語", "it's", "'s", "don't",
        "<|endoftext|>", "<|", "|>", "x<|y", "...", "?!", "word.", "(see)", "<b>", "3.14", "²", "ª", "ǅ", "ŉ", "K",
        " ", "  ", "\n", "\n\n", "\r\n", "\t", " ", " ", "\x85", "\x1c", "​", "", "\U0001f600", "q" * 70]


@pytest.mark.parametrize("name", NAMES)
def test_ids_of_odd_texts_are_whole(name):
    rng = random.Random(7)
    encoder = Encoder(public_tokenizers.path(name), cached=40)
    assert encoder.plain is not None
    texts = [None, "", " ", "\n", " a", "a ", "\na", "a\n", *BITS, *(
        "".join(rng.choice(BITS) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(1, 9)))
        for _ in range(3000))]
    want = [w if t else b"" for t, w in zip(texts, encoder.whole([t or "" for t in texts]))]
    for i in range(0, len(texts), 100):
        assert encoder.encode(pa.array(texts[i:i + 100], pa.string())) == want[i:i + 100]
        assert encoder.encode(texts[i:i + 100]) == want[i:i + 100]
    assert encoder.encode([]) == [] == encoder.encode(pa.array([], pa.string()))


@pytest.mark.parametrize("name", NAMES)
def test_words_of_letters_take_the_short_way(name):
    encoder, seen = Encoder(public_tokenizers.path(name)), []
    whole = encoder.whole
    encoder.whole = lambda texts: seen.extend(texts) or whole(texts)
    text = "Some words, and Übermut.\nNew lines of Words? " * 3 + "end"
    assert encoder.encode([text]) == whole([text])
    long = [x for x in seen if sum(c.isalpha() for c in x) > 4]  # a first part, one across a line end
    assert len(long) <= (0 if encoder.drops else 1)
    assert encoder.drops == (name == NAMES[0])
