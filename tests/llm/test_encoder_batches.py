"""The encoder's work per batch: distinct parts are sought once, and ids are those of whole texts."""

import public_tokenizers

from strata.llm.tokens import Encoder

TEXTS = ["a word and a word again", None, "", " ", "one", "one  two", "end. and, (more) it's 12 3.5 Ünï İstanbul",
         "x <|endoftext|> y", "line\nbreak here", "a word and a word again " * 50]


class Counted(dict):
    sought = 0

    def get(self, *a):
        self.sought += 1
        return dict.get(self, *a)


def test_distinct_parts_are_sought_once_and_ids_are_whole():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = Encoder(public_tokenizers.path(name), cached=20)
        want = [w if t else b"" for t, w in zip(TEXTS, encoder.whole([t or "" for t in TEXTS]))]
        for _ in range(3):  # the later rounds find parts known, or dropped
            encoder.later = Counted(encoder.later)
            held = encoder.later
            assert encoder.encode(TEXTS) == want
            assert held.sought <= len({p for t in TEXTS if t for p in t.split(" ")})
