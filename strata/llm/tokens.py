"""Token ids of whole texts by a tokenizer file, with each distinct word encoded once.

A tokenizer that cuts text into words before its merges gives a text the ids of its parts, if the
text is cut at a single blank between two characters that are not white space. So texts are cut
there, each distinct part (with its blank) goes through the tokenizer once, and ids are joined.
Texts with other blanks, or that may hold a special token, are encoded as a whole. A tokenizer that
drops blanks and takes line ends for them gives the ids of its parts at any of both.

New parts are encoded many at a time: a part that the tokenizer's own normalising leaves as letters
is one word, possibly with end punctuation, which is a word of its own. (Where it makes marks of
letters, as of a dotted capital I, marks and punctuation may be one word: such parts go through
whole.) The ids of a line of such words fall apart again at the
tokens that begin a word (they hold the blank) or end one (by the model's suffix). Where the tokenizer
cuts a line of words only at its blanks and hands their bytes to the model, the line goes to a tokenizer
of the same model that does just this: most of the time of the whole one is for rules that words of
letters never meet.
"""

from __future__ import annotations

import codecs
import functools
import json
import os
import string
from itertools import compress, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts kept in a Python worker's memory (about 200 bytes each). Beyond it, those of the current batch
#: stay, which holds the frequent ones.
CACHED = 500_000
_BLOCK = 4000  # words encoded as one line
_ENDS = string.punctuation.replace("'", "")
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = iter(range(256, 512))
#: How byte-level vocabularies write each byte; a blank stays one here, between words.
_BYTES = "".join(chr(b if b in _KEPT else next(_OTHERS)) for b in range(256)).replace("Ġ", " ")
_PROBE = ["a", string.ascii_letters, "Hello", "WORLD", "internationalisation", "Straße", "ÀÉÎÕÜ",
          "naïveté", "żółć", "Ελληνικά", "Привет", "日本語", "한국어", "العربية", "ﬁne"]


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


@functools.cache
def encoder_of(path: str) -> Encoder:
    """One encoder per Python worker: a worker's later tasks find the frequent parts known. What
    is remembered never changes an id, so a lost worker costs only the time to learn again."""
    return Encoder(path)


class Encoder:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        normalizer = self.tokenizer.normalizer
        self.normalize = normalizer.normalize_str if normalizer is not None else None
        self.cached = cached
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.at_end = bool(suffix)
        self.edge = np.zeros(max(vocab.values(), default=0) + 1, bool)
        blank = "Ġ"  # how byte-level vocabularies write a blank
        self.edge[[i for t, i in vocab.items()
                   if (t.endswith(suffix) if suffix else t.startswith(blank))]] = True
        #: blanks and line ends only part words: the tokenizer's own normalising makes them one blank
        self.drops = (self.at_end and self.normalize is not None
                      and self.normalize("a\n b  c\n\nd") == "a b c d"
                      and len({*self.whole(["a b", " a b", "a b ", "a\nb"])}) == 1)
        self.plain, self.lowers = None, False
        if self._cuts_bytes():
            self.plain = self._plain()
            if self._line(_PROBE) != self.tokenizer.encode_batch_fast(
                    [" " + " ".join(_PROBE)], add_special_tokens=False)[0].ids:
                self.plain = None

    def _cuts_bytes(self) -> bool:
        """Whether words reach the model as their bytes, and it always merges them alike."""
        spec = json.loads(self.tokenizer.to_str())
        cut, model = spec["pre_tokenizer"] or {}, spec["model"]
        last = cut.get("pretokenizers", [cut])[-1]
        change = spec["normalizer"] or {}
        steps = change.get("normalizers", [change])
        blanks = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        #: what normalising does to ASCII letters that single blanks part
        self.lowers = any(x.get("type") == "Lowercase" for x in steps) and all(
            x.get("type") in ("Lowercase", "NFC", "NFKC") or x == blanks for x in steps)
        return (last.get("type") == "ByteLevel" and not last["add_prefix_space"]
                and model["type"] == "BPE" and not model["dropout"])

    def _plain(self):
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer(self.tokenizer.model)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return plain

    def _letters(self, words) -> list[bool]:
        """Whether the tokenizer sees letters only, for words of letters beyond ASCII."""
        if self.normalize is None:
            return [True] * len(words)
        seen = self.normalize(" ".join(words)).split(" ")
        if len(seen) != len(words):
            seen = map(self.normalize, words)
        return [x.isalpha() for x in seen]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _line(self, words: list[str]) -> list[int]:
        """Ids of words of letters, each with a blank in front, in a row."""
        line, by = " ".join(words), self.plain
        if by is None:
            line, by = " " + line, self.tokenizer
        else:
            if self.lowers and line.isascii():
                line = line.lower()
            elif self.normalize is not None:
                line = self.normalize(line)
            line = codecs.charmap_decode(line.encode(), "strict", _BYTES)[0]
            if not self.at_end:
                line = "Ġ" + line.replace(" ", " Ġ")
        return by.encode_batch_fast([line], add_special_tokens=False)[0].ids

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, each with a blank in front."""
        out = []
        for i in range(0, len(words), _BLOCK):
            some = words[i:i + _BLOCK]
            ids = np.array(self._line(some), "<u4")
            at = np.flatnonzero(self.edge[ids])
            if len(at) == len(some):  # then each word has just one such token
                cut = [0, *((at + 1) * 4).tolist()] if self.at_end else \
                    [*(at * 4).tolist(), 4 * len(ids)]
                raw = ids.tobytes()
                out += [raw[a:z] for a, z in zip(cut, cut[1:])]
            else:
                out += self.whole([" " + w for w in some])
        return out

    def _learn(self, new: list[str]) -> None:
        have = self.later
        parts = pa.array(new, pa.large_string())
        stems = pc.utf8_rtrim(parts, _ENDS)
        plain = pc.and_not(pc.ascii_is_alpha(stems), pc.match_substring(parts, "<|"))
        end = pc.and_(plain, pc.not_equal(parts, stems))
        words, wide, other = _strings(parts.filter(pc.and_not(plain, end))), [], []
        ended = list(zip(_strings(parts.filter(end)), _strings(stems.filter(end))))
        have.update(zip(words, self._words(words)))
        for p in _strings(parts.filter(pc.invert(plain))):
            stem = p.rstrip(_ENDS)
            if stem.isalpha() and "<|" not in p:
                wide.append((p, stem))
            elif not p:
                have[p] = b"" if self.drops else None
            elif p[0].isspace() or p[-1].isspace() or "<|" in p:
                have[p] = None  # not a safe place to cut
            else:
                other.append(p)
        for i in range(0, len(wide), _BLOCK):
            some = wide[i:i + _BLOCK]
            seen = self._letters([stem for _, stem in some])
            ended += compress(some, seen)
            other += [p for (p, _), letters in zip(some, seen) if not letters]
        stems = sorted({stem for _, stem in ended}.difference(have), key=str.isascii)
        have.update(zip(stems, self._words(stems)))
        tails = {"": b""}
        for p, stem in ended:
            tail = p[len(stem):]
            if tail not in tails:
                tails[tail] = self.whole([tail])[0]
            have[p] = have[stem] + tails[tail]
        have.update(zip(other, self.whole([" " + p for p in other])))

    def _begin(self, part: str) -> bytes | None:
        """Ids of a text's first part, which has no blank in front."""
        if part not in self.first:
            if len(self.first) >= self.cached // 10:
                self.first.clear()
            safe = part and not part[0].isspace() and not part[-1].isspace() and "<|" not in part
            self.first[part] = self.whole([part])[0] if safe else None
        return self.first[part]

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Null counts as empty."""
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list)
                             else texts.cast(pa.large_string()), "")
        if not len(texts):
            return []
        split = pc.split_pattern(
            pc.replace_substring(texts, "\n", " ") if self.drops else texts, " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        parts = split.flatten().dictionary_encode()
        code, names = parts.indices.to_numpy().astype(np.int64), _strings(parts.dictionary)
        begins: list[str] = []
        if not self.drops:  # the first part is another's work: it has no blank in front
            at = bounds[:-1]
            begins = [names[i] for i in code[at].tolist()]
            inner = np.ones(len(code), bool)
            inner[at] = False
            used, code[inner] = np.unique(code[inner], return_inverse=True)
            names = [names[i] for i in used.tolist()]
            code[at] = len(names) + np.arange(len(begins))
        new = list(filterfalse(self.later.__contains__, names))
        if len(self.later) + len(new) > self.cached:
            self.later = {p: self.later[p] for p in set(names).difference(new)}
        self._learn(new)
        ids = [*map(self.later.__getitem__, names), *(self._begin(p) if p else b"" for p in begins)]
        some = pa.array(ids, pa.large_binary())
        unsafe = some.is_null().to_numpy(zero_copy_only=False)
        if not self.drops:  # a text that begins with a blank; an empty one has no ids
            unsafe[len(names):] |= np.array([not p for p in begins]) & (np.diff(bounds) > 1)
        bad = np.add.reduceat(unsafe[code].astype(np.int64), bounds[:-1]) > 0
        joined = some.take(pa.array(code))
        _, offsets, data = joined.buffers()
        ends = np.frombuffer(offsets, np.int64)[bounds].tolist()
        raw = data.to_pybytes() if data is not None else b""
        return [self.whole([texts[i].as_py()])[0] if whole else raw[a:z]
                for i, (whole, a, z) in enumerate(zip(bad.tolist(), ends, ends[1:]))]
