"""Secret scans: known formats, and windows of high Shannon entropy in candidate strings.

Candidates are maximal runs of 20 and more key characters. A window slides over a candidate; the
counts of its characters, and from them its entropy, are updated by the one that enters and the
one that leaves. What counts as high depends on the window's character class. Flagged windows
merge into spans. Windows that touch a known format or a placeholder's token are not flagged, and
what the allow-list explains (UUIDs, digests behind an integrity prefix, numbers, paths) is left
out.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import as_row, fields, prepare, text_of
from strata.llm.kernels import byte_class, flat, runs

#: Kinds in the order that breaks ties of the start.
KINDS = ("assign", "access", "hex", "entropy")
#: The formats that are always reported.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Characters of a window.
WINDOW = 20
#: Bits a character from which a window is flagged, by class: at most the 1st percentile of random
#: windows of 20 (2.90, 3.65, 3.65 and 3.58 in 40,000 draws each). Windows of letters alone are
#: never flagged in one case, nor in words.
BITS = {"hex": 2.9, "alnum": 3.6, "base64": 3.6, "letters": 3.58}
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"sha(?:1|256|384|512)-.*",
    r"[0-9+/_=-]+",
    # words and short numbers between separators; possessive, so that it is linear
    r"[/_=-]*+(?:(?:[A-Za-z]{1,19}+|[0-9]{1,4}+)[/_=-]++)++[A-Za-z]{0,19}+[0-9]{0,4}+[/_=-]*+",
)
#: Least share of capitals and of small letters in a window of letters, two of the capitals side by
#: side: names made of words (camel case) have fewer capitals, each before small letters. Of random
#: windows of 20, 98 % have so many.
MIXED = 0.2
#: Words that explain the token around them (up to a / _ = or -), a window's length to each side.
PLACEHOLDER = r"example|sample|dummy|placeholder|xxxx|changeme"

_KEY_BYTE = byte_class(lambda b: chr(b).isalnum() and b < 0x80 or chr(b) in "+/_=-")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                 T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType())]))


def high_entropy(s: str, window: int, bits: dict[str, float],
                 skip: tuple = ()) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``s`` whose entropy reaches that of their class; windows
    that touch one of the ranges to ``skip`` (ascending, disjoint) don't count. One pass.

    With counts c of a window of w characters, entropy is log2(w) - sum(c * log2(c)) / w, so a
    step changes the sum for two characters only. Numbers of digits, upper and lower case, hex
    and other characters are kept the same way and give the class.
    """
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    kinds = {"digit": 0, "upper": 0, "lower": 0, "other": 0, "hex": 0}
    total, out, past = 0.0, [], 0

    def change(ch, by):
        nonlocal total
        c = counts.get(ch, 0)
        total += weight[c + by] - weight[c]
        counts[ch] = c + by
        kinds["digit" if ch.isdigit() else "upper" if ch.isupper() else "lower"
              if ch.islower() else "other"] += by
        if ch in "0123456789abcdefABCDEF":
            kinds["hex"] += by

    side = 0  # neighbours that are both capitals
    for i, ch in enumerate(s):
        if i >= window:
            change(s[i - window], -1)
            side -= s[i - window].isupper() and s[i - window + 1].isupper()
        change(ch, 1)
        side += i > 0 and ch.isupper() and s[i - 1].isupper()
        if i < window - 1:
            continue
        letters = kinds["upper"] + kinds["lower"]
        if kinds["digit"] and letters:
            least = bits["hex"] if kinds["hex"] == window else \
                bits["alnum"] if not kinds["other"] else bits["base64"]
        elif not kinds["digit"] and side and min(kinds["upper"], kinds["lower"]) >= MIXED * window:
            least = bits["letters"]
        else:
            continue
        if math.log2(window) - total / window >= least:
            a = i - window + 1
            while past < len(skip) and skip[past][1] <= a:
                past += 1  # no later window reaches back to it
            if past < len(skip) and skip[past][0] <= i:
                continue
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((a, i + 1))
    return out


def known_formats(text: str, candidates) -> list[tuple[str, int, int]]:
    """The base spans. ``candidates`` are (start, string) runs that hold every hex run."""
    out = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in _KEYWORDS):
            out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                    if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                if len(m[0]) >= MIN_ACCESS]
    for at, s in candidates:
        out += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(s)
                if len(m[0]) >= MIN_HEX]
    return out


def placeholders(s: str, words: re.Pattern, window: int) -> list[tuple[int, int]]:
    """The ranges of ``s`` that placeholder words explain."""
    out = []
    for m in words.finditer(s):
        low, high = max(0, m.start() - window), min(len(s), m.end() + window)
        before = max(s.rfind(c, low, m.start()) for c in "/_=-") + 1
        after = min((x for c in "/_=-" if (x := s.find(c, m.end(), high)) >= 0), default=high)
        out.append((max(before, low), after))
    return out


def disjoint(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same ground as ascending ranges that don't meet."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def _scan(window: int, bits: dict, allow: tuple, placeholder: str = PLACEHOLDER):
    allowed = re.compile("|".join(f"(?:{a})" for a in allow)) if allow else None
    words = re.compile(placeholder, re.IGNORECASE) if placeholder else None

    def of_text(text, candidates):
        found = known_formats(text, candidates)
        base, first = disjoint([(a, z) for _, a, z in found]), 0
        for at, s in candidates:  # ascending, as the base spans are
            while first < len(base) and base[first][1] <= at:
                first += 1
            if allowed and allowed.fullmatch(s):
                continue
            skip, k = [], first
            while k < len(base) and base[k][0] < at + len(s):
                skip.append((base[k][0] - at, base[k][1] - at))
                k += 1
            if words:
                skip += placeholders(s, words, window)
            for a, z in high_entropy(s, window, bits, disjoint(skip)):
                if not (allowed and allowed.fullmatch(s[a:z])):
                    found.append(("entropy", a + at, z + at))
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))

    def run(batches):
        for b in batches:
            texts = text_of(b)
            data, offsets = flat(texts)
            starts, ends = runs(data, offsets, _KEY_BYTE)
            long_ = ends - starts >= min(window, MIN_HEX)
            starts, ends = starts[long_], ends[long_]
            doc = np.searchsorted(offsets, starts, "right") - 1
            candidates: dict[int, list] = {}
            # characters before a candidate: bytes that don't continue one
            more = np.flatnonzero((data & 0xC0) == 0x80)
            o = offsets[doc]
            at = starts - o - (np.searchsorted(more, starts) - np.searchsorted(more, o))
            for d, c, a, z in zip(doc.tolist(), at.tolist(), starts.tolist(), ends.tolist()):
                candidates.setdefault(d, []).append((c, data[a:z].tobytes().decode("ascii")))
            spans = [of_text(t or "", candidates.get(i, ())) for i, t in
                     enumerate(texts.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[{"kind": k, "start": a, "end": z} for k, a, z in s] for s in spans],
                          pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                              ("end", pa.int32())]))), b.column("row")],
                names=["spans", "row"])
    return run


def scan(docs: DataFrame, window: int = WINDOW, bits: dict[str, float] | None = None,
         allow: tuple[str, ...] = ALLOW, keep_columns: bool = True,
         placeholder: str = PLACEHOLDER) -> DataFrame:
    """Each row of ``docs`` (as struct ``row``) with ``spans``: (kind, start, end) in code
    points, by start and kind. Null and empty texts have none; repeated rows are scanned alike;
    an empty table gives no rows."""
    prepare(docs.sparkSession)
    df = docs.select(as_row(docs, keep_columns))
    return df.mapInArrow(_scan(window, bits or BITS, allow, placeholder),
                         fields(("spans", SPAN), ("row", df.schema["row"].dataType)))


def joined(spans: str = "spans", kinds: tuple[str, ...] = KINDS):
    """kind:start:end of the spans of these kinds, comma-joined."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(some, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
