"""Spelling variants: pairs of words one edit apart, by composition of finite-state machines.

Let A be the minimal acyclic automaton that accepts the vocabulary and E the transducer of at most
one edit (two states: copying before the edit, copying after it; between them it inserts, deletes
or replaces one symbol). The pairs that A . E . A accepts, with the edit made, are the near words.

The machine is never built whole. Take a pair whose longer word has m symbols and whose words part
after p common ones. For every window [a, b) of 0..m that holds p, both words have the same first a
symbols and the same last m - b. So the vocabulary is dealt by (m, a, b, prefix, suffix): the
prefix leads from the initial state to one state of A, and that is the initial state of the
group's machine, which accepts what stands between prefix and suffix. Every word is in the groups of
m = its length (it is the longer one, or as long) and m = its length + 1 (the shorter one), for
both halves of 0..m; a pair is made in the one window that holds its p.

A group of too many words, or of too long middles, is not run: its window is cut into halves and
its words are dealt again. A window of one symbol holds words that are all near each other, at most
as many as the alphabet has letters and one more. So no group is unbounded and none is cut short.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise, prepare, text_of
from strata.llm.kernels import flat, runs_of

#: Most symbols of all middles of a group that a task runs as one machine, and the longest
#: window of such a group; beyond either, windows are halved.
GROUP_SYMBOLS, WINDOW = 400_000, 64
#: Keys of too large groups that are broadcast; more are joined by a shuffle.
BROADCAST = 250_000
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, np.uint32(0xEDB88320) ^ (_CRC >> 1), _CRC >> 1).astype(np.uint32)


def _crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each byte range, going on from the crc in ``begun``."""
    out = begun.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    left = np.argsort(starts - ends, kind="stable")  # longest first
    size = (ends - starts)[left]
    for j in range(int(min(size[0], 64)) if len(size) else 0):
        i = left[:np.searchsorted(-size, -j, "left")]  # those of more than j bytes
        c = out[i]
        out[i] = _CRC[(c ^ data[starts[i] + j]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for i in left[:np.searchsorted(-size, -64, "left")].tolist():
        out[i] = zlib.crc32(data[starts[i] + 64:ends[i]].tobytes(), int(out[i]))
    return out


def _words(least: int, delete_every: int):
    """(word, n) of every batch: lower-cased runs of letters of at least ``least`` code points."""
    def run(batches):
        for b in batches:
            data, offsets = flat(text_of(b))
            inside = _LETTER[data]
            lead = np.flatnonzero(data == 0xC3)  # of two bytes: U+00C0 to U+00FF
            inside[lead + 1] = True
            starts, ends = runs_of(inside, offsets)
            wide = np.searchsorted(lead, ends) - np.searchsorted(lead, starts)
            size = ends - starts - wide
            keep = size >= least
            starts, ends, size = starts[keep], ends[keep], size[keep]
            data = _SMALL[data]
            some = []
            if delete_every and len(starts):
                ids = b.column(b.schema.get_field_index("doc_id")).to_pylist()
                begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids],
                                 np.uint32)
                doc = np.searchsorted(offsets, starts, "right") - 1
                crc = _crc32(data, starts, ends, begun[doc])
                hit = crc % np.uint32(delete_every) == 0
                for s, e, n, c in zip(starts[hit].tolist(), ends[hit].tolist(), size[hit].tolist(),
                                      crc[hit].tolist()):
                    if n > least:
                        w = data[s:e].tobytes().decode()
                        some.append(w[:c % n] + w[c % n + 1:])
                starts, ends = starts[~hit], ends[~hit]
            cut = np.zeros(len(data) + 1, np.int8)
            cut[starts] += 1
            cut[ends] -= 1
            at = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(ends - starts, out=at[1:])
            words = pa.LargeStringArray.from_buffers(
                len(starts), pa.py_buffer(at), pa.py_buffer(data[np.cumsum(cut[:-1], dtype=np.int8) > 0]))
            found = pc.value_counts(pa.concat_arrays([words, pa.array(some, pa.large_string())]))
            yield pa.RecordBatch.from_arrays(
                [found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])
    return run


def vocabulary(docs: DataFrame, min_chars: int = 7, min_count: int = 2,
               delete_every: int = 0) -> DataFrame:
    """(word, n): the runs ``[A-Za-z\\u00C0-\\u00FF]+`` of all texts, A-Z lower-cased.

    With ``delete_every`` a fault is planted in a share of the runs: where it divides the crc32 of
    ``<doc_id>:<run>`` (a null doc_id is empty there), the run loses the code point at crc modulo
    its length. Null and empty texts have no words; repeated rows count again; other columns are
    ignored.
    """
    found = docs.select("doc_id", "text").mapInArrow(
        _words(min_chars, delete_every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- the machine of one group -------------------------------------------------------------

class Acceptor:
    """Minimal acyclic automaton of sorted distinct words. States are numbers: equal ones have
    been merged, so two states with the same right language are one."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.next: list[dict[str, int]] = []
        self._known: dict[tuple, int] = {}
        self._right: dict[int, list[str]] = {}
        self._both: dict[tuple[int, int], list[str]] = {}
        path: list[list] = [[False, {}]]  # the open states along the last word
        last = ""
        for w in words:
            same = 0
            while same < len(last) and same < len(w) and last[same] == w[same]:
                same += 1
            self._close(path, last, same)
            path += [[False, {}] for _ in range(len(w) - same)]
            path[-1][0] = True
            last = w
        self._close(path, last, 0)
        self.start = self._state(path[0])

    def _close(self, path: list, last: str, keep: int) -> None:
        while len(path) > keep + 1:
            state = self._state(path.pop())
            path[-1][1][last[len(path) - 1]] = state

    def _state(self, open_state: list) -> int:
        final, arcs = open_state
        key = (final, *arcs.items())  # arcs were closed in the order of the words
        if key not in self._known:
            self._known[key] = len(self.final)
            self.final.append(final)
            self.next.append(arcs)
        return self._known[key]

    def right(self, p: int) -> list[str]:
        """All that is accepted from p."""
        have = self._right.get(p)
        if have is None:
            have = [""] if self.final[p] else []
            for c, q in self.next[p].items():
                have += [c + s for s in self.right(q)]
            self._right[p] = have
        return have

    def both(self, p: int, q: int) -> list[str]:
        """All that is accepted from p and from q: the copying part after the edit."""
        if p == q:
            return self.right(p)
        key = (p, q) if p < q else (q, p)
        have = self._both.get(key)
        if have is None:
            have = [""] if self.final[p] and self.final[q] else []
            a, b = self.next[p], self.next[q]
            for c in a.keys() & b.keys():
                have += [c + s for s in self.both(a[c], b[c])]
            self._both[key] = have
        return have


def near_pairs(words: list[str]):
    """Pairs (u, v) of sorted distinct words that A . E . A accepts with one edit, each once; the
    edit stands right after what u and v begin with in common."""
    a = Acceptor(words)
    edits: dict[int, list[tuple[str, str]]] = {}

    def edited(p: int) -> list[tuple[str, str]]:
        """What the two sides read from p on, if the edit is made at p."""
        have = edits.get(p)
        if have is None:
            arcs, have = list(a.next[p].items()), []
            for i, (c, q) in enumerate(arcs):
                have += [(c + s, s) for s in a.both(q, p) if not s.startswith(c)]  # c deleted
                for d, r in arcs[i + 1:]:  # c replaced by d
                    have += [(c + s, d + s) for s in a.both(q, r)]
            edits[p] = have
        return have

    stack = [(a.start, "")]
    while stack:  # composed states before the edit: both sides in the same state
        p, prefix = stack.pop()
        for x, y in edited(p):
            yield prefix + x, prefix + y
        for c, q in a.next[p].items():
            stack.append((q, prefix + c))


def _common(u: str, v: str) -> int:
    n = 0
    for x, y in zip(u, v):
        if x != y:
            return n
        n += 1
    return n


def _run_group(m: int, a: int, b: int, words: list[str], counts: list[int]):
    """Per word with partners: the number of its near words and the best of them, for the pairs
    whose words part inside the window."""
    tail = m - b
    middle = sorted((w[a:len(w) - tail], i) for i, w in enumerate(words))
    index = dict(middle)
    near, best = {}, {}
    for x, y in near_pairs([w for w, _ in middle]):
        i, j = index[x], index[y]
        u, v = words[i], words[j]
        if max(len(u), len(v)) != m or not a <= _common(u, v) < b:
            continue  # made in the groups of another length, or in another window
        for s, t in ((i, j), (j, i)):
            near[s] = near.get(s, 0) + 1
            rank = (-counts[t], words[t])
            if s not in best or rank < best[s]:
                best[s] = rank
    return [(words[i], n, -best[i][0], best[i][1]) for i, n in near.items()]


def _run_groups(batches):
    """Rows (key, word, n), those of a key in a row; a batch may end within them."""
    key, words, counts = "", [], []  # of the last key, as far as it was seen

    def done():
        return _run_group(*map(int, key.split(" ", 3)[:3]), words, counts) if len(words) > 1 else []

    def made(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        keys, out = batch.column("key"), []
        some, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        turns = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), turns]))
        ends = np.append(starts[1:], len(keys))
        told = ends - starts > 1  # words alone have no pairs
        told[:1] = told[-1:] = True
        for s, e in zip(starts[told].tolist(), ends[told].tolist()):
            if s or keys[0].as_py() != key:
                out += done()
                key, words, counts = keys[s].as_py(), [], []
            words += some[s:e]
            counts += n[s:e]
        yield made(out)
    yield made(done())


# --- groups over Spark --------------------------------------------------------------------

def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, a, b) with what all words of a group share; long ones by a digest."""
    shared = F.concat(F.expr("substring(word, 1, a)"), F.lit(" "),
                      F.expr("substring(word, length(word) - (m - b) + 1)"))
    key = F.when(F.col("m") - F.col("b") + F.col("a") > 40, F.sha2(shared, 256)).otherwise(shared)
    rows = rows.withColumn("key", F.concat_ws(" ", "m", "a", "b", key))
    return rows.withColumn("hash", F.xxhash64("key"))


def _halved(a, b):
    middle = F.floor((a + b + 1) / 2).cast("int")
    return F.array(F.struct(a.alias("a"), middle.alias("b")), F.struct(middle.alias("a"), b.alias("b")))


def _dealt(rows: DataFrame) -> DataFrame:
    cut = F.explode(_halved(F.col("a"), F.col("b"))).alias("w")
    return rows.select("word", "n", "m", cut).select("word", "n", "m", "w.a", "w.b")


def near_words(words: DataFrame, group_symbols: int = GROUP_SYMBOLS,
               window: int = WINDOW) -> DataFrame:
    """(word, n_near, best_n, best): the words that have others one edit away, the number of
    these, and the most frequent of them (ties: the smallest in code-point order).

    ``words`` holds distinct words and their counts (word, n); null and empty ones have no partners.
    """
    prepare(words.sparkSession)
    size = F.char_length("word")
    rows = words.where(size > 0).select(
        "word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    rows = _dealt(rows.select("word", "n", "m", F.lit(0).alias("a"), F.col("m").alias("b")))
    out = []
    while rows is not None:
        keyed, again = _keyed(rows), None
        width = F.col("b") - F.col("a")
        # by a hash: where two keys share one, a group is halved that need not have been
        sums = keyed.groupBy("hash").agg(F.count("*").alias("size"), F.max(width).alias("width"),
                                         F.sum(width).alias("symbols"))
        hot = materialise(sums.where("size > 1 AND width > 1").where(
            (F.col("symbols") > group_symbols) | (F.col("width") > window)).select("hash"),
            "spelling-hot")
        number = hot.count()
        if number:
            hot = F.broadcast(hot) if number <= BROADCAST else hot
            again = materialise(_dealt(keyed.join(hot, "hash", "left_semi")), "spelling-again")
            keyed = keyed.join(hot, "hash", "left_anti")
        # sorted rows, and no lists of members: those would be objects on the heap of the executors
        groups = keyed.select("hash", "key", "word", "n").repartition("hash").sortWithinPartitions(
            "hash", "key").select("key", "word", "n")
        out.append(materialise(groups.mapInArrow(
            _run_groups, "word string, n_near long, best_n long, best string"), "spelling-near"))
        rows = again
    all_near = out[0]
    for more in out[1:]:
        all_near = all_near.unionByName(more)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return all_near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word on the way of forms. A form is always more
    frequent than its word, so ways end; each round doubles the part of them that is known."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialise(now.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def spelling_variants(counted: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every counted word (word, n).

    ``form`` is the most frequent word one edit away, if it is at least ``ratio`` times as frequent
    (else null, with ``form_n``), ``root`` the last one on the way of forms (the word itself if it
    has no form). An empty vocabulary gives no rows.
    """
    prepare(counted.sparkSession)
    words = materialise(counted.select("word", "n"), "spelling-words")
    near = near_words(words)
    has = F.col("best_n") >= ratio * F.col("n")
    judged = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")),
        "spelling-judged")
    return judged.join(roots(judged.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
