"""Merkle manifest, licence scan and spelling variants against brute force, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import license_scan, merkle, oracle, queries, spelling

from .test_operators import SF, odd  # noqa: F401 - the odd table is a fixture


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- Merkle manifest ----------------------------------------------------------------------

def leaf_of(row):
    def part(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "-"
        v = str(v)
        return f"{len(v.encode())}:{v}"
    return H(*[part(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])


def tree_of(digests, fan):
    """The root, and per leaf its (left, right) steps."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, node in enumerate(at):
            run = level[node // fan * fan:node // fan * fan + fan]
            k = node % fan
            steps[i].append(("".join(run[:k]), "".join(run[k + 1:])))
        level = [H(*level[i:i + fan]) for i in range(0, len(level), fan)]
        at = [x // fan for x in at]
    return level[0], steps


def brute_manifest(rows, fan):
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(
            ((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)), r["doc_id"], leaf_of(r)))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_of([x[2] for x in sorted(by_source[s], key=lambda x: x[0])], fan)
             for s in sources}
    root, above = tree_of([trees[s][0] for s in sources], fan)
    out = []
    for i, s in enumerate(sources):
        for x, steps in zip(sorted(by_source[s], key=lambda x: x[0]), trees[s][1]):
            out.append((x[1], s, x[2], trees[s][0], root, tuple(steps + above[i])))
    return out


def found_manifest(df, fan=merkle.FAN, claim=None):
    return [(r.doc_id, r.source, r.leaf, r.subroot, r.root,
             tuple((p.left, p.right) for p in r.path))
            for r in merkle.manifest(df, claim, fan=fan).collect()]


def key(x):
    return str(x)


@pytest.mark.parametrize("fan,n", [(2, 70), (3, 200), (16, 700)])
def test_manifest_equals_brute_force(spark, fan, n):
    """Sources of one leaf, of exactly fan and fan + 1, a hot one, null and empty ones."""
    rng = random.Random(fan)
    names = [None, "", "a", "b", "ä", "z" * 5] + [f"s{i}" for i in range(fan * fan)]
    rows = [{"doc_id": i, "text": f"Text {i}" if i % 7 else None, "lang": rng.choice(["en", None]),
             "source": "hot" if i % 3 == 0 else rng.choice(names), "n_chars": i} for i in range(n)]
    rows += [{"doc_id": 10_000 + i, "text": "x", "lang": "en", "source": s, "n_chars": 1}
             for s, k in (("one", 1), ("fan", fan), ("more", fan + 1)) for i in range(k)]
    rng.shuffle(rows)
    df = spark.createDataFrame([tuple(r.values()) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(found_manifest(df, fan), key=key) == sorted(brute_manifest(rows, fan), key=key)


def test_manifest_of_odd_rows(spark, odd):  # noqa: F811
    rows = [r.asDict() for r in odd.drop("row", "n").collect()]
    clash = odd.withColumns({"tree": F.lit(1), "rank": F.lit(2), "digest": F.lit("x"), "lo": F.lit(0)})
    assert sorted(found_manifest(clash), key=key) == sorted(brute_manifest(rows, 16), key=key)
    assert found_manifest(odd.limit(0)) == []
    one = found_manifest(odd.where("doc_id = 5"))
    assert one[0][2] == one[0][3] == one[0][4] and one[0][5] == ()


def test_fold_finds_a_false_leaf(spark, odd):  # noqa: F811
    claim = F.when(F.col("doc_id") == 7, merkle.leaf_digest(F.lower("text")))
    out = merkle.manifest(odd, claim, fan=2).select(
        "doc_id", "root", merkle.fold(F.coalesce("claim", "leaf")).alias("folded")).collect()
    assert [r.doc_id for r in out if r.folded != r.root] == [7]


def test_a_third_of_all_rows_alike(spark):
    """Equal rows are dealt over the tasks, and still get one rank each."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("t").alias("text"),
        F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"),
        F.lit(1).cast("long").alias("n_chars"))
    rows = [r.asDict() for r in df.collect()]
    assert sorted(found_manifest(df), key=key) == sorted(brute_manifest(rows, 16), key=key)


# --- licence scan -------------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_scan(text, licenses):
    """The definition, offset by offset."""
    w, idf = words_of(text), dict(licenses.idf)

    def places(phrase):
        p = phrase.split()
        return [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    base = sorted((i, label) for phrase, label in licenses.phrases for i in places(phrase))
    L, matches = license_scan, []
    for label, said, keys in licenses.templates:
        t = said.split()
        rare = sorted(set(t), key=lambda x: (-idf[x], x))
        looked = [x for x in rare if x in w][:L.LOOK_UP]
        need = max(math.ceil(L.AGREE * min(L.LOOK_UP, len(rare))), 1)
        votes = sorted((f - i, looked.index(x)) for i, x in enumerate(t) if x in looked
                       for f in range(len(w)) if w[f] == x)
        centres = set()
        for a, _ in votes:
            near = [v for v in votes if a <= v[0] <= a + 2 * L.SLACK]
            start = min(j for j, v in enumerate(votes) if v[0] >= a)
            held = all(any(a - L.SLACK <= p <= a + 3 * L.SLACK + len(t) for p in places(k))
                       for k in keys)
            if held and len({v[1] for v in near}) >= need:
                for j in range(start, start + sum(v[0] == a for v in votes)):
                    # windows begin at each vote of this offset
                    centres.add(votes[(j + start + len(near) - 1) // 2][0])
        scored = {}
        for c in centres:
            hits = sum(any(0 <= c + i + d < len(w) and w[c + i + d] == x
                           for d in range(-L.SLACK, L.SLACK + 1)) for i, x in enumerate(t))
            if hits / len(t) >= L.LEAST:
                scored[c] = hits / len(t)
        left = sorted(scored)
        while left:
            best = max((c for c in left if c <= left[0] + L.SLACK), key=lambda c: (scored[c], -c))
            matches.append((label, max(0, best), min(len(w), best + len(t)) - 1, scored[best]))
            left = [c for c in left if c >= best + len(t)]
    return base, sorted(matches)


def check_scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    licenses = license_scan.fit(df)
    out = license_scan.scan(df, licenses).collect()
    assert len(out) == len(texts)
    for r in out:
        base, matches = brute_scan(texts[r.row.doc_id], licenses)
        assert r.n_words == len(words_of(texts[r.row.doc_id]))
        assert [(p.word, p.label) for p in r.places] == base
        assert sorted((m.label, m.first, m.last, m.score) for m in r.matches) == matches, r.row.text
    return {r.row.doc_id: {m.label for m in r.matches} for r in out}


def test_license_matches_equal_brute_force(spark):
    rng = random.Random(11)
    some = sorted({w for _, t, _ in license_scan.TEMPLATES for w in t.split()})
    texts = [" ".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(60)]
    for _, t, _ in license_scan.TEMPLATES:
        w = t.split()
        for _ in range(4):  # words go, come and stand in other texts
            v = [x for x in w if rng.random() > 0.1]
            for _ in range(rng.randrange(4)):
                v.insert(rng.randrange(len(v) + 1), rng.choice(["acme", "2024", "the", "of"]))
            texts.append(" ".join(["filler"] * rng.randrange(20) + v + rng.choice(texts).split()))
    check_scan(spark, texts)


def test_every_template_is_found_and_its_parts_are_not(spark):
    texts = [f"# (c) 2020 Somebody\n{t.capitalize()}.\nnext" for _, t, _ in license_scan.TEMPLATES]
    found = check_scan(spark, texts)
    for i, (label, _, _) in enumerate(license_scan.TEMPLATES):
        assert label in found[i], texts[i]
    clean = ["the public may use the software for any purpose", "a license to drive, a bsd, a mit",
             "version 2 0 of the mozilla project", "all rights in general, public or reserved"]
    assert all(not x for x in check_scan(spark, clean).values())


def test_license_base_columns_equal_sql(spark):
    a = queries.REGISTRY["op11_positional_license_scan"](spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    b = con.execute(oracle.LICENSE_BASE).df()
    pd.testing.assert_frame_equal(
        a[b.columns].sort_values("doc_id", ignore_index=True),
        b.sort_values("doc_id", ignore_index=True), check_dtype=False)
    assert a.score.between(0, 1).all() and (a.base_labels != "").any()
    for base, labels in zip(a.base_labels, a.labels):
        assert set(filter(None, base.split(","))) <= set(filter(None, labels.split(",")))


def test_license_scan_of_odd_rows(spark, odd):  # noqa: F811
    long_ = "mit license " * 30_000 + "all rights reserved"
    df = odd.unionByName(spark.createDataFrame(
        [(9, long_, None, None, None, "x", 3), (10, "CC-BY, cc\nby CC BY", None, None, None, "x", 3)],
        odd.schema)).withColumn("places", F.lit(1)).withColumn("n_words", F.lit("?"))
    out = license_scan.scan(df, license_scan.fit(df)).collect()
    assert len(out) == 13 and out[0].row.places == 1
    by = {r.row.doc_id: r for r in out}
    assert [p.word for p in by[10].places] == [0, 2, 4] and by[2].n_words == by[4].n_words == 0
    assert by[9].places[0].word == 60_000
    assert {m.label for m in by[9].matches} == {"mit"} and len(by[9].matches) >= 10_000
    empty = odd.limit(0)
    assert license_scan.scan(empty, license_scan.fit(empty)).isEmpty()


# --- spelling variants --------------------------------------------------------------------

def brute_words(rows, every=31, least=7):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(n, ratio=10):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def found_variants(df, **kw):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
            for r in spelling.spelling_variants(df, **kw).collect()}


def test_spelling_of_the_documents_equals_brute_force(spark, odd):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    rows += [(i, f"Straße {'Übermut' * (i % 3)}× naïveté÷ÿ Rhabarber Rhabarbar xĀrhabarber "
                 f"rhabarbe rhabarberr {'q' * (60 + i)} {'q' * (60 + i)}") for i in range(20, 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1))
    for every in (0, 31, 2):
        got = {r.word: r.n for r in spelling.vocabulary(df, delete_every=every).collect()}
        assert got == brute_words(rows, every or 1 << 33)
    assert spelling.vocabulary(df.limit(0)).isEmpty()


@pytest.mark.parametrize("symbols,window", [(400_000, 64), (30, 4), (1, 1)])
def test_near_words_equal_brute_force(spark, monkeypatch, symbols, window):
    """Short words over few letters, so that all edits and runs of one letter occur; small groups
    and windows force halving down to single symbols."""
    rng = random.Random(symbols)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(250)}
    words |= {"a" * k for k in range(1, 80)} | {"é" + "b" * 40, "b" * 41, "ébb" + "b" * 37 + "c"}
    words |= {"x" * 30 + c + "y" * 50 for c in "abcé"} | {"x" * 30 + "y" * 50, "x" * 31 + "y" * 50}
    n = {w: rng.choice([1, 2, 3, 30, 300, 3000]) for w in words}
    near = spelling.near_words
    monkeypatch.setattr(spelling, "near_words", lambda df: near(df, symbols, window))
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found_variants(df) == brute_variants(n)


def test_spelling_of_null_and_empty_words_and_ties(spark):
    df = spark.createDataFrame([("abcdefg", 1), ("abcdefh", 10), ("abcdefi", 10), ("", 5),
                                ("abcdefhi", 100)], "word string, n long")
    assert found_variants(df) == {
        "abcdefg": ("abcdefh", "abcdefhi", 1, 2, 10),  # of two as frequent: the smaller one
        "abcdefh": ("abcdefhi", "abcdefhi", 10, 3, 100),
        "abcdefi": ("abcdefhi", "abcdefhi", 10, 3, 100),
        "abcdefhi": (None, "abcdefhi", 100, 2, None), "": (None, "", 5, 0, None)}
    assert spelling.spelling_variants(df.limit(0)).isEmpty()


def test_the_acceptor_is_minimal():
    a = spelling.Acceptor(["abc", "abd", "xbc", "xbd", "xyz"])
    assert sorted(a.right(a.start)) == ["abc", "abd", "xbc", "xbd", "xyz"]
    assert len(a.final) == 6  # start, after a, after x, after ab or xb, after xy, end
    assert sorted(map(sorted, spelling.near_pairs(["abc", "abd", "xbc", "xbd", "xyz"]))) == [
        ["abc", "abd"], ["abc", "xbc"], ["abd", "xbd"], ["xbc", "xbd"]]
