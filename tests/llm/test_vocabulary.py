"""Spelling variants and substring dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import bits, spelling, substrings, wordarrays
from test_native import ODD, SCHEMA, odd

LETTERS = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for c in letters:
        out |= {word[:i] + c + word[i:] for i in range(len(word) + 1)} | {word[:i] + c + word[i + 1 :] for i in range(len(word))}
    return out - {word}


def variants_plainly(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in spelling._RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    letters = sorted(set("".join(words)))
    near = {w: edits(w, letters) & words.keys() for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def variants(df):
    return sorted((tuple(r) for r in spelling.op11(df).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdeéÀq", min_size=1, max_size=7), st.data())
def test_neighbourhood_has_every_one_edit_word(word, data):
    other = data.draw(st.sampled_from(sorted(edits(word, "abcdeéÀqz") - {""})))
    keys = set(np.concatenate([x.ravel() for x in spelling.neighbourhood([word])]).tolist())
    assert spelling.own_keys([other])[0] in keys
    assert spelling.own_keys([word])[0] in keys


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**12), st.binary(max_size=100))
def test_checksum_tables(doc_id, run):
    prefix = zlib.crc32(f"{doc_id}:".encode())
    tables, n = spelling._zero_bytes(len(run)), len(run)
    moved = 0
    for k in range(4):
        moved ^= int(tables[n, k, prefix >> 8 * k & 255])
    assert moved ^ zlib.crc32(run) == zlib.crc32(f"{doc_id}:".encode() + run)


def test_variants_equal_brute_force(spark):
    random.seed(5)
    base = ["".join(random.choices("aeionrst", k=random.randint(4, 8))) for _ in range(60)] + ["Éclair", "éclair", "eclair", "x" * 90, "x" * 91]
    pool = base + [random.choice(sorted(edits(w, "aeioné"))) for w in base for _ in range(4)]
    rows = [(d if d % 9 else None, " ".join(random.choices(pool, k=random.randint(0, 80), weights=[1 + i % 13 for i in range(len(pool))]))) for d in range(200)]
    rows += [(7, "Wörter-WÖRTER wörter2wörter"), (8, None), (9, ""), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    expected = variants_plainly(rows)
    assert len(expected) > 100 and any(r[1] for r in expected)
    assert variants(docs.withColumns({c: F.lit("clash") for c in ("word", "n", "key", "id", "root")})) == expected


def test_variants_of_awkward_tables(spark):
    assert variants(odd(spark)) == variants_plainly([r[:2] for r in ODD])
    assert variants(odd(spark, [])) == []
    long = "ab" * 30_000
    rows = [(i, t, "s") for i, t in enumerate([long, long, long, long + "c", long + "c", long + "c", long + "c", long + "c", long + "c"])]
    found = {r.n: r for r in spelling.op11(odd(spark, rows)).collect()}
    assert found[3].form == long + "c" and found[3].n_near == found[6].n_near == 1 and found[6].form is None


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = [(d, " ".join(random.Random(d).choices(["house", "hous", "houses", "mouse", "moose", "goose"], k=30)), "s") for d in range(30)]
    expected = variants(odd(spark, rows))
    assert expected == variants_plainly([r[:2] for r in rows])
    monkeypatch.setattr(spelling, "held", lambda bits, keys: np.ones(keys.shape, dtype=bool))
    assert variants(odd(spark, rows)) == expected


def test_bitmap_holds_its_keys(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    made = bits.bitmap(spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "k bigint"), "k", 20).value
    assert bits.held(made, keys.view(np.uint64)).all()
    assert bits.held(made, np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)).mean() < 0.02
    assert int(np.unpackbits(made).sum()) == len(set((keys & ((1 << 20) - 1)).tolist()))


def removed_plainly(rows, window=13):
    """Per row: words, removed words, what is kept."""
    firsts = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            key = tuple(words[i : i + window])
            firsts[key] = min(firsts.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            if firsts[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(df):
    return sorted((tuple(r) for r in substrings.op12(df).collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), max_size=4))
def test_factors_cover_exactly_the_windows_of_the_blocks(words, blocks):
    window = 4
    held = {tuple(b[i : i + window]) for b in blocks for i in range(len(b) - window + 1)}
    covered = {k for i in range(len(words) - window + 1) if tuple(words[i : i + window]) in held for k in range(i, i + window)}
    spans = substrings.factors(words, blocks, window)
    assert {k for a, b in spans for k in range(a, b)} == covered
    assert all(b - a >= window for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é\t\n\x0b\x0c\r\x1c\x85\u2003", max_size=12), max_size=6), st.integers(1, 20))
def test_words_in_arrays(texts, at_once):
    hashes, joined, counts = {}, [], []
    before, wordarrays._AT_ONCE = wordarrays._AT_ONCE, at_once
    try:
        for words in wordarrays.words_in(pa.array(["skipped", *texts], pa.string())[1:]):
            joined += words.joined()
            counts += words.counts.tolist()
            flat = [w for t in texts[words.rows] for w in t.encode().split()]
            found = words.hashes().tolist()
            assert len(flat) == len(found)
            for w, h in zip(flat, found):
                assert hashes.setdefault(w, h) == h
    finally:
        wordarrays._AT_ONCE = before
    assert joined == [b" ".join(t.encode().split()) for t in texts]
    assert counts == [len(t.encode().split()) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 62, 13).astype(np.uint64)
    found = []
    for _ in range(20):
        left, right = (rng.integers(0, 1 << 62, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
        found.append(substrings.anchors(np.concatenate([left, shared, right]))[len(left)])
    assert len(set(found)) == 1


def passages(seed, docs=150):
    """Documents made of passages that many share, with copies, near copies, periodic texts and repeated ids."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of"]) if rng.random() < 0.4 else f"w{rng.randint(0, 400)}"
    pool = [[word() for _ in range(rng.randint(5, 120))] for _ in range(12)]
    rows = []
    for d in range(docs):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = list(rng.choice(pool)) if rng.random() < 0.5 else [word() for _ in range(rng.randint(0, 60))]
            words += part[rng.randint(0, 5) :]
        rows.append((rng.randint(0, docs), rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, rows[5][1] + " and a tail"), (None, rows[5][1]), (2001, "a " * 500), (2002, "a " * 300 + "b")]
    return rows + [(5, rows[7][1]), (5, rows[8][1]), rows[9], (1, rows[9][1]), (3000, None), (3001, ""), (3002, "x " * 12), (3003, "x " * 12)]


def test_removed_words_equal_brute_force(spark):
    for seed in (1, 2):
        rows = passages(seed)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        docs = docs.withColumns({c: F.lit("clash") for c in ("class", "window", "start", "n_removed", "least", "gone")})
        assert removed(docs) == removed_plainly(rows)


def test_hot_windows_are_salted(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 10)
    monkeypatch.setattr(wordarrays, "_AT_ONCE", 50)
    rows = passages(4)
    assert removed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == removed_plainly(rows)


def test_kept_texts_are_whole(spark):
    rows = passages(6, 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    kept = substrings.dedup(docs)
    assert kept.columns == ["doc_id", "lang", "text", "n_removed"]
    found = []
    for r in kept.collect():
        words = (r.text or "").encode().split()
        found.append((r.doc_id, len(words) + r.n_removed, r.n_removed, hashlib.sha256(b" ".join(words)).hexdigest()))
    assert sorted(found, key=str) == removed_plainly(rows)


def test_removed_words_of_awkward_tables(spark):
    assert removed(odd(spark)) == removed_plainly([r[:2] for r in ODD])
    assert removed(odd(spark, [])) == []
    assert removed(odd(spark, [(1, None, None), (2, "", "s")])) == removed_plainly([(1, None), (2, "")])
    assert removed(odd(spark, [(2, "y " * 40_000, "s"), (1, "y " * 20, "s")])) == removed_plainly([(2, "y " * 40_000), (1, "y " * 20)])


def test_schema(spark):
    assert substrings.op12(spark.createDataFrame([], SCHEMA)).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
