"""Line dedup, near-duplicates, components and neighbours against brute force."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import linededup, neardup, neighbours, spread
from starloom.llm.components import components
from test_native import ODD, SCHEMA, odd


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25))
def test_matches_align(a, b):
    found = linededup.matches(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
    assert len(found) <= lcs(a, b)
    if set(a) & set(b):
        assert found
    once = [x for x in a if a.count(x) == 1 and b.count(x) == 1]
    if len(once) == len(a) == len(b) and a == b:
        assert len(found) == len(a)


def test_blocks_in_any_order_are_found():
    a, b = [1, 2, 3, 4, 5, 6], [4, 5, 6, 9, 1, 2, 3, 8, 1, 2, 3]
    words = [20] * len(b)
    assert linededup.common_lines(a, b, words, 50) == [0, 1, 2, 4, 5, 6, 8, 9, 10]
    assert linededup.common_lines(a, b, words, 61) == []
    assert linededup.common_lines(a, [7, 2, 8], [60, 60, 60], 50) == [1]


def test_blocks_that_cross_short_lines_are_found():
    p, s1, s2, x, y = 1, 2, 3, 4, 5
    assert linededup.common_lines([p, s1, x, s2], [s1, y, s2, p], [2, 2, 2, 60], 50) == [3]
    assert linededup.common_lines([1, 2, 9, 2, 3], [1, 2, 3], [20, 40, 20], 50) == [0, 1, 2]  # two blocks that overlap in b
    assert linededup.common_lines([s1, x, s2], [s1, y, s2], [30, 2, 30], 50) == []


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_common_lines_are_those_of_all_common_blocks(a, b):
    count = {0: 0, 1: 3, 2: 10, 3: 20, 4: 45, 5: 60}
    words = [count[x] for x in b]
    gone = set()
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if sum(words[j : j + n]) >= 50:
                gone.update(range(j, j + n))
    found = linededup.common_lines(a, b, words, 50)
    assert set(found) <= gone and {k for k in found if words[k]} == {k for k in gone if words[k]}


def test_rare_runs_cover_every_long_block():
    random.seed(3)
    for _ in range(200):
        words = [random.randint(0, 30) for _ in range(20)]
        lines = list(range(20))
        i, j = sorted(random.sample(range(21), 2))
        runs = set(linededup.rare_runs(lines, words, 50))
        inside = set(linededup.rare_runs(lines[i:j], words[i:j], 50))
        assert inside <= runs
        assert bool(inside) == (sum(words[i:j]) >= 50)


def sentence(seed, n):
    picked = random.Random(seed)
    return " ".join(f"w{picked.randint(0, 5000)}" for _ in range(n)) + "."


def kept_plainly(rows, least=50):
    """Each document is compared, line by line, with the first holder of each of its runs of `least` words."""
    left, first, known = {}, {}, {}
    for doc_id, text in sorted(rows):
        lines = [x.strip(" \t\r\x0b\x0c") for x in text.split("\n")]
        counts = [len(x.split()) for x in lines]
        partners = set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if counts[a] and sum(counts[a:b]) >= least:
                    partners.add(first.setdefault(tuple(lines[a:b]), doc_id))
                    break
        gone = set()
        for other in partners - {doc_id}:
            for a in range(len(lines)):
                for c in range(len(known[other])):
                    n = 0
                    while a + n < len(lines) and c + n < len(known[other]) and lines[a + n] == known[other][c + n]:
                        n += 1
                    if sum(counts[a : a + n]) >= least:
                        gone.update(range(a, a + n))
        known[doc_id] = lines
        left[doc_id] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return left


def test_shared_passages_go_from_later_documents(spark):
    passage = [sentence(s, 14) for s in range(5)]  # 70 words over five lines
    long_line, short_line = sentence(77, 60), "A short line that all share."
    rows = []
    for i in range(60):
        own = [sentence(1000 + 10 * i + k, 12) for k in range(6)]
        if i % 3 == 0:
            own[2:2] = passage
        if i % 7 == 0:
            own.append(long_line)
        if i % 10 == 4:
            own = [long_line, *passage[::-1], *own, *passage]
        rows.append((i, "\n".join([short_line, *own])))
    rows += [(100 + i, rows[5][1]) for i in range(20)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA).repartition(6)
    found = {r.doc_id: r.text for r in linededup.op5(docs).collect()}
    assert found == kept_plainly(rows)
    assert found[5] == rows[5][1] and found[1] == rows[1][1] and found[0] == rows[0][1]
    assert found[110] == "" and passage[0] not in found[3] and short_line in found[3]


def test_blank_lines_inside_a_passage_make_no_difference(spark):
    a, b, c = sentence(1, 30), sentence(2, 30), sentence(3, 10)
    rows = [(1, f"{a}\n{b}"), (2, f"{c}\n{a}\n\n \n{b}\n\n{c}"), (3, f"{a}\n{c}\n{b}"), (4, f"\n{a}\n\n{b}")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA)
    found = {r.doc_id: (r.text, r.n_words_removed) for r in linededup.dedup(docs).collect()}
    assert found == {1: (rows[0][1], 0), 2: (f"{c}\n\n{c}", 60), 3: (rows[2][1], 0), 4: ("", 60)}


def test_lines_that_repeat_take_little_time():
    passage = list(range(100, 130))
    a, b = (passage + [x for k in range(10_000) for x in ((0, k % 7 + 1) if n else (k % 5 + 1, 0))] for n in (0, 1))
    words = [0 if x == 0 else 2 for x in b]
    start = time.perf_counter()
    gone = linededup.deleted_lines(a, b, [0 if x == 0 else 2 for x in a], words, 50)
    assert set(range(30)) <= set(gone)
    assert time.perf_counter() - start < 10


def test_many_deleted_lines(spark):
    lines = [f"line {k} has some words of its own" for k in range(3000)]
    kept = [f"kept {k}" for k in range(10)]
    rows = [(1, "\n".join(lines), "s"), (2, "\n".join(x for k in range(10) for x in [kept[k], *lines[300 * k : 300 * k + 300]]), "s")]
    found = {r.doc_id: r for r in linededup.dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[2].text == "\n".join(kept) and found[2].n_lines_removed == 3000


def test_line_dedup_of_odd_rows(spark):
    long_text = "x " * 5000
    rows = [*ODD, (11, long_text, "s"), (None, long_text, "s"), (5, long_text, "s2")]
    found = linededup.dedup(odd(spark, rows).withColumn("gone", F.lit(1)))
    texts = {}
    for r in found.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[11] == [""] and texts[5] == [long_text] * 2 and texts[2] == [None] and texts[3] == [""]
    assert sorted(texts[None]) == ["null id", long_text]
    assert "gone" in found.columns
    assert linededup.op5(odd(spark, [])).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=40))
def test_components_against_union_find(spark, links):
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = components(spark.createDataFrame(links, "a int, b int")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted((r.node, r.root) for r in found) == sorted((x, root(x)) for x in linked)


def test_a_long_chain_is_one_component(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(chain).collect()} == {0}


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(zip(*(words[k:] for k in range(5))))


def components_plainly(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def edited(words, n, seed):
    picked = random.Random(seed)
    words = list(words)
    for k in picked.sample(range(len(words)), n):
        words[k] = f"edit{picked.randint(0, 10**9)}"
    return " ".join(words)


def test_near_duplicates_against_all_pairs(spark):
    random.seed(8)
    rows = []
    for g in range(6):
        base = sentence(g, 150).split()
        rows += [(1000 * g + i, edited(base, i % 6, 100 * g + i)) for i in range(40)]  # zero to five of 150 words changed
    rows += [(9000 + i, sentence(500 + i, 80)) for i in range(60)]
    rows += [(9500 + i, rows[3][1].upper().replace(" ", "\t")) for i in range(30)]  # copies but for case and blanks
    rows += [(9700 + i, "too short here") for i in range(4)] + [(9800, "Too SHORT here"), (9801, "too short"), (9802, "İ K")]
    random.shuffle(rows)
    docs = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA).repartition(5)
    found = neardup.op3(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(components_plainly(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_odd_rows(spark):
    found = neardup.op3(odd(spark)).collect()
    rows = [(d, t) for d, t, _ in ODD]
    order = lambda r: tuple((v is not None, v) for v in r)
    plain = sorted(components_plainly(rows), key=order)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=order) == plain
    assert all(r.kept is not None for r in found)
    assert neardup.op3(odd(spark, [])).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.8, 0.9])
@pytest.mark.parametrize("other", [400, 470])
def test_the_joint_estimate_is_close(share, other):
    random_ = np.random.default_rng(4)
    shape = neardup.Settings()
    errors = []
    for _ in range(40):
        values = random_.integers(0, 1 << 63, 2000, dtype=np.uint64)
        both = int(share * 400)
        a, b = values[:400], np.concatenate([values[:both], values[1000 : 1000 + other - both]])
        truth = both / (400 + other - both)
        pair = [neardup.sketch(x, shape)[None, :].astype(np.int32) for x in (a, b)]
        errors.append(neardup.similarity(*pair, np.array([400.0]), np.array([float(other)]), shape.base)[0] - truth)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_sketches_merge():
    values = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64)
    shape = neardup.Settings()
    parts = [neardup.sketch(values[:300], shape), neardup.sketch(values[200:], shape)]
    assert (np.maximum(*parts) == neardup.sketch(values, shape)).all()


def nearest_plainly(vectors, query, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids.tolist()])
    score = (x * vectors[query]).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((vectors[query] ** 2).sum())
    keep = ids != query
    order = np.lexsort((ids[keep], -score[keep]))[:k]
    return list(zip(ids[keep][order].tolist(), score[keep][order].tolist()))


def test_neighbours_of_a_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows.collect()}
    found = {}
    for r in neighbours.op1(rows).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    queries = [i for i in vectors if i % 50 == 0]
    assert sorted(found) == sorted(queries)
    hits = 0
    for q in queries:
        best = dict(nearest_plainly(vectors, q, len(vectors)))
        own = sorted(found[q])
        assert [n for n, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(abs(best[v] - s) < 1e-12 for _, v, s in own)
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        hits += len({v for _, v, _ in own} & {v for v, _ in nearest_plainly(vectors, q, 5)})
    assert hits / (5 * len(queries)) >= 0.9


def test_equal_vectors_tie_by_id_and_large_parts_are_cut(spark):
    shape = neighbours.Settings(block_rows=16, block_queries=2)
    rows = [(i, [1.0, 2.0, 0.1 * (i % 2)]) for i in range(200)]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0, settings=shape)
    by_query = {}
    for r in found.orderBy("query_id", "rank").collect():
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    assert by_query == {0: [2, 4, 6, 8, 10], 50: [0, 2, 4, 6, 8], 100: [0, 2, 4, 6, 8], 150: [0, 2, 4, 6, 8]}


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [1.0, None]),
        (7, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (100, None),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"rank": F.lit(1), "score": F.lit("x")})
    found = neighbours.op1(table).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert neighbours.op1(table.limit(0)).count() == 0


def test_every_length_is_searched_and_small_vectors_count(spark):
    random_ = np.random.default_rng(8)
    vectors = {i: random_.normal(size=3 if i % 4 else 5) * 10.0 ** random_.integers(-300, 300) for i in range(400)}
    vectors[1000], vectors[1001] = np.array([1.0, 2.0]), np.array([2.0, 1.0]) * 1e-200
    vectors[1002] = np.array([5e-324, 0.0])
    rows = [(i, v.tolist()) for i, v in vectors.items()]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {}
    for r in neighbours.op1(table).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(found) == [i for i in sorted(vectors) if i % 50 == 0]
    for q, near in found.items():
        same = {i: v / np.abs(v).max() for i, v in vectors.items() if len(v) == len(vectors[q])}
        best = nearest_plainly(same, q, 5)
        assert len(near) == min(5, len(same) - 1) and len({i for i, _ in near} & {i for i, _ in best}) >= min(4, len(best))
    assert [i for i, _ in found[1000]] == [1001, 1002]


def test_other_vectors_of_an_id_are_rows(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (1, [1.0, 0.2]), (1, [0.2, 1.0]), (1, [0.2, 1.0])]
    found = neighbours.op1(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [(50, 1, 1), (50, 1, 1), (50, 2, 1), (50, 2, 1), (50, 3, 50), (50, 3, 50)]


def test_parts_are_balanced_and_follow_the_graph():
    random_ = np.random.default_rng(5)
    points = np.concatenate([random_.normal(c, 0.1, (64, 8)) for c in np.eye(8)[:4] * 3])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph = neighbours.nearest(points, points, 6, own=True)
    label = neighbours.balanced_parts(graph, 4, random_)
    assert Counter(label.tolist()) == {0: 64, 1: 64, 2: 64, 3: 64}
    assert (label[graph] == label[:, None]).mean() > 0.85


def test_a_hub_is_dealt_out(spark):
    star = spark.range(1, 50_001).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b")).union(spark.range(100, 400).selectExpr("id", "id + 1"))
    counts = star.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("__n"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        found = spread.spread_join(star, counts.hint("merge"), "a", "b", spread.most_rows(50_300))
        sizes = [r.n for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 50_300 and max(sizes) < 3 * sum(sizes) / 50
        assert found.where("m is null").count() == 0 and found.columns == ["a", "b", "m"]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert {r.root for r in components(star.where("a = 0")).collect()} == {0}
