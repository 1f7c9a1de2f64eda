"""Fingerprints, the n-gram join and the embedding join against brute force."""
import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import fingerprints, ngram_join, vector_dups
from tests.llm.conftest import documents, prose


def grouped(nodes, links):
    label = {n: n for n in nodes}
    for _ in range(len(label) + 1):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def word_set(text, size=3):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def near_texts():
    base, out = prose(7, 120).split(), []
    for i in range(40):                                             # one group of near copies, some chained, some apart
        words, draw = list(base), random.Random(i)
        for _ in range(i % 7):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(9)}"
        out.append((100 + i, " ".join(words)))
    out += [(200 + i, f"a shared passage of many words that is common to all of these {i}") for i in range(30)]
    out += [(300 + i, prose(40 + i // 3, 60 + i % 3)) for i in range(30)]
    return out


def check_components(rows, like, size):
    sets = [(i, word_set(t, size)) for i, t in rows]
    ids = {i for i, _ in rows if i is not None}
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x and y and a is not None and b is not None
             and 100 * len(x & y) >= like * len(x | y)]
    return grouped(ids, links)


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 60)])
def test_ngram_components(spark, sf, size, percent):
    rows = near_texts()
    docs = spark.read.parquet(sf(documents=documents(rows)) + "/documents.parquet")
    want = check_components(rows, percent, size)
    got = ngram_join.near_components(docs, ngram_join.Likeness(size, percent)).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) < len(want)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(word_set(t, size)) for i, t in rows}


def test_ngram_odd_input(spark, sf, odd_texts):
    got = ngram_join.op4_ngram_jaccard_join(spark, sf(documents=documents(odd_texts))).collect()
    want = check_components(odd_texts, 90, 3)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == Counter((i, len(word_set(t)), want[i]) for i, t in odd_texts if i is not None)
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id is None} == {(78, 7), (0, None)}
    assert ngram_join.op4_ngram_jaccard_join(spark, sf(documents=documents([]))).collect() == []


@pytest.mark.parametrize("block", [256, 5])
def test_ngram_links(spark, sf, block):
    rows = near_texts() + [(400 + i, near_texts()[3 * i][1]) for i in range(8)]                # exact copies too
    sets = {i: word_set(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    count, part = Counter(x for pair in links for x in pair), check_components(rows, 90, 3)
    docs = spark.read.parquet(sf(documents=documents(rows)) + "/documents.parquet")
    got = ngram_join.near_counts(docs, ngram_join.Likeness(3, 90), block).collect()
    assert len(got) == len(rows) and {r.doc_id: (r.n_links, r.component_id) for r in got} == {i: (count[i], part[i]) for i in sets}
    first = {}
    for i in sorted(sets):
        first.setdefault(frozenset(sets[i]), i)
    different = {(a, b) for a, b in links if sets[a] != sets[b] and {a, b} <= set(first.values())}
    pairs = [tuple(r) for r in ngram_join.near_links(docs, ngram_join.Likeness(3, 90), block).collect()]
    assert sorted(pairs) == sorted(different) and len(different) > len(first) - len(set(part.values()))       # more than a tree of links


def test_ngram_links_odd_input(spark, sf, odd_texts):
    got = ngram_join.op4_ngram_links(spark, sf(documents=documents(odd_texts))).collect()
    found = Counter((r.doc_id, r.n_links) for r in got)
    assert len(got) == len(odd_texts) and found[(7, 2)] == 1 and found[(8, 2)] == 2 and found[(9, 2)] == 1 and found[(None, 0)] == 2 and found[(1, 0)] == 1
    assert found[(11, 1)] == found[(14, 1)] == 1 and found[(10, 0)] == 2
    assert ngram_join.op4_ngram_links(spark, sf(documents=documents([]))).collect() == []


def test_prefix_lengths_never_miss_a_pair():
    like, draw = ngram_join.Likeness(3, 90), random.Random(3)
    for _ in range(3000):
        a = draw.randrange(1, 60)
        b = draw.randrange(a, 67)
        need = next(i for i in range(b + 1) if 100 * i >= 90 * (a + b - i))
        if need <= a and a != b:
            assert like.prefixes(a)[1] >= a - need + 1 and like.prefixes(b)[0] >= b - need + 1


def test_near_copy_stage_keeps_one_of_each(spark, sf):
    rows = near_texts()
    docs = spark.read.parquet(sf(documents=documents(rows)) + "/documents.parquet")
    want = check_components(rows, 80, 5)
    out = ngram_join.near_copy_stage(spark, docs, None)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == set(want.values())


def test_repeated_rows_of_near_copies_cost_one_verification(spark, sf, monkeypatch):
    base = prose(5, 120).split()
    near = " ".join([*base[:60], "changed", *base[61:]])
    rows = [(1, " ".join(base))] * 1000 + [(2, near)] * 1000 + [(3, prose(6, 50))]
    stored, plain = {}, ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", lambda df, label: stored.setdefault(label, plain(df, label)))
    docs = spark.read.parquet(sf(documents=documents(rows)) + "/documents.parquet")
    got = ngram_join.near_components(docs, ngram_join.Likeness(5, 80)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == {(1, 1): 1000, (2, 1): 1000, (3, 3): 1}
    assert stored["central-pairs"].count() == 1 and stored["central-sets"].count() == 2 and stored["rest-pairs"].count() == 0


def test_near_copy_stage_on_repeated_and_null_ids(spark, sf):
    one, two = prose(1, 80), prose(2, 80)
    rows = ([(1, one), (1, one), (1, one), (2, one), (None, one), (None, one)]               # one text, six rows
            + [(None, two), (None, two), (None, two.upper()), (None, "  "), (None, None), (None, None)]
            + [(5, ""), (5, ""), (6, None), (7, prose(3, 60)), (7, prose(4, 60)), (8, prose(3, 60))])
    docs = spark.read.parquet(sf(documents=documents(rows)) + "/documents.parquet")
    out = ngram_join.near_copy_stage(spark, docs, None)
    got = out.collect()
    assert out.columns == docs.columns
    assert Counter((r.doc_id, (r.text or "").lower()) for r in got) == {
        (1, one): 1, (None, two): 1, (None, "  "): 1, (None, ""): 2, (5, ""): 1, (6, ""): 1, (7, min(prose(3, 60), prose(4, 60))): 1}
    assert ngram_join.near_copy_stage(spark, docs.limit(0), None).collect() == []


def sketch(text):
    words = text.encode().split()
    words = [w.decode() for w in words]
    hashes = {hashlib.md5(" ".join(words[k:k + 5]).encode()).hexdigest()[:12] for k in range(max(1, len(words) - 4))} if words else set()
    return sorted(h for h in hashes if h < "200000000000") or sorted(hashes)[:1]


def jaccard(a, b):
    return 1.0 if not a and not b else len({*a} & {*b}) / len({*a} | {*b})


def test_fingerprints(spark, sf, odd_texts):
    rows = [(i, t or "") for i, t in odd_texts]
    got = fingerprints.op1_fingerprints(spark, sf(documents=documents(odd_texts))).collect()
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(sketch(t)), "".join(sketch(edited)), jaccard(sketch(t), sketch(edited)), jaccard(sketch(t), sketch(following))))
    known = [tuple(r)[:7] for r in got if r.doc_id is not None]
    assert sorted(known) == sorted(want)
    assert sorted((r.n_chars, r.near_next) for r in got if r.doc_id is None) == [(0, None), (len(prose(1, 80)), None)]


def test_fingerprint_of_one_or_no_document(spark, sf):
    (only,) = fingerprints.op1_fingerprints(spark, sf(documents=documents([(3, "a b c d e f")]))).collect()
    assert only.near_next == 1.0 and only.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c"[:5]).hexdigest()
    assert fingerprints.op1_fingerprints(spark, sf(documents=documents([]))).collect() == []


def test_merged_sketch_is_that_of_both(spark):
    a, b = prose(1, 300), prose(2, 300)
    df = fingerprints.add_sketch(fingerprints.add_sketch(spark.createDataFrame([(a, b)], "a string, b string"), "a", "x"), "b", "y")
    (row,) = df.select(fingerprints.merge_sketches(F.col("x"), F.col("y")).alias("m"), fingerprints.containment(F.col("x"), fingerprints.merge_sketches(F.col("x"), F.col("y"))).alias("c")).collect()
    assert row.m == sorted({*sketch(a)} | {*sketch(b)}) and row.c == 1.0


EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"


def vector_rows():
    draw = np.random.default_rng(5)
    centre = draw.standard_normal((6, 16))
    rows = [(i, (centre[i % 6] + 0.13 * draw.standard_normal(16)).astype("f4").tolist(), i % 3) for i in range(240)]
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(10)]                       # exact copies
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [1.0, None], 1), (404, [math.nan] * 16, 1), (405, [math.inf] + [1.0] * 15, 1), (406, rows[0][1], None),
             (407, [1.0, 2.0], 1), (408, [2.0, 4.0], 1), (409, [-0.0, 1.0], 2), (410, [0.0, 1.0], 2)]
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_vector_links(spark, sf, block):
    rows = vector_rows()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, label in rows if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: x for i, _, x in rows}
    links = [(a, b) for a, b in itertools.combinations(unit, 2) if label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    count, part = Counter(x for pair in links for x in pair), grouped([i for i, _, _ in rows], links)
    vectors = spark.read.parquet(sf(embeddings=(EMBEDDINGS, rows)) + "/embeddings.parquet")
    got = vector_dups.near_vectors(vectors, block=block).collect()
    assert len(got) == len(rows) and len(links) > 500
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (count[i], part[i], part[i] == i) for i, _, _ in rows}


def test_vectors_none_null_and_repeated(spark, sf):
    assert vector_dups.op10_embedding_near_dedup(spark, sf(embeddings=(EMBEDDINGS, []))).collect() == []
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (None, [1.0, 0.0], 0)]
    got = sorted(vector_dups.op10_embedding_near_dedup(spark, sf(embeddings=(EMBEDDINGS, rows))).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, None)]


def test_tables_grow_with_bits():
    small, large = vector_dups.plan(1000, 10), vector_dups.plan(10**9, 10)
    assert small[0] < large[0] and small[1] < large[1]
