"""Toxicity, language ID and the suffix-tree model: held-out accuracy, probabilities, brute-force counts, odd input."""
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import langid, suffix_tree_lm, toxicity
from tests.llm.conftest import DOCUMENTS, documents, prose

LABELS = "doc_id bigint, quality int, toxic int"


def crc(i):
    return zlib.crc32(str(i).encode())


def toxic_corpus(n=600):
    draw, docs, labels = random.Random(2), [], []
    for i in range(n):
        words, bad = prose(i, draw.randrange(20, 120)).split(), i % 6 == 0
        for _ in range(6 if bad else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["grumblefoot", "snorkface", "mudbrain"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark, sf):
    docs, labels = toxic_corpus()
    got = toxicity.op5_toxicity(spark, sf(documents=documents(docs), labels=(LABELS, labels))).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(docs) and all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_toxicity_learns_nothing_from_held_out_labels(spark, sf):
    docs, labels = toxic_corpus(300)
    turned = [(i, q, 1 - t if crc(i) % 3 == 1 else t) for i, q, t in labels]
    a = toxicity.op5_toxicity(spark, sf(documents=documents(docs), labels=(LABELS, labels))).collect()
    b = toxicity.op5_toxicity(spark, sf(documents=documents(docs), labels=(LABELS, turned))).collect()
    assert sorted(a) == sorted(b)


def test_toxicity_rows_are_read_once_and_found_in_their_parts(monkeypatch):
    monkeypatch.setattr(toxicity, "_PART_ROWS", 3)
    texts = [prose(k, 5 + k) for k in range(8)] + [None, ""]
    for n in (0, 3, 10):
        rows = toxicity.Rows(((t, k % 2) for k, t in enumerate(texts[:n])), toxicity.WordHashes())
        assert len(rows) == n and len(rows.parts) == -(-n // 3)
        for k in range(n):
            assert rows[k][0].tolist() == toxicity.slots(texts[k], toxicity.WordHashes()).tolist() and rows[k][1] == k % 2


def test_toxicity_odd_input(spark, sf, odd_texts):
    labels = [(7, 1, 1), (7, 1, 0), (None, 1, 1), (8, None, None), (4, 0, 0), (999, 0, 1)]
    got = toxicity.op5_toxicity(spark, sf(documents=documents(odd_texts), labels=(LABELS, labels))).collect()
    assert len(got) == len(odd_texts) and all(r.score is not None for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in got if r.doc_id in (7, 8)}) == 1
    none = toxicity.op5_toxicity(spark, sf(documents=documents(odd_texts), labels=(LABELS, []))).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.op5_toxicity(spark, sf(documents=documents([]), labels=(LABELS, []))).collect() == []


def test_toxic_stage_keeps_rows_as_they_came(spark, sf):
    docs, labels = toxic_corpus()
    folder = sf(documents=documents(docs), labels=(LABELS, labels))
    df = spark.read.parquet(f"{folder}/documents.parquet")
    out = toxicity.toxic_stage(spark, df, folder)
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == df.columns and {i for i, _, t in labels if not t} <= kept and len(kept & {i for i, _, t in labels if t}) < 5


SYLLABLES = {"aa": "tor mel vin sa rok", "bb": "chi zhu lan qui eo", "cc": "ßer üng bö strä fju"}


def language_text(lang, seed, n=60):
    draw = random.Random(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randrange(1, 4))) for _ in range(n))


def test_language_on_held_out_rows(spark, sf):
    rows = [(i, language_text(lang, i), lang, "s", 1) for i in range(300) for lang in [list(SYLLABLES)[i % 3]]]
    got = langid.op9_language_id(spark, sf(documents=(DOCUMENTS, rows))).collect()
    truth = {i: lang for i, _, lang, *_ in rows}
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    turned = [(i, t, "cc" if crc(i) % 4 == 2 else lang, s, n) for i, t, lang, s, n in rows]
    assert sorted(langid.op9_language_id(spark, sf(documents=(DOCUMENTS, turned))).collect()) == sorted(got)


def test_language_odd_input(spark, sf, odd_texts):
    rows = [(i, t, None if i == 9 else ["en", "fr"][k % 2], "s", 1) for k, (i, t) in enumerate(odd_texts)]
    got = langid.op9_language_id(spark, sf(documents=(DOCUMENTS, rows))).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} <= {"en", "fr", "und"}
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"} and {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0}
    unknown = langid.op9_language_id(spark, sf(documents=(DOCUMENTS, [(i, t, None, "s", 1) for i, t in odd_texts]))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
    assert langid.op9_language_id(spark, sf(documents=(DOCUMENTS, []))).collect() == []


def test_language_letters_and_brute_force(spark, sf):
    """Numbers are no letters, marks belong to them; predictions equal those of plain zstandard over the same dictionaries."""
    rows = [(i, language_text(lang, i, 5 + i % 40), lang, "s", 1) for i in range(200) for lang in [list(SYLLABLES)[i % 3]]]
    rows += [(1000 + k, t, "aa", "s", 1) for k, t in enumerate(["½ ²", "①", "Ⅷ", "٣ 12", "\u0301", "", "हिन्दी", "q"])]
    path = sf(documents=(DOCUMENTS, rows))
    got = {r.doc_id: r for r in langid.op9_language_id(spark, path).collect()}
    assert {k for k in range(8) if got[1000 + k].lang_pred == "und"} == {0, 1, 2, 4, 5} | ({3} if not any(c.isalpha() for c in "٣ 12") else set())
    assert langid.normalised("हिन्दी 12 भाषा") == "हिन्दी भाषा" and langid.normalised("Été-2½") == "été"
    learned = langid.learn(spark.read.parquet(path + "/documents.parquet"))
    made = learned.compressors()
    for i, text, *_ in rows[:200]:
        letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        sizes = [len(c.compress(b"\0" * 64 + f" {' '.join(letters)} ".encode())) for c in made.values()]
        best = min(range(len(sizes)), key=lambda k: (sizes[k], k))
        assert got[i].lang_pred == list(made)[best]
        two, n = sorted(sizes)[:2], sum(map(len, letters))
        assert got[i].accepted == (two[1] > two[0] and got[i].score >= 0.02 * n / (n + 100))


def test_every_sampled_document_is_in_its_dictionary():
    pieces = [bytes([97 + k % 26]) * (5 if k % 3 else 400) for k in range(300)]
    content = langid.dealt(pieces, 30_000)
    parts = content.split()
    assert len(parts) == 300 and 29_000 < len(content) <= 30_000 and sorted({len(p) for p in parts})[0] == 5
    assert langid.dealt([], 10) == b"" and langid.dealt([b"abc"], 100) == b"abc "
    assert {langid.piece(i, "x" * 10 + "word " * 500, 50) for i in range(40)} != {langid.piece(0, "x" * 10 + "word " * 500, 50)}


def test_language_stage_rejects_only_what_cannot_be_told(spark, sf):
    rows = [(i, language_text(lang, i), lang, "s", 1) for i in range(120) for lang in [list(SYLLABLES)[i % 3]]] + [(900, "12345 !!!", "aa", "s", 1), (901, None, "aa", "s", 1)]
    df = spark.read.parquet(sf(documents=(DOCUMENTS, rows)) + "/documents.parquet")
    out = langid.language_stage(spark, df, None)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == set(range(120))


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def lm_rows():
    phrase = "one fixed phrase that many documents repeat word for word until its very end"
    return [(i, prose(i, 50) + (" " + phrase if i % 2 else "") + (" rare%d" % i)) for i in range(240)]


def test_lm_counts_base_and_gain(spark, sf):
    rows = lm_rows()
    got = {r.doc_id: r for r in suffix_tree_lm.op8_suffix_tree_lm(spark, sf(documents=documents(rows))).collect()}
    count = Counter(t for i, text in rows if crc(i) % 7 != 2 for t in tokens(text))
    n, v = sum(count.values()), len(count)
    for i, text in rows:
        r = got[i]
        assert r.held_out == (crc(i) % 7 == 2) and r.n_tokens == len(tokens(text)) and r.train_tokens == n
        assert r.n_known == sum(count[t] > 0 for t in tokens(text))
        assert r.base_score == pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(text)))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 10
    assert all(r.score < 0 for r in held)


class BruteTree:
    """The same tree from counts of all grams in dictionaries."""

    def __init__(self, texts, depth):
        docs = [tokens(t) for t in texts]
        self.grams = Counter(tuple(d[i:i + size]) for d in docs for size in range(1, depth + 2) for i in range(len(d) - size + 1))
        self.words = {g[0]: n for g, n in self.grams.items() if len(g) == 1}
        self.total, self.depth, self.nodes = sum(self.words.values()), depth, {}
        for size in range(1, depth + 1):
            grown = {}
            for context in [g for g, n in self.grams.items() if len(g) == size and n >= suffix_tree_lm.CONTEXT_COUNT]:
                edges = {w: self.grams[(*context, w)] for w in self.words if self.grams[(*context, w)] >= suffix_tree_lm.EDGE_COUNT}
                n = self.grams[context]
                before = {w: self.probability(context[1:], w) for w in edges}
                gain = sum(k * math.log(k / n / before[w]) for w, k in edges.items())
                rest = n - sum(edges.values())
                if rest:
                    gain += rest * math.log(rest / n / max(1 - sum(before.values()), 1e-12))
                if edges and gain > suffix_tree_lm.PENALTY * len(edges):
                    grown[context] = edges
            self.nodes.update(grown)

    def probability(self, context, word):
        context = tuple(context)[-self.depth:]
        if not context:
            return (self.words.get(word, 0) + 1) / (self.total + len(self.words) + 1)
        shorter = self.probability(context[1:], word)
        if context not in self.nodes:
            return shorter
        edges, n = self.nodes[context], self.grams[context]
        free = 1 - (sum(edges.values()) - suffix_tree_lm.DISCOUNT * len(edges)) / n
        return max(edges.get(word, 0) - suffix_tree_lm.DISCOUNT, 0) / n + free * shorter

    def score(self, text):
        seen = tokens(text)
        return sum(math.log10(self.probability(seen[max(0, i - self.depth):i], w)) for i, w in enumerate(seen))


def tree_rows():
    """Words whose successor shows only one, two, three or four words further back, among prose."""
    draw, rows = random.Random(5), []
    for i in range(90):
        parts = [prose(i, 12), "rare%d" % i]
        for far, between in (("i", ""), ("j", "k"), ("l", "m n"), ("p", "q r s")):
            which = draw.randrange(4)
            parts.append(f"{far}{which} {between} after{far}{which}")
        rows.append((i, " ".join(parts)))
    return rows


def test_lm_probabilities_sum_to_one():
    tree = BruteTree([t for _, t in tree_rows()], 4)
    assert {1, 2, 3, 4} == {len(c) for c in tree.nodes}
    for context in sorted(tree.nodes)[::7]:
        assert sum(tree.probability(context, w) for w in [*tree.words, b"never seen"]) == pytest.approx(1.0)


@pytest.mark.parametrize("hot_entries", [0, 500, 1 << 20])
@pytest.mark.parametrize("depth", [1, 4])
def test_lm_scores_as_brute_force(spark, sf, depth, hot_entries):
    rows = tree_rows()
    docs = spark.read.parquet(sf(documents=documents(rows)) + "/documents.parquet").withColumn("held_out", F.col("doc_id") % 5 == 0)
    tree = BruteTree([t for i, t in rows if i % 5], depth)
    assert {len(c) for c in tree.nodes} == set(range(1, depth + 1))
    got = suffix_tree_lm.score(docs, suffix_tree_lm.learn(docs.where("not held_out"), depth), depth, hot_entries).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        seen = tokens(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id % 5 == 0, len(seen), sum(t in tree.words for t in seen), tree.total)
        assert r.score == pytest.approx(tree.score(text[r.doc_id]))


def test_lm_full_bitmaps_change_no_score(spark, sf, monkeypatch):
    docs = spark.read.parquet(sf(documents=documents(tree_rows())) + "/documents.parquet").withColumn("held_out", F.col("doc_id") % 5 == 0)
    want = {r.doc_id: r.score for r in suffix_tree_lm.score(docs, suffix_tree_lm.learn(docs.where("not held_out"))).collect()}
    monkeypatch.setattr(suffix_tree_lm, "places_of", lambda grams, count: suffix_tree_lm.Places(15, np.full(1 << 12, 255, np.uint8)))
    got = suffix_tree_lm.score(docs, suffix_tree_lm.learn(docs.where("not held_out")), hot_entries=100).collect()
    assert {r.doc_id: r.score for r in got} == {i: pytest.approx(s) for i, s in want.items()}


@pytest.mark.parametrize("passes", [1, 3])
def test_lm_scoring_stores_results_alone(spark, sf, monkeypatch, passes):
    rows, stored = [(i, f"{text} " * 20) for i, text in tree_rows()], []
    docs = spark.read.parquet(sf(documents=documents(rows)) + "/documents.parquet").withColumn("held_out", F.col("doc_id") % 5 == 0)
    model = suffix_tree_lm.learn(docs.where("not held_out"))
    want = {r.doc_id: r.score for r in suffix_tree_lm.score(docs, model).collect()}

    def kept(df, label):
        out = materialize(df, label)
        stored.append(sum(os.path.getsize(f.removeprefix("file:")) for f in out.inputFiles()))
        return out

    materialize = suffix_tree_lm.materialize
    monkeypatch.setattr(suffix_tree_lm, "materialize", kept)
    monkeypatch.setattr(suffix_tree_lm, "PASSES", passes, raising=False)
    monkeypatch.setattr(suffix_tree_lm, "PASS_TOKENS", 1, raising=False)
    got = suffix_tree_lm.score(docs, model, hot_entries=0).collect()
    assert {r.doc_id: r.score for r in got} == {i: pytest.approx(s) for i, s in want.items()} and len(got) == len(rows)
    assert sum(stored) < 40_000 and len(stored) == (passes if passes > 1 else 0)     # not the grams that are asked for


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_lm_words_are_hashed_alike_wherever_texts_are_cut(monkeypatch, odd_texts, block):
    monkeypatch.setattr(suffix_tree_lm, "_BLOCK", block)
    texts = [t for _, t in odd_texts if t is None or len(t) < 5000]
    ((_, flat, lengths),) = suffix_tree_lm._hashed([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])], 0)
    want = [w for t in texts for w in tokens(t)]
    assert lengths.tolist() == [len(tokens(t)) for t in texts] and len(flat) == len(want)
    of_word = dict(zip(want, flat.tolist()))
    assert [of_word[w] for w in want] == flat.tolist() and len(set(of_word.values())) == len(of_word)


def test_lm_odd_input(spark, sf, odd_texts):
    got = suffix_tree_lm.op8_suffix_tree_lm(spark, sf(documents=documents(odd_texts))).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(tokens(t)) for _, t in odd_texts)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got) and all(r.n_tokens == 1 for r in got if r.doc_id in (1, 2, 3))
    assert suffix_tree_lm.op8_suffix_tree_lm(spark, sf(documents=documents([]))).collect() == []
    only = next(i for i in range(100) if crc(i) % 7 == 2)
    (r,) = suffix_tree_lm.op8_suffix_tree_lm(spark, sf(documents=documents([(only, "a b")]))).collect()
    assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_lm_keeps_contexts_of_few_occurrences_in_a_large_corpus(spark, tmp_path):
    phrase = " ".join(f"only{k}" for k in range(30))
    held = next(i for i in range(1000, 2000) if crc(i) % 7 == 2)
    trained = [i for i in range(1000, 2000) if crc(i) % 7 != 2][:4]
    few = spark.createDataFrame([(i, phrase) for i in (held, *trained)], "doc_id bigint, text string")
    filler = [i for i in range(1000) if crc(i) % 7 != 2][:20]
    many = spark.createDataFrame([(i,) for i in filler], "doc_id bigint").repartition(8).select("doc_id", F.repeat(F.lit("a "), 500_000).alias("text"))
    many.unionByName(few).write.parquet(f"{tmp_path}/documents.parquet")                  # ten million training tokens, a phrase of which occurs four times
    (r,) = suffix_tree_lm.op8_suffix_tree_lm(spark, str(tmp_path)).where(F.col("doc_id") == held).collect()
    assert r.train_tokens > 10_000_000 and r.score > r.base_score + 29 * 5
