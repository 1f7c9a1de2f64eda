"""WARC, SentencePiece, packing, quotations and the pipeline: round trips and brute force."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from starloom.llm import packing, pieces, quotations, warc
from starloom.session import shared_dir
from tests.llm.conftest import DOCUMENTS, documents, prose

PAGES = "page_id bigint, url string, html string"


def page_rows():
    big = "<p>" + prose(1, 400) + "</p>"
    return [(1, "http://a/1", big), (2, "http://a/2", big), (3, "http://a 3\r\nX: y", "<p>short</p>"), (4, None, "<p>short</p>"), (5, "http://é/5", None), (6, "", ""), (7, "http://a/7", "ü" * 499),
            (8, "u", "ü" * 499), (9, "u", "ü" * 500), (10, "u", "ü" * 500), (10, "u", "ü" * 500), (None, "u", big), (11, "u", prose(3, 60_000)), (-4, "u", big + "\r\n\r\nWARC/1.1\r\n")]


def test_warc_query(spark, sf):
    rows = page_rows()
    got = warc.op2_warc(spark, sf(pages=(PAGES, rows))).collect()
    largest = defaultdict(list)
    for i, _, h in rows:
        largest[h or ""].append(-10**9 if i is None else i)
    want = []
    for i, _, h in rows:
        data, first = (h or "").encode(), max(largest[h or ""])
        refers = first if len(data) >= 1000 and first != i else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(want)
    assert warc.op2_warc(spark, sf(pages=(PAGES, []))).collect() == []


@pytest.mark.parametrize("split", [1, 97, 1000, 1 << 20])
def test_warc_splits_own_every_record_once(spark, tmp_path, split):
    rows = [r for r in page_rows() if len(r[2] or "") < 5000]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    manifest = warc.write_archives(warc.planned_records(pages), f"file://{tmp_path}/archive")
    (entry,) = manifest.collect()
    seen = [x for start in range(0, entry.bytes, split) for x in warc.owned_records(entry.path, start, start + split)]
    assert [at for at, _, _ in seen] == sorted({at for at, _, _ in seen}) and len(seen) == entry.records == len(rows)
    assert all(len(block) == int(h["Content-Length"]) and "sha1:" + hashlib.sha1(block).hexdigest() == h["WARC-Block-Digest"] for _, h, block in seen)
    records = warc.read_archives(manifest, split_bytes=max(split, 500)).collect()
    assert len(records) == len(rows) and all(r.computed_digest == r.payload_digest for r in records if r.record_type == "response")


def test_warc_magic_inside_a_payload_is_no_record(tmp_path):
    inner = warc.member(1, "u", b"inner", "0", None)
    noise = random.Random(1).randbytes(3000)
    path = tmp_path / "x.warc.gz"
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)                    # level 0 leaves the payload as it is
    outer = stored.compress(b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3000\r\n\r\n" + inner + noise) + stored.flush()
    path.write_bytes(warc.member(2, "u", b"a", "0", None) + outer + warc.member(3, "u", b"b", "0", None))
    size = path.stat().st_size
    whole = [at for at, _, _ in warc.owned_records(str(path), 0, size)]
    for split in (50, 200, 1000):
        assert [at for s in range(0, size, split) for at, _, _ in warc.owned_records(str(path), s, s + split)] == whole and len(whole) == 3


def odd_strings():
    draw = random.Random(4)
    fixed = ["Hello  world", "  a b", "a\nb\tc", "", "é\U0001f600x", "▁a", " ", "x\x00y", "<s> </s><unk>", "中文字符测试" * 60, "a" * 1500, "abc" * 300 + " x", "\n\n   \n", "\U0010ffff x \U0010ffff", None]
    return fixed + ["".join(draw.choice("abcdeehtino rs\n\t  ▁éüß中😀.,'-%<0xA>") for _ in range(draw.randrange(60))) for _ in range(300)]


def test_sentencepiece_equals_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    runs, texts = pieces.Runs(pieces.model_path()), odd_strings()
    ids = runs.encode(texts)
    assert [list(map(int, i)) for i in ids] == [model.encode(t) if t else [] for t in texts]
    assert [runs.decode(i) for i in ids] == [model.decode(i.tolist()) for i in ids]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    back = {r.doc_id: r.text for r in pieces.decode_documents(pieces.encode_documents(df)).collect()}
    assert back == {k: (t or "").replace("▁", " ") for k, t in enumerate(texts)}
    assert runs.decode(np.array([-1, 10**6, 0xE9 + 3])) == "�"


def test_sentencepiece_query(spark, sf, odd_texts):
    got = pieces.op3_sentencepiece(spark, sf(documents=documents(odd_texts))).collect()
    assert len(got) == len(odd_texts) and all(r.round_trip and r.n_ids == len(r.ids) for r in got)
    assert pieces.op3_sentencepiece(spark, sf(documents=documents([]))).collect() == []


def reference_ids(text):
    from tokenizers import Tokenizer

    reference_ids.t = getattr(reference_ids, "t", None) or Tokenizer.from_file(packing.tokenizer_path())
    return reference_ids.t.encode(text or "", add_special_tokens=False).ids + [1]


def test_word_ids_equal_the_tokenizer():
    words = packing.WordIds(packing.tokenizer_path())
    draw = random.Random(6)
    texts = ["it's they're ’s", "ΣΑΣ İstanbul ǅ", "a\x1cb \x85 c d", "<|endoftext|>x <|startoftext|>", "ÀÉÎõü-x. %%% 12ab", "é ﬁ ½ Ⅷ", "", None]
    texts += ["".join(draw.choice("abEéÜßıİſ σΣ\n\t.,!'%&12中😀\x1d́-") for _ in range(draw.randrange(50))) for _ in range(1500)]
    for t in texts:
        assert np.frombuffer(words.of(t), "<u4").tolist() + [1] == reference_ids(t), t


def test_packing_query(spark, sf, odd_texts):
    rows = odd_texts + [(100 + i, prose(i, 40 + 37 * i)) for i in range(60)]
    got = packing.op6_packing(spark, sf(documents=documents(rows))).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array(reference_ids(t), "<u4")
        for p in range(-(-len(ids) // 4096)):
            part = ids[4096 * p:4096 * p + 4096]
            want[i, p, 4096 * p, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= -(-sum(r.length for r in got) // 4096) + 2
    assert packing.op6_packing(spark, sf(documents=documents([]))).collect() == []


def test_null_and_repeated_ids_spread_over_the_groups(spark):
    pieces = packing.materialize(spark.range(12_000).selectExpr("if(id < 8000, null, 7L) AS doc_id", "0 AS piece", "1 + id % 900 AS length"), "pieces")
    groups = packing.pack(pieces, group_pieces=1000).groupBy((F.col("sequence_id") / 2**32).cast("int").alias("g")).count().collect()
    assert len(groups) == 12 and sum(r["count"] for r in groups) == 12_000 and max(r["count"] for r in groups) < 1200


def test_sum_of_squares_rule():
    draw = np.random.default_rng(3)
    for capacity in (5, 12):
        lengths = draw.integers(1, capacity + 1, 200)
        where, offset = packing.sum_of_squares(lengths, capacity)
        fill = {}
        for s, b, o in zip(lengths.tolist(), where.tolist(), offset.tolist()):
            gaps = Counter(capacity - f for f in fill.values() if f < capacity)

            def after(gap):
                c = Counter(gaps)
                if gap < capacity:
                    c[gap] -= 1
                if gap > s:
                    c[gap - s] += 1
                return sum(v * v for v in c.values())

            options = {g: after(g) for g in {*gaps, capacity} if g >= s and (g == capacity or gaps[g])}
            assert fill.get(b, 0) == o and options[capacity - o] == min(options.values())
            fill[b] = o + s


MESSAGES = "conv_id bigint, turn bigint, role string, text string"


def thread_rows():
    rows = []
    for c in range(25):
        draw, own = random.Random(c), []
        for t in range(draw.randrange(1, 14)):
            said = f"Statement {t} of thread {c} has words. It ends with number {draw.randrange(5)} here!"
            quote = draw.randrange(t) if t and draw.random() < 0.6 else None
            text = said
            if quote is not None:
                deeper = f"\n>> {own[draw.randrange(quote)]}" if quote and draw.random() < 0.4 else ""
                text = f"Someone wrote:\n> {own[quote][:34]}\n> {own[quote][35:]}{deeper}\n\n{said}"
            own.append(said)
            rows.append((c, t, "user", text))
    return rows


def test_quotations_against_brute_force(spark, sf):
    rows = thread_rows()
    got = quotations.op7_quotation_linking(spark, sf(conversations=(MESSAGES, rows))).collect()
    by = defaultdict(list)
    for c, t, _, text in rows:
        by[c].append((t, text))
    want = {}
    for c, messages in by.items():
        parsed, parent = [quotations.parse(text) for _, text in messages], []
        for n, (_, _, quoted) in enumerate(parsed):
            hits = Counter()
            for level, h in quoted:
                source = max((m for m in range(n) if h in parsed[m][1]), default=None)
                if source is not None:
                    hits[level, source] += 1
            best = max(hits.items(), key=lambda x: (-x[0][0], x[1], x[0][1]), default=None)
            parent.append(best[0][1] if best else n - 1)
        order = []

        def visit(n):
            order.append(n)
            for m in range(n + 1, len(parent)):
                if parent[m] == n:
                    visit(m)

        visit(0)
        for n, (t, _) in enumerate(messages):
            want[c, t] = (parsed[n][0], None if parent[n] < 0 else messages[parent[n]][0], order.index(n) + 1)
    assert {(r.conv_id, r.turn): (r.text, r.reply_to, r.place) for r in got} == want
    assert all(">" not in r.text and "wrote" not in r.text for r in got) and any(r.place != r.turn + 1 for r in got)


def test_quotations_odd_input(spark, sf):
    rows = [(1, 0, "user", None), (1, 1, "user", ""), (1, 1, "user", ""), (1, None, "user", "> only a quote"), (None, 5, "user", "alone"), (None, 5, "user", "> x\nalone"), (2, 7, None, "a > b\n\n\n\nc")]
    got = quotations.op7_quotation_linking(spark, sf(conversations=(MESSAGES, rows))).collect()
    assert sorted(((r.conv_id, r.turn, r.text, r.place) for r in got), key=str) == sorted(
        [(1, None, "", 1), (1, 0, "", 2), (1, 1, "", 3), (1, 1, "", 4), (None, 5, "alone", 1), (None, 5, "alone", 1), (2, 7, "a > b\n\n\n\nc", 1)], key=str)
    assert quotations.op7_quotation_linking(spark, sf(conversations=(MESSAGES, []))).collect() == []


def test_pipeline(spark, sf):
    from tests.llm.test_models import LABELS, SYLLABLES, language_text, toxic_corpus
    from tests.llm.test_similarity import check_components, near_texts

    toxic, labels = toxic_corpus(240)
    rows = [(1000 + i, t, "en", "s", 1) for i, t in toxic] + [(i, t, "en", "s", 1) for i, t in near_texts()]
    rows += [(5000 + i, language_text(lang, i), lang, "s", 1) for i in range(90) for lang in [list(SYLLABLES)[i % 3]]] + [(9000, "12 34 56", "en", "s", 1), (9001, None, None, None, None)]
    folder = sf(documents=(DOCUMENTS, rows), labels=(LABELS, [(1000 + i, q, t) for i, q, t in labels]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage-{k}")
        docs = spark.read.parquet(f"{folder}/stage-{k}")
        kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    assert not set(kept[1]) & {9000, 9001} and set(kept[0]) - set(kept[1]) == {9000, 9001}
    assert set(kept[2]) == set(check_components(list(kept[1].items()), 80, 5).values())
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == set(kept[2])
    assert sum(r.length for r in got) == sum(len(reference_ids(t)) for t in kept[2].values())


def test_a_lost_writer_leaves_no_records(spark, tmp_path):
    assert shared_dir(spark)
    pages = spark.createDataFrame(page_rows()[:6], PAGES)
    manifest = warc.write_archives(warc.planned_records(pages), f"file://{tmp_path}/a")
    (tmp_path / "a" / "part-000000-999.warc.gz").write_bytes(warc.member(77, "u", b"left over", "0", None))
    assert 77 not in {int(r.record_id.split(":")[-1][:-1]) for r in warc.read_archives(manifest).collect()}


def test_word_ids_are_kept_within_a_bound_and_shared_by_the_tasks_of_a_worker(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE_WORDS", 3)
    words, whole = packing.WordIds(packing.tokenizer_path()), "one two. three, four five! six one two. seven four"
    expected = [words.tokenizer.encode(whole, add_special_tokens=False).ids] * 2
    assert [np.frombuffer(words.of(whole), "<u4").tolist() for _ in range(2)] == expected
    assert len(words) == 3 and len(words.cores) <= 3 and {"one", "two."} <= set(words)
    assert packing.word_ids(packing.tokenizer_path()) is packing.word_ids(packing.tokenizer_path())


def test_plain_words_go_without_the_pattern(monkeypatch):
    whole = packing.WordIds(packing.tokenizer_path()).of("Plain WORDS only words")
    monkeypatch.setattr(packing, "_PLAIN", None)
    assert packing.WordIds(packing.tokenizer_path()).of("Plain WORDS only words") == whole
