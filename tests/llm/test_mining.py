"""Conversation repair, hard negatives and the quality classifier against brute force, on odd rows too."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from conftest import DOCUMENTS, documents, prose
from starloom.llm import conversation_repair as repair
from starloom.llm import hard_negatives as mining
from starloom.llm import quality
from starloom.llm.queries import QUERIES



def shape_ok(initials: str) -> bool:
    rest = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (len(rest) > 0 and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def cheapest(signs: str):
    """All ways to edit a few rows, with up to two insertions in each gap: the least (cost, audit)."""
    def ways(sign):
        yield 4, "D", ""
        if sign != "x":
            cut = 3 if sign.isupper() else 0
            yield cut, "K", sign.lower()
            yield 3 + cut, "R", "u"
            yield 3 + cut, "R", "a"

    gaps = [(3 * n, "I" * n, "".join(r)) for n in range(3) for r in itertools.product("ua", repeat=n)]
    best = None
    for rows in itertools.product(*map(lambda s: list(ways(s)), signs)):
        if best and sum(r[0] for r in rows) > best[0]:
            continue
        for put in itertools.product(gaps, repeat=len(signs) + 1):
            cost = sum(r[0] for r in rows) + sum(g[0] for g in put)
            audit = put[0][1] + "".join(r[1] + g[1] for r, g in zip(rows, put[1:]))
            if (best is None or (cost, audit) < best) and shape_ok(put[0][2] + "".join(r[2] + g[2] for r, g in zip(rows, put[1:]))):
                best = (cost, audit)
    return best


def whole(signs: str, parts: int = 1):
    size = -(-len(signs) // parts)
    tables = [repair.segment_table(signs[k:k + size], k == 0) for k in range(0, len(signs), size)]
    told = tables[0]
    for table in tables[1:]:
        told = repair.joined(told, table)
    return min([(c, a) for _, q, c, a in told if q in (0, 3)] + [(c + 3, a + "I") for _, q, c, a in told if q == 2])


def test_search_finds_the_least_cost_and_audit():
    for n in (1, 2):
        for signs in itertools.product("suaoSUAOx", repeat=n):
            assert whole("".join(signs)) == cheapest("".join(signs)), signs
    draw = random.Random(4)
    for _ in range(60):
        signs = "".join(draw.choice("suaoSUAOx") for _ in range(3))
        assert whole(signs) == cheapest(signs) == repair.search(signs, 0, None), signs


def step_by_step(signs: str):
    """The least (cost, audit) per end state, row after row: for long conversations."""
    best = {0: (0, "")}
    for sign in signs:
        after = {}
        for state, (cost, audit) in best.items():
            for put in (0, 1):
                q, c, a = (state, cost, audit) if not put else (repair._NEXT[state], cost + 3, audit + "I")
                moves = [(q, c + 4, a + "D")]
                if sign != "x":
                    cut = 3 if sign.isupper() else 0
                    moves.append((repair._NEXT[q], c + 3 + cut, a + "R"))
                    if (sign.lower(), q) in repair._AFTER_KEEP:
                        moves.append((repair._AFTER_KEEP[sign.lower(), q], c + cut, a + "K"))
                for q2, c2, a2 in moves:
                    if q2 not in after or (c2, a2) < after[q2]:
                        after[q2] = (c2, a2)
        best = after
    return min([best[q] for q in (0, 3) if q in best] + ([(best[2][0] + 3, best[2][1] + "I")] if 2 in best else []))


def test_segments_join_to_the_whole():
    draw = random.Random(5)
    for n in (4, 9, 30, 61):
        for _ in range(12):
            signs = "".join(draw.choice("sususuauauauaoSUAOx") for _ in range(n))
            assert whole(signs) == whole(signs, 3) == whole(signs, 5) == step_by_step(signs) == repair.search(signs, 0, None)
    for signs in ("u" * 96, "a" * 96, "x" * 96, "s" * 96, "U" * 96, "ua" * 48, "O" * 96):
        assert whole(signs) == step_by_step(signs)


def expected_report(rows):
    """The contract, conversation by conversation, in plain Python."""
    out, blank_chars = {}, " \t\n\x0b\f\r"
    for conv, *_ in rows:
        out.setdefault(conv, [])
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, turns in out.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, signs, counts = set(), "", [0, 0, 0]
        for _, role, text in turns:
            end = text.rstrip(blank_chars)[-1:]
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end not in ".!?" else 3
            seen.add((role, text))
            sign = role[:1] if role[:1] in ("s", "u", "a") else "o"
            signs += "x" if fault < 2 else sign.upper() if fault == 2 else sign
            if fault < 3:
                counts[fault] += 1
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit = step_by_step(signs) if turns else (0, "")
        state, done, rest = 0, [], iter(turns)
        for step in audit:
            turn = None if step == "I" else next(rest)
            if step != "D":
                state = repair._NEXT[state] if step in "IR" else repair._AFTER_KEEP[turn[1][:1], state]
                done.append(f"{turn[1] if step == 'K' else ('user', 'assistant')[state == 3]}:{turn[2] if turn else ''}")
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def test_repair_query(spark, sf, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 7)
    monkeypatch.setattr(repair, "FAN", 3)
    draw, rows = random.Random(6), []
    for conv in range(60):
        for turn in range(draw.randrange(9)):
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", "tool", "", None]), draw.choice(["Hello there.", "no end", "", " \t\n", None, "Why?", f"{draw.random()}!"])))
    rows += [(900, t, ("user", "assistant")[t % 2], f"turn {t}{'.' if t % 5 else ''}") for t in range(300)]          # a hot conversation
    rows += [(901, 1, "user", "again and again.")] * 150 + [(None, 3, "user", "Null conversation."), (None, None, "assistant", "Null turn."), (902, None, "user", "x" * 300_000 + ".")]
    rows += [(903, 5, "user", "b."), (903, 5, "assistant", "a."), (903, 2**40, "user", "far."), (903, -3, "system", "é😀?")]
    folder = sf(conversations=("conv_id bigint, turn bigint, role string, text string", rows))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, folder).collect()}
    assert got == expected_report(rows)
    for conversation in (900, None):
        found = spark.createDataFrame([r for r in rows if r[0] == conversation], "conv_id bigint, turn bigint, role string, text string")
        stored = repair.marked(found)
        turns = repair.repaired_turns(stored, repair.repairs(repair.faults(stored))).collect()
        assert [t.place for t in turns] == list(range(1, len(turns) + 1)) and shape_ok("".join(t.role[0] for t in turns))
    empty = sf(conversations=("conv_id bigint, turn bigint, role string, text string", []))
    assert QUERIES["op11_conversation_repair"](spark, empty).collect() == []


def mined(rows):
    """Hard negatives of (vec_id, embedding, label) rows by comparing everything."""
    usable = {}
    for vec, v, label in rows:
        if vec is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v):
            label = int(np.fmod(label + 1, 10)) if vec % 7 == 0 else label
            usable[(vec, label, tuple(int(np.floor(256 * float(x))) for x in v))] = None
    out, held = [], lambda x: max(-2**63, min(2**63 - 1, x))
    for a in usable:
        if a[0] % 100:
            continue
        scored = sorted((-held(sum(x * y for x, y in zip(a[2], b[2]))), b[0], b[1]) for b in usable if b is not a and len(b[2]) == len(a[2]))
        for p_score, p, _ in [s for s in scored if s[2] == a[1]][:5]:
            inside = [s for s in scored if s[2] != a[1] and 80 * -p_score <= 100 * -s[0] <= 100 * -p_score][:5]
            out += [(a[0], p, k + 1, s[1], -p_score, -s[0]) for k, s in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("rows_a_block", [64, 16_384])
def test_hard_negatives(spark, sf, monkeypatch, rows_a_block):
    monkeypatch.setattr(mining, "BLOCK_ROWS", rows_a_block)
    draw = np.random.default_rng(7)
    centre = draw.standard_normal((3, 6))
    rows = [(i, [float(x) for x in centre[i % 3] + draw.standard_normal(6) * 0.4], int(draw.integers(0, 4) if i % 3 else 1)) for i in range(700)]
    rows += [(1000 + k, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], k % 2) for k in range(60)]                       # many ties, at all windows' ends
    rows += [(2000, [0.0] * 6, 1), (2100, [0.0] * 6, 1), (2101, [0.0] * 6, 2), (2200, [-1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 3), (2201, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 3)]
    rows += [(3000, [1.0, 2.0], 1), (3001, [1.0, 2.5], 1), (3002, [1.0, 2.0], 2), (4000, [1e30, 1.0], 5), (4001, [1e15, 3.0], 5), (4002, [1e15, 3.0], 6)]
    rows += [(5000, None, 1), (5100, [], 1), (5200, [None, 1.0], 1), (5300, [float("nan"), 1.0], 1), (5400, [float("inf"), 1.0], 1), (5500, [1.0, 2.0], None), (None, [1.0, 2.0], 1)]
    rows += rows[:30] + [(200, rows[5][1], 1), (-700, rows[7][1], -4)]
    folder = sf(embeddings=("vec_id bigint, embedding array<double>, label int", rows))
    want = mined(rows)
    assert sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, folder).collect())) == want and len(want) > 100
    assert QUERIES["op12_hard_negatives"](spark, sf(embeddings=("vec_id bigint, embedding array<double>, label int", []))).collect() == []


def test_keys_sort_as_their_parts():
    draw = random.Random(8)
    parts = [tuple(draw.choice([-2**63, -5, -1, 0, 1, 7, 2**63 - 1]) for _ in range(5)) for _ in range(300)]
    keys = mining.pack_keys(*(np.array(c, np.int64) for c in zip(*parts)))
    assert [mining.unpack_key(k) for k in keys] == parts
    assert sorted(parts, key=lambda p: (p[0], p[1], -p[2], p[3], p[4])) == [mining.unpack_key(k) for k in sorted(keys)]


def test_windows_hold_a_few_rows_only():
    """A stream of any length: one anchor with half a million candidates, read as it comes."""
    n = 500_000
    stream = zip(mining.pack_keys(np.zeros(n), np.zeros(n), np.arange(2 * n, n, -1), np.arange(n), np.arange(n)), (k == 10 for k in range(n)))
    assert [(r[1], r[2], r[3]) for r in mining.open_windows(stream)] == [(10, k, 10 + k) for k in range(1, 6)]


def junk(seed: int) -> str:
    words = prose(seed, 60).split()
    kind = seed % 3
    return " | ".join(words) if kind == 0 else " ".join(w.upper() + "!!" for w in words) if kind == 1 else " ".join(w for w in words[:6] for _ in range(12))


def test_quality(spark, sf, odd_texts):
    texts = [(i, junk(i) if i % 4 == 1 else prose(i, 80)) for i in range(20, 1400)]
    labels = [(i, int(i % 4 != 1), 0) for i, _ in texts] + [(20, 1, 0), (None, 0, 0), (21, None, 0), (5_000_000, 1, 0)]
    rows = documents(odd_texts + texts + [texts[0]] * 40)
    folder = sf(documents=rows, labels=("doc_id bigint, quality int, toxic int", labels))
    got = QUERIES["op13_compression_quality"](spark, folder).collect()
    assert len(got) == len(rows[1]) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = {i: int(i % 4 != 1) for i, _ in texts}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    by_text = {}
    text_of = dict(texts)
    for r in got:
        if r.doc_id in text_of:
            assert by_text.setdefault(text_of[r.doc_id], r.score) == r.score
    nothing = [r.score for r in got if r.doc_id in (1, 2, 3)]
    assert len(set(nothing)) == 1
    one = sf(documents=documents(texts[:40]), labels=("doc_id bigint, quality int, toxic int", [(i, 1, 0) for i in range(20, 40) if zlib.crc32(str(i).encode()) % 4 != 2]))
    n = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(20, 40))
    assert {round(r.score, 9) for r in QUERIES["op13_compression_quality"](spark, one).collect()} == {round((n + 1) / (n + 2), 9)}
    empty = sf(documents=(DOCUMENTS, []), labels=("doc_id bigint, quality int, toxic int", []))
    assert QUERIES["op13_compression_quality"](spark, empty).collect() == []


def test_quality_view_of_repeats_and_layout():
    assert quality.outline("The cat CAT cat cat 123, a") == b"Aa a A a = 0, a" and quality.outline("Éa ß|x") == b"a a|a"
    assert quality.differences(None, [(None, None)] * 2) == [0.0, 0.0] == quality.differences(" \n", [(None, None)] * 2)
    x = np.array([[0.2, 0.1], [0.3, 0.2], [-0.2, -0.3], [-0.1, 0.05]])
    score = quality.Model(None, quality.calibrate(x, np.array([1.0, 1, 0, 0]), np.ones(4))).score(x)
    assert (score[:2] > 0.5).all() and (score[2:] < 0.5).all()
