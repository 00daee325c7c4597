"""Discovery: the graph against a plain scorer, contexts on both sides, tokens and words of any length."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from chronoweave.llm import pii

DDL = "doc_id long, text string"


def discovered(spark, rows):
    """By document: the texts of the spans that no fixed form describes."""
    text = dict(rows)
    out = {}
    for r in pii.find(spark.createDataFrame(rows, DDL).repartition(3)).collect():
        base = {f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text[r.doc_id])}
        spans = [x.split(":") for x in r.spans.split(",") if x and x not in base]
        assert r.n_found == len(spans) and r.n_spans == len(spans) + len(base)
        if spans:
            out[r.doc_id] = [(k, text[r.doc_id][int(a) : int(b)]) for k, a, b in spans]
    return out


def slow_patterns(links, rounds=pii.ROUNDS, support=pii.LEAST_SUPPORT, least=pii.LEAST_CONFIDENCE):
    """The graph's definition, one dictionary at a time."""
    kind, may = {}, {}
    for p, i, k, m in links:
        kind[p, i] = max(kind.get((p, i)) or "", k or "") or None
        may[p, i] = max(may.get((p, i), 0), m)
    held = defaultdict(list)
    for p, i in kind:
        held[p].append(i)
    held = {p: x for p, x in held.items() if len(x) >= support}
    score: dict = {}
    for _ in range(rounds):
        best = {}
        for p, instances in held.items():
            sums = defaultdict(float)
            for i in instances:
                if kind[p, i]:
                    sums[kind[p, i]] += 1
                elif i in score:
                    sums[score[i][1]] += score[i][0]
            tops = [(s / (1 + sum(may[p, i] >> pii.FOUND.index(k) & 1 for i in instances)), k) for k, s in sums.items()]
            tops = [t for t in tops if t[0] >= least]
            if tops:
                best[p] = max(tops)
        score = {}
        for p, (c, k) in best.items():
            for i in held[p]:
                if not kind[p, i] and may[p, i] >> pii.FOUND.index(k) & 1:
                    score[i] = max(score.get(i, (0, "")), (c, k))
    return {p: (k, round(c, 9)) for p, (c, k) in best.items()}


@pytest.mark.parametrize("seed", range(2))
def test_the_graph_by_brute_force(spark, seed):
    rng = random.Random(seed)
    links = []
    for _ in range(900):
        p, i = f"p{rng.randrange(30)}", rng.randrange(120)
        bits = 1 + i % 31
        kind = pii.FOUND[i % 5] if i % 3 == 0 or (i < 60 and p < "p2") else None
        links.append((p, i, kind, 1 << pii.FOUND.index(kind) if kind else bits))
    for i in range(9):  # one that is sure, and one that only its finds reach
        links += [("sure", 1000 + i, "phone", 8), ("reached", 2000 + i, None, 8), ("sure", 2000, None, 8)]
        links += [(f"way{j}", 3000 + j * 50 + i, "phone", 8) for j in range(9)] + [(f"way{j}", 2000 + j, None, 8) for j in range(9)]
    df = spark.createDataFrame(links, "pattern string, instance long, kind string, may int").repartition(4)
    got = {r.pattern: (r.kind, round(r.confidence, 9)) for r in pii.confident_patterns(df).collect()}
    assert got == slow_patterns(links)
    assert "reached" in got and "sure" in got


def test_a_second_context_is_reached_through_a_discovered_instance(spark):
    rows = [(i, f"text my fax number +1 (555) 010-{1000 + i} ok") for i in range(60)]
    # The seeds' context finds these; a context without any seed shares them and has one more.
    rows += [(100 + i, f"more my fax number 555-{7000 + i} here") for i in range(10)]
    rows += [(200 + i, f"please ring desk line 555-{7000 + i} now") for i in range(10)]
    rows += [(300, "please ring desk line 555-9999 now"), (301, "other order code 555-8888 now")]
    got = discovered(spark, rows)
    assert got[300] == [("phone", "555-9999")]
    assert set(got) == {*range(100, 110), *range(200, 210), 300}


def test_a_context_after_the_token(spark):
    rows = [(i, f"{'abcdefghijklmnopqrstuvwxyz'[i % 26] * (1 + i // 26)} +44 20 7946 {1000 + i} extension") for i in range(40)]
    rows += [(100, "qq 555-7123 extension"), (101, "qq 555-7123 pieces")]
    got = discovered(spark, rows)
    assert got == {100: [("phone", "555-7123")]}


def test_secrets_and_what_stands_where_they_do(spark):
    rng = random.Random(5)
    rows = [(i, f'x token = "{rng.getrandbits(160):040x}" y') for i in range(30)]
    rows += [(100, 'say token = "Zq4-77Kx_0912" so'), (101, "12345678901234567890123456789012 digits only"), (102, "deadbeef" * 6)]
    got = discovered(spark, rows)
    assert all(got[i] == [("secret", rows[i][1][11:51])] for i in range(30))
    assert got[100] == [("secret", "Zq4-77Kx_0912")] and set(got) == {*range(30), 100}


@pytest.mark.parametrize("size", [64, 3000])
def test_tokens_and_words_of_any_length(spark, size):
    """Neither a long identifier nor a long word before it is cut."""
    long = "w" * size
    rows = [(i, f"my {long} +1 (555) 010-{1000 + i} ok") for i in range(40)]
    rows += [(100, f"my {long} 555-7123 here"), (101, f"my w{long} 555-7123 here")]
    assert discovered(spark, rows) == {100: [("phone", "555-7123")]}
    rows = [(i, f"write to{i} my box abc{i}@mail.org ok") for i in range(40)]
    rows += [(100, f"see my box {'4' * size}@host here"), (101, f"see my box {'e' * size}@{'h' * size}")]
    assert discovered(spark, rows) == {100: [("email", "4" * size + "@host")], 101: [("email", "e" * size + "@" + "h" * size)]}


def test_a_long_text_without_spaces_takes_linear_time():
    text = "a@b.co," * 100_000 + "7" * 1_000_000
    spans = pii.base_spans(text)
    assert len(spans) == 100_000 and len(pii.links_of(text, spans)) > 100_000
