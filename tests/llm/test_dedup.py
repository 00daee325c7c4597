"""Exact, near and repeat dedup against brute force on small tables with every odd case."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronoweave.llm import exact_dedup, passages, simhash, substring_dedup, suffix_dedup
from chronoweave.llm.components import connected_components

DDL = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, fp long, block long"


def docs(spark, rows, parts=3):
    """``(doc_id, text)`` with extra columns whose names clash with the operators' own."""
    full = [(i, t, None, None, None, 7, 7, 7) for i, t in rows]
    return spark.createDataFrame(full, DDL).repartition(parts) if full else spark.createDataFrame([], DDL)


def corpus(seed=1):
    """Copies, near copies, shared passages, periodic and empty texts, one very long."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = text(30), text(9)
    rows = [None, "", "", " ", "a", "a" * 300, "a" * 301, "ab" * 90, passage, passage, f"{line}\n" * 12, f"x {line}\n" * 5, "\0" * 60, "\0" * 70 + "z"]
    rows += [f"{text(rng.randint(0, 60))} {passage} {text(rng.randint(0, 60))}" for _ in range(12)]
    base = text(200).split()
    for _ in range(10):
        near = base.copy()
        near[rng.randrange(200)] = "zz"
        rows.append(" ".join(near))
    rows.append(text(6000))
    rows.append(rows[-1][100:9000])
    rows += [text(rng.randint(1, 80)) for _ in range(20)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i * 3, t) for i, t in zip(order, rows, strict=True)]


# ---- exact ---------------------------------------------------------------------------


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact(spark, keep):
    rows = [*corpus(), (1, "tie"), (None, "tie"), (2, "tie"), (2, "tie"), (None, "alone")]
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    got = exact_dedup.exact_duplicates(docs(spark, rows, 7), keep=keep, fan_in=2).collect()
    assert len(got) == len(rows)
    pick = max if keep == "largest" else min
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    for r in got:
        group = by_sha[r.text_sha256]
        best = pick((i for i in group if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(group), r.doc_id == best)
    assert exact_dedup.exact_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_without_copies(spark, keep):
    rows = [*corpus(), (1, "tie"), (None, "tie"), (2, "tie"), (2, "tie"), (None, "alone"), (None, "twice"), (None, "twice"), (None, "")]
    df = docs(spark, rows, 7).withColumn("__run1", F.lit(1))
    kept = exact_dedup.without_copies(df, keep=keep, fan_in=2)
    assert kept.columns == df.columns
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    pick = max if keep == "largest" else min
    want = [(pick((i for i in g if i is not None), default=None), t) for t, g in groups.items()]
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert exact_dedup.without_copies(docs(spark, [])).count() == 0


def test_exact_runs_are_merged_in_order(spark, monkeypatch):
    """One exchange folds the runs, one deals them; every round after that merges sorted rows in place."""
    seen = []
    write = exact_dedup.write_table
    monkeypatch.setattr(exact_dedup, "write_table", lambda df, label: (seen.append((label, df._jdf.queryExecution().executedPlan().toString())), write(df, label))[1])
    exact_dedup.exact_duplicates(docs(spark, corpus(), 40), fan_in=4).count()
    plan = dict(seen)["exact-merged"]
    assert plan.count("Exchange") == 2 and plan.count("Sort [") == 3  # a run where it was read, where it was folded, and all rounds
    assert plan.count("SortAggregate") >= 6 and "HashAggregate" not in plan


def test_exact_is_native(spark):
    plan = exact_dedup.exact_duplicates(docs(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# ---- SimHash -------------------------------------------------------------------------


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(spark):
    rows = [*corpus(2), (1, "tie one two"), (2, "TIE  one\ttwo"), (None, "alone here now"), (None, "tie one two")]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fps = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    want = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        want.append((doc_id, f"{fps[i]:016x}", min(ids, default=None)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("shared", [1, 5, 10_000])
def test_close_pairs_whatever_is_full(spark, shared):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]
    fps = {b for b in base}
    for b in base:
        for _ in range(25):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << bit
            fps.add(x)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    assert {tuple(r) for r in simhash.close_pairs(df, shared=shared).collect()} == want


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(5, 5)] + [(rng.randint(200, 240), rng.randint(200, 240)) for _ in range(20)]
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- repeats -------------------------------------------------------------------------


def slow_bytes(rows, win):
    first: dict = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - win + 1):
            s = b[p : p + win]
            first[s] = min(first.get(s, (2, 0)), (1, i) if i is not None else (0, 0))
    for i, t in rows:
        b, own = (t or "").encode(), (1, i) if i is not None else (0, 0)
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - win + 1):
            if first[b[p : p + win]] < own:
                gone[p : p + win] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        yield i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def slow_words(rows, win):
    first: dict = {}
    place = lambda i, p: ((1, i) if i is not None else (0, 0), p)
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - win + 1):
            s = tuple(w[p : p + win])
            first[s] = min(first.get(s, ((2, 0), 0)), place(i, p))
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - win + 1):
            if first[tuple(w[p : p + win])] < place(i, p):
                gone[p : p + win] = [True] * win
        yield i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()


LIMITS = [{}, {"hot_blocks": 1, "block_bytes": 2000, "chunk_bytes": 500}]


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("seed", [3, 4])
def test_repeated_bytes(spark, limits, seed):
    rows = [*corpus(seed), (None, "q" * 80), (1, "q" * 90), (1, "q" * 95)]
    got = suffix_dedup.remove_repeats(docs(spark, rows), **limits).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(slow_bytes(rows, 50), key=repr)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("seed", [3, 4])
def test_repeated_words(spark, limits, seed):
    rows = [*corpus(seed), (None, "q r " * 40), (1, "q r " * 50), (1, "q r " * 60), (4, "s " * 19), (5, "s " * 20), (6, "s " * 21)]
    got = substring_dedup.remove_repeats(docs(spark, rows), **limits).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(slow_words(rows, 20), key=repr)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0
    assert substring_dedup.remove_repeats(docs(spark, [(1, None)])).first()[:3] == (1, 0, 0)


def test_suffix_order():
    rng = random.Random(2)
    for alphabet in ("ab", "abcdefgh\0\xff"):
        parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(8, 120))).encode("latin1") for _ in range(30)] + [b"a" * 200]
        data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
        text = data.astype(np.uint16) + 1
        text[np.cumsum([len(p) + 1 for p in parts]) - 1] = 0
        words = suffix_dedup._big_endian_words(np.concatenate([data, np.zeros(64, np.uint8)]))
        order = suffix_dedup.suffix_array(text, words, 50)
        assert sorted(order.tolist()) == list(range(len(text)))
        whole = [p + 50 <= len(data) and 0 not in text[p : p + 50] for p in order]
        seen = [bytes(data[p : p + 50]) for p, w in zip(order, whole, strict=True) if w]
        assert seen == sorted(seen)


@pytest.mark.parametrize("module", [suffix_dedup, substring_dedup])
def test_window_classes(module):
    rng = random.Random(5)
    parts = [b" ".join(rng.choice([b"aa", b"bb", b"cc"]) for _ in range(rng.randint(10, 40))) for _ in range(20)]
    win = 12 if module is suffix_dedup else 4
    pieces = [p for part in parts for u in [part if module is suffix_dedup else part.split()] for p in (bytes(u[i : i + win]) if isinstance(u, bytes) else tuple(u[i : i + win]) for i in range(len(u) - win + 1))]
    cls = module.window_classes(parts, win).tolist()
    assert len(cls) == len(pieces)
    assert len(set(cls)) == len(set(pieces)) == len(set(zip(cls, pieces, strict=True)))


def test_fm_index_counts():
    rng = random.Random(7)
    text = np.array([rng.randint(1, 5) if i % 17 else 0 for i in range(1, 400)])
    text[-1] = 0
    fm = substring_dedup.FMIndex(text, 8)
    for _ in range(50):
        n = rng.randint(1, 6)
        pattern = [rng.randint(1, 5) for _ in range(n)]
        low, high = fm.first[[pattern[-1]]], fm.first[[pattern[-1] + 1]]
        for c in reversed(pattern[:-1]):
            low, high = fm.extend(low, high, np.array([c]))
        assert high[0] - low[0] == sum(text[i : i + n].tolist() == pattern for i in range(len(text) - n + 1))


def test_equal_windows_share_anchors():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 100, 600).astype(np.uint8).tobytes()
    units = passages.byte_units(body + body[50:400] + body, np.array([600, 350, 600]))
    first, n, h, doc, _ = passages.anchor_runs(units, 16, 50)
    anchor = {int(u + j): int(a) for u, c, a in zip(first, n, h, strict=True) for j in range(c)}
    assert len(anchor) == 551 + 301 + 551
    by_window: dict = {}
    for u, a in anchor.items():
        by_window.setdefault(units.body[u : u + 50], set()).add(a)
    assert all(len(s) == 1 for s in by_window.values())


def test_matching_statistics_by_brute_force():
    rng = np.random.default_rng(3)
    for n, sigma, threshold in ((1, 2, 4), (60, 2, 6), (400, 4, 7), (3000, 60, 5)):
        text = rng.zipf(1.4, n).clip(1, sigma)
        text[rng.integers(0, n, n // 15)] = 0
        text[-1] = 0
        _, text = np.unique(np.append(text, 0), return_inverse=True)  # numbers without gaps
        text = text[:n] if n > 1 else np.array([0])
        fm = substring_dedup.FMIndex(text, threshold)
        ends = np.array([i for i in range(n) if text[max(0, i - threshold + 1) : i + 1].all() and i >= threshold - 1], np.int64)
        length, low, high = substring_dedup.matching_statistics(fm, text, ends, threshold) if len(ends) else ([], [], [])
        places: dict = {}
        for i in range(n):
            for k in range(1, threshold + 1):
                if i - k + 1 >= 0:
                    places.setdefault(tuple(text[i - k + 1 : i + 1]), []).append(i)
        for i, got, a, b in zip(ends, length, low, high, strict=True):
            want = max([k for k in range(1, threshold + 1) if len(places[tuple(text[i - k + 1 : i + 1])]) > 1], default=0)
            assert got == want
            if want == threshold:
                assert b - a == len(places[tuple(text[i - threshold + 1 : i + 1])])


def test_the_index_is_as_small_as_the_entropy():
    rng = np.random.default_rng(4)
    text = np.append(rng.zipf(1.5, 200_000).clip(1, 5000), 0)
    _, text = np.unique(text, return_inverse=True)
    share = np.bincount(text) / len(text)
    entropy = -(share * np.log2(share)).sum()
    fm = substring_dedup.FMIndex(text, 20)
    bits = sum(v.words.nbytes for v in fm.tree.levels) * 8 / len(text)
    assert bits <= entropy + 1.1 < int(text.max()).bit_length()
    assert not any(isinstance(x, np.ndarray) and len(x) >= len(text) for x in (*vars(fm).values(), *vars(fm.tree).values()))


def test_every_window_is_judged_by_the_index(spark, monkeypatch):
    """Copies are no exception: a run goes where the index has its windows first, whole stretches too."""
    asked = []
    classes = substring_dedup.window_classes
    monkeypatch.setattr(substring_dedup, "window_classes", lambda parts, win: (asked.append(sum(max(0, p.count(b" ") + 2 - win) for p in parts)), classes(parts, win))[1])
    units = passages.word_units
    task = substring_dedup.task()
    body = b" ".join(b"w%d" % (i % 50) for i in range(200))
    stretch = bytes(body[: body.index(b"w30") + 3])
    arrays = (np.array([7], np.uint16), np.array([0, 0, 0], np.uint32), np.array([0, 5, 9]), np.array([4, 2, 9]), np.array([0, 3, 1]), np.array([1, 1, 2]))
    blocks, pairs = passages.shard_windows([(arrays, [stretch])], task)
    windows = stretch.count(b" ") + 2 - 20
    assert units is passages.word_units and asked == [windows]
    assert dict(zip(blocks, [p.tolist() for p in pairs], strict=True)) == {1: [[0, windows]], 2: [[9, windows]]}
