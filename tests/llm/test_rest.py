"""Packing, personal data, GIF, language, WARC, mixing and the pipeline, on small fixtures."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import gif, langid, mixing, packing, pii, queries, warc
from chronoweave.llm.common import join_hot, release

DDL = "doc_id long, text string, lang string, source string, n_chars long, size long, target double, name string"


def docs(spark, rows, parts=3):
    """``(doc_id, text, lang, source)`` with extra columns whose names clash."""
    full = [(i, t, g, s, None if t is None else len(t), 9, 9.0, "n") for i, t, g, s in rows]
    return spark.createDataFrame(full, DDL).repartition(parts) if full else spark.createDataFrame([], DDL)


# ---- packing -------------------------------------------------------------------------


def check_pieces(got, want, window):
    """``want``: ids by document. Every id in one piece, sequences gapless and full but the last."""
    by, seq = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    assert set(by) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for k, rs in seq.items():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or (k == max(seq) and at <= window)
        assert all(r.padded_to == (window if at & (at - 1) else at) for r in rs)
    assert sorted(seq) == list(range(len(seq)))
    return seq


def test_packing(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.vocabulary())
    rng = random.Random(1)
    texts = [None, "", "x", "a" * 3000, " " * 900, "<|endoftext|> and <|x", "Añb   ½ \n\n\t", *["".join(rng.choice("abc dé\n9.") for _ in range(rng.randint(1, 3000))) for _ in range(40)]]
    rows = [(i, t, None, rng.choice(["s", "s", "s", "t", None])) for i, t in enumerate(texts)]
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _, _ in rows}
    got = packing.pack(docs(spark, rows), queries.vocabulary(), window=256).collect()
    seq = check_pieces(got, want, 256)
    total = Counter()
    for i, _, _, s in rows:
        total[s] += len(want[i])
    share = {s: n / sum(total.values()) for s, n in total.items()}
    held = Counter()
    for k in sorted(seq):  # up to each window, every source is within a slice or so of its share
        for r in seq[k]:
            held[r.source] += r.length
        assert all(abs(held[s] - sum(held.values()) * share[s]) <= packing.QUANTUM * len(share) for s in share)
    assert packing.pack(docs(spark, []), queries.vocabulary()).count() == 0


def test_packing_moves_no_ids(spark):
    """Only totals by task and source are shuffled, whatever is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = packing.pack(docs(spark, [(i, "some words", None, "ab"[i % 2]) for i in range(20)]), queries.vocabulary())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() >= 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan[: plan.index("Bucketed: true")]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange" not in above.split("ShuffledHashJoin")[1]


def test_packing_with_weights(spark):
    rows = [(i, "word " * 200, None, "ab"[i % 2]) for i in range(20)]
    got = packing.pack(docs(spark, rows), queries.vocabulary(), window=256, weights={"a": 3.0, "b": 1.0}).collect()
    held = Counter()
    for r in got:
        if r.sequence_id < 8:
            held[r.source] += r.length
    assert abs(held["a"] / (held["a"] + held["b"]) - 0.75) < 0.05


@pytest.mark.parametrize("totals", [[5000, 3, 70000, 1], [10, 0, 5], [300_000, 2_000_000, 50]])
def test_schedule_places_every_token_once(totals):
    rng = random.Random(3)
    phases = packing.schedule(totals)
    seen = np.zeros(sum(totals), int)
    for s, n in enumerate(totals):
        at = 0
        while at < n:
            end, here = min(n, at + rng.randint(1, 30_000)), at
            for x, length, g in packing.pieces_of(phases, s, at, end):
                assert x == here and g // 2048 == (g + length - 1) // 2048
                here += length
                seen[g : g + length] += 1
            assert here == end
            at = end
    assert (seen == 1).all()


# ---- personal data -------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]


def test_base_spans_by_brute_force():
    rng = random.Random(2)
    pieces = ["a", "b.c", "@", ".", "_", "-", "+", "%", " ", "1", "23", "255", "256", "0001", "+1 (2", "4539 1488 0343 6467", "4539148803436467", "é", "x@y.z", "1.2.3.4", "(", ")"]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(t) == slow_spans(t), t


def test_pii_discovers_by_context(spark):
    rows = [(i, f"text {i} my fax number +1 (555) 010-{1000 + i} ok", None, None) for i in range(30)]
    rows += [(100 + i, f"more my fax number 555-{7000 + i} here", None, None) for i in range(5)]
    rows += [(200, "clean 12345 text", None, None), (201, None, None, None), (202, "", None, None), (203, "x " * 50_000, None, None), (1, "twice a@b.co", None, None)]
    got = pii.find(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {(i, t or ""): t or "" for i, t, _, _ in rows}
    for r in got:
        mine = [t for (i, t) in text if i == r.doc_id and hashlib.sha256(pii.join_spans(slow_spans(t)).encode()).hexdigest() == r.base_sha256]
        assert mine
        base = {f"{k}:{a}:{b}" for k, a, b in slow_spans(mine[0])}
        found = set(r.spans.split(",")) - {""} - base
        assert base <= set(r.spans.split(",")) | {""}
        if 100 <= r.doc_id < 200:
            assert [mine[0][int(x.split(":")[1]) : int(x.split(":")[2])] for x in found] == [f"555-{6900 + r.doc_id}"]
            assert all(x.startswith("phone:") for x in found)
        else:
            assert not found
    assert pii.find(docs(spark, [])).count() == 0


# ---- GIF -----------------------------------------------------------------------------


def test_lzw_round_trip():
    rng = random.Random(4)
    for bits, n in ((2, 50), (8, 1), (8, 0), (8, 5000), (8, 60_000), (4, 20_000)):
        data = bytes(rng.randrange(1 << bits) for _ in range(n))
        assert gif.lzw_decode(gif.lzw_encode(data, bits), bits, n) == data
        low = bytes(rng.choice(data[:3] or b"\0") for _ in range(n))
        assert gif.lzw_decode(gif.lzw_encode(low, bits), bits, n) == low
    assert gif.lzw_decode(b"", 8, 4) == b""


def test_lzw_by_a_plain_decoder():
    """A decoder written from the format's rules alone reads what the encoder wrote."""

    def plain(data, bits):
        clear, end = 1 << bits, (1 << bits) + 1
        stream, at, out, width, table, prev = int.from_bytes(data, "little"), 0, b"", bits + 1, {}, None
        while True:
            code = stream >> at & ((1 << width) - 1)
            at += width
            if code == end:
                return out
            if code == clear:
                table, width, prev = {i: bytes([i]) for i in range(clear)} | {clear: b"", end: b""}, bits + 1, None
                continue
            entry = table[code] if code in table else prev + prev[:1]
            if prev is not None and len(table) < 4096:
                table[len(table)] = prev + entry[:1]
                if len(table) == 1 << width and width < 12:
                    width += 1
            out, prev = out + entry, entry

    rng = random.Random(5)
    for n in (1, 300, 9000):
        data = bytes(rng.choice(b"abcab ") if rng.random() < 0.9 else rng.randrange(256) for _ in range(n))
        assert plain(gif.lzw_encode(data), 8) == data


def picture(frames, size=(2, 1), background=0):
    """A GIF of one-row frames: ``(x, samples, disposal, transparent or None)``; palette red, green, blue, white."""
    colours = bytes([255, 0, 0, 0, 255, 0, 0, 0, 255, 255, 255, 255])
    out = b"GIF89a" + size[0].to_bytes(2, "little") + size[1].to_bytes(2, "little") + b"\x81\0\0" + colours
    for x, px, disposal, clear in frames:
        out += b"\x21\xf9\x04" + bytes([disposal << 2 | (clear is not None), 10, 0, clear or 0]) + b"\0"
        out += b"\x2c" + x.to_bytes(2, "little") + b"\0\0" + len(px).to_bytes(2, "little") + b"\1\0\0\2" + gif._blocks(gif.lzw_encode(bytes(px), 2))
    return out + b"\x3b"


def test_gif_disposal_and_transparency():
    seen = lambda data: [[tuple(p) for p in f.picture[0].tolist()] for f in gif.frames(data)]
    r, g, b, none = (255, 0, 0), (0, 255, 0), (0, 0, 255), (0, 0, 0)
    assert seen(picture([(0, [0, 0], 1, None), (1, [1], 1, None)])) == [[r, r], [r, g]]
    assert seen(picture([(0, [0, 0], 1, None), (0, [3, 1], 1, 3)])) == [[r, r], [r, g]]
    assert seen(picture([(0, [0, 0], 1, None), (1, [1], 2, None), (0, [2], 1, None)])) == [[r, r], [r, g], [b, none]]
    assert seen(picture([(0, [0, 0], 1, None), (1, [1], 3, None), (0, [2], 1, None)])) == [[r, r], [r, g], [b, r]]
    assert [(f.start_ms, f.delay_ms) for f in gif.frames(picture([(0, [0], 1, None)] * 2))] == [(0, 100), (100, 100)]


def test_gif_columns(spark):
    texts = [None, "", "a", "é" * 288, "b" * 577, "long " * 60_000, "a"]
    table = docs(spark, [(i, t, None, None) for i, t in enumerate(texts)] + [(2, "a", None, None), (None, "x", None, None)])
    got = gif.store_texts(table).collect()
    assert sorted(((r.doc_id, r.n_bytes) for r in got), key=repr) == sorted([*((i, len((t or "").encode())) for i, t in enumerate(texts)), (2, 1), (None, 1)], key=repr)
    for r in got:
        body = (texts[r.doc_id] or "").encode() if r.doc_id is not None else b"x"
        want = body + b"\xff" * (-len(body) % 576 or (576 if not body else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(body), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))
        media = gif.encode_samples(want)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        shown = -(-len(want) // (576 * 64))
        counts = ",".join(str(sum(v >> 5 == i for v in want)) for i in range(8))
        assert r.feature == f"frames={shown};ms={40 * shown};red={counts};green={counts};blue={counts}"
    media = gif.encode_texts(table)
    frames = gif.frame_rows(media).where("doc_id = 5").orderBy("frame").collect()
    assert b"".join(bytes(f.pixels)[: f.box_width * f.box_height * 3][::3] for f in frames)[:300_000] == texts[5].encode()
    assert all(sum(f.red) == f.width * f.height for f in frames) and [f.start_ms for f in frames[:2]] == [0, 40]
    assert gif.store_texts(docs(spark, [])).count() == 0


def test_broken_gifs(spark):
    good = picture([(0, [0, 0], 1, None), (1, [1], 1, None)])
    huge = b"GIF89a" + b"\xff" * 4 + good[10:]
    wide = bytearray(good)
    at = good.index(b"\x2c")
    wide[at + 5 : at + 9] = b"\xff" * 4
    second = good.index(b"\x2c", at + 1)
    files = {1: b"no gif", 2: None, 3: huge, 4: bytes(wide), 5: good[:-1], 6: good[: second + 4], 7: good[: second + 12], 8: good, 9: good[:13], 10: b""}
    rows = [(i, None if d is None else bytearray(d)) for i, d in files.items()]
    got = defaultdict(lambda: [0, 0])
    for r in gif.frame_rows(spark.createDataFrame(rows, "doc_id long, media binary")).collect():
        got[r.doc_id][r.error is not None] += 1
    assert dict(got) == {1: [0, 1], 2: [0, 1], 3: [0, 1], 4: [0, 1], 5: [2, 1], 6: [1, 1], 7: [2, 1], 8: [2, 0], 9: [0, 1], 10: [0, 1]}


# ---- language ------------------------------------------------------------------------

LANGS = {"xx": ["ka", "ro", "mi", "ten"], "yy": ["shu", "wel", "gra", "oft"], "zz": ["ñeo", "ção", "lué", "già"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


def test_language(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, lang, rng.randint(3, 60)), lang, "s") for i in range(400) for lang in [rng.choice(list(LANGS))]]
    rows += [(1000, None, "xx", "s"), (1001, "", "xx", "s"), (1002, "12 34 !?", "xx", "s"), (1003, rows[0][1], None, None), (None, rows[1][1], None, None), (1004, sentence(rng, "yy", 400_000), None, None)]
    got = {r.doc_id: r for r in langid.identify(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1002].score == 0
    assert got[1003].lang_pred == rows[0][2] and got[None].lang_pred == rows[1][2] and got[1004].lang_pred == "yy"
    held = [(got[i].lang_pred, g) for i, _, g, _ in rows[:400] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 60 and sum(a == b for a, b in held) / len(held) >= 0.97
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows[:400])
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(docs(spark, [])).count() == 0
    assert langid.identify(docs(spark, [(1, "abc", None, None)])).first().lang_pred == "und"


def test_language_mixture(spark):
    rng = random.Random(2)
    train = [(i, sentence(rng, lang, 40), lang, None) for i in range(90) for lang in [list(LANGS)[i % 3]]]
    model = langid.fit(docs(spark, train))
    ((lang, share, chosen, background),) = model.predict([sentence(rng, "xx", 120) + " " + sentence(rng, "zz", 60)])
    assert lang == "xx" and chosen == ["xx", "zz"] and 0.5 < share < 0.8 and background < 0.1
    ((_, share, chosen, _),) = model.predict([sentence(rng, "yy", 80)])
    assert chosen == ["yy"] and share > 0.95


# ---- WARC ----------------------------------------------------------------------------


def test_warc(spark, tmp_path):
    big, other = "p" * 1000 + "é", "q" * 1200
    rows = [(1, "http://a/x", big), (2, "http://b/\r\ny", big), (9, None, big), (4, "u", "p" * 10), (5, "u", "p" * 10), (6, "u", None), (7, "u", other), (None, "u", other), (8, "http://c", "WARC/1.1\r\nContent-Length: 3\r\n\r\n")]
    pages = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, sha1 string, key string").repartition(3)
    got = {r.page_id: r for r in warc.page_captures(spark, pages).collect()}
    assert len(got) == len(rows)
    for i, _, h in rows:
        body = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
    kinds = {i: (r.record_type, r.refers_to) for i, r in got.items()}
    assert kinds == {1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None), 7: ("response", None), None: ("revisit", 7), 8: ("response", None)}
    assert warc.page_captures(spark, pages.limit(0)).count() == 0
    # Files on disk, plain and compressed, read alike.
    import gzip

    content = bytes(warc.archive_rows(warc.assign_roles(pages).coalesce(1)).first().content)
    (tmp_path / "a.warc").write_bytes(content)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(content))
    recs = warc.records(warc.read_files(spark, str(tmp_path)))
    assert recs.count() == 2 * 3 * len(rows) and recs.where("error is not null").count() == 0
    for direct in (True, False):
        nested = warc.transactions(recs, direct=direct)
        assert nested.count() == len(rows)
        one = nested.where("metadata.fields['page-id'] = '8'").first()
        assert bytes(one.response.payload) == rows[-1][2].encode() and one.request.type == "request"


def test_warc_repeated_and_long_pages(spark):
    big = "p" * 3_000_000
    rows = [(1, "u", big), (1, "u", big), (None, None, big), (None, "None", "x"), (None, None, "x"), (2, "u", "y" * 999), (2, "u", "y" * 999), (3, "u", "y" * 1000), (3, "u", "y" * 1000), (4, "v", "y" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.page_captures(spark, pages).collect())
    assert got == Counter({
        (1, len(big), "response", None): 2, (None, len(big), "revisit", 1): 1, (None, 1, "response", None): 2,
        (2, 999, "response", None): 2, (3, 1000, "revisit", 4): 2, (4, 1000, "response", None): 1,
    })


def test_warc_of_others(spark):
    def rec(kind, ident, others=(), block=b"", extra=()):
        return warc.record(kind, [*([("WARC-Record-ID", ident)] if ident else []), *[("WARC-Concurrent-To", x) for x in others], *extra], block)

    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    parts = [
        rec("warcinfo", "w"), rec("response", "p1", (), http), rec("request", "q1", ("p1",)), rec("metadata", "m1", ("q1",)),  # metadata names the request
        rec("request", "q2"), rec("response", "p2", ("q2", "m2"), b"no separator"), rec("metadata", "m2"),  # the response names the others, by a repeated header
        rec("response", None, (), http), rec("response", None, (), http), rec("metadata", None, ("p1x",)),  # no identifiers
        rec("request", "q3", ("m3",)), rec("metadata", "m3"),  # no response
    ]
    broken = rec("response", "p9", (), http).replace(b"Content-Length: 23", b"Content-Length: x")
    folded = rec("response", "p10", (), http).replace(b"WARC-Record-ID: p10", b"WARC-Record-ID:\r\n p10")
    content = b"".join(parts) + broken + folded + b"junk\r\n" + rec("response", "p11", (), http)[:-10]
    files = spark.createDataFrame([("a", bytearray(content)), ("b", None), ("c", bytearray(b"\x1f\x8bxx")), ("d", bytearray())], "archive string, content binary")
    recs = warc.records(files)
    assert sorted(r.error for r in recs.where("error is not null").collect()) == sorted(["no length", "not a record", "breaks off", recs.where("archive = 'c'").first().error])
    got = {r.capture_id: r for r in warc.transactions(recs).collect()}
    name = lambda x: x and x.record_id
    told = {(name(r.response), name(r.request), name(r.metadata)) for k, r in got.items() if "@" not in k}
    assert told == {("p1", "q1", "m1"), ("p2", "q2", "m2"), (None, "q3", "m3"), ("p10", None, None)}
    assert bytes(got["p2"].response.payload) == b"no separator" and bytes(got["p10"].response.payload) == b"body"
    assert sum(r.response is not None for k, r in got.items() if "@" in k) == 2 and len(got) >= 6


# ---- mixing --------------------------------------------------------------------------


def slow_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = budget - sum(capped.values())
        over = [s for s in rest if left * w[s] / sum(w[x] for x in rest) > 2 * sizes[s]]
        if not over:
            return capped | {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        capped |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rng = random.Random(seed)
    rows = [(i, None if rng.random() < 0.05 else "w " * rng.randint(0, 40), None, rng.choice(["a", "a", "a", "b", "ç", "", None])) for i in range(300)] + [(5, "w w", None, "b"), (None, "w", None, "zero"), (400, "", None, "empty"), (401, "v " * 5000, None, "a")]
    df = docs(spark, rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    targets = slow_targets(dict(sizes))
    by_source = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.whole * r.size + r.part
        by_source.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    assert sorted(by_source) == sorted({(sizes[s], round(targets[s], 6)) for s in sizes})
    for (_, target), taken in by_source.items():
        assert abs(sum(taken) - target) <= 1
    assert sorted(map(tuple, mixing.mix(df.repartition(5)).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    words = Counter()
    for r in mixing.materialise(df).collect():
        words[r.doc_id] += len(r.text.split())
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.taken
    assert words == +taken
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.materialise(docs(spark, [])).count() == 0


def test_mixing_of_repeated_and_missing_identifiers(spark):
    """Decisions are by row: targets are met however rows share identifiers; columns keep their names."""
    rng = random.Random(9)
    rows = [(rng.choice([None, None, 1, 2, 1000 + i]), rng.choice(["", None, "same text here", " ".join("x" * rng.randint(1, 9)) + f" {rng.randint(0, 30)}"]), rng.choice("ab")) for i in range(400)]
    ddl = "doc_id long, text string, source string, choice int, _id int, _key int, _text string, size int, part int"
    df = spark.createDataFrame([(*r, 1, 2, 3, "t", 4, 5) for r in rows], ddl).repartition(5)
    got, made = mixing.mix(df).collect(), mixing.materialise(df).collect()
    assert len(got) == 400 and made[0].__fields__ == df.columns
    sizes, words = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    for r in made:
        words[r.source] += len(r.text.split())
    for s, target in slow_targets(dict(sizes)).items():
        assert abs(words[s] - target) <= 1
    assert all(0 <= r.taken <= 2 * r.size for r in got) and sum(r.taken for r in got) == sum(words.values())
    assert sorted(map(tuple, mixing.mix(df.repartition(2)).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    assert not any(x in mixing.materialise(df)._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Arrow", "Pandas"))


def test_mixing_is_native(spark):
    plan = mixing.mix(docs(spark, [(1, "a", None, "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_hot_join(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(90)] + [(f"k{i}", i) for i in range(10)], "k string, i int")
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("m"))
    got = join_hot(rows, facts, "k", "n", 100, share=10)
    assert got.count() == 100 and got.where("k = 'hot' and m = 89").count() == 90


# ---- registered queries and the pipeline ---------------------------------------------

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want, df = con.sql(queries.SQL[name]), queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    cols = df.columns
    place = [want.columns.index(c) for c in cols]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=repr)


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    from tokenizers import Tokenizer

    rng = random.Random(3)
    rows = [(i, sentence(rng, lang, rng.randint(5, 90)), lang, rng.choice(["a", "b", None])) for i in range(150) for lang in [list(LANGS)[i % 3]]]
    rows += [(500 + i, rows[i][1], "xx", "a") for i in range(20)] + [(600, None, None, None), (601, "", "xx", "a"), (602, "99 --", "xx", "a"), (7, rows[7][1], rows[7][2], rows[7][3])]
    df = spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for name, stage in pipeline.STAGES:
        df = pipeline.write_table(stage(spark, df, ""), "test")
        kept.append((name, df))
    known, single, apart, mixed, packed = (d for _, d in kept)
    assert [n for n, _ in kept] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert all(d.columns == known.columns == ["doc_id", "text", "lang", "source", "n_chars"] for d in (known, single, apart, mixed))
    assert known.count() == len(rows) - 3
    last = {}
    for i, t, _, _ in rows[:-1]:
        last[t] = max(i, last.get(t, -1))
    want = {(i, t) for t, i in last.items() if t and i != 602}
    assert sorted((r.doc_id, r.text) for r in single.collect()) == sorted(want)
    sets = {i: set(zip(*[t.lower().split()[k:] for k in range(5)], strict=False)) or {t.lower()} for i, t in want}
    groups: list[set] = []
    for i, f in sets.items():
        near = [g for g in groups if any(len(f & sets[j]) >= 0.8 * len(f | sets[j]) for j in g)]
        groups = [g for g in groups if g not in near] + [{i}.union(*near)]
    assert sorted(r.doc_id for r in apart.collect()) == sorted(min(g) for g in groups)
    taken = {r.doc_id: r.taken for r in mixing.mix(apart).collect()}
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert words == Counter({i: n for i, n in taken.items() if n})
    tok = Tokenizer.from_file(queries.vocabulary())
    assert packed.agg(F.sum("length")).first()[0] == sum(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed.collect())


def test_work_tables_go(spark):
    from chronoweave.llm import substring_dedup

    assert substring_dedup.remove_repeats(docs(spark, [(1, "w " * 50, None, None)])).first().n_removed == 49
    spark.sql("CREATE TABLE IF NOT EXISTS chronoweave_rows_of_another (a INT) USING parquet")
    assert len(spark.catalog.listTables(pattern="chronoweave_rows_*")) > 1
    assert release(spark) > 0
    assert [t.name for t in spark.catalog.listTables(pattern="chronoweave_rows_*")] == ["chronoweave_rows_of_another"] and release(spark) == 0
    spark.sql("DROP TABLE chronoweave_rows_of_another")


def test_no_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace

    from chronoweave.llm.common import shared_folder

    there = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="none"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(there)
