"""The sample of a language is of different texts, however often each is repeated."""

from __future__ import annotations

import random

import numpy as np

from chronoweave.llm import langid


def test_a_language_of_copies_is_learned(spark):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    rows = [(" ".join(word("abcde") for _ in range(20)), "aa") for _ in range(4)] * 5000
    rows += [(" ".join(word("vwxyz") for _ in range(20)), "zz") for _ in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = langid.fit(df, sample_rows=50)
    assert model.languages == ["aa", "zz"]
    # Four texts were fitted once each: the same model as without their copies.
    alone = langid.fit(spark.createDataFrame(sorted(set(rows)), "text string, lang string"), sample_rows=50)
    assert np.array_equal(model.ratio, alone.ratio)


LANGS = {"xx": ["ka", "ro", "mi", "ten"], "yy": ["shu", "wel", "gra", "oft"], "zz": ["ñeo", "ção", "lué", "già"]}


def said(rng, lang, n):
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def plain_mixture(model, text):
    """EM over the n-grams one by one, in doubles; then every nested set by penalised likelihood."""
    like = model.ratio[langid.grams(text)].astype(float)
    share = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(langid.STEPS):
        owed = like * np.maximum(share, 1e-9)
        share = (owed / owed.sum(1, keepdims=True)).mean(0)
    order = np.argsort(-share, kind="stable")
    best = None
    for n in range(1, max(1, int((share >= langid.LEAST_SHARE).sum())) + 1):
        held = np.isin(np.arange(len(share)), order[:n])
        within = np.where(held, np.maximum(share, 1e-9), 1e-12)
        score = np.log(like @ (within / within.sum())).sum() - 0.5 * (n - 1) * np.log(len(like))
        if best is None or score > best[0]:
            best = score, held
    return share, best[1]


def test_mixtures_by_brute_force(spark):
    rng = random.Random(3)
    train = [(said(rng, lang, 40), lang) for lang in LANGS for _ in range(30)]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    texts = ["a", "xq", "12 é", *(" ".join(said(rng, lang, rng.randint(0, 40)) for lang in rng.sample(list(LANGS), rng.randint(1, 3))) for _ in range(60))]
    texts = [t for t in texts if langid.has_letter(t)]
    share, chosen = model.mixtures([langid.counted(t) for t in texts])
    for text, s, c in zip(texts, share, chosen, strict=True):
        want_share, want = plain_mixture(model, text if len(langid.grams(text)) else "    ")
        if len(langid.grams(text)):
            assert np.allclose(s, want_share, atol=1e-4) and (c == want).all()


def test_a_very_long_text_gets_the_answer_of_the_whole(spark, monkeypatch):
    rng = random.Random(4)
    train = [(said(rng, lang, 40), lang) for lang in LANGS for _ in range(30)]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    # Two per cent of another language, all at the end: its last piece alone would be that language.
    text = said(rng, "xx", 60_000) * 40 + " " + said(rng, "yy", 48_000)
    assert len(text) > 10_000_000
    (whole,) = model.predict([text])
    assert whole[0] == "xx" and whole[2] == ["xx"]
    monkeypatch.setattr(langid, "PIECE_BYTES", 1000)
    short = said(rng, "xx", 900) + " " + said(rng, "zz", 300) + " " + said(rng, "xx", 5)
    cut = langid.grams(short), langid.counted(short)
    monkeypatch.setattr(langid, "PIECE_BYTES", 1 << 20)
    assert np.array_equal(cut[0], langid.grams(short))
    assert all(np.array_equal(a, b) for a, b in zip(cut[1], langid.counted(short), strict=True))


def test_languages_without_bound_and_columns_in_the_way(spark, monkeypatch):
    import pytest

    df = spark.createDataFrame([(f"text {i}", f"l{i}") for i in range(30)], "text string, lang string")
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 20)
    with pytest.raises(ValueError, match="more than 20"):
        langid.fit(df)
    with pytest.raises(ValueError, match="score"):
        langid.predict(df.withColumn("Score", df.lang), langid.Model([], np.zeros((langid.BINS, 1), np.float32)))
