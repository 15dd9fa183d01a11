import random
import zlib

import numpy as np

from tidemark.llm import langid

DOCS = "doc_id long, text string, lang string, source string, score string"
WORDS = {"en": "the of and with ing tion er", "de": "der die und ßen ung ei", "fr": "le que été ment de", "es": "el los ción ñ de"}


def corpus(n=600):
    draw = random.Random(2)
    rows = []
    for i in range(n):
        lang = draw.choice(list(WORDS))
        parts = WORDS[lang].split()
        text = " ".join(draw.choice(parts) + draw.choice(parts) for _ in range(draw.randrange(5, 60)))
        rows.append((i, text.capitalize(), lang, "s", None))
    return rows


def brute_ngrams(text):
    padded = b" " + bytes(langid._FOLD[np.frombuffer(text.encode(), np.uint8)]) + b" "
    return [padded[i : i + 4] for i in range(len(padded) - 3) if padded[i + 1] != 32]


def test_ngrams_equal_brute_force():
    texts = ["", "a", "ab", "Abc d", "ö", "1 2 3", "x" * 50, "Ünd so"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    codes, counts, heads = langid.ngrams(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, text in enumerate(texts):
        own = codes[heads[i] : heads[i + 1]][counts[heads[i] : heads[i + 1]]]
        assert [int(c).to_bytes(4, "little") for c in own] == brute_ngrams(text)


def test_held_out_accuracy(spark):
    data = corpus()
    rows = langid.report(spark.createDataFrame(data, DOCS).repartition(3)).collect()
    truth = {d: lang for d, _, lang, *_ in data}
    out = [r for r in rows if r.held_out]
    assert len(rows) == len(data) and len(out) > 50
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_does_not_see_lang(spark):
    data = corpus()
    hidden = [(d, t, None if zlib.crc32(str(d).encode()) % 4 == 2 else lang, None, None) for d, t, lang, *_ in data]
    one, other = (
        {r.doc_id: (r.lang_pred, r.score) for r in langid.report(spark.createDataFrame(rows, DOCS)).collect()}
        for rows in (data, hidden)
    )
    assert one == other


def test_hard_rows(spark):
    data = [*corpus(100), (None, None, "en", None, None), (1000, "", "en", "s", None), (1001, "12 !?", None, "s", None)]
    data += [(1002, "the ing of " * 30000, None, "s", "x"), (1003, "日本", "en", "s", None), (5, "the of", "en", "s", None)]
    got = {r.doc_id: r for r in langid.report(spark.createDataFrame(data, DOCS)).collect()}
    assert [got[i].lang_pred for i in (None, 1000, 1001, 1002)] == ["und", "und", "und", "en"]
    assert got[1003].lang_pred in WORDS and got[None].score == 0
    kept = langid.predict(spark.createDataFrame(data, DOCS), langid.learn(spark.createDataFrame(data, DOCS)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score"]
    assert kept.count() == len(data)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None, None, None)], DOCS)
    assert [r.lang_pred for r in langid.report(docs).collect()] == ["und"]
    assert langid.report(docs.limit(0)).count() == 0


def test_more_languages_than_one_plane(spark):
    rows = [(i, f"x{chr(97 + i % 26)}{chr(97 + i // 26)}q " * 20, f"l{i:03d}", "s", None) for i in range(90)]
    docs = spark.createDataFrame(rows, DOCS)
    got = langid.predict(docs, langid.learn(docs)).collect()
    assert all(r.lang == r.lang_pred for r in got)


def brute_profiles(rows, least_ratio=0.3):
    """Language to its n-grams: those at least 0.3 times as common there as where they are most common."""
    counts = {}
    for _, text, lang, *_ in rows:
        if text is not None and lang is not None:
            own = counts.setdefault(lang, {})
            for gram in brute_ngrams(text):
                own[gram] = own.get(gram, 0) + 1
    shares = {lang: {g: n / sum(own.values()) for g, n in own.items()} for lang, own in counts.items()}
    best = {}
    for own in shares.values():
        for gram, share in own.items():
            best[gram] = max(best.get(gram, 0), share)
    return {lang: {g for g, share in own.items() if share >= best[g] * least_ratio} for lang, own in shares.items()}


def brute_judge(model, profiles, text):
    """By sets; a gram that no set holds counts where the filter says so, and the expected number of those is taken off."""
    grams, values = brute_ngrams(text), []
    for i, lang in enumerate(model.langs):
        hits = 0
        for gram in grams:
            code = int.from_bytes(gram, "little")
            places = [(code * int(factor)) % (1 << 32) >> model.shift for factor in langid._HASHES]
            passed = all(int(model.planes[i // 64][p]) >> (i % 64) & 1 for p in places)
            assert passed or gram not in profiles[lang]  # the filter loses nothing
            hits += gram in profiles[lang] or passed
        chance = float(model.chance[i])
        values.append((hits - len(grams) * chance) / (1 - chance))
    best = max(range(len(values)), key=lambda i: (values[i], -i))
    score = min(1.0, max(0.0, values[best] / max(len(grams), 1)))
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    return (model.langs[best] if score > 0 else model.default), score


def test_decisions_equal_sets(spark):
    rows = corpus(120) + [(2000, "qqqq zzzz", "fr", "s", None), (2001, "12 ?", "en", "s", None), (2002, "der the der the", "de", "s", None)]
    rows += [(2003, "", "es", "s", None), (2004, "日本 の", "fr", "s", None), (2005, "x", "es", "s", None)]
    docs = spark.createDataFrame(rows, DOCS)
    model, profiles = langid.learn(docs), brute_profiles(rows)
    assert model.langs == sorted(profiles)
    texts = {d: t for d, t, *_ in rows}
    unseen = [(5000 + i, t, None, None, None) for i, t in enumerate(["the der of ing le", "ñññ los ción x", "wholly unseen words", "a", "b 1 c"])]
    texts |= {d: t for d, t, *_ in unseen}
    got = langid.predict(docs.unionByName(spark.createDataFrame(unseen, DOCS)), model).collect()
    for row in got:
        lang, score = brute_judge(model, profiles, texts[row.doc_id])
        assert row.lang_pred == lang and abs(row.score - score) < 1e-12, texts[row.doc_id]
    # False positives are as rare as the model says: grams that no language has.
    wrong = np.random.default_rng(1).integers(0, 1 << 32, 50_000, dtype=np.uint64)
    known = {int.from_bytes(g, "little") for own in profiles.values() for g in own}
    wrong = [int(c) for c in wrong if int(c) not in known]
    for i in range(len(model.langs)):
        passed = sum(
            all(int(model.planes[0][(c * int(f)) % (1 << 32) >> model.shift]) >> i & 1 for f in langid._HASHES) for c in wrong
        )
        assert abs(passed / len(wrong) - model.chance[i]) < 0.002 + 3 * model.chance[i]
