import random
import zlib
from collections import Counter

import numpy as np
import pytest

from docweave.llm import language_id
from docweave.llm.language_id import Profiles, identify, in_known_language, learn_profiles, letters
from docweave.llm.queries import QUERIES

MARK = 1 << 63


def grams(text):
    """N-grams as the numbers the operator uses, counted one by one."""
    line = [0]
    for ch in text.lower():
        c = ord(ch) if ch.isalpha() else 0
        if c or line[-1]:
            line.append(c)
    if line[-1]:
        line.append(0)
    out = Counter()
    for i, c in enumerate(line):
        if c:
            out[c << 42 | MARK] += 1
        if i + 1 < len(line):
            out[c << 21 | line[i + 1] | MARK] += 1
        if i + 2 < len(line) and line[i + 1]:
            out[c << 42 | line[i + 1] << 21 | line[i + 2]] += 1
    return out


def ranked(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda k: (-k[1], k[0]))[: language_id.PROFILE]]


def learn(rows):
    totals = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            totals.setdefault(lang, Counter()).update(grams(text))
    return {lang: {g: r for r, g in enumerate(sorted(c, key=lambda g: (-c[g], g if g < MARK else g - 2 * MARK))[: language_id.PROFILE])} for lang, c in totals.items()}


def predict(profiles, text):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    own = ranked(grams(text))
    best = None
    for lang in sorted(profiles):
        p = profiles[lang]
        apart = sum(abs(p[g] - r) if g in p else language_id.PROFILE for r, g in enumerate(own))
        if best is None or apart < best[0]:
            best = (apart, lang)
    return best[1], 1 - best[0] / (language_id.PROFILE * len(own))


@pytest.mark.parametrize("chunk", [1, 2, 5, 1 << 20])
def test_counts_do_not_depend_on_chunks(monkeypatch, chunk):
    monkeypatch.setattr(language_id, "_CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(1500):
        text = "".join(rng.choices("abÉ dé  ,.\n9漢", k=rng.randint(1, 16)))
        values, counts = language_id._grams(text, letters())
        assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == dict(grams(text))


def test_query_against_brute_force_and_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    out = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    profiles = learn([(r.text, r.lang) for r in rows if not out[r.doc_id]])
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in QUERIES["op6_language_id"](spark, folder).collect()}
    assert len(got) == len(rows)
    right = []
    for r in rows:
        lang, score = predict(profiles, r.text)
        assert got[r.doc_id][:2] == (out[r.doc_id], lang)
        assert got[r.doc_id][2] == pytest.approx(score, abs=1e-12)
        if out[r.doc_id]:
            right.append(lang == r.lang)
    assert np.mean(right) > 0.95


def test_odd_texts_and_tables(documents):
    docs = documents([(1, "the one and the other"), (2, "das eine und das andere"), (3, None), (4, ""), (5, "123 !?"), (None, "the other"), (6, "zz " * 700_000)],
                     lang=["en", "de", "en", None, "de", None, None])
    profiles = learn_profiles(docs)
    assert sorted(profiles) == ["de", "en"]
    found = identify(docs.withColumnRenamed("key", "score").withColumnRenamed("twin", "LANG_PRED"), profiles)
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.select("doc_id", "lang_pred", "score").collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[None][0] == "en"
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert 0 <= got[6][1] <= 1
    kept = in_known_language(docs, profiles)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 6, None]
    none = documents([])
    assert learn_profiles(none) == {}
    assert identify(none, {}).count() == 0
    assert {r.lang_pred for r in identify(docs, {}).collect()} == {"und"}


def test_a_large_table_is_sampled(documents):
    docs = documents([(i, f"text number {i}") for i in range(400)])
    assert set(learn_profiles(docs, documents=100)) == {"en"}


def test_rare_languages_are_learnt_whole(documents):
    pairs = [(i, f"text number {i}") for i in range(400)] + [(1000 + i, f"ord nummer {chr(97 + i)}") for i in range(3)]
    lang = ["en"] * 400 + ["xx"] * 3
    found = learn_profiles(documents(pairs, lang), documents=5)
    assert set(found) == {"en", "xx"}
    assert found["xx"] == learn_profiles(documents(pairs[400:], lang[400:]))["xx"]


def test_ties_go_to_the_first_name():
    same = [int(np.uint64(97 << 42 | MARK).view(np.int64))]
    assert Profiles({"b": same, "a": same}).predict("a")[0] == "a"
