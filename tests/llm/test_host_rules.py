"""Rules by host against a plain version, written apart from the module's own measures."""

import collections
import random
import re

import pytest

from docweave.llm import host_rules

HOSTS = ["a.org", "b.org", "c.org", "bad.example", "noisy.example", None]


def plain_measures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    found = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if found[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(inside), len(lines),
    )


def plain_fails(m):
    words, chars, symbols, same, repeated, lines = m
    return (
        words < 50, 100 * repeated > 50 * words, 10 * symbols > chars, 100 * same > 30 * lines,
        chars < 2 * words or chars > 15 * words,
    )


def plain_judged(rows):
    """``rows``: (doc_id, host, text); the results in their order."""
    measures = [plain_measures(t) for _, _, t in rows]
    failed = [plain_fails(m) for m in measures]
    counts, total = collections.Counter(), collections.defaultdict(lambda: [0] * 5)
    for (_, host, _), f in zip(rows, failed):
        if host is not None:
            counts[host] += 1
            total[host] = [a + b for a, b in zip(total[host], f)]
    n = sum(counts.values())
    rate = collections.defaultdict(list)
    for r in range(5):
        mean = sum(t[r] for t in total.values()) / n if n else 0
        correlation = 0.5
        free = n - len(counts) - sum(c * c for c in counts.values()) / n + 1 if n else 0
        if 0 < mean < 1 and free > 0:
            variation = sum(c * (total[h][r] / c - mean) ** 2 for h, c in counts.items())
            correlation = (variation / (mean * (1 - mean)) - (len(counts) - 1)) / free
        strength = 1 / min(max(correlation, 1e-4), 0.5) - 1
        for h, c in counts.items():
            rate[h].append((total[h][r] + mean * strength) / (c + strength))
        rate[None].append(mean)
    out = []
    for (i, host, _), m, f in zip(rows, measures, failed):
        base = f[0] or f[1]
        good = max(rate[host]) <= 0.5 and not any(x and rate[host][r] > 0.05 for r, x in enumerate(f))
        out.append((i, *m, base, not base and good))
    return out


def some_text(rng, prose, kind):
    text = prose(rng, rng.randint(50, 120))
    if kind == "short":
        return prose(rng, rng.randint(0, 49))
    if kind == "symbols":
        return " ".join(w + rng.choice("#*$%&|<>é") for w in text.split())
    if kind == "lines":
        return "\n".join([prose(rng, 20)] * 2 + [prose(rng, 30), " \t", "", "x y", "x y"])
    if kind == "repeat":
        return " ".join(text.split()[:12] * 8)
    return text


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_version(spark, prose, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        host = rng.choice(HOSTS) if i % 3 else "a.org"
        odds = {"bad.example": 8, "noisy.example": 2}.get(host, 0.2)
        kind = rng.choices(["good", "short", "symbols", "lines", "repeat"], [4, odds, 4 * odds, odds, odds / 2])[0]
        rows.append((i // 2 if i % 50 == 0 else i, host, some_text(rng, prose, kind)))
    rows += [(None, "a.org", None), (1000, None, ""), (1001, "only.one", "x"), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string")
    ours = host_rules.judged(docs, "host", ["doc_id"]).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, ours), key=key) == sorted(plain_judged(rows), key=key)
    assert {r.kept for r in ours if not r.base_failed} == {True, False}


def test_verdicts_of_hosts(spark, prose):
    rng = random.Random(9)
    rows = [("good", prose(rng, 60)) for _ in range(60)] + [("bad", prose(rng, 60) + " #" * 80) for _ in range(40)]
    rows += [("bad", prose(rng, 60)), ("single", prose(rng, 60) + " #" * 80)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, host string, text string")
    verdicts, priors = host_rules.host_verdicts(host_rules.measured(docs))
    by = {r.host: r for r in verdicts.collect()}
    assert by["bad"].rejected and not by["good"].rejected
    # One failure of one document is drawn to the mean of all hosts.
    assert priors["symbols"][0] < by["single"].rate_symbols < 1
    kept = host_rules.kept_documents(docs, "host")
    assert kept.columns == docs.columns
    assert {r.host for r in kept.collect()} == {"good"}  # the clean text of a rejected host goes as well


def test_edge_cases(spark, documents):
    empty = documents([])
    assert host_rules.judged(empty, "source").count() == 0
    assert host_rules.judged(documents([(1, None)]), "source", ["doc_id"]).first().asDict() == {
        "doc_id": 1, **dict.fromkeys(host_rules.MEASURES, 0), "base_failed": True, "kept": False,
    }
    no_hosts = spark.createDataFrame([(1, None, "w " * 60)], "doc_id long, host string, text string")
    assert host_rules.judged(no_hosts, "host").count() == 1
    clash = spark.createDataFrame([(1, "h", "a b", 5, True, "x", "y")], "doc_id long, host string, text string, n_words int, kept boolean, __c0 string, __host string")
    row = host_rules.judged(clash, "host").first().asDict()
    assert (row["n_words"], row["kept"], row["__c0"], row["__host"], row["text"]) == (2, False, "x", "y", "a b")
    assert host_rules.kept_documents(clash, "host").columns == clash.columns


def test_long_text(spark, prose):
    text = prose(random.Random(3), 30_000) + "\n" + "again and again " * 20_000
    docs = spark.createDataFrame([(1, "h", text)], "doc_id long, host string, text string")
    row = host_rules.judged(docs, "host", ["doc_id"]).first()
    assert row.n_words == 90_000 and tuple(row)[1:7] == plain_measures(text)


def test_host_of(spark):
    urls = ["https://User:pw@Example.ORG:80/a?b", "http://x.y", "mailto:a", "", None, "ftp://h#f"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(host_rules.host_of("url")).collect()] == ["example.org", "x.y", None, None, None, "h"]
