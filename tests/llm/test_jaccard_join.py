import random
import re

import pytest

import docweave.llm.jaccard_join as jaccard_join_module
from docweave.llm.jaccard_join import jaccard_join, one_of_each
from docweave.llm.queries import QUERIES
from docweave.llm.tables import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in WORD.findall((text or "").encode())]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(pairs):
    """(doc_id, size, component) by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    tried = set()
    for held in where.values():
        for x in held:
            for y in held:
                if x < y and (x, y) not in tried:
                    tried.add((x, y))
                    both = len(sets[x] & sets[y])
                    if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                        parent[find(x)] = find(y)
    least = {}
    for i, (d, _) in enumerate(pairs):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(
        ((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(pairs)), key=str
    )


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def family(rng, prose, first, count, length, edits):
    base = prose(rng, length).split()
    out = [(first, " ".join(base))]
    for i in range(1, count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        out.append((first + i, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def hard(prose):
    rng = random.Random(3)
    passage = prose(rng, 40)
    pairs = [(i, prose(rng, rng.randint(1, 80))) for i in range(60)]
    pairs += family(rng, prose, 100, 60, 60, 4)
    pairs += family(rng, prose, 200, 30, 200, 10)
    chain = prose(rng, 100).split()
    for i in range(12):  # neighbours are similar, ends are not
        pairs.append((300 + i, " ".join(chain[i * 4 : i * 4 + 60])))
    pairs += [(400 + i, prose(rng, 8) + " " + passage + " " + prose(rng, 8)) for i in range(40)]
    pairs += [(500, ""), (501, None), (502, "  \n\t "), (503, "one"), (504, "ONE"), (505, "one two three four"), (506, "one  two three\tfour"),
              (507, "É é"), (508, "é é"), (509, "a " * 3000), (510, "a a a a a"), (511, "x" * 5000)]
    pairs += [(100, pairs[60][1]), (600, pairs[60][1].upper()), (None, pairs[0][1]), (None, prose(rng, 30)), (1, prose(rng, 20))]
    rng.shuffle(pairs)
    return pairs


def test_against_brute_force(documents, hard):
    assert rows(jaccard_join(documents(hard))) == brute(hard)


def test_one_of_each(documents, hard):
    kept = one_of_each(documents(hard))
    assert kept.columns == documents([]).columns
    ids = sorted((r.doc_id for r in kept.collect() if shingle_set(r.text) and r.doc_id is not None))
    # Two different texts share the id 1 and both stay.
    assert ids == sorted([1, *{c for d, n, c in brute(hard) if n and c is not None}])
    assert sorted(r.doc_id for r in kept.collect() if not shingle_set(r.text)) == [500, 501, 502]


def test_other_texts_under_one_id_with_equal_short_hashes(documents, collide):
    pairs = [(i, word) for i in (None, 4) for word in collide]
    kept = one_of_each(documents(pairs)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(4, word) for word in sorted(collide)]


def test_no_rows(documents):
    assert rows(jaccard_join(documents([]))) == []
    assert one_of_each(documents([])).count() == 0
    assert rows(jaccard_join(documents([(1, None), (2, None)]))) == [(1, 0, 1), (2, 0, 2)]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows(QUERIES["op10_ngram_jaccard_join"](spark, "/root/testdata/sf0.001")) == brute(pairs)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert {k: v for k, v in found.items() if k != 300} == want


def test_rows_of_shared_passages_and_copies(spark, monkeypatch):
    """A passage in unlike texts that are far apart gives no pair for each two of them; copies are still found."""
    made, write = [], jaccard_join_module.stored

    def stored(df):
        out = write(df)
        if "place_a" in out.columns:
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join_module, "stored", stored)
    passage = " ".join(f"shared{w}" for w in range(25))
    rows = [(k, " ".join(f"own{k}x{w}" for w in range(60)) + " " + passage) for k in range(40)]
    text = [f"copied{w}" for w in range(80)]
    rows += [(100 + k, " ".join(text[:k] + [f"edit{k}"] + text[k + 1 :])) for k in range(30)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join(docs).collect()}
    assert got == {d: min(d, 100) for d, _ in rows}
    cells = len(rows) * 18
    assert made[0] <= 2 * cells
