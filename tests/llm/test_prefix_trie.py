"""The trie against a plain one of nested prefixes, built from the rules alone."""

import hashlib
import random
import zlib

import pytest

from docweave.llm import prefix_trie as p


def plain_turns(rows):
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in by.items()}


def plain_rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def plain_trie(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    out, total = [], {}
    for k in sorted(members, key=len, reverse=True):
        below = children.get(k, [])
        own = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        total[k] = (own + sum(total[b][0] for b in below), sum(total[b][1] for b in below) or 1)
        ends = ",".join(map(str, sorted(c for c in members[k] if len(seqs[c]) == len(k))))
        out.append(
            (min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(below), total[k][1], total[k][0],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=lambda r: (r[1], r[0]))


def ours(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0]))


KIND = "conv_id long, turn long, role string, text string, conv string, d int, k1 string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, "y") for r in rows], KIND)


@pytest.mark.parametrize("seed, longest", [(0, 4), (1, 9), (2, 18)])
def test_against_plain_version(spark, seed, longest):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-3, 40), 100, 101, 150, 205, 2**62]:
        n = rng.randint(1, longest)
        rows += [(c, t if t else None, rng.choice(["user", None]), rng.choice(["a", "é\n", "", None, "bcd"])) for t in range(n)]
    rows += [(None, 0, "user", "lost"), (0, -5, "user", "early")]
    rng.shuffle(rows)
    assert ours(p.rebuilt_trie(table(spark, rows).repartition(3))) == plain_trie(plain_rebuilt(plain_turns(rows)))


def test_hot_prefixes_and_copies(spark):
    """A third of all conversations are alike, as many share a first turn, and one holds a third of all turns."""
    rng = random.Random(7)
    seqs = {c: [("u", "same")] * 5 for c in range(60)}
    seqs |= {c: [("u", "hello")] + [("a", rng.choice("xyz"))] * rng.randint(0, 3) for c in range(60, 120)}
    seqs |= {c: [("u", rng.choice("pq"))] for c in range(120, 150)}
    seqs[500] = [("u", str(rng.random()))] * 2 + [("u", "same")] * 250
    rows = [(c, t, *turn) for c, s in seqs.items() for t, turn in enumerate(s)]
    turns = p.numbered_turns(table(spark, rows).repartition(8))
    assert ours(p.prefix_trie(turns, p.lengths(turns))) == plain_trie(seqs)


def test_numbers_of_a_conversation_over_many_tasks(spark):
    rows = [(1 if t < 300 else 2, t % 300, "u", str(t)) for t in range(330)]
    turns = p.numbered_turns(table(spark, rows).repartition(16)).collect()
    assert sorted((r.conv, r.d) for r in turns) == [(c, d) for c, n in ((1, 300), (2, 30)) for d in range(1, n + 1)]
    assert [r.n for r in sorted(turns, key=lambda r: (r.conv, r.d))] == [len(r[3]) for r in rows]


def test_edge_cases(spark):
    assert p.rebuilt_trie(table(spark, [])).count() == 0
    # 7 is rebuilt from its turns after the first four, 0 has none of them to give.
    rows = [(7, 0, "u", "a" * 100_000), (7, 0, "u", "a" * 100_000), (8, None, None, None)]
    assert ours(p.rebuilt_trie(table(spark, rows))) == plain_trie(plain_rebuilt(plain_turns(rows)))
    turns = p.numbered_turns(table(spark, rows))
    assert ours(p.prefix_trie(turns, p.lengths(turns))) == plain_trie(plain_turns(rows))


def test_ids_of_a_node_over_many_pieces(spark):
    rows = [(c, 0, "u", "same") for c in range(0, 30_000, 7)]
    turns = p.numbered_turns(table(spark, rows))
    found = ours(p.prefix_trie(turns, p.lengths(turns)))
    assert found == plain_trie(plain_turns(rows))
