import hashlib
import random

import numpy as np
import pytest

from docweave.llm import repeats
from docweave.llm.queries import QUERIES
from docweave.llm.repeats import RunIndex, suffix_array, without_repeats


def brute(pairs, length=100):
    """(id, bytes, removed, runs, kept) by a table of all strings in the order of ids."""
    seen, out = set(), []
    for doc, text in sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, kept))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


def texts_of(letters, ends):
    def suffix(p):
        out = []
        while letters[p]:
            out.append((1, int(letters[p])))
            p += 1
        return [*out, (0, p)]

    return sorted(range(len(letters)), key=suffix)


def test_run_index_streams_matching_statistics():
    rng = random.Random(0)
    for _ in range(200):
        parts = [bytes(rng.choices(b"ab", k=rng.randint(0, 25))) for _ in range(rng.randint(1, 6))]
        letters = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int16) + 1, 0) for p in parts])
        ends = np.flatnonzero(letters == 0)
        order = texts_of(letters, ends)
        assert suffix_array(letters, ends).tolist() == order
        index = RunIndex(letters, ends)
        before, match = index.statistics()
        for q, p in zip(order, order[1:], strict=False):
            n = 0
            while letters[p + n] == letters[q + n] != 0:
                n += 1
            assert (before[p], match[p]) == (q, n)


def test_an_index_of_the_suffixes_that_are_long_enough():
    rng = random.Random(11)
    for least in (1, 3, 12, 40, 100):
        for letters in ("a", "ab", "abcdefgh"):
            base = ["".join(rng.choices(letters, k=120)) for _ in range(4)]
            parts = [b[rng.randrange(9) :] + rng.choice(letters) for b in base for _ in range(5)] + ["", letters]
            rng.shuffle(parts)
            text = np.frombuffer(b"\0".join(p.encode() for p in parts) + b"\0", np.uint8).astype(np.int16)
            ends = np.flatnonzero(text == 0)
            until = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text))
            full = suffix_array(text, ends)
            assert suffix_array(text, ends, least).tolist() == full[until[full] >= least].tolist()
            (before, match), (some_before, some_match) = RunIndex(text, ends).statistics(), RunIndex(text, ends, least).statistics()
            again = match >= least
            assert (again == (some_match >= least)).all()
            assert (before[again] == some_before[again]).all() and (match[again] == some_match[again]).all()


def test_a_repetitive_text_has_few_runs():
    line = np.frombuffer(b"the same line again and again. ", np.uint8).astype(np.int16) + 1
    letters = np.append(np.tile(line, 400), 0)
    assert len(RunIndex(letters, np.array([len(letters) - 1])).sample) < 100


def edited(rng, prose, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


@pytest.fixture(scope="module")
def pairs(prose):
    rng = random.Random(9)
    base = [prose(rng, rng.randint(5, 200)) for _ in range(30)]
    passage = prose(rng, 60)
    out = [(i, t) for i, t in enumerate(base)]
    out += [(100 + i, rng.choice(base)) for i in range(20)]
    out += [(200 + i, edited(rng, prose, rng.choice(base), rng.randint(1, 6))) for i in range(50)]
    out += [(300 + i, prose(rng, rng.randint(0, 30)) + passage + prose(rng, rng.randint(0, 30))) for i in range(30)]
    # Lines just short of, at and over the length, among other words.
    for k, n in enumerate((60, 98, 99, 100, 101, 131, 132, 133, 200)):
        line = (prose(rng, 80))[:n]
        out += [(400 + 10 * k + i, prose(rng, 12) + "|" + line + "|" + prose(rng, 12)) for i in range(6)]
    out += [(600, None), (601, ""), (602, "x" * 99), (603, "x" * 100), (604, "x" * 101), (605, "x" * 3000), (606, "ab" * 400), (607, "é" * 500),
            (608, passage + passage), (609, "\0" * 300), (610, "\0" * 150 + "end"), (611, "short")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("blocks", [(1 << 19, 1 << 18, 1 << 20, 1 << 21), (40, 900, 150, 900), (40, 900, 150, 1 << 20)])
def test_against_brute_force(documents, pairs, monkeypatch, blocks):
    for name, value in zip(("BLOCK_ANCHORS", "INDEX_BYTES", "_SLICE", "LARGEST_BYTES"), blocks, strict=True):
        monkeypatch.setattr(repeats, name, value)
    assert result(without_repeats(documents(pairs).repartition(5))) == brute(pairs)


def test_another_length(documents, pairs):
    assert result(without_repeats(documents(pairs), length=50)) == brute(pairs, 50)


def test_repeated_rows_null_ids_and_no_rows(documents, prose):
    rng = random.Random(1)
    a, b = prose(rng, 60), prose(rng, 60)
    pairs = [(5, a), (5, a), (None, a), (7, b), (None, b + "!"), (8, a[:150])]
    got = result(without_repeats(documents(pairs).repartition(6)))
    whole = [(5, len(a), 0, 0, a.encode())] * 2 + [(7, len(b), 0, 0, b.encode())]
    gone = [(None, len(a), len(a), 1, b""), (None, len(b) + 1, len(b), 1, b"!"), (8, 150, 150, 1, b"")]
    assert got == sorted(whole + gone, key=str)
    assert without_repeats(documents([])).count() == 0
    assert result(without_repeats(documents([(1, None)]))) == [(1, 0, 0, 0, b"")]


@pytest.mark.parametrize("number", [None, 4])
def test_other_texts_under_one_id_with_equal_short_hashes(documents, prose, collide, number):
    rest = "|" + prose(random.Random(2), 60)
    pairs = [(number, word + rest) for word in collide]
    for docs in (documents(pairs).coalesce(1), documents(pairs).repartition(4)):
        got = sorted((n_removed, kept) for _, _, n_removed, _, kept in result(without_repeats(docs)))
        assert got[0][0] == 0 and got[1][0] == len(rest)
        assert {got[0][1].decode(), got[1][1].decode() + rest} == {word + rest for word in collide}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {(d, n, m, s, hashlib.sha256(k).hexdigest()) for d, n, m, s, k in brute(pairs)}
    assert {tuple(r) for r in QUERIES["op2_suffix_dedup"](spark, folder).collect()} == want
