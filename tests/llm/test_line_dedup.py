import random

from docweave.llm.line_dedup import line_dedup, without_repeats


def brute(pairs, width=3):
    """Lines that stay by looking at every window in order; pairs are distinct and have ids."""
    seen, out = set(), {}
    for doc, text in sorted(pairs, key=lambda p: p[0]):
        if text is None:
            out[doc] = (0, 0, None)
            continue
        lines = text.split("\n")
        gone = set()
        for i in range(max(len(lines) - width + 1, 1)):
            window = tuple(lines[i : i + width])
            if not "".join(window).strip(" \t\r"):
                continue
            if window in seen:
                gone |= set(range(i, min(i + width, len(lines))))
            seen.add(window)
        out[doc] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def made(rng):
    lines = [f"line {k}" for k in range(6)] + ["", " ", "é|x"]
    pairs = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for i in range(150)]
    block = "\n".join(f"shared {k}" for k in range(5))
    pairs += [(200 + i, f"own {i}\n{block}\nend {i}") for i in range(30)]
    pairs += [(300, None), (301, ""), (302, "\n\n\n\n"), (303, "\n\n\n\n"), (304, "x\n" * 4000), (305, "only"), (306, "only"), (307, "two\nlines"), (308, "two\nlines")]
    rng.shuffle(pairs)
    return pairs


def test_against_brute_force(documents):
    pairs = made(random.Random(4))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup(documents(pairs)).collect()}
    assert got == brute(pairs)


def test_other_widths(documents):
    pairs = made(random.Random(5))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup(documents(pairs), width=2).collect()}
    assert got == brute(pairs, 2)


def test_repeated_rows_null_ids_and_no_rows(documents):
    pairs = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd"), (None, "a\nb\nc"), (None, "d\ne\nf"), (1, "d\ne\nf")]
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in line_dedup(documents(pairs)).collect()), key=str)
    assert got == sorted(
        [(1, "a\nb\nc", 0), (1, "a\nb\nc", 0), (2, "d", 3), (None, "", 3), (None, "", 3), (1, "d\ne\nf", 0)], key=str
    )
    assert line_dedup(documents([])).count() == 0


def test_other_texts_under_one_id_with_equal_short_hashes(documents, collide):
    pairs = [(i, f"{word}\na\nb\nc") for i in (None, 4) for word in collide]
    got = [(r.doc_id, r.n_removed, r.text) for r in line_dedup(documents(pairs)).collect()]
    whole = [t for d, n, t in got if not n]
    assert len(whole) == 1 and whole[0] in [t for _, t in pairs]
    # The later ones of the same words are gone as a whole, the first of the other word keeps that.
    other = next(w for w in collide if w not in whole[0])
    assert sorted(((d, t) for d, n, t in got if n), key=str) == sorted([(4, other), (None, ""), (None, "")], key=str)


def test_stage_keeps_columns_and_clean_documents(documents):
    pairs = [(1, "a\nb\nc"), (2, "a\nb\nc"), (3, "x\na\nb\nc"), (4, ""), (5, None), (6, "clean")]
    docs = documents(pairs).withColumnRenamed("key", "n_lines").withColumnRenamed("id", "n_removed")
    kept = without_repeats(docs)
    assert kept.schema == docs.schema or kept.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars, r.n_lines, r.n_removed) for r in kept.collect()}
    assert got == {1: ("a\nb\nc", 5, "extra", 7), 3: ("x", 1, "extra", 7), 4: ("", 0, "extra", 7), 5: (None, None, "extra", 7), 6: ("clean", 5, "extra", 7)}
