import itertools
import random

from docweave.llm.quotations import link_quotations, normal_hash, parse
from docweave.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, thread string, units int"


def run(spark, rows):
    return link_quotations(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3))


def test_parse_levels_and_own_text():
    text = "Hello\nAnn wrote:\n> first line\n> goes on\n>\n> second\n>> deeper\n> > same depth\nmy answer\n\n  more"
    own, quotes, units = parse(text)
    assert own == "Hello\nmy answer\n\n  more"
    assert quotes == [(1, normal_hash("First  line goes on")), (1, normal_hash("second")), (2, normal_hash("deeper same depth"))]
    assert set(units) == {normal_hash(x) for x in ("Hello", "my answer", "more", "Hello my answer", "Hello my answer more")}
    assert parse("") == ("", [], []) and parse("> \n>>") == ("", [], [])
    assert parse("ratio: 3\nnote:") == ("ratio: 3\nnote:", [], parse("ratio: 3\nnote:")[2])


def test_links_follow_quotations(spark):
    rows = [
        (1, 0, "user", "How are you?\nTell me"),
        (1, 1, "assistant", "Fine.\n\nAnd you?"),
        (1, 2, "user", "> how ARE   you?\n> tell me\nNobody said?"),
        (1, 3, "assistant", "> And you?\n>> Tell me\nWell."),
        (1, 4, "user", "> never said\nok"),
        (1, 6, "user", "after a gap"),
        (2, 0, "user", "> And you?\nother conversation"),
        (None, 3, "user", "> Fine.\nno conversation"),
        (3, None, "user", "no turn"),
        (4, 0, None, None),
        (4, 1, "user", ""),
        (4, 1, "user", ""),
    ]
    got = sorted(((r.conv_id, r.turn, r.reply_to, r.thread, r.depth, r.n_quoted, r.n_linked, r.content) for r in run(spark, rows).collect()), key=str)
    want = [
        (1, 0, None, 0, 0, 0, 0, "How are you?\nTell me"),
        (1, 1, 0, 0, 1, 0, 0, "Fine.\n\nAnd you?"),
        (1, 2, 0, 0, 1, 1, 1, "Nobody said?"),
        (1, 3, 1, 0, 2, 2, 2, "Well."),
        (1, 4, 3, 0, 3, 1, 0, "ok"),
        (1, 6, None, 6, 0, 0, 0, "after a gap"),
        (2, 0, None, 0, 0, 1, 0, "other conversation"),
        (None, 3, None, None, 0, 1, 0, "no conversation"),
        (3, None, None, None, 0, 0, 0, "no turn"),
        (4, 0, None, 0, 0, 0, 0, ""),
        (4, 1, 0, 0, 1, 0, 0, ""),
        (4, 1, 0, 0, 1, 0, 0, ""),
    ]
    assert got == sorted(want, key=str)


def brute(rows):
    parsed = {(c, t): parse(x) for c, t, _, x in rows}
    out = []
    for (c, t), (own, quotes, _) in parsed.items():
        links = []
        for level, said in quotes:
            first = [u for (d, u), p in sorted(parsed.items()) if d == c and said in p[2]]
            if first and first[0] < t:
                links.append((level, -first[0]))
        reply = -min(links)[1] if links else (t - 1 if (c, t - 1) in parsed else None)
        out.append([c, t, reply, len(quotes), len(links), own])
    up = {(c, t): r for c, t, r, *_ in out}
    for row in out:
        at, depth = row[1], 0
        while up[row[0], at] is not None:
            at, depth = up[row[0], at], depth + 1
        row += [at, depth]
    return sorted(map(tuple, out))


def test_random_conversations_with_a_hot_one(spark, prose):
    rng = random.Random(6)
    rows, said = [], {}
    for c in [1] * 150 + [rng.randrange(2, 30) for _ in range(250)]:
        mine = said.setdefault(c, [])
        own = [prose(rng, rng.randint(1, 6)) for _ in range(rng.randint(1, 3))]
        lines = []
        for _ in range(rng.randint(0, 2)):
            if mine:
                lines.append(">" * rng.randint(1, 3) + " " + rng.choice(rng.choice(mine)).upper())
                lines.append("")
        mine.append(own)
        rows.append((c, len(mine) - 1, "user", "\n".join(lines + own)))
    got = run(spark, rows).collect()
    assert sorted((r.conv_id, r.turn, r.reply_to, r.n_quoted, r.n_linked, r.content, r.thread, r.depth) for r in got) == brute(rows)


def norm(text):
    return " ".join(text.split()).casefold()


def read(text):
    """Own text, quotations as {(level, passage): line lists}, and what the message said; written apart from ``parse``."""
    rows = []
    for line in text.splitlines():
        level, rest = 0, line
        while rest.lstrip(" \t").startswith(">"):
            level, rest = level + 1, rest.lstrip(" \t")[1:]
        rows.append((level, rest.lstrip(" \t") if level else rest))
    names = []
    for (level, line), (after, _) in itertools.zip_longest(rows, rows[1:], fillvalue=(0, "")):
        names.append(after > level and line.rstrip().endswith(":") and norm(line.rstrip()[:-1]) != "")
    own = [line for (level, line), name in zip(rows, names, strict=True) if level == 0 and not name]
    said = {norm("\n".join(own)), *map(norm, own)}
    said |= {norm(" ".join(g)) for blank, g in itertools.groupby(own, lambda line: not line.strip()) if not blank}
    quotes = {}
    for level, group in itertools.groupby(zip(rows, names, strict=True), lambda r: r[0][0] if r[0][1].strip() else None):
        group = list(group)
        if level == 0:
            said.add(norm(" ".join(line for (_, line), name in group if not name)))
        elif level:
            lines = [norm(line) for (_, line), name in group if not name]
            quotes.setdefault((level, norm(" ".join(line for (_, line), _ in group))), []).append(lines)
    return "\n".join(own).strip(), quotes, said - {""}


def brute_apart(rows):
    messages = {(c, t): read(x) for c, t, _, x in rows}
    out = []
    for (c, t), (own, quotes, _) in messages.items():
        links = []
        before = [(u, messages[c, u][2]) for d, u in sorted(messages) if d == c and u < t]
        for (level, passage), variants in quotes.items():
            whole = [u for u, said in before if passage in said]
            lined = [u for u, said in before if any(v and set(v) <= said for v in variants)]
            if whole or lined:
                links.append((level, -(whole or lined)[0]))
        out.append((c, t, -min(links)[1] if links else (t - 1 if (c, t - 1) in messages else None), len(quotes), len(links), own))
    return sorted(out, key=str)


def test_answers_between_quotations(spark):
    first = "> q1\na1\na2\n> q2\nb1"
    rows = [
        (1, 0, "user", first),
        (1, 1, "user", "between"),
        (1, 2, "user", "> a1\n> a2\nyes"),
        (1, 3, "user", "\n".join("> " + line for line in first.split("\n")) + "\nall of it"),
        (2, 0, "user", "l1\nl2\nl3"),
        (2, 1, "user", "between"),
        (2, 2, "user", "> l2\n> l3\nthe end of a paragraph"),
        (2, 3, "user", "> l3\n> never said\nonly one line was said"),
        (3, 0, "user", "l1"),
        (3, 1, "user", "l2"),
        (3, 2, "user", "l1\nl2\nl3"),
        (3, 3, "user", "between"),
        (3, 4, "user", "> l1\n> l2\nof the one that has both"),
        (3, 5, "user", "> l1\n> l2\n> Ann wrote:\n>> never said\nwith the line that announces"),
    ]
    got = {(r.conv_id, r.turn): (r.reply_to, r.n_quoted, r.n_linked) for r in run(spark, rows).collect()}
    assert got[1, 2] == (0, 1, 1) and got[1, 3] == (0, 4, 2)
    assert got[2, 2] == (0, 1, 1) and got[2, 3] == (2, 1, 0)
    assert got[3, 4] == (2, 1, 1) and got[3, 5] == (2, 2, 1)
    assert sorted(((*k, *v) for k, v in got.items())) == sorted(r[:5] for r in brute_apart(rows))


def test_random_answers_between_quotations(spark):
    rng = random.Random(9)
    rows, texts = [], {}
    for c in [rng.randrange(30) for _ in range(400)]:
        mine = texts.setdefault(c, [])
        lines = []
        for _ in range(rng.randint(0, 3)):
            if mine and rng.random() < 0.8:
                quoted = rng.choice(mine).split("\n")
                start = rng.randrange(len(quoted))
                stop = rng.choice([len(quoted), start + rng.randint(1, 3)])
                if rng.random() < 0.3:
                    lines.append(rng.choice(["Ann wrote:", ":", "On Monday: "]))
                lines += [">" * rng.randint(1, 2) + " " + line for line in quoted[rng.choice([0, start]) : stop]]
            lines += [rng.choice([f"w{rng.randrange(12)}", f"Own {rng.randrange(400)}", "", "note:"]) for _ in range(rng.randint(0, 4))]
        mine.append("\n".join(lines))
        rows.append((c, len(mine) - 1, "user", mine[-1]))
    got = sorted(((r.conv_id, r.turn, r.reply_to, r.n_quoted, r.n_linked, r.content) for r in run(spark, rows).collect()), key=str)
    assert got == brute_apart(rows)
    assert sum(r[4] for r in got) > 100


def test_no_rows(spark):
    assert run(spark, []).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op5_quotations"](spark, folder).collect()
    assert sorted((r.conv_id, r.turn, r.reply_to, r.n_quoted, r.n_linked, r.content, r.thread, r.depth) for r in got) == brute(rows)
