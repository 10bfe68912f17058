"""Quotation linking: which message a reply quotes, and conversations in reply order without quotes.

A line's quote level is the number of ``>`` before its text. A passage is a run of lines of one
level without a blank line; a message's own text is what has level 0. Passages are compared by
the hash of their letters: case, white space and line breaks don't count. A quoted passage is
joined to the first message of its conversation that said it, in whole passages, paragraphs or lines of its own; if
none did before, to the first that has each of the passage's lines as one of those. A message
replies to what it quotes at the outermost level (the latest of several), else to the turn
before it. Following replies upwards gives each message its thread and depth.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.tables import bounded_batches, stored
from docweave.operators.running import checkpointed

_MARKS = re.compile(r"[ \t]*(?:>[ \t]*)+")
_SPACE = re.compile(r"\s+")
#: A line of this kind before a quotation names whom it quotes and goes with it.
_ATTRIBUTION = re.compile(r".*\S.*:\s*")


def normal_hash(text: str) -> int | None:
    """A hash of the text without regard to case and white space; None for a blank one."""
    text = _SPACE.sub(" ", text).strip().casefold()
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) if text else None


def parse(text: str) -> tuple[str, list[tuple[int, int]], list[int]]:
    """Own text, quoted passages as (level, hash), and hashes of own passages, paragraphs and lines."""
    return _parse(text)[:3]


def _parse(text: str) -> tuple[str, list[tuple[int, int]], list[int], list[tuple[int, int, tuple[int, ...]]]]:
    """What ``parse`` gives, and (level, hash, hashes of the lines) of quoted passages of several lines.

    Paragraphs are those of the text without quotations, passages also end at each quoted line.
    """
    lines = []
    for line in text.splitlines():
        found = _MARKS.match(line)
        lines.append((found.group().count(">"), line[found.end() :]) if found else (0, line))
    # Lines that announce a quotation of a deeper level.
    names = [
        k + 1 < len(lines) and lines[k + 1][0] > level and _ATTRIBUTION.fullmatch(content) is not None
        for k, (level, content) in enumerate(lines)
    ]
    own = [content for (level, content), name in zip(lines, names, strict=True) if not level and not name]
    quotes, parts, passages, run = [], [], [], []

    def close():
        if not run:
            return
        level = run[0][0]
        if level:
            said = normal_hash(" ".join(c for _, c, _ in run))
            quotes.append((level, said))
            each = {normal_hash(c) for _, c, name in run if not name} - {None}
            if len(run) > 1 and each:
                parts.append((level, said, tuple(sorted(each))))
        else:
            passages.append(normal_hash(" ".join(c for _, c, name in run if not name)))
        run.clear()

    for (level, content), name in zip(lines, names, strict=True):
        if run and (run[0][0] != level or not content.strip()):
            close()
        if content.strip():
            run.append((level, content, name))
    close()
    text = "\n".join(own).strip()
    units = {normal_hash(p) for p in re.split(r"\n[ \t\r]*\n", text)} | {normal_hash(x) for x in own} | {normal_hash(text), *passages}
    return text, list(dict.fromkeys(quotes)), sorted(units - {None}), list(dict.fromkeys(parts))


_PARSED = (
    "conv_id long, turn long, role string, content string, quotes array<struct<level:int,said:long>>, units array<long>, "
    "parts array<struct<level:int,said:long,lines:array<long>>>"
)
_PART = pa.struct([("level", pa.int32()), ("said", pa.int64()), ("lines", pa.list_(pa.int64()))])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_parse(t or "") for t in batch.column("text").to_pylist()]
        yield pa.record_batch(
            [
                *(batch.column(c) for c in ("conv_id", "turn", "role")),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([[{"level": a, "said": h} for a, h in f[1]] for f in found], pa.list_(pa.struct([("level", pa.int32()), ("said", pa.int64())]))),
                pa.array([f[2] for f in found], pa.list_(pa.int64())),
                pa.array([[{"level": a, "said": h, "lines": list(x)} for a, h, x in f[3]] for f in found], pa.list_(_PART)),
            ],
            names=["conv_id", "turn", "role", "content", "quotes", "units", "parts"],
        )


def _by_lines(parts: DataFrame, units: DataFrame, first: DataFrame) -> DataFrame:
    """Of ``parts`` (``conv_id``, ``turn``, ``level``, ``said``, ``lines``): the first turn that has all the lines among its units, if it is before.

    Only the turns that have the rarest of the lines are looked at, once for all that quote the same.
    """
    key = ["conv_id", "lines"]
    rarest = (
        parts.select(*key).distinct().select(*key, F.explode("lines").alias("said")).join(first, ["conv_id", "said"])
        .groupBy(*key).agg(F.count(F.lit(1)).alias("n_said"), F.min(F.struct("sayers", "said")).alias("least"))
        .filter(F.col("n_said") == F.size("lines"))
    )
    sayers = rarest.select(*key, F.col("least.said").alias("said")).join(units, ["conv_id", "said"]).select(*key, "turn")
    whole = (
        sayers.select(*key, "turn", F.explode("lines").alias("said")).join(units, ["conv_id", "turn", "said"])
        .groupBy(*key, "turn").agg(F.count(F.lit(1)).alias("n_said")).filter(F.col("n_said") == F.size("lines"))
        .groupBy(*key).agg(F.min("turn").alias("first"))
    )
    return (
        parts.join(whole, key).filter(F.col("first") < F.col("turn"))
        .groupBy("conv_id", "turn", "level", "said").agg(F.min("first").alias("first"))
    )


def link_quotations(messages: DataFrame) -> DataFrame:
    """One row per row of ``messages`` (``conv_id``, ``turn``, ``role``, ``text``), to be read by conversation, thread and turn.

    ``content`` is the text without quotations and the lines that announce them, ``reply_to`` the turn answered, ``thread`` the
    first turn of the chain of replies, ``depth`` its length up to here, ``n_quoted`` and ``n_linked`` the passages
    quoted and those found. A null text is empty. A message whose conversation or turn is null answers nothing
    and has no thread. Rows of one conversation and turn are one place: they share the links of all of them, the smallest
    turn counting on ties; repeated rows are returned as often as they occur. A passage that
    nobody said before stays unlinked. No rows give no rows.
    """
    spark = bounded_batches(messages.sparkSession)
    said = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    parsed = stored(said.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(_parsed, _PARSED))
    placed = parsed.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    units = placed.select("conv_id", "turn", F.explode("units").alias("said"))
    first = units.groupBy("conv_id", "said").agg(F.min("turn").alias("first"), F.count(F.lit(1)).alias("sayers"))
    quoted = placed.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.level", "q.said").distinct()
    found = quoted.join(first.drop("sayers"), ["conv_id", "said"]).filter(F.col("first") < F.col("turn"))
    if not placed.filter(F.size("parts") > 0).isEmpty():
        parts = placed.select("conv_id", "turn", F.explode("parts").alias("p")).select("conv_id", "turn", "p.*").distinct()
        parts = parts.join(found, ["conv_id", "turn", "level", "said"], "left_anti")
        found = found.unionByName(_by_lines(parts, units.distinct(), first))
    linked = (
        found.groupBy("conv_id", "turn")
        .agg(F.min(F.struct("level", (-F.col("first")).alias("late"))).alias("nearest"), F.count(F.lit(1)).alias("n_linked"))
        .select("conv_id", "turn", (-F.col("nearest.late")).alias("answered"), "n_linked")
    )
    places = placed.select("conv_id", "turn").distinct()
    before = places.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("previous"))
    links = checkpointed(
        places.join(linked, ["conv_id", "turn"], "left").join(before, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", F.coalesce("answered", "previous").alias("reply_to"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"))
    )
    # Every step doubles the part of the way up that is known, so the steps are few even for one long chain.
    way = links.select("conv_id", "turn", F.coalesce("reply_to", "turn").alias("up"), F.col("reply_to").isNotNull().cast("long").alias("depth"))
    while True:
        above = way.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        way = checkpointed(
            way.join(above, ["conv_id", "up"]).select("conv_id", "turn", F.col("further").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("more"))
        )
        if way.filter("more > 0").isEmpty():
            break
        way = way.drop("more")
    joined = links.join(way.select("conv_id", "turn", F.col("up").alias("thread"), "depth"), ["conv_id", "turn"])
    return parsed.join(joined, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "reply_to", "thread", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.size("quotes").cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "content",
    )

