"""Prefix trie of conversations, built by van Emde Boas recursion.

A trie of depth below 2^k is cut at half its depth. Every cut prefix gets a name, made of the name of
the block's root and a hash of the turns since; the upper trie then needs one conversation for
each name, which stands for all that share the prefix, and the turns below the cut form a
forest with a root for each name. Both halves are cut again, all blocks of a level at once, so a
trie of depth d takes log2(d) rounds and every turn is named in one of them. Totals are grafted
back: from the finest blocks up, a cut node takes the total of the block below it and hands it
to its block's root; then, from the coarsest down, those of the nodes at its own block's end.

128 bits of hashes tell turns, segments and names apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.llm.tables import join_by_size, shared_folder, stored

#: Conversations that end at one node are joined to text in pieces of so many ids.
IDS = 4096

_NODE = ["d", "k1", "k2"]


# --- Sequences ---


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``d`` (from 1), hashes ``x``, ``y`` of role and text, and ``n``, the text's code points.

    Turns go by ``turn``, null first; equal ones in the order of their hashes. A null role or text is empty, rows
    without ``conv_id`` belong to no conversation, and repeated rows are turns of their own. Rows are sorted
    over all tasks, so one very long conversation is no large group: its parts are numbered apart and
    shifted by the parts before, of which each task but the first starts with one at most.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit(1), text, role).alias("y"), F.char_length(text).alias("n"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("x"), F.col("y")]
    parts = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "x", "y", "n", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    )
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("rows"))
    shifts = counts.select("conv", "part", F.sum("rows").over(before).alias("shift")).filter("shift > 0")
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy("at"))
    numbered = parts.withColumn("within", within.cast("long")).join(F.broadcast(shifts), ["conv", "part"], "left")
    return stored(numbered.select("conv", (F.col("within") + F.coalesce("shift", F.lit(0))).alias("d"), "x", "y", "n"))


def lengths(turns: DataFrame) -> DataFrame:
    """``conv`` and its number of turns ``len``."""
    return turns.groupBy("conv").agg(F.count(F.lit(1)).alias("len"))


def with_shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations rebuilt with the head of another one.

    Conversation c begins with the first h turns of conversation c - c % every, where h is the unsigned crc32 of c in
    decimal, modulo ``most``, and goes on with its own turns after the first h. One head serves fewer
    than 2 * ``every`` conversations and has fewer than ``most`` turns.
    """
    own = stored(
        lengths(turns).withColumns(
            {
                "h": F.crc32(F.col("conv").cast("string").cast("binary")) % most,
                "head": F.col("conv") - F.col("conv") % every,
            }
        )
    )
    heads = turns.filter((F.col("conv") % every == 0) & (F.col("d") < most))
    n_heads = own.select(F.col("conv").alias("head"), F.col("len").alias("head_len"))
    known = own.join(n_heads, "head", "left").select(
        "conv", "h", "head", "len",
        F.least("h", F.coalesce("head_len", F.lit(0))).alias("kept"), F.greatest(F.col("len") - F.col("h"), F.lit(0)).alias("rest"),
    )
    known = stored(known)
    first = known.select(F.col("conv").alias("to"), "h", "head").join(heads.withColumnRenamed("conv", "head"), "head")
    first = first.filter("d <= h").select(F.col("to").alias("conv"), "d", "x", "y", "n")
    later = join_by_size(turns, known.select("conv", "h", "kept", "len"), ["conv"], "len").filter("d > h")
    later = later.select("conv", (F.col("d") - F.col("h") + F.col("kept")).alias("d"), "x", "y", "n")
    return stored(first.unionByName(later)), stored(known.select("conv", (F.col("kept") + F.col("rest")).alias("len")))


# --- Naming, from the top ---


def _cut_segments(turns: DataFrame, sizes: DataFrame, levels: int, path: str) -> DataFrame:
    """The hash of the upper half of each block that a conversation crosses: ``conv``, level ``t``, ``j``.

    At level t halves have 2^t turns; the j-th of them, j even, is an upper half. Written by level. ``n`` is that of its last turn.
    """
    crossed = F.expr(
        f"filter(sequence(0, {levels - 1}), t -> (shiftright(d - 1, t) & 1) = 0 AND shiftleft(shiftright(d - 1, t) + 1, t) <= len)"
    )
    rows = join_by_size(turns, sizes, ["conv"], "len").select("conv", "d", "x", "y", "n", F.explode(crossed).alias("t"))
    j = F.expr("shiftright(d - 1, t)")
    rows.groupBy("conv", "t", j.alias("j")).agg(
        F.bit_xor(F.xxhash64("d", "x")).alias("x"), F.bit_xor(F.xxhash64("y", "d")).alias("y"),
        F.max(F.when(F.expr("d = shiftleft(shiftright(d - 1, t) + 1, t)"), F.col("n"))).alias("n"),
    ).write.partitionBy("t").parquet(path)
    kind = "conv long, j long, x long, y long, n int, t int"
    return turns.sparkSession.read.schema(kind).parquet(path)


def _name_prefixes(sizes: DataFrame, segments: DataFrame, levels: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two tables by level ``t``, their files below ``folder``.

    ``paths``: of each conversation in a block (root ``r1``, ``r2`` at depth ``a``) the name ``k1``, ``k2`` of its node at the cut
    ``d``, null if it ends above. ``live`` rows are conversations themselves, others stand for ``w`` that share a cut
    prefix. ``nodes``: of each name the smallest member ``conv``, members, those that end there, and code points.
    """
    spark = sizes.sparkSession
    block = sizes.filter("len > 0").select(
        "conv", "len", *(F.lit(0).cast("long").alias(c) for c in ("a", "r1", "r2")),
        F.lit(1).cast("long").alias("w"), F.lit(True).alias("live"),
    )
    for t in range(levels - 1, -1, -1):
        half = 1 << t
        found = segments.filter(F.col("t") == t).drop("t")
        depth = F.col("a") + half
        named = block.withColumn("j", F.expr(f"shiftright(a, {t})")).join(found, ["conv", "j"], "left")
        named.select(
            *block.columns, depth.alias("d"), "n",
            F.when(F.col("x").isNotNull(), F.xxhash64(depth, "r1", "x")).alias("k1"),
            F.when(F.col("x").isNotNull(), F.xxhash64("y", "r2", depth)).alias("k2"),
        ).write.parquet(f"{folder}/paths/t={t}")
        paths = spark.read.parquet(f"{folder}/paths/t={t}")
        through = paths.filter("k1 IS NOT NULL")
        through.groupBy("a", "r1", "r2", *_NODE).agg(
            F.min("conv").alias("conv"), F.sum("w").alias("n_convs"),
            F.count_if(F.col("live") & (F.col("len") == F.col("d"))).alias("n_ends"), F.max("n").alias("n"),
        ).write.parquet(f"{folder}/nodes/t={t}")
        nodes = spark.read.parquet(f"{folder}/nodes/t={t}")
        above = paths.filter("k1 IS NULL").select(*block.columns)
        below = through.filter("len > d").select("conv", "len", F.col("d").alias("a"), F.col("k1").alias("r1"), F.col("k2").alias("r2"), "w", "live")
        upper = nodes.select("conv", (F.col("d") - 1).alias("len"), "a", "r1", "r2", F.col("n_convs").alias("w"), F.lit(False).alias("live"))
        block = above.unionByName(below).unionByName(upper)
    everything = [spark.read.option("basePath", f"{folder}/{k}").parquet(f"{folder}/{k}") for k in ("paths", "nodes")]
    return everything[0], everything[1]


# --- Totals, from the bottom ---


def _level(depth: Column, levels: int) -> Column:
    """The level at which a depth is cut: its trailing zeros; that of the root is ``levels``."""
    return F.when(depth == 0, F.lit(levels)).otherwise(F.bit_count(depth.bitwiseAND(-depth) - 1))


def _block_totals(nodes: DataFrame, root: DataFrame, levels: int, folder: str) -> DataFrame:
    """The nodes with totals of themselves and the block below them: ``saved`` and ``leaves``.

    A block's total is the sum of its cut nodes', of all its levels, so each level needs the sums of the finer ones by root.
    """
    spark = nodes.sparkSession
    own = [((F.col("n_convs") - 1) * F.col("n")).alias("own"), (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf")]
    kept = ["a", "r1", "r2", *_NODE, "conv", "n_convs"]
    kind = "a long, r1 long, r2 long, d long, k1 long, k2 long, conv long, n_convs long, saved long, leaves long, up int"
    for t in range(levels + 1):
        cut = (root if t == levels else nodes.filter(F.col("t") == t)).select(*kept, *own)
        if t:
            finer = spark.read.schema(f"{kind}, t int").parquet(f"{folder}/totals").filter((F.col("up") == t) & (F.col("t") < t))
            sums = finer.groupBy(*(F.col(a).alias(b) for a, b in zip(("a", "r1", "r2"), _NODE))).agg(
                F.sum("saved").alias("s"), F.sum("leaves").alias("l")
            )
            cut = cut.join(sums, _NODE, "left")
        else:
            cut = cut.withColumns({"s": F.lit(0), "l": F.lit(0)})
        zero = F.lit(0).cast("long")
        cut.select(
            *kept, (F.col("own") + F.coalesce("s", zero)).alias("saved"), (F.col("leaf") + F.coalesce("l", zero)).alias("leaves"),
            _level(F.col("a"), levels).alias("up"),
        ).write.parquet(f"{folder}/totals/t={t}")
    return spark.read.schema(f"{kind}, t int").parquet(f"{folder}/totals")


def _grafted(totals: DataFrame, paths: DataFrame, levels: int, folder: str) -> DataFrame:
    """The nodes with totals of their whole subtrees: ``saved`` and ``leaves``.

    What a block leaves out of a cut node's subtree hangs on the nodes at the block's end, which a coarser level has
    cut. Each of them has one representative in the block, whose path leads to the cut node: one join for each level.
    """
    spark = totals.sparkSession
    kind = "d long, k1 long, k2 long, conv long, n_convs long, saved long, leaves long"
    columns = [c.split()[0] for c in kind.split(", ")]
    for t in range(levels, -1, -1):
        cut = totals.filter(F.col("t") == t).select(*columns)
        if t < levels - 1:
            ends = spark.read.schema(f"{kind}, t int").parquet(f"{folder}/finals").filter((F.col("t") > t) & (F.col("d") > 0))
            steps = paths.filter((F.col("t") == t) & ~F.col("live") & F.col("k1").isNotNull())
            more = (
                steps.select("conv", *_NODE, (F.col("d") + (1 << t)).alias("end"))
                .join(ends.select("conv", F.col("d").alias("end"), "saved", "leaves"), ["conv", "end"])
                .groupBy(*_NODE).agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
            )
            zero = F.lit(0).cast("long")
            cut = cut.join(more, _NODE, "left").withColumns(
                {"saved": F.col("saved") + F.coalesce("s", zero), "leaves": F.col("leaves") + F.coalesce("l", zero)}
            )
        cut.select(*columns).write.parquet(f"{folder}/finals/t={t}")
    return spark.read.schema(kind).parquet(f"{folder}/finals")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``d``, ``k1``, ``k2`` and the SHA-256 of the decimal ids that end there, ascending and joined by commas.

    Ids are joined in pieces of bounded size by all tasks. One hash over a node's pieces cannot be shared among tasks; they
    stream through it in order, so memory stays small however many ids there are.
    """
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*_NODE, F.expr(f"conv - pmod(conv, {IDS})").alias("piece")).agg(text.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * 4
            out = [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            done.clear()
            return pa.record_batch(out, names=[*_NODE, "ends"])

        for batch in batches:
            for d, k1, k2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (d, k1, k2) == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (d, k1, k2), hashlib.sha256()
                digest.update(ids.encode())
            yield flush()
        if key is not None:
            done.append((*key, digest.hexdigest()))
            yield flush()

    dealt = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece")
    return dealt.mapInArrow(run, "d long, k1 long, k2 long, ends string")


# --- The operator ---


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The trie of all prefixes: one row per distinct sequence of first turns, from the empty one.

    ``turns`` are as ``numbered_turns`` gives them, ``sizes`` every conversation with its length, 0 included. Rows have
    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless
    nodes of the subtree, itself included), ``saved_tokens`` (summed over the subtree, members but one times the
    code points of the last text) and ``ends_sha256`` (of the ids that end there). No conversations give no rows.
    """
    spark = turns.sparkSession
    turns, sizes = stored(turns), stored(sizes)
    longest = sizes.agg(F.max("len")).first()[0]
    if longest is None:
        return _result_of(spark.createDataFrame([], _RESULT))
    levels, folder = max(int(longest).bit_length(), 1), shared_folder(spark)
    segments = _cut_segments(turns, sizes, levels, f"{folder}/segments")
    paths, nodes = _name_prefixes(sizes, segments, levels, folder)
    zeros = [F.lit(0).cast("long").alias(c) for c in ("a", "r1", "r2", *_NODE)]
    root = sizes.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("len") == 0).alias("n_ends"), F.lit(0).alias("n"))
    totals = _block_totals(nodes, stored(root.select(*zeros, "*")), levels, folder)

    # The parent of a node at odd depth is its block's root, that of one at even depth the last cut on the way to it.
    odd = totals.filter("t = 0").select(*_NODE, F.col("r1").alias("p1"), F.col("r2").alias("p2"))
    steps = paths.filter("t = 0 AND NOT live AND k1 IS NOT NULL").select("conv", (F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    even = totals.filter(f"t > 0 AND t < {levels}").join(steps, ["conv", "d"]).select(*_NODE, "p1", "p2")
    parents = stored(odd.unionByName(even))

    ends = paths.filter("live AND d = len").select(*_NODE, "conv").unionByName(sizes.filter("len = 0").select(*zeros[3:], "conv"))
    one = F.lit(1).cast("long")
    children = parents.select((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), one.alias("child"))
    parts = _grafted(totals, paths, levels, folder)
    for more in (children, _end_hashes(ends), parents):
        parts = parts.unionByName(more, allowMissingColumns=True)
    joined = stored(
        parts.groupBy(*_NODE).agg(
            F.max("conv").alias("conv_id"), F.max("n_convs").alias("n_convs"), F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"),
            F.max("leaves").alias("n_leaves"), F.max("saved").alias("saved_tokens"),
            F.coalesce(F.max("ends"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
            F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        )
    )
    named = joined.filter("n_children > 0").select(
        (F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    below = join_by_size(joined.filter("d > 0").withColumnRenamed("n_children", "own"), named, ["d", "p1", "p2"], "n_children")
    below = below.withColumn("n_children", F.col("own"))
    top = joined.filter("d = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return _result_of(below.unionByName(top, allowMissingColumns=True).withColumnRenamed("d", "depth"))


_RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def _result_of(rows: DataFrame) -> DataFrame:
    return rows.select(*(c.split()[0] for c in _RESULT.split(", ")))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of all conversations rebuilt ``with_shared_heads``."""
    return prefix_trie(*with_shared_heads(numbered_turns(conversations)))


SQL = """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS d,
           coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, list_reduce(flatten(list_transform(range(length(c::VARCHAR)), lambda i:
           [ascii(substr(c::VARCHAR, i + 1, 1)), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])),
           lambda z, b: CASE WHEN b >= 0 THEN xor(z, b) ELSE xor(z >> 1, 3988292384 * (z & 1)) END, 4294967295::BIGINT) AS z
        FROM (SELECT DISTINCT c FROM t)),
h AS (SELECT c, xor(z, 4294967295::BIGINT) % 6 AS h, c - c % 100 AS p FROM crc),
r AS (SELECT h.c, t.d, role, text FROM h JOIN t ON t.c = h.p AND t.d <= h.h
      UNION ALL
      SELECT h.c, t.d - h.h + least(h.h, (SELECT count(*) FROM t AS q WHERE q.c = h.p)), role, text
      FROM h JOIN t ON t.c = h.c AND t.d > h.h),
k AS (SELECT c, d, length(text) AS n, list(sha256(role || chr(1) || text)) OVER (PARTITION BY c ORDER BY d) AS k FROM r
      UNION ALL SELECT c, 0, 0, [] FROM h),
z AS (SELECT c, max(d) AS len FROM k GROUP BY c),
g AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS own,
      coalesce(string_agg(CASE WHEN d = len THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
      FROM k JOIN z USING (c) GROUP BY d, k),
e AS (SELECT g.*, u.conv_id AS parent_conv_id, u.k AS up FROM g LEFT JOIN g AS u ON u.d = g.d - 1 AND u.k = g.k[1:g.d - 1]),
b AS (SELECT e.*, coalesce(n, 0) AS n_children FROM e LEFT JOIN (SELECT d - 1 AS d, up AS k, count(*) AS n FROM e WHERE d > 0 GROUP BY ALL) USING (d, k)),
s AS (SELECT a.d, a.k, sum(own) AS saved, count_if(n_children = 0) AS leaves
      FROM (SELECT d, k, unnest(range(d + 1)) AS up, own, n_children FROM b) AS x
      JOIN (SELECT d, k FROM b) AS a ON a.d = x.up AND a.k = x.k[1:x.up] GROUP BY a.d, a.k)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM b JOIN s USING (d, k)
"""
