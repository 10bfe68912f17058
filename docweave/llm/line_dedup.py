"""Line dedup over overlapping three-line windows.

Every run of three consecutive lines of a document is a window, hashed as a whole. Windows that
occur more than once anywhere are found by one aggregate; every occurrence but the first, in the
order of id and line, covers its three lines. Covered positions are merged to spans, and what
lies between the spans stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.llm.tables import identity, stored

#: 96 bits tell windows apart.
_KEY = ["w64", "w32"]


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """``id``, ``twin``, line number ``i`` from 0, number of lines ``n`` and the hash of each window."""
    lines = docs.select(*identity(), _lines().alias("lines")).withColumn("n", F.size("lines"))
    starts = F.sequence(F.lit(1), F.greatest(F.col("n") - (width - 1), F.lit(1)))
    at = F.transform(
        starts,
        lambda i: F.struct(
            (i - 1).alias("i"),
            F.xxhash64(F.slice("lines", i, F.lit(width))).alias("w64"),
            F.hash(F.slice("lines", i, F.lit(width))).alias("w32"),
            F.exists(F.slice("lines", i, F.lit(width)), lambda x: x.rlike("[^ \\t\\r]")).alias("filled"),
        ),
    )
    return (
        lines.filter("n > 0").select("id", "twin", "n", F.explode(at).alias("w"))
        .filter("w.filled").select("id", "twin", "n", "w.i", *(f"w.{k}" for k in _KEY))
    )


def later_windows(docs: DataFrame, width: int = 3) -> DataFrame:
    """``id``, ``twin``, ``i``, ``n`` of each window that also occurs earlier."""
    windows = stored(_windows(docs, width))
    first = (
        windows.groupBy(*_KEY)
        .agg(
            F.min(F.struct("id", "twin", "i")).alias("first"),
            F.max(F.struct("id", "twin", "i")).alias("last"),
        )
        .filter("first != last").select(*_KEY, "first")
    )
    return (
        windows.join(first, _KEY).filter(F.struct("id", "twin", "i") != F.col("first"))
        .select("id", "twin", "i", "n").distinct()
    )


def kept_spans(docs: DataFrame, width: int = 3) -> DataFrame:
    """For each document that loses lines: ``n_lines``, ``n_removed``, and ``spans`` (first line, length) that stay."""
    order = Window.partitionBy("id", "twin").orderBy("i")
    end = F.least(F.col("i") + width, F.col("n"))
    gaps = later_windows(docs, width).select(
        "id", "twin", "n", end.alias("end"),
        F.coalesce(F.lag(end).over(order), F.lit(0)).alias("from"), F.col("i").alias("to"),
    )
    after = F.max("end")
    spans = gaps.groupBy("id", "twin").agg(
        F.max("n").alias("n_lines"), after.alias("after"),
        F.collect_list(
            F.when(F.col("to") > F.col("from"), F.struct("from", (F.col("to") - F.col("from")).alias("length")))
        ).alias("between"),
    )
    tail = F.struct(F.col("after").alias("from"), (F.col("n_lines") - F.col("after")).alias("length"))
    spans = spans.withColumn(
        "spans", F.sort_array(F.when(F.col("after") < F.col("n_lines"), F.array_append("between", tail)).otherwise(F.col("between")))
    )
    stay = F.aggregate("spans", F.lit(0), lambda total, s: total + s["length"])
    return spans.select("id", "twin", "n_lines", (F.col("n_lines") - stay).alias("n_removed"), "spans")


def line_dedup(docs: DataFrame, width: int = 3) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` cut, and ``n_lines`` and ``n_removed``, in place of any such columns.

    Lines end at ``\\n`` and are compared as they are. A text of fewer than ``width`` lines is one
    window, so its later copies lose all lines; windows of blank lines alone do not count. A null
    text has no lines and stays null; a text that loses all lines becomes empty. Rows that repeat
    an id and text are one document and keep their lines; other texts under one id are other
    documents, the one with the smaller text hash first; null ids come last. No rows give no rows.
    """
    number, text_hash = identity()
    spans = kept_spans(docs, width).select(
        F.col("id").alias("__id"), F.col("twin").alias("__twin"), F.col("n_lines").alias("__lines"),
        F.col("n_removed").alias("__removed"), F.col("spans").alias("__spans"),
    )
    joined = docs.withColumns({"__id": number, "__twin": text_hash}).join(spans, ["__id", "__twin"], "left")
    stay = F.transform("__spans", lambda s: F.array_join(F.slice(_lines(), s["from"] + 1, s["length"]), "\n"))
    cut = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    total = F.coalesce("__lines", F.size(_lines()), F.lit(0))
    return joined.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(total).cast("long"),
            "n_removed": F.coalesce("__removed", F.lit(0)).cast("long"),
            "text": cut,
        }
    ).drop("__id", "__twin", "__lines", "__removed", "__spans")


def without_repeats(docs: DataFrame, width: int = 3) -> DataFrame:
    """The columns of ``docs`` with ``text`` cut and ``n_chars`` recounted where it was; documents left blank by that go."""
    names = docs.columns
    marked = line_dedup(docs.withColumns({f"__{c}": F.col(c) for c in ("n_lines", "n_removed") if c in names}), width)
    cut = F.col("n_removed") > 0
    marked = marked.filter(~cut | F.col("text").rlike("[^ \\t\\r\\n]"))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        marked = marked.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return marked.select(*(F.col(f"__{c}").alias(c) if c in ("n_lines", "n_removed") else c for c in names))


SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, ls, unnest(range(1, greatest(len(ls) - 2, 1) + 1)) AS i FROM l),
w AS (SELECT doc_id, i, len(ls) AS n, array_to_string(ls[i:i + 2], chr(10)) AS k FROM s),
r AS (SELECT doc_id, i, n, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS occurrence
      FROM w WHERE regexp_matches(k, '[^ \\t\\r\\n]')),
c AS (SELECT DISTINCT doc_id, unnest(range(i, least(i + 2, n) + 1)) AS p FROM r WHERE occurrence > 1),
a AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM l),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS kept
      FROM a ANTI JOIN c USING (doc_id, p) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(l.ls), 0)::BIGINT AS n_lines, coalesce(m.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN k USING (doc_id)
"""
