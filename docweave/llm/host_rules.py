"""Quality rules judged by host: failures are counted per host, shrunken, and held against its documents.

Each document is measured once and tested against RULES. A host's share of failures under a rule is
noisy where the host is small, so it is drawn to the mean of all hosts by an empirical beta prior:
its mean and strength come from the hosts themselves (moments of the beta-binomial), and the
shrunken rate is ``(failures + mean * strength) / (documents + strength)``. Hosts are rejected
whole, or watched under a rule, by that rate, and the verdicts go back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docweave.llm.tables import bounded_batches, join_by_size, stored

#: A host whose shrunken rate under any rule is above REJECT loses all documents; one above WATCH
#: loses those that fail that rule themselves.
REJECT, WATCH = 0.5, 0.05

#: Bounds of the correlation of failures within a host: strengths of the prior from 1 to 9999 documents.
LEAST_CORRELATION, MOST_CORRELATION = 1e-4, 0.5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_filled_lines"]

#: Conditions on the measures; the first two are the base rules.
RULES = {
    "short": "n_words < 50",
    "repeated": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "same_lines": "100 * n_dup_lines > 30 * n_filled_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
BASE = ("short", "repeated")


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, each word once."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    _, pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)
    _, at, counts = np.unique(pairs[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True)
    again = counts[at] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : len(words) - 2 + k] |= again
    return int(inside.sum())


def _measure(text: bytes | None, n_chars: int | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()  # of bytes: splits at 0x20 and 0x09 to 0x0D only
    filled = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        n_chars - (len(text) - len(text.translate(None, b" \t\n\v\f\r"))),
        len(text) - len(text.translate(None, b"#*$%&|<>")),
        len(filled) - len(set(filled)),
        repeated_words(words),
        len(filled),
    )


def measured(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` of ``docs`` (all, if not given) and MEASURES of ``text`` in place of any such columns; null counts as empty.

    ``n_words``: runs of anything but 0x20 and 0x09 to 0x0D. ``word_chars``: code points in them. ``n_symbols``:
    characters of ``#*$%&|<>``. ``n_filled_lines``: lines, ended by ``\\n``, that hold a word; ``n_dup_lines``: those of them
    that equal an earlier line. ``n_repeat_words``: words in three-word windows that occur twice or more.
    """
    bounded_batches(docs.sparkSession)
    kept = [c for c in columns or docs.columns if c.lower() not in MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lengths = pc.utf8_length(texts).to_pylist()
            found = [_measure(t.as_py(), n) for t, n in zip(texts.cast(pa.binary()), lengths)]
            columns = np.array(found, np.int64).reshape(-1, len(MEASURES)).T
            yield pa.record_batch([*batch.columns[:-1], *(pa.array(c) for c in columns)], names=[*kept, *MEASURES])

    schema = StructType([*docs.select(*kept).schema, *(StructField(c, LongType()) for c in MEASURES)])
    rows = docs.select(*kept, docs["text"].alias("text"))
    return rows.toDF(*(f"c{i}" for i in range(len(kept) + 1))).mapInArrow(run, schema)


def fails(rule: str) -> Column:
    return F.expr(RULES[rule])


def beta_prior(hosts: int, rows: float, squares: float, failures: float, spread: float) -> tuple[float, float]:
    """Mean and strength (alpha + beta) of the prior of failure rates.

    ``squares`` is the sum of the hosts' squared numbers of documents, ``spread`` that of failures² over documents.
    Under a beta-binomial with mean ``m`` and correlation ``r`` within hosts, the weighted variation of the
    rates is ``m (1 - m) ((hosts - 1) + r (rows - hosts - squares / rows + 1))`` on average, which gives ``r``.
    """
    mean = failures / rows if rows else 0.0
    free = rows - hosts - squares / rows + 1 if rows else 0.0
    correlation = MOST_CORRELATION
    if free > 0 and 0 < mean < 1:
        correlation = ((spread - failures * mean) / (mean * (1 - mean)) - (hosts - 1)) / free
    return mean, 1 / min(max(correlation, LEAST_CORRELATION), MOST_CORRELATION) - 1


def host_verdicts(documents: DataFrame, host: str = "host") -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """One row per host, and the prior of each rule; ``documents`` have MEASURES.

    ``n_documents``, per rule ``fail_<rule>`` (count) and ``rate_<rule>`` (shrunken), ``rejected``, and per rule ``watched_<rule>``.
    Counts are summed before they are shuffled, so a large host is no large group. Null is no host.
    """
    counts = stored(
        documents.filter(F.col(host).isNotNull()).groupBy(host)
        .agg(F.count(F.lit(1)).alias("n_documents"), *(F.count_if(fails(r)).alias(f"fail_{r}") for r in RULES))
    )
    n = F.col("n_documents").cast("double")
    total = counts.agg(
        F.count(F.lit(1)).alias("hosts"), F.coalesce(F.sum(n), F.lit(0.0)).alias("rows"),
        F.coalesce(F.sum(n * n), F.lit(0.0)).alias("squares"),
        *(F.coalesce(F.sum(F.col(f"fail_{r}").cast("double")), F.lit(0.0)).alias(f"k_{r}") for r in RULES),
        *(F.coalesce(F.sum(F.col(f"fail_{r}") / n * F.col(f"fail_{r}")), F.lit(0.0)).alias(f"s_{r}") for r in RULES),
    ).first()
    priors = {r: beta_prior(total.hosts, total.rows, total.squares, total[f"k_{r}"], total[f"s_{r}"]) for r in RULES}
    return _judged(counts, priors), priors


def _judged(counts: DataFrame, priors: dict[str, tuple[float, float]]) -> DataFrame:
    rates = {f"rate_{r}": (F.col(f"fail_{r}") + m * s) / (F.col("n_documents") + s) for r, (m, s) in priors.items()}
    return counts.withColumns(rates).withColumns(
        {
            "rejected": F.greatest(*rates) > REJECT,
            **{f"watched_{r}": F.col(f"rate_{r}") > WATCH for r in RULES},
        }
    )


def judged(docs: DataFrame, host: str, columns: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: its ``columns`` (all of them, if not given), MEASURES, ``base_failed`` and ``kept``.

    A document is kept if it passes the base rules, its host is not rejected, and it fails no rule under
    which its host is watched. A document without a host is judged by the prior's means, as one of an
    unseen host. ``docs`` need ``text`` and the column ``host``; columns named like the results give way to
    them. Repeated rows and ids count as often as they occur; no rows give no rows. Measures are stored
    once with the ``columns``, so ask for few of them if the texts are not wanted back.
    """
    made = {*MEASURES, "base_failed", "kept"}
    wanted = [c for c in columns or docs.columns if c.lower() not in made]
    carried = {f"__c{i}": c for i, c in enumerate(wanted)}
    inner = docs.select(*(F.col(c).alias(k) for k, c in carried.items()), F.col(host).alias("__host"), "text")
    rows = stored(measured(inner, [*carried, "__host"]))
    hosts, priors = host_verdicts(rows, "__host")
    flags = ["rejected", *(f"watched_{r}" for r in RULES)]
    verdicts = stored(hosts.select("__host", "n_documents", *flags))

    no_host = rows.filter(F.col("__host").isNull()).withColumns(
        {
            "rejected": F.lit(any(m > REJECT for m, _ in priors.values())),
            **{f"watched_{r}": F.lit(m > WATCH) for r, (m, _) in priors.items()},
        }
    )
    known = join_by_size(rows.filter(F.col("__host").isNotNull()), verdicts, ["__host"], "n_documents")
    both = known.select(*no_host.columns).unionByName(no_host)
    base = reduce(or_, (fails(r) for r in BASE))
    held = reduce(or_, (F.col(f"watched_{r}") & fails(r) for r in RULES))
    return both.select(
        *(F.col(k).alias(c) for k, c in carried.items()), *MEASURES,
        base.alias("base_failed"), (~base & ~F.col("rejected") & ~held).alias("kept"),
    )


def kept_documents(docs: DataFrame, host: str) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with their columns."""
    names = {f"__k{i}": c for i, c in enumerate(docs.columns)}
    carried = docs.select("text", F.col(host).alias("__h"), *(F.col(c).alias(k) for k, c in names.items()))
    rows = judged(carried, "__h", [*names]).filter("kept")
    return rows.select(*(F.col(k).alias(c) for k, c in names.items()))


def host_of(url: str) -> Column:
    """The host of a URL column, in lower case and without port; null if there is none."""
    found = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


_SQL_COUNTS = ", ".join(f"count(*) FILTER ({rule}) AS fail_{name}" for name, rule in RULES.items())
_SQL_PRIOR = """
    SELECT hosts, m_{r}, 1 / least(greatest(CASE WHEN free > 0 AND m_{r} > 0 AND m_{r} < 1
        THEN ((s_{r} - k_{r} * m_{r}) / (m_{r} * (1 - m_{r})) - (hosts - 1)) / free ELSE {most} END, {least}), {most}) - 1 AS s
    FROM totals"""

SQL = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, row_number() OVER () AS k, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
g AS (SELECT k, i, ws[i:i + 2] AS gram FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
a AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS c FROM g) WHERE c > 1),
p AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM a) GROUP BY k),
m AS (SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_filled_lines
      FROM w LEFT JOIN p USING (k)),
hosts AS (SELECT source, count(*) AS n, {_SQL_COUNTS} FROM m WHERE source IS NOT NULL GROUP BY source),
totals AS (SELECT count(*) AS hosts, sum(n)::DOUBLE - count(*) - sum(n::DOUBLE * n) / sum(n) + 1 AS free,
  {", ".join(f"sum(fail_{r})::DOUBLE AS k_{r}, sum(fail_{r} / n::DOUBLE * fail_{r}) AS s_{r}, sum(fail_{r}) / sum(n)::DOUBLE AS m_{r}" for r in RULES)}
  FROM hosts),
{", ".join(f"prior_{r} AS ({_SQL_PRIOR.format(r=r, least=LEAST_CORRELATION, most=MOST_CORRELATION)})" for r in RULES)},
rates AS (SELECT source, {", ".join(f"(fail_{r} + prior_{r}.m_{r} * prior_{r}.s) / (n + prior_{r}.s) AS rate_{r}" for r in RULES)}
  FROM hosts, {", ".join(f"prior_{r}" for r in RULES)}
  UNION ALL SELECT NULL, {", ".join(f"m_{r}" for r in RULES)} FROM totals)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({" OR ".join(RULES[r] for r in BASE)}) AS base_failed,
  NOT ({" OR ".join(f"({RULES[r]})" for r in BASE)}) AND greatest({", ".join(f"rate_{r}" for r in RULES)}) <= {REJECT}
  AND NOT ({" OR ".join(f"(rate_{r} > {WATCH} AND ({RULES[r]}))" for r in RULES)}) AS kept
FROM m JOIN rates ON m.source IS NOT DISTINCT FROM rates.source
"""
