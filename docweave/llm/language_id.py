"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams of one to three letters, most
frequent first, a word having one blank at either end. A document's own list is compared
with each profile: each of its n-grams counts how far its rank is from the rank in the profile,
at most the profile's length, which is also what an n-gram counts that isn't there. The smallest
sum of these out-of-place distances names the language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.tables import bounded_batches


#: N-grams of a profile, and of a document's own list.
PROFILE = 300
#: Labelled documents from which a profile is learnt, about: a language with more is sampled by a hash of the id.
LEARN_DOCUMENTS = 20_000
#: More languages than this are refused: their profiles are broadcast.
MAX_LANGUAGES = 2_000
UNDETERMINED = "und"

_U = np.uint64
#: Characters that are taken at once when n-grams are counted.
_CHUNK = 1 << 20


def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _grams(text: str, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text as numbers, ascending, and how often each occurs."""
    values, counts = np.zeros(0, _U), np.zeros(0, np.int64)
    tail = np.zeros(1, _U)  # the blank before the first word, then what earlier characters leave
    for at in range(0, len(text), _CHUNK):
        code = np.frombuffer(text[at : at + _CHUNK].lower().encode("utf-32-le", "replace"), np.uint32)
        code = np.where(is_letter[code], code, 0).astype(_U)
        code = np.concatenate([tail, code, np.zeros(1 if at + _CHUNK >= len(text) else 0, _U)])
        new = len(tail)
        # A run of other characters is one blank.
        stay = (code != 0) | np.append(True, code[:-1] != 0)
        new = int(stay[:new].sum())
        code = code[stay]
        one = code[new:] if at else code
        one = one[one != 0]
        start = max(new - 1, 0) if at else 0
        two = code[start:-1] << _U(21) | code[start + 1 :]
        start = max(new - 2, 0) if at else 0
        a, b, c = code[start:-2], code[start + 1 : -1], code[start + 2 :]
        three = (a << _U(42) | b << _U(21) | c)[b != 0]
        mark = _U(1) << _U(63)
        found = np.sort(np.concatenate([one << _U(42) | mark, two | mark, three]))
        if len(found):
            first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
            found, times = found[first], np.diff(np.append(first, len(found)))
            if len(values):
                both = np.concatenate([values, found])
                values, where = np.unique(both, return_inverse=True)
                counts = np.bincount(where, np.concatenate([counts, times]), len(values)).astype(np.int64)
            else:
                values, counts = found, times
        tail = code[-2:]
    return values, counts


def _most(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, the smaller number first on ties."""
    if len(values) > PROFILE:
        least = -np.partition(-counts, PROFILE - 1)[PROFILE - 1]
        often = counts >= least
        values, counts = values[often], counts[often]
    return values[np.argsort(-counts, kind="stable")][:PROFILE]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    is_letter = letters()
    for batch in batches:
        totals: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            totals.setdefault(lang, []).append(_grams(text, is_letter))
        for lang, found in totals.items():
            values, where = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([c for _, c in found]), len(values)).astype(np.int64)
            yield pa.record_batch(
                [pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"],
            )


def learn_profiles(labelled: DataFrame, documents: int = LEARN_DOCUMENTS) -> dict[str, list[int]]:
    """The profile of each language in ``labelled`` (``doc_id``, ``text``, ``lang``).

    Rows without a text or language are left out. Of each language about ``documents`` rows are used, chosen by a
    hash of the id and text, or all if it has no more. Ties go to the smaller n-gram number.
    """
    spark = bounded_batches(labelled.sparkSession)
    usable = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    parts = [(r["lang"], int(documents / r["n"] * (1 << 32))) for r in sizes if r["n"] > documents]
    if parts:
        part = F.broadcast(spark.createDataFrame(parts, "lang string, part long"))
        usable = usable.select("doc_id", "text", "lang").join(part, "lang", "left")
        usable = usable.filter(F.col("part").isNull() | (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) < F.col("part")))
    counts = (
        usable.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ).persist()
    try:
        langs = [r[0] for r in counts.select("lang").distinct().collect()]
        return {
            lang: [r[0] for r in counts.filter(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(PROFILE).select("gram").collect()]
            for lang in sorted(langs)
        }
    finally:
        counts.unpersist()


class Profiles:
    """Ranks of n-grams by language, as one table."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        grams = sorted({g for p in profiles.values() for g in p})
        place = {g: i for i, g in enumerate(grams)}
        self.grams = np.array([*grams], np.int64).view(_U)
        order = np.argsort(self.grams)
        self.ranks = np.full((len(grams) + 1, len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            for rank, g in enumerate(profiles[lang]):
                self.ranks[place[g], k] = rank
        self.grams = self.grams[order]
        self.ranks[:-1] = self.ranks[:-1][order]
        self.is_letter = letters()

    def predict(self, text: str | None) -> tuple[str, float]:
        values, counts = _grams(text, self.is_letter) if text else (np.zeros(0, _U), None)
        if not self.langs or not len(values) or not (values >> _U(63)).any() or not _has_letter(values):
            return UNDETERMINED, 0.0
        own = _most(values, counts)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.langs[best], float(1 - apart[best] / (PROFILE * len(own)))


def _has_letter(values: np.ndarray) -> bool:
    mark = _U(1) << _U(63)
    return bool((values > mark | _U((1 << 42) - 1)).any())


def identify(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of any such columns, one row per row.

    ``score`` is 1 less the distance as a share of the largest possible one. A null text or one without
    a letter is ``und`` with score 0, as is any text if there are no profiles; of
    languages at the same distance the first by name is taken. Only the text counts.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    shared = bounded_batches(docs.sparkSession).sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Profiles(shared.value)
        for batch in batches:
            found = [table.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*kept, docs["text"].alias("__text")).mapInArrow(run, schema)


def held_out() -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is 2 modulo 4; a null id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def in_known_language(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """``docs`` without those whose language cannot be told (``und``); all columns.

    Those are null texts and texts without a letter, or all if there are no profiles: no distance is too large, so a
    text that shares no n-gram with any profile (score 0) stays.
    """
    shared = bounded_batches(docs.sparkSession).sparkContext.broadcast(profiles)

    # Only the texts cross to Python, and only a flag comes back.
    @F.arrow_udf("boolean")
    def is_known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = Profiles(shared.value)
        for texts in batches:
            yield pa.array([table.predict(t.as_py())[0] != UNDETERMINED for t in texts], pa.bool_())

    return docs.filter(is_known("text"))
