"""Removes byte strings that occur earlier, by a run-length compressed suffix index.

*Where repeats can be.* Of the hashes of all ``GRAM``-byte strings in each ``length``-byte window the
smallest is chosen; so equal windows choose alike, and a repeated window holds an *anchor* that
occurs elsewhere too. A repeat is then a matter of the anchor's *context*, the bytes that the
windows around it reach. Equal contexts of an anchor are pre-aggregated: all but the first
are repeats as a whole. What is left, anchors with contexts that differ, is indexed.

*The index.* The contexts of some anchors are joined to a text. Its Burrows-Wheeler transform is kept as
runs with the suffix array sampled at the run heads: for each the text position, the position of the suffix
before it in the array, and the length of their match. Between two samples along the
text both positions go up in step while the match gets shorter by one, so matching statistics of
the text against itself stream from the runs alone. Matches of ``length`` chain the positions of one
string together, and all but the earliest are marked.

Anchors travel by hash, contexts only where they differ, texts once, to be cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.filters import bitmap, let_through
from docweave.llm.tables import bounded_batches, doc_id, identity, stored
from docweave.llm.words import mixed, randoms, text_buffer

GRAM = 32
#: Anchors that a task pre-aggregates at once.
BLOCK_ANCHORS = 1 << 19
#: Bytes of contexts that an index is built over, about: few enough for a processor's cache.
INDEX_BYTES = 1 << 18
#: Contexts of one key are indexed up to this many bytes together, beyond that compared by a shuffle.
LARGEST_BYTES = 1 << 21
#: Bytes of a text that are scanned at once.
_SLICE = 1 << 20

_U = np.uint64


class Documents:
    """The anchors of some documents, only those that the filter ``bits`` lets through if there is one; ``count`` counts all."""

    def __init__(self, length: int, bits: np.ndarray | None = None):
        self.length, self.margin, self.bits = length, length - GRAM, bits
        self.parts: list[np.ndarray] = []
        self.size = self.count = 0
        self.columns: list[list[np.ndarray]] = [[] for _ in range(6)]

    def add(self, number: int, twin: int, data: np.ndarray) -> None:
        n = len(data)
        if n < self.length:
            return
        padded = np.zeros(n + self.length + self.margin + 8, np.uint8)
        padded[self.margin : self.margin + n] = data
        words = np.ndarray(len(padded) - 7, np.dtype("<u8"), padded, 0, (1,))
        for at in range(0, n - GRAM + 1, _SLICE):
            to = min(at + _SLICE, n - GRAM + 1)
            place, gram = _anchors(words[self.margin :], at, to, n - GRAM + 1, self.margin + 1)
            self.count += len(place)
            if self.bits is not None:
                kept = let_through(self.bits, gram.view(np.int64))
                place, gram = place[kept], gram[kept]
            right = np.minimum(self.length, n - place)
            context = self._contexts(words, place, right)
            columns = (gram, context, np.full(len(place), number), np.full(len(place), twin), place.astype(np.int64), right.astype(np.int32))
            for held, column in zip(self.columns, columns, strict=True):
                held.append(column)

    def _contexts(self, words: np.ndarray, place: np.ndarray, right: np.ndarray) -> np.ndarray:
        """A hash of the bytes around each place: ``margin`` before it, ``length`` from it on, zeros beyond the ends."""
        factor = randoms(2, seed=3)
        ends = np.minimum(self.margin, place).astype(_U) * factor[0] + right.astype(_U) * factor[1]
        return mixed(ends + _strings(words, place, self.margin + self.length))

    def classes(self) -> tuple[list[np.ndarray], np.ndarray]:
        """All anchors in the order of gram, context and place, and which are the first of their context."""
        if not any(map(len, self.columns[0])):
            return [np.zeros(0, np.int64)] * 6, np.zeros(0, bool)
        columns = [np.concatenate(c) for c in self.columns]
        order = np.lexsort((columns[4], columns[3], columns[2], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        first = np.append(True, (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]))
        return columns, first


def _strings(words: np.ndarray, place: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """Hashes of the ``size`` bytes from each place; ``words`` has 8 bytes from each."""
    at = np.array([*range(0, size - 7, 8), size - 8])
    factor = randoms(len(at), seed)
    out = np.empty(len(place), _U)
    for k in range(0, len(place), 1 << 14):
        some = slice(k, k + (1 << 14))
        out[some] = (mixed(words[place[some, None] + at] ^ factor) * factor).sum(axis=1)
    return out


def _gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the GRAM bytes from each of the first ``n`` places; ``words`` has 8 bytes from each."""
    a, b = randoms(2, seed=4)
    two = mixed(words[: n + 16]) * a + words[8 : n + 24] * b
    two ^= two >> _U(31)
    return mixed(two[:n] * a + two[16 : n + 16] * b)


def _slide(values: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` (minimum or maximum) over each run of ``width`` values."""
    reach = 1
    while 2 * reach <= width:
        values = f(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return f(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(words: np.ndarray, start: int, end: int, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from ``start`` to ``end`` whose gram is the smallest of some ``width`` neighbours, and the grams; ``n`` grams in all."""
    low, high = max(0, start - width + 1), min(n, end + width - 1)
    hashes = _gram_hashes(words[low:], high - low)
    least = _slide(hashes, width, np.minimum)
    never = np.zeros(width - 1, _U)
    most = _slide(np.concatenate([never, least, never]), width, np.maximum)
    here = slice(start - low, end - low)
    place = np.flatnonzero(hashes[here] == most[here])
    return place + start, hashes[here][place]


def _spans(number: np.ndarray, twin: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Ranges of bytes by document, those that overlap or touch merged."""
    order = np.lexsort((low, twin, number))
    number, twin, low, high = (x[order] for x in (number, twin, low, high))
    if len(low):
        new = np.append(True, (number[1:] != number[:-1]) | (twin[1:] != twin[:-1]))
        # The furthest end so far, starting anew with each document.
        group = np.cumsum(new) - 1
        reach = np.maximum.accumulate(high + group * (high.max() + 1)) - group * (high.max() + 1)
        new[1:] |= low[1:] > reach[:-1]
        first = np.flatnonzero(new)
        number, twin, low, high = number[first], twin[first], low[first], np.maximum.reduceat(high, first)
    return pa.record_batch(
        [pa.array(number, pa.int64()), pa.array(twin, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["id", "twin", "low", "high"]
    )


def _blocks(batches: Iterator[pa.RecordBatch], length: int, bits: np.ndarray | None = None) -> Iterator[tuple[Documents, dict]]:
    """Documents of a task, some at a time, and their bytes."""
    held, texts = Documents(length, bits), {}
    for batch in batches:
        ids, twins = (batch.column(c).to_numpy() for c in ("id", "twin"))
        data, offsets = text_buffer(batch.column("text"))
        for k in range(batch.num_rows):
            key = (int(ids[k]), int(twins[k]))
            if key in texts:  # a repeated row is the same document
                continue
            part = data[offsets[k] : offsets[k + 1]]
            texts[key] = part
            held.add(*key, part)
            if held.count >= BLOCK_ANCHORS:
                yield held, texts
                held, texts = Documents(length, bits), {}
    if held.count:
        yield held, texts


_CLASSES = "gram long, context long, id long, twin long, place long, right int, low long, high long"


def _scan(length: int):
    """A row per context that is new in its block, and spans of contexts that aren't (``gram`` null)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, _ in _blocks(batches, length):
            (gram, context, number, twin, place, right), first = held.classes()
            n = int(first.sum())
            none = pa.nulls(n, pa.int64())
            yield pa.record_batch(
                [pa.array(gram[first].view(np.int64)), pa.array(context[first].view(np.int64)), pa.array(number[first]), pa.array(twin[first]), pa.array(place[first]), pa.array(right[first]), none, none],
                names=[c.split()[0] for c in _CLASSES.split(", ")],
            )
            again = ~first
            spans = _spans(number[again], twin[again], np.maximum(place[again] - held.margin, 0), place[again] + right[again])
            yield _as_classes(spans)

    return scan


def _as_classes(spans: pa.RecordBatch) -> pa.RecordBatch:
    long, short = pa.nulls(spans.num_rows, pa.int64()), pa.nulls(spans.num_rows, pa.int32())
    return pa.record_batch([long, long, spans.column("id"), spans.column("twin"), long, short, spans.column("low"), spans.column("high")], names=[c.split()[0] for c in _CLASSES.split(", ")])


def _settle(length: int):
    """Of context rows sorted by gram, context and place: spans of all but the first of each, and grams with several (``low`` null)."""
    margin = length - GRAM

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = None, None  # the last row, whether it repeats its context, and the last gram that was told
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in range(6)]
            gram, context, number, twin, place, right = columns
            previous = [np.append(c[:1] if last is None else last[k], c[:-1]) for k, c in enumerate(columns[:5])]
            same = [c == b for c, b in zip(columns, previous, strict=False)]
            if last is None:
                same[0][0] = False
            same_class = same[0] & same[1]
            # A repeated row is the same place again, not a later one.
            moved = ~(same[2] & same[3] & same[4])
            start = np.flatnonzero(~same_class)
            moves = np.cumsum(moved & same_class)
            base = np.zeros(len(gram), np.int64)
            base[start] = moves[start]
            again = moves - np.maximum.accumulate(base) > 0
            if same_class[0] and last is not None and last[5]:
                again[: start[0] if len(start) else None] = True
            mixed_grams = np.unique(gram[same[0] & ~same[1]])
            if told is not None:
                mixed_grams = mixed_grams[mixed_grams != told]
            last = (*(c[-1] for c in columns[:5]), bool(again[-1]))
            if len(mixed_grams):
                told = mixed_grams[-1]
            yield _as_classes(_spans(number[again], twin[again], np.maximum(place[again] - margin, 0), place[again] + right[again]))
            n = len(mixed_grams)
            none, short = pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())
            yield pa.record_batch([pa.array(mixed_grams), none, none, none, none, short, none, none], names=[c.split()[0] for c in _CLASSES.split(", ")])

    return settle


_CONTEXTS = "gram long, id long, twin long, low long, high long, content binary"


def _contexts(length: int, shared):
    """Two sides of each context whose anchor the filter lets through, each once in a block, and spans of the others (``gram`` null).

    A string around an anchor holds the gram and, of what is left, at least half before it or at least half after
    it. So a context falls into two sides, each keyed by the hash of a longer string that all of
    its own share, and many contexts that differ have one side in common.
    """
    margin = length - GRAM
    half = margin // 2

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for held, texts in _blocks(batches, length, bits):
            columns, first = held.classes()
            _, _, number, twin, place, right = (c[first] for c in columns)
            sides: dict[tuple[int, bytes], tuple[int, int, int]] = {}
            again = []
            # Anchors come by gram and context; sides are to be met in the order of documents.
            order = np.lexsort((place, twin, number))
            shown_of, text = None, b""
            for i, t, p, r in zip(*(c[order].tolist() for c in (number, twin, place, right)), strict=True):
                if (i, t) != shown_of:
                    shown_of, text = (i, t), texts[i, t].tobytes()
                # Strings that start at p - half or before, and those that start after that.
                for side, common, low, high in (
                    (b"<", p - half, max(0, p - margin), p - half + length),
                    (b">", p, max(0, p - half + 1), p + r),
                ):
                    high = min(high, p + r)
                    if common < 0 or common + GRAM + half > len(text) or high - low < length:
                        continue
                    shown = text[common : common + GRAM + half]
                    key = int.from_bytes(hashlib.blake2b(side + shown, digest_size=8).digest(), "little", signed=True)
                    content = text[low:high]
                    first_place = sides.setdefault((key, content), (i, t, low))
                    if first_place != (i, t, low):
                        again.append((i, t, low, high))
            spans = _spans(*(np.array([x[j] for x in again], np.int64) for j in range(4)))
            yield pa.record_batch(
                [pa.nulls(spans.num_rows, pa.int64()), *spans.columns, pa.nulls(spans.num_rows, pa.binary())], names=[c.split()[0] for c in _CONTEXTS.split(", ")]
            )
            rows = list(sides.items())
            for at in range(0, len(rows), 1 << 15):
                some = rows[at : at + (1 << 15)]
                yield pa.record_batch(
                    [
                        pa.array([k for (k, _), _ in some], pa.int64()),
                        *(pa.array([w[j] for _, w in some], pa.int64()) for j in range(3)),
                        pa.nulls(len(some), pa.int64()), pa.array([c for (_, c), _ in some], pa.binary()),
                    ],
                    names=[c.split()[0] for c in _CONTEXTS.split(", ")],
                )

    return contexts


def suffix_array(text: np.ndarray, ends: np.ndarray, least: int = 0) -> np.ndarray:
    """The suffixes of a text of small numbers in order, of those with at least ``least`` letters before their separator.

    ``ends`` are the places of its separators, 0 in ``text``: each of them is a letter of its own, smaller than all
    others and than the separators after it, so no comparison goes beyond one.
    """
    n = len(text)
    place = np.arange(n)
    until = np.repeat(ends, np.diff(np.append(-1, ends))) - place  # letters before the separator
    # As many letters as go into a number, by their places among the letters that occur.
    known = np.zeros(int(text.max()) + 1, bool)
    known[text] = True
    code = (np.cumsum(known) - 1)[text]
    bits = max(int(known.sum() - 1).bit_length(), 1)
    reach, key = 1, code
    while 2 * reach * bits <= 63:
        after = np.append(key[reach:], np.zeros(min(reach, n), np.int64))
        after[until < reach] = 0
        key = key << reach * bits | after
        reach *= 2
    order = np.argsort(key)
    rank = np.empty(n, np.int64)  # of a suffix: where those begin that are equal as far as they are known
    # What is sorted in a round: suffixes equal to another so far, by where they stand in the order.
    slot, some, key = place, order, key[order]
    while True:
        new = np.append(True, key[1:] != key[:-1])
        start = np.flatnonzero(new)
        rank[some] = np.repeat(slot[start], np.diff(np.append(start, len(some))))
        # Suffixes that end within reach differ by their separators alone, which come in text order.
        tied = ~(new & np.append(new[1:], True))
        done = tied & (until[some] < reach)
        if done.any():
            which = np.flatnonzero(done)
            ended = some[which]
            ended = ended[np.argsort(rank[ended] * (n + 1) + ended)]
            some[which] = ended
            order[slot[which]] = ended
            rank[ended] = slot[which]
        left = tied & ~done
        slot, some = slot[left], some[left]
        if not len(some) or 4 * reach >= least > reach:
            break
        key = rank[some] * (n + 1) + rank[some + reach] + 1
        by = np.argsort(key)
        some, key = some[by], key[by]
        order[slot] = some
        reach *= 2
    # The others go on alone, by the ranks of what follows: as many letters again in each round.
    long = until[some] >= least
    slot, some = slot[long], some[long]
    group, at = rank[some], reach
    while len(some):
        key = group * (n + 1) + rank[some + at] + 1
        by = np.argsort(key)
        some, key = some[by], key[by]
        order[slot] = some
        at += reach
        new = np.append(True, key[1:] != key[:-1])
        start = np.flatnonzero(new)
        group = np.repeat(slot[start], np.diff(np.append(start, len(some))))
        left = ~(new & np.append(new[1:], True))
        slot, some, group = slot[left], some[left], group[left]
    return order[until[order] >= least] if least else order


class RunIndex:
    """The runs of a text's Burrows-Wheeler transform, with samples at their heads in text order.

    Only suffixes with ``least`` letters before their separator take part, and only matches of that length count. If
    a shorter suffix lies between two of the order, it ends within their match, which is too short to count then.
    """

    def __init__(self, text: np.ndarray, ends: np.ndarray, least: int = 0):
        order = suffix_array(text, ends, least)
        letter = text[order - 1]
        # Separators are letters of their own, so each is a run.
        head = np.append(True, (letter[1:] != letter[:-1]) | (letter[1:] == 0))
        at = np.flatnonzero(head)
        self.size = len(text)
        sample, before = order[at], np.append(-1, order[:-1])[at]
        by_place = np.argsort(sample)
        self.sample, self.before = sample[by_place], before[by_place]
        if not len(at) or self.sample[0]:  # what comes before all of them matches nothing
            self.sample, self.before = np.append(0, self.sample), np.append(-1, self.before)
        self.match = self._matches(text, ends)

    def _matches(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The length of the match of each sampled suffix with the one before it in order."""
        out = np.zeros(len(self.sample), np.int64)
        go = np.flatnonzero(self.before >= 0)
        while len(go):
            a, b = text[np.minimum(self.sample[go] + out[go], self.size - 1)], text[np.minimum(self.before[go] + out[go], self.size - 1)]
            go = go[(a == b) & (a != 0)]
            out[go] += 1
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the text: the place of the suffix before it in order, and the length of their match."""
        reach = np.diff(np.append(self.sample, self.size))
        step = np.arange(self.size) - np.repeat(self.sample, reach)
        return np.repeat(self.before, reach) + step, np.repeat(self.match, reach) - step


def _marks(rows: list[tuple[int, int, int, bytes]], length: int) -> pa.RecordBatch:
    """Spans of the bytes in these contexts (id, twin, first place, bytes) whose windows occur earlier."""
    sizes = np.array([len(r[3]) + 1 for r in rows])
    ends = np.cumsum(sizes) - 1
    letters = np.frombuffer(b"\0".join(r[3] for r in rows) + b"\0", np.uint8).astype(np.int16) + 1
    letters[ends] = 0
    before, match = RunIndex(letters, ends, length).statistics()
    place = np.arange(len(letters))
    again = match >= length
    root = np.where(again, before, place)
    while True:
        further = root[root]
        if (further == root).all():
            break
        root = further
    # Strings with more than one place, in the order of the documents.
    some = np.flatnonzero(again)
    some = np.unique(np.concatenate([some, root[some]]))
    number = np.array([r[0] for r in rows], np.int64)
    twin = np.array([r[1] for r in rows], np.int64)
    _, document = np.unique(np.stack([number, twin], axis=1), axis=0, return_inverse=True)
    row = np.searchsorted(ends, some)
    offset = np.array([r[2] for r in rows], np.int64)[row] + some - (ends - sizes + 1)[row]
    order = np.lexsort((offset, document.reshape(-1)[row], root[some]))
    some, row, offset, document = some[order], row[order], offset[order], document.reshape(-1)[row][order]
    first = np.flatnonzero(np.append(True, root[some][1:] != root[some][:-1])) if len(some) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(some))))
    # One place may show in contexts of two anchors: it is no earlier than itself.
    later = (document != document[first][group]) | (offset != offset[first][group])
    return _spans(number[row[later]], twin[row[later]], offset[later], offset[later] + length)


_MARKS = "id long, twin long, low long, high long, hash_a long, hash_b long"


def _windows(number: int, twin: int, low: int, content: bytes, length: int) -> pa.RecordBatch:
    """The ``length``-byte strings of a context by place, as 128 bits of hash."""
    n = len(content) - length + 1
    words = np.ndarray(len(content) - 7, np.dtype("<u8"), np.frombuffer(content, np.uint8), 0, (1,))
    hashes = [mixed(_strings(words, np.arange(n), length, seed)).view(np.int64) for seed in (5, 6)]
    place = low + np.arange(n)
    return pa.record_batch(
        [pa.array(np.full(n, number)), pa.array(np.full(n, twin)), pa.array(place), pa.array(place + length), *map(pa.array, hashes)],
        names=[c.split()[0] for c in _MARKS.split(", ")],
    )


def _index(length: int):
    """Marks of context sides sorted by key and content; an index takes the sides of as many keys as it has room for.

    Of equal sides the first stands for all, the others are repeats. The sides of one key that alone
    are more than an index has room for are not held: their strings go on by hash, to be
    compared by a shuffle.
    """
    names = [c.split()[0] for c in _MARKS.split(", ")]

    def with_hashes(spans: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(spans.num_rows, pa.int64())
        return pa.record_batch([*spans.columns, none, none], names=names)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0
        group, gram, weight, last = [], None, 0, None
        for batch in batches:
            told = batch.filter(batch.column("gram").is_null())
            yield with_hashes(told.select(["id", "twin", "low", "high"]))
            batch = batch.filter(batch.column("gram").is_valid())
            again = []
            columns = [*(batch.column(c).to_numpy().tolist() for c in ("gram", "id", "twin", "low")), batch.column("content").to_pylist()]
            for g, i, t, low, content in zip(*columns, strict=True):
                if g != gram:
                    if len(group) > 1:
                        ready += group
                        size += weight
                    group, gram, weight, last = [], g, 0, None
                    if size >= INDEX_BYTES:
                        yield with_hashes(_marks(ready, length))
                        ready, size = [], 0
                if last is not None and content == last[3]:
                    if (i, t, low) != last[:3]:
                        again.append((i, t, low, low + len(content)))
                    continue
                last = (i, t, low, content)
                weight += len(content)
                group.append(last)
                if weight > LARGEST_BYTES:
                    for other in group:
                        yield _windows(*other, length)
                    group = []
            yield with_hashes(_spans(*(np.array([x[j] for x in again], np.int64) for j in range(4))))
        if len(group) > 1:
            ready += group
        if ready:
            yield with_hashes(_marks(ready, length))

    return index


def repeated_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """``id``, ``twin``, ``low``, ``high``: byte ranges whose ``length``-byte strings also start earlier.

    Every such byte is in some range; ranges of a document may overlap. ``length`` is above ``GRAM``.
    """
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    spark = bounded_batches(docs.sparkSession)
    texts = docs.select(*identity(), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scanned = texts.mapInArrow(_scan(length), _CLASSES)
    # Spans found in a block go along under a gram of their own, spread by document.
    key = F.coalesce("gram", F.xxhash64("id", "twin", "low"))
    settled = stored(
        scanned.withColumn("gram_or", key).repartition(parts, "gram_or").drop("gram_or")
        .sortWithinPartitions("gram", "context", "id", "twin", "place").mapInArrow(_settle_or_pass(length), _CLASSES)
    )
    several = settled.filter("low IS NULL").select(F.col("gram").alias("key"))
    shared = spark.sparkContext.broadcast(bitmap(several).tobytes())
    contexts = texts.mapInArrow(_contexts(length, shared), _CONTEXTS)
    marks = stored(
        contexts.repartition(parts, F.coalesce("gram", F.xxhash64("id", "twin", "low")))
        .sortWithinPartitions("gram", "content", "id", "twin", "low").mapInArrow(_index(length), _MARKS)
    )
    strings, place, hashes = marks.filter("hash_a IS NOT NULL"), F.struct("id", "twin", "low"), ["hash_a", "hash_b"]
    first = strings.groupBy(*hashes).agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last").drop("last")
    later = strings.join(first, hashes).filter(place != F.col("first"))
    found = (settled.filter("low IS NOT NULL"), marks.filter("hash_a IS NULL"), later)
    spans = [x.select("id", "twin", "low", "high") for x in found]
    return spans[0].unionByName(spans[1]).unionByName(spans[2])


def _settle_or_pass(length: int):
    settle = _settle(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = []

        def classes():
            for batch in batches:
                span = batch.column("gram").is_null()
                passed.append(batch.filter(span))
                yield batch.filter(pc.invert(span))

        for out in settle(classes()):
            while passed:
                yield passed.pop()
            yield out
        yield from passed

    return run


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the bytes that stay, ``kept``.

    Each text counts as its UTF-8 bytes, null as none. A byte goes if some ``length`` bytes around it also start earlier: in a
    document of a smaller id, or in the same one further up; overlaps count. Rows that repeat an id and text are
    one document; other texts under one id are ordered by the texts' hashes; null ids come last. ``kept`` need not be
    valid UTF-8. Texts shorter than ``length`` stay whole. No rows give no rows.
    """
    spans = repeated_spans(docs, length).groupBy("id", "twin").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    texts = docs.select(*identity(), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                data, offsets = text_buffer(rows.column("text"))
                kept, removed, runs = [], [], []
                for k in range(rows.num_rows):
                    text = data[offsets[k] : offsets[k + 1]]
                    spans = rows.column("spans")[k]
                    gone = spans.values if spans.is_valid else None
                    if gone is None:
                        kept.append(text.tobytes()), removed.append(0), runs.append(0)
                        continue
                    change = np.zeros(len(text) + 1, np.int32)
                    np.add.at(change, gone.field("low").to_numpy(), 1)
                    np.add.at(change, gone.field("high").to_numpy(), -1)
                    inside = np.cumsum(change[:-1]) > 0
                    kept.append(text[~inside].tobytes())
                    removed.append(int(inside.sum()))
                    runs.append(int((inside[1:] & ~inside[:-1]).sum()) + int(inside[:1].sum()))
                yield pa.record_batch(
                    [rows.column("id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    done = texts.join(spans, ["id", "twin"], "left").mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(doc_id(), "n_bytes", "n_removed", "n_spans", "kept")
