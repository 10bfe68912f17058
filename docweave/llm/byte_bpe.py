"""Byte-level BPE encoding and decoding with given ranks.

A text is split into pieces by a pattern. Within a piece, a segment tree over the byte
positions keeps, at each node, the smallest rank of a pair of neighbouring parts that starts
there, the leftmost on ties. The root names the next merge; a merge joins a part with its
live neighbour and updates the two or three pairs concerned, each along one path of the tree.
"""

from __future__ import annotations

import base64
import itertools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType

from docweave.llm.tables import bounded_batches

_NEVER = np.int64(1) << np.int64(62)
#: A single space between two characters that are no white space always begins a piece.
_BETWEEN = re.compile(r" (?<=\S )(?=\S)")
_ODD = re.compile(r" \s|\s ")
#: Words whose ids a task remembers, each of at most _LONGEST characters: the latest half of them at least.
_REMEMBERED, _LONGEST = 1 << 18, 48
#: Characters of a text that are taken at once, up to the next such space.
_AT_ONCE = 1 << 20
#: Pieces whose trees are worked on side by side; fewer than _FEW of a width are worked on one by one.
_SIDE_BY_SIDE, _FEW = 1 << 14, 24
#: A rank file above this size is refused: it is broadcast.
MAX_RANK_BYTES = 64 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its id."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Merges:
    """Which pairs of ids merge to which id; the id is the rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], _NEVER)
        self.made = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], 0)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, _NEVER if it doesn't merge."""
        pair = left << np.int64(32) | right
        at = np.searchsorted(self.keys, pair)
        return np.where(self.keys[at] == pair, self.made[at], _NEVER)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as 32-bit integers.

        A piece that is a token as a whole is that token. The others are grouped by the width of
        their tree, a power of two, and each step does one merge in every tree of a group.
        """
        out: list[bytes] = [b""] * len(pieces)
        widths: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            else:
                widths.setdefault(1 << (len(piece) - 1).bit_length(), []).append(k)
        for width, members in widths.items():
            if len(members) < _FEW:
                for k in members:
                    out[k] = self._tree(pieces[k], width)
                continue
            most = max(1, _SIDE_BY_SIDE * 16 // width)
            for at in range(0, len(members), most):
                some = members[at : at + most]
                for k, ids in zip(some, self._forest([pieces[k] for k in some], width), strict=True):
                    out[k] = ids
        return out

    def _tree(self, piece: bytes, width: int) -> bytes:
        """One tree, step by step on plain numbers: a step on few trees at once costs arrays more than it saves."""
        n, none, rank_of = len(piece), int(_NEVER), self.pairs.get
        ids = array("q", self.single[np.frombuffer(piece, np.uint8)].tobytes())
        following, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        tree = array("q", [none]) * (2 * width)
        for i in range(n - 1):
            rank = rank_of(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right

        def put(position: int, value: int) -> None:
            node = width + position
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    return  # so are all above
                tree[node] = value

        def renew(i: int) -> None:
            j = following[i]
            rank = rank_of(ids[i] << 32 | ids[j]) if j < n else None
            put(i, none if rank is None else rank * width + i)

        while tree[1] < none:
            i, rank = tree[1] & (width - 1), tree[1] // width
            j = following[i]
            ids[i], ids[j] = rank, -1
            following[i] = following[j]
            if following[j] < n:
                before[following[j]] = i
            put(j, none)
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        live = np.frombuffer(ids, np.int64)
        return live[live >= 0].astype("<i4").tobytes()

    def _forest(self, pieces: list[bytes], width: int) -> list[bytes]:
        m = len(pieces)
        length = np.array([len(p) for p in pieces])
        letters = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
        ids = np.append(self.single[letters], np.zeros((m, 1), np.int64), axis=1)
        place = np.arange(width + 1)
        ids[place >= length[:, None]] = -1
        following = np.tile(np.minimum(place + 1, width), (m, 1))
        before = np.tile(place - 1, (m, 1))
        # A node holds rank * width + position: its minimum is the leftmost pair of the smallest rank.
        tree = np.full((m, 2 * width), _NEVER, np.int64)
        flat = np.where(place[1:] < length[:, None], self.rank(ids[:, :-1], np.maximum(ids[:, 1:], 0)), _NEVER)
        tree[:, width:] = np.where(flat < _NEVER, flat * width + place[:-1], _NEVER)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2

        # One long array each: a tree's nodes begin at 2 * width times its number, its parts at width + 1 times that.
        tree, ids, following, before = tree.ravel(), ids.ravel(), following.ravel(), before.ravel()
        row = np.flatnonzero(tree[1 :: 2 * width] < _NEVER)
        while len(row):
            top, part = row * (2 * width), row * (width + 1)
            best = tree[top + 1]
            i = best & (width - 1)
            j = following[part + i]
            after = following[part + j]
            made = best // width
            ids[part + i] = made
            ids[part + j] = -1
            following[part + i] = after
            before[part + after] = i
            k = before[part + i]
            left = np.flatnonzero(k >= 0)
            # The pairs that begin at the merged part and at the part before it are new, that of the part that is gone is none.
            tree[top + width + j] = _NEVER
            right = ids[part + after]
            rank = self.rank(made, np.maximum(right, 0))
            tree[top + width + i] = np.where((right >= 0) & (rank < _NEVER), rank * width + i, _NEVER)
            if len(left):
                k = k[left]
                rank = self.rank(ids[part[left] + k], made[left])
                tree[top[left] + width + k] = np.where(rank < _NEVER, rank * width + k, _NEVER)
            tops = np.concatenate([top, top, top[left]])
            node = np.concatenate([j, i, k if len(left) else i[:0]]) + width
            while node[0] > 1:  # all leaves are equally deep
                node >>= 1
                below = tops + 2 * node
                tree[tops + node] = np.minimum(tree[below], tree[below + 1])
            row = row[tree[top + 1] < _NEVER]
        ids = ids.reshape(m, width + 1)
        live = ids[:, :-1] >= 0
        values = ids[:, :-1][live].astype("<i4")
        ends = np.cumsum(live.sum(axis=1))
        return [values[e - n : e].tobytes() for e, n in zip(ends.tolist(), live.sum(axis=1).tolist(), strict=True)]


class Encoder:
    """Encodes texts, remembering the ids of words, each taken with the single space before it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges, self.pattern = Merges(ranks), regex.compile(pattern)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _spans(self, text: str) -> Iterator[str]:
        """Parts of a text that can be encoded apart; all but the first follow a space that belongs to them."""
        at = 0
        while len(text) - at > _AT_ONCE:
            cut = _BETWEEN.search(text, at + _AT_ONCE)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:] if at else text

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of each part; the pieces of all of them are merged side by side."""
        split = dict(zip(parts, self._pieces(parts), strict=True))
        pieces = list({p for found in split.values() for p in found})
        ids = dict(zip(pieces, self.merges.encode([p.encode() for p in pieces]), strict=True))
        return {part: ids[found[0]] if len(found) == 1 else b"".join([ids[p] for p in found]) for part, found in split.items()}

    def _pieces(self, parts: list[str]) -> list[list[str]]:
        """The pieces of each part. Words, each after its one space, are split in one go: every such space begins a piece."""
        out: list[list[str]] = [[] for _ in parts]
        plain = []
        for k, part in enumerate(parts):
            if part[:1] == " " and len(part) > 1 and len(part.split()) == 1 and not part[1].isspace() and not part[-1].isspace():
                plain.append(k)
            else:
                out[k] = self.pattern.findall(part)
        at = -1
        for piece in self.pattern.findall("".join([parts[k] for k in plain])):
            if piece[0] == " ":
                at += 1
            out[plain[at]].append(piece)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for spans in itertools.zip_longest(*map(self._spans, texts)):
            # At a time the first spans of all texts, then the second of those that have one, and so on.
            firsts, words = [], []
            for k, span in enumerate(spans):
                if span is None:
                    firsts.append(None), words.append([])
                    continue
                found = _BETWEEN.split(span) if _ODD.search(span) or span[:1] == " " or span[-1:] == " " else span.split(" ")
                firsts.append((" " if out[k] else "") + found[0])
                words.append(found[1:])
            if len(self.words) >= _REMEMBERED // 2:
                self.words, self.older = {}, self.words
            known = self.words
            new = set().union(*words) - known.keys()
            again = new & self.older.keys()
            known.update((w, self.older[w]) for w in again)
            new -= again
            learnt = self._learn([*(" " + w for w in new), *{f for f in firsts if f is not None}])
            for w in new:
                known[w] = learnt[" " + w]
            for k, found in enumerate(words):
                if firsts[k] is not None:
                    out[k].append(learnt[firsts[k]])
                    out[k] += map(known.__getitem__, found)
            for w in new:
                if len(w) > _LONGEST or "\n" in w:
                    del known[w]
        return [b"".join(parts) for parts in out]


def _rank_file(spark: SparkSession, path: str):
    bounded_batches(spark)
    with open(path, "rb") as file:
        data = file.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"{path} has more than {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def _columns(df: DataFrame, name: str) -> list[str]:
    """Columns that stay beside a new one of this name, which takes the place of its like."""
    return [c for c in df.columns if c.lower() != name.lower()]


class Decoder:
    """The bytes of ids, gathered from one array of all tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted((i, b) for b, i in ranks.items())
        lengths = np.array([len(b) for _, b in tokens], np.int64)
        most = tokens[-1][0] + 1 if tokens else 0
        self.bytes = np.frombuffer(b"".join(b for _, b in tokens), np.uint8)
        self.length, self.start = np.full(most, -1, np.int64), np.zeros(most, np.int64)
        at = np.array([i for i, _ in tokens], np.int64)
        self.length[at], self.start[at] = lengths, np.cumsum(lengths) - lengths

    def decode(self, ids: np.ndarray) -> bytes:
        parts = []
        for at in range(0, len(ids), _AT_ONCE):
            some = ids[at : at + _AT_ONCE]
            length = self.length[some]
            if (some < 0).any() or (length < 0).any():
                raise KeyError("an id that is no token")
            ends = np.cumsum(length)
            parts.append(self.bytes[np.repeat(self.start[some] - ends + length, length) + np.arange(ends[-1])].tobytes())
        return b"".join(parts)


def _arrays(found: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(found), "<i4"))


def encode(
    docs: DataFrame, rank_path: str, pattern: str, column: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with the array ``ids``, in place of any such column, beside its own columns.

    Whole texts are encoded, without special tokens; a null text counts as empty and has
    no ids. With ``decoded``, what the ids decode to comes along in a binary column of that name. ``rank_path``
    is read on the driver. Each row stands alone: repeated rows, ties and null ids make no difference, and no rows give no rows.
    """
    shared = _rank_file(docs.sparkSession, rank_path)
    made = [ids] if decoded is None else [ids, decoded]
    kept = [c for c in docs.columns if c.lower() not in {m.lower() for m in made}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(shared.value)
        encoder, decoder = Encoder(ranks, pattern), None if decoded is None else Decoder(ranks)
        for batch in batches:
            # A few rows at a time, so that what a batch of texts becomes need not be in memory at once.
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = encoder.encode([t or "" for t in rows.column(rows.num_columns - 1).to_pylist()])
                columns = [*rows.columns[:-1], _arrays(found)]
                if decoder is not None:
                    columns.append(pa.array([decoder.decode(np.frombuffer(x, "<i4")) for x in found], pa.binary()))
                yield pa.record_batch(columns, names=[*kept, *made])

    schema = docs.select(*kept).schema.add(ids, ArrayType(IntegerType()))
    if decoded is not None:
        schema = schema.add(decoded, "binary")
    rows = docs.select(*kept, docs[column].alias("text"))
    return rows.toDF(*(f"c{i}" for i in range(len(kept) + 1))).mapInArrow(run, schema)


def decode(tokens: DataFrame, rank_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``tokens`` with the binary column ``decoded``, the bytes of its ids; null ids give no bytes."""
    shared = _rank_file(tokens.sparkSession, rank_path)
    kept = _columns(tokens, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [decoder.decode(x.values.to_numpy()) if x.is_valid else b"" for x in rows.column(rows.num_columns - 1)]
                yield pa.record_batch([*rows.columns[:-1], pa.array(texts, pa.binary())], names=[*kept, decoded])

    schema = tokens.select(*kept).schema.add(decoded, "binary")
    return tokens.select(*kept, tokens[ids].alias("__ids")).mapInArrow(run, schema)
