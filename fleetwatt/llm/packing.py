"""Best-fit packing of documents into sequences of a fixed number of tokens.

The packing is decided on the number of pieces of each length: at most `capacity` numbers, however
many documents there are. Pieces above a third of the capacity share a sequence with one other
such piece at most and are matched greedily, the longest first with the longest that fits. Shorter
pieces go, longest first, to the fullest sequences that have room. Both steps treat all sequences
with the same room at once. The decision is a list of runs "ranks a to b of length l go to
sequences s to s + b - a at offset o"; Spark ranks the pieces of each length and looks them up.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fleetwatt.llm.texts import UNIT, WHITE
from fleetwatt.llm.steps import stored

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
CACHED_UNITS = 500_000
CACHED_STEMS = 500_000
JOINED_STEMS = 1024
RANKED_TOGETHER = 250_000

_UNEVEN = re.compile(f"[{WHITE}] ")
# ASCII marks but the apostrophe. The library always splits between a letter and those.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LAST_LETTER = "\u024f"  # up to here every version of Unicode has the same letters


class _UnitIds:
    """Ids of texts by the tokenizers library, which is asked once for each new unit.

    A unit is a word with the white space before it. The library splits there too, so the ids of
    a text are those of its units one after the other. Most units are letters and then marks; their
    letters, the stem, are kept longer, since few stems come with many marks. New stems are encoded as
    one text: only the first token of a word holds its space.
    """

    def __init__(self, name: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(public_tokenizers.path(name))
        self.model.no_truncation()
        self.model.no_padding()
        self.spaced: dict[str, bytes] = {}  # by the word after a single space
        self.known: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}  # after a single space
        space = self.model.encode(" ", add_special_tokens=False).tokens[0]
        self.opens = np.zeros(self.model.get_vocab_size(), bool)
        self.opens[[i for t, i in self.model.get_vocab().items() if t.startswith(space)]] = True

    def _learn(self, known: dict[str, bytes], units: set[str], before: str) -> None:
        new = list(units.difference(known))
        if len(known) + len(new) > CACHED_UNITS:
            known.clear()
            new = list(units)
        self._encode(known, new, before)

    def _encode(self, known: dict[str, bytes], new: list[str], before: str) -> None:
        coded = self.model.encode_batch_fast([before + u for u in new], add_special_tokens=False) if new else []
        known.update((u, np.array(x.ids, "<u4").tobytes()) for u, x in zip(new, coded))

    def _learn_stems(self, stems: set[str]) -> None:
        new = list(stems.difference(self.stems))
        if len(self.stems) + len(new) > CACHED_STEMS:
            self.stems.clear()
            new = list(stems)
        for at in range(0, len(new), JOINED_STEMS):
            part = new[at : at + JOINED_STEMS]
            ids = np.array(self.model.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = [*(4 * np.flatnonzero(self.opens[ids])).tolist(), 4 * len(ids)]
            if len(cuts) != len(part) + 1:  # a vocabulary of another kind: its words are asked for one by one
                continue
            data = ids.tobytes()
            self.stems.update((w, data[a:b]) for w, a, b in zip(part, cuts, cuts[1:]))

    def _learn_spaced(self, units: set[str]) -> None:
        new = units.difference(self.spaced)
        if len(self.spaced) + len(new) > CACHED_UNITS:
            self.spaced.clear()
            new = units
        stems, other = [u.rstrip(MARKS) for u in new], []
        self._learn_stems({x for x in stems if _is_stem(x)})
        self._learn(self.known, {u[len(x) :] for u, x in zip(new, stems)}, "")
        known, of = self.known, self.stems.get
        for u, x in zip(new, stems):
            ids = of(x)
            if ids is None:
                other.append(u)
            else:
                self.spaced[u] = ids if len(u) == len(x) else ids + known[u[len(x) :]]
        self._encode(self.spaced, other, " ")

    def forget(self) -> None:
        """The next task learns its own words; a worker that waits for one holds none."""
        for known in (self.spaced, self.known, self.stems):
            known.clear()
        pa.default_memory_pool().release_unused()

    def ids(self, texts: list[str]) -> list[bytes]:
        even = [None if _UNEVEN.search(t) else t.split(" ") for t in texts]
        units = [[x[0]] if x else UNIT.findall(t) for t, x in zip(texts, even)]
        self._learn_spaced({w for x in even if x for w in x[1:]})
        self._learn(self.known, {u for x in units for u in x}, "")
        spaced, known = self.spaced.__getitem__, self.known.__getitem__
        return [
            b"".join(map(known, u)) + (b"".join(map(spaced, x[1:])) if x else b"") for u, x in zip(units, even)
        ]


def _is_stem(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) <= LAST_LETTER)


@lru_cache(maxsize=2)
def _unit_ids(name: str) -> _UnitIds:
    return _UnitIds(name)


def pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Token pieces of documents: doc_id, piece, start, length, ids (little-endian 32-bit).

    A document is its ids and `end_id`; a null text is empty, so it has the end id only. One that
    is longer than the capacity is cut into pieces of the capacity; the first takes what is over.
    Repeated rows give repeated pieces. Other columns are left out.
    """
    key = docs.schema[doc_id]
    schema = T.StructType(
        [
            T.StructField("doc_id", key.dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unit_ids(vocabulary)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    row, piece, start, length, data = [], [], [], [], []
                    for i, ids in enumerate(model.ids([t or "" for t in part.column(1).to_pylist()])):
                        ids += end
                        n = len(ids) // 4
                        cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                            row.append(i)
                            piece.append(k)
                            start.append(a)
                            length.append(b - a)
                            data.append(ids[4 * a : 4 * b])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(row, pa.int64())),
                            pa.array(piece, pa.int32()),
                            pa.array(start, pa.int64()),
                            pa.array(length, pa.int64()),
                            pa.array(data, pa.binary()),
                        ],
                        names=schema.names,
                    )
        finally:
            model.forget()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


@dataclass
class Run:
    """Ranks first .. first + count - 1 of a length go to sequences from `sequence` on."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = dict(counts)
        self.next = dict.fromkeys(counts, 0)
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[Run] = []
        self.rooms: list[int] = []  # sorted
        self.open: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, count)

    def take(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(length, self.next[length], count, sequence, offset))
        self.next[length] += count
        self.left[length] -= count

    def give(self, room: int, sequence: int, count: int) -> None:
        if count and room:
            if room not in self.open:
                bisect.insort(self.rooms, room)
                self.open[room] = []
            self.open[room].append((sequence, count))

    def fresh(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def match(self, large: list[int]) -> None:
        """large: ascending."""
        for a in reversed(large):
            while self.left[a]:
                i = bisect.bisect_right(large, min(a, self.capacity - a)) - 1
                while i >= 0 and self.left[large[i]] < 1 + (large[i] == a):
                    i -= 1
                if i < 0:
                    n = self.left[a]
                    s = self.fresh(n)
                    self.take(a, n, s, 0)
                    self.give(self.capacity - a, s, n)
                    break
                b = large[i]
                n = self.left[a] // 2 if a == b else min(self.left[a], self.left[b])
                s = self.fresh(n)
                self.take(a, n, s, 0)
                self.take(b, n, s, a)
                self.give(self.capacity - a - b, s, n)

    def fill(self, small: list[int]) -> None:
        """small: descending."""
        for a in small:
            while self.left[a]:
                i = bisect.bisect_left(self.rooms, a)
                if i == len(self.rooms):
                    each = self.capacity // a
                    n = -(-self.left[a] // each)
                    self.give(self.capacity, self.fresh(n), n)
                    continue
                room = self.rooms[i]
                sequence, n = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room], self.rooms[i]
                each = min(room // a, self.left[a])
                used = min(n, self.left[a] // each)
                for k in range(each):
                    self.take(a, used, sequence, self.capacity - room + k * a)
                self.give(room - each * a, sequence, used)
                self.give(room, sequence + used, n - used)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place `counts[l]` pieces of each length l (1 to capacity)."""
    decided = _Plan({length: n for length, n in counts.items() if n}, capacity)
    decided.match(sorted(x for x in decided.left if 3 * x > capacity))
    decided.fill(sorted((x for x in decided.left if 3 * x <= capacity), reverse=True))
    return decided.runs


def pack(parts: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a length of 1 to capacity.

    Rows of the same length are exchangeable. They are ranked in groups of a hash of the whole
    row, so that a length that holds most rows is spread, and the groups' sizes give the ranks'
    starts. Eager: the rows are stored once, since they are counted first and then placed, and the
    counts per length (at most `capacity` numbers) go to the driver. An empty table stays empty.
    """
    rows = stored(parts, "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy(length).count().collect()}
    if any(not (x and 0 < x <= capacity) for x in counts):
        raise ValueError(f"lengths must be 1 to {capacity}: {[x for x in counts if not (x and 0 < x <= capacity)][:5]}")
    runs = sorted(plan(counts, capacity), key=lambda r: (r.length, r.first))
    key = np.array([(r.length << 44) + r.first for r in runs], np.int64)
    shift = np.array([r.sequence - r.first for r in runs], np.int64)
    offset = np.array([r.offset for r in runs], np.int64)

    @F.arrow_udf("sequence_id bigint, offset bigint")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        rank = np.asarray(ranks)
        at = np.searchsorted(key, (np.asarray(lengths) << 44) + rank, "right") - 1
        return pa.StructArray.from_arrays([pa.array(rank + shift[at]), pa.array(offset[at])], names=["sequence_id", "offset"])

    groups = max(16, -(-sum(counts.values()) // RANKED_TOGETHER))
    names = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    grouped = rows.select(*names, F.pmod(F.xxhash64(*names), F.lit(groups)).alias("_group"))
    starts = grouped.groupBy(length, "_group").agg(F.count("*").alias("_n")).select(
        F.col(length).alias("_length"),
        F.col("_group").alias("_of"),
        (F.sum("_n").over(Window.partitionBy(length).orderBy("_group")) - F.col("_n")).alias("_start"),
    )
    by = [length, "_group"]
    ranked = grouped.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*[c for c in names if c != length])))
    placed = ranked.join(starts, (F.col(length) == F.col("_length")) & (F.col("_group") == F.col("_of")))
    at = place(F.col(length).cast("bigint"), (F.col("_start") + F.col("_rank") - 1).cast("bigint"))
    return placed.withColumn("_at", at).select(*names, "_at.sequence_id", "_at.offset")


def packed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut = pieces(docs, doc_id, text).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(cut)
