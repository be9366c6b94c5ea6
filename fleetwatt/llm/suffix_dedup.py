"""Removal of byte strings that occur earlier in the corpus, by suffix arrays of shards.

Every string of `length` bytes holds an anchor: the K-byte string of least hash in it. Equal strings
hold equal anchors, so repeats are sought among occurrences of one anchor, each with the bytes
around it that such a string can reach. Occurrences with equal surroundings are settled by hash:
all but the first go, within a partition already before the shuffle. Those whose surroundings
differ are few. They are compared with the first occurrence of the anchor; what may still match
another one goes, with all its likes, to a shard's suffix array, which is built by prefix doubling.
Neighbours in it with common prefixes of `length` bytes are one string, and all but its first
place are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleetwatt.llm.suffix_array import common_prefixes, suffix_array
from fleetwatt.llm.steps import stored

LENGTH = 100
#: Bytes of an anchor.
ANCHOR = 32
#: A text is hashed in blocks of so many bytes.
BLOCK = 1 << 20
#: Bytes of surroundings in one suffix array.
SHARD = 1 << 17
#: Different surroundings of one anchor that are handled in one task. Those of commoner anchors
#: are compared string by string in Spark.
TOGETHER = 50_000

_UP_TWO = bytes(min(b + 2, 255) for b in range(256))
_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, BLOCK + 2048), _powers(_INVERSE, BLOCK + 2048)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Hashes:
    """Hashes of substrings of a block, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _UP[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * _DOWN[start]


def _sliding(x: np.ndarray, width: int, f) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x, step = f(x[:-step], x[step:]), 2 * step
    rest = width - step
    return f(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors of a text, their hashes, and hashes of their surroundings: from
    `length - anchor` bytes before to `length` bytes after the position, as far as the text goes."""
    width, n = length - anchor + 1, len(text)
    pos, key, around = [], [], []
    reach = 2 * length
    for start in range(0, n, BLOCK):
        low, high = max(0, start - reach), min(n, start + BLOCK + reach)
        data = np.frombuffer(text, np.uint8)[low:high]
        if len(data) < length:
            continue
        sums = _Hashes(data).sums
        grams = len(data) - anchor + 1
        h = _mixed((sums[anchor:] - sums[:grams]) * _DOWN[:grams])
        least = _sliding(h, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(h == _sliding(np.concatenate([edge, least, edge]), width, np.maximum))
        at = chosen + low
        here = (at >= start) & (at < start + BLOCK)
        chosen, at = chosen[here], at[here]
        left, right = np.minimum(at, length - anchor), np.minimum(n - at, length)
        c = (sums[chosen + right] - sums[chosen - left]) * _DOWN[chosen - left]
        pos.append(at)
        key.append(h[chosen])
        around.append(_mixed(c + (left * 1000 + right).astype(np.uint64)))
    if not pos:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(pos), np.concatenate(key), np.concatenate(around)


def _spans(doc: np.ndarray, pos: np.ndarray, before: int, after: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges around positions, those of a document that touch made one. They may pass the text's ends."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    if not len(doc):
        return doc, pos, pos
    new = np.r_[True, (doc[1:] != doc[:-1]) | (pos[1:] - before > pos[:-1] + after)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(doc) - 1]
    return doc[first], np.maximum(pos[first] - before, 0), pos[last] + after


def _found(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """Rows with key: an anchor's first occurrence with its surroundings in the partition. Rows
    without: spans of other occurrences, which the first one covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, text in enumerate(batch.column(1)):
                p, k, a = anchors((text.as_py() or "").encode(), length, anchor)
                parts.append((np.full(len(p), ids[i]), p, k, a))
            if sum(len(x[0]) for x in parts) > 3_000_000:
                yield from settle(parts)
                parts = []
        if parts:
            yield from settle(parts)

    def settle(parts: list) -> Iterator[pa.RecordBatch]:
        doc, pos, key, around = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((pos, doc, around, key))
        doc, pos, key, around = doc[order], pos[order], key[order], around[order]
        first = np.r_[True, (key[1:] != key[:-1]) | (around[1:] != around[:-1])][: len(doc)]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
        first |= (doc == doc[lead]) & (pos == pos[lead])
        for s in range(0, int(first.sum()), 100_000):
            at = np.flatnonzero(first)[s : s + 100_000]
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at].view(np.int64)), pa.array(around[at].view(np.int64)), pa.array(doc[at]), pa.array(pos[at]), none], names=names
            )
        d, s, e = _spans(doc[~first], pos[~first], length - anchor, length)
        if len(d):
            none = pa.nulls(len(d), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(d), pa.array(s), pa.array(e)], names=names)

    names = ["key", "around", "doc", "pos", "end"]
    return docs.mapInArrow(run, "key bigint, around bigint, doc bigint, pos bigint, end bigint")


def _settled(found: DataFrame, length: int, anchor: int) -> DataFrame:
    """Rows with key: first occurrences of anchors with several surroundings. Rows without: spans.

    Reads occurrences in order and only remembers the last one, however common its anchor is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, around, doc and pos of the first one of its surroundings; whether it is out
        for batch in batches:
            key, around, doc, pos = (batch.column(i).to_numpy() for i in range(4))
            if last is not None:
                key, around, doc, pos = (np.r_[np.int64(v), x] for v, x in zip(last[:4], (key, around, doc, pos)))
            n = len(key)
            new_key = np.r_[True, key[1:] != key[:-1]]
            new = new_key | np.r_[True, around[1:] != around[:-1]]
            lead = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            later = (doc > doc[lead]) | ((doc == doc[lead]) & (pos > pos[lead]))
            # A lead is out if its anchor has another lead before it or, in this batch, behind it.
            leads = np.flatnonzero(new)
            more = np.zeros(n, bool)
            more[leads[1:]] |= ~new_key[leads[1:]]
            more[leads[:-1]] |= ~new_key[leads[1:]]
            done = np.zeros(n, bool)
            if last is not None:
                done[0] = last[4]
                more[0] |= last[4]
            out = np.flatnonzero(more & ~done)
            if len(out):
                none = pa.nulls(len(out), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(doc[out]), pa.array(pos[out]), none], names=names)
            d, s, e = _spans(doc[later], pos[later], length - anchor, length)
            if len(d):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(d), pa.int64()), pa.array(d), pa.array(s), pa.array(e)], names=names)
            k = lead[-1]
            last = (key[k], around[k], doc[k], pos[k], bool(more[k]))

    names = ["key", "doc", "pos", "end"]
    rows = found.where("key is not null").select("key", "around", "doc", "pos")
    return rows.repartition("key").sortWithinPartitions("key", "around", "doc", "pos").mapInArrow(
        run, "key bigint, doc bigint, pos bigint, end bigint"
    )


def _surroundings(docs: DataFrame, firsts: DataFrame, length: int, anchor: int) -> DataFrame:
    """key, doc, start, at (of the anchor in it) and data: the bytes around first occurrences."""
    wanted = firsts.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("key", "pos")).alias("spots"))
    texts = docs.join(wanted, F.col("doc") == F.col("_doc")).select("doc", "text", "spots.key", "spots.pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                key, doc, begin, at, data = [], [], [], [], []
                part = batch.slice(start, 200)
                for d, text, keys, places in zip(*(part.column(i) for i in range(4))):
                    raw, keys, places = text.as_py().encode(), keys.values.to_numpy(), places.values.to_numpy()
                    low = np.maximum(places - (length - anchor), 0)
                    key.append(keys)
                    doc.append(np.full(len(keys), d.as_py()))
                    begin.append(low)
                    at.append(places - low)
                    data.extend(raw[a : p + length] for a, p in zip(low.tolist(), places.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.concatenate(x)) for x in (key, doc, begin, at)), pa.array(data, pa.binary())],
                    names=["key", "doc", "start", "at", "data"],
                )

    return texts.mapInArrow(run, "key bigint, doc bigint, start bigint, at bigint, data binary")


def _equal_run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading equal columns of two matrices."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def repeats_by_suffix_array(data: list[bytes], doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """doc and start of every string of `length` bytes in data that also starts earlier there."""
    # 0 ends the text and 1 each piece; the bytes of UTF-8 are below 246 and move up by two.
    text = b"".join(x.translate(_UP_TWO) + b"\1" for x in data) + b"\0"
    size = np.array([len(x) for x in data])
    owner = np.repeat(np.arange(len(data)), size + 1)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(size + 1) - (size + 1), size + 1)
    room = size[owner] - offset
    array = suffix_array(text, 256)
    shared = common_prefixes(text, array)
    order = np.array(array[1:])  # without the last symbol
    full = room[order] >= length
    joined = (shared[order] >= length) & full
    order, joined = order[full], joined[full]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = np.cumsum(~joined)
    d, s = doc[owner[order]], start[owner[order]] + offset[order]
    by = np.lexsort((s, d, run))
    d, s, run = d[by], s[by], run[by]
    lead = np.maximum.accumulate(np.where(np.r_[True, run[1:] != run[:-1]], np.arange(len(run)), 0))
    later = (d > d[lead]) | ((d == d[lead]) & (s > s[lead]))
    return d[later], s[later]


def _compared(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """Spans of strings that occur earlier, among occurrences of the same anchor."""
    before = length - anchor

    def settle(key: np.ndarray, doc: np.ndarray, start: np.ndarray, at: np.ndarray, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        n = len(key)
        pos = start + at
        order = np.lexsort((pos, doc, key))
        key, doc, start, at, pos = key[order], doc[order], start[order], at[order], pos[order]
        data = [data[i] for i in order]
        flat = np.frombuffer(b"".join(data), np.uint8)
        size = np.array([len(x) for x in data])
        base = np.cumsum(size) - size + at
        columns = np.arange(length)
        right = np.where(columns < (size - at)[:, None], flat[np.minimum(base[:, None] + columns, len(flat) - 1)].astype(np.int16), -1)
        columns = np.arange(1, before + 1)
        left = np.where(columns <= at[:, None], flat[np.maximum(base[:, None] - columns, 0)].astype(np.int16), -1)
        first = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(n), 0))
        l = np.minimum(_equal_run(left, left[first]), np.minimum(at, at[first]))
        r = np.minimum(_equal_run(right, right[first]), np.minimum(size - at, (size - at)[first]))
        other = (doc > doc[first]) | (pos > pos[first])
        hit = other & (l + r >= length)
        docs_out, starts_out, ends_out = [doc[hit]], [(pos - l)[hit]], [(pos + r)[hit]]
        # What reaches beyond the match with the first one can only match its likes: those that
        # share the bytes up to the first difference, on the right or on the left.
        again = np.zeros(n, bool)
        for side, ext, room in ((right, r, size - at), (left, l, at)):
            beyond = other & (ext < room)
            like = [hash((k, x[: e + 1].tobytes())) for k, x, e in zip(key[beyond].tolist(), side[beyond], ext[beyond].tolist())]
            _, which, count = np.unique(np.array(like, np.int64), return_inverse=True, return_counts=True)
            again[np.flatnonzero(beyond)[count[which] > 1]] = True
        held = np.flatnonzero(again)
        cuts = np.flatnonzero(np.r_[True, key[held][1:] != key[held][:-1]]) if len(held) else []
        group: list[int] = []
        bytes_held = 0
        for a, b in zip(cuts, [*cuts[1:], len(held)]):
            group.extend(held[a:b].tolist())
            bytes_held += int(size[held[a:b]].sum())
            if bytes_held >= SHARD or b == len(held):
                d, s = repeats_by_suffix_array([data[i] for i in group], doc[group], start[group], length)
                docs_out.append(d)
                starts_out.append(s)
                ends_out.append(s + length)
                group, bytes_held = [], 0
        d, s, e = (np.concatenate(x) for x in (docs_out, starts_out, ends_out))
        if len(d):
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(s), pa.array(e)], names=["doc", "pos", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows_held = 0

        def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(x) for x in list(zip(*parts))[:4]]
            yield from settle(*columns, [x for p in parts for x in p[4]])

        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            data = batch.column(4).to_pylist()
            cut = np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1
            cut = int(cut[-1]) if len(cut) else 0
            if held and (cut or columns[0][0] != held[-1][0][-1]) and rows_held >= 4000:
                stop = cut if columns[0][0] == held[-1][0][-1] else 0
                first_end = int(np.argmax(columns[0] != held[-1][0][-1])) if stop else 0
                if first_end:
                    held.append((*(c[:first_end] for c in columns), data[:first_end]))
                yield from flush(held)
                held, rows_held = [], 0
                columns, data = [c[first_end:] for c in columns], data[first_end:]
            held.append((*columns, data))
            rows_held += len(data)
        if rows_held:
            yield from flush(held)

    sorted_rows = rows.repartition("key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(run, "doc bigint, pos bigint, end bigint")


def _string_by_string(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many surroundings: every string's first place is an
    aggregate that each task makes in part."""
    places = rows.where(F.octet_length("data") >= length).select(
        "doc", "start", "data", F.explode(F.sequence(F.lit(0), F.octet_length("data") - length)).alias("i")
    )
    string = F.substring("data", F.col("i") + 1, F.lit(length))
    places = places.select("doc", (F.col("start") + F.col("i")).alias("pos"), F.xxhash64(string).alias("a"), F.xxhash64(F.lit(1), string).alias("b"))
    doc = places.groupBy("a", "b").agg(F.min("doc").alias("first_doc"))
    both = places.join(doc, ["a", "b"])
    pos = both.where("doc = first_doc").groupBy("a", "b").agg(F.min("pos").alias("first_pos"))
    later = both.join(pos, ["a", "b"]).where("doc > first_doc or pos > first_pos")
    return later.select("doc", "pos", (F.col("pos") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, together: int = TOGETHER) -> DataFrame:
    """doc and spans (start, end in bytes) of docs (doc, text); spans may overlap or pass the end."""
    found = stored(_found(docs, length, anchor), "anchors")
    settled = stored(_settled(found, length, anchor), "settled")
    firsts = settled.where("key is not null").select("key", "doc", "pos")
    around = stored(_surroundings(docs, firsts, length, anchor), "around")
    hot = stored(around.groupBy("key").count().where(F.col("count") > together).select(F.col("key").alias("_key")), "hot")
    few = around.join(hot, F.col("key") == F.col("_key"), "left_anti")
    many = around.join(hot, F.col("key") == F.col("_key"), "left_semi")
    spans = (
        found.where("key is null").select("doc", "pos", "end")
        .unionByName(settled.where("key is null").select("doc", "pos", "end"))
        .unionByName(_compared(few, length, anchor))
        .unionByName(_string_by_string(many, length))
    )
    return spans.groupBy("doc").agg(F.collect_list(F.struct(F.col("pos").alias("start"), "end")).alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Adds n_bytes, n_removed, n_spans and kept (binary); the other columns stay.

    A byte goes if a string of `length` bytes over it also starts earlier: in a text of smaller
    doc_id or before in the same one. Strings are judged on the input. A NULL text is empty.
    Ids are taken to identify texts; equal rows are one text and are treated alike. A row without
    an id is not compared and keeps all bytes. Eager: intermediate tables are stored.
    """
    keep = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept")]
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).where("doc is not null")
    spans = repeated_spans(texts, length)
    joined = docs.select(*[F.col(f"`{c}`") for c in keep]).join(
        spans.select(F.col("doc").alias("_doc"), F.col("spans").alias("_spans")), F.col(doc_id).cast("bigint") == F.col("_doc"), "left"
    )
    rows = joined.select(F.col(text).alias("_text"), F.col("_spans.start").alias("_s"), F.col("_spans.end").alias("_e"), *[F.col(f"`{c}`") for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                size, gone, runs, kept = [], [], [], []
                for t, s, e in zip(part.column(0), part.column(1), part.column(2)):
                    raw = (t.as_py() or "").encode()
                    size.append(len(raw))
                    if s.values is None or not len(s.values):
                        gone.append(0)
                        runs.append(0)
                        kept.append(raw)
                        continue
                    s, e = s.values.to_numpy(), np.minimum(e.values.to_numpy(), len(raw))
                    order = np.argsort(s, kind="stable")
                    s, e = s[order], np.maximum.accumulate(e[order])
                    new = np.r_[True, s[1:] > e[:-1]]
                    low, high = s[new], e[np.r_[np.flatnonzero(new)[1:] - 1, len(e) - 1]]
                    gone.append(int((high - low).sum()))
                    runs.append(len(low))
                    edges = [0, *np.column_stack([low, high]).ravel().tolist(), len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[3:], pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                    names=[*keep, "n_bytes", "n_removed", "n_spans", "kept"],
                )

    added = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    return rows.mapInArrow(run, T.StructType([docs.schema[c] for c in keep] + added.fields))


def valid_text(kept: Column) -> Column:
    """The bytes as text, without what is no whole character any more."""

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else x.decode("utf-8", "ignore") for x in column.to_pylist()], pa.string())

    return decoded(kept)
