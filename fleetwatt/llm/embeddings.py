"""Near-duplicate embeddings: cells, iterative quantisation, multi-index Hamming tables, exact rerank.

Vectors are centred, turned by principal axes and a learnt rotation, and cut to signs. They go to
cells by the largest components of other rotations, each vector to a few cells. Inside a cell the
sign codes are split over several tables; two vectors meet where parts of their codes agree but for
the bits next to zero. What meets is compared by cosine with the original vectors. There are more
cells the more vectors there are, and as many tables as the threshold needs, which is measured on
the fitted vectors.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.llm.components import components
from fleetwatt.llm.steps import forget, stored

THRESHOLD = 0.9
#: Vectors on which the rotation is fitted: those of smallest hash.
FIT_VECTORS = 4096
BITS = 64
ROUNDS = 40
#: The largest share of pairs just at the threshold that meet nowhere; cells and codes get half each.
MISS = 1e-3
#: Pairs at the threshold on which the share is measured.
PAIRS = 16384
#: Bits of a part, those next to zero, that may differ.
UNSURE = 3
#: Cells of a vector in one table of cells.
CELLS = 4
#: Rows that a cell of one rotation should have, and one of two; up to twice these cells are of one.
CELL, LARGE = 8192, 32768
#: Tables of cells, at most; where more would be needed, cells are made larger.
TABLES = 8
#: Rows of a cell that one task holds; what is above is cut, and each two halves of this size meet.
BLOCK = 131072
#: Rows of a block up to which all are compared, rows of a key up to which pairs are listed, and pairs made at once.
PLAIN, LISTED, PRODUCTS = 2048, 128, 1 << 22
#: Bytes of rows that may be sent at once in any case, and as a multiple of the vectors' bytes.
AT_ONCE, SHARE = 1 << 27, 2.2


def fit_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection of iterative quantisation: sign((x - mean) @ projection) is the code.

    Alternates between the nearest corners of the cube and the rotation that best fits them.
    """
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    _, _, axes = np.linalg.svd(sample - mean, full_matrices=True)
    axes = axes[: min(bits, dim)].T
    v = (sample - mean) @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(v.shape[1],) * 2))[0]
    for _ in range(rounds):
        corners = np.where(v @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ v)
        turn = (left @ right).T
    return mean, axes @ turn


def part_widths(bits: int, threshold: float, miss: Callable[[list[int]], float] | None = None) -> list[int]:
    """Widths of the parts of a code: the fewest tables that miss at most MISS of the pairs at the
    threshold. Each bit of such a pair differs with chance acos(threshold) / pi, and parts meet that
    differ in one bit at most; or miss tells the share that is missed."""
    p = math.acos(threshold) / math.pi
    blind = lambda widths: math.prod(1 - (1 - p) ** w - w * p * (1 - p) ** (w - 1) for w in widths)
    for tables in range(1, bits + 1):
        widths = [bits // tables + (i < bits % tables) for i in range(tables)]
        if (miss or blind)(widths) <= MISS:
            break
    return widths


def usable(vector: Column) -> Column:
    """Not NULL, not zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = values.reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _parts(code: np.ndarray, widths: list[int]) -> list[np.ndarray]:
    out, at = [], 0
    for w in widths:
        out.append((code >> np.uint64(at)) & np.uint64((1 << w) - 1))
        at += w
    return out


class Search(NamedTuple):
    """What is fitted to the vectors of one length. apart: the bits in which codes of a pair differ at most.
    turns: for each table of cells the rotations, of `axes` columns each; none if all rows are one cell."""

    mean: np.ndarray
    projection: np.ndarray
    widths: list[int]
    apart: int
    turns: list[list[np.ndarray]]
    axes: int

    def cells(self, v: np.ndarray) -> np.ndarray:
        """The cells of turned vectors, in each table CELLS: the axes on which the rotations have the largest
        components, and the next best choices."""
        out = []
        for t, turns in enumerate(self.turns):
            key, loss = np.full((len(v), 1), t, np.int32), np.zeros((len(v), 1))
            for turn in turns:
                c = v @ turn
                top = np.argpartition(np.abs(c), -CELLS, axis=1)[:, -CELLS:]
                c = np.take_along_axis(c, top, axis=1)
                own = (2 * top + (c >= 0)).astype(np.int32)
                c = np.abs(c)
                key = (key[:, :, None] * np.int32(2 * self.axes) + own[:, None, :]).reshape(len(v), -1)
                loss = (loss[:, :, None] + (c.max(axis=1, keepdims=True) - c)[:, None, :]).reshape(len(v), -1)
            if key.shape[1] > CELLS:
                key = np.take_along_axis(key, np.argpartition(loss, CELLS - 1, axis=1)[:, :CELLS], axis=1)
            out.append(key)
        return np.concatenate(out, axis=1) if out else np.zeros((len(v), 1), np.int32)


def _signs(v: np.ndarray) -> np.ndarray:
    return (v >= 0) @ (np.uint64(1) << np.arange(v.shape[1], dtype=np.uint64))


def _tables(v: np.ndarray, widths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each part of the sign codes, the part and the mask of its UNSURE bits next to zero."""
    out, at = [], 0
    for w, part in zip(widths, _parts(_signs(v), widths)):
        few = min(UNSURE, w)
        bits = np.argpartition(np.abs(v[:, at : at + w]), few - 1, axis=1)[:, :few]
        kind = np.uint16 if w <= 16 else np.uint64
        out.append((part.astype(kind), (np.uint64(1) << bits.astype(np.uint64)).sum(axis=1, dtype=np.uint64).astype(kind)))
        at += w
    return out


def _at_threshold(x: np.ndarray, threshold: float, turned: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Turned pairs whose cosine is the threshold: fitted vectors, and partners in random directions
    and, every other one, in the direction of another fitted vector."""
    rng = np.random.default_rng(11)
    out = []
    for start in range(0, PAIRS, 1024):
        a = x[np.arange(start, start + 1024) % len(x)]
        u = rng.normal(size=a.shape)
        u[::2] = x[rng.integers(0, len(x), 512)] + 1e-3 * u[::2]
        u -= (u * a).sum(axis=1, keepdims=True) * a
        u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
        out.append((turned(a), turned(threshold * a + math.sqrt(1 - threshold**2) * u)))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _shapes(n: int, bits: int) -> Iterator[tuple[int, int]]:
    """Rotations of a table and axes of each, from as many cells as n vectors need to fewer."""
    turns = 1 if CELLS * n <= 2 * bits * 2 * LARGE else 2
    axes = min(bits, math.ceil((CELLS * n / (CELL if turns == 1 else LARGE)) ** (1 / turns) / 2))
    for turns in range(turns, 0, -1):
        while axes > CELLS:
            yield turns, axes
            axes //= 2
        axes = bits


def fit(sample: np.ndarray, n: int, threshold: float) -> Search:
    """The search for n vectors. Tables of cells are added, and parts made narrower, until pairs at the
    threshold meet; where too many tables would be needed, cells become larger, at last one for all."""
    mean, projection = fit_rotation(sample)
    bits = projection.shape[1]
    a, b = _at_threshold(sample, threshold, lambda x: (x - mean) @ projection)

    def miss(widths: list[int]) -> float:
        met = np.zeros(PAIRS, bool)
        for (p, p_mask), (q, q_mask) in zip(_tables(a, widths), _tables(b, widths)):
            met |= ((p ^ q) & ~(p_mask | q_mask)) == 0
        return 2 * (1 - met.mean())

    apart = int(np.bitwise_count(_signs(a) ^ _signs(b)).max())
    search = Search(mean, projection, part_widths(bits, threshold, miss), apart, [], 0)
    for turns, axes in _shapes(n, bits):
        rng, tables, met = np.random.default_rng(13), [], np.zeros(PAIRS, bool)
        while len(tables) < TABLES and 2 * (1 - met.mean()) > MISS:
            tables.append([np.linalg.qr(rng.normal(size=(bits, bits)))[0][:, :axes] for _ in range(turns)])
            one = search._replace(turns=tables[-1:], axes=axes)
            met |= (one.cells(a)[:, :, None] == one.cells(b)[:, None, :]).any(axis=(1, 2))
        if 2 * (1 - met.mean()) <= MISS:
            return search._replace(turns=tables, axes=axes)
    return search


def _with_cells(vectors: DataFrame, search: Search) -> DataFrame:
    """id, n, the vector's bytes, and its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                x = _matrix(batch.column(2))
                cells = search.cells((x - search.mean) @ search.projection)
                data = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                ends = lambda width: pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * np.int32(width))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1),
                        pa.Array.from_buffers(pa.binary(), len(x), [None, ends(4 * x.shape[1]), pa.py_buffer(data)]),
                        pa.ListArray.from_buffers(pa.list_(pa.int32()), len(x), [None, ends(cells.shape[1])], children=[pa.array(cells.ravel())]),
                    ],
                    names=["id", "n", "vector", "cells"],
                )

    return vectors.select("id", "n", "vector").mapInArrow(run, "id bigint, n bigint, vector binary, cells array<int>")


class Block:
    """Rows of one cell, and the links found between them. A pair counts in the first of its common
    cells, there in the first table where it meets, and there in the least of its common keys."""

    def __init__(self, cell: int, ids: np.ndarray, weight: np.ndarray, own: np.ndarray | None, raw: np.ndarray, cells: np.ndarray, search: Search, threshold: float):
        self.ids, self.weight, self.own, self.raw, self.threshold = ids, weight, own, raw, threshold
        m, dim = raw.shape
        self.norm, self.x = np.zeros(m), np.zeros((m, dim), np.float32)
        tables = search.widths if m > PLAIN else []
        v = np.zeros((m, search.projection.shape[1]), np.float32) if tables else None
        for s in range(0, m, 8192):
            part = raw[s : s + 8192].astype(np.float64)
            self.norm[s : s + 8192] = np.linalg.norm(part, axis=1)
            part /= self.norm[s : s + 8192, None]
            self.x[s : s + 8192] = part
            if tables:
                v[s : s + 8192] = (part - search.mean) @ search.projection
        codes = _tables(v, tables) if tables else []
        self.home, self.mask = [h for h, _ in codes], [k for _, k in codes]
        self.base = [h & ~k for h, k in codes]
        self.signs, self.apart = _signs(v) if tables else None, search.apart
        self.before = np.where(cells < cell, cells, -1)
        self.same = [
            range(t, min(t + CELLS, cells.shape[1])) for t in range(0, cells.shape[1], CELLS) if (self.before[:, t : t + CELLS] >= 0).any()
        ]
        # What rounding to single precision can change.
        self.doubt = 1e-6 + dim * 1.2e-7
        self.links, self.root, self.waiting, self.held = np.zeros(m, np.int64), np.arange(m), [], 0

    def find(self) -> None:
        m = len(self.ids)
        if not self.home:
            self.bucket(np.arange(m), -1, 0)
            return
        for t, (base, mask) in enumerate(zip(self.base, self.mask)):
            keys, rest = base[:, None], mask.copy()
            for _ in range(UNSURE):
                bit = rest & (~rest + rest.dtype.type(1))  # the lowest one left; none in narrow parts
                rest ^= bit
                keys = np.concatenate([keys, keys | bit[:, None]], axis=1) if bit.any() else keys
            every = keys.ravel()
            order = np.argsort(every, kind="stable")
            every, rows = every[order], order // keys.shape[1]
            cuts = np.flatnonzero(np.r_[True, every[1:] != every[:-1], True])
            sizes = np.diff(cuts)
            for g in np.flatnonzero(sizes > LISTED):
                self.bucket(rows[cuts[g] : cuts[g + 1]], t, every[cuts[g]])
            left = np.repeat(cuts[1:], sizes) - np.arange(len(rows))  # rows of the key from here on
            left[np.repeat(sizes > LISTED, sizes)] = 0
            signs, live, off, held, some = self.signs[rows], np.flatnonzero(left > 1), 1, [], 0
            while len(live):
                if 2 * len(live) > len(rows):
                    i = np.flatnonzero(np.bitwise_count(signs[:-off] ^ signs[off:]) <= self.apart)
                    i = i[left[i] > off]
                else:
                    i = live[np.bitwise_count(signs[live] ^ signs[live + off]) <= self.apart]
                held.append((rows[i], rows[i + off], every[i]))
                some += len(i)
                off += 1
                live = live[left[live] > off]
                if some > 1 << 18 or not len(live):
                    self.listed(t, *(np.concatenate(z) for z in zip(*held)))
                    held, some = [], 0

    def settled(self, members: np.ndarray, t: int, key: int) -> np.ndarray:
        """The largest set found of members of which each two have met before, or meet at a lesser key."""
        sets = []
        if t >= 0:
            extra = self.mask[t][members] & key
            sets = [extra & extra.dtype.type(1 << b) != 0 for b in range(int(key).bit_length())]
        for s in range(t):
            values, counts = np.unique(self.base[s][members], return_counts=True)
            sets.append(((self.home[s][members] ^ values[counts.argmax()]) & ~self.mask[s][members]) == 0)
        before = self.before[members]
        values, counts = np.unique(before[before >= 0], return_counts=True)
        if len(values):
            sets.append((before == values[counts.argmax()]).any(axis=1))
        return max(sets, key=np.count_nonzero, default=np.zeros(len(members), bool))

    def met(self, a: np.ndarray, b: np.ndarray, t: int, key: int | np.ndarray) -> np.ndarray:
        """Which of the pairs of a and b, broadcast, count in another table or at another key."""
        out = (self.base[t][a] | self.base[t][b]) != key if t >= 0 else np.zeros(np.broadcast_shapes(a.shape, b.shape), bool)
        for s in range(t):
            out |= ((self.home[s][a] ^ self.home[s][b]) & ~(self.mask[s][a] | self.mask[s][b])) == 0
        return out

    def elsewhere(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs of a and b, broadcast, count in another cell or block."""
        out = self.own[a] == self.own[b] if self.own is not None else np.zeros(np.broadcast_shapes(a.shape, b.shape), bool)
        for columns in self.same:
            for p, q in itertools.product(columns, columns):
                one = self.before[a, p]
                out |= (one == self.before[b, q]) & (one >= 0)
        return out

    def bucket(self, members: np.ndarray, t: int, key: int) -> None:
        m = rows = len(members)
        if m > LISTED:
            settled = self.settled(members, t, key)
            members, rows = np.concatenate([members[~settled], members[settled]]), m - int(np.count_nonzero(settled))
        x = self.x[members]
        at = 0
        while at < rows:
            end = min(rows, at + max(1, PRODUCTS // (m - at)))
            near = x[at:end] @ x[at:].T
            hit = near >= self.threshold - self.doubt
            if (found := np.count_nonzero(hit)) > end - at:  # a vector is near itself
                h, others = members[at:end], members[at:]
                if found > hit.size // 16:
                    self.dense(h, others, near, hit, t, key)
                else:
                    i, j = np.nonzero(hit)
                    i, j = i[i < j], j[i < j]
                    a, b, near = h[i], others[j], near[i, j]
                    on = ~self.met(a, b, t, key)
                    self.linked(a[on], b[on], near[on])
            at = end

    def listed(self, t: int, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> None:
        """Pairs of rows that meet, each at its key."""
        on = (self.base[t][a] | self.base[t][b]) == key
        a, b, key = a[on], b[on], key[on]
        on = ~self.met(a, b, t, key)
        a, b = a[on], b[on]
        for s in range(0, len(a), 8192):
            p, q = a[s : s + 8192], b[s : s + 8192]
            near = np.einsum("ij,ij->i", self.x[p], self.x[q])
            on = near >= self.threshold - self.doubt
            if on.any():
                self.linked(p[on], q[on], near[on])

    def linked(self, a: np.ndarray, b: np.ndarray, near: np.ndarray) -> None:
        on = np.flatnonzero(~self.elsewhere(a, b))
        on = on[self.sure(a[on], b[on], near[on])]
        a, b = a[on], b[on]
        np.add.at(self.links, a, self.weight[b])
        np.add.at(self.links, b, self.weight[a])
        self.wait(a, b)

    def sure(self, a: np.ndarray, b: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Which pairs are near in double precision."""
        out = np.ones(len(a), bool)
        doubt = np.flatnonzero(near < self.threshold + self.doubt)
        for s in range(0, len(doubt), 8192):
            d = doubt[s : s + 8192]
            p, q = a[d], b[d]
            cosine = np.einsum("ij,ij->i", self.raw[p].astype(np.float64) / self.norm[p, None], self.raw[q].astype(np.float64) / self.norm[q, None])
            out[d] = cosine >= self.threshold
        return out

    def dense(self, h: np.ndarray, others: np.ndarray, near: np.ndarray, hit: np.ndarray, t: int, key: int) -> None:
        """Many near pairs: as a matrix, not as a list."""
        hit[:, : len(h)] &= np.tri(len(h), k=-1, dtype=bool).T
        hit &= ~self.met(h[:, None], others[None, :], t, key)
        hit &= ~self.elsewhere(h[:, None], others[None, :])
        i, j = np.nonzero(hit & (near < self.threshold + self.doubt))
        on = self.sure(h[i], others[j], near[i, j])
        hit[i[~on], j[~on]] = False
        # A row stands once in each list.
        self.links[h] += hit @ self.weight[others]
        self.links[others] += self.weight[h] @ hit
        i, j = np.nonzero(hit & (self.root[h][:, None] != self.root[others][None, :]))
        self.wait(h[i], others[j])

    def wait(self, a: np.ndarray, b: np.ndarray) -> None:
        self.waiting.append((a, b))
        self.held += len(a)
        if self.held > 1 << 18:
            self.join()

    def join(self) -> None:
        """The least row of each component becomes its root."""
        if self.waiting:
            a, b = (np.concatenate(z) for z in zip(*self.waiting))
            self.waiting, self.held = [], 0
            while len(a):
                p, q = self.root[a], self.root[b]
                on = p != q
                a, b, p, q = a[on], b[on], p[on], q[on]
                np.minimum.at(self.root, np.maximum(p, q), np.minimum(p, q))
                while ((up := self.root[self.root]) != self.root).any():
                    self.root = up

    def out(self) -> pa.RecordBatch:
        self.find()
        self.join()
        least = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(least, self.root, self.ids)
        has = self.links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[has]), pa.array(self.links[has]), pa.array(least[self.root][has])], names=["id", "links", "root"]
        )


def _linked(keyed: DataFrame, sizes: DataFrame | None, search: Search, threshold: float, tables: range, turn: int, turns: int) -> DataFrame:
    """id, links (weighted by copies), root: partial results of the blocks of the cells of these tables, of one turn of several.
    sizes: the pieces of each cell that is cut, if any is.

    A pair counts in one block only, so nothing needs to be made distinct, and only one row a vector
    leaves a block, with the least vector of its component in the block.
    """
    cells = F.slice("cells", CELLS * tables.start + 1, CELLS * len(tables))
    if turns > 1:
        cells = F.filter(cells, lambda c: F.pmod(F.xxhash64(c), F.lit(turns)) == turn)
    # Only the cells up to its own say whether a pair has met before.
    rows = keyed.select("id", "n", "vector", F.slice("cells", 1, CELLS * tables.stop).alias("cells"), F.explode(cells).alias("cell"))
    if sizes is None:
        cut = rows.select("*", *[F.lit(0).alias(c) for c in ("own", "i", "j")])
    else:
        cut = rows.join(F.broadcast(sizes.withColumnRenamed("cell", "_cell")), F.col("cell") == F.col("_cell"), "left")
        n = F.coalesce("pieces", F.lit(1))
        own = F.pmod(F.xxhash64("id"), n).cast("int")
        cut = cut.select("cell", "id", "n", "vector", "cells", own.alias("own"), F.explode(F.sequence(F.lit(0), n - 1)).alias("other"))
        cut = cut.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("other")

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        m = sum(b.num_rows for b in rows)
        if m < 2:
            return None
        get = lambda name: np.concatenate([b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for b in rows])
        raw = []
        for b in rows:
            column = b.column(b.schema.get_field_index("vector")).cast(pa.binary())
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            raw.append(np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float32).reshape(len(column), -1))
        cells = np.concatenate([b.column(b.schema.get_field_index("cells")).flatten().to_numpy(zero_copy_only=False) for b in rows]).reshape(m, -1)
        cross = get("i")[0] != get("j")[0]
        return Block(int(get("cell")[0]), get("id"), get("n"), get("own") if cross else None, np.concatenate(raw), cells, search, threshold).out()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cell", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, e in zip(cuts, cuts[1:]):
                if e == a:
                    continue
                key = tuple(keys[:, a])
                if held and key != last:
                    if (out := block(held)) is not None:
                        yield out
                    held = []
                held.append(batch.slice(a, e - a))
                last = key
        if held and (out := block(held)) is not None:
            yield out

    together = cut.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return together.mapInArrow(run, "id bigint, links bigint, root bigint")


def _searched(vectors: DataFrame, n: int, dim: int, threshold: float, last: Callable[[], None]) -> tuple[DataFrame, DataFrame]:
    """id and links, id and component of the linked ones of n different vectors of one length. last is
    called when the vectors are read no more. Only some rows lie in the shuffle at a time."""
    sample = vectors.orderBy("_h").limit(FIT_VECTORS).select("vector").toArrow().column("vector").combine_chunks()
    search = fit(_matrix(sample), n, threshold)
    keyed = stored(_with_cells(vectors, search), "vectors")
    last()
    counts = keyed.select(F.explode("cells").alias("cell")).groupBy("cell").count().where(F.col("count") > BLOCK)
    sizes = stored(counts.select("cell", F.ceil(2 * F.col("count") / BLOCK).cast("int").alias("pieces")), "sizes")
    sizes = None if sizes.isEmpty() else sizes
    # All tables at once if their rows are few, else one after the other, and in turns.
    count = max(1, len(search.turns))
    row, most = 4 * (dim + CELLS * count) + 64, max(AT_ONCE, SHARE * n * 4 * dim)
    turns = math.ceil(n * CELLS * row / most)
    together = max(1, int(most // (n * CELLS * row)))
    found = None
    for start in range(0, count, together):
        for turn in range(turns):
            part = stored(_linked(keyed, sizes, search, threshold, range(start, min(count, start + together)), turn, turns), "links")
            found = part if found is None else found.unionByName(part)
    forget(keyed)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    return links, components(found, "id", "root").select(F.col("node").alias("id"), "component")


def near_duplicates(table: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """Adds n_links, component_id and kept to all rows; columns of these names are replaced.

    Equal vectors are one vector with a number of copies. Vectors that are NULL, zero or not
    finite, and rows without an id have no links; vectors of different lengths are not linked. An
    empty table stays empty. Pairs are found if they share a cell and some part of their codes agrees
    but for its unsure bits; cells and parts are fitted so that at any number of vectors at most MISS of
    the pairs at the threshold are not. Eager: a rotation per length is fitted on the FIT_VECTORS
    distinct vectors of smallest hash, which go to the driver, and components take some rounds.
    """
    keep = [c for c in table.columns if c not in ("n_links", "component_id", "kept")]
    rows = table.select(*[F.col(f"`{c}`") for c in keep]).withColumns(
        {"_v": F.when(F.col(id).isNotNull() & usable(F.col(vector)), F.col(vector).cast("array<float>"))}
    )
    # Rows find their vector again by 128 bits of hash; the vector itself does not move twice.
    rows = rows.withColumns({"_h": F.when(F.col("_v").isNotNull(), F.xxhash64("_v")), "_g": F.xxhash64(F.lit(1), "_v")})
    distinct = rows.where("_v is not null").groupBy("_h", "_g", F.col("_v").alias("vector")).agg(F.min(id).cast("bigint").alias("id"), F.count("*").alias("n"))
    every = stored(distinct, "vectors")
    known = stored(every.select("_h", "_g", "id", "n", F.size("vector").alias("_d")), "copies")
    # Vectors of each length are a table of their own: few lengths, whatever the number of rows. The last is the largest.
    lengths = [r for r in known.groupBy("_d").agg(F.count("*").alias("k")).orderBy("k", "_d").collect() if r["k"] > 1]
    links = roots = None
    for r in lengths:
        last = (lambda: forget(every)) if r is lengths[-1] else (lambda: None)
        found = [x.withColumn("_d", F.lit(r["_d"])) for x in _searched(every.where(F.size("vector") == r["_d"]), r["k"], r["_d"], threshold, last)]
        links, roots = found if links is None else (links.unionByName(found[0]), roots.unionByName(found[1]))
    if links is None:
        known = known.withColumns({"links": F.lit(0).cast("bigint"), "component": F.col("id")})
    else:
        known = known.join(links, ["id", "_d"], "left").join(roots, ["id", "_d"], "left")
    known = known.select(
        F.col("_h").alias("_kh"), F.col("_g").alias("_kg"), F.col("id").alias("_kid"), F.col("n").alias("_kn"),
        F.col("links").alias("_klinks"), F.col("component").alias("_kcomponent"),
    )
    joined = rows.join(known, (F.col("_h") == F.col("_kh")) & (F.col("_g") == F.col("_kg")), "left")
    component = F.coalesce("_kcomponent", F.col("_kid"), F.col(id))
    return joined.select(
        *[joined[f"`{c}`"] for c in keep],
        F.coalesce(F.col("_kn") - 1 + F.coalesce(F.col("_klinks"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"),
        F.coalesce(component == F.col(id), F.lit(True)).alias("kept"),
    )
