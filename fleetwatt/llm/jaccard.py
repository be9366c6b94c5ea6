"""Exact Jaccard links between documents, by a token-group matrix.

Each document is its set of word n-grams (64-bit hashes). Documents with equal sets are one. A
global order puts n-grams of rarely hit counters first; two sets that link share SHARED n-grams in
their prefixes of that order, which are SHARED - 1 longer than those that share one. First every set is compared with one likely partner, the first set
of some shared prefix n-gram; what links forms groups. Then the matrix (n-gram, group) holds the
prefix n-grams of each group's members, and a set meets a group of another component if they share
as many. Members of such groups are compared by sketches first: a sketch has the parities of the
counts of n-grams in its cells, so no more bits differ than there are n-grams that only one set has.
Sets of one component are never compared again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwatt.llm.components import components
from fleetwatt.llm.steps import stored

WIDTH = 3
PERCENT = 90
#: Counters of n-grams: a fixed number, whatever the input.
CELL_BITS = 18
#: N-grams that the prefixes of two sets that link share, if the sets have so many.
SHARED = 8
#: 64-bit words of the sketch of a set of up to SKETCHED n-grams; twice as many for each doubling of it.
SKETCH_WORDS = 8
SKETCHED = 1024
CACHED_WORDS = 400_000
#: Bits of the map of the documents that are compared, 64 in a row: a fixed number, whatever the input.
MAP_BITS = 24
#: Sets that are compared with one other set in the same task.
MEMBERS = 1000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; A-Z are lower-cased. With fewer words, the whole
    sequence is the only one; none for no words or NULL."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    out = h[: len(h) - width + 1]
    for k in range(1, width):
        out = _mix(out) + h[k : len(h) - width + 1 + k]
    return np.unique(_mix(out))


def sketch(grams: np.ndarray) -> np.ndarray:
    """Whether an odd number of the n-grams falls in each cell, as 64-bit words."""
    bits = 64 * SKETCH_WORDS
    while bits * SKETCHED < len(grams) * 64 * SKETCH_WORDS:
        bits *= 2
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _differ(a: Column, b: Column) -> Column:
    """Bits that differ between two sketches, one of which may be twice as long; 0 for other lengths."""
    xor = lambda x, y: x.bitwiseXOR(y)

    def fold(x: Column, other: Column) -> Column:
        half = F.call_function("div", F.size(x), F.lit(2)).cast("int")
        return F.when(F.size(x) > F.size(other), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), xor)).otherwise(x)

    x, y = fold(a, b), fold(b, a)
    bits = F.aggregate(F.zip_with(x, y, lambda i, k: F.bit_count(xor(i, k))), F.lit(0), lambda n, i: n + i)
    return F.when(F.size(x) == F.size(y), bits).otherwise(0)


def _folded(sketch: Column, word: int) -> Column:
    """One of the two words of a sketch that is folded to 128 bits."""
    return F.aggregate(F.filter(sketch, lambda x, i: i.bitwiseAND(F.lit(1)) == word), F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseXOR(x))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*(x.view(np.int64) for x in arrays), np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat))


def _sets(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """doc_id, n, two hashes and a sketch of each set; and, with a cell, counts of its n-grams' cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            n, a, b, hit, marks = [], [], [], [], []
            for t in batch.column(1):
                s = shingles(t.as_py(), width)
                key = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                a.append((key >> 64) - (1 << 63))
                b.append((key & ((1 << 64) - 1)) - (1 << 63))
                hit.append(s >> np.uint64(64 - CELL_BITS))
                marks.append(sketch(s))
            if n:
                cells += np.bincount(np.concatenate(hit).astype(np.int64), minlength=len(cells))
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), none, none, _lists(marks)], names=names)
        hit = np.flatnonzero(cells)
        none = pa.nulls(len(hit), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(hit), pa.array(cells[hit]), pa.nulls(len(hit), pa.list_(pa.int64()))], names=names)

    names = ["doc_id", "n", "a", "b", "cell", "hits", "sketch"]
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, n bigint, a bigint, b bigint, cell bigint, hits bigint, sketch array<bigint>"
    )


def _per_document(docs: DataFrame, doc_id: str, text: str, make, schema: str) -> DataFrame:
    """doc_id and what make(text) gives: an array of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                made = [make(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(made)], names=["doc_id", "grams"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _asked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """All docs of pairs and few others: only those move. Their ids are marked in a map of fixed size."""
    cell = F.xxhash64("id").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), cell.bitwiseAND(F.lit(63)).cast("int"))
    ids = pairs.select(F.explode(F.array("lead", "q")).alias("id"))
    words = np.zeros(1 << MAP_BITS - 6, np.int64)
    for row in ids.groupBy(F.shiftright(cell, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toLocalIterator():
        words[row[0]] = row[1]

    @F.arrow_udf("boolean")
    def marked(cells: pa.Array) -> pa.Array:
        at = np.asarray(cells)
        return pa.array(words[at >> 6] >> (at & 63) & 1 == 1)

    return docs.where("doc_id is not null").where(marked(F.xxhash64("doc_id").bitwiseAND(F.lit((1 << MAP_BITS) - 1))))


def _linked(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs (lead, q) whose sets link. A lead's set is sent once to each thousand partners."""
    sizes = pairs.groupBy("lead").count().select(F.col("lead").alias("_lead"), F.ceil(F.col("count") / MEMBERS).cast("int").alias("n"))
    leads = sizes.select(
        F.col("_lead").alias("id"), F.col("_lead").alias("lead"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"), F.lit(0).alias("role")
    )
    members = pairs.join(sizes, F.col("lead") == F.col("_lead")).select(
        F.col("q").alias("id"), "lead", F.pmod(F.xxhash64("q"), F.col("n")).cast("int").alias("part"), F.lit(1).alias("role")
    )
    # A text is turned into its set once, for all comparisons that it takes part in.
    asked = leads.unionByName(members).groupBy("id").agg(F.collect_list(F.struct("lead", "part", "role")).alias("to"))
    texts = _asked(docs, pairs).join(asked, F.col("doc_id") == F.col("id")).select("doc_id", "text", "to.lead", "to.part", "to.role")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, lead, part, role in zip(*(batch.column(i) for i in range(5))):
                grams, n = shingles(text.as_py(), width), len(lead.values)
                yield pa.RecordBatch.from_arrays(
                    [lead.values, part.values, role.values, pa.array([doc.as_py()] * n, pa.int64()), pa.array([grams.tobytes()] * n, pa.binary())],
                    names=["lead", "part", "role", "q", "grams"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first = None, []
        for batch in batches:
            left, right = [], []
            for lead, part, role, q, grams in zip(*(batch.column(i).to_pylist() for i in range(5))):
                grams = np.frombuffer(grams, np.uint64)
                if role == 0:
                    if key != (lead, part):
                        key, first = (lead, part), []
                    first.append(grams)
                    continue
                for other in first:
                    at = np.minimum(np.searchsorted(other, grams), len(other) - 1)
                    both = int((other[at] == grams).sum())
                    if 100 * both >= percent * (len(other) + len(grams) - both):
                        left.append(lead)
                        right.append(q)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["lead", "q"])

    rows = texts.mapInArrow(sets, "lead bigint, part int, role int, q bigint, grams binary")
    ordered = rows.repartition("lead", "part").sortWithinPartitions("lead", "part", "role")
    return ordered.mapInArrow(compare, "lead bigint, q bigint")


def similar_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two documents link when 100 * |both| >= percent * |either|; component_id is the smallest
    doc_id that links reach, the document's own included. Documents without words, and NULL texts,
    have no n-gram and link with nothing. A row without an id has n_shingles and no component.
    Ids are taken to identify texts; repeated rows stay and are one document. Exact up to
    equal 64-bit hashes of different n-grams. Eager: intermediate tables are stored.
    """
    found = stored(_sets(docs, doc_id, text, width), "sets")
    counts = np.zeros(1 << CELL_BITS, np.int64)
    for row in found.where("cell is not null").groupBy("cell").agg(F.sum("hits").alias("hits")).toLocalIterator():
        counts[row[0]] = row[1]
    documents = found.where("cell is null").select("doc_id", "n", "a", "b")
    named = found.where("cell is null and doc_id is not null and n > 0")
    kept = [F.min("doc_id").alias("sid"), F.first("n").alias("n"), F.first("sketch").alias("sketch")]
    distinct = stored(named.groupBy("a", "b").agg(*kept), "distinct")

    def prefix(t: str | None) -> np.ndarray:
        s = shingles(t, width)
        least = -(-percent * len(s) // 100)
        size = len(s) - least + min(SHARED, least)
        return s[np.lexsort((s, counts[s >> np.uint64(64 - CELL_BITS)]))[:size]]

    schema = "doc_id bigint, grams array<bigint>"
    tokens = _per_document(docs, doc_id, text, prefix, schema).join(distinct.select("sid", "n"), F.col("doc_id") == F.col("sid")).select(
        F.explode("grams").alias("gram"), "sid", F.col("n").cast("int").alias("n")
    )
    # All that follows on one n-gram happens where the n-gram is: one exchange.
    tokens = tokens.repartition("gram")
    shared = tokens.groupBy("gram").agg(F.count("*").alias("_c")).where("_c > 1").select(F.col("gram").alias("_gram"))
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent))
    first = F.min_by(F.struct(F.col("sid").alias("lead"), F.col("n").alias("ln")), "sid").over(Window.partitionBy("gram", band))
    posts = tokens.join(shared, F.col("gram") == F.col("_gram")).drop("_gram").withColumn("x", first)
    posts = stored(posts.select("gram", "sid", "n", "x.lead", "x.ln"), "posts")

    # One likely partner each: the first set with most of the shared n-grams. This only finds
    # groups early; whatever it misses is met below.
    fits = (100 * F.least("n", "ln") >= percent * F.greatest("n", "ln")) & (F.col("lead") != F.col("sid"))
    least_n = lambda n: F.ceil(percent * n / 100)
    best = (
        posts.where(fits).groupBy("sid", "n", "lead").count()
        .where(F.col("count") >= F.least(F.lit(SHARED), least_n(F.col("n"))))
        .groupBy("sid").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("lead"))
        .select("lead", F.col("sid").alias("q"))
    )
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    edges = stored(_linked(stored(best, "best"), texts, width, percent), "edges")

    # Groups are what is linked so far. A set that is in none is a group of its own.
    group_of = components(edges, "lead", "q").select(F.col("node").alias("_node"), F.col("component").alias("grp"))
    sized = distinct.select("sid", F.col("n").cast("int").alias("n"), "sketch")
    members = sized.join(group_of, F.col("sid") == F.col("_node"), "left").withColumn("grp", F.coalesce("grp", "sid"))
    # Two words of each sketch go with its n-grams. Of a group, the bits that all members or none have count.
    halves = [_folded(F.col("sketch"), 0).alias("even"), _folded(F.col("sketch"), 1).alias("odd")]
    whose = members.select(F.col("sid").alias("_sid"), "n", "grp", *halves)
    placed = posts.select("gram", "sid").join(whose, F.col("sid") == F.col("_sid")).drop("_sid")
    here = stored(placed, "placed").repartition("gram")
    ends = [f(c).alias(f"{kind}_{c}") for c in ("even", "odd") for kind, f in (("all", F.bit_and), ("any", F.bit_or))]
    matrix = here.groupBy(F.col("gram").alias("_gram"), F.col("grp").alias("_grp")).agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"), *ends)
    apart = sum(
        (F.bit_count(F.col(f"all_{c}").bitwiseAND(F.bitwise_not(F.col(c)))) + F.bit_count(F.col(c).bitwiseAND(F.bitwise_not(F.col(f"any_{c}")))) for c in ("even", "odd")),
        F.lit(0),
    )
    reachable = (100 * F.col("n") >= percent * F.col("least_n")) & (100 * F.col("most_n") >= percent * F.col("n"))
    reachable = reachable & ((100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("most_n")))
    met = (
        here.join(matrix, (F.col("gram") == F.col("_gram")) & (F.col("_grp") < F.col("grp")) & reachable)
        .groupBy("sid", "n", F.col("_grp").alias("grp")).agg(F.min("least_n").alias("least_n"), F.count("*").alias("c"))
        .where(F.col("c") >= F.least(F.lit(SHARED), least_n(F.col("n")), least_n(F.col("least_n"))))
    )
    met = stored(met.select(F.col("sid").alias("q"), F.col("grp").alias("_grp")), "met")

    # Of the groups a set meets, only members whose sketches differ little are compared with it.
    ours = met.join(sized, F.col("q") == F.col("sid")).select("q", F.col("n").alias("qn"), F.col("sketch").alias("ours"), "_grp")
    few = (100 + percent) * _differ(F.col("sketch"), F.col("ours")) <= (100 - percent) * (F.col("n") + F.col("qn"))
    near = (100 * F.least("n", "qn") >= percent * F.greatest("n", "qn")) & few
    inside = members.join(ours, (F.col("grp") == F.col("_grp")) & near)
    pairs = stored(inside.select(F.col("sid").alias("lead"), "q"), "pairs")
    every = edges.unionByName(_linked(pairs, texts, width, percent))
    final = components(every, "lead", "q").select(F.col("node").alias("_node"), "component")
    known = distinct.join(final, F.col("sid") == F.col("_node"), "left").select(
        F.col("a").alias("_a"), F.col("b").alias("_b"), F.coalesce("component", "sid").alias("component")
    )
    labelled = documents.join(known, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")) & F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
