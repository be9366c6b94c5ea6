"""Spelling variants: words at edit distance one, by search schemes on bidirectional FM-indexes.

A word near another one holds one of its two halves unchanged, as a prefix or as a suffix. So words are
sent to shards by such halves, and each shard has an FM-index over its delimited words and another one
over the same text reversed. A search matches a half exactly, with the delimiter at its outer end, and
extends across the other half with one error. Each step keeps the two suffix-rank intervals in
step, so that it can go on at either end. All searches of a shard advance together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.llm.steps import stored

SHORTEST = 6  # code points of a word
LEAST = 5  # occurrences of a word
TIMES = 5  # how much commoner a form is than its variant
SHARD_WORDS = 20_000
CELLS = 200_000  # symbols of the searches that advance together
SALTS = 8
# The letters of words, and those that are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX, SUFFIX = 0, 1


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 199) -> DataFrame:
    """word, n: occurrences of the words of all texts, some with a planted error.

    Runs of letters are lower-cased in A to Z. Where `every` divides the checksum of `<doc_id>:<run>`, the
    letter at the checksum modulo the length is missing. A NULL id is written as nothing, a NULL text has no words.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))
    run = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("_run"))
    run = run.withColumn("_h", F.crc32(F.concat_ws(":", "_id", "_run").cast("binary")))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    word = F.when(F.col("_h") % every == 0, cut).otherwise(F.col("_run"))
    counted = run.select(word.alias("word")).where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST)


# --- routing ----------------------------------------------------------------------------------


def _halves(word: Column, lengths: list[Column]) -> Column:
    """The prefixes and suffixes that are halves of words of some lengths."""
    front = [F.struct(F.lit(PREFIX).alias("side"), F.left(word, n.cast("int")).alias("half")) for n in [F.floor(x / 2) for x in lengths]]
    back = [F.struct(F.lit(SUFFIX).alias("side"), F.right(word, n.cast("int")).alias("half")) for n in [F.ceil(x / 2) for x in lengths]]
    return F.array_distinct(F.array(*front, *back))


def near_pairs(vocabulary: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, near, near_n: all pairs of different words at edit distance one, in both directions.

    vocabulary: word (each once), n. A half with more words than an index holds is cut in blocks, of
    indexed words and of searches; each block of searches meets each index.
    """
    length = F.length("word")
    texts = vocabulary.select("word", "n", F.explode(_halves(F.col("word"), [length - 1, length, length + 1])).alias("_s")).select("word", "n", "_s.*")
    searches = vocabulary.select("word", "n", F.explode(_halves(F.col("word"), [length])).alias("_s")).select("word", "n", "_s.*")
    counts = texts.groupBy("side", "half").agg(F.count("*").alias("_k"))
    hot = stored(counts.where(F.col("_k") > shard_words), "hot_halves")
    hot = hot.select("side", "half", F.ceil(F.col("_k") / shard_words).cast("int").alias("_blocks"))
    hot = hot.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def blocked(rows: DataFrame) -> DataFrame:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
        return salted.join(hot, ["side", "half", "_salt"], "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))

    own, every = F.pmod(F.xxhash64(F.lit(1), "word"), F.col("_blocks")).cast("int"), F.sequence(F.lit(0), F.col("_blocks") - 1)
    indexed = blocked(texts).withColumn("_i", own).withColumn("_j", F.explode(every)).withColumn("search", F.lit(False))
    asked = blocked(searches).withColumn("_j", own).withColumn("_i", F.explode(every)).withColumn("search", F.lit(True))
    total = vocabulary.count()
    shards = max(1, -(-4 * total // shard_words))
    # A hot half has shards of its own; the others share the rest.
    to = F.when(F.col("_blocks") > 1, F.concat_ws(":", "side", "half", "_i", "_j")).otherwise(F.pmod(F.xxhash64("side", "half"), F.lit(shards)).cast("string"))
    rows = indexed.unionByName(asked).select(to.alias("shard"), "word", "n", "side", "search")
    found = rows.groupBy("shard").applyInArrow(_search_shard, "word string, near string, near_n bigint")
    return found.distinct()


# --- one shard -----------------------------------------------------------------------------------


def _suffixes(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of symbols below `symbols`, by ranks of packed and then of doubled prefixes."""
    n, bits = len(text), max(int(symbols).bit_length(), 1)
    span = 62 // bits
    padded, key = np.r_[text, np.zeros(span, np.int64)], np.zeros(n, np.int64)
    for k in range(span):
        key = key << bits | padded[k : k + n]
    while True:
        values, rank = np.unique(key, return_inverse=True)
        if len(values) == n:
            return np.argsort(rank)
        key = rank * (n + 1) + np.r_[rank[span:] + 1, np.zeros(min(span, n), np.int64)]
        span *= 2


class _Ranks:
    """Suffix array and, before each rank and for each symbol, how many smaller ones precede suffixes."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.array = _suffixes(text, symbols)
        before = text[self.array - 1]
        self.less = np.zeros((len(text) + 1, symbols + 1), np.int32)
        for c in range(1, symbols + 1):
            np.cumsum(before < c, out=self.less[1:, c])
        self.first = self.less[-1]

    def extend(self, at, other, size, symbol):
        """Intervals here, in the other index, and their sizes, after one more symbol on this side."""
        low, low_next = self.less[at, symbol], self.less[at, symbol + 1]
        high, high_next = self.less[at + size, symbol], self.less[at + size, symbol + 1]
        held = low_next - low
        return self.first[symbol] + held, other + (high - low), (high_next - high) - held


class _Index:
    """Bidirectional FM-index over words, each between two delimiters."""

    def __init__(self, words: list[str], others: list[str]):
        joined = "#" + "#".join(words) + "#"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        extra = np.frombuffer("".join(others).encode("utf-32-le"), np.uint32)
        self.letters = np.union1d(points, extra)  # the delimiter is the least
        text = np.searchsorted(self.letters, points) + 1
        self.symbols = len(self.letters) + 1
        self.left = _Ranks(np.r_[text, 0], self.symbols)
        self.right = _Ranks(np.r_[text[::-1], 0], self.symbols)
        self.starts = np.flatnonzero(text == 1)[:-1]
        self.size = len(text) + 1

    def codes(self, words: list[str]) -> np.ndarray:
        """Symbols of words, one per row, filled up with -1."""
        sizes = np.array([len(w) for w in words])
        out = np.full((len(words), int(sizes.max())), -1)
        out[np.arange(out.shape[1]) < sizes[:, None]] = np.searchsorted(self.letters, np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)) + 1
        return out

    def step(self, leftward: bool, state, symbol):
        """state: left interval, right interval, size."""
        a, b, size = state
        if leftward:
            return self.left.extend(a, b, size, symbol)
        b, a, size = self.right.extend(b, a, size, symbol)
        return a, b, size

    def search(self, halves: list[str], rests: list[str], leftward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of search and word number: the half is matched first, ending with the delimiter if the
        half is the end of the word that is met leftward; the rest follows on the other side with one error."""
        # Symbols in the order in which they are met.
        first = self.codes([(h[::-1] if leftward else h) + "#" for h in halves])
        rest = self.codes([r if leftward else r[::-1] for r in rests])
        asked = np.arange(len(halves))
        state = tuple(np.full(len(halves), x) for x in (0, 0, self.size))
        for k in range(first.shape[1]):
            going = first[asked, k] >= 0
            moved = self.step(leftward, tuple(x[going] for x in state), first[asked[going], k])
            for x, y in zip(state, moved):
                x[going] = y
            alive = state[2] > 0
            asked, state = asked[alive], tuple(x[alive] for x in state)
        ends = (rest >= 0).sum(1)
        pools = []

        def take(query, place, moved):
            alive = moved[2] > 0
            pools.append((query[alive], place[alive], *(x[alive] for x in moved)))

        onward = self.right if leftward else self.left
        for k in range(rest.shape[1] + 1):
            if not len(asked):
                break
            inside = k < ends[asked]
            symbol = np.where(inside, rest[asked, min(k, rest.shape[1] - 1)], 0)
            place = np.full(len(asked), k)
            take(asked[inside], place[inside] + 1, tuple(x[inside] for x in state))  # one letter less
            at = state[1] if leftward else state[0]
            below = onward.less[at]
            counts = np.diff(onward.less[at + state[2]] - below, axis=1)
            counts[:, :2] = 0  # neither the end nor the delimiter
            row, letter = np.nonzero(counts)
            moved = self.step(not leftward, tuple(x[row] for x in state), letter)
            take(asked[row], place[row], moved)  # one letter more
            other = inside[row] & (letter != symbol[row])
            take(asked[row][other], place[row][other] + 1, tuple(x[other] for x in moved))  # another letter
            asked, state, symbol = asked[inside], tuple(x[inside] for x in state), symbol[inside]
            state = self.step(not leftward, state, symbol)
            alive = state[2] > 0
            asked, state = asked[alive], tuple(x[alive] for x in state)
        if not pools:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, place, *state = (np.concatenate(x) for x in zip(*pools))
        done = []
        while len(query):
            over = place == ends[query]
            symbol = np.where(over, 1, rest[query, np.minimum(place, rest.shape[1] - 1)])
            state = self.step(not leftward, tuple(state), symbol)
            alive = state[2] > 0
            done.append((query[over & alive], state[0][over & alive]))
            keep = alive & ~over
            query, place, state = query[keep], place[keep] + 1, [x[keep] for x in state]
        query, at = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 2
        return query, np.searchsorted(self.starts, self.left.array[at])


def _alike(words: list[str]) -> Iterator[list[str]]:
    """Searches of about equal length, so that rows of symbols are filled and few."""
    words = sorted(words, key=len, reverse=True)
    at = 0
    while at < len(words):
        end = at + max(1, CELLS // len(words[at]))
        yield words[at:end]
        at = end


def _search_shard(rows: pa.Table) -> pa.Table:
    """Pairs of the searches of a shard and its indexed words."""
    held = dict(zip(*(rows.filter(pc.invert(rows["search"]))[c].to_pylist() for c in ("word", "n"))))
    words, counts = list(held), np.array(list(held.values()), np.int64)
    asked = rows.filter(rows["search"])
    left, right, common = [], [], []
    if len(words) and len(asked):
        index = _Index(words, asked["word"].to_pylist())
        for side in (PREFIX, SUFFIX):
            for some in _alike(asked.filter(pc.equal(asked["side"], side))["word"].to_pylist()):
                front, back = [w[: len(w) // 2] for w in some], [w[len(w) // 2 :] for w in some]
                query, found = index.search(front, back, True) if side == PREFIX else index.search(back, front, False)
                pairs = np.unique(query.astype(np.int64) * len(words) + found)
                query, found = pairs // len(words), pairs % len(words)
                left += [some[i] for i in query]
                right += [words[i] for i in found]
                common += counts[found].tolist()
    return pa.table([pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(common, pa.int64())], ["word", "near", "near_n"])


# --- forms -----------------------------------------------------------------------------------------


def _roots(links: DataFrame) -> DataFrame:
    """word, root of words that have a form. Pointers double: a form is TIMES as common as its word,
    so a chain has few words and the rounds are few."""
    now = stored(links.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stored(now.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "spelling_roots")
        now = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return now


def spelling_groups(vocabulary: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n, root of each word of a vocabulary (word, n; each word once).

    n_near counts the words at edit distance one. The form is the commonest of them, the least in code-point
    order if several are, provided that it is TIMES as common; else NULL. The root is what forms lead to. Words
    shorter than two letters have no near ones here. An empty vocabulary gives no rows.
    """
    words = stored(vocabulary.select("word", "n"), "spelling_words")
    pairs = near_pairs(words, shard_words)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best"))
    joined = words.join(near, "word", "left")
    common = -F.col("_best.minus") >= TIMES * F.col("n")
    formed = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(common, F.col("_best.near")).alias("form"), F.when(common, -F.col("_best.minus")).alias("form_n"),
        ),
        "spelling_forms",
    )
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
