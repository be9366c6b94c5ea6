"""Line dedup by an exact set-similarity join, in SQL functions only.

A line is the set of its words. Words are ordered by rarity: the commonest ones of the corpus come
last, by the logarithm of their count; all others come first, longer ones before shorter ones. Words
that follow each other in this order are a pair. A word that one set lacks breaks two of the other
set's pairs at most, and one that it has besides breaks one, so two sets with a Jaccard similarity of
p % share k of their first pairs; k grows with n. Few pairs occur in two sets, and only those are kept.
Sets that meet in k pairs, with fitting lengths and 64-bit signatures that differ little, are compared
by all their words, as numbers made of a length and 52 bits of a hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwatt.llm.quality import SPACE, words_of
from fleetwatt.llm.steps import forget, stored

PERCENT = 80
#: Words are counted in cells of a hash; those of the fullest cells are taken as common. Fixed numbers.
CELL_BITS = 16
COMMON = 2000
#: Bits of a word in a pair.
PAIR_BITS = 31
#: From this similarity on, sets of any size that are similar share a pair; below, single words are met.
PAIRED_PERCENT = 75
#: Sets of so many words must share one more pair; at most SHARED.
SHARE_WORDS = 24
SHARED = 8
HASH_BITS = 52
#: A line is known by its row's id, a hash of its row's text, and its position there.
ROW = ["doc", "h"]
LINE = [*ROW, "pos"]


def _word_key(word: Column) -> Column:
    """31 - length (at most 31), then 52 bits of a hash."""
    short = (F.lit(31) - F.least(F.length(word), F.lit(31))).cast("bigint")
    return F.shiftleft(short, HASH_BITS).bitwiseOR(F.xxhash64(word).bitwiseAND(F.lit((1 << HASH_BITS) - 1)))


def _words(text: Column) -> Column:
    """Words of a text, and empty strings; split at single spaces where there is no other white space."""
    return F.when(text.rlike(r"[\x09-\x0D]"), words_of(text)).otherwise(F.split(text, " "))


def _word_keys(line: Column) -> Column:
    """Distinct words as numbers."""
    return F.array_remove(F.array_distinct(F.transform(_words(line), _word_key)), _word_key(F.lit("")))


def _cell(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << CELL_BITS) - 1).cast("bigint"))


def common_words(docs: DataFrame, text: str, count: int = COMMON) -> dict[int, list[int]]:
    """The cells of the commonest words by the logarithm of their number to base 4. Counts all words,
    partly before the shuffle; only `count` rows go to the driver."""
    flat = F.replace(F.col(text), F.lit("\n"), F.lit(" "))
    words = docs.select(F.explode(_words(flat)).alias("word")).where("word != ''")
    top = words.groupBy(_cell(F.xxhash64("word")).alias("cell")).count().orderBy(F.desc("count"), "cell").limit(count).collect()
    levels: dict[int, list[int]] = {}
    for row in top:
        levels.setdefault(row["count"].bit_length() // 2 + 1, []).append(row["cell"])
    return levels


def _ordered(keys: Column, levels: dict[int, list[int]]) -> Column:
    """Keys from the rarest to the commonest: the level is above the other bits."""

    def level(key: Column) -> Column:
        chain = F.lit(0)
        for n, words in sorted(levels.items()):
            chain = F.when(_cell(key).isin(words), n).otherwise(chain)
        return F.when(_cell(key).isin([w for words in levels.values() for w in words]), chain).otherwise(0).cast("bigint")

    return F.sort_array(F.transform(keys, lambda k: F.shiftleft(level(k), HASH_BITS + 5).bitwiseOR(k)))


def _div(n: Column, by: int) -> Column:
    """Whole numbers only: pairs are tested by the million."""
    return F.call_function("div", n, F.lit(by))


def _least_overlap(n: Column, percent: int) -> Column:
    return _div(percent * n + 99, 100).cast("int")


def _broken(n: Column, percent: int) -> Column:
    """How many pairs (or single words) of a set of n words a similar set lacks at most."""
    kept = _least_overlap(n, percent)
    if percent < PAIRED_PERCENT:
        return n - kept
    # As many words as may be missing, and what may then still be added. Others break fewer.
    return 2 * (n - kept) + (_div(100 * kept, percent) - n).cast("int")


def _shared(n: Column) -> Column:
    """How many pairs of their first ones two similar sets share, the smaller one of n words, if they have so many."""
    return F.least(F.lit(SHARED), 1 + _div(n, SHARE_WORDS)).cast("int")


def _signature(words: str) -> Column:
    """64 bits, each whether an odd number of words has it: a shift takes the last six bits of its number."""
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda acc, w: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), w.bitwiseAND(F.lit(63)).cast("int"))))


def _alike(percent: int) -> Column:
    """Whether sets x and y may be similar by the bits that differ: each is a word of one set only.

    Parities tell long sets apart, too, whose words would set nearly all bits of a union.
    """
    total = F.col("x.n") + F.col("y.n")
    differ = F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits")))
    return (total - differ) * (100 + percent) >= 2 * percent * total


def _prefixes(docs: DataFrame, doc_id: str, text: str, levels: dict[int, list[int]], percent: int) -> DataFrame:
    """A row for each line with a word: doc, h, pos, its set as two hashes, the number of words, a bit signature and the first words, of which pairs are made."""
    lines = docs.select(
        *_row(doc_id, text), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line")
    ).where(F.trim(F.col("line"), F.lit(SPACE)) != "")
    sets = lines.select(*LINE, _ordered(_word_keys(F.col("line")), levels).alias("words"))
    n = F.size("words")
    first = F.slice("words", F.lit(1), _broken(n, percent) + _shared(n) + (1 if percent >= PAIRED_PERCENT else 0))
    return sets.select(
        *LINE,
        F.xxhash64("words").alias("a"),
        F.xxhash64(F.lit(1), F.col("words")).alias("b"),
        n.alias("n"),
        _signature("words").alias("bits"),
        F.transform(first, lambda w: w.bitwiseAND(F.lit((1 << PAIR_BITS) - 1).cast("bigint")).cast("int")).alias("prefix"),
    )


def _pairs(prefix: str, percent: int) -> Column:
    """Each word with the next one as a number; single words below PAIRED_PERCENT."""
    words = F.transform(prefix, lambda w: w.cast("bigint"))
    if percent < PAIRED_PERCENT:
        return words
    places = F.filter(F.sequence(F.lit(0), F.size(prefix) - 1), lambda i: i < F.size(prefix) - 1)
    return F.transform(places, lambda i: F.shiftleft(F.get(F.col(prefix), i).cast("bigint"), PAIR_BITS).bitwiseOR(F.get(F.col(prefix), i + 1).cast("bigint")))


def _near(percent: int) -> Column:
    """Whether sets x and y may be similar by their lengths."""
    return (100 * F.col("x.n") >= percent * F.col("y.n")) & (100 * F.col("y.n") >= percent * F.col("x.n"))


def _needed(percent: int) -> Column:
    """How many of their first pairs sets x and y share, if they are similar."""
    least = F.least(F.col("x.n"), F.col("y.n"))
    return F.least(_shared(least), least - (1 if percent >= PAIRED_PERCENT else 0) - _broken(least, percent))


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (x, y) of set numbers whose signatures differ little. Eager."""
    pairs = pairs.select(F.col("x").alias("_x"), F.col("y").alias("_y"))
    marks = sets.select("id", "n", "bits")
    marked = pairs.join(marks.alias("x"), F.col("_x") == F.col("x.id")).join(marks.alias("y"), F.col("_y") == F.col("y.id"))
    return stored(marked.where(_alike(percent)).select(F.col("_x").alias("x"), F.col("_y").alias("y")), "close")


def _similar(close: DataFrame, sets: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """x: those of the stored pairs (x, y) of set numbers whose words are similar to those of y. Eager; deletes close."""
    wanted = close.select(F.explode(F.array("x", "y")).alias("id")).distinct().join(sets.select("id", *LINE), "id")
    spots = wanted.groupBy(F.col("doc").alias("_doc"), F.col("h").alias("_h")).agg(F.collect_list(F.struct("pos", "id")).alias("spots"))
    texts = docs.select(*_row(doc_id, text), F.col(text).alias("_text"))
    at = texts.join(spots, (F.col("doc") == F.col("_doc")) & (F.col("h") == F.col("_h")))
    at = at.select(F.split("_text", "\n").alias("lines"), F.inline("spots"))
    words = stored(at.select("id", _word_keys(F.get(F.col("lines"), F.col("pos"))).alias("words")), "words")
    both = F.size(F.array_intersect("words", "words2"))
    near = close.join(words.withColumnRenamed("id", "x"), "x").join(words.select(F.col("id").alias("y"), F.col("words").alias("words2")), "y")
    found = stored(near.where(100 * both >= percent * (F.size("words") + F.size("words2") - both)).select("x").distinct(), "similar")
    forget(close, words)
    return found


def _place(doc_id: Column) -> Column:
    """Rows without an id come last."""
    return F.coalesce(doc_id.cast("bigint"), F.lit((1 << 63) - 1))


def _row(doc_id: str, text: str) -> list[Column]:
    """doc and h: rows without an id, or with a repeated one, are told apart by their texts."""
    return [_place(F.col(doc_id)).alias("doc"), F.xxhash64(F.col(text)).alias("h")]


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc (the id; the largest number for none), h (a hash of the text) and the positions (from 0) of the lines that go.

    A line goes if an earlier line (smaller doc_id and h, or before it in the document) has a similarity
    of at least `percent` %, whether that one stays or not. Lines without words stay.
    """
    levels = common_words(docs, text)
    lines = stored(_prefixes(docs, doc_id, text, levels, percent), "lines")

    # Each distinct set once, by its first line, with a number in the order of the first lines.
    first = F.min(F.struct(*LINE, "n", "bits", "prefix")).alias("first")
    distinct = lines.groupBy("a", "b").agg(first, F.count("*").alias("copies")).select("a", "b", "copies", "first.*")
    sets = stored(distinct.orderBy(*LINE).withColumn("id", F.monotonically_increasing_id()), "sets")
    copied = sets.where("copies > 1").select("a", "b", *[F.col(c).alias(f"{c}1") for c in LINE])
    again = lines.select("a", "b", *LINE).join(copied, ["a", "b"]).where("doc > doc1 or h > h1 or pos > pos1")
    again = stored(again.select(LINE), "again")
    forget(lines)

    # Few pairs occur in two sets; the others end here. Each set is first compared with the earliest
    # set that it shares most pairs with: one similar set before it is enough, so most copies end
    # here. Those that share too few are not compared; whatever that misses is met below.
    met = sets.select("id", "n", F.explode(_pairs("prefix", percent)).alias("w"))
    group = Window.partitionBy("w").orderBy("id")
    earliest = F.first(F.struct("id", "n")).over(group.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    asked = met.repartition("w").select("w", F.struct("id", "n").alias("x"), earliest.alias("y"), F.lead("id").over(group).alias("next"))
    asked = stored(asked.where("y.id < x.id or next is not null").select("w", "x", "y"), "met")
    best = (
        asked.where((F.col("x.id") > F.col("y.id")) & _near(percent))
        .groupBy(F.col("x.id").alias("x"), F.col("y.id").alias("y")).agg(F.count("*").alias("count"), F.first(_needed(percent)).alias("needed"))
        .where("count >= needed").groupBy("x").agg(F.max_by("y", F.struct("count", "y")).alias("y"))
    )
    best = stored(best, "best")
    close = _close(best, sets, percent)
    forget(best)
    gone = _similar(close, sets, docs, doc_id, text, percent)

    # What is left meets every earlier set that shares a pair. Sets that go are met and meet
    # none: their number is stored as its complement, which no number is below. So the pairs
    # move once, for both sides of the join.
    going = gone.select(F.col("x").alias("_gone"))
    # A number is never NULL; Spark must see it, or it filters one side and the sides differ.
    mark = F.coalesce(F.when(F.col("_gone").isNull(), F.col("id")).otherwise(F.bitwise_not("id")), F.lit(-1))
    marks = sets.join(going, F.col("id") == F.col("_gone"), "left").select(F.col("id").alias("_id"), mark.alias("mark"), "n", "bits")
    marked = asked.select("w", "x.id").join(marks, F.col("id") == F.col("_id")).select("mark", "n", "bits", "w")
    number = F.greatest(F.col("y.mark"), F.bitwise_not("y.mark"))
    may = (number < F.col("x.mark")) & _alike(percent) & _near(percent)
    pairs = marked.alias("x").join(marked.alias("y"), (F.col("x.w") == F.col("y.w")) & may)
    met = pairs.select(F.col("x.mark").alias("x"), number.alias("y"), _needed(percent).alias("needed"))
    met = met.groupBy("x", "y").agg(F.count("*").alias("met"), F.first("needed").alias("needed")).where("met >= needed")
    pairs = stored(met.select("x", "y"), "pairs")
    more = _similar(pairs, sets, docs, doc_id, text, percent)

    # Repeated lines other than the first, and first lines of sets that go.
    firsts = sets.join(gone.unionByName(more).withColumnRenamed("x", "id"), "id", "left_semi").select(LINE)
    removed = stored(again.unionByName(firsts).groupBy(ROW).agg(F.collect_set("pos").alias("positions")), "removed")
    forget(sets, asked, again, gone, more)
    return removed


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents without the lines that go; adds n_lines (with a word) and n_removed.

    All rows and other columns stay, a text may become empty, and a NULL text stays NULL with no
    lines. Rows of one id and one text are one row and keep the same lines. Rows of one id that
    differ in text are documents of their own, in the order of a hash of the text; so are rows without an
    id, which come last. Columns of the two names are replaced. Eager: intermediate tables are stored.
    """
    gone = removed_lines(docs, doc_id, text, percent).select(
        F.col("doc").alias("_doc"), F.col("h").alias("_h"), "positions"
    )
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.join(gone, (_place(F.col(doc_id)) == F.col("_doc")) & (F.xxhash64(F.col(text)) == F.col("_h")), "left")
    lines = F.split(F.col(text), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("positions"))
    left = F.transform(F.array(lines), lambda x: F.transform(stay, lambda i: x[i]))[0]
    cleaned = F.when(F.col("positions").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    worded = F.size(F.filter(lines, lambda x: F.trim(x, F.lit(SPACE)) != ""))
    return joined.select(
        *[(cleaned.alias(c) if c == text else F.col(f"`{c}`")) for c in keep],
        F.when(F.col(text).isNull(), 0).otherwise(worded).cast("bigint").alias("n_lines"),
        F.when(F.col("positions").isNull(), 0).otherwise(F.size("positions")).cast("bigint").alias("n_removed"),
    )
