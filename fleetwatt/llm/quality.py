"""Quality rules: counts of a text, and its distance from what its language looks like.

Two histograms of a text are compared with those of its language by Jensen-Shannon distance:
classes of characters, and the share of each of the language's commonest words. The references
are counted over all documents of the language, or over those of them that are near its median
document. Everything is SQL functions on whole texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.llm.steps import stored

# Common function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "with"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "im", "ein"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour"],
    "es": ["de", "la", "que", "el", "en", "los", "se", "del", "las", "un", "por", "con"],
}
N_COMMON = 12
SPACE = " \t\n\x0b\f\r"
CLASSES = ["small", "capital", "digit", "sentence_mark", "symbol", "space"]

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PCT = 30
#: Shorter texts are not compared: their histograms are mostly chance.
GUARD_CHARS = 200
GUARD_WORDS = 100
MAX_CLASS_DISTANCE = 0.31
MAX_WORD_DISTANCE = 0.25
#: How often steady references are counted: without what is far from the medians, then from the count before.
PASSES = 2


def words_of(text: Column) -> Column:
    """Runs of characters other than space and tab to carriage return; none for NULL."""
    bare = F.trim(text, F.lit(SPACE))
    return F.when(text.isNull() | (bare == ""), F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
    return F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("bigint")


def _bound(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of `width` words (a power of two) that occur twice or more.

    Windows are compared by a 64-bit hash built by doubling. Only a text with a repeat sorts them.
    """

    def joined(hashes: Column, step: int) -> Column:
        return _bound(
            hashes,
            lambda h: F.when(
                F.size(h) > step,
                F.zip_with(F.slice(h, F.lit(1), F.size(h) - step), F.slice(h, F.lit(step + 1), F.size(h) - step), lambda a, b: F.xxhash64(a, b)),
            ).otherwise(F.array().cast("array<bigint>")),
        )

    hashes, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < width:
        hashes, step = joined(hashes, step), 2 * step

    def covered(found: Column) -> Column:
        order = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = _bound(
            order,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"])
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return _bound(
            at,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.coalesce(F.least(x - F.get(p, i - 1), F.lit(width)), F.lit(width))), F.lit(0), lambda a, x: a + x
            ),
        )

    return _bound(hashes, lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), 0).otherwise(covered(h))).cast("bigint")


def _counts(text: Column, words: Column, lang: Column) -> dict[str, Column]:
    """Columns of the two histograms: c_<class> and w0 .. w11."""
    joined = F.array_join(words, "")
    rest = F.regexp_replace(joined, r"\p{L}+", "")
    letters = F.length(joined) - F.length(rest)
    capital = F.length(joined) - F.length(F.regexp_replace(joined, r"\p{Lu}+", ""))
    rest2 = F.regexp_replace(rest, "[0-9]+", "")
    mark = F.length(F.regexp_replace(rest2, "[^.,;:?'\"()-]+", ""))
    spaced = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))
    listed = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    out = {
        "c_small": letters - capital,
        "c_capital": capital,
        "c_digit": F.length(rest) - F.length(rest2),
        "c_sentence_mark": mark,
        "c_symbol": F.length(rest2) - mark,
        "c_space": F.length(F.coalesce(text, F.lit(""))) - F.length(joined),
    }
    for i in range(N_COMMON):
        word = F.concat(F.lit(" "), F.try_element_at(listed, lang)[i], F.lit(" "))
        out[f"w{i}"] = F.coalesce(
            ((F.octet_length(spaced) - F.octet_length(F.replace(spaced, word, F.lit("")))) / F.octet_length(word)).cast("int"), F.lit(0)
        )
    return {k: v.cast("bigint") for k, v in out.items()}


HISTOGRAM = [f"c_{c}" for c in CLASSES] + [f"w{i}" for i in range(N_COMMON)]


COUNTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measured(docs: DataFrame, text: str, lang: str, keep: list[str]) -> DataFrame:
    """The kept columns, _lang, the counts and the histogram of each document, stored: the one pass over the texts.

    Filters and references above read the stored numbers, so no text is measured twice.
    """
    known = F.when(F.col(lang).isin(*COMMON_WORDS), F.col(lang)).otherwise("")
    base = docs.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in keep], F.col(text).alias("_text"), known.alias("_lang"), words_of(F.col(text)).alias("_words"))
    words, body = F.col("_words"), F.col("_text")
    counts = [
        F.size(words).cast("bigint"),
        F.length(F.array_join(words, "")).cast("bigint"),
        F.coalesce(F.regexp_count(body, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("bigint"),
        duplicate_lines(body),
        repeated_words(words),
    ]
    histogram = F.struct(*[c.alias(k) for k, c in _counts(body, words, F.col("_lang")).items()])
    return stored(
        base.select(*[F.col(f"`_of_{c}`") for c in keep], "_lang", *[c.alias(k) for k, c in zip(COUNTED, counts)], histogram.alias("_h")),
        "measured_documents",
    )


def references(measured: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Mean histograms per language over all documents: at most one row per listed language and one
    for the rest is collected. Each row holds 18 sums and the number of words."""
    hist = measured.select("_lang", F.col("n_words").alias("n"), "_h.*")
    return _means(hist.groupBy("_lang").agg(*[F.sum(c).alias(c) for c in ["n", *HISTOGRAM]]).collect())


def _means(rows: list) -> dict[str, dict[str, list[float]]]:
    out = {}
    for row in rows:
        chars = [row[f"c_{c}"] for c in CLASSES]
        common = [row[f"w{i}"] for i in range(N_COMMON)]
        if sum(chars) and row["n"]:
            out[row["_lang"]] = {
                "chars": [x / sum(chars) for x in chars],
                "words": [x / row["n"] for x in common] + [1 - sum(common) / row["n"]],
            }
    return out


def js_distance(counts: Sequence[Column], total: Column, reference: Sequence[Column]) -> Column:
    """Square root of the Jensen-Shannon divergence in bits: 0 for equal shares, 1 for disjoint ones."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    terms = [part(c / total, (c / total + r) / 2) + part(r, (c / total + r) / 2) for c, r in zip(counts, reference)]
    whole = terms[0]
    for term in terms[1:]:
        whole = whole + term
    return F.sqrt(F.greatest(whole / 2, F.lit(0.0)))


def _distances(refs: dict[str, dict[str, list[float]]], count, n_words: Column) -> tuple[Column, Column]:
    """Distances of the characters and of the words; count(name) is a number of the histogram. NULL without a reference."""

    def reference(kind: str, i: int) -> Column:
        pairs = [x for k, v in refs.items() for x in (F.lit(k), F.lit(float(v[kind][i])))]
        return F.try_element_at(F.create_map(*pairs), F.col("_lang")) if pairs else F.lit(None).cast("double")

    chars = [count(f"c_{c}") for c in CLASSES]
    common = [count(f"w{i}") for i in range(N_COMMON)]
    n_chars = sum(chars[1:], chars[0])
    other = n_words - sum(common[1:], common[0])
    class_distance = js_distance(chars, n_chars, [reference("chars", i) for i in range(len(CLASSES))])
    word_distance = js_distance([*common, other], n_words, [reference("words", i) for i in range(N_COMMON + 1)])
    return F.when(n_chars >= GUARD_CHARS, class_distance), F.when((n_words >= GUARD_WORDS) & (F.col("_lang") != ""), word_distance)


def _base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PCT * n_words)


def _near(class_distance: Column, word_distance: Column) -> Column:
    return (F.coalesce(class_distance, F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (F.coalesce(word_distance, F.lit(0.0)) <= MAX_WORD_DISTANCE)


def steady_references(measured: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Mean histograms per language that a minority of junk does not move.

    Of the documents that pass the base rules and are long enough to be compared, the median of
    each share is the first centre. Means over the documents near it are the next one, PASSES
    times. Shares are rounded to thousandths for the median, so it holds 1,001 counts at most.
    """
    hist = measured.select("_lang", F.col("n_words").alias("n"), F.col("n_repeat_words").alias("repeats"), "_h.*")
    chars = sum([F.col(f"c_{c}") for c in CLASSES[1:]], F.col(f"c_{CLASSES[0]}"))
    common = sum([F.col(f"w{i}") for i in range(1, N_COMMON)], F.col("w0"))
    good = hist.where(~_base_failed(F.col("n"), F.col("repeats")) & (chars >= GUARD_CHARS))
    worded = (F.col("n") >= GUARD_WORDS) & (F.col("_lang") != "")
    median = lambda share, of: F.percentile(F.when(of, F.round(share, 3)), 0.5)
    centres = good.groupBy("_lang").agg(
        *[median(F.col(f"c_{c}") / chars, F.lit(True)).alias(f"c_{c}") for c in CLASSES],
        *[median(F.col(f"w{i}") / F.col("n"), worded).alias(f"w{i}") for i in range(N_COMMON)],
        median((F.col("n") - common) / F.col("n"), worded).alias("rest"),
    )
    refs = {}
    for row in centres.collect():
        shares = [row[f"c_{c}"] for c in CLASSES]
        listed = [0.0 if row[k] is None else row[k] for k in [*(f"w{i}" for i in range(N_COMMON)), "rest"]]
        refs[row["_lang"]] = {"chars": [x / sum(shares) for x in shares], "words": [x / (sum(listed) or 1.0) for x in listed]}
    for _ in range(PASSES):
        near = good.where(_near(*_distances(refs, F.col, F.col("n"))))
        # Words are counted where they are compared, if that is anywhere.
        sums = near.groupBy("_lang").agg(
            *[F.sum(f"c_{c}").alias(f"c_{c}") for c in CLASSES],
            *[F.coalesce(F.sum(F.when(worded, F.col(c))), F.sum(c)).alias(c) for c in ["n", *(f"w{i}" for i in range(N_COMMON))]],
        )
        refs = refs | _means(sums.collect())
    return refs


def quality(docs: DataFrame, text: str = "text", lang: str = "lang", steady: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Adds counts, base_failed, the two distances and kept; all columns of docs stay, or those of `keep`.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint); base_failed: fewer than
    20 words, or over 30 % of them in repeated windows; class_distance, word_distance: NULL under
    the length guards, and word_distance also for a language without a list; kept: neither
    base_failed nor too far. A NULL text has no words and fails; a NULL or unknown language is
    compared with all such documents' characters. Repeated rows are judged alike. Eager: one pass
    measures the texts and stores the numbers with the columns that stay; the references and the
    verdict are made from those. Columns of these names are replaced.

    The references are means over all documents, as in SQL, so they move towards junk that holds
    much of a language. With steady they are those of steady_references, which do not.
    """
    added = [*COUNTED, "base_failed", "class_distance", "word_distance", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    measured = _measured(docs, text, lang, keep)
    refs = (steady_references if steady else references)(measured)
    class_distance, word_distance = _distances(refs, lambda name: F.col(f"_h.{name}"), F.col("n_words"))
    far = measured.select(
        *[F.col(f"`_of_{c}`").alias(c) for c in keep],
        *COUNTED,
        _base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
        class_distance.alias("class_distance"),
        word_distance.alias("word_distance"),
    )
    return far.withColumn("kept", ~F.col("base_failed") & _near(F.col("class_distance"), F.col("word_distance")))
