"""Token counts of texts: only lengths leave the Arrow function."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

VOCABULARY = "piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
LONG_TEXT = 1 << 15
CACHED_WORDS = 400_000

# A piece model writes a space as \u2581 and puts one before a text. No piece holds one after
# another character, so a single space inside a text is a safe cut, unless it touches another one.
_UNSAFE = re.compile("  |^ | $|\u2581")
_WORDS: dict[str, int] = {}  # of the piece model of this Python worker


@lru_cache(maxsize=4)
def _counter(name: str):
    """texts -> numbers of tokens, and whether a part may begin inside a text."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def parts(text: str, pieces: bool, size: int = LONG_TEXT) -> Iterator[str]:
    """A long text in parts that give its tokens one after the other.

    A cut is only made at a single space between two ASCII letters: no token spans it, no
    normalisation joins its sides, and no special string holds it. A piece model puts a space
    before every text itself, so there the space at the cut is left out.
    """
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut > 0 and not (text[cut - 1 : cut].isascii() and text[cut - 1 : cut].isalpha() and text[cut + 1 : cut + 2].isascii() and text[cut + 1 : cut + 2].isalpha()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1 if pieces else cut
    yield text[start:]


def _encoded(count, words: list[str]) -> Iterator[int]:
    """Counts of words, in batches of about equal bytes."""
    ends = np.cumsum([len(w) for w in words])
    start = 0
    while start < len(words):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BATCH_BYTES)))
        yield from count(words[start:stop])
        start = stop


def _by_words(texts: list[str], count) -> np.ndarray:
    """Counts of texts whose spaces are all safe cuts: each new word is encoded once."""
    words = [t.split(" ") for t in texts]
    every = {w for x in words for w in x}
    new = list(every - _WORDS.keys())
    if len(_WORDS) + len(new) > CACHED_WORDS:
        _WORDS.clear()
        new = list(every)
    _WORDS.update(zip(new, _encoded(count, new)))
    known = _WORDS.__getitem__
    return np.fromiter((sum(map(known, x)) for x in words), np.int64, len(words))


def batch_counts(column: pa.Array, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Tokens per text of an Arrow column, encoded in batches of about equal bytes."""
    count, pieces = _counter(vocabulary), vocabulary.endswith(".model")
    total = np.zeros(len(column), np.int64)
    texts = column.to_pylist()
    if pieces:
        plain = [i for i, t in enumerate(texts) if t and not _UNSAFE.search(t)]
        total[plain] = _by_words([texts[i] for i in plain], count)
        for i in plain:
            texts[i] = None
    batch: list[str] = []
    owner: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        for part in parts(text, pieces) if text else ():
            batch.append(part)
            owner.append(i)
            held += len(part)
            if held >= BATCH_BYTES:
                np.add.at(total, owner, count(batch))
                batch, owner, held = [], [], 0
    if batch:
        np.add.at(total, owner, count(batch))
    return total


def token_count(text: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of a text column, without begin, end or added tokens.

    A null or empty text has none. Works on whole texts; only one integer a row returns to Spark.
    """

    @F.arrow_udf("bigint")
    def lengths(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in column:
            yield pa.array(batch_counts(array, vocabulary), pa.int64())

    return lengths(F.col(text) if isinstance(text, str) else text)


def token_counts(docs: DataFrame, text: str = "text", limit: int = 4096, vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit); other columns stay.

    A null text counts as empty. Narrow: no shuffle. Columns of the three names are replaced.
    """
    return docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(F.col(text)).cast("bigint"), F.lit(0).cast("bigint")),
            "n_tokens": token_count(F.col(text), vocabulary),
        }
    ).withColumn("over_limit", F.col("n_tokens") > limit)
