"""Byte-pair encoding as a streaming transducer, and decoding as an incremental one.

A merge can only be stopped from the right by a merge of higher rank that takes its right part
away, and that one only by a merge of a still higher rank. Following these chains through the
merge list gives the number of bytes after a token that can change it: the sufficient lookahead.
The transducer merges one window, emits every token with so many bytes behind it, and goes on at
the end of the last one. Neither needs more memory than a window.
"""

from __future__ import annotations

import codecs
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from fleetwatt.llm.texts import blocks

VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the split into words before the merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK_CHARS = 1 << 16
CACHED_WORDS = 500_000
LONG_WORD = 256
NONE = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """A merge list over token ids, with its sufficient lookahead."""

    def __init__(self, base: list[int], pairs: list[tuple[int, int, int]], length: dict[int, int]):
        """base: token of each byte; pairs: left, right and merged token by rank; length in bytes."""
        self.base = base
        self.rank = {(a << 20) | b: r for r, (a, b, _) in enumerate(pairs)}
        self.made = [c for _, _, c in pairs]
        self.base_table, self.made_table = np.array(base, np.int64), np.array(self.made, np.int64)
        self.keys = np.array(list(self.rank), np.int64)  # by rank
        self.slots = np.full(1 << 20, -1, np.int32)  # rank of the pair in a slot, -2 - rank if it has several
        at = self._slot(self.keys >> 20, self.keys & 0xFFFFF)
        self.slots[at] = np.arange(len(self.keys))
        shared = np.flatnonzero(np.bincount(at, minlength=len(self.slots)) > 1)
        self.slots[shared] = -2
        self.several = {int(k): r for r, k in enumerate(self.keys) if self.slots[at[r]] == -2}
        self.longest = max(length.values())
        self.lookahead = self._lookahead(pairs, length)
        self.window = max(1024, 4 * (self.lookahead + self.longest))

    @staticmethod
    def _lookahead(pairs: list[tuple[int, int, int]], length: dict[int, int]) -> int:
        """Bytes after a boundary on which the merges across it depend.

        reach[t] is the largest number so far for a merge whose left part is t, and form[t] the
        bytes from t's start on which its own making depends. Both only use merges of higher rank.
        """
        reach: dict[int, int] = {}
        form: dict[int, int] = {}
        most = 0
        for left, right, made in pairs:
            behind = max(form.get(right, length[right]), length[right] + reach.get(right, 0))
            form[made] = max(form.get(made, 0), form.get(left, 0), length[left] + behind)
            reach[left] = max(reach.get(left, 0), behind)
            most = max(most, form[made])
        return most

    def merge(self, ids: list[int]) -> list[int]:
        if len(ids) > 96:
            return self._merge_long(ids)
        rank, made = self.rank.get, self.made
        while len(ids) > 1:
            ranks = [rank((a << 20) | b, NONE) for a, b in zip(ids, ids[1:])]
            best = min(ranks)
            if best == NONE:
                break
            out, i, n, new = [], 0, len(ids), made[best]
            while i < n:
                if i < n - 1 and ranks[i] == best:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list."""
        ids, n = list(ids), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank((ids[i] << 20) | ids[i + 1], NONE)) < NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := rank((ids[x] << 20) | ids[y], NONE)) < NONE:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [t for t in ids if t >= 0]

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of many short words, as bytes: in each step every word does its best merge."""
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.base_table[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        done_ids, done_word = [], []
        while len(ids):
            same = word[1:] == word[:-1]
            rank = np.full(len(ids), len(self.made), np.int64)  # of the pair that begins here
            rank[:-1][same] = self._ranks(ids[:-1][same], ids[1:][same])
            first = np.flatnonzero(np.r_[True, ~same])
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(ids)]))
            ended = best == len(self.made)
            if ended.any():
                done_ids.append(ids[ended])
                done_word.append(word[ended])
                ids, word, rank, best = ids[~ended], word[~ended], rank[~ended], best[~ended]
                if not len(ids):
                    break
            hit = rank == best
            # Of a run of pairs that overlap, every second one merges, from the left.
            at = np.flatnonzero(hit)
            run = np.cumsum(np.r_[True, np.diff(at) != 1]) - 1
            begin = np.flatnonzero(np.r_[True, np.diff(run) != 0])
            hit[at[(np.arange(len(at)) - begin[run]) % 2 == 1]] = False
            ids = np.where(hit, self.made_table[np.minimum(rank, len(self.made) - 1)], ids)
            kept = np.r_[True, ~hit[:-1]]
            ids, word = ids[kept], word[kept]
        ids, word = np.concatenate(done_ids), np.concatenate(done_word)
        data = ids[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(word, minlength=len(words)) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _slot(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left * 0x9E3B + right * 0x85EBC) & 0xFFFFF

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        rank = self.slots[self._slot(left, right)].astype(np.int64)
        for i in np.flatnonzero(rank == -2):
            rank[i] = self.several.get((int(left[i]) << 20) | int(right[i]), -1)
        wrong = (rank < 0) | (self.keys[rank] != (left << 20) + right)
        rank[wrong] = len(self.made)
        return rank

    def stream(self, data: bytes, length: list[int]) -> Iterator[list[int]]:
        """Tokens of data, a window at a time, each as soon as it is stable."""
        start, base = 0, self.base
        while start < len(data):
            stop = min(len(data), start + self.window)
            ids = self.merge([base[b] for b in data[start:stop]])
            if stop == len(data):
                yield ids
                return
            end, k = start, 0
            while end + length[ids[k]] <= stop - self.lookahead:
                end += length[ids[k]]
                k += 1
            yield ids[:k]
            start = end


class ByteBpe:
    """Encoder and decoder of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        self.length = [len(b) for b in self.bytes_of]
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        base = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges = Merges(base, pairs, {i: len(b) for i, b in enumerate(self.bytes_of) if b})
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.splits = regex.compile("|".join(regex.escape(s) for s in self.special) or r"(?!)")
        self.words = regex.compile(WORDS)
        self.splitter = None
        self.path = path
        self.plain: set[str] = set()
        self.known: dict[str, bytes] = {}

    # -- encoding

    def _words(self, text: str) -> list[str]:
        strange = set(text) - self.plain
        self.plain.update(c for c in strange if unicodedata.category(c) != "Cn")
        if strange <= self.plain:
            return self.words.findall(text)
        # Characters that are newer than one of the two Unicode tables: the library's split decides.
        if self.splitter is None:
            from tokenizers import Tokenizer

            self.splitter = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[i:j] for _, (i, j) in self.splitter.pre_tokenize_str(text)]

    def _learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet, the short ones together."""
        known = self.known
        new = list(words.difference(known))
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = list(words)
        coded = [w.encode() for w in new]
        short = [i for i, data in enumerate(coded) if len(data) <= LONG_WORD]
        known.update(zip([new[i] for i in short], self.merges.merge_many([coded[i] for i in short])))
        for i in set(range(len(new))).difference(short) if len(short) < len(new) else ():
            stable = self.merges.stream(coded[i], self.length)
            known[new[i]] = b"".join(np.array(ids, "<u4").tobytes() for ids in stable)

    def encode_stream(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, block by block."""
        start = 0
        for special in [*self.splits.finditer(text), None]:
            part = text[start : special.start() if special else len(text)]
            for block in blocks(part, BLOCK_CHARS) if part else ():
                words = self._words(block)
                self._learn(set(words))
                yield b"".join(map(self.known.__getitem__, words))
            if special:
                yield np.array([self.special[special[0]]], "<u4").tobytes()
                start = special.end()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of many texts. Texts without special strings and of one block share their new words."""
        words = {
            i: self._words(t) for i, t in enumerate(texts) if t and len(t) <= BLOCK_CHARS and not self.splits.search(t)
        }
        self._learn({w for x in words.values() for w in x})
        known = self.known.__getitem__
        coded = {i: b"".join(map(known, x)) for i, x in words.items()}
        return [coded[i] if i in coded else b"".join(self.encode_stream(t)) for i, t in enumerate(texts)]

    # -- decoding

    def decode_stream(self, blocks_of_ids: Iterable[bytes]) -> Iterator[str]:
        """Text of ids. Bytes of a character that is not complete wait for the next block."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        piece = self.bytes_of.__getitem__
        for ids in blocks_of_ids:
            yield state.decode(b"".join(map(piece, np.frombuffer(ids, "<u4").tolist())))
        yield state.decode(b"", final=True)


@lru_cache(maxsize=2)
def byte_bpe(name: str) -> ByteBpe:
    """One per Python worker, with what it has learnt about frequent units."""
    import public_tokenizers

    return ByteBpe(public_tokenizers.path(name))


def encode_decode(
    docs: DataFrame, text: str = "text", ids: str = "token_ids", decoded: str = "decoded",
    vocabulary: str = VOCABULARY, keep_text: bool = True,
) -> DataFrame:
    """Encode a text column and decode the ids again.

    Adds `ids` (binary: little-endian unsigned 32-bit integers) and `decoded` (string). All other
    columns stay as they are; columns of these two names are replaced. A null text is the empty
    text and has no ids. With keep_text=False the text itself is left out. Special strings inside a text become their own token. Repeated rows stay.
    Narrow: one pass, no shuffle, a failed task is simply run again.
    """
    keep = [c for c in docs.columns if c not in (ids, decoded)]
    if text not in keep:
        raise ValueError(f"no column {text}")
    out = [c for c in keep if keep_text or c != text]
    schema = T.StructType([docs.schema[c] for c in out] + [T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(vocabulary)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part, texts in _by_bytes(batch, column):
                coded = model.encode_batch([t or "" for t in texts.to_pylist()])
                back = ["".join(model.decode_stream([ids])) for ids in coded]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i, c in enumerate(keep) if c in out), pa.array(coded, pa.binary()), pa.array(back, pa.string())],
                    names=[*out, ids, decoded],
                )

    return docs.select([F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def _by_bytes(batch: pa.RecordBatch, column: pa.Array, size: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch with about so many bytes of text each."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start), column.slice(start, stop - start)
        start = stop
