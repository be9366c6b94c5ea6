"""Toxicity scores: a learnt lexicon, matched with misspellings, and what stands around the hits.

Terms and stems that are far commoner in toxic texts form a trie. Levenshtein automata of all of
them are run as one: a state is the set of (trie node, edits) that a word's letters can have led
to, made when first needed, so most words leave the trie after two or three letters. A logistic
model weighs the hits: how strong, how many, how dense, exact or misspelled, and whether their
surroundings look like a quotation or a report rather than an address.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleetwatt.llm.steps import stored

#: Labelled texts on which lexicon and weights are fitted: those of smallest hash of their id.
FIT_ROWS = 20_000
LEXICON = 2_000
MIN_SHARE, MIN_TEXTS, MIN_LOG_ODDS = 0.005, 8, 2.5
STEMS = (4, 5, 6)
FUZZY_LENGTH = 5
CONTEXT = 5
CACHED_WORDS = 400_000

STRIPPED = ".,;:!?\"'()[]#*$%&|<>-«»“”„‘’"
# Marks of a quotation, and words that report what others say.
QUOTES = "\"«»“”„"
REPORTING = frozenset(
    "said says say wrote called quote quoted word term sagte schrieb nannte zitat wort dit écrit appelé citation mot dijo "
    "escribió llamó cita palabra".split()
)
FEATURES = ["strongest", "second", "kinds", "density", "misspelled", "quoted", "reported", "any"]


@dataclass
class Node:
    next: dict[str, Node] = field(default_factory=dict)
    term: float = 0.0  # weight of a term that ends here
    stem: float = 0.0  # weight of a stem that ends here
    fuzzy: bool = False  # whether what ends here may be misspelled


class Automaton:
    """All Levenshtein automata of a lexicon, with at most one edit, against its trie."""

    def __init__(self, lexicon: Iterable[tuple[str, bool, float]]):
        self.nodes = [Node()]
        self.index: dict[int, int] = {id(self.nodes[0]): 0}
        for text, stem, weight in lexicon:
            node = self.nodes[0]
            for c in text:
                if c not in node.next:
                    node.next[c] = made = Node()
                    self.index[id(made)] = len(self.nodes)
                    self.nodes.append(made)
                node = node.next[c]
            node.fuzzy = len(text) >= FUZZY_LENGTH
            if stem:
                node.stem = max(node.stem, weight)
            else:
                node.term = max(node.term, weight)
        self.states: list[frozenset[tuple[int, int]]] = [frozenset({(0, 0)})]
        self.number = {self.states[0]: 0}
        self.moves: dict[tuple[int, str], int] = {}

    def _step(self, state: frozenset[tuple[int, int]], c: str) -> frozenset[tuple[int, int]]:
        out = set()
        for i, edits in state:
            node = self.nodes[i]
            if c in node.next:
                out.add((self.index[id(node.next[c])], edits))
            if edits == 0:
                out.add((i, 1))  # c is too much
                for child in node.next.values():
                    out.add((self.index[id(child)], 1))  # c stands for another letter
                    if c in child.next:
                        out.add((self.index[id(child.next[c])], 1))  # a letter before c is missing
        return frozenset((i, e) for i, e in out if e == 0 or (i, 0) not in out)

    def match(self, word: str) -> tuple[float, int]:
        """Weight of the best entry that the word is, or begins with; and its edits. (0, 0): none."""
        state, best = 0, (0.0, 0)
        for c in word:
            move = self.moves.get((state, c))
            if move is None:
                after = self._step(self.states[state], c)
                move = self.number.setdefault(after, len(self.states))
                if move == len(self.states):
                    self.states.append(after)
                self.moves[(state, c)] = move
            state = move
            here = self.states[state]
            if not here:
                return best
            for i, edits in here:
                node = self.nodes[i]
                if node.stem and edits == 0 and node.stem > best[0]:
                    best = (node.stem, 0)
        for i, edits in self.states[state]:
            node = self.nodes[i]
            ends = [node] if edits else [node, *(x for x in node.next.values() if x.fuzzy)]
            for k, end in enumerate(ends):
                off = edits + (k > 0)
                if end.term and (off == 0 or end.fuzzy) and (end.term, -off) > (best[0], -best[1]):
                    best = (end.term, off)
        return best


def plain(word: str) -> str:
    return word.strip(STRIPPED).lower()


class Scanner:
    """Feature rows of texts. Words are matched once and remembered."""

    def __init__(self, lexicon: Iterable[tuple[str, bool, float]]):
        self.automaton = Automaton(lexicon)
        self.known: dict[str, tuple[float, int]] = {}

    def _hit(self, word: str) -> tuple[float, int]:
        hit = self.known.get(word)
        if hit is None:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = hit = self.automaton.match(plain(word))
        return hit

    def features(self, text: str | None) -> list[float]:
        words = (text or "").split()
        hits = {w: h for w in set(words) if (h := self._hit(w))[0]}
        if not hits:
            return [0.0] * len(FEATURES)
        at = [i for i, w in enumerate(words) if w in hits]
        quoted = reported = 0
        for i in at:
            before, behind = words[max(0, i - CONTEXT) : i], words[i + 1 : i + 1 + CONTEXT]
            opens = sum(w.count(q) for w in [*before, words[i]] for q in QUOTES)
            closes = sum(w.count(q) for w in [words[i], *behind] for q in QUOTES)
            quoted += opens > 0 and closes > 0
            reported += any(plain(w) in REPORTING for w in before + behind)
        weights = sorted({plain(w): h[0] for w, h in hits.items()}.values(), reverse=True)
        return [
            weights[0] / 10, weights[1] / 10 if len(weights) > 1 else 0.0, math.log1p(len(weights)), math.log1p(100 * len(at) / len(words)),
            sum(h[1] for h in hits.values()) / len(hits), quoted / len(at), reported / len(at), 1.0,
        ]


def fit_lexicon(sample: DataFrame, toxic: int, clean: int, text: str = "text", label: str = "toxic") -> list[tuple[str, bool, float]]:
    """Terms and stems by their log-odds of occurring in a toxic text; at most LEXICON entries.

    Words are counted by Spark, once a text; only the entries go to the driver.
    """
    bare = F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.trim(w, F.lit(STRIPPED)))
    words = sample.select(F.col(label).alias("y"), F.explode(F.array_distinct(F.filter(bare, lambda w: F.length(w) >= 3))).alias("w"))
    counts = words.groupBy("w").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    both = counts.select("w", F.lit(False).alias("stem"), "t", "c").unionByName(
        counts.where(F.length("w") > min(STEMS)).select(F.explode(F.array(*[F.when(F.length("w") > n, F.substring("w", 1, n)) for n in STEMS])).alias("w"), F.lit(True).alias("stem"), "t", "c")
        .where("w is not null").groupBy("w", "stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    enough = F.col("t") >= max(MIN_TEXTS, MIN_SHARE * toxic)
    rows = both.withColumn("odds", odds).where(enough & (F.col("odds") >= MIN_LOG_ODDS + F.col("stem").cast("int")))
    best = rows.orderBy(F.desc(F.col("odds") * F.log1p("t")), "w").limit(LEXICON).collect()
    return sorted((r["w"], r["stem"], float(r["odds"])) for r in best)


def fit_weights(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _features(docs: DataFrame, text: str, keep: list[str], lexicon: list[tuple[str, bool, float]], weights: np.ndarray | None) -> DataFrame:
    """keep and the features; with weights, keep and the score."""
    names = FEATURES if weights is None else ["score"]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(f"_{n}", T.DoubleType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(lexicon)
        for batch in batches:
            x = np.array([scanner.features(t.as_py()) for t in batch.column(0)], float).reshape(-1, len(FEATURES))
            if weights is not None:
                x = (1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ weights, -30, 30))))[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(x[:, k]) for k in range(x.shape[1]))], names=[*keep, *(f"_{n}" for n in names)]
            )

    return docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row.

    Learns from labelled rows that are not held out, at most FIT_ROWS of them: an id's labels
    count as 1 if any is, NULL labels and ids are left out, and of copies of a text one is
    learnt from. Only the text is scored. A NULL or empty text has no hit; without both labels,
    every score is the share of label 1, or 0. Repeated rows get equal scores. Eager: the model is
    fitted while the result is built. What is broadcast has at most FIT_ROWS ids and labels.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS)
    )
    known = docs.select(F.col(doc_id), F.col(text).alias("text")).join(F.broadcast(chosen), F.col(doc_id) == F.col("_id"))
    sample = stored(known.select("_id", "text", "toxic", F.xxhash64("text").alias("h")), "sample")
    sample = sample.dropDuplicates(["h"])
    clean, toxic = (lambda r: (r[0] or 0, r[1] or 0))(sample.agg(F.sum(1 - F.col("toxic")), F.sum("toxic")).first())
    lexicon = fit_lexicon(sample, toxic, clean) if toxic and clean else []
    if lexicon:
        fitted = _features(sample, "text", ["toxic"], lexicon, None).toArrow()
        x = np.column_stack([fitted.column(f"_{n}").to_numpy() for n in FEATURES])
        weights = fit_weights(x, fitted.column("toxic").to_numpy())
    else:
        share = toxic / (toxic + clean) if toxic + clean else 0.0
        weights = np.r_[np.zeros(len(FEATURES)), np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -30, 30)]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = _features(rows, "text", ["doc_id"], lexicon, weights)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted")
    )
