"""Spelling variants against all edits of each word, and against pairwise distances."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from fleetwatt.llm import spelling
from fleetwatt.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm.texts import clashing, corpus, frame

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def near(words):
    """All words one edit away, by trying every edit."""
    letters = sorted({c for w in words for c in w})
    out = {}
    for w in words:
        made = {w[:i] + w[i + 1 :] for i in range(len(w))}
        for c in letters:
            made |= {w[:i] + c + w[i:] for i in range(len(w) + 1)} | {w[:i] + c + w[i + 1 :] for i in range(len(w))}
        out[w] = {v for v in made if v in words and v != w}
    return out


def grouped(words):
    """word: (form, root, n, n_near, form_n)."""
    forms, nears = {}, near(words)
    for w, found in nears.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = {}
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, words[w], len(nears[w]), words[forms[w]] if forms[w] else None)
    return out


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def vocabulary(seed, n):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abß") for _ in range(rnd.randrange(6, 11))) for _ in range(n)}
    words |= {"a" * k for k in range(6, 14)} | {"shared" + "".join(rnd.choice("xyé") for _ in range(rnd.randrange(1, 7))) for _ in range(n)}
    return {w: 5 ** rnd.randrange(1, 7) + rnd.randrange(4) for w in words}


@pytest.mark.parametrize("shard_words", [spelling.SHARD_WORDS, 60])
def test_random_words(spark, shard_words):
    """Few letters, so most words have several near ones; with small shards many halves are hot."""
    words = vocabulary(shard_words, 250)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = grouped(words)
    assert result(spelling.spelling_groups(df, shard_words)) == want
    pairs = {(r.word, r.near) for r in spelling.near_pairs(df, shard_words).collect()}
    assert pairs == {(a, b) for a in words for b in words if distance_one(a, b)}
    assert any(form and form != root for form, root, *_ in want.values())


def test_one_index():
    words = ["aaaaaa", "aaaaaaa", "abcdef", "abcdeg", "xabcdef", "abcdff"]
    rows = [{"word": w, "n": 5, "side": side, "search": search} for w in words for side in (0, 1) for search in (True, False)]
    out = spelling._search_shard(pa.Table.from_pylist(rows)).to_pylist()
    assert {(r["word"], r["near"]) for r in out} == {(a, b) for a in words for b in words if distance_one(a, b)}


def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = grouped(counted(docs))
    assert result(QUERIES["op11_spelling_variants"](spark, SF_DIR)) == want
    assert any(form for form, *_ in want.values())


def test_awkward_rows(spark):
    rows = corpus() * 6
    rows += [(5000 + i, t, None, None, None) for i, t in enumerate(["STRAßE straße ÉCOLE École école_écoles", "xy" * 150, "colour color×colour", "don't"] * 6)]
    got = {r.word: r.n for r in spelling.words_of(clashing(spark, rows)).collect()}
    assert got == counted([r[:2] for r in rows])
    assert result(spelling.spelling_groups(spelling.words_of(frame(spark, rows)))) == grouped(got)


def test_a_very_long_word(spark):
    words = {"x" * 20_000: 5, "x" * 20_001: 30, "xxxxxx": 7, "yxxxxxx": 9}
    out = result(spelling.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert {w: o[3] for w, o in out.items()} == {w: 1 for w in words}
    assert out["x" * 20_000][:2] == ("x" * 20_001,) * 2


def test_no_rows(spark):
    assert spelling.spelling_groups(spelling.words_of(frame(spark, []))).count() == 0
    assert spelling.spelling_groups(spelling.words_of(frame(spark, [(1, None, None, None, None), (None, "", None, None, None)]))).count() == 0
