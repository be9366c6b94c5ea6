"""Quality rules, archives, toxicity and embeddings."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwatt.llm import embeddings, quality, toxicity, warc
from fleetwatt.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm import brute
from tests.llm.texts import clashing, corpus, frame

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_counts(spark):
    extra = [(9001, "a b c d e f g h " * 5, "en", None, None), (9002, "x # y\nx # y\n" + " ".join(map(str, range(40))), "en", None, None)]
    rows = corpus() + extra
    out = quality.quality(clashing(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r[n] for n in NAMES) == brute.quality_counts(r.text)
        assert not (r.kept and r.base_failed)
    assert quality.quality(frame(spark, [])).count() == 0


def test_quality_distance(spark):
    rnd = random.Random(3)
    prose = lambda: " ".join(rnd.choice(["the", "of", "and", "to", "in", "river", "mountain", "evening", "a", "is", "walks", "that", "cloud"]) for _ in range(200))
    rows = [(i, prose(), "en", None, None) for i in range(60)]
    rows.append((100, " ".join(w + "%%#" for w in prose().split()), "en", None, None))
    rows.append((101, " ".join(f"ware{i}" for i in range(200)), "en", None, None))
    rows.append((102, prose(), "xx", None, None))
    out = {r.doc_id: r for r in quality.quality(frame(spark, rows)).collect()}
    assert all(out[i].kept for i in range(60))
    assert not out[100].kept and out[100].class_distance > quality.MAX_CLASS_DISTANCE
    assert not out[101].kept and out[101].word_distance > quality.MAX_WORD_DISTANCE
    assert out[102].word_distance is None and out[102].kept
    p = np.array([0.5, 0.5, 0.0])
    q = np.array([0.25, 0.25, 0.5])
    m = (p + q) / 2
    want = np.sqrt(sum(a * np.log2(a / b) for x in (p, q) for a, b in zip(x, m) if a) / 2)
    got = spark.range(1).select(quality.js_distance([F.lit(2), F.lit(2), F.lit(0)], F.lit(4), [F.lit(float(x)) for x in q]).alias("d")).first().d
    assert abs(got - want) < 1e-12


@pytest.mark.parametrize("kind", ["symbols", "words"])
def test_a_third_of_junk_does_not_move_the_references(spark, kind):
    import corpus_pipeline

    rnd = random.Random(7)
    common = quality.COMMON_WORDS["en"]
    other = lambda: "".join(rnd.choice("aeiourstlnm") for _ in range(rnd.randrange(4, 9)))
    prose = lambda: " ".join(rnd.choice(common) if rnd.random() < 0.35 else other() for _ in range(200)) + "."
    junk = {
        "symbols": lambda: " ".join("".join(rnd.choice("#*$%&|<>@=ab") for _ in range(7)) for _ in range(200)),
        "words": lambda: " ".join(other() for _ in range(200)),
    }[kind]
    rows = [(i, junk() if i % 3 == 0 else prose(), "en", None, None) for i in range(180)]
    rows += [(500, "# " * 12, "en", None, None), (501, None, "de", None, None), (502, other(), None, None, None)]
    left = corpus_pipeline.quality_rules(spark, frame(spark, rows).repartition(3), SF_DIR).collect()
    assert {r.doc_id for r in left} == {i for i in range(180) if i % 3}


def test_quality_is_native(spark):
    plan = quality.quality(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def pages(spark):
    long = "<p>" + "same " * 40 + "é😀\r\n\r\nWARC/1.0\r\n1 2 3</p>"
    rows = [(i, f"http://a/{i} x", long if i % 3 == 0 else f"<p>{i}" + "y" * (i * 5) + "</p>") for i in range(1, 40)]
    rows += [(50, None, None), (51, "", ""), (52, "u", "short"), (53, "u", "short"), (None, "n", long), (40, None, long), (40, None, long)]
    return rows


def archive(spark, tmp_path, rows, version):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_arc(warc.captures(frame), str(tmp_path / "arc"), version=version, file_bytes=3000)
    warc.write_warc(warc.arc_to_warc(spark, str(tmp_path / "arc")), str(tmp_path / "warc"))
    return warc.refer_pages(warc.read_warc(spark, str(tmp_path / "warc"))).collect()


def test_archives(spark, tmp_path):
    for version in (1, 2):
        rows = pages(spark)
        out = archive(spark, tmp_path / str(version), rows, version)
        assert len(out) == len(rows) and all(r.digest_ok for r in out)
        least = {}
        for page, _, html in rows:
            if page is not None and len((html or "").encode()) >= 100:
                least[html] = min(page, least.get(html, page))
        want = []
        for page, _, html in rows:
            raw = (html or "").encode()
            first = least.get(html)
            revisit = first is not None and (page is None or page > first)
            want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None, None if revisit else raw))
        got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to_page, None if r.payload is None else bytes(r.payload)) for r in out]
        assert sorted(map(str, got)) == sorted(map(str, want))
        assert all(r.date == "2024-01-01T00:00:00Z" for r in out)
        assert {r.record_id for r in out if r.record_type == "response"} >= {r.refers_to for r in out if r.refers_to}


def test_archives_of_no_pages_and_broken_ones(spark, tmp_path):
    assert archive(spark, tmp_path, [], 1) == []
    import io

    import pytest

    with pytest.raises(ValueError):
        list(warc._arc_records(io.BytesIO(b"http://a 0.0.0.0 20240101000000 text/html 50\nshort\n")))
    with pytest.raises(ValueError):
        list(warc._arc_records(io.BytesIO(b"http://a 0.0.0.0 20240101000000 text/html 200 - 2\nab\n")))
    with pytest.raises(ValueError):
        list(warc._warc_records(io.BytesIO(b"nonsense\r\n")))
    other = list(warc._arc_records(io.BytesIO(b"dns:a 0.0.0.0 20240101000000 text/dns 4\nabcd\n")))
    assert warc._http(other[0][1]) == ({}, 0)


def test_automaton_is_an_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, last = [i + 1, *row[1:]], row
            for j, y in enumerate(b):
                row[j + 1] = min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1)
        return row[-1]

    terms = ["abcde", "abxde", "fghijk", "abc"]
    automaton = toxicity.Automaton([(t, False, 1.0 + i) for i, t in enumerate(terms)])
    rnd = random.Random(6)
    for _ in range(4000):
        word = list(rnd.choice(terms))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(word) + 1)
            word[at : at + rnd.randrange(2)] = rnd.choice(["", "x", "a", "k"])
        word = "".join(word)
        near = {t: distance(t, word) for t in terms}
        allowed = [1.0 + i for i, t in enumerate(terms) if near[t] == 0 or (near[t] == 1 and len(t) >= toxicity.FUZZY_LENGTH)]
        assert automaton.match(word)[0] == max(allowed, default=0.0), word
    stem = toxicity.Automaton([("abcd", True, 2.0)])
    assert stem.match("abcdxyz") == (2.0, 0) and stem.match("abzdxyz") == (0.0, 0)


def toxic_rows(n=900):
    rnd = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("aeiourstlnm") for _ in range(rnd.randrange(2, 8))) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(["villainous", "wretchedly", "scoundrel", "vermin"])
        rows.append((i, " ".join(words), None, None, None))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    extra = [(5000, None, None, None, None), (5001, "", None, None, None), (None, "hello", None, None, None), (5002, "you scoundrels vermim wretchedli " * 2, None, None, None)]
    labels += [(None, 1), (3, None), (4, 0), (4, 0)]
    docs, marks = clashing(spark, rows + extra + [rows[7]]), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    out = toxicity.toxicity(docs, marks).collect()
    assert len(out) == len(rows) + len(extra) + 1
    score = {r.doc_id: r for r in out}
    for i, y in toxic_rows()[1]:
        assert score[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert score[i].predicted == y and score[i].predicted == (score[i].score >= 0.5)
    assert score[5000].score == score[5001].score < 0.5 and not score[None].held_out
    assert score[5002].score > 0.5  # misspelled terms only


def test_held_out_labels_do_not_matter(spark):
    rows, labels = toxic_rows(300)
    docs = frame(spark, rows)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, spark.createDataFrame(x, "doc_id bigint, toxic int")).collect())) for x in (labels, flipped))
    assert a == b


def test_toxicity_without_labels_or_documents(spark):
    rows, labels = toxic_rows(20)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.predicted for r in toxicity.toxicity(frame(spark, rows), none).collect()} == {0}
    assert toxicity.toxicity(frame(spark, []), spark.createDataFrame(labels, "doc_id bigint, toxic int")).count() == 0


def test_quotations_are_seen():
    scanner = toxicity.Scanner([("scoundrel", False, 5.0)])
    names = dict(zip(toxicity.FEATURES, scanner.features('he said "you scoundrel" and left')))
    plain = dict(zip(toxicity.FEATURES, scanner.features("you scoundrel get out of here")))
    assert names["quoted"] == 1 and names["reported"] == 1 and plain["quoted"] == 0 and plain["reported"] == 0


def vectors(n=300, dim=64):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, dim))
    for k in range(0, 60):
        x[100 + k] = x[k % 3] + rng.normal(size=dim) * 0.12  # three large groups
    rows = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    rows += [(400 + i, rows[0][1]) for i in range(30)]  # equal vectors
    rows += [(500, None), (501, [0.0] * dim), (502, [float("nan")] * dim), (503, [None] * dim), (504, [float("inf")] + [1.0] * (dim - 1)), (505, [1.0, 2.0]), (None, rows[0][1])]
    return rows


def test_embeddings(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"id": F.lit("x"), "n": F.lit("y"), "n_links": F.lit(1)})
    out = {r.vec_id: r for r in embeddings.near_duplicates(table.repartition(3)).collect()}
    assert len(out) == len(rows)
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and i < 500}
    ids = sorted(good)
    cos = np.array([good[i] for i in ids]) @ np.array([good[i] for i in ids]).T
    near = (cos >= 0.9) & ~np.eye(len(ids), dtype=bool)
    found = sum(out[i].n_links for i in ids)
    assert all(out[i].n_links <= near[k].sum() for k, i in enumerate(ids))
    assert found >= 0.97 * near.sum() > 0
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))]
    want = brute.components(ids, links)
    assert np.mean([out[i].component_id == want[i] for i in ids]) > 0.97
    for i in (500, 501, 502, 503, 504, 505):
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True)
    assert out[None].n_links == 0
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    table = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<float>")
    whole = sorted(map(str, embeddings.near_duplicates(table).collect()))
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    assert sorted(map(str, embeddings.near_duplicates(table).collect())) == whole


def partners(n, cosine, dim=64):
    """Unit vectors, and one at the cosine from each in a random direction."""
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(2, n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    return x, cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y, axis=1, keepdims=True)


def test_recall_at_the_threshold_on_many_vectors(spark):
    """More than the 7,100 vectors from which the tables used to become fewer."""
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate(partners(3700, 0.901)))]
    out = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).select("n_links").collect()
    assert sum(r.n_links for r in out) >= 0.998 * 7400


@pytest.mark.parametrize("cosine", [0.9, 0.91, 0.92])
def test_recall_of_the_parts(cosine):
    """The parts follow from the threshold only, so these are the ones of 3 million vectors, too."""
    x, y = partners(20000, cosine)
    mean, projection = embeddings.fit_rotation(x[: embeddings.FIT_VECTORS])
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    widths = embeddings.part_widths(64, embeddings.THRESHOLD)
    a, b = (embeddings._parts((((v - mean) @ projection) >= 0) @ weights, widths) for v in (x, y))
    met = np.any([np.bitwise_count(p ^ q) <= 1 for p, q in zip(a, b)], axis=0)
    assert sum(widths) == 64 and met.mean() >= 0.998


def test_the_rotation_balances_codes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 16)) * np.r_[np.full(4, 5.0), np.ones(12)]
    mean, projection = embeddings.fit_rotation(x, bits=16)
    ones = ((x - mean) @ projection >= 0).mean(axis=0)
    assert np.abs(ones - 0.5).max() < 0.08 and np.allclose(projection.T @ projection, np.eye(16))


def test_queries_on_the_smallest_scale(spark):
    docs = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op3_quality_rules"](spark, SF_DIR).collect():
        assert tuple(r[n] for n in NAMES) == brute.quality_counts(docs[r.doc_id])
    html = dict(spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect())
    out = QUERIES["op4_arc_to_warc"](spark, SF_DIR).collect()
    assert len(out) == len(html) and all(r.payload_digest == hashlib.sha256((html[r.page_id] or "").encode()).hexdigest() for r in out)
    assert QUERIES["op7_toxicity"](spark, SF_DIR).count() == len(docs)
    assert QUERIES["op8_embedding_near_dedup"](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
