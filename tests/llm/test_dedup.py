"""Line dedup, Jaccard groups, suffix arrays and the pipeline against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from fleetwatt.llm import components, jaccard, line_dedup, suffix_array, suffix_dedup
from fleetwatt.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm import brute
from tests.llm.texts import SCHEMA, clashing, corpus, frame


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(150)]
    edges += [(7, 7), (None, 3), (5, 4), (5, 4)]
    out = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    good = [(a, b) for a, b in edges if a is not None and a != b]
    ids = {i for e in good for i in e}
    assert out == brute.components(ids, good)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 50)])
def test_similar_groups(spark, width, percent):
    rows = [r for r in corpus()]
    out = jaccard.similar_groups(clashing(spark, rows).repartition(5), width=width, percent=percent).collect()
    assert len(out) == len(rows)
    want = brute.similar(rows, width, percent)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert any(c != i for i, (_, c) in want.items())


def test_a_family_whose_members_do_not_all_link(spark):
    """Edits drift: neighbours link, far ones do not, and the first one is not the middle."""
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        if i % 4 == 0:
            base[rnd.randrange(200)] = f"e{i}"
        text = list(base)
        text[rnd.randrange(200)] = f"own{i}"
        rows.append((1000 - i, " ".join(text), None, None, None))
    out = {r.doc_id: r.component_id for r in jaccard.similar_groups(frame(spark, rows)).collect()}
    assert out == {i: c for i, (_, c) in brute.similar(rows).items()}


def test_similar_groups_of_no_rows(spark):
    assert jaccard.similar_groups(frame(spark, [])).count() == 0


def test_dedup_lines(spark):
    rows = [r for r in corpus() if r[0] is not None]
    out = line_dedup.dedup_lines(clashing(spark, rows).repartition(3)).collect()
    assert len(out) == len(rows)
    want = brute.dedup_lines(rows)
    for r in out:
        assert (r.n_lines, r.n_removed, r.text) == want[r.doc_id]
    assert sum(w[1] for w in want.values()) > 20


def test_prefix_words_move_once_for_both_sides(spark, monkeypatch):
    """The second join shares one exchange, and sets that go are left out of one side only."""
    rows, plans, before = [r for r in corpus() if r[0] is not None], [], line_dedup.stored

    def seen(df, label):
        if label == "pairs":
            assert df.count() == len(df.distinct().collect())
            ran = df.select("x", "y")
            ran.collect()
            plans.append(ran._jdf.queryExecution().executedPlan().toString())
            assert not {r.x for r in ran.collect()} & gone
        table = before(df, label)
        if label == "similar" and not plans:
            gone.update(r.x for r in table.collect())
        return table

    gone: set[int] = set()
    monkeypatch.setattr(line_dedup, "stored", seen)
    out = line_dedup.dedup_lines(clashing(spark, rows).repartition(3)).collect()
    want = brute.dedup_lines(rows)
    assert all((r.n_lines, r.n_removed, r.text) == want[r.doc_id] for r in out)
    assert gone and len(plans) == 1 and "ReusedExchange" in plans[0]


def test_long_lines_with_few_rare_words_in_common_are_not_compared(spark, monkeypatch):
    """Long similar lines share several words of their prefixes; lines that share one are no pair."""
    rnd, before, made = random.Random(6), line_dedup.stored, {}
    usual = [f"u{i}" for i in range(300)]
    own = [[f"longer{i}x{k}" for k in range(500)] for i in range(20)]
    lines = [[*usual, *own[i], *own[i], f"rareandverylongword{i // 2}"] for i in range(20)]
    lines += [[w for w in lines[i] if rnd.random() > 0.08] for i in range(0, 20, 5)]
    rows = [(i, " ".join(rnd.sample(x, len(x))), None, None, None) for i, x in enumerate(lines)]

    def counted(df, label):
        table = before(df, label)
        if label == "pairs":
            made[label] = table.count()
        return table

    monkeypatch.setattr(line_dedup, "stored", counted)
    want = brute.dedup_lines(rows)
    out = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert all((r.n_lines, r.n_removed, r.text) == want[r.doc_id] for r in out)
    assert sum(w[1] for w in want.values()) == 4
    assert made["pairs"] <= 4  # the similar ones


def test_lines_that_share_single_words_do_not_meet(spark, monkeypatch):
    """Rows of the second join: words of long lines are common to many, pairs of them are not."""
    rnd, before, made = random.Random(16), line_dedup.stored, []
    words = [f"word{i:05}" for i in range(6000)]
    lines = [rnd.sample(words, 150) for _ in range(120)]
    lines += [lines[i][:140] + rnd.sample(words, 5) for i in range(0, 120, 12)]
    rows = [(i, " ".join(x), None, None, None) for i, x in enumerate(lines)]

    def joined(node):
        name, children = node.nodeName(), node.children()
        if name.startswith("AdaptiveSparkPlan"):
            return joined(node.executedPlan())
        if "QueryStage" in name:
            return joined(node.plan())
        own = [node.metrics().apply("numOutputRows").value()] if "Join" in name and "bit_count" in node.toString().split("\n")[0] else []
        return own + [n for i in range(children.size()) for n in joined(children.apply(i))]

    def counted(df, label):
        if label == "pairs":
            ran = df.select("x", "y")
            ran.collect()
            made.extend(joined(ran._jdf.queryExecution().executedPlan()))
        return before(df, label)

    monkeypatch.setattr(line_dedup, "stored", counted)
    want = brute.dedup_lines(rows)
    out = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert all((r.n_lines, r.n_removed, r.text) == want[r.doc_id] for r in out)
    assert sum(w[1] for w in want.values()) == 10
    assert len(made) == 1 and made[0] <= 500


@pytest.mark.parametrize("percent", [60, 75, 80, 95])
def test_similar_lines_share_enough_pairs(spark, percent):
    rnd = random.Random(percent)
    base = [[f"{'abcdefgh'[k % 8] * (1 + k % 5)}{k}" for k in rnd.sample(range(60), n)] for n in (1, 2, 3, 4, 5, 7, 9, 10, 14, 19, 24, 30, 48, 55)]
    lines = []
    for x in base * 12:
        gone = rnd.randrange(1 + len(x) * (100 - percent) // 100)
        more = [f"more{rnd.randrange(999)}" for _ in range(rnd.randrange(1 + (len(x) - gone) * 100 // percent - len(x) + gone))]
        lines.append(x[: len(x) - gone] + more[: rnd.randrange(4)])
    rows = [(i, " ".join(rnd.sample(x, len(x))), None, None, None) for i, x in enumerate(lines) if x]
    want = brute.dedup_lines(rows, percent)
    out = line_dedup.dedup_lines(frame(spark, rows), percent=percent).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in out} == want


def test_dedup_lines_without_id_comes_last(spark):
    line = "some words that are the same in both"
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, [(None, line, None, None, 1), (9, line + "\nmore", None, None, 1)])).collect()}
    assert out == {None: "", 9: line + "\nmore"}
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("id", [None, 7])
def test_rows_of_one_id_keep_lines_of_their_own(spark, id):
    rows = [(id, "p q r\nalpha beta", None, None, 1), (id, "x y z\np q r", None, None, 1), (3, "first", None, None, 1)]
    out = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert sorted(x for r in out for x in r.text.split("\n") if x) == ["alpha beta", "first", "p q r", "x y z"]
    assert sorted(r.n_removed for r in out) == [0, 0, 1]


@pytest.mark.parametrize("together", [50_000, 2])
def test_repeated_strings(spark, together, monkeypatch):
    rnd = random.Random(8)
    rows = [r for r in corpus() if r[0] is not None]
    parts = ["".join(rnd.choice("abc ") for _ in range(130)) for _ in range(6)]
    rows += [(5000 + i, "".join(rnd.choice(parts) + str(rnd.random()) * rnd.randrange(3) for _ in range(6)), None, None, None) for i in range(40)]
    rows += [(7000, "ab" * 300, None, None, None), (7001, "ab" * 200, None, None, None), (7002, "z" * 250, None, None, None)]
    docs = frame(spark, rows).repartition(4)
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    spans = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda d, n: spans(d, n, together=together))
    out = suffix_dedup.remove_repeats(docs.withColumn("n_bytes", F.lit("x")).withColumn("spans", F.lit("y"))).collect()
    want = brute.repeats(rows)
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]


def test_repeated_strings_across_blocks(spark, monkeypatch):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefgh") for _ in range(3000))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 512)
    p, k, a = suffix_dedup.anchors(text.encode())
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 20)
    q, m, b = suffix_dedup.anchors(text.encode())
    assert p.tolist() == q.tolist() and k.tolist() == m.tolist() and a.tolist() == b.tolist()
    assert max(y - x for x, y in zip(q, q[1:])) <= suffix_dedup.LENGTH


def test_repeated_strings_without_id_or_rows(spark):
    out = suffix_dedup.remove_repeats(frame(spark, [(None, "a" * 500, None, None, None)])).collect()
    assert (out[0].n_bytes, out[0].n_removed, bytes(out[0].kept)) == (500, 0, b"a" * 500)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 4, 30])
def test_suffix_arrays(letters):
    rnd = random.Random(letters)
    for _ in range(60):
        x = [rnd.randint(1, letters) for _ in range(rnd.randrange(80))] + [0]
        array = suffix_array.suffix_array(x, letters + 1)
        assert array == sorted(range(len(x)), key=lambda i: x[i:])
        shared = suffix_array.common_prefixes(x, array)
        for a, b in zip(array, array[1:]):
            n = next(n for n in range(len(x)) if x[a + n] != x[b + n] or not x[a + n])
            assert shared[b] == n


def test_suffix_arrays_take_no_python_step_for_each_symbol():
    import sys

    import numpy as np

    rnd = random.Random(31)
    parts = [bytes(rnd.choice(b"abcdef ") for _ in range(150)) for _ in range(20)]
    data = [rnd.choice(parts)[rnd.randrange(9) :] + bytes([65 + i % 20]) for i in range(150)]
    doc, start, steps = np.arange(len(data)), np.zeros(len(data), np.int64), [0]

    def seen(frame, event, arg):
        steps[0] += event == "line"
        return seen

    sys.settrace(seen)
    try:
        found = suffix_dedup.repeats_by_suffix_array(data, doc, start, 100)
    finally:
        sys.settrace(None)
    places, want = {}, set()
    for d, x in enumerate(data):
        for i in range(len(x) - 99):
            if places.setdefault(x[i : i + 100], (d, i)) != (d, i):
                want.add((d, i))
    assert want and set(zip(*(x.tolist() for x in found))) == want
    assert steps[0] < sum(map(len, data)) // 5


def test_queries_on_the_smallest_scale(spark):
    docs = documents(spark)
    want = brute.similar(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op6_ngram_jaccard_join"](spark, SF_DIR).collect()} == want
    cut = brute.repeats(docs)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in QUERIES["op9_suffix_array_dedup"](spark, SF_DIR).collect()}
    assert got == {i: v[:3] for i, v in cut.items()}
    lines = brute.dedup_lines(docs)
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in QUERIES["op2_line_dedup"](spark, SF_DIR).collect()} == {i: v[:2] for i, v in lines.items()}


def test_pipeline(spark):
    import corpus_pipeline
    from tests.llm.test_tokens import brute_pieces, gapless

    docs = frame(spark)
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF_DIR)
        assert left.schema == spark.createDataFrame([], SCHEMA).schema, name
    rows = [r for r in corpus() if not brute.quality_counts(r[1])[5]]
    judged = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF_DIR).collect()}
    rows = [r for r in rows if r[0] in judged]
    lines = brute.dedup_lines(rows)
    rows = [(r[0], lines[r[0]][2]) for r in rows]
    groups = brute.similar(rows, 5, 80)
    rows = [r for r in rows if r[0] is None or groups[r[0]][1] == r[0]]
    cut = brute.repeats(rows)
    rows = [(i, t if i is None else cut[i][3].decode("utf-8", "ignore")) for i, t in rows]
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted((str(i), t) for i, t in rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF_DIR).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in packed))) == sorted(map(str, brute_pieces(rows)))
    gapless(packed, 1024)
    none = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF_DIR)
    assert none.count() == 0


def test_shuffle_files_go_with_the_query_that_made_them(spark, monkeypatch):
    from fleetwatt.llm import steps

    before, during, write = spark.conf.get(steps.CLEAN_UP), [], steps.lineage.stored
    monkeypatch.setattr(steps.lineage, "stored", lambda df, label: (during.append(spark.conf.get(steps.CLEAN_UP)), write(df, label))[1])
    assert steps.stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counts").count() == 7
    assert during == ["true"] and spark.conf.get(steps.CLEAN_UP) == before


def test_signatures_tell_long_sets_apart(spark):
    """Sets of 120 words set nearly all of 64 bits, but not evenly often."""
    sets = [[hash((i, k)) & (1 << 50) - 1 for k in range(120)] for i in range(12)]
    rows = spark.createDataFrame(list(enumerate(sets)), "id int, words array<bigint>").select("id", F.size("words").alias("n"), line_dedup._signature("words").alias("bits"))
    pairs = rows.alias("x").join(rows.alias("y"), F.col("x.id") < F.col("y.id"))
    assert pairs.where(line_dedup._alike(80)).count() <= pairs.count() // 3
    near = spark.createDataFrame([(0, sets[0]), (1, sets[0][:108])], "id int, words array<bigint>").select("id", F.size("words").alias("n"), line_dedup._signature("words").alias("bits"))
    assert near.alias("x").join(near.alias("y"), F.col("x.id") < F.col("y.id")).where(line_dedup._alike(80)).count() == 1


def test_sketches_differ_in_no_more_bits_than_sets(spark):
    """Also where one set is just above a doubling, and its sketch twice as long."""
    import numpy as np

    rnd, rows = random.Random(12), []
    for n in (5, 200, 1000, 1024, 2048, 9000):
        base = [rnd.getrandbits(64) for _ in range(n)]
        for gone, more in ((0, 0), (1, 0), (n // 20, n // 20), (n // 5, n // 5), (n, n), (0, max(1, n // 10))):
            other = base[gone:] + [rnd.getrandbits(64) for _ in range(more)]
            x, y = (jaccard.sketch(np.array(sorted(s), np.uint64)).tolist() for s in (base, other))
            rows.append((n, gone + more, x, y, n >= 200 and gone >= n // 5))
    out = spark.createDataFrame(rows, "n int, apart int, x array<bigint>, y array<bigint>, far boolean")
    got = out.select("*", jaccard._differ(F.col("x"), F.col("y")).alias("xy"), jaccard._differ(F.col("y"), F.col("x")).alias("yx")).collect()
    assert any(len(r.x) != len(r.y) for r in got)
    for r in got:
        assert r.xy == r.yx <= r.apart
        assert not r.far or 190 * r.xy > 20 * r.n  # such sets do not link at 90 %


def test_sets_near_each_other_that_do_not_link_send_no_n_grams(spark, monkeypatch):
    """Members of a family share prefix n-grams; their sketches end the comparison."""
    rnd, before, made = random.Random(14), jaccard.stored, {}
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(30):
        text = list(base)
        for k in rnd.sample(range(300), 6):
            text[k] = f"own{i}x{k}"
        rows.append((i, " ".join(text), None, None, None))

    def counted(df, label):
        table = before(df, label)
        made[label] = table.count()
        return table

    monkeypatch.setattr(jaccard, "stored", counted)
    out = {r.doc_id: r.component_id for r in jaccard.similar_groups(frame(spark, rows)).collect()}
    assert out == {i: c for i, (_, c) in brute.similar(rows).items()} and len(set(out.values())) == 30
    assert made["met"] <= 30 and made["pairs"] <= 3 and "grams" not in made


def test_only_documents_that_are_compared_move(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    pairs = spark.createDataFrame([(i, i + 1) for i in range(0, 100, 10)] + [(0, 1999)], "lead bigint, q bigint")
    left = {r.doc_id for r in jaccard._asked(docs, pairs).collect()}
    assert left >= {0, 1, 10, 91, 1999} and len(left) <= 30
