"""Shards of equal bytes: balance, slots, groups, repeated rows, and independence of the ranges."""

import zlib
from collections import Counter, defaultdict

import pytest

from fleetwatt.llm import sharding
from fleetwatt.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm.texts import clashing, corpus, frame


def check(rows, out, shards=sharding.SHARDS):
    """Every row once, with the right size and checksum; slots gapless; bytes near one level."""
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    slots, held = defaultdict(list), Counter()
    for r in out:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        held[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return [held[s] for s in range(shards)]


def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op12_sharding"](spark, SF_DIR).collect()
    held = check(docs, out)
    share = sum(held) / len(held)
    assert all(abs(x - share) <= 2 * share / sharding.LARGE for x in held)
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}


def test_ranges_do_not_change_the_result(spark):
    rows = [(i, "w" * (i * 7919 % 97) + str(i % 300), None, None, None) for i in range(2500)]
    one, many = (
        sharding.document_shards(frame(spark, rows), range_rows=n).collect() for n in (10**9, 12)
    )
    assert sorted(one) == sorted(many)
    held = check(rows, many)
    assert max(held) - min(held) <= 4 * max(r.size for r in many)
    groups = defaultdict(set)
    for r in many:
        groups[r.text_hash].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) < sharding.SHARDS


def test_one_text_holds_most_rows(spark):
    rows = [(i, "same text" if i % 3 else f"own {i}", None, None, None) for i in range(3000)]
    held = check(rows, sharding.document_shards(frame(spark, rows), range_rows=25).collect())
    assert max(held) - min(held) <= 20


def test_one_row_many_times(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 50)
    rows = [(7, "again", None, None, None)] * 1777 + [(i, f"t{i}", None, None, None) for i in range(200)]
    held = check(rows, sharding.document_shards(frame(spark, rows), range_rows=20).collect())
    assert max(held) - min(held) <= 12


def test_awkward_rows(spark):
    rows = corpus()
    out = sharding.document_shards(clashing(spark, rows)).collect()
    held = check(rows, out)
    longest = max(r.size for r in out)
    assert max(held) == longest or max(held) - min(held) <= longest
    assert {"doc_id", "size", "text_crc32", "text_hash", "shard", "slot"} == set(out[0].asDict())


def test_no_rows_few_rows_and_other_sizes(spark):
    assert sharding.document_shards(frame(spark, [])).count() == 0
    check([(None, None)], sharding.document_shards(frame(spark, [(None, None, None, None, None)])).collect())
    plain = spark.createDataFrame([(str(i), None if i % 2 else 0) for i in range(40)], "name string, weight int")
    out = sharding.byte_shards(plain, ["name"], "weight", shards=4).collect()
    assert len(out) == 40
    out = sharding.byte_shards(spark.createDataFrame([(i, 10) for i in range(40)], "k int, weight int"), ["k"], "weight", shards=4).collect()
    assert Counter(r.shard for r in out) == {s: 10 for s in range(4)}


@pytest.mark.parametrize("loads,rest", [([0, 0, 0], 9), ([5, 0, 2], 4), ([100, 0], 3), ([0, 0], 0)])
def test_level(loads, rest):
    ends = sharding._levelled(loads, rest)
    parts = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == rest and all(p >= 0 for p in parts)
    full = [x + p for x, p in zip(loads, parts) if p]
    assert not full or max(full) - min(full) <= 1 + len(loads)


def test_plan_has_no_python(spark):
    plan = sharding.document_shards(frame(spark, corpus()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
