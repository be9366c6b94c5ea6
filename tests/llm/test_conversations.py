"""Repair of conversations against a plain program over (cost, audit) and against all edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from fleetwatt.llm import conversations as talk
from fleetwatt.llm.queries import QUERIES
from tests.conftest import SF_DIR

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NOT_WHITE = re.compile(r"[^\x20\x09-\x0D]")
FORM = re.compile(r"(s?(ua)+)?")
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def flaws(rows):
    """Rows in order with their first faults."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = NOT_WHITE.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return rows, out


def least(rows, fault):
    """Cheapest (cost, audit, repaired rows), from the end."""
    step = lambda q, x: {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, x))
    best = {0: (0, "", ()), 3: (0, "", ())}

    def inserts(best):
        for _ in range(3):
            for q in range(4):
                for who in ("user", "assistant"):
                    then = best.get(step(q, who[0]))
                    if then:
                        made = (then[0] + 5, "I" + then[1], ((who, ""), *then[2]))
                        best[q] = min(best.get(q, made), made)
        return best

    best = inserts(best)
    for (_, _, role, text), f in zip(reversed(rows), reversed(fault)):
        now = {}
        for q in range(4):
            ways = [(best[q][0] + 2, "D" + best[q][1], best[q][2])] if q in best else []
            if f not in ("blank", "duplicate"):
                for cost, letter, who in ((0, "K", role), (1, "R", "user"), (1, "R", "assistant")):
                    then = best.get(step(q, who[:1]))
                    if then:
                        ways.append((then[0] + cost + 5 * (f == "truncated"), letter + then[1], ((who, text), *then[2])))
            if ways:
                now[q] = min(ways)
        best = inserts(now)
    return best[0]


def expected(rows):
    rows, fault = flaws(rows)
    cost, audit, kept = least(rows, fault)
    turns = [t for _, t, _, _ in rows if t is not None]
    first = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[fault.count(k) for k in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )


def by_conversation(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def random_rows(seed, conversations=60, longest=9):
    rnd = random.Random(seed)
    texts = ["one.", "two!", "three?", "four", "", " \n", "end.  ", "x", None, "dots ... no", "é😀."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "ua"]
    rows = []
    for c in range(conversations):
        for t in range(rnd.randrange(1, longest)):
            turn = None if rnd.random() < 0.05 else t + (rnd.random() < 0.1)
            role = roles[(t + (rnd.random() < 0.2)) % 2] if rnd.random() < 0.7 else rnd.choice(roles)
            rows.append((None if c == 7 else c, turn, role, rnd.choice(texts) if rnd.random() < 0.5 else f"text {rnd.randrange(99)}."))
    return rows + rows[3:5]


def summary(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


@pytest.mark.parametrize("block_rows", [talk.BLOCK_ROWS, 3, 1])
def test_random_conversations(spark, block_rows):
    rows = random_rows(block_rows)
    mended = talk.repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5), block_rows)
    plain = [tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)) for r in rows]
    assert summary(talk.summaries(mended)) == {c: expected(r) for c, r in by_conversation(plain).items()}


def test_one_conversation_holds_most_rows(spark):
    rnd = random.Random(9)
    rows = [(1, t, rnd.choice(["user", "assistant"]), rnd.choice(["a.", "b", f"c{t}!", ""])) for t in range(900)]
    rows += [(1, None, "user", "same.")] * 300 + [(2, 0, "user", "q?"), (2, 1, "assistant", "r.")]
    df = spark.createDataFrame(rows, SCHEMA)
    mended = talk.repair_conversations(df, 50)
    assert summary(talk.summaries(mended)) == {c: expected(r) for c, r in by_conversation(rows).items()}
    turns = sorted(talk.repaired_turns(mended.where("conv_id = 1")).collect(), key=lambda r: (r.seq, r.place))
    assert FORM.fullmatch("".join(r.role[0] for r in turns))


def test_least_of_all_edits():
    """The plain program itself, against every sequence of edits with up to three inserts."""
    rnd = random.Random(2)
    for _ in range(60):
        rows = [(1, t, rnd.choice(["user", "assistant", "system", "x"]), rnd.choice(["a.", "b", f"t{t}.", ""])) for t in range(rnd.randrange(1, 4))]
        rows, fault = flaws(rows)
        found = []
        for spots in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(len(rows) + 1), k) for k in range(4)):
            for edits in itertools.product(*[["D"] if f in ("blank", "duplicate") else ["K", "D", "Ru", "Ra"] for f in fault]):
                for who in itertools.product("ua", repeat=len(spots)):
                    out, audit, cost = "", "", 5 * len(spots)
                    for i in range(len(rows) + 1):
                        for s, w in zip(spots, who):
                            if s == i:
                                out, audit = out + w, audit + "I"
                        if i < len(rows):
                            e, f = edits[i], fault[i]
                            audit += e[0]
                            cost += {"K": 0, "R": 1, "D": 2}[e[0]] + (5 if e != "D" and f == "truncated" else 0)
                            out += "" if e == "D" else rows[i][2][0] if e == "K" else e[1]
                    if FORM.fullmatch(out):
                        found.append((cost, audit))
        assert min(found) == least(rows, fault)[:2]


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = by_conversation(damaged(rows))
    out = summary(QUERIES["op13_conversation_repair"](spark, SF_DIR))
    assert out == {c: expected(after.get(c, [])) for c in by_conversation(rows)}


def test_dropped_conversations_are_listed(spark, tmp_path):
    rows = random_rows(4, 80, 3)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    after = by_conversation(damaged(rows))
    out = summary(QUERIES["op13_conversation_repair"](spark, str(tmp_path)))
    assert out == {c: expected(after.get(c, [])) for c in by_conversation(rows)}
    assert any(c not in after for c in out)


def test_no_rows_and_clashing_columns(spark):
    assert talk.summaries(talk.repair_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(1, 0, "user", "a?", 1, "x"), (1, 1, "assistant", "b.", 2, "y")]
    more = spark.createDataFrame(rows, SCHEMA + ", seq int, fault string")
    assert summary(talk.summaries(talk.repair_conversations(more)))[1][5:7] == (0, "KK")
    long = [(1, 0, "user", "w" * 300_000 + "."), (1, 1, "assistant", " " * 200_000)]
    assert summary(talk.summaries(talk.repair_conversations(spark.createDataFrame(long, SCHEMA)))) == {1: expected(long)}
