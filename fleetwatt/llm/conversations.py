"""Repair of the structure of conversations by cheapest edits.

A conversation is a path of rows, and a repaired one is `(s?(ua)+)?` in the initials of its roles. Edits
keep, rerole, delete or insert rows. Costs to go follow from a dynamic program over the states of that
expression. The arcs that keep to the least cost form a graph whose nodes are ranked by the least
audit strings of 1, 2, 4, ... letters that begin there; the ranks select the least path, which is read off
through pointers of doubled length.

Rows are range-partitioned in the order of the conversations and packed in blocks of bounded size.
A conversation that lies in one block is repaired there. The blocks of a longer one give the costs
between states at their two ends; these carry the costs to go back to each block, and the states reached on
to the next one, so that no task holds a long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from fleetwatt.llm.steps import stored

BLOCK_ROWS = 4096
BLOCK_CHARS = 4_000_000
SALTS = 8

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LETTERS = np.frombuffer(b"DIKR", np.uint8)  # in ASCII order
NEVER = 1 << 40

# States: nothing yet, after s, after u, after a. What comes next there, and what a kept row leads to.
NEXT = np.array([2, 2, 3, 2])
INITIALS = {"s": 0, "u": 1, "a": 2}
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])  # state, initial
END = np.array([0, INSERT * 2, INSERT, 0])
LEGAL = {"su", "ua", "au"}
CLEAN, BLANK, DUPLICATE, CUT = range(4)
WHITE = " \t\n\x0b\x0c\r"


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text with planted faults, by crc32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 takes its [.!?], 3 repeats it, 4 makes the role user.
    A NULL id or turn is written as one space there; a NULL role or text becomes one.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    kind = F.crc32(name.cast("binary")) % 20
    body = F.coalesce(F.col(text), F.lit(" "))
    body = F.when(kind == 1, "").when(kind == 2, F.translate(body, ".!?", "")).otherwise(body)
    who = F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" ")))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    made = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), who.alias("role"), body.alias("text"), times.alias("_n")
    )
    return made.where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, _n, fault: equal rows counted, each with the fault of its first copy.

    The later copies are duplicates, or blank if they are. A row is a duplicate if its role and text
    occur in an earlier row. The order is by turn (NULL first), role and text. Equal texts are found
    by a 128-bit hash, so that only the rows themselves carry texts.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("_n")).withColumn("_hash", F.md5("text"))
    when = F.struct(F.col("turn").isNotNull(), "turn")
    hashed = rows.withColumn("_hash", F.md5("text")).groupBy("conv_id", "turn", "role", "_hash").agg(F.lit(1).alias("_"))
    first = hashed.groupBy("conv_id", "role", "_hash").agg(F.min(when).alias("_first"), F.count("*").alias("_k"))
    first = first.where("_k > 1").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    first = first.withColumnsRenamed({c: f"_{c}" for c in ("conv_id", "role")} | {"_hash": "_same"})
    salted = counted.withColumn("_salt_", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("_hash") == F.col("_same"))
    joined = salted.join(first, same & (F.col("_salt_") == F.col("_salt")), "left")
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (
        F.when(body == "", BLANK)
        .when(F.col("_first").isNotNull() & (F.col("_first") < when), DUPLICATE)
        .when(F.right(body, F.lit(1)).isin(".", "!", "?"), CLEAN)
        .otherwise(CUT)
    )
    return joined.select("conv_id", "turn", "role", "text", "_n", fault.alias("fault"))


def _block_schema(conv: T.DataType) -> T.StructType:
    schema = T.StructType([T.StructField("conv_id", conv), T.StructField("seq", T.LongType()), T.StructField("whole", T.BooleanType())])
    for name in ("roles", "texts"):
        schema.add(name, T.ArrayType(T.StringType()))
    schema.add("fault", T.ArrayType(T.IntegerType()))
    for name in ("low", "high", "turns", "illegal"):
        schema.add(name, T.LongType())
    return schema


class _Block:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv, seq: int):
        self.conv, self.seq = conv, seq
        self.roles, self.texts, self.fault = [], [], []
        self.low = self.high = None
        self.turns = self.chars = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.fault.append(fault)
        self.chars += len(text)
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def full(self, most: int) -> bool:
        return len(self.roles) >= most or self.chars >= BLOCK_CHARS

    def row(self, whole: bool) -> tuple:
        first = [r[:1] for r in self.roles]
        illegal = sum(a + b not in LEGAL for a, b in zip(first, first[1:]))
        return self.conv, self.seq, whole, self.roles, self.texts, self.fault, self.low, self.high, self.turns, illegal


def _pack(batches: Iterator[pa.RecordBatch], schema: pa.Schema, block_rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one sorted partition. Its first and last conversation may go on in another one."""
    seq = TaskContext.get().partitionId() << 32
    held, size = [], 0
    now, blocks_of, at_edge = None, 0, True

    def take(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for conv, turn, role, text, n, fault in zip(*[c.to_pylist() for c in batch.columns]):
            for copy in range(n):
                if now is None or now.conv != conv or now.full(block_rows):
                    if now is not None:
                        ended = now.conv != conv
                        held.append(now.row(ended and not at_edge and blocks_of == 1))
                        size += now.chars
                        at_edge, blocks_of = at_edge and not ended, 1 if ended else blocks_of + 1
                    else:
                        blocks_of = 1
                    now, seq = _Block(conv, seq), seq + 1
                    if size > BLOCK_CHARS or len(held) >= 2048:
                        yield take(held)
                        held, size = [], 0
                now.add(turn, role, text, fault if copy == 0 or fault == BLANK else DUPLICATE)
    if now is not None:
        held.append(now.row(False))
    if held:
        yield take(held)


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of the conversations in order (seq), and whether one is a `whole` conversation for certain."""
    prefix = F.substring("text", 1, 64)  # what a range boundary may hold
    ranged = faults(rows).repartitionByRange("conv_id", "turn", "role", prefix)
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = _block_schema(rows.schema["conv_id"].dataType)
    return ordered.mapInArrow(_with_schema(partial(_pack, block_rows=block_rows), schema), schema)


def _with_schema(fn, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return lambda batches: fn(batches, schema=arrow)


# --- one or more blocks at once -----------------------------------------------------------


class _Graph:
    """Costs to go and optimal arcs of several blocks; node = 4 * layer + state, one layer per row and one at the end."""

    def __init__(self, roles: list[list[str]], fault: list[list[int]], ends: np.ndarray, last: np.ndarray):
        self.sizes = np.array([len(r) for r in roles])
        self.layer = np.r_[0, np.cumsum(self.sizes + 1)]  # first layer of each block
        count = int(self.layer[-1])
        self.initial, flaw = np.full(count, 3), np.zeros(count, np.int64)
        for at, r, f in zip(self.layer, roles, fault):
            self.initial[at : at + len(r)] = [INITIALS.get(x[:1], 3) for x in r]
            flaw[at : at + len(f)] = f
        self.gone = (flaw == BLANK) | (flaw == DUPLICATE)
        self.extra = np.where(flaw == CUT, TRUNCATED, 0)
        self.cost = np.zeros((count, 4), np.int64)
        self.at_end = self.layer[1:] - 1
        self.cost[self.at_end] = ends
        self.last = last
        self._costs()

    def _steps(self, layers: np.ndarray, after: np.ndarray) -> list[np.ndarray]:
        """Costs to go by deleting, keeping and reroling the rows of some layers."""
        stays = np.where(self.gone[layers], NEVER, self.extra[layers])[:, None]
        to = KEPT.T[self.initial[layers]]
        keep = np.where(to < 0, NEVER, np.take_along_axis(after, np.maximum(to, 0), 1)) + stays
        return [after + DELETE, keep, after[:, NEXT] + REROLE + stays]

    def _costs(self) -> None:
        longest_first = np.argsort(-self.sizes, kind="stable")
        sizes = self.sizes[longest_first]
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            some = longest_first[: np.searchsorted(-sizes, -back, "right")]
            layers = self.at_end[some] - back
            g = np.minimum.reduce(self._steps(layers, self.cost[layers + 1]))
            after_u = np.minimum(g[:, 2], g[:, 3] + INSERT)
            after_a = np.minimum(g[:, 3], g[:, 2] + INSERT)
            begun = np.minimum(g[:, :2], after_u[:, None] + INSERT)
            self.cost[layers] = np.c_[begun, after_u, after_a]

    def paths(self):
        """Pointers of doubled length, the letter of each node's least arc, and its number of letters."""
        count = len(self.cost)
        rows = np.setdiff1d(np.arange(count), self.at_end)
        inside, whole = np.zeros(count, bool), np.arange(count)[:, None] * 4
        inside[rows] = True
        d, k, r = (np.full((count, 4), NEVER * 4) for _ in range(3))
        for array, part in zip((d, k, r), self._steps(rows, self.cost[rows + 1])):
            array[rows] = part
        may_insert = inside.copy()
        may_insert[self.at_end[self.last]] = True
        i = np.where(may_insert[:, None], self.cost[:, NEXT] + INSERT, NEVER * 4)
        optimal = np.stack([x == self.cost for x in (d, i, k, r)], 2).reshape(-1, 4)
        to = [whole + 4 + np.arange(4), whole + NEXT, whole + 4 + KEPT.T[self.initial], whole + 4 + NEXT]
        target = np.stack([np.broadcast_to(x, (count, 4)) for x in to], 2).reshape(-1, 4)
        node, ends = np.arange(4 * count), ~optimal.any(1)
        target = np.where(optimal, target, node[:, None])

        # Arcs of one node have different letters, so a least string of any length has one end.
        first = np.argmax(optimal, 1)
        rank, jump = np.where(ends, 0, first + 1), np.where(ends, node, target[node, first])
        steps = (~ends).astype(np.int64)
        jumps, reach = [jump], steps
        while (~ends[jump]).any():
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
            reach = reach + reach[jump]
            jump = jump[jump]
            jumps.append(jump)
        # The ranks of all letters to the end select the arc.
        worth = np.where(optimal, np.arange(4) * (int(rank.max()) + 1) + rank[target], np.iinfo(np.int64).max)
        letter = np.argmin(worth, 1)
        return jumps, letter, reach, ends

    def exits(self, entry: int) -> np.ndarray:
        """State at the end of each block, entered in a state."""
        return self.paths()[0][-1][4 * self.layer[:-1] + entry] % 4


def _matrices(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Least cost between each state before a block and each one after it."""
    for batch in batches:
        conv, seq, roles, fault, low, high = batch.columns
        roles, fault = roles.to_pylist(), fault.to_pylist()
        parts = []
        for state in range(4):
            ends = np.full((len(roles), 4), NEVER)
            ends[:, state] = 0
            graph = _Graph(roles, fault, ends, np.zeros(len(roles), bool))
            parts.append(graph.cost[graph.layer[:-1]])
        matrix = np.stack(parts, 2).reshape(len(roles), 16).tolist()
        sides = [pa.array([r[k][:1] for r in roles], pa.string()) for k in (0, -1)]
        yield pa.RecordBatch.from_arrays([conv, seq, pa.array(matrix, schema.field("matrix").type), *sides, low, high], schema=schema)


def _back(group: pd.DataFrame) -> pd.DataFrame:
    """Costs to go at the end of each block of one conversation, and what its two neighbours share."""
    group = group.sort_values("seq")
    after, out = END, []
    for m in reversed(group["matrix"].tolist()):
        out.append(list(after))
        after = (np.array(m).reshape(4, 4) + np.array(after)).min(1)
    sides = list(zip(group["last_initial"], group["first_initial"].tolist()[1:]))
    known, shared, before = group[["low", "high"]].astype("object").where(group[["low", "high"]].notna(), None), [], None
    for low, high in zip(known["low"], known["high"]):
        shared.append(int(low is not None and low == before))
        before = high if high is not None else before
    return pd.DataFrame(
        {
            "seq": group["seq"],
            "ends": out[::-1],
            "last": [False] * (len(group) - 1) + [True],
            "joint_illegal": [0] + [int(a + b not in LEGAL) for a, b in sides],
            "joint_turns": shared,
        }
    )


def _exits(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, seq, roles, fault, ends, last = batch.columns
        graph = _Graph(roles.to_pylist(), fault.to_pylist(), np.array(ends.to_pylist()), np.array(last.to_pylist(), bool))
        through = np.stack([graph.exits(q) for q in range(4)], 1).tolist()
        yield pa.RecordBatch.from_arrays([conv, seq, pa.array(through, schema.field("through").type)], schema=schema)


def _forth(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which each block of one conversation is entered."""
    group = group.sort_values("seq")
    state, out = 0, []
    for through in group["through"]:
        out.append(state)
        state = int(through[state])
    return pd.DataFrame({"seq": group["seq"], "entry": out})


def _mend(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        roles, texts, fault = (get[n].to_pylist() for n in ("roles", "texts", "fault"))
        entry = np.array(get["entry"].to_pylist())
        graph = _Graph(roles, fault, np.array(get["ends"].to_pylist()), np.array(get["last"].to_pylist(), bool))
        jumps, letter, reach, _ = graph.paths()
        start = 4 * graph.layer[:-1] + entry
        lengths = reach[start]
        node = np.repeat(start, lengths)
        step = np.arange(len(node)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        for k, jump in enumerate(jumps):
            node = np.where(step >> k & 1, jump[node], node)
        audit = LETTERS[letter[node]].tobytes().decode()
        row, state = node // 4 - np.repeat(graph.layer[:-1], lengths), node % 4
        edits, new_roles, new_texts, cuts, at = [], [], [], [0], 0
        for b, n in enumerate(lengths.tolist()):
            for x, i, q in zip(audit[at : at + n], row[at : at + n].tolist(), state[at : at + n].tolist()):
                edits.append(x)
                new_roles.append(roles[b][i] if x in "DK" else "assistant" if q == 2 else "user")
                new_texts.append("" if x == "I" else texts[b][i])
            at += n
            cuts.append(at)
        turns = pa.ListArray.from_arrays(
            pa.array(cuts, pa.int32()),
            pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in (edits, new_roles, new_texts)], ["edit", "role", "text"]),
        )
        count = lambda kind: pa.array([sum(f == kind for f in x) for x in fault], pa.int64())
        out = {
            **get,
            "edits": turns.cast(schema.field("edits").type),
            "blank": count(BLANK),
            "duplicate": count(DUPLICATE),
            "truncated": count(CUT),
            "cost": pa.array((graph.cost[graph.layer[:-1], entry] - _end_cost(graph, jumps, start)).tolist(), pa.int64()),
        }
        yield pa.RecordBatch.from_arrays([out[f.name] for f in schema], schema=schema)


def _end_cost(graph: _Graph, jumps: list[np.ndarray], start: np.ndarray) -> np.ndarray:
    """What is still to be paid in the blocks that follow."""
    last = jumps[-1][start]
    return graph.cost[last // 4, last % 4]


MENDED = ["low", "high", "turns", "illegal"]


def repair_conversations(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of repaired conversations: conv_id, seq, whole, edits [{edit, role, text}], counts and cost.

    rows: conv_id, turn, role, text; other columns are left out. Edits: K keeps a row, R gives it the role
    user or assistant, D deletes it, I inserts an empty one; of the cheapest sequences it is the least in
    ASCII order. Deleted rows are listed with their text. NULL roles and texts count as one space. A NULL
    conv_id is a conversation of its own, a NULL turn comes first. An empty table gives no blocks.
    """
    plain = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    packed = stored(blocks(plain, block_rows), "conversation_blocks")
    conv = rows.schema["conv_id"].dataType
    names = T.StructType([T.StructField("conv_id", conv), T.StructField("seq", T.LongType())])
    longs = T.ArrayType(T.LongType())
    sized = T.StructType(names.fields + [T.StructField("matrix", longs), T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()), T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])
    passed = T.StructType(names.fields + [T.StructField("through", longs)])

    long_ones = packed.where("NOT whole")
    matrix = long_ones.select("conv_id", "seq", "roles", "fault", "low", "high").mapInArrow(_with_schema(_matrices, sized), sized)
    back = stored(
        matrix.groupBy("conv_id").applyInPandas(_back, "seq bigint, ends array<bigint>, last boolean, joint_illegal bigint, joint_turns bigint"),
        "conversation_costs",
    )
    through = long_ones.select("conv_id", "seq", "roles", "fault").join(back.select("seq", "ends", "last"), "seq")
    through = through.select("conv_id", "seq", "roles", "fault", "ends", "last").mapInArrow(_with_schema(_exits, passed), passed)
    forth = through.groupBy("conv_id").applyInPandas(_forth, "seq bigint, entry int")

    columns = ["conv_id", "seq", "whole", "roles", "texts", "fault", "low", "high", "turns", "illegal", "ends", "last", "entry"]
    cut = long_ones.join(back, "seq").join(forth, "seq").withColumns(
        {"illegal": F.col("illegal") + F.col("joint_illegal"), "turns": F.col("turns") - F.col("joint_turns")}
    )
    here = packed.where("whole").withColumns(
        {"ends": F.array(*[F.lit(int(x)).cast("bigint") for x in END]), "last": F.lit(True), "entry": F.lit(0)}
    )
    schema = T.StructType(names.fields + [T.StructField("whole", T.BooleanType())])
    schema.add("edits", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("edit", "role", "text")])))
    for name in (*MENDED, "blank", "duplicate", "truncated", "cost"):
        schema.add(name, T.LongType())
    mend = _with_schema(_mend, schema)
    return here.select(columns).mapInArrow(mend, schema).unionByName(cut.select(columns).mapInArrow(mend, schema))


def repaired_turns(mended: DataFrame) -> DataFrame:
    """conv_id, seq, place, edit, role, text: the rows that stay, in order by seq and place."""
    rows = mended.select("conv_id", "seq", F.posexplode("edits").alias("place", "_e")).select("conv_id", "seq", "place", "_e.*")
    return rows.where("edit <> 'D'")


_SUMS = ["turns", "illegal", "blank", "duplicate", "truncated", "cost"]


def _join_blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks in order to conversations; texts are hashed as they come."""
    done, now = [], None

    def finish() -> tuple:
        gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        return (now["conv_id"], gaps, *[now[n] for n in ("blank", "duplicate", "truncated", "illegal", "cost")], "".join(now["audit"]), now["hash"].hexdigest())

    for batch in batches:
        for row in batch.to_pylist():
            if now is None or now["conv_id"] != row["conv_id"]:
                if now is not None:
                    done.append(finish())
                now = {"conv_id": row["conv_id"], "low": None, "high": None, "audit": [], "hash": hashlib.sha256(), "any": False, **dict.fromkeys(_SUMS, 0)}
            for n in _SUMS:
                now[n] += row[n]
            if row["low"] is not None:
                now["low"], now["high"] = row["low"] if now["low"] is None else now["low"], row["high"]
            now["audit"].append("".join(e["edit"] for e in row["edits"]))
            kept = "\n".join(f"{e['role']}:{e['text']}" for e in row["edits"] if e["edit"] != "D")
            if any(e["edit"] != "D" for e in row["edits"]):
                now["hash"].update((("\n" if now["any"] else "") + kept).encode("utf-8", "surrogatepass"))
                now["any"] = True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(finish(), schema)], schema=schema)


def summaries(mended: DataFrame) -> DataFrame:
    """One row per conversation: gaps, counts of faults, cost, audit, and the hash of its repaired rows.

    A hash runs over the whole conversation in order, so the blocks of a long one meet in one
    task; they pass through it one after the other.
    """
    schema = T.StructType([mended.schema["conv_id"]])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema.add(name, T.LongType())
    schema.add("audit", T.StringType()).add("repaired_sha256", T.StringType())
    join = _with_schema(_join_blocks, schema)
    columns = ["conv_id", "low", "high", *_SUMS, "edits"]
    short = mended.where("whole").select(columns).mapInArrow(join, schema)
    ordered = mended.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return short.unionByName(ordered.select(columns).mapInArrow(join, schema))
