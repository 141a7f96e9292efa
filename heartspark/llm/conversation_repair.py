"""Conversation structure repair by a checkpointed dynamic programme.

The turns of a conversation are edited at least cost so that the initials of their roles read
``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert of an empty user or
assistant turn 3. Blank and repeated turns must be deleted; a truncated turn that stays adds 3. Of
the cheapest edits, those whose initials come first in ASCII order are taken.

The programme's state is the role of the last turn that stays, so a stretch of turns is a 4 x 4
table of costs. Turns are sorted by range and cut into blocks that get longer as a conversation goes
on (block k has k turns, 32 at least), so that n turns make about the square root of 2n blocks of at
most that length. Then

* a walk backward over the blocks' tables stores the vector of costs to the end, by state, at block
  borders only (the checkpoints);
* each block by itself computes its own vectors again from the checkpoint behind it, and where a walk
  forward would leave it from each state;
* a walk forward over these gives each block's first state, and each block by itself emits its edits.

The two walks over borders see a few numbers and a byte a turn, a row at a time; all else runs block by block, so
a conversation of any length is spread over tasks, and no task holds more than a block of it.

Results by definition: null roles and texts are one space; turns are taken by turn number, nulls first,
equal ones by role, then by hash of role and text; equal rows of one turn number are one turn and repeats; conversations
whose id is null are one; long texts are carried whole; a conversation without rows isn't in the result (the
query adds those whose rows are all dropped); an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .rows import cut, pick

BLANKS = "\x20\t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NONE = 1 << 50  # a cost that nothing reaches

#: States: nothing kept yet, then the last kept turn's initial s, u or a.
START, USER, ASSISTANT = 0, 2, 3
#: By state: the state after a kept turn whose initial is s, u, a or another; None if it can't follow.
LEADS = ((1, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
#: By state: the state after the one turn that may be inserted, or given another role, there.
NEEDED = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
INITIALS = {"s": 0, "u": 1, "a": 2}

LEAST_TURNS = 32  # of a block, unless the conversation ends or its texts are long
MOST_CHARS = 1 << 22  # of a block of several turns


def with_inserts(costs: list[int]) -> list[int]:
    """Costs by state, if turns may be inserted first."""
    u, a = min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
    return [min(costs[START], INSERT + u), min(costs[1], INSERT + u), u, a]


END = with_inserts([0, NONE, NONE, 0])


def before(kind: int, after: list[int]) -> list[int]:
    """Costs to the end by the state before a turn, from those after it. ``kind``: 0 to 3 for the initial s, u, a or
    another; 4 more if truncated, 8 more if it must go."""
    costs = [DELETE + c for c in after]
    if kind < 8:
        more = TRUNCATED if kind >= 4 else 0
        for s in range(4):
            t = LEADS[s][kind % 4]
            if t is not None:
                costs[s] = min(costs[s], more + after[t])
            costs[s] = min(costs[s], more + REROLE + after[NEEDED[s]])
    return with_inserts(costs)


def vectors(kinds: bytes, end: list[int]) -> list[list[int]]:
    """Costs to the end by state before each turn of a block, and ``end`` after the last."""
    found = [end]
    for kind in reversed(kinds):
        found.append(before(kind, found[-1]))
    return found[::-1]


def table(kinds: bytes) -> list[int]:
    """Costs of a block by state before and state after, row by row."""
    columns = [vectors(kinds, [0 if s == t else NONE for s in range(4)])[0] for t in range(4)]
    return [columns[t][s] for s in range(4) for t in range(4)]


def through(block: list[int], end: list[int]) -> list[int]:
    return [min(block[4 * s + t] + end[t] for t in range(4)) for s in range(4)]


def tight_edits(kinds: bytes, state: int, end: list[int], last: bool) -> tuple[str, int]:
    """The ASCII-least of a block's cheapest edits from a state, and the state that they end in."""
    costs, edits = vectors(kinds, end), []
    for kind, here, after in zip(kinds, costs, costs[1:]):
        more = TRUNCATED if kind >= 4 else 0
        while True:
            if DELETE + after[state] == here[state]:
                edits.append("D")
                break
            if INSERT + here[NEEDED[state]] == here[state]:
                edits.append("I")
                state = NEEDED[state]
                continue
            t = LEADS[state][kind % 4]
            if t is not None and more + after[t] == here[state]:
                edits.append("K")
                state = t
            else:
                edits.append("R")
                state = NEEDED[state]
            break
    while last and state not in (START, ASSISTANT):
        edits.append("I")
        state = NEEDED[state]
    return "".join(edits), state


def applied(edits: str, state: int, kinds: bytes, roles: list[str], texts: list[str]) -> tuple[int, list[str], list[str]]:
    """Cost, roles and texts of a block's turns after its edits."""
    cost, i, out_roles, out_texts = 0, 0, [], []
    for edit in edits:
        if edit == "I":
            cost += INSERT
            state = NEEDED[state]
            out_roles.append(NAMES[state])
            out_texts.append("")
            continue
        if edit == "D":
            cost += DELETE
        else:
            cost += TRUNCATED if kinds[i] >= 4 else 0
            cost += REROLE if edit == "R" else 0
            state = NEEDED[state] if edit == "R" else LEADS[state][kinds[i] % 4]
            out_roles.append(NAMES[state] if edit == "R" else roles[i])
            out_texts.append(texts[i])
        i += 1
    return cost, out_roles, out_texts


class Block:
    """Turns of one conversation, one after the other, and what is counted of them."""

    def __init__(self, conv, number: int):
        self.conv, self.number = conv, number
        self.kinds, self.roles, self.texts, self.chars = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        body = text.rstrip(BLANKS)
        kind = INITIALS.get(role[:1], 3)
        if not body:
            self.blank += 1
            kind += 8
        elif seen:
            self.duplicate += 1
            kind += 8
        elif body[-1] not in ".!?":
            self.truncated += 1
            kind += 4
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.kinds.append(kind)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.kinds) >= max(LEAST_TURNS, self.number) or self.chars >= MOST_CHARS


COUNTS = ("blank", "duplicate", "truncated", "illegal", "n_turns", "first_turn", "last_turn")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns of a partition, as blocks with ids that go on in the order of turns."""
    block, before_this, uid, conv_type = None, None, 0, None

    def out(b: Block, kind: pa.DataType) -> pa.RecordBatch:
        kinds = bytes(b.kinds)
        return pa.RecordBatch.from_arrays([
            pa.array([b.conv], kind), pa.array([uid], pa.int64()), pa.array([kinds], pa.binary()), pa.array([table(kinds)], pa.list_(pa.int64())),
            pa.array([b.roles], pa.list_(pa.string())), pa.array([b.texts], pa.list_(pa.string())),
            *[pa.array([getattr(b, name)], pa.int64()) for name in COUNTS]], names=["conv", "uid", "kinds", "costs", "roles", "texts", *COUNTS])

    for batch in batches:
        conv_type = batch.schema.field("conv").type
        for conv, turn, role, text, h, later, part in zip(*[c.to_pylist() for c in batch.columns]):
            same = before_this is not None and before_this[0] == conv
            if block is None:
                uid = part << 40
            if block is not None and (not same or block.full()):
                yield out(block, conv_type)
                uid += 1
                block = Block(conv, block.number + 1 if same else 0)
            elif block is None:
                block = Block(conv, 0)
            block.add(turn, role, text, later or (same and before_this[1:] == (turn, h)))
            before_this = (conv, turn, h)
    if block is not None:
        yield out(block, conv_type)


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from the last to the first: the costs to the end by state behind each."""
    now, costs, begun = None, END, False
    for batch in batches:
        ends, lasts = [], []
        for conv, block in zip(batch.column("conv").to_pylist(), batch.column("costs").to_pylist()):
            if not begun or conv != now:
                now, costs, begun = conv, END, True
                lasts.append(True)
            else:
                lasts.append(False)
            ends.append(costs)
            costs = through(block, costs)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("uid"), batch.column("kinds"), pa.array(ends, pa.list_(pa.int64())), pa.array(lasts)],
                                         names=["conv", "uid", "kinds", "ends", "last"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that a block's edits end in, by the state that they begin in."""
    for batch in batches:
        kinds, ends, lasts = (batch.column(name).to_pylist() for name in ("kinds", "ends", "last"))
        found = [[tight_edits(k, s, e, last)[1] for s in range(4)] for k, e, last in zip(kinds, ends, lasts)]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("uid"), batch.column("ends"), batch.column("last"), pa.array(found, pa.list_(pa.int32()))],
                                         names=["conv", "uid", "ends", "last", "exits"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from the first to the last: the state that each begins in."""
    now, state, begun = None, START, False
    for batch in batches:
        states = []
        for conv, exits in zip(batch.column("conv").to_pylist(), batch.column("exits").to_pylist()):
            if not begun or conv != now:
                now, state, begun = conv, START, True
            states.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("ends"), batch.column("last"), pa.array(states, pa.int32())],
                                         names=["uid", "ends", "last", "state"])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's edits, their cost and the turns that they leave."""
    for batch in batches:
        rows = zip(*[batch.column(name).to_pylist() for name in ("kinds", "state", "ends", "last", "roles", "texts")])
        done = []
        for kinds, state, end, last, roles, texts in rows:
            edits, _ = tight_edits(kinds, state, end, last)
            done.append((edits, *applied(edits, state, kinds, roles, texts)))
        columns = [pa.array([r[i] for r in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())))]
        ends_of = [pa.array([(r or [""])[i][:1] for r in batch.column("roles").to_pylist()], pa.string()) for i in (0, -1)]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("uid"), *columns, *ends_of, *[batch.column(name) for name in COUNTS]],
                                         names=["conv", "uid", "edits", "cost", "roles", "texts", "first_initial", "last_initial", *COUNTS])


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Pieces of the repaired conversations in order of ``uid``: the edits' initials, their cost, roles and texts of the turns that are left, and counts."""
    ship_package(turns.sparkSession)
    rows = pick(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    kind = rows.schema["conv"].dataType.simpleString()
    rows = rows.select("conv", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("h", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # Where a role and text occur again: their first turn. A row of a later turn has been seen; equal rows of one turn meet in the sort.
    again = (rows.groupBy("conv", "h").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("conv").alias("conv2"), F.col("h").alias("h2"), F.col("first.turn").alias("first"), F.lit(True).alias("found")))
    rows = rows.join(again, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("h") == F.col("h2")), "left")
    later = F.coalesce(F.col("found") & ~F.col("turn").eqNullSafe(F.col("first")), F.lit(False))
    order = ["conv", "turn", "role", "h"]
    rows = rows.select("conv", "turn", "role", "text", "h", later.alias("later")).repartitionByRange(*order).sortWithinPartitions(*order)
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    blocks = cut(turns.sparkSession, rows.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(
        _blocks, f"conv {kind}, uid bigint, kinds binary, costs array<bigint>, roles array<string>, texts array<string>, {counts}"))

    borders = blocks.select("conv", "uid", "kinds", "costs").repartition("conv").sortWithinPartitions(F.desc("conv"), F.desc("uid"))
    ends = borders.mapInArrow(_checkpoints, f"conv {kind}, uid bigint, kinds binary, ends array<bigint>, last boolean").repartition("uid")
    exits = ends.mapInArrow(_exits, f"conv {kind}, uid bigint, ends array<bigint>, last boolean, exits array<int>")
    entries = exits.repartition("conv").sortWithinPartitions("conv", "uid").mapInArrow(_entries, "uid bigint, ends array<bigint>, last boolean, state int")
    return blocks.join(entries, "uid").mapInArrow(
        _repaired, f"conv {kind}, uid bigint, edits string, cost bigint, roles array<string>, texts array<string>, "
                   f"first_initial string, last_initial string, {counts}").withColumnRenamed("conv", conv_col)


def repaired_turns(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, uid, position, role, text): the turns that are left, in order of uid and position."""
    each = F.posexplode(F.arrays_zip("roles", "texts"))
    return pieces.select(conv_col, "uid", each.alias("position", "t")).select(
        conv_col, "uid", "position", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))


DIGESTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order: a row for each conversation. Texts are hashed piece by piece."""
    one, kind = None, None

    def out(x: dict) -> pa.RecordBatch:
        gaps = 0 if x["first"] is None else x["last"] - x["first"] + 1 - x["n_turns"]
        return pa.RecordBatch.from_arrays([
            pa.array([x["conv"]], kind), *[pa.array([gaps if name == "gaps" else x[name]], pa.int64()) for name in DIGESTS],
            pa.array(["".join(x["edits"])]), pa.array([x["sha"].hexdigest()])], names=["conv", *DIGESTS, "audit", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for r in batch.to_pylist():
            if one is None or one["conv"] != r["conv"]:
                if one is not None:
                    yield out(one)
                one = dict.fromkeys(DIGESTS, 0) | {"conv": r["conv"], "n_turns": 0, "first": None, "last": None, "initial": None, "edits": [],
                                                   "sha": hashlib.sha256(), "empty": True}
            for name in DIGESTS[1:]:
                one[name] += r[name]
            if one["initial"] is not None and one["initial"] + r["first_initial"] not in LEGAL:
                one["illegal"] += 1
            one["initial"] = r["last_initial"]
            if r["first_turn"] is not None:
                one["n_turns"] += r["n_turns"] - (one["last"] == r["first_turn"])
                one["first"] = r["first_turn"] if one["first"] is None else one["first"]
                one["last"] = r["last_turn"]
            one["edits"].append(r["edits"])
            for role, text in zip(r["roles"], r["texts"]):
                one["sha"].update(f"{'' if one['empty'] else chr(10)}{role}:{text}".encode())
                one["empty"] = False
    if one is not None:
        yield out(one)


def digests(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, gaps, counts of faults, cost, audit, repaired_sha256) of each conversation."""
    kind = pieces.schema[conv_col].dataType.simpleString()
    rows = pieces.withColumnRenamed(conv_col, "conv").repartition("conv").sortWithinPartitions("conv", "uid")
    schema = f"conv {kind}, {', '.join(f'{name} bigint' for name in DIGESTS)}, audit string, repaired_sha256 string"
    return rows.mapInArrow(_digests, schema).withColumnRenamed("conv", conv_col)


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's damage, by the remainder of a row's crc32 by 20: 0 drops it, 1 empties its text, 2 takes away marks
    of sentence ends, 3 repeats it, 4 makes its role user."""
    space = F.lit(" ")

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.withColumn("d", F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20).where("d <> 0")
    text = F.when(F.col("d") == 1, F.lit("")).when(F.col("d") == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(F.col("d") == 4, F.lit("user")).otherwise(said("role"))
    copies = F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_digests(conversations: DataFrame) -> DataFrame:
    """The query: every conversation's digest after damage and repair; zeros and the empty text's hash where no row is left."""
    found = digests(repair(damaged(conversations))).withColumnRenamed("conv_id", "conv")
    every = pick(conversations, conv_id="conv_id").distinct()
    default = {name: F.lit(0).cast("long") for name in DIGESTS} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(F.col(name), value).alias(name) for name, value in default.items()])
