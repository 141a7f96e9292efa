"""Conversation repair against all edit sequences, by hand, and against SQL on odd rows."""
import hashlib
import itertools
import random
import re

import duckdb
import pytest

from heartspark.llm import conversation_repair as cr
from heartspark.llm import oracles

GOOD = re.compile(r"(s?(ua)+)?")


def by_hand(turns):
    """(cost, audit, repaired turns) of [(initial, fault)]: the least of all edit sequences, by search in order of (cost, audit)."""
    best = {(0, ""): (0, "", ())}  # by turns taken and initials kept: cost, audit, result
    todo, done = {(0, ""): (0, "", ())}, []
    while todo:
        key = min(todo, key=lambda k: todo[k][:2])
        i, kept = key
        cost, audit, out = todo.pop(key)
        if i == len(turns) and GOOD.fullmatch(kept):
            done.append((cost, audit, out))
        if done and cost > min(done)[0]:
            break
        steps = [(0, "u", 3, "I", ("user", None)), (0, "a", 3, "I", ("assistant", None))] if len(audit) < 2 * len(turns) + 4 else []
        if i < len(turns):
            initial, fault = turns[i]
            more = 3 if fault == "truncated" else 0
            steps.append((1, "", 4, "D", None))
            if fault not in ("blank", "duplicate"):
                steps += [(1, initial, more, "K", (None, i)), (1, "u", 3 + more, "R", ("user", i)), (1, "a", 3 + more, "R", ("assistant", i))]
        for taken, more_kept, more, edit, what in steps:
            new = (i + taken, kept + more_kept)
            if not re.fullmatch(r"s?(ua)*u?", new[1]):
                continue
            value = (cost + more, audit + edit, out + ((what,) if what else ()))
            if new not in best or value[:2] < best[new][:2]:
                best[new] = todo[new] = value
    return min(done, key=lambda x: x[:2])


@pytest.mark.parametrize("seed", range(6))
def test_blocks_equal_all_sequences(seed):
    """Blocks of any lengths, put together by the checkpoints, give the cheapest edits, ASCII-least."""
    rng = random.Random(seed)
    faults = {"": 0, "truncated": 4, "blank": 8, "duplicate": 8}
    for _ in range(60):
        turns = [(rng.choice("suax"), rng.choice(["", "", "", *faults])) for _ in range(rng.randrange(0, 7))]
        kinds = bytes("suax".index(c) + faults[f] for c, f in turns)
        cuts = sorted(rng.sample(range(1, len(kinds)), rng.randrange(0, len(kinds)))) if len(kinds) > 1 else []
        parts = [kinds[a:b] for a, b in itertools.pairwise([0, *cuts, len(kinds)])]
        ends = [cr.END]
        for part in reversed(parts):
            ends.append(cr.through(cr.table(part), ends[-1]))
        cost, ends, state, audit = ends[-1][cr.START], ends[-2::-1], cr.START, ""
        for k, (part, end) in enumerate(zip(parts, ends)):
            edits, state = cr.tight_edits(part, state, end, k == len(parts) - 1)
            audit += edits
        want = by_hand(turns)
        assert (cost, audit) == want[:2], turns
    assert cr.through(cr.table(b""), cr.END) == cr.END


def against_sql(df):
    con = duckdb.connect()
    con.register("conversations", df.select("conv_id", "turn", "role", "text").toArrow())
    want = con.execute(oracles.CONVERSATIONS)
    names = [d[0] for d in want.description]
    want = sorted(want.fetchall(), key=str)
    got = sorted((tuple(r[n] for n in names) for r in cr.repair_digests(df).collect()), key=str)
    assert got == want
    return got


def test_odd_rows(spark):
    """Nulls in any column, blanks, ties, repeats, other roles, marks, long texts, clashing names, whole conversations that go."""
    rng = random.Random(3)
    texts = [None, "", " \n\t", "A question?", "An answer. ", "cut off", "é ", "x" * 200_000 + ".", "a:b\nuser:c!", "."]
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, *range(9)]), rng.choice([None, "", "user", "assistant", "system", "tool", "User", "u"]), rng.choice(texts))
            for _ in range(300)]
    rows += [(50, None, "user", "Same?"), (50, None, "user", "Same?"), (50, 4, "user", "Same?"), (51, None, None, None)]
    rows += [(100 + k, 0, "user", "Alone?") for k in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "uid", "kinds", "h", "d", "part", "copy", "cost"):
        df = df.withColumn(name, df.text)
    got = against_sql(df)
    empty = hashlib.sha256().hexdigest()
    assert any(r[-1] == empty and r[0] is not None and r[0] >= 100 for r in got) and len(got) == 75
    assert cr.repair_digests(df.where("false")).count() == 0


def test_long_conversation_in_many_blocks(spark):
    """One conversation of many blocks over many partitions: its digests follow from its repaired turns, and cutting it otherwise changes nothing."""
    rng = random.Random(8)
    rows = [(1, k // 2 if k % 50 else None, rng.choice(["user", "assistant", "assistant", "tool"]), f"{rng.choice(['Yes.', 'no', '', 'what?'])} {k % 700}.") for k in range(6000)]
    rows += [(2, 0, "user", "Hello?"), (2, 1, "assistant", "Hello.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    pieces = cr.repair(df)
    got = {r.conv_id: r for r in cr.digests(pieces).collect()}
    kept = [r for r in pieces.where("conv_id = 1").orderBy("uid").collect()]
    assert len(kept) > 60 and max(len(r.edits) for r in kept) < 700
    turns = [f"{r.role}:{r.text}" for r in cr.repaired_turns(pieces).where("conv_id = 1").orderBy("uid", "position").collect()]
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(turns).encode()).hexdigest()
    assert re.fullmatch(GOOD, "".join(t[0] for t in turns)) and got[2].audit == "KK" and got[2].cost == 0
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    ordered = con.execute(oracles.CONVERSATIONS[:oracles.CONVERSATIONS.index("), turns AS")].replace("FROM hit WHERE d <> 0", "FROM hit").replace("d = ", "20 = ") +
                          ") SELECT c, fault FROM faulty WHERE conv_id = 1 ORDER BY i").fetchall()
    faults = {"": 0, "truncated": 4, "blank": 8, "duplicate": 8}
    kinds = bytes(cr.INITIALS.get(c, 3) + faults[f] for c, f in ordered)
    assert len(kinds) == 6000 and got[1].audit == cr.tight_edits(kinds, cr.START, cr.END, True)[0]
    assert got[1].cost == cr.vectors(kinds, cr.END)[0][cr.START]
