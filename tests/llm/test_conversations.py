"""Repair of conversations against exhaustive search, SQL and odd rows."""

import itertools
import random

import oracle
from orderpulse.llm import conversations
from orderpulse.llm.conversations import ASSISTANT, NEXT, START, WANTED, Survivors
from orderpulse.llm.queries import OP12_SQL, op12_conversations

ROWS = "conv_id long, turn long, role string, text string, step long, fault string, copy int"


def exhaustive(rows):
    """(cost, audit) over all ways that aren't dearer than the cheapest by more than an insert."""
    def with_inserts(ways):
        ways = {state: set(own) for state, own in ways.items()}
        for _ in range(3):
            for state, to in ((0, 2), (1, 2), (3, 2), (2, 3)):
                for cost, audit in list(ways.get(state, ())):
                    ways.setdefault(to, set()).add((cost + 3, audit + "I"))
            ways = {state: {w for w in own if w[0] <= min(own)[0] + 3}
                    for state, own in ways.items()}
        return ways

    ways = with_inserts({START: {(0, "")}})
    for initial, fault in rows:
        now = {}
        for state, own in ways.items():
            for cost, audit in own:
                now.setdefault(state, set()).add((cost + 4, audit + "D"))
                if fault in (1, 2):
                    continue
                cost += 3 if fault == 3 else 0
                if initial in NEXT[state]:
                    now.setdefault(NEXT[state][initial], set()).add((cost, audit + "K"))
                now.setdefault(NEXT[state][WANTED[state][0]], set()).add((cost + 3, audit + "R"))
        ways = with_inserts(now)
    return min(w for state in (START, ASSISTANT) for w in ways.get(state, ()))


def test_search_as_exhaustive():
    rng = random.Random(1)
    for _ in range(400):
        rows = [(rng.choice("suauaux "), rng.choice([0, 0, 0, 0, 0, 1, 2, 3]))
                for _ in range(rng.randrange(9))]
        found, audit = Survivors(), b""
        for row in rows:
            found.step(*row)
            audit += found.certain()
        cost, rest = found.end()
        assert (cost, (audit + rest).decode()) == exhaustive(rows), rows


def test_edits_come_while_rows_still_do():
    """A sound conversation without end is given out row by row, so nothing piles up."""
    endless = ((n, ("user", "assistant")[n % 2], f"Row {n}.", 0) for n in itertools.count())
    first = list(itertools.islice(conversations.edits_of(endless), 5000))
    assert [e[0] for e in first] == ["keep"] * 5000 and first[-1][1] == 4999


def test_ties_stay_open_to_the_end():
    """Users only: both ways of pairing them cost the same until the end is known."""
    for n in (1000, 1001):
        rows = [(i, "user", f"{i}.", 0) for i in range(n)]
        edits = list(conversations.edits_of(iter(rows)))
        roles = "".join(e[3][0] for e in edits if e[3])
        assert roles == "ua" * (len(roles) // 2) and len([e for e in edits if e[1] is not None]) == n
        assert sum(e[6] for e in edits) == 3 * ((n + 1) // 2)


def odd_rows():
    rng = random.Random(2)
    texts = [None, "", " \t\n", "Fine.", "Cut off", "A!", "Why?\n", "é \U0001f600.", "x.\xa0"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "useful"]
    rows = [(conv, rng.choice([None, *range(6)]), rng.choice(roles[:2] * 3 + roles),
             rng.choice(texts[3:4] * 5 + texts))
            for conv in [None, *range(40)] for _ in range(rng.randrange(12))]
    rows += [(50, n, ("user", "assistant")[n % 2], f"Long {n} " * (n % 50) + ".")
             for n in range(3000)]                                   # most rows
    rows += [(51, n, "user", "Same.") for n in range(300)] + [(52, 0, "user", "y " * 200_000)]
    rows += [(53, 7, "user", "Twice."), (53, 7, "user", "Twice."), (54, -9, "system", "Only.")]
    return rows


def test_query_as_sql_on_odd_rows(spark, tmp_path):
    rows = [r for r in odd_rows() if r[0] != 50 or r[1] < 60]
    frame = spark.createDataFrame([(*r, 0, "", 1) for r in rows], ROWS)
    frame.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    con = oracle.duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM read_parquet("
                f"'{tmp_path}/conversations.parquet/*.parquet')")
    # A message without a role has no initial in SQL either.
    assert oracle.compare(op12_conversations(spark, str(tmp_path)), con, OP12_SQL) == ""


def test_repair(spark):
    rows = odd_rows()
    edits = conversations.repair(spark.createDataFrame([(*r, 0, "", 1) for r in rows], ROWS))
    got = edits.collect()
    by_conv = {}
    for r in sorted(got, key=lambda r: r.step):
        by_conv.setdefault(r.conv_id, []).append(r)
    assert set(by_conv) == {r[0] for r in rows}
    for conv, own in by_conv.items():
        assert [r.step for r in own] == list(range(len(own)))
        roles = "".join(r.role[:1] for r in own if r.role is not None)
        body = roles.removeprefix("s")
        assert body == "ua" * (len(body) // 2) and (body or not roles)
        kept = sorted((r.turn is not None, r.turn, r.old_role, r.text) for r in own
                      if r.edit != "insert")
        given = sorted((t is not None, t, role if role is not None else " ",
                        text if text is not None else " ") for c, t, role, text in rows if c == conv)
        assert kept == given
        cost = {"keep": 0, "rerole": 3, "delete": 4, "insert": 3}
        assert all(r.cost == cost[r.edit] + 3 * (r.fault == "truncated" and r.edit != "delete")
                   for r in own)
        assert all(r.edit == "delete" for r in own if r.fault in ("blank", "duplicate"))
    whole = conversations.repaired(edits).filter("conv_id = 50").collect()
    assert len(whole) == 3000


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], ROWS)
    assert conversations.repair(none).collect() == []
    # The row 0:15 is dropped, so nothing is left of its conversation.
    frame = spark.createDataFrame([(0, t, "user", "a.", 0, "", 1) for t in dropped()[:2]], ROWS)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    row = op12_conversations(spark, str(tmp_path)).collect()
    assert [r[:-1] for r in map(tuple, row)] == [(0, 0, 0, 0, 0, 0, 0, "")]
    assert row[0].repaired_sha256.startswith("e3b0c442")


def dropped():
    import zlib
    return [t for t in range(200) if zlib.crc32(f"0:{t}".encode()) % 20 == 0]
