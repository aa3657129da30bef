import hashlib
import random
import re
import zlib

import pytest
import verify
from conftest import SF_DIR

from tideline.llm import conversation_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns of each conversation; the tests have no two different turns of equal number."""
    out = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def brute(paths):
    """Rows of the trie of ``{conversation: turns}``."""
    members, ends = {}, {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def words(node):
        return len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = (len(members[node]) - 1) * words(node) + sum(saved[b] for b in below)
    out = []
    for node, of in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        above = min(members[node[:-1]]) if node else None
        out.append((min(of), len(node), above, len(of), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def found(spark, rows, again=False, **limits):
    paths = conversation_trie.conversations(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in conversation_trie.trie(queries.rebuilt(paths) if again else paths, **limits).collect()), key=repr)


def test_query_matches_its_sql(spark):
    connection = verify.duck(SF_DIR)
    frame = queries.QUERIES["op11_conversation_trie"](spark, SF_DIR)
    cursor = connection.execute(queries.ORACLES["op11_conversation_trie"])
    assert verify.rows_of(frame.columns, frame.collect()) == verify.rows_of([d[0] for d in cursor.description], cursor.fetchall())


def corpus(draw):
    """Conversations that share beginnings, copies and continuations, some of them long."""
    rows = []
    for c in draw.sample(range(-300, 9000), 150):
        turns = [("user", draw.choice("ab"))] * draw.randint(1, 3) + [(draw.choice(["user", "x y"]), draw.choice(["", "a b", "c"])) for _ in range(draw.randint(0, 5))]
        if draw.random() < 0.3:
            turns = [("system", "always the same words")] * 40 + turns[: draw.randint(0, 3)]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("most_rows", "most_turns", "piece"), [(1, 10**6, 64), (5, 10**6, 4096), (10**6, 30, 7), (10**6, 10**6, 1)])
def test_bursting_does_not_change_the_trie(spark, monkeypatch, most_rows, most_turns, piece):
    monkeypatch.setattr(conversation_trie, "PIECE", piece)
    rows = corpus(random.Random(most_rows + piece))
    assert found(spark, rows, most_rows=most_rows, most_turns=most_turns) == brute(ordered(rows))


def test_edges(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 3, "", "é  ü\tö"), (2, None, "user", "first"), (2, -5, None, ""),
            (None, 1, "user", "lost"), (3, 1, "us", "erx"), (4, 1, "user", "x"), (5, 1, "1:u", "x"), (6, 1, "x", "w " * 100_000),
            (7, 1, "r", "twice"), (7, 1, "r", "twice")]
    for given in (rows, rows[:1], [], [r for r in rows if r[0] is None]):
        for limit in (1, 100):
            assert found(spark, given, most_rows=limit) == brute(ordered(given))
    clash = spark.createDataFrame([(*r, "k", 1) for r in rows], f"{SCHEMA}, id string, words int")
    assert conversation_trie.trie(conversation_trie.conversations(clash)).count() == len(brute(ordered(rows)))


def test_rebuilt_conversations(spark):
    draw = random.Random(9)
    rows = [(c, t, "user", draw.choice("abc")) for c in draw.sample(range(200), 90) for t in range(draw.randint(1, 5))]
    turns, want = ordered(rows), {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        want[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    assert any(not t for t in want.values())
    assert found(spark, rows, again=True, most_rows=3) == brute(want)
