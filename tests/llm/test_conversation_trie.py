import hashlib
import random
import zlib

import pytest

from catalogsync.llm import conversation_trie as T
from llm_cases import LONG, WORD, ordered

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def want(rows):
    """A dictionary of all beginnings; totals by comparing every node with every other."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(convs.get(first, [])[:h] + own[h:])
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {n: sum(len(m) == len(n) + 1 and m[: len(n)] == n for m in nodes) for n in nodes}
    out = []
    for n, members in nodes.items():
        below = [m for m in nodes if m[: len(n)] == n]
        saved = sum((len(nodes[m]) - 1) * len(WORD.findall(m[-1][1])) for m in below if m)
        ends = ",".join(str(c) for c in sorted(members) if rebuilt[c] == n)
        parent = min(nodes[n[:-1]]) if n else None
        out.append((min(members), len(n), parent, len(members), children[n], sum(children[m] == 0 for m in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return ordered(out)


def frame(spark, rows):
    """With further columns whose names clash with those the operator uses."""
    extra = "conv string, pos string, k1 string, `a.b` int, words string, TURN_ID int, id int"
    return spark.createDataFrame([(*r, "c", "p", "k", 1, "w", 2, 3) for r in rows], f"conv_id long, turn long, role string, text string, {extra}")


def got(df):
    return ordered(tuple(r[c] for c in COLUMNS) for r in df.collect())


# Null and repeated turns, ties, null and empty texts, a null id, a negative one, absent first conversations, copies, a very long text.
ROWS = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} says {'this' if c % 3 else 'that'}") for c in range(40, 66) for t in range(c % 6)]
ROWS += [
    (20, None, "system", "be kind"), (20, 0, "user", "hello there"), (20, 0, "user", "hello there"), (20, 0, None, None), (20, 1, "assistant", ""),
    (21, 5, None, "only  one\nturn"), (22, None, None, None), (23, None, "user", None), (None, 1, "user", "nobody's"), (None, None, None, None),
    (-5, 1, "user", "minus five"), (-20, 1, "user", "minus twenty"), (-20, 2, "user", "again and again"), (-21, 3, "x", "y"),
    (101, 1, "user", LONG), (102, 1, "user", LONG), (103, 1, "user", "short"), (103, 2, "user", LONG),
    (9223372036854775807, 1, "user", "last"), (0, 1, "user", "first"),
]


@pytest.mark.parametrize("block, piece", [(T.BLOCK, T.PIECE), (2, 2)])
def test_all_nodes(spark, block, piece):
    assert got(T.shared_beginnings(frame(spark, ROWS), block=block, piece=piece)) == want(ROWS)


def test_one_conversation_holds_most_turns(spark):
    """It is dealt over several tasks; its chain is contracted in far fewer rounds than it is long."""
    rows = [(7, k, "user", f"w{k} of many") for k in range(300)] + [(c, k, "user", f"w{k} of many") for c in (8, 9) for k in range(40 + c)]
    rows += [(7, 3, "user", "a tie"), (10, 1, "user", "short")]
    random.Random(1).shuffle(rows)
    assert got(T.shared_beginnings(frame(spark, rows), block=16)) == want(rows)


def test_nothing(spark):
    assert got(T.shared_beginnings(frame(spark, []))) == []
    assert got(T.shared_beginnings(frame(spark, [(None, 1, "a", "b")]))) == []


def test_turnless_conversations_end_at_the_root(spark):
    own = [c for c in range(1, 40) if zlib.crc32(str(c).encode()) % 4 >= 1 and c != 20][:5]
    rows = [(c, 1, "user", "goes away") for c in own]
    assert got(T.shared_beginnings(frame(spark, rows))) == want(rows)
    assert want(rows)[0][3] == 5 and len(want(rows)) == 1


@pytest.mark.parametrize("shape", ["path", "star", "random", "caterpillar", "single", "forest", "none"])
def test_subtree_totals(spark, shape, monkeypatch):
    draw, n = random.Random(2), 240
    parent = {
        "path": [k - 1 for k in range(n)], "star": [-1] + [0] * (n - 1), "random": [-1] + [draw.randrange(k) for k in range(1, n)],
        "caterpillar": [-1] + [k - 2 if k % 2 == 0 else k - 1 for k in range(1, n)], "single": [-1], "forest": [-1, -1, -1, 1, 3, 3, 2], "none": [],
    }[shape]
    kids = [parent.count(k) for k in range(len(parent))]
    total = [k + 1 for k in range(len(parent))]
    size = [1] * len(parent)
    for k in range(len(parent) - 1, -1, -1):
        if parent[k] >= 0:
            total[parent[k]] += total[k]
            size[parent[k]] += size[k]
    staged = []
    monkeypatch.setattr(T, "stage", lambda df, name, real=T.stage: staged.append(name) or real(df, name))
    rows = [(k * 7, p * 7 if p >= 0 else None, kids[k], k + 1, 1) for k, p in enumerate(parent)]
    found = T.subtree_totals(spark.createDataFrame(rows, "id long, parent long, kids long, x long, n long"), ["x", "n"])
    assert {(r["id"], r["x"], r["n"]) for r in found.collect()} == {(k * 7, total[k], size[k]) for k in range(len(parent))}
    assert found.count() == len(parent)
    assert staged.count("alive") <= 30
