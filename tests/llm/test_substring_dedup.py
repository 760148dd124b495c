import hashlib
import random

import numpy as np
import pytest

from catalogsync.llm import substring_dedup as S
from llm_cases import LONG, ROWS, WORD, collected, frame, ordered


def want(rows, window=13):
    """Every window of every row against the smallest id that has it."""
    least = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - window + 1):
            said = tuple(words[k : k + window])
            low = least.get(said, (2,))
            least[said] = min(low, (i is None, i or 0)) if low != (2,) else (i is None, i or 0)
    out = []
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < (i is None, i or 0):
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return ordered(out)


COLUMNS = ("doc_id", "n_words", "n_removed", "kept")
SMALL = dict(group=3, settle=7, compare=40)


def passages(seed=5, n=40):
    """Documents that share passages about as long as a window, whole copies, and copies with a few words changed."""
    draw = random.Random(seed)
    word = lambda k: "".join(draw.choice("abcdeé漢") for _ in range(k))
    shared = [[word(3) for _ in range(m)] for m in (12, 13, 14, 20, 60)]
    rows = []
    for i in range(n):
        words = [word(4) for _ in range(draw.randrange(0, 40))]
        for _ in range(draw.randrange(0, 4)):
            at, passage = draw.randrange(len(words) + 1), list(draw.choice(shared))
            if draw.random() < 0.3:
                passage[draw.randrange(len(passage))] = word(4)
            words[at:at] = passage
        rows.append((i * 3, draw.choice([" ", "  ", "\n", "\t "]).join(words)))
    rows += [(i + 1, t) for i, t in draw.sample(rows, 8)] + [(i, t) for i, t in draw.sample(rows, 3)]
    rows += [(200 + k, " ".join(["same", "words"] * 20)) for k in range(5)] + [(None, " ".join(shared[4])), (None, "x " + " ".join(shared[4])), (None, None), (-7, " ".join(shared[3]))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, SMALL])
def test_against_all_windows(spark, sizes):
    """Also with groups and tasks so small that frequent prefixes have to be made longer."""
    rows = passages()
    assert collected(S.drop_repeats(frame(spark, rows), **sizes), *COLUMNS) == want(rows)
    hashed = [(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in want(rows)]
    assert collected(S.drop_repeats(frame(spark, rows), digest=True, **sizes), *COLUMNS) == ordered(hashed)


def test_other_windows(spark):
    rows = passages(seed=8, n=25)
    assert collected(S.drop_repeats(frame(spark, rows), window=6, seed=6, **SMALL), *COLUMNS) == want(rows, 6)
    assert collected(S.drop_repeats(frame(spark, rows), window=30, seed=2, **SMALL), *COLUMNS) == want(rows, 30)


def test_cases(spark):
    rows = [*ROWS, (12, LONG + " and more"), (10, "new start " + LONG), (13, LONG)]
    assert collected(S.drop_repeats(frame(spark, rows)), *COLUMNS) == want(rows)
    assert S.drop_repeats(frame(spark, [])).count() == 0
    assert collected(S.drop_repeats(frame(spark, [(1, None), (2, "")])), *COLUMNS) == [(1, 0, 0, ""), (2, 0, 0, "")]


def test_one_passage_in_all_documents(spark):
    """Every task settles its own copies; the group that owns the passage gets a few of them."""
    draw = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(25))
    rows = [(i, f"{draw.random()} {passage} {draw.random()}") for i in range(600)]
    assert collected(S.drop_repeats(frame(spark, rows), settle=500), *COLUMNS) == want(rows)


def test_equal_windows_have_equal_anchors():
    draw = random.Random(3)
    for _ in range(50):
        said = [draw.choice([b"a", b"b", b"cc"]) for _ in range(13)]
        found = []
        for _ in range(2):
            head = [draw.choice([b"a", b"b", b"x"]) for _ in range(draw.randrange(9))]
            hashes, place, low, stop = S.anchors(head + said + [b"b"] * draw.randrange(9), 13, 5)
            k = int(np.flatnonzero((low <= len(head)) & (stop > len(head)))[0])
            found.append((hashes[k], place[k] - len(head)))
        assert found[0] == found[1] and 0 <= found[0][1] <= 8


def test_trees_against_windows():
    """Nodes of the two trees are the equal windows around the anchors."""
    draw = random.Random(4)
    slices, left = [], []
    for _ in range(200):
        k = draw.randrange(4)
        slices.append([draw.choice([b"a", b"b"]) for _ in range(k)] + [b"x", b"y"] + [draw.choice([b"a", b"b"]) for _ in range(4 + draw.randrange(3))])
        left.append(k)
    rank = np.array([draw.randrange(50) for _ in slices])
    row, start, late = S.repeated(slices, np.array(left), rank, 6, 2)
    got = {(r, s): v for r, s, v in zip(row.tolist(), start.tolist(), late.tolist())}
    least = {}
    every = [(r, s, (left[r] - s, *slices[r][s : s + 6])) for r in range(200) for s in range(len(slices[r]) - 5) if s <= left[r] <= s + 4]
    for r, s, said in every:
        least[said] = min(least.get(said, 99), rank[r])
    assert got == {(r, s): bool(rank[r] > least[said]) for r, s, said in every}
