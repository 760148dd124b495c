from collections import Counter

from catalogsync.llm import mixing as M
from llm_cases import WORD, collected, frame, ordered


def rows(scale=1):
    out = [(k, " ".join(["word"] * (1 + k * 7 % 23)), ["b", "a", None, "ü", "B"][k % 5]) for k in range(300 * scale)]
    return out + [(1000, " ".join(["w"] * 5), "tiny"), (1001, None, "a"), (1002, "", "b"), (None, "no id here", "a"), (2005, "again", "a"), (2005, "again", "a")]


def targets(sizes, weights=(1, 2, 3)):
    """Shares by weight, the excess over three times the size shared anew until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    stopped, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in stopped]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return stopped | {s: left * weight[s] / total for s in open_}
        for s in over:
            stopped[s] = 3 * sizes[s]
            left -= stopped[s]


def test_targets_sizes_and_budgets(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 7)  # so that prefix sums run over blocks
    given = rows()
    size = Counter()
    for _, text, source in given:
        size[source] += len(WORD.findall(text or ""))
    want, taken = targets(size), Counter()
    got = M.mix(frame(spark, given, source=True))
    found = got.collect()
    assert len(found) == len(given)
    by_id = {i: (t, s) for i, t, s in given}
    for r in found:
        text, source = by_id[r["doc_id"]]
        assert r["size"] == len(WORD.findall(text or "")) and r["source_size"] == size[source]
        assert abs(r["target"] - want[source]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"]
        taken[source] += r["taken"]
    assert want["tiny"] == 15 == taken["tiny"]
    for source in size:
        assert want[source] - 23 < taken[source] <= want[source]
    again = M.mix(frame(spark, given[::-1], source=True).repartition(3))
    assert collected(got, "doc_id", "taken") == collected(again, "doc_id", "taken")


def test_whole_epochs_come_first(spark):
    given = [(k, "one two three", "a") for k in range(10)] + [(100 + k, "x " * 30, "b") for k in range(10)]
    times = {r["doc_id"]: r["times"] for r in M.mix(frame(spark, given, source=True)).collect()}
    # a weighs 1 of 3 and stops at 90 words, three whole epochs; b gets the other 240 of its 300.
    assert all(times[k] == 3 for k in range(10))
    assert sorted(times[100 + k] for k in range(10)) == [0] * 2 + [1] * 8


def test_quality_weighs(spark):
    plain, junk = "plain words of prose like these " * 3, "XX## 9$9 QQ!! ZZ%% 77^^ KK## " * 3
    given = [(k, plain if k % 2 else junk, "a") for k in range(400)] + [(1000 + k, "other words " * 9, "b") for k in range(400)]
    found = M.mix(frame(spark, given, source=True)).where("doc_id < 400").collect()
    good = sum(r["taken"] for r in found if r["doc_id"] % 2)
    assert good > 2 * sum(r["taken"] for r in found if not r["doc_id"] % 2)


def test_no_document_that_fits_is_left(spark):
    """Sources with some very long documents: what is taken is what one gets by going through the keys one by one."""
    lengths = [(k, 4000 if k % 40 == 3 else 300 if k % 9 == 1 else 1 + k % 13) for k in range(900)]
    given = [(k, " ".join(["w"] * n), ["a", "b", None, "c"][k % 4]) for k, n in lengths] + [(5000, "", "a"), (5001, None, "b")]
    found = M.mix(frame(spark, given, source=True)).collect()
    of = {i: s for i, _, s in given}
    rest = {}
    for r in found:
        s = of[r["doc_id"]]
        rest[s] = rest.get(s, r["target"]) - r["taken"]
    for r in found:
        epochs = r["target"] // r["source_size"] if r["source_size"] else 0
        if r["size"] and r["times"] == epochs:
            assert r["size"] > rest[of[r["doc_id"]]]
    assert all(0 <= left for left in rest.values())
    again = M.mix(frame(spark, given[::-1], source=True).repartition(5))
    assert collected(again, "doc_id", "times") == ordered((r["doc_id"], r["times"]) for r in found)


def test_empty_tables_and_copies(spark):
    assert M.mix(frame(spark, [], source=True)).count() == 0
    assert M.mix(frame(spark, [(1, None, None), (2, "", "a")], source=True)).where("taken <> 0 or target <> 0").count() == 0
    docs = frame(spark, rows(), source=True)
    mixed = M.apply_mix(docs)
    assert mixed.columns == docs.columns
    want = Counter({r["doc_id"]: r["times"] for r in M.mix(docs).where("doc_id < 1000").collect() if r["times"]})
    assert Counter(r["doc_id"] for r in mixed.where("doc_id < 1000").collect()) == want
