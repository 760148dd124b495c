"""Feeds read in byte ranges give the rows that a single task reads."""

import random

import pytest

from catalogsync.sources import feeds, splits
from tests.helpers import rows


def _session(spark, size):
    """Byte ranges of so many bytes, set in a session of its own."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    return session


def _field(draw):
    kind = draw.randrange(9)
    text = "".join(draw.choice("ab ,é”“") for _ in range(draw.randrange(12)))
    return {
        0: "", 1: '""', 2: text.replace(",", ";").replace('"', ""), 3: f'"{text}"', 4: '"one\ntwo"', 5: f'"{text}\r\nand ""{text}"" more"',
        6: 'an 8" plate', 7: '"8"" by 10"""', 8: '"' + "long, with breaks\n\n" * draw.randrange(1, 9) + '"',
    }[kind]


def _content(seed, n=60, header="code,text"):
    draw = random.Random(seed)
    ends = ["\n", "\r\n"][seed % 2]
    lines = [header] + [f"C{seed}-{k},{_field(draw)}{',surplus' if draw.random() < 0.1 else ''}" for k in range(n)]
    lines[3:3] = ["", "only a code", '"quoted, code","x"']
    return ends.join(lines) + (ends if draw.random() < 0.5 else "")


@pytest.mark.parametrize("size", [7, 64, 700, 1 << 20])
def test_the_same_rows_from_any_ranges(spark, tmp_path, size):
    folder = tmp_path / "feed"
    folder.mkdir()
    for seed in range(3):
        (folder / f"part {seed}.csv").write_bytes(_content(seed).encode("cp1252"))
    session = _session(spark, size)
    whole = feeds.read_feed(spark, "descriptions", str(folder))
    ranged = feeds.read_feed(session, "descriptions", str(folder), in_splits=True)
    assert rows(ranged, "prod_code", "narrative", "snapshot_date") == rows(whole, "prod_code", "narrative", "snapshot_date")
    assert whole.count() > 150
    bad, ranged_bad = (feeds.rejected_rows(s, "descriptions", str(folder), in_splits=s is session) for s in (spark, session))
    columns = ("feed", "key", "file", "kept")
    assert rows(ranged_bad, *columns) == rows(bad, *columns) and bad.count() > 10


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_bytes(("code,text\n" + "".join(f'A{k},"line one\nline two of {k}"\n' for k in range(500))).encode())
    session = _session(spark, 1000)
    states = splits.range_states(splits._lines(session, str(path), True)).collect()
    assert len(states) >= 15 and {s["begins_inside"] for s in states} == {True, False}
    assert splits._lines(session, str(path), True).rdd.getNumPartitions() >= 15
    got = feeds.read_feed(session, "descriptions", str(path), in_splits=True)
    assert rows(got, "prod_code", "narrative") == sorted((f"A{k}", f"line one line two of {k}") for k in range(500))


def test_a_field_longer_than_ranges(spark, tmp_path):
    path = tmp_path / "long.csv"
    long = "row, of\n" * 400
    path.write_bytes(f'code,"a header\nin {"many " * 50} lines"\nA1,x\nA2,"{long}"\nA3,y\nA4,"{long}"'.encode())
    got = feeds.read_feed(_session(spark, 100), "descriptions", str(path), in_splits=True)
    want = " ".join(["row, of"] * 400)
    assert rows(got, "prod_code", "narrative") == [("A1", "x"), ("A2", want), ("A3", "y"), ("A4", want)]


def test_an_unclosed_quote_loses_no_code(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_bytes(b'code,text\nA1,x\nA2,"never closed\nA3,y\nA4,z\n')
    whole = feeds.read_feed(spark, "descriptions", str(path))
    for size in (8, 1 << 20):
        got = feeds.read_feed(_session(spark, size), "descriptions", str(path), in_splits=True)
        assert rows(got, "prod_code", "narrative") == rows(whole, "prod_code", "narrative")


def test_nothing(spark, tmp_path):
    for name, content in (("empty", b""), ("header", b"code,text\n"), ("header only", b'code,"te\nxt"')):
        path = tmp_path / f"{name}.csv"
        path.write_bytes(content)
        assert feeds.read_feed(_session(spark, 4), "descriptions", str(path), in_splits=True).count() == 0


def test_how_lines_end():
    ends = splits._quotes()
    for line, inside, want in (
        ("a,b", False, False), ('a,"b', False, True), ('a,"b"', False, False), ('a,"b""', False, True), ('8" plate,x', False, False),
        ('x"', True, False), ('x"",y', True, True), ('x","y', True, True), ('x" z,"y"', True, False), ("", True, True), ('"', False, True), ('""', False, False),
    ):
        assert ends(line, inside) is want, line
    assert ends('"' + 'a""b' * 100_000, False) is True
