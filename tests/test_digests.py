"""Digests of files from byte ranges."""

import random

from catalogsync.sources.digests import range_digests
from catalogsync.sources.snapshots import changed_sources
from tests.helpers import rows


def _ranged(spark, size, path):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    return range_digests(session, path)


def _write(folder, **files):
    for name, data in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def test_one_digest_whatever_the_ranges(spark, tmp_path):
    draw = random.Random(1)
    _write(
        tmp_path, binary=draw.randbytes(60_000), lines=b"one\ntwo\r\nthree\n" * 900, zeros=bytes(30_000), breaks=b"\n" * 3000, empty=b"", one=b"x", **{"sub/one": b"x"}
    )
    want = rows(_ranged(spark, 1 << 20, str(tmp_path)), "name", "length", "md5")
    assert [r[0] for r in want] == ["binary", "breaks", "lines", "one", "sub/one", "zeros"]
    for size in (37, 1000, 7777):
        assert rows(_ranged(spark, size, str(tmp_path)), "name", "length", "md5") == want
    digests = {r[0]: r[2] for r in want}
    assert digests["one"] == digests["sub/one"] and len(set(digests.values())) == 5


def test_what_changes_a_digest(spark, tmp_path):
    base = b"".join(b"line %d\n" % k for k in range(500))
    swapped = base.replace(b"line 7\nline 8\n", b"line 8\nline 7\n")
    _write(tmp_path / "before", a=base, b=base, c=base, d=base, e=base, f=b"")
    _write(tmp_path / "now", a=base, b=swapped, c=base[:-1], d=base + b"\n", e=base.replace(b"line 250", b"line 25x"), f=b"\n", g=base)
    before, now = (_ranged(spark, size, str(tmp_path / name)) for name, size in (("before", 100), ("now", 900)))
    assert rows(changed_sources(now, before), "name") == [("b",), ("c",), ("d",), ("e",), ("f",), ("g",)]


def test_a_file_of_many_ranges(spark, tmp_path):
    """Most of it is never written: 450 MB with a line feed every 30 MB, read by 16 MB."""
    path = tmp_path / "sparse"
    with open(path, "wb") as file:
        for k in range(1, 16):
            file.seek(k * 30_000_000)
            file.write(b"\n")
    first = rows(_ranged(spark, 16 << 20, str(path)), "length", "md5")
    assert first == rows(_ranged(spark, 1 << 30, str(path)), "length", "md5") and first[0][0] == 450_000_001
