"""Contents under their digests: bytes are equal, reruns copy nothing, failures leave nothing half."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalogsync.sources import media_store, published
from catalogsync.sources.media import scan_media
from tests.helpers import rows


def _given(folder):
    files = {"a.jpg": b"one", "large z/b c.jpg": b"\x00\xff" * 5000, "d.jpg": b"one", "é.jpg": b"\n" * 77}
    for name, content in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return files


def _scanned(spark, folder):
    found = scan_media(spark, str(folder))
    return found.withColumn("path", F.concat_ws("/", F.lit(str(folder)), F.nullif("dir", F.lit("")), "name")).select("path", "length", "md5")


def _stored(root):
    return {p.name: p.read_bytes() for p in Path(root, "content").glob("*/*")}


def test_bytes_are_equal_and_a_rerun_copies_nothing(spark, tmp_path):
    files, root = _given(tmp_path / "in"), str(tmp_path / "out")
    scanned = _scanned(spark, tmp_path / "in")
    done = media_store.store_contents(scanned, root, chunk=1000)
    assert {r["outcome"] for r in done.collect()} == {"stored"} and done.count() == 3
    want = {hashlib.md5(c).hexdigest(): c for c in files.values()}
    assert _stored(root) == want
    assert rows(media_store.held_contents(spark, root), "md5", "length") == sorted((m, len(c)) for m, c in want.items())
    before = {p: p.stat().st_mtime_ns for p in Path(root, "content").glob("*/*")}
    assert media_store.store_contents(scanned, root).count() == 0
    assert {p: p.stat().st_mtime_ns for p in Path(root, "content").glob("*/*")} == before
    assert published.entry_numbers(spark, root) == [1]
    (tmp_path / "in" / "new.jpg").write_bytes(b"new")
    assert [r["path"].rsplit("/", 1)[1] for r in media_store.store_contents(_scanned(spark, tmp_path / "in"), root).collect()] == ["new.jpg"]
    assert published.entry_numbers(spark, root) == [1, 2] and media_store.held_contents(spark, root).count() == 4
    assert published.unnamed_parts(spark, root) == ["content"]


def test_files_that_change_or_go_are_not_stored(spark, tmp_path):
    _given(tmp_path / "in")
    root = str(tmp_path / "out")
    scanned = spark.createDataFrame(_scanned(spark, tmp_path / "in").collect(), "path string, length long, md5 string")
    (tmp_path / "in" / "a.jpg").write_bytes(b"two")
    (tmp_path / "in" / "é.jpg").unlink()
    more = scanned.unionByName(spark.createDataFrame([(None, 1, "x"), ("/no", None, "y"), ("/no", 1, None)], scanned.schema))
    found = {r["path"].rsplit("/", 1)[1]: r["outcome"] for r in media_store.store_contents(more, root).collect()}
    assert found == {"a.jpg": "changed", "é.jpg": "gone", "b c.jpg": "stored"}
    assert len(_stored(root)) == 1 and media_store.held_contents(spark, root).count() == 1
    assert not list(Path(root).glob("drafts-*"))
    # The other file of that content is still there and found by the next scan.
    assert [r["outcome"] for r in media_store.store_contents(_scanned(spark, tmp_path / "in").where("path like '%d.jpg'"), root).collect()] == ["stored"]


def test_a_run_that_dies_leaves_nothing_half(spark, tmp_path, monkeypatch):
    files, root = _given(tmp_path / "in"), str(tmp_path / "out")
    scanned = _scanned(spark, tmp_path / "in")
    monkeypatch.setattr(media_store, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        media_store.store_contents(scanned, root)
    assert media_store.held_contents(spark, root).count() == 0
    monkeypatch.undo()
    Path(root, "drafts-of-a-dead-driver").mkdir()
    before = {p: p.stat().st_mtime_ns for p in Path(root, "content").glob("*/*")}
    assert media_store.store_contents(scanned, root).where("outcome = 'stored'").count() == 3
    assert {p: p.stat().st_mtime_ns for p in Path(root, "content").glob("*/*")} == before
    assert media_store.drop_drafts(spark, root) == ["drafts-of-a-dead-driver"] and media_store.drop_drafts(spark, root) == []
    assert len(_stored(root)) == len(set(files.values()))


def test_no_files(spark, tmp_path):
    none = spark.createDataFrame([], "path string, length long, md5 string")
    assert media_store.store_contents(none, str(tmp_path / "out")).count() == 0
    assert published.entry_numbers(spark, str(tmp_path / "out")) == []
    assert media_store.drop_drafts(spark, str(tmp_path / "nowhere")) == []
