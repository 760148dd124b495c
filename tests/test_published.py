"""What is published step by step: the issue log and the versions of a store."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from catalogsync.plans.run import Issues, empty_issues, run
from catalogsync.schemas import CATEGORY_ISSUES, PLACEMENT_ISSUES, PRODUCT_ISSUES
from catalogsync.sources import issue_log as logs
from catalogsync.sources import published, versions
from tests.helpers import SETTINGS, feed, rows, store


def _products(spark, *found):
    return replace(empty_issues(spark), products=spark.createDataFrame(list(found), PRODUCT_ISSUES))


def test_the_log_of_two_sessions(spark, tmp_path):
    root = str(tmp_path / "log")
    assert rows(logs.read_log(spark, root).products, "products_model") == []
    first = _products(spark, ("A", "Missing Name", "one", None), ("A", "Missing Name", "two", None), (None, "Rejected row", None, "x"))
    assert logs.extend_log(first, root) == 1
    other = spark.newSession()
    again = _products(other, ("A", "Missing Name", "three", None), (None, "Rejected row", None, "y"))
    assert logs.extend_log(again, root) == 1
    more = Issues(
        other.createDataFrame([(7, "Invalid parent_id", None, None)], CATEGORY_ISSUES),
        other.createDataFrame([("A", "Missing Name", "four", None), ("A", "Name too long", None, None)], PRODUCT_ISSUES),
        other.createDataFrame([(None, 3, "Unknown product", None, "n", None)] * 2, PLACEMENT_ISSUES),
    )
    assert logs.extend_log(more, root) == 2
    assert rows(logs.read_entries(spark, root, "products"), "products_model", "issue", "note_1", "run") == [
        (None, "Rejected row", None, 1), ("A", "Missing Name", "one", 1), ("A", "Name too long", None, 2)
    ]
    assert logs.read_log(spark, root).categories.count() == logs.read_log(spark, root).placements.count() == 1
    assert logs.read_entries(spark, root, "products", 1).count() == 2
    with pytest.raises(FileNotFoundError):
        logs.read_entries(spark, root, "products", 5)


def test_a_run_that_dies_leaves_the_log(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "log")
    logs.extend_log(_products(spark, ("A", "Missing Name", None, None)), root)
    found = replace(_products(spark, ("B", "Missing Name", None, None)), categories=spark.createDataFrame([(1, "x", None, None)], CATEGORY_ISSUES))
    with monkeypatch.context() as broken:
        broken.setattr(logs, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            logs.extend_log(found, root)
    assert rows(logs.read_log(spark, root).products, "products_model") == [("A",)]
    assert len(published.unnamed_parts(spark, root)) == 2
    assert logs.extend_log(found, root) == 2
    assert rows(logs.read_log(spark, root).products, "products_model") == [("A",), ("B",)]
    assert logs.read_log(spark, root).categories.count() == 1


def test_only_files_that_may_hold_a_key_are_opened(spark, tmp_path):
    root = str(tmp_path / "log")
    many = [(f"M{k}", "Missing Name", None, None) for k in range(4000)]
    logs.extend_log(_products(spark, *many), root, file_rows=1000)
    entry = published.read_entry(spark, root)
    files = entry["products"][0]["files"]
    assert len(files) == 4 and sum(f["rows"] for f in files) == 4000
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:]))
    few = _products(spark, many[17], ("new", "Missing Name", None, None)).products
    fresh, opened = logs.unknown_entries(few, entry, root, "products")
    assert 1 <= len(opened) <= 2 and rows(fresh, "products_model") == [("new",)]


def test_parts_are_folded(spark, tmp_path):
    root = str(tmp_path / "log")
    for k in range(4):
        logs.extend_log(_products(spark, (f"M{k}", "Missing Name", str(k), None)), root, most_parts=3)
    assert len(published.read_entry(spark, root)["products"]) == 1
    assert rows(logs.read_entries(spark, root, "products"), "products_model", "run") == [(f"M{k}", k + 1) for k in range(4)]


def test_a_run_reads_and_extends_the_log(spark, tmp_path):
    """What a run found goes to the log; the next run is excused by it and adds nothing."""
    root = str(tmp_path / "log")
    tables = store(spark, categories=[dict(categories_id=1), dict(categories_id=2, parent_id=1)])
    feeds = dict(
        departments=feed(spark, "departments", dict(dept_name="n" * 40, dept_code=1), dict(dept_name="two", dept_code=2, parent_id=1), dict(dept_name="lost", dept_code=3, parent_id=77)),
        complete=feed(spark, "complete", dict(prod_code="A", prod_desc="a " * 60, narrative=None)),
        stockinfo=feed(spark, "stockinfo"), descriptions=feed(spark, "descriptions"),
        product_department=feed(spark, "product_department", dict(prod_code="A", dept_code=2), dict(prod_code="zz", dept_code=2)),
    )
    counts = []
    for session in (spark, spark.newSession()):
        log = logs.read_log(session, root)
        result = run(tables, feeds, log, SETTINGS)
        logs.extend_log(result.found, root)
        counts.append([getattr(logs.read_log(session, root), n).count() for n in logs.LOGS])
        assert [getattr(result.issues, n).count() for n in logs.LOGS] == counts[0]
    assert counts[0] == counts[1] and min(counts[0]) >= 1
    assert published.entry_numbers(spark, root) == [1]


def _store(spark, products, links=()):
    return store(
        spark,
        products=[dict(products_id=i, products_model=m, products_price=p) for i, m, p in products],
        products_to_categories=[dict(products_id=a, categories_id=b) for a, b in links],
    )


def test_versions_write_what_changes(spark, tmp_path):
    root = str(tmp_path / "store")
    base = [(k, f"M{k}", k) for k in range(2000)]
    assert versions.first_version(_store(spark, base, [(1, 1), (2, 2)]), root) == 1
    second = [(k, f"M{k}", 5 if k == 7 else k) for k in range(1, 2001)]
    assert versions.next_version(_store(spark, second, [(2, 2), (2, 3)]), root) == 2
    change = versions.changes_of(spark, root, "products")
    assert rows(change, "products_id", "products_model", "gone") == [(0, None, True), (7, "M7", False), (2000, "M2000", False)]
    assert rows(versions.changes_of(spark, root, "products_to_categories"), "products_id", "categories_id", "gone") == [(1, 1, True), (2, 3, False)]
    assert versions.changes_of(spark, root, "categories").count() == 0
    entry = published.read_entry(spark, root)
    (part,) = entry["products"]["changes"]
    assert published.part_size(spark, root, part)[0] == 3 and entry["categories"]["changes"] == []
    # What was away comes back, what changed changes again; the last change wins.
    third = [(0, "M0", 9), *[(k, f"M{k}", 6 if k == 7 else k) for k in range(1, 2000)]]
    assert versions.next_version(_store(spark, third, [(2, 2), (2, 3)]), root) == 3
    for number, want in ((None, third), (3, third), (2, second), (1, base)):
        got = versions.read_version(spark, root, number).products
        assert rows(got, "products_id", "products_model", F.col("products_price").cast("int")) == want
    # No change, no version.
    assert versions.next_version(versions.read_version(spark, root), root) == 3


def test_changes_are_folded(spark, tmp_path):
    root = str(tmp_path / "store")
    versions.first_version(_store(spark, [(1, "A", 1)]), root)
    for k in range(2, 6):
        versions.next_version(_store(spark, [(1, "A", k), (k, "B", k)]), root, most_changes=2)
    entry = published.read_entry(spark, root)
    assert len(entry["products"]["changes"]) <= 2
    assert rows(versions.read_version(spark, root).products, "products_id", "products_model") == [(1, "A"), (5, "B")]
    assert rows(versions.read_version(spark, root, 3).products, "products_id") == [(1,), (3,)]


def test_half_a_version_is_none(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)
    versions.first_version(_store(spark, [(1, "A", 1)], [(1, 1)]), root)
    written = []

    def dies(df, where, kind, real=versions.write_part):
        if kind.startswith("products_to"):
            raise OSError("executor gone")
        written.append(kind)
        return real(df, where, kind)

    with monkeypatch.context() as broken:
        broken.setattr(versions, "write_part", dies)
        with pytest.raises(OSError):
            versions.next_version(_store(spark, [(1, "A", 2)], [(1, 2)]), root)
    assert "products-changes" in written
    assert rows(versions.read_version(spark, root).products, F.col("products_price").cast("int")) == [(1,)]
    os.remove(f"{root}/_entries/000000001.json")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)


def test_one_of_two_writers_fails(spark, tmp_path):
    root = str(tmp_path / "any")
    assert published.publish(spark, root, {"a": 1}, 0) == 1
    with pytest.raises(published.Conflict):
        published.publish(spark, root, {"a": 2}, 0)
    assert published.read_entry(spark, root) == {"a": 1, "number": 1}
    assert published.publish(spark, root, {"a": 3}, 1) == 2
