import gzip
import os
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from catalogsync.operators.validate import append_issues
from catalogsync.plans.run import rejected_issues
from catalogsync.schemas import CATEGORY_ISSUES, FEEDS, PLACEMENT_ISSUES
from catalogsync.session import release, stage, staged_paths, work_dir
from catalogsync.sources import feeds, media, patch, snapshots
from catalogsync.sources import store as stores
from tests.helpers import feed, rows, store


def _write(path: Path, data: bytes, day: str | None = None) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    if day:
        at = datetime.fromisoformat(f"{day}T12:00:00+00:00").timestamp()
        os.utime(path, (at, at))
    return str(path)


def test_cp1252_quotes_and_line_breaks(spark, tmp_path):
    path = _write(
        tmp_path / "d.csv",
        b'code,text\n"A1","12"" caf\xe9 \x93x\x94"\n"A2","line1\r\nline2"\n"A3",""\n"A4",\n',
        "2019-03-13",
    )
    got = feeds.read_feed(spark, "descriptions", path)
    assert rows(got, "prod_code", "narrative") == [
        ("A1", "12” café “x”"), ("A2", "line1 line2"), ("A3", ""), ("A4", None)
    ]
    assert {r[0] for r in got.select("snapshot_date").collect()} == {date(2019, 3, 13)}


def test_flawed_rows_stay_and_are_listed(spark, tmp_path):
    path = _write(
        tmp_path / "s.csv",
        b"c,d,q,w,p,del,dis,img,cant\nA1,one,2,1.5,9.99,,0,a.jpg,0\nA5,bad,x,1,1,,0,b.jpg,0\n"
        b"A6,long,1,1,1,,0,b.jpg,0,extra\nA7,,,,,,,,\nA8,short,3,1,2.5\n,none,1,1,1,,0,c.jpg,0\n",
    )
    good = feeds.read_feed(spark, "stockinfo", path)
    assert rows(good, "prod_code", "prod_desc", "units_qty", "price", "cantsell", "prod_image") == [
        ("A1", "one", 2.0, Decimal("9.9900"), 0, "a.jpg"),
        ("A5", "bad", None, Decimal("1.0000"), 0, "b.jpg"),
        ("A6", "long", 1.0, Decimal("1.0000"), 0, "b.jpg"),
        ("A7", "", 0.0, Decimal("0.0000"), 0, None),
        ("A8", "short", 3.0, Decimal("2.5000"), 0, None),
    ]
    # Whatever is asked for, the same rows are there.
    for column in (*good.columns, "snapshot_date"):
        assert good.select(column).count() == good.count() == len(good.select(column).collect()) == 5
    bad = feeds.rejected_rows(spark, "stockinfo", path)
    assert rows(bad, "key", "record", "kept") == [
        ("", ",none,1,1,1,,0,c.jpg,0", False),
        ("A5", "A5,bad,x,1,1,,0,b.jpg,0", True),
        ("A6", "A6,long,1,1,1,,0,b.jpg,0,extra", True),
        ("A8", "A8,short,3,1,2.5", True),
    ]
    found = rejected_issues(bad)
    assert rows(found.products, "products_model", "issue") == [
        (m, "Rejected row") for m in ("", "A5", "A6", "A8")
    ]
    assert found.categories.isEmpty() and found.placements.isEmpty()


def test_line_breaks_in_any_feed(spark, tmp_path):
    for end in (b"\n", b"\r\n", b"\r"):
        for inside in (b"\n", b"\r\n", b"\r"):
            text = end.join([b"n,c,d,s,p", b'"one' + inside + b'two",7,1,1,0', b'"three",8,1,1,0', b""])
            got = feeds.read_feed(spark, "departments", _write(tmp_path / f"{len(end)}{end[0]}{len(inside)}{inside[0]}.csv", text))
            assert rows(got, "dept_name", "dept_code") == [("one two", 7), ("three", 8)]


def test_files_without_line_breaks_are_read_in_splits(spark, tmp_path):
    path = _write(tmp_path / "p.csv", b"code,dept\n" + b"".join(b"P%06d,%d\n" % (k, k) for k in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        whole = feeds.read_feed(spark, "product_department", path)
        split = feeds.read_feed(spark, "product_department", path, line_breaks=False)
        parts = split.select(F.spark_partition_id()).distinct().count()
        assert parts > 2 and whole.select(F.spark_partition_id()).distinct().count() == 1
        assert split.count() == whole.count() == 20_000 == split.select("prod_code").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_delivery_is_one_day(spark, tmp_path):
    _write(tmp_path / "f/1.csv", b"code,dept\nA,1\n", "2019-03-13")
    _write(tmp_path / "f/2.csv", b"code,dept\nB,2\n", "2019-03-14")
    got = feeds.read_feed(spark, "product_department", str(tmp_path / "f"))
    snapshots.archive_feed(got, "product_department", str(tmp_path / "r"))
    assert snapshots.snapshot_days(spark, "product_department", str(tmp_path / "r")) == [date(2019, 3, 14)]
    back = snapshots.read_snapshot(spark, "product_department", str(tmp_path / "r"), date(2019, 3, 14))
    assert rows(back, "prod_code") == [("A",), ("B",)]
    dated = feeds.read_feed(spark, "product_department", str(tmp_path / "f"), day=date(2020, 1, 1))
    assert {r[0] for r in dated.select("snapshot_date").collect()} == {date(2020, 1, 1)}


def test_missing_values_take_defaults_and_text_is_cut(spark, tmp_path):
    path = _write(tmp_path / "p.csv", b"name,code,deep,show,parent\n" + b"n" * 300 + b",7,1,,\n")
    row = feeds.read_feed(spark, "departments", path).first()
    assert (len(row.dept_name), row.dept_code, row.dept_show, row.parent_id) == (255, 7, 1, 0)


def test_folder_of_files_is_one_feed(spark, tmp_path):
    _write(tmp_path / "f/1.csv", b"code,dept\nA,1\n")
    _write(tmp_path / "f/2.csv", b"code,dept\nB,2\n")
    got = feeds.read_feed(spark, "product_department", str(tmp_path / "f"))
    assert rows(got, "prod_code", "dept_code") == [("A", 1), ("B", 2)]


def test_require_feeds(spark):
    names = spark.createDataFrame([(n,) for n in FEEDS], "name string")
    assert feeds.require_feeds(names)
    assert not feeds.require_feeds(names.where("name <> 'stockinfo'"))


def test_changed_sources(spark, tmp_path):
    for name, now, before in (("same", b"1", b"1"), ("other", b"2", b"x"), ("fresh", b"3", None)):
        _write(tmp_path / "test" / name, now)
        if before:
            _write(tmp_path / "active" / name, before)
    # Equal base names in different folders are different files.
    for folder in ("complete", "stockinfo"):
        for side in ("test", "active"):
            _write(tmp_path / side / folder / "part-0", folder.encode())
    for digests in (snapshots.file_digests, snapshots.text_digests):
        test, active = (digests(spark, str(tmp_path / d)) for d in ("test", "active"))
        assert rows(snapshots.changed_sources(test, active), "name") == [("fresh",), ("other",)]
        assert ("complete/part-0",) in rows(test, "name")


def test_archive_and_read_back(spark, tmp_path):
    root = str(tmp_path / "record")

    def archived(day, *given):
        df = feed(spark, "product_department", *given).withColumn("snapshot_date", F.lit(day))
        snapshots.archive_feed(df, "product_department", root)

    first, second = date(2019, 3, 13), date(2019, 3, 14)
    archived(first, dict(prod_code="A", dept_code=1))
    archived(second, dict(prod_code="B", dept_code=2))
    archived(second, dict(prod_code="C", dept_code=3))
    assert snapshots.snapshot_days(spark, "product_department", root) == [first, second]
    read = snapshots.read_snapshot(spark, "product_department", root, second)
    assert rows(read, "prod_code", "dept_code") == [("C", 3)]
    assert "PartitionFilters: [isnotnull(snapshot_date" in read._jdf.queryExecution().executedPlan().toString()
    assert snapshots.replay_time(first) == datetime(2019, 3, 13, 21, 13, 8)


def test_scan_media(spark, tmp_path):
    _write(tmp_path / "pics/1/pics/a.jpg", b"12")
    _write(tmp_path / "pics/1/pics/large z/b_z.jpg", b"345")
    got = rows(media.scan_media(spark, str(tmp_path / "pics/1/pics")), "dir", "name", "length")
    assert got == [("", "a.jpg", 2), ("large z", "b_z.jpg", 3)]


def test_missing_report(spark, tmp_path):
    media.write_missing_report(spark.createDataFrame([("b/b",), ("a/a",)], "key string"), str(tmp_path / "m"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "m")).collect()] == ["a/a", "b/b"]


def test_store_versions_and_control_categories(spark, tmp_path):
    base = store(spark, categories=[dict(categories_id=1)])
    imports, issues = (100001, "In", "In text"), (100002, "Bad", "Bad text")
    seeded = stores.seed_control_categories(base, imports, issues)
    stores.write_store(seeded, str(tmp_path / "v1"))
    again = stores.seed_control_categories(stores.read_store(spark, str(tmp_path / "v1")), imports, issues)
    assert rows(again.categories, "categories_id", "parent_id", "categories_status") == [
        (1, 0, 1), (100001, 0, 0), (100002, 0, 0)
    ]
    assert stores.control_category_id(again.categories_description, "In") == 100001
    assert stores.control_category_id(again.categories_description, "nothing") is None
    assert rows(again.meta_tags_categories_description, "categories_id", "metatags_title") == [
        (100001, "In"), (100002, "Bad")
    ]


def test_patch_file_order(spark, tmp_path):
    given = [(2, 1, "b", "s3"), (1, 2, "", "s2"), (1, 1, "z", "s1"), (2, 1, "c", "s4")]
    df = spark.createDataFrame(given, "phase int, step int, sort_key string, statement string").repartition(3)
    patch.write_patch(df, str(tmp_path / "p"))
    parts = sorted((tmp_path / "p").glob("part-*.txt.gz"))
    lines = [line for part in parts for line in gzip.open(part, "rt").read().splitlines()]
    assert lines == ["s1", "s2", "s3", "s4"]
    dated = [patch.write_dated_patch(df, str(tmp_path / "runs"), datetime(2020, 1, 2, 3, 4, k)) for k in (5, 6)]
    assert dated[0].endswith("2020.01.02-030405") and spark.read.text(dated).count() == 8
    patch.write_phase_patches(df, str(tmp_path / "by_phase"))
    assert spark.read.text(str(tmp_path / "by_phase/products")).count() == 2


def test_issue_log_first_write_wins(spark):
    log = spark.createDataFrame([(1, "Name too long", "old", None)], CATEGORY_ISSUES)
    new = spark.createDataFrame(
        [(1, "Name too long", "new", None), (1, "Inactive parent", "b", None), (1, "Inactive parent", "a", None)],
        CATEGORY_ISSUES,
    )
    got = append_issues(log, new, ["categories_id", "issue"])
    assert rows(got, "categories_id", "issue", "note_1") == [(1, "Inactive parent", "a"), (1, "Name too long", "old")]


def test_issue_log_keys_may_be_null(spark):
    log = spark.createDataFrame([(1, 2, "No category assigned", None, None, None)], PLACEMENT_ISSUES)
    key = ["categories_id", "products_id", "issue", "products_model"]
    assert append_issues(append_issues(log, log, key), log, key).count() == 1


def test_released_tables_are_gone(spark):
    before = staged_paths()
    kept, gone = stage(spark.range(2).toDF("n"), "kept"), stage(spark.range(3).toDF("n"), "gone")
    made = staged_paths() - before
    release(spark, [p for p in made if p.endswith("gone")])
    assert kept.count() == 2 and len(staged_paths() - before) == 1
    release(spark, made)
    assert staged_paths() == before


def test_stage_uses_the_named_folder(spark):
    staged = stage(spark.range(3).toDF("n"), "numbers")
    assert rows(staged, "n") == [(0,), (1,), (2,)]
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_dir(spark) == named
        assert all(named.removeprefix("file:") in f for f in staged.inputFiles())
