"""A feed's record as intervals."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from catalogsync.sources import intervals, published
from tests.helpers import feed, rows

DAYS = [date(2020, 1, k) for k in (1, 2, 5, 6)]


def _links(spark, *pairs):
    return feed(spark, "product_department", *[dict(prod_code=c, dept_code=d) for c, d in pairs])


def test_every_day_is_read_back(spark, tmp_path):
    root = str(tmp_path / "record")
    given = [
        [("A", 1), ("B", 2), ("B", 2), ("C", None)],
        [("A", 1), ("B", 2), ("C", 3), ("", 4)],
        [("A", 1), ("B", 2), ("C", 3), ("", 4)],
        [("A", 1), ("B", 2), ("B", 2), ("C", None)],
    ]
    for day, pairs in zip(DAYS, given):
        intervals.record_day(_links(spark, *pairs), "product_department", root, day)
    assert intervals.recorded(spark, root) == DAYS
    order = lambda pairs: sorted(pairs, key=lambda t: [(v is not None, v) for v in t])
    for day, pairs in zip(DAYS, given):
        assert rows(intervals.read_day(spark, "product_department", root, day), "prod_code", "dept_code") == order(pairs)
    assert rows(intervals.read_day(spark, "product_department", root, date(2020, 1, 4)), "prod_code") == [("",), ("A",), ("B",), ("C",)]
    assert intervals.read_day(spark, "product_department", root, date(2019, 12, 31)).count() == 0
    found = intervals.intervals(spark, "product_department", root)
    kept = rows(found.where("prod_code = 'A'"), "copies", "valid_from", "valid_to")
    assert kept == [(1, DAYS[0], None)] and found.count() == 8
    # The third day is like the second one: on record without a file.
    third = published.read_entry(spark, root)["days"][2]
    assert third == {"day": "2020-01-05", "opened": None, "closed": None}
    with pytest.raises(ValueError):
        intervals.record_day(_links(spark), "product_department", root, DAYS[3])


def test_one_change_writes_one_row(spark, tmp_path):
    root = str(tmp_path / "record")
    many = spark.range(3000).select(F.concat(F.lit("P"), "id").alias("prod_code"), (F.col("id") % 9).cast("int").alias("dept_code"))
    intervals.record_day(many, "product_department", root, DAYS[0])
    moved = many.withColumn("dept_code", F.when(F.col("prod_code") == "P77", 100).otherwise(F.col("dept_code")))
    intervals.record_day(moved, "product_department", root, DAYS[1])
    last = published.read_entry(spark, root)["days"][1]
    assert published.part_size(spark, root, last["opened"])[0] == published.part_size(spark, root, last["closed"])[0] == 1


def test_a_day_that_dies_is_not_on_record(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "record")
    intervals.record_day(_links(spark, ("A", 1)), "product_department", root, DAYS[0])
    with monkeypatch.context() as broken:
        broken.setattr(intervals, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            intervals.record_day(_links(spark, ("B", 1)), "product_department", root, DAYS[1])
    assert intervals.recorded(spark, root) == DAYS[:1]
    intervals.record_day(_links(spark, ("B", 2)), "product_department", root, DAYS[1])
    assert rows(intervals.read_day(spark, "product_department", root, DAYS[1]), "prod_code", "dept_code") == [("B", 2)]
