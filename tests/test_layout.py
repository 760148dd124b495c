"""Live tables by key, and patches in numbered parts."""

import gzip
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalogsync.plans import products as P
from catalogsync.sources import layout, patch, published
from tests.helpers import SETTINGS, rows, store


def _live(spark, changes=()):
    prices = {k: k for k in range(1, 400)} | dict(changes)
    return store(
        spark,
        products=[dict(products_id=k, products_model=f"M{k % 350}" if k != 5 else None, products_price=p) for k, p in prices.items()],
        products_description=[dict(products_id=k, products_name=f"name {k}", products_description=f"text {p}") for k, p in prices.items()],
    )


def _feed(spark):
    made = spark.range(1, 300).select(F.concat(F.lit("M"), F.col("id").cast("string")).alias("products_model"))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in store(spark).products.schema if f.name in (
        "products_image", "products_price", "products_quantity", "products_weight", "products_status")}
    text = {c: F.lit("x") for c in ("products_name", "products_title", "products_description")}
    return made.groupBy("products_model").agg(F.count("*").alias("n")).drop("n").withColumns(empty | text)


def test_only_the_feed_is_moved(spark, tmp_path):
    path = str(tmp_path / "it's live")
    schema = layout.write_live(_live(spark), path, 8, SETTINGS)
    assert len(list(Path(path).glob("part-*"))) == 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = layout.read_by_key(spark, path, schema, "match_key", 8)
        diff = P.product_diff(live, _feed(spark), SETTINGS)
        plan = diff._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        joins = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert joins and all("products_model" in line for line in joins) and not re.search(r"hashpartitioning\((live_)?match_key", plan)
        got = diff.groupBy("change_kind").count()
        plain = P.product_diff(P.live_digests(_live(spark).products, _live(spark).products_description, SETTINGS), _feed(spark), SETTINGS)
        assert rows(got, "change_kind", "count") == rows(plain.groupBy("change_kind").count(), "change_kind", "count")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("laid_")]


def test_the_next_layout(spark, tmp_path):
    before, after = _live(spark), _live(spark, {7: 70, 360: 1, 1000: 5, 1001: 6})
    schema = layout.write_live(before, str(tmp_path / "a"), 8, SETTINGS)
    live = layout.read_by_key(spark, str(tmp_path / "a"), schema, "match_key", 8)
    changed = spark.createDataFrame([(7,), (360,), (1000,), (1001,)], "products_id int")
    layout.update_live(live, after, changed, str(tmp_path / "b"), 8, SETTINGS)
    layout.write_live(after, str(tmp_path / "c"), 8, SETTINGS)
    updated, whole = (layout.read_by_key(spark, str(tmp_path / n), schema, "match_key", 8) for n in "bc")
    columns = [c for c in whole.columns]
    assert rows(updated, *columns) == rows(whole, *columns)


def _patch(spark, n=25):
    given = [(1 + k % 3, 1 + k % 2, f"{k:03d}", f"SET {k}; -- é") for k in range(n)] + [(2, 2, "", "same"), (2, 2, "", "same")]
    return spark.createDataFrame(given, "phase int, step int, sort_key string, statement string").repartition(5), [g[3] for g in sorted(given)]


def test_statements_are_numbered_in_order(spark):
    given, want = _patch(spark)
    assert rows(patch.numbered_statements(given), "number", "statement") == list(enumerate(want, 1))
    assert patch.numbered_statements(given.limit(0)).count() == 0


def test_a_patch_in_parts(spark, tmp_path):
    root = str(tmp_path / "patches")
    given, want = _patch(spark)
    assert patch.publish_patch(given, root, 0, part_rows=10) == 1
    parts = published.read_entry(spark, root, 1)["parts"]
    assert [(p["first"], p["last"]) for p in parts] == [(1, 10), (11, 20), (21, 27)]
    # The parts are members of one compressed stream.
    files = [list(Path(root, p["folder"]).glob("*.gz")) for p in parts]
    assert all(len(f) == 1 for f in files)
    assert gzip.decompress(b"".join(f[0].read_bytes() for f in files)).decode().splitlines() == want
    assert [s for k in range(3) for s in patch.read_patch_part(spark, root, 1, k)] == want
    with pytest.raises(published.Conflict):
        patch.publish_patch(given, root, 0)
    assert published.read_entry(spark, root, 1)["parts"] == parts
    damaged = files[1][0]
    lines = gzip.decompress(damaged.read_bytes()).decode().splitlines()
    damaged.write_bytes(gzip.compress("\n".join(lines[::-1]).encode()))
    Path(damaged.parent, f".{damaged.name}.crc").unlink()
    with pytest.raises(ValueError):
        patch.read_patch_part(spark, root, 1, 1)
