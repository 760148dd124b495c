from datetime import datetime

from pyspark.sql import functions as F

from catalogsync.functions import compare, image, keys, text


def _values(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clean_text(spark):
    given = ['12" café  “x”', " line1\r\n line2\t", '""', "", None, " \n "]
    assert _values(spark, given, text.clean_text) == ["12” café “x”", "line1 line2", "””", "", None, ""]


def test_cp1252(spark):
    assert len(text.CP1252_BYTES) == len(text.CP1252_CHARS) == 27
    for byte, char in zip(text.CP1252_BYTES, text.CP1252_CHARS):
        assert bytes([ord(byte)]).decode("cp1252") == char
    assert _values(spark, ["\x93x\x94 \x80 é \x81"], text.fix_cp1252) == ["“x” € é \x81"]


def test_quoted_literals_are_escaped(spark):
    assert _values(spark, ['a"b\\c', None], text.quoted) == ['"a\\"b\\\\c"', None]


def test_float_text(spark):
    assert _values(spark, [3.0, 3.5, 0.0, None, -2.0], text.float_text, "float") == ["3", "3.5", "0", None, "-2"]


def test_prefer_nonempty(spark):
    assert _values(spark, ["", "x", None], lambda c: text.prefer_nonempty(c, F.lit("other"))) == ["other", "x", None]


def test_dates(spark):
    moment = datetime(2019, 3, 31, 2, 30, 0)  # does not exist in every zone
    zone = spark.conf.get("spark.sql.session.timeZone")
    for other in ("UTC", "Europe/Berlin", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", other)
        row = spark.range(1).select(text.wall_clock(moment), text.time_text(text.wall_clock(moment))).first()
        assert tuple(row) == (moment, "2019-03-31 02:30:00")
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_null_is_no_change(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 2), (1, None), (None, None)], "a int, b int")
    got = df.select(compare.differs(F.col("a"), F.col("b")), compare.same(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(False, True), (True, False)] + [(False, False)] * 3
    assert [r[0] for r in df.select(compare.changed_to(F.col("a"), F.col("b"))).collect()] == [None, 1, None, 1, None]


def test_image_path(spark):
    # The long extension is replaced before folding, so an upper-case one stays long.
    given = ["Ab 12.jpeg", "AB12.JPEG", "x.tiff", None]
    assert _values(spark, given, image.image_path) == ["ab/ab12.jpg", "ab/ab12.jpeg", "x./x.tif", None]


def test_name_parts(spark):
    assert _values(spark, ["a/b.c/d.e.jpg"], lambda c: image.stem(image.base_name(c))) == ["d.e"]
    assert _values(spark, ["a.jpg", "none"], image.extension) == ["jpg", ""]
    assert _values(spark, ["jpeg", "tiff", "png"], image.short_extension) == ["jpg", "tif", "png"]
    assert _values(spark, ["jpg", "tif", "png"], image.long_extension) == ["jpeg", "tiff", None]
    assert _values(spark, ["thumb t", "x/large z", "t", "art", ""], image.size_suffix) == ["t", "z", "", "", ""]
    assert _values(spark, ["ab_z", "ab_zz", "ab"], image.without_mark) == ["ab", "ab_zz", "ab"]


def test_canonical_keys(spark):
    given = ["É b ", "e B", "ß", "S", "й", "И", "", "  ", None, "中", "x\t", "a\u0301", "a"]
    got = _values(spark, given, keys.canonical_key)
    assert got[:4] == ["e b", "e b", "s", "s"] and got[4] == got[5]
    assert got[6:11] == ["", "", None, "中", "x\t"] and got[11] != got[12]
