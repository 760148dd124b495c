import re
from collections import Counter

import pytest

from catalogsync.llm import divergence as D
from llm_cases import LONG, ordered

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def want(rows, min_docs, top):
    """All groups with all kept terms, as the definition reads."""
    lower = str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(lower)))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        kept = sorted(t for t, n in Counter(t for d in mine for t in d[2]).items() if n >= min_docs)
        sources = sorted({d[1] for d in mine}, key=str.encode)
        counts = {s: {t: sum(d[2][t] for d in mine if d[1] == s) for t in kept} for s in sources}
        counts[None] = {t: sum(counts[s][t] for s in sources) for t in kept}
        share = {s: {t: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()} for s, c in counts.items()}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(o, sum(f(share[s][t], share[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(share[s][t], share[None][t])) for t in kept if counts[s][t] and share[s][t] > share[None][t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)]
    return ordered(out)


# (text, lang, source): ties, letters beyond ASCII, null and empty values, repeated rows, a very long text, a group without terms.
ROWS = [
    ("The cat, the DOG and the bird", "en", "a"),
    ("the cat and the dog", "en", "b"),
    ("the cat and the dog", "en", "b"),
    ("Zebra yak xenon zebra yak xenon", "en", "c"),
    ("zebra Yak XENON", "en", "d"),
    ("123 456 ... ", "en", "e"),
    (None, "en", None),
    ("the only words of a row without a source: the cat", "en", None),
    ("Été ÉTÉ été straße 漢字 漢字🙂", "fr", "a"),
    ("été Été don't été's straße 漢字", "fr", "b"),
    ("seul", "de", "a"),
    ("the null language has the words", None, "a"),
    ("the null language", "", "z"),
    (LONG, "en", "a"),
    (LONG, "fr", "c"),
    ("", "xx", "a"),
    ("", "xx", "b"),
]


def frame(spark, rows):
    """With further columns whose names clash with those the operator uses."""
    extra = "n long, term string, value string, `a.b` int, rank string, TEXTS string, p int"
    return spark.createDataFrame([(*r, 7, "t", "v", 1, "r", "x", None) for r in rows], f"text string, lang string, source string, {extra}")


def got(df):
    return ordered(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("block, tile, cells", [(D.BLOCK, D.TILE, D.CELLS), (3, 2, 4)])
def test_all_groups(spark, block, tile, cells):
    """Also where terms come in many blocks and sources in several tiles."""
    assert got(D.audit(frame(spark, ROWS), min_docs=2, top=4, block=block, tile=tile, cells=cells)) == want(ROWS, 2, 4)


def test_many_equal_values(spark):
    """A cell holds far more terms than are asked for; the UTF-8 order decides."""
    words = [f"{a}{b}" for a in "bcdé漢z" for b in "aeiouy🙂"]
    rows = [(" ".join(words), "en", "a"), (" ".join(words[::-1]) + " common", "en", "a"), ("common words " * 9, "en", "b"), ("words common", "en", "b")]
    assert got(D.audit(frame(spark, rows), min_docs=2)) == want(rows, 2, 10)


def test_pieces(monkeypatch):
    """A text in pieces and tallies handed on early give the same sums."""
    monkeypatch.setattr(D, "PIECE", 7)
    text = "the cat, the DOG; été 漢字" + "y" * 40 + " and the end"
    assert [t for piece in D._pieces(text) for t in piece] == [t.encode() for t in TERM.findall(text.lower())]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": [text, text, ""], "lang": ["en"] * 3, "source": ["a", "b", "c"]})
    monkeypatch.setattr(D, "HELD", 5)
    sums = Counter()
    for out in D._tally(iter([batch, batch])):
        for lang, source, term, n, docs in zip(*(out.column(k).to_pylist() for k in range(5))):
            sums[lang, source, term] += n * 100 + docs
    words = Counter(TERM.findall(text.lower()))
    assert sums == Counter({("en", s, t): 2 * (n * 100 + 1) for s in "ab" for t, n in words.items()})
    assert ("en", "c", "") in sums


def test_shares_beyond_a_long_product(spark):
    counts = [(0, 5), (3, 5), (10**12, 3 * 10**15), (9 * 10**14, 9 * 10**15 - 1), (10**10, 10**10 + 2)]
    rows = spark.createDataFrame(counts, "n long, total long").select("n", "total", D.share("n", "total").alias("p")).collect()
    assert [r["p"] for r in rows] == [1 + 10**9 * (n + 2) // total for n, total in counts]


def test_nothing(spark):
    assert got(D.audit(frame(spark, []))) == []
    assert got(D.audit(frame(spark, [(None, None, None)]))) == []
    assert got(D.audit(frame(spark, [(None, None, "a"), ("few words", None, "b")]))) == want([(None, None, "a"), ("few words", None, "b")], 10, 10)
