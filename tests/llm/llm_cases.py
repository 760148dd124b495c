"""Small inputs with what real tables may hold, and plain versions to compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "The long text goes on and on, été 漢字 again. " * 4000

# (doc_id, text): a null id, null, empty and blank texts, a very long one, equal texts, a repeated row.
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away"),
    (2, "the quick brown fox jumps over the lazy dog and runs away"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, LONG),
    (7, "Crème brûlée à la carte, señor. Straße 🙂 <|endoftext|> ok"),
    (8, "don't    stop\n\n\n  now 12345 !!! \x1c \x85 end  "),
    (9, "12 34 ... 56"),
    (9, "12 34 ... 56"),
    (None, "a row without an id"),
    (11, "word"),
]


def frame(spark, rows=ROWS, source=False):
    """The rows as a table with further columns whose names clash with those the operators use."""
    extra = "key string, rep long, component long, n_tokens string, text_sha256 int, score string, size string, `a.b` int, TEXTS string"
    if source:
        rows = [(*r, None, None, None, "x", None, "s", "t", 1, "u") for r in rows]
        return spark.createDataFrame(rows, f"doc_id long, text string, source string, {extra}")
    rows = [(*r, None, None, None, "x", None, "s", "t", 1, "u") for r in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


def collected(df, *columns):
    found = [tuple(r[c] for c in columns) for r in df.collect()]
    return sorted(found, key=lambda t: [(v is not None, v) for v in t])


def ordered(rows):
    return sorted(rows, key=lambda t: [(v is not None, v) for v in t])


def near_components(texts, same=0.75):
    """Smallest reachable id by comparing all pairs of shingle sets; (size of the set, component) by id."""
    sets = {}
    for i, text in texts.items():
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}
