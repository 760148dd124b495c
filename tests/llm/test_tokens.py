import hashlib
import random

import numpy as np
import pytest
import public_tokenizers as P

from catalogsync.llm import bpe, token_counts as TC
from llm_cases import LONG, ROWS, collected, frame, ordered

COUNTER = P.path("byte_bpe_50k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = "abcdefgh  \n\t.,é漢字ñ🙂0123\x1c\x85 'sTHE՘ꟲ"


def random_texts(n=400):
    draw = random.Random(5)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_counts_are_the_librarys(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(COUNTER)
    rows = ROWS + [(100 + k, t) for k, t in enumerate(random_texts())]
    want = [
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows
    ]
    got = collected(TC.token_counts(frame(spark, rows), COUNTER), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == ordered(want)


def test_counts_do_not_depend_on_the_frequent_table(spark, monkeypatch):
    monkeypatch.setattr(TC, "frequent_counts", lambda *a, **k: {})
    got = collected(TC.token_counts(frame(spark), COUNTER), "doc_id", "n_tokens")
    monkeypatch.undo()
    assert got == collected(TC.token_counts(frame(spark), COUNTER), "doc_id", "n_tokens")


def test_frequent_pieces_come_from_all_rows(spark):
    rows = [(k, "first words of one source") for k in range(2500)] + [(5000 + k, "zweite Sprache") for k in range(40)]
    found = TC.frequent_counts(frame(spark, rows).repartition(1).sortWithinPartitions("doc_id"), COUNTER)
    assert {"first", " words", "zweite", " Sprache"} <= set(found)
    few = TC.frequent_counts(frame(spark, rows), COUNTER, entries=5)
    assert set(few) == {"first", " words", " of", " one", " source"}


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(TC, "CACHE", 3)
    counted = TC.Counted(COUNTER, {})
    text = "some words that fill a small cache again and again"
    assert counted.count(text) == counted.library(text) and len(counted) <= 3


def test_split_agrees_with_the_library_on_settled_characters():
    from tokenizers import Tokenizer

    splitter = Tokenizer.from_file(COUNTER).pre_tokenizer
    for code in range(0x3400):
        c = chr(code)
        if TC.UNSETTLED.match(c):
            continue
        probe = f"a{c}a 1{c}1 !{c}! {c}{c} b"
        assert TC.SPLIT.findall(probe) == [probe[a:b] for _, (a, b) in splitter.pre_tokenize_str(probe)], hex(code)


def test_other_tokenizers_are_refused(spark):
    with pytest.raises(ValueError):
        TC.Counted(P.path("word_bpe_49k.json"), {})


def test_the_quick_split_is_the_patterns():
    codec = bpe.Codec(RANKS, P.PATTERN)
    quick = 0
    for code in [*range(0x3000), 0x4E2D, 0xAC00, 0x1F642]:
        c = chr(code)
        probe = f"a{c}a 1{c}1 !{c}! {c}{c} b's{c}'ll  {c}\n{c}"
        quick += codec.splitter(probe) is codec.quick
        assert codec.splitter(probe).findall(probe) == codec.split.findall(probe), hex(code)
    assert quick >= 0x250 and bpe.Codec(RANKS, r"\S+|\s+").quick is None


def test_all_characters_are_the_librarys(tiktoken_encoding):
    """Every code point of the basic plane but surrogates and private use, the pictures, and the older ideographs, in context."""
    codec = bpe.Codec(RANKS, P.PATTERN)
    spans = [range(0x80, 0xD800), range(0xF900, 0x10000), range(0x1F000, 0x1FB00), range(0x20000, 0x2A6E0)]
    codes = [code for span in spans for code in span]
    for k in range(0, len(codes), 64):
        probe = "".join(f"a{chr(c)}a 1{chr(c)}1 {chr(c)}. " for c in codes[k : k + 64])
        assert np.frombuffer(codec.encode(probe), "<u4").tolist() == tiktoken_encoding.encode(probe), hex(codes[k])


def test_generations_of_pieces(monkeypatch, tiktoken_encoding):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    codec = bpe.Codec(RANKS, P.PATTERN)
    for text in [*random_texts(60), *random_texts(60)]:
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == tiktoken_encoding.encode(text)
        assert len(codec.packed) <= 3 and len(codec.packed.older) <= 3


def test_pieces_merge_as_defined(tiktoken_encoding):
    codec = bpe.Codec(RANKS, P.PATTERN)
    for text in random_texts() + [LONG[:5000], "a" * 3000, "ab" * 1500, " " * 2000, "é" * 700, "🙂" * 300]:
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == tiktoken_encoding.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()


def test_backtracking_equals_the_merges_on_made_up_ranks():
    """Random vocabularies built by merging, so that longest matches are often wrong."""
    draw = random.Random(9)
    for _ in range(30):
        ranks = {bytes([b]): k for k, b in enumerate(b"abc")}
        while len(ranks) < 14:
            made = draw.choice(list(ranks)) + draw.choice(list(ranks))
            if made not in ranks and len(bpe.merge(made, ranks)) == 2:
                ranks[made] = len(ranks)
        encoder = bpe.Encoder(ranks)
        for _ in range(60):
            piece = bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, 14)))
            want = [ranks[piece]] if piece in ranks else [ranks[p] for p in bpe.merge(piece, ranks)]
            assert encoder.encode_piece(piece) == want, (ranks, piece)


def test_round_trip(spark, tiktoken_encoding):
    want = []
    for i, t in ROWS:
        ids = np.array(tiktoken_encoding.encode_ordinary(t or ""), dtype="<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.bpe_round_trip(frame(spark), RANKS, P.PATTERN)
    assert collected(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)
    texts = bpe.bpe_decode(bpe.bpe_encode(frame(spark), RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert collected(texts, "doc_id", "text") == ordered((i, t or "") for i, t in ROWS)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert TC.token_counts(none, COUNTER).count() == 0
    assert bpe.bpe_round_trip(none, RANKS, P.PATTERN).count() == 0
