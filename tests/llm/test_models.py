import os
from zlib import crc32

import numpy as np
import pytest

from catalogsync.llm import language_id as L, lm_score as S, quality as Q
from llm_cases import ROWS, collected, frame, ordered


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    folder = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels")}


def test_language_accuracy_on_held_out_documents(tables):
    truth = {r["doc_id"]: r["lang"] for r in tables["documents"].collect()}
    found = L.identify(tables["documents"]).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(truth) and all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_cases(spark, tables):
    profiles = L.language_profiles(tables["documents"].limit(200))
    got = L.predict_language(frame(spark), profiles)
    assert got.count() == len(ROWS)
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    for k in (3, 4, 5, 9):
        assert by_id[k] == ("und", 0.0)
    assert None in by_id and by_id[6][0] != "und"
    none = L.language_profiles(frame(spark, []), lang="TEXTS")
    assert none.names == [] and set(collected(L.predict_language(frame(spark), none), "lang_pred")) == {("und",)}
    assert L.predict_language(frame(spark, []), profiles).count() == 0
    kept = L.keep_identified(frame(spark), profiles)
    assert kept.columns == frame(spark).columns
    assert collected(kept, "doc_id") == ordered((i,) for i, t in ROWS if any(c.isalpha() for c in t or ""))


def test_bundles_are_sums_of_bound_letters():
    space = L.Space(256)
    text = "Ab, cab!"
    want = np.zeros(256)
    for a, b, c in zip(" ab cab ", " ab cab "[1:], " ab cab "[2:]):
        want += np.roll(space.letter(ord(a)), 2) * np.roll(space.letter(ord(b)), 1).astype(int) * space.letter(ord(c))
    assert np.allclose(space.bundle([text, None, "", "12"])[0], want)
    assert not space.bundle([text, None, "", "12"])[1:].any()


def test_words_of_a_text_are_scored_at_once_to_the_same_bits(monkeypatch):
    margins = np.random.default_rng(3).normal(size=Q.BUCKETS)
    words = [f"{'wörd' if k % 3 else 'w'}{'x' * (k % 40)}{k}".encode() for k in range(900)] + [b"y" * 200, b"\xff\xfe"]
    text = b" ".join(words + words[::2])
    alone = {w: complex(float(margins[Q.features(w)].sum()), len(Q.features(w))) for w in words}
    total = sum((alone[w] for w in text.split()), 0j)
    single = []
    monkeypatch.setattr(Q, "features", lambda word, inner=Q.features: single.append(word) or inner(word))
    want = float(1 / (1 + np.exp(-(0.25 + total.real / total.imag))))
    assert Q.Scorer(margins, 0.25).score(text) == want
    assert set(single) == {b"y" * 200}  # only what is too long to be kept
    for kept, at_once in ((50, 20_000), (100, 7)):
        monkeypatch.setattr(Q, "WORDS_KEPT", kept)
        monkeypatch.setattr(Q, "WORDS_AT_ONCE", at_once)
        assert Q.Scorer(margins, 0.25).score(text) == want
    texts = [b"", text, text[:500], b"new words", text[100:900]] * 3
    assert list(Q.Scorer(margins, 0.25).scores(texts)) == [Q.Scorer(margins, 0.25).score(t) for t in texts]
    assert Q.Scorer(margins, 0.0).score(b" ") == 0.5
    letters = np.frombuffer(text[:3000], dtype=np.uint8).astype(np.uint32)
    assert all(Q.window_hashes(letters, n).tolist() == [crc32(text[k : k + n]) for k in range(3001 - n)] for n in (3, 4))
    assert Q.window_hashes(letters, 12, 4).tolist() == [crc32(text[k : k + 12]) for k in range(0, 2989, 4)]


def test_quality_on_held_out_documents(tables):
    label = {r["doc_id"]: r["quality"] for r in tables["labels"].collect()}
    found = Q.classify(tables["documents"], tables["labels"]).collect()
    assert len(found) == tables["documents"].count()
    held = [(r["score"], label[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in label]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found)


def test_quality_cases(spark, monkeypatch):
    monkeypatch.setattr(Q, "LEAST_STEPS", 0)
    docs = frame(spark, ROWS + [(k, f"good text number {k}" if k % 2 else f"JUNK!! {k} $$$") for k in range(200, 260)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(200, 260)] + [(1, None), (None, 1), (7, 5), (3, 1)], "doc_id long, quality int")
    model = Q.fit_quality(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in Q.score_quality(docs, model).collect()}
    assert scores[201] > scores[202] and scores[3] == scores[4] == scores[5]
    assert Q.score_quality(docs, model).count() == docs.count()
    blank = Q.fit_quality(docs, labels.limit(0))
    assert set(collected(Q.score_quality(docs, blank), "score")) == {(0.5,)}
    assert Q.score_quality(frame(spark, []), model).count() == 0


def test_a_score_is_the_softmax_of_the_averaged_vectors():
    random = np.random.default_rng(2)
    model = Q.Model(random.normal(size=(Q.BUCKETS, Q.DIMENSIONS)), random.normal(size=(Q.DIMENSIONS, 2)), random.normal(size=2))
    text = "Some words, été and some words".encode()
    used, shares = Q.text_features(text, {})
    want = Q.softmax((shares @ model.vectors[used]) @ model.weights + model.bias)[1]
    margins = model.vectors @ (model.weights[:, 1] - model.weights[:, 0])
    assert abs(Q.Scorer(margins, model.bias[1] - model.bias[0]).score(text) - want) < 1e-6


def test_pseudo_likelihood_is_the_sum_over_all_bytes(monkeypatch):
    net = S.Network(np.random.default_rng(1).normal(size=S.Network.size()).astype(np.float32))
    texts = [b"abcabd", b"", None, b"x", "é漢".encode() * 9]
    want = []
    for data in texts:
        total, padded = 0.0, [S.EDGE] * S.SIDE + list(data or b"") + [S.EDGE] * S.SIDE
        for k in range(len(data or b"")):
            window = np.array([[padded[S.SIDE + k + p] for p in S.PLACES]])
            total += net.log_probabilities(window)[0, data[k]]
        want.append(total)
    assert np.allclose(S.score_texts(texts, net), want, atol=1e-3)
    monkeypatch.setattr(S, "BLOCK", 7)  # slices of long texts see beyond their ends
    assert np.allclose(S.score_texts(texts, net), want, atol=1e-3)


def test_training_prefers_the_corpus(spark, tables):
    docs = tables["documents"].limit(300)
    values = S.train(docs)
    rows = docs.select("doc_id", "text").limit(20).collect()
    shuffled = [(r["doc_id"], "".join(np.random.default_rng(r["doc_id"]).permutation(list(r["text"])))) for r in rows]
    plain = {r["doc_id"]: r["per_token"] for r in S.score(docs, values).collect()}
    mixed = {r["doc_id"]: r["per_token"] for r in S.score(frame(spark, shuffled), values).collect()}
    before = {r["doc_id"]: r["per_token"] for r in S.score(docs, S.Network.start().values).collect()}
    assert all(plain[i] > mixed[i] for i in mixed)
    assert np.mean(list(plain.values())) > np.mean(list(before.values())) + 1


def test_lm_cases(spark):
    values = S.train(frame(spark))
    got = S.score(frame(spark), values)
    assert collected(got, "doc_id", "n_tokens") == ordered((i, len((t or "").encode())) for i, t in ROWS)
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[3]["log_likelihood"] == 0 and by_id[3]["per_token"] is None
    assert S.score(frame(spark, []), values).count() == 0
    assert np.array_equal(S.train(frame(spark, [])), S.Network.start().values)


def test_long_texts_are_bundled_as_one(monkeypatch):
    """Wherever slices cut a text, its trigrams are those of the whole."""
    text = "Été, ΟΔΟΣ και İstanbul!  x — 漢字 の\U0001d4d0 12 ab" * 3 + "c"
    space = L.Space(64)
    whole = np.concatenate(list(space.codes(text)))
    assert len(whole) > 60 and whole[0] >> np.uint64(42) == 32 and whole[-1] & np.uint64(0x1FFFFF) == 32
    want = space.bundle([text, None, "", "1 2", "a"])
    for size in (1, 2, 3, 5, 17):
        monkeypatch.setattr(L, "BLOCK_CHARS", size)
        assert np.array_equal(np.concatenate(list(space.codes(text))), whole)
        assert np.array_equal(space.bundle([text, None, "", "1 2", "a"]), want)
    assert not want[1:4].any() and want[4].any()
