import re

import pytest
import public_tokenizers as P

import corpus_pipeline as C
from catalogsync.llm import bpe, mixing
from catalogsync.session import stage
from checks.compare import difference, oracle_connection
from llm_cases import near_components


def test_every_stage_on_its_own_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {"raw": docs}
    for name, apply in C.STAGES:
        before, docs = docs, stage(apply(spark, docs, sf_dir), name)
        kept[name] = docs
        if name != "byte_bpe":
            assert docs.columns == columns and not docs.exceptAll(before).where(f"'{name}' <> 'mixing'").count()
    rows = {name: df.collect() for name, df in kept.items()}
    assert {r["doc_id"] for r in rows["language_id"]} == {r["doc_id"] for r in rows["raw"] if re.search(r"[^\W\d_]", r["text"] or "")}
    largest = {}
    for r in rows["language_id"]:
        largest[r["text"]] = max(r["doc_id"], largest.get(r["text"], -1))
    assert {r["doc_id"] for r in rows["exact_dedup"]} == set(largest.values())
    near = near_components({r["doc_id"]: r["text"] for r in rows["exact_dedup"]})
    assert sorted(r["doc_id"] for r in rows["near_dedup"]) == sorted(i for i, (_, c) in near.items() if c == i)
    times = {r["doc_id"]: r["times"] for r in mixing.mix(kept["near_dedup"]).collect()}
    assert sorted(r["doc_id"] for r in rows["mixing"]) == sorted(i for i, n in times.items() for _ in range(n))
    codec = bpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    texts = {r["doc_id"]: r["text"] for r in rows["mixing"]}
    assert all(r["n_tokens"] == len(codec.encode(texts[r["doc_id"]])) // 4 for r in rows["byte_bpe"])
    assert len(rows["byte_bpe"]) == len(rows["mixing"])
    again = C.run(spark, sf_dir)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows["byte_bpe"]))


@pytest.mark.parametrize("name", ["op1_topk_search", "op5_near_dedup", "op8_exact_dedup", "op9_mixing"])
def test_queries_with_an_oracle(spark, sf_dir, name):
    import __spark_entry__ as contract

    assert difference(contract.queries()[name](spark, sf_dir), oracle_connection(sf_dir), contract.oracle_sql()[name]) is None


def test_ten_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
