"""The corpus pipeline against a plain statement of its stages, and the SQL oracles."""

import hashlib

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from cohortline.llm import mixing, queries, suffix_repetition
from parity import compare, duck
from test_operators import brute_components


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    result = compare(spark, duck(SF_SMALL), name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert result["ok"], result


def test_pipeline_matches_plain_stages(spark):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    judged = suffix_repetition.judge([r["text"] or "" for r in rows.values()], suffix_repetition.MIN_REPEAT).to_pylist()
    left = {}
    for (i, r), j in zip(rows.items(), judged):
        n = j["n_words"]
        if n >= 50 and 2 * j["n_repeat_words"] <= n and j["covered_words"] <= 0.3 * n and j["longest_repeat"] <= 0.2 * n:
            left[i] = r
    last = {}
    for i, r in left.items():
        last[r["text"]] = max(i, last.get(r["text"], -1))
    ids = sorted(last.values())
    components = brute_components([rows[i]["text"] for i in ids])
    ids = [i for k, i in enumerate(ids) if components[k][2]]
    stage4 = corpus_pipeline.source_mix(spark, spark.createDataFrame([rows[i] for i in ids]), SF_SMALL)
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    wanted = sorted(
        (r["doc_id"], b"".join(x.to_bytes(4, "little") for x in library.encode(r["text"], add_special_tokens=False).ids),
         hashlib.sha256(r["text"].encode()).hexdigest()) for r in stage4.collect())
    got = sorted((r["doc_id"], bytes(r["token_ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == wanted and mixing.SEED
