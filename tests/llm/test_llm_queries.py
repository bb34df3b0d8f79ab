"""Queries against their SQL over whole tables, and the pipeline stage by stage."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry_module  # noqa: E402
from pagetally.llm import bpe, simhash, substring_dedup, toxicity  # noqa: E402
from pagetally.llm.queries import PATTERN, QUERIES, VOCABULARY, table  # noqa: E402
from pagetally.llm.queries_sql import ORACLE  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = duck.sql(ORACLE[name]).df()
    assert columns == sorted(want.columns)
    rows = lambda frame: sorted(map(repr, frame[columns].values.tolist()))
    assert rows(got.toPandas()) == rows(want)


def test_queries_are_registered():
    names = set(entry_module.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


CONTRACTS = {
    "op1_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op2_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op4_maxent": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op7_nn_descent": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op8_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op9_quality_fm": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op11_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op13_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_query_keeps_its_contract(spark, name):
    got = QUERIES[name](spark, SMALL)
    want = dict(pair.rsplit(" ", 1) for pair in CONTRACTS[name].split(", "))
    assert want.items() <= dict(got.dtypes).items()
    if name == "op11_collocations":
        assert got.count() > 0
    elif name == "op13_conversation_repair":
        assert got.count() == table(spark, SMALL, "conversations").select("conv_id").distinct().count()
    else:
        source = "embeddings" if "vec_id" in want else "documents"
        assert got.count() == table(spark, SMALL, source).count()


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, found = table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        found[name] = docs, after
        docs = after
    return found


def test_stages_return_the_columns_of_documents(spark, stages):
    want = table(spark, SMALL, "documents").dtypes
    for name, (before, after) in stages.items():
        assert before.dtypes == want
        if name != "byte_bpe":
            assert after.dtypes == want


def test_toxic_stage_drops_what_the_chain_rejects(spark, stages):
    before, after = stages["toxicity"]
    chain = toxicity.fit_labels(before, table(spark, SMALL, "labels"))
    want = toxicity.score(before, chain).where("not rejected").select(before.columns)
    assert Counter(map(tuple, after.collect())) == Counter(map(tuple, want.collect()))


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after = stages["simhash_near_dedup"]
    rows = sorted(map(tuple, before.collect()))
    prints = np.array([simhash.fingerprint(r[1]) for r in rows], np.uint64)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= corpus_pipeline.RADIUS):
            a, b = root(i), root(i + 1 + int(j))
            label[max(a, b)] = min(a, b)
    assert sorted(map(tuple, after.collect())) == [r for i, r in enumerate(rows) if root(i) == i]
    assert after.count() < len(rows)


def test_repeated_passages_are_cut(stages):
    before, after = stages["substring_dedup"]
    left = {r.doc_id: r for r in substring_dedup.dedup(before, corpus_pipeline.WINDOW).collect()}
    for r in after.collect():
        whole = left[r.doc_id]
        assert r.text == (whole.kept_text if whole.n_removed else whole.text)
        assert r.n_chars == (len(r.text) if whole.n_removed else whole.n_chars)
    assert after.count() == before.count() and any(r.n_removed for r in left.values())


def test_mixing_keeps_every_document_at_least_once(stages):
    before, after = stages["mixing"]
    once, taken = Counter(map(tuple, before.collect())), Counter(map(tuple, after.collect()))
    assert set(once) == set(taken)
    assert all(n <= taken[r] <= 2 * n for r, n in once.items())


def test_every_row_is_encoded(stages):
    before, after = stages["byte_bpe"]
    ranks = bpe.load_ranks(VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((r.doc_id, np.array(library.encode_ordinary(r.text), "<u4").tobytes()) for r in before.collect())
    assert Counter((r.doc_id, bytes(r.ids)) for r in after.collect()) == want


def test_run_chains_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL).select("doc_id", "ids_sha256")
    want = stages["byte_bpe"][1].select("doc_id", "ids_sha256")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_stages_take_odd_documents(spark, odd, odd_rows, none):
    for docs, n in ((odd, len(odd_rows)), (none, 0)):
        for name, stage in corpus_pipeline.STAGES:
            after = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
            if name != "byte_bpe":
                assert after.columns == docs.columns and [t for _, t in after.dtypes] == [t for _, t in docs.dtypes]
            if name in ("toxicity", "substring_dedup", "byte_bpe"):
                assert after.count() == n
