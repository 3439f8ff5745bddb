"""The pipeline, stage by stage, on the smallest tables."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from loomtext.llm import bpe, pii, simhash
from loomtext.llm.common import stored, table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage, as rows."""
    docs = table(spark, SF, "documents")
    columns, out = docs.columns, []
    for name, f in corpus_pipeline.STAGES:
        after = stored(f(spark, docs, SF), name)
        out.append((docs.collect(), after.collect()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        docs = after
    return out


def test_toxicity_only_drops(spark, stages):
    before, after = stages[0]
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before} and {r for r in after} <= set(before)
    assert all(d in kept for d, t in labels.items() if t == 0)


def test_one_of_each_group_stays(spark, stages):
    before, after = stages[1]
    comp = simhash.near_duplicates(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert sorted(r.doc_id for r in after) == sorted({r.component_id for r in comp}) and set(after) <= set(before)


def test_personal_data_is_masked(stages):
    before, after = ({r.doc_id: r.text for r in x} for x in stages[2])
    assert set(before) == set(after)
    changed = [d for d in before if before[d] != after[d]]
    for d in changed:
        for m in re.findall(pii.EMAIL.replace("++", "+"), before[d]):
            assert m not in after[d]
    assert all(before[d] == after[d] for d in before if not re.search("[0-9@]", before[d]))


def test_mix_meets_its_budgets(stages):
    before, after = stages[3]
    size, got = Counter(), Counter()
    for r in before:
        size[r.source] += len(WORD.findall(r.text))
    for r in after:
        got[r.source] += len(WORD.findall(r.text))
    assert abs(sum(got.values()) - 1.5 * sum(size.values())) <= len(size)
    assert all(got[s] <= 2 * size[s] for s in size) and max(Counter(r.doc_id for r in after).values()) <= 2
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id].startswith(r.text) for r in after)


def test_tokens(stages):
    before, after = stages[4]
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert len(before) == len(after)
    for r in after:
        ids = exact.encode_ordinary(r.text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_run_is_its_stages(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.ids_sha256) for r in out.select("doc_id", "ids_sha256").collect()) == sorted((r.doc_id, r.ids_sha256) for r in stages[4][1])


def test_every_operator_has_its_query():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
