import numpy as np
import pytest
from brute import components, contamination, fingerprint, sha, without_repeats

import corpus_pipeline as cp
from chronodim.llm.common import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in cp.STAGES:
        after = stage(f(spark, docs, SF), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return sorted(df.collect(), key=lambda r: r.doc_id)


def test_columns(steps):
    assert all(a.columns == b.columns for a, b in steps[:-1])


def test_quality_stage(spark, steps):
    kept = {r.doc_id for r in rows(steps[0][1])}
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert np.mean([(i in kept) == bool(q) for i, q in y.items()]) > 0.97


def test_near_duplicate_stage(steps):
    before, after = map(rows, steps[1])
    comp = components([fingerprint(d.text) for d in before], lambda a, b: (a ^ b).bit_count() <= 2)
    assert after == [before[i] for i in sorted(set(comp))]


def test_suffix_stage(steps):
    before, after = map(rows, steps[2])
    want = without_repeats([d.text for d in before])
    assert [d.doc_id for d in after] == [d.doc_id for d in before]
    assert [d.text for d in after] == [w[3].decode("utf-8", "ignore") for w in want]
    assert all(d.n_chars == len(d.text) for d in after)


def test_decontamination_stage(spark, steps):
    before, after = map(rows, steps[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = contamination([d.text for d in before], items)
    assert after == [d for d, b in zip(before, bad, strict=True) if not b[4]]


def test_encoding_stage(steps):
    from tokenizers import Tokenizer

    from chronodim.llm import bpe

    library = Tokenizer.from_file(bpe.default_path())
    before, after = map(rows, steps[4])
    assert [d.doc_id for d in after] == [d.doc_id for d in before]
    for d, r in zip(before, after, strict=True):
        ids = np.array(library.encode(d.text, add_special_tokens=False).ids, "<u4")
        assert (bytes(r.ids), r.n_tokens, r.decoded_sha256) == (ids.tobytes(), len(ids), sha(d.text.encode()))


def test_run_is_the_stages(spark, steps):
    got = {(r.doc_id, r.ids_sha256) for r in cp.run(spark, SF).collect()}
    assert got == {(r.doc_id, r.ids_sha256) for r in rows(steps[4][1])}


def test_empty_corpus(spark, steps):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, f in cp.STAGES:
        docs = stage(f(spark, docs, SF), f"empty-{name}")
    assert docs.count() == 0
