import random

import numpy as np
import pytest
from brute import SF, sha
from tokenizers import Tokenizer

from chronodim.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in bpe.query(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False).encode())


@pytest.mark.parametrize("parts", [
    ["a", "b", "'s", "'re", "'", " ", "  ", "\n", "é", "漢字", "1", "12", "...", " ", "<|endoftext|>", " ", "x" * 40, "ß", "'ll", "\t", "🙂", "\x85", "\x1c"],
    ["a", "b", "'s", "'re", "漢字", "1", "...", "x" * 40, "ß", "\n\n\n", "　", "\n \n"],
])
def test_joins_of_any_text(library, parts, monkeypatch):
    codec, rng = bpe.Codec(bpe.default_path()), random.Random(len(parts))
    for n in range(150):
        monkeypatch.setattr(bpe, "MAX_CHUNK", rng.choice([8, 40, 300, 700]))
        t = "".join(rng.choice(parts) for _ in range(rng.choice([5, 60, 400, 1500])))
        ids, decoded = bpe.encode_batch(codec, [t.encode()])[0]
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("letters, between, stop", [("абвгдежз", " ", "."), ("漢字文本学校電話", "，", "。"), ("漢字文本学校電話", "", ""), ("אבגדה", " ", "."), ("éèàüñ", " ", ",")])
def test_second_encoding_of_any_script_reuses(library, letters, between, stop):
    codec, rng = bpe.Codec(bpe.default_path()), random.Random(7)
    t = "".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) + rng.choice([between, between, stop + between]) for _ in range(5000))
    ids = bpe.encode_batch(codec, [t.encode()])[0][0]
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    first = codec.encoded
    bpe.encode_batch(codec, [t.encode()])
    assert codec.encoded == first == len(t.encode())
    if between:  # elsewhere too
        more = "head. " + t + " tail"
        assert np.frombuffer(bpe.encode_batch(codec, [more.encode()])[0][0], "<u4").tolist() == library.encode(more, add_special_tokens=False).ids
        assert codec.encoded - first < 0.1 * first


def test_cuts_beside_any_white_space(library):
    codec, rng = bpe.Codec(bpe.default_path()), random.Random(11)
    parts = [" ", " ", "  ", "\u00a0", "\u3000", "\u2003", "\u2028", "\u1680", "\u0085", "é", "ж", "漢", "。", "，", "'", "s", "\u4dc5", "\u9fff", "e\u0301", "🙂", "١", "3", "\ufeff", "\u180e"]
    for _ in range(300):
        t = "".join(rng.choice(parts) for _ in range(700))
        assert np.frombuffer(bpe.encode_batch(codec, [t.encode()])[0][0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_other_files(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    other, codec = Tokenizer.from_file(path), bpe.Codec(path)
    rows = [(i, t) for i, t in enumerate(["Hello there, World 123's", "", "日本語 текст\n\n  x", "a " * 500])]
    for r in bpe.bpe(spark.createDataFrame(rows, "__row long, text string"), path).collect():
        ids = other.encode(rows[r["row"]["__row"]][1], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded.decode() == other.decode(ids, skip_special_tokens=False)
    assert not codec.plain


def test_shared_passages_are_encoded_once():
    codec, rng = bpe.Codec(bpe.default_path()), random.Random(2)
    passage = " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(800)).encode()
    bpe.encode_batch(codec, [passage])
    first = codec.encoded
    bpe.encode_batch(codec, [b"another head " + passage + b" another tail"])
    assert first == len(passage) and codec.encoded <= first + len(passage) // 10


def test_edges(spark, library):
    big = "漢" * 20000
    rows = [(1, None, "x"), (2, "", "x"), (None, "a", "y"), (4, "a", "y"), (4, "a", "y"), (5, big, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.bpe(df, bpe.default_path()).collect()
    assert len(out) == len(rows)
    by = {(r["row"].doc_id, r["row"].ids): r for r in out}
    assert by[1, "x"].ids == b"" and by[2, "x"].decoded == b""
    assert np.frombuffer(by[5, "z"].ids, "<u4").tolist() == library.encode(big, add_special_tokens=False).ids
    assert bpe.bpe(df.limit(0), bpe.default_path()).count() == 0
    assert bpe.bpe(df.select("text"), bpe.default_path()).count() == len(rows)
