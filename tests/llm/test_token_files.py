import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.queries import op2_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, (1 << 32) - 1)), max_size=300), st.integers(1, 40))
def test_round_trip(values, block):
    ids = np.array(values, np.uint32)
    data = token_files.pack(ids, block)
    assert np.array_equal(token_files.unpack(data), ids)
    for start, stop in ((0, 1), (3, 17), (len(ids) // 2, len(ids)), (len(ids), len(ids) + 5)):
        assert np.array_equal(token_files.unpack(data, start, stop), ids[start:stop])


def test_outliers_do_not_widen_a_block():
    ids = np.arange(1024, dtype=np.uint32) % 16
    ids[7] = 4_000_000_000
    assert len(token_files.pack(ids)) < 1024 * 4 / 8 + 64


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \t\n\xa0\u2003ab'sZ1,.東ü<|endoftext|>", max_size=60))
def test_pieces_encode_as_the_whole(text):
    encoder = test_pieces_encode_as_the_whole.encoder
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == whole


test_pieces_encode_as_the_whole.encoder = token_files.Encoder(PATH)


def expected(rows, tokenizer):
    at, found = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END]
        found.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return found


def test_query(spark, sf_dir, corpus, tokenizer):
    rows = sorted((r["doc_id"], r["text"]) for r in corpus.collect())
    found = sorted(tuple(r) for r in op2_token_files(spark, sf_dir).collect())
    assert found == expected(rows, tokenizer)


def test_odd_rows(spark, odd, none, folder, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 500)
    token_files.write_ids(odd, PATH, f"{folder}/odd", parts=3)
    found = token_files.read_ids(spark, f"{folder}/odd").orderBy("start").collect()
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in found]
    # A null text and an empty one have equal ids, so their order among null ids does not show.
    assert got == expected(rows, tokenizer)
    token_files.write_ids(none, PATH, f"{folder}/none", parts=3)
    assert token_files.read_ids(spark, f"{folder}/none").count() == 0
