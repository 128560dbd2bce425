"""Directly addressable codes: exact round trips against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hazardpanel.llm import dac
from tests.llm.test_pieces import TEXTS, random_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_round_trip_and_random_access(ids):
    a = np.array(ids, np.uint32)
    d = dac.Dac(dac.pack(a, [7], np.array([len(a)])) + dac.TRAILER)
    assert d.size == len(a) and d.range(0, len(a)).tolist() == ids
    for i in {0, 1, len(a) // 2, len(a) - 1, 511, 512, 513} & set(range(len(a))):
        assert d.access(i) == ids[i]
        assert d.range(i, min(70, len(a) - i)).tolist() == ids[i:i + 70]
    with pytest.raises(IndexError):
        d.access(len(a))


def test_word_cache_equals_the_library():
    t = Tokenizer.from_file(PATH)
    source = TEXTS + random_texts() + [f"a {w}{p} {p}{w} {w}{p}{w}, b" for w in ("word", "Été", "x1", "12", "日本", "don't", "a\nb", "é̂", "²", "w\u3000v")
                                       for p in (".", "!!", "''", '."', "-", "%%%", "'s", "...", "|", "<|endoftext|>")] + ["it's 's 're they're", "a <|endoftext|> b<|endoftext|>c", "x y  z", "1 23 ,, .. a", "end "]
    got = dac.byte_level_encoder(PATH)()(source)
    for s, g, e in zip(source, got, t.encode_batch(source, add_special_tokens=False)):
        assert g.tolist() == e.ids, s


@pytest.mark.parametrize("shard_ids", [50, 1 << 22])
def test_files_hold_all_documents_in_order(spark, tmp_path, shard_ids):
    rows = [(i * 3 % 101, t, "x") for i, t in enumerate(TEXTS + random_texts(60))] + [(None, "null id", "x"), (5, None, "x"), (5, None, "y"), (900, "word " * 60000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    dac.write_tokens(docs, dac.byte_level_encoder(PATH), f"{tmp_path}/t", shard_ids=shard_ids)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in dac.read_tokens(spark, f"{tmp_path}/t").collect()))
    t = Tokenizer.from_file(PATH)
    want = sorted(((d, *(lambda i: (len(i), zlib.crc32(np.array(i, "<u4").tobytes())))(t.encode(x or "", add_special_tokens=False).ids + [0])) for d, x, _ in rows), key=str)
    assert sorted(((d, n, c) for _, d, n, c in got), key=str) == want
    at, last = 0, -1
    for start, d, n, _ in got:
        assert start == at and (-1 if d is None else d) >= last
        at, last = at + n, -1 if d is None else d
    if shard_ids == 50:
        assert len({r.shard for r in dac.read_tokens(spark, f"{tmp_path}/t").collect()}) > 5


def test_empty_table(spark, tmp_path):
    dac.write_tokens(spark.createDataFrame([], "doc_id long, text string"), dac.byte_level_encoder(PATH), f"{tmp_path}/t")
    assert dac.read_tokens(spark, f"{tmp_path}/t").collect() == []
