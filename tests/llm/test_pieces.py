"""SentencePiece operator against the library."""

import hashlib
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from hazardpanel.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a", " a", "a ", "Hello world", "Hello  world \n x", "tab\there", "é è ç", "emoji 😀😀 end", "▁x ▁", "<s> </s> <unk>",
         "\n\n a\n b ", "x y z", "　 wide", "a b", "long" * 500 + " tail", "null\0byte", "日本語 テキスト", "ﬁ ﬀ ①"]


def library_spans(sp, text):
    out = sp.encode(text, return_type="proto")
    return [p.id for p in out.pieces], [(p.begin, p.end) for p in out.pieces]


def random_texts(n=150):
    rng = random.Random(3)
    parts = ["the", "Haus", "été", ".", ",", " ", "  ", "\n", "😀", "▁", "x1", "ABC", "\t", "niño", " "]
    return ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_ids_and_spans_equal_the_library():
    c, sp = P.Codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert c.cuts
    source = TEXTS + random_texts()
    for t, ids, plain in zip(source, c.encode(source), sp.encode(source)):
        assert ids.tolist() == plain, t
        want_ids, want = library_spans(sp, t)
        begin, end = c.spans(t, ids)
        assert want_ids == plain and list(zip(begin.tolist(), end.tolist())) == want, t


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("strip", [True, False])
def test_character_map_equals_the_library(rule, strip):
    norm = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=strip, add_dummy_prefix=True, escape_whitespaces=True)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(norm.serialized_model_proto())
    mine = P.Normaliser(proto.normalizer_spec)
    for t in TEXTS + random_texts():
        want, offsets = norm.normalize(t, with_offsets=True)
        got, source = mine(t.encode())
        assert got.decode() == want, (rule, t)
        assert source[-1] <= len(t.encode()) and (np.diff(source) >= 0).all()
        at = [0]
        for ch in t:
            at.append(at[-1] + len(ch.encode()))
        starts = np.concatenate(([0], np.cumsum([len(ch.encode()) for ch in want]))).astype(int)
        assert [int(source[s]) for s in starts] == [at[o] for o in offsets], (rule, t)


def test_operator(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "null id", "x"), (3, None, "x"), (3, None, None), (77, "word " * 60000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = sorted(((r.id, tuple(r.ids), r.decoded) for r in P.encode(docs, PATH).collect()), key=str)
    want = sorted(((d, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or ""))) for d, t, _ in rows), key=str)
    assert got == want
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(((r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_bytes) for r in P.digests(docs, PATH).collect()), key=str)
    assert got == sorted(((d, len(i), sha(",".join(map(str, i))), sha(x), len((t or "").encode())) for d, t, _ in rows
                          for i in [sp.encode(t or "")] for x in [sp.decode(i)]), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.encode(docs, PATH).collect() == [] and P.digests(docs, PATH).collect() == []


@pytest.mark.parametrize("limit, window", [(2000, 1 << 20), (1 << 20, 64)])
def test_small_caches_and_windows_equal_the_library(monkeypatch, limit, window):
    from hazardpanel.llm import dac, wordcache
    from tokenizers import Tokenizer
    byte_path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(wordcache, "WINDOW", window)
    source = TEXTS + random_texts() + ["wide\u3000 a \u2003b c\u0085 d \xa0e f\u2028 g “q” h", "word, été x  " * 300, "x" * 400 + " y", "", "▁ " * 50 + "a b"]
    c, b = P.Codec(PATH), dac.ByteLevel(byte_path)
    c.words.limit = b.words.limit = limit
    t = Tokenizer.from_file(byte_path)
    for _ in range(2):
        assert [x.tolist() for x in c.encode(source)] == c.sp.encode(source)
        assert [x.tolist() for x in b(source)] == [e.ids for e in t.encode_batch(source, add_special_tokens=False)]
        assert c.words.held <= limit and b.words.held <= limit


def test_memory_of_a_long_text():
    """20 MB of text in one row; a process of its own, as peaks last."""
    code = ("import resource, sys; sys.path.insert(0, '.');"
            "from hazardpanel.llm import pieces; c = pieces.Codec(%r); t = ' '.join('w%%d,' %% (i %% 50021) for i in range(2_700_000));"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; (x,) = c.encode([t]); a, b = c.spans(t, x);"
            "assert b[-1] == len(t) and (a[1:] == b[:-1]).all(); print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)") % PATH
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(done.stdout) < 450_000, done.stdout
