import base64
import codecs
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from picsift.llm import bpe
from picsift.llm.bpe_fst import Codec, Transducer, Utf8Decoder, Vocabulary, stream

from helpers import empty_docs, odd_docs, odd_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
with open(PATH, "rb") as f:
    DATA = f.read()
VOCAB = Vocabulary(DATA)
CODEC = Codec(VOCAB, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, DATA.splitlines())})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="ab \n\t'sl1é日", max_size=80)), min_size=1, max_size=4))
def test_ids_equal_the_reference_library(texts):
    assert [x.tolist() for x in CODEC.encode_batch(texts)] == [REFERENCE.encode_ordinary(t) for t in texts]


def test_whitespace_kinds_and_long_runs():
    texts = ["a\x1cb \x1f", "\x85\x85b  c", "x" * 5000, "ab" * 3000, " " * 700 + "x", "\n\n \n", "'s 'S ’s don't", "a  　b"]
    assert [x.tolist() for x in CODEC.encode_batch(texts)] == [REFERENCE.encode_ordinary(t) for t in texts]


def test_machine_that_forgets_its_states_gives_the_same():
    small = Codec(VOCAB, public_tokenizers.PATTERN)
    small.machine = Transducer(VOCAB, max_states=50)
    for k in range(5):
        t = prose(k, 200)
        assert small.encode(t) == REFERENCE.encode_ordinary(t)


def test_tokens_no_merge_reaches_follow_the_definition():
    odd = Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate([b"a", b"b", b"c", b"abc", b"bc"])))
    c = Codec(odd, r"\S+|\s+")
    own = tiktoken.Encoding("odd", pat_str=r"\S+|\s+", mergeable_ranks=odd.ranks, special_tokens={})
    for t in ("abc", "abcabc", "cbacb", "aabbcc", "bcabc"):
        assert c.encode(t) == own.encode_ordinary(t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50255), max_size=40), st.integers(1, 7))
def test_streaming_decode_equals_the_standard_decoder(ids, block):
    data = b"".join(VOCAB.bytes_of[i] for i in ids)
    want = codecs.getincrementaldecoder("utf-8")("replace").decode(data, True)
    assert "".join(stream(Utf8Decoder(VOCAB), ids, block)) == want


def test_long_texts_are_cut_where_nothing_changes(monkeypatch):
    monkeypatch.setattr(bpe, "CUT", 300)
    text = prose(3, 500) + "\n\n" + "y" * 900 + "  " + prose(4, 100)
    assert len(list(bpe.cut(text, 300))) > 3 and "".join(bpe.cut(text, 300)) == text
    got = bpe.encode_texts(CODEC, [text, None, ""])
    assert [x.tolist() for x in got] == [REFERENCE.encode_ordinary(text), [], []]


def test_operator_on_odd_rows(spark):
    docs = odd_docs(spark, clashes=True)
    rows = bpe.digests(docs, PATH).collect()
    want = sorted((str(r[0]), len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())
                  for r in odd_rows() for x in [REFERENCE.encode_ordinary(r[1] or "")])
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), r[1] or "") for r in odd_rows())
    assert bpe.digests(empty_docs(spark), PATH).count() == 0


def test_vocabulary_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY", 10)
    with pytest.raises(ValueError):
        bpe.encode(empty_docs(spark), PATH)
