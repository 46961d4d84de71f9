import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import public_tokenizers

from picsift.llm import cutting, packing as P

from helpers import empty_docs, odd_docs, odd_rows, prose

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts, path=PATH):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype=encoder.width).tolist()


def check(pieces, documents, size):
    """Each id in exactly one piece, sequences without holes or padding; ``documents``: Counter of (doc_id, ids)."""
    sequences = defaultdict(list)
    by_doc = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == size or at & (at - 1) == 0 and at < size
    got = Counter()
    for doc_id, rows in by_doc.items():
        copies = defaultdict(list)
        for r in rows:
            copies[r.doc_tokens].append(r)
        for n, those in copies.items():
            assert sum(r.length for r in those) % n == 0
            starts = Counter((i for r in those for i in range(r.start, r.start + r.length)))
            assert set(starts) == set(range(n)) and len(set(starts.values())) == 1
            got[doc_id, n] += starts[0]
    assert got == Counter((d, len(ids)) for d, ids in documents.elements())
    known = defaultdict(set)
    for d, ids in documents:
        known[d, len(ids)].add(tuple(ids))
    for r in pieces:
        part = tuple(np.frombuffer(r.ids, dtype="<u4").tolist())
        assert any(part == ids[r.start:r.start + r.length] for ids in known[r.doc_id, r.doc_tokens])
    return sequences


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = {r.doc_id: np.array([*i, 2], dtype="<u4") for r, i in zip(rows, library([r.text or "" for r in rows]))}
    df = P.op13_packing(spark, SF)
    assert dict(df.dtypes) == {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                               "sequence_id": "bigint", "offset": "bigint"}
    used = Counter()
    for r in df.collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(part.tobytes()) == r.ids_crc32
        used[r.doc_id] += r.length
    assert used == {d: len(i) for d, i in ids.items()}


@pytest.mark.parametrize("size,classes", [(64, 64), (64, 8), (100, 7), (4096, 256)])
def test_odd_rows_in_sequences_of_any_size(spark, size, classes):
    docs = odd_docs(spark, clashes=True).withColumns({c: F.lit(3) for c in ("n", "width", "rank", "start", "pieces", "at")})
    documents = Counter((r[0], (*ids, 2)) for r, ids in zip(odd_rows(), library([r[1] or "" for r in odd_rows()])))
    pieces = P.pack(docs, PATH, size=size, classes=classes).collect()
    sequences = check(pieces, documents, size)
    whole = {r.sequence_id: r.ids for r in P.sequences_of(spark.createDataFrame(pieces)).collect()}
    assert whole == {s: b"".join(r.ids for r in sorted(rows, key=lambda r: r.offset)) for s, rows in sequences.items()}


def test_empty_table_and_empty_texts(spark):
    assert P.pack(empty_docs(spark), PATH).collect() == []
    rows = [(i, None if i % 2 else "") for i in range(7)]
    got = P.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, size=4, classes=4).collect()
    check(got, Counter((i, (2,)) for i, _ in rows), 4)


def test_a_third_of_the_documents_has_one_length(spark):
    rng = random.Random(2)
    rows = [(i, "a " * 30 if i % 3 == 0 else "b " * rng.randint(0, 300)) for i in range(600)]
    ids = library([t for _, t in rows])
    pieces = P.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, size=128, classes=32).collect()
    check(pieces, Counter((r[0], (*i, 2)) for r, i in zip(rows, ids)), 128)
    whole = sum(1 for r in pieces if r.length == min(r.doc_tokens - r.start, 128))
    assert whole > 0.8 * len(pieces)                                            # few documents are cut to fill gaps


@given(st.lists(st.text(st.characters(max_codepoint=0x24f), max_size=40), max_size=5))
@settings(max_examples=100, deadline=None)
def test_encoder_equals_the_library(texts):
    encoder = ENCODER.setdefault("one", P.Encoder(PATH))
    assert [ids_of(encoder, t) for t in texts] == library_of(texts)


ENCODER: dict = {}


def library_of(texts):
    if "library" not in ENCODER:
        from tokenizers import Tokenizer

        ENCODER["library"] = Tokenizer.from_file(PATH)
        ENCODER["library"].encode_special_tokens = True
    return [ENCODER["library"].encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_on_every_character_portions_and_special_strings(monkeypatch):
    encoder = P.Encoder(PATH, remembered=50)
    chars = [chr(c) for c in range(0x2100) if not 0xd800 <= c < 0xe000]
    texts = [f"Ab{c}cD 1{c}2 .{c}' {c}s'{c}" for c in chars] + ["<|endoftext|> it's I'LL", "日本語 é é ﬁ İstanbul ΑΣ ǰ J̌"]
    assert [ids_of(encoder, t) for t in texts] == library_of(texts)
    monkeypatch.setattr(P, "PORTION", 40)
    long = prose(3, 400) + "\n" + "日本" * 50 + " it's" * 30
    assert ids_of(encoder, long) == library_of([long])[0]


def test_another_tokenizer_file_goes_through_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = P.Encoder(path)
    assert not encoder.plain and ids_of(encoder, "Hello  World's\n é") == library(["Hello  World's\n é"], path)[0]


def test_knapsack_and_patterns():
    assert cutting.knapsack(np.array([3, 4]), np.array([0.3, 0.5]), 10)[0] == pytest.approx(1.1)      # 3 + 3 + 4
    rng = random.Random(1)
    demand = {k: rng.randint(1, 40_000 // k ** 2 + 2) for k in range(1, 65)}
    found = cutting.patterns(demand, 64)
    assert all(p.filled <= 64 for p in found)
    used = Counter()
    for p in found:
        for k, n in p.counts.items():
            used[k] += n * p.times
    assert all(used[k] <= n for k, n in demand.items())
    placed, total = sum(k * n for k, n in used.items()), sum(k * n for k, n in demand.items())
    sequences = sum(p.times for p in found)
    assert placed > 0.9 * total and sequences * 64 < 1.01 * placed               # the rest is what rounding leaves
    assert cutting.patterns({}, 64) == [] and cutting.patterns({5: 0}, 64) == []
    assert json.loads(json.dumps([p.times for p in cutting.patterns({64: 3}, 64)])) == [3]
