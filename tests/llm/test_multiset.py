import hashlib
import random

import pytest

from picsift.llm import multiset
from picsift.llm.multiset import State, state_of

from helpers import empty_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.001"


def test_order_does_not_matter_and_content_does():
    assert state_of("a\nb\nb\nc") == state_of("b\nc\nb\na")
    assert state_of("a\nb\nb") != state_of("a\na\nb") and state_of("a\n\nb") != state_of("a\nb") and state_of("") == State()


def test_insertion_deletion_and_sums():
    rng = random.Random(1)
    for _ in range(20):
        old = [rng.choice("abcdef") * rng.randint(1, 9) for _ in range(rng.randint(0, 600 if _ == 0 else 12))]
        new = [rng.choice("uvwxyz") * rng.randint(1, 9) for _ in range(5)]
        base = State().insert((p, 1) for p in old)
        assert base == state_of("\n".join(old)) or not old
        grown = base.insert((p, 3) for p in new)
        assert grown == State().insert([(p, 1) for p in old] + [(p, 1) for p in new * 3])
        assert grown.delete((p, 3) for p in new) == base
        assert base + State().insert((p, 3) for p in new) == grown
        assert State.from_bytes(grown.to_bytes()) == grown


def test_likeness_follows_the_shared_length():
    rng = random.Random(2)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(80)) for _ in range(60)]
    whole = state_of("\n".join(lines[:40]))
    assert whole.likeness(state_of("\n".join(reversed(lines[:40])))) == 1.0
    assert abs(whole.likeness(state_of("\n".join(lines[20:]))) - 0.5) < 0.12
    assert whole.likeness(state_of("other\ntext")) < 0.12 and whole.likeness(State()) == 0.0 and State().likeness(State()) == 1.0


def wanted(rows):
    rows = sorted(((i is not None, i or 0, t is not None, t or ""), i, t or "") for i, t in rows)
    out = []
    for k, (_, i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][2]
        half = len(t) // 2
        changed = t[:len(t) - half] + after[:half]
        out.append((str(i), len(t), hashlib.sha256(changed.encode()).hexdigest(), state_of(t).fingerprint(), state_of(changed).fingerprint(),
                    state_of(t).likeness(state_of(changed)), state_of(t).likeness(state_of(after))))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_query_against_brute_force(spark, partitions):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert got(multiset.op1_fingerprints(spark, SF)) == wanted(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(spark):
    docs = odd_docs(spark, clashes=True)
    assert got(multiset.edited(docs)) == wanted([r[:2] for r in odd_rows()])
    assert multiset.edited(empty_docs(spark)).count() == 0
    one = spark.createDataFrame([(5, "abcd\nef")], "doc_id long, text string")
    assert got(multiset.edited(one)) == wanted([(5, "abcd\nef")])
    states = multiset.states(docs).collect()
    assert len(states) == len(odd_rows())
    assert all(State.from_bytes(bytes(r.state)).fingerprint() == r.fingerprint for r in states)
