import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from picsift.llm import simhash

from helpers import DOCS, empty_docs, odd_docs, odd_rows, prose

SF = "/root/testdata/sf0.001"


def naive(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    lines = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Component of each fingerprint by breadth-first search over all pairs."""
    left, out = set(prints), {}
    while left:
        front = [left.pop()]
        seen = set(front)
        while front:
            a = front.pop()
            near = {b for b in left if (a ^ b).bit_count() <= 4}
            left -= near
            seen |= near
            front += near
        for x in seen:
            out[x] = min(seen)
    return out


def check(rows, texts):
    prints = [naive(t) for _, t in texts]
    group = grouped(prints)
    least = {}
    for (i, _), p in zip(texts, prints):
        if i is not None:
            least[group[p]] = min(least.get(group[p], i), i)
    want = sorted((str(i), f"{p:016x}", str(least.get(group[p]))) for (i, _), p in zip(texts, prints))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def test_registered_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(simhash.op6_simhash(spark, SF).collect(), [tuple(r) for r in docs])


def test_odd_rows_and_empty_table(spark):
    check(simhash.near_duplicates(odd_docs(spark, clashes=True)).collect(), [r[:2] for r in odd_rows()])
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("hot,block", [(256, 2048), (1, 3), (4, 2)])
def test_links_of_planted_fingerprints(spark, hot, block):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(12):
            x = base
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(sorted(values))]
    rows = simhash.components(spark.createDataFrame(signed, "doc_id long, fp long"), hot=hot, block=block).collect()
    group = grouped(values)
    least = {}
    for i, v in signed:
        g = group[v % (1 << 64)]
        least[g] = min(least.get(g, i), i)
    assert {r.fp % (1 << 64): r.component_id for r in rows} == {v: least[group[v]] for v in values}
    if hot == 256:      # each pair that is near is fetched, and from each segment once at most
        pairs = [(r.src % (1 << 64), r.dst % (1 << 64)) for r in simhash.links(spark.createDataFrame(signed, "doc_id long, fp long")).collect()]
        near = {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
        assert {frozenset(p) for p in pairs} == near and len(pairs) <= 2 * len(near)


def test_text_cut_in_portions_has_the_same_fingerprint(monkeypatch):
    text = prose(8, 700)
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CUT", 64)
    assert simhash.fingerprint(text) == want
    assert want % (1 << 64) == naive(text)


def test_stage_keeps_one_of_each_group(spark):
    docs = odd_docs(spark, clashes=True)
    kept = simhash.keep_one(spark, docs, "").collect()
    assert kept and kept[0].asDict().keys() == set(docs.columns)
    prints = [(r[0], naive(r[1])) for r in odd_rows()]
    group = grouped([p for _, p in prints])
    least = {}
    for i, p in prints:
        g = group[p]
        least[g] = i if least.get(g) is None else min(least[g], i if i is not None else least[g])
    assert sorted((str(r.doc_id), group[naive(r.text)]) for r in kept) == sorted((str(i), g) for g, i in least.items())
    assert simhash.keep_one(spark, empty_docs(spark), "").count() == 0


def test_stage_with_one_id_in_two_groups(spark):
    rows = [(1, prose(1, 50), "en", "s", 1), (1, prose(2, 50), "en", "s", 1), (1, prose(2, 50), "en", "s", 1), (2, prose(1, 50), "en", "s", 1)]
    kept = simhash.keep_one(spark, spark.createDataFrame(rows, DOCS), "").select("doc_id", F.md5("text")).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {1}
