import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from picsift.llm import variants as V

from helpers import empty_docs, odd_docs, odd_rows, prose

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_counts(rows, shortest=5, occurrences=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= occurrences}


def brute_near(words):
    """Near words of each word, by the words that lack one character."""
    lacking, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1:]
            lacking[less, i].add(w)
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for group in lacking.values():
        for a in group:
            near[a] |= group - {a}
    return near


def brute(n):
    near = brute_near(set(n))
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def grouped(spark, n):
    rows = V.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert len(rows) == len(n)
    return {tuple(r) for r in rows}


def test_query_on_whole_texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = V.op12_variants(spark, SF)
    assert dict(df.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    got = {tuple(r) for r in df.collect()}
    assert got == brute(brute_counts(rows)) and any(r[1] for r in got) and any(r[1] != r[2] and r[1] for r in got)


def test_edits_at_every_place_and_chains_of_forms(spark):
    n = {"colour": 100, "color": 300, "colours": 40, "olour": 3, "colou": 4, "xcolour": 5, "coolour": 6, "cclour": 7, "colxur": 8, "volour": 9,
         "aaaaa": 50, "aaaaaa": 20, "aaaaaaa": 10, "aaaaaaaa": 5, "aabaaa": 3, "baaaaa": 3, "aaaaab": 3, "élève": 9, "eleve": 4, "éléve": 4, "single": 3}
    got = grouped(spark, n)
    assert got == brute(n)
    assert {r[0]: r[2] for r in got}["aaaaaaaa"] == "aaaaa"                 # aaaaaaaa -> aaaaaaa -> aaaaaa -> aaaaa


@given(st.dictionaries(st.text("abé", min_size=5, max_size=9), st.integers(3, 60), min_size=1, max_size=60))
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_dense_vocabularies(spark, n):
    assert grouped(spark, n) == brute(n)


def test_long_words_need_few_levels(spark):
    long = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(30_000))
    n = {long: 9, long[:10] + long[11:]: 4, long[:-1]: 3, long[:20_000] + "é" + long[20_001:]: 3, "x" + long: 3, "short": 3}
    edges, start, levels = V.trie_edges(spark.createDataFrame(list(enumerate(n)), "number long, word string"))
    assert levels < 10
    assert grouped(spark, n) == brute(n)


@pytest.mark.parametrize("clashes", [False, True])
def test_odd_rows(spark, clashes):
    docs = odd_docs(spark, clashes)
    if clashes:
        docs = docs.withColumns({c: F.lit("own") for c in ("word", "n", "node", "pos", "edits", "near", "way")})
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert {tuple(r) for r in V.group_variants(V.word_counts(docs)).collect()} == brute(brute_counts(rows))


def test_empty_tables(spark):
    assert V.group_variants(V.word_counts(empty_docs(spark))).collect() == []
    assert V.group_variants(V.word_counts(spark.createDataFrame([(1, None), (2, ""), (3, "ab cd")], "doc_id long, text string"))).collect() == []


def test_runs_are_cut_between_words_only(monkeypatch):
    text = prose(4, 300) + " É÷x×9 " + "z" * 500 + "-" + prose(5, 50)
    whole = re.findall("[A-Za-zÀ-ÿ]+", text.translate(LOWER))
    monkeypatch.setattr(V, "CUT", 64)
    assert [w for part in V.runs(text) for w in part] == whole


def test_a_common_word_on_a_third_of_the_rows(spark):
    rows = [(i, "popular " * 50 if i % 3 == 0 else f"popularx rare{chr(97 + i % 26)}") for i in range(300)]
    got = {tuple(r) for r in V.group_variants(V.word_counts(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == brute(brute_counts(rows))


def test_prefix_hashes_follow_the_prefix_alone():
    which, t, node = V._prefixes(["abcde", "abxde", "abcde"], 0)
    at = {(int(w), int(i)): int(h) for w, i, h in zip(which, t, node)}
    assert len(at) == 18 and all(at[0, i] == at[2, i] for i in range(6))
    assert [at[0, i] == at[1, i] for i in range(6)] == [True, True, True, False, False, False]
    assert not np.intersect1d(node, V._prefixes(["abcde"], 1)[2]).size
