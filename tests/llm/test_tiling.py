import random

from picsift.llm import tiling

from helpers import CLASHES, empty_docs, odd_docs, prose

SF = "/root/testdata/sf0.001"


def naive_tiles(item, doc, match):
    """Try every pair of places for the longest unmarked match, again and again."""
    match = min(match, len(item))
    used_i, used_d, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and i + n not in used_i and j + n not in used_d):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < match or not n:
            return out
        out.append((i, j, n))
        used_i |= set(range(i, i + n))
        used_d |= set(range(j, j + n))


def test_tiles_equal_the_naive_search():
    rng = random.Random(3)
    for _ in range(150):
        letters = "ab" if rng.random() < 0.4 else "abcde"
        item = [rng.choice(letters) for _ in range(rng.randint(0, 12))]
        doc = [rng.choice(letters) for _ in range(rng.randint(0, 25))]
        match = rng.randint(1, 4)
        assert tiling.tiles(item, doc, match) == naive_tiles(item, doc, match)


def test_registered_query_finds_whole_items(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.coverage for r in tiling.op4_decontamination(spark, SF).collect()}
    held = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert held and held <= got.keys() and all(got[p] == 1.0 for p in held)
    for d, t in docs.items():
        words = tiling.tokens(t)
        for i, x in items.items():
            item = tiling.tokens(x)
            seeds = {tuple(item[k:k + 5]) for k in range(len(item) - 4)}
            if any(tuple(words[k:k + 5]) in seeds for k in range(len(words) - 4)):
                share = sum(n for _, _, n in tiling.tiles(item, words)) / len(item)
                assert ((d, i) in got) == (share >= tiling.COVERAGE)
            else:
                assert (d, i) not in got


def test_reordered_edited_and_quoted_passages(spark):
    item = prose(50, 40)
    w = item.split()
    docs = [(1, prose(1, 60) + " " + " ".join(w[20:] + w[:20]) + " " + prose(2, 60)),      # two halves swapped
            (2, "“" + item.upper() + "”"),                                                   # other case, in quotes
            (3, " ".join(w[:8]) + " " + prose(3, 80)),                                       # a fifth of it
            (4, prose(4, 200)), (5, " ".join(w[:19] + ["zzz"] + w[20:]))]                    # one word replaced
    bench = spark.createDataFrame([(7, item), (8, "short item"), (9, ""), (10, None)], "item_id long, text string")
    rows = tiling.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 7), (2, 7), (5, 7)}
    assert {r.doc_id: r.tiles for r in rows}[1] == 2


def test_items_shorter_than_a_seed(spark):
    bench = spark.createDataFrame([(1, "alpha beta"), (1, "alpha beta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "say Alpha, beta!"), (2, "beta alpha"), (2, "alpha beta")], "doc_id long, text string")
    assert sorted(r.doc_id for r in tiling.contaminated(docs, bench).collect()) == [1, 1, 2, 2]


def test_odd_rows_and_stage(spark, tmp_path):
    item = prose(2, 30)
    spark.createDataFrame([(1, item), (None, prose(77, 30)), (3, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_docs(spark, clashes=True)
    kept = tiling.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and set(CLASHES) <= set(kept.columns)
    rows = kept.collect()
    assert len(rows) == docs.count() - 1 and all(r.text != item for r in rows)      # the one row without id that holds it
    assert tiling.drop_contaminated(spark, empty_docs(spark), str(tmp_path)).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert tiling.contaminated(docs, none).count() == 0


def test_repeated_words_stay_bounded():
    item, doc = ["der"] * 200, ["der"] * 20_000
    assert tiling.tiles(item, doc) == [(0, 0, 200)]


def test_passages_in_scripts_without_spaces_are_found():
    for item in ("天地玄黄宇宙洪荒日月盈昃", "いろはにほへとちりぬるを", "ทุกคนเกิดมามีอิสระ"):
        words = tiling.tokens(item)
        assert words == list(item)
        doc = tiling.tokens(f"古人云「{item}」後文也在此。")
        assert sum(n for _, _, n in tiling.tiles(words, doc)) == len(words)
    assert tiling.tokens("漢、字。ABC漢 한국어 naïve，x") == ["漢", "字", "abc", "漢", "한국어", "naïve", "x"]
