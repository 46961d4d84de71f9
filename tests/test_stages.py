"""Keeper rules, layout numbering, upsert, ranking and the driver contract."""

import os
import random

from pyspark.sql import functions as F

from picsift.operators.exact import exact_duplicates
from picsift.operators.layout import place_files, view_links
from picsift.operators.near import near_duplicates
from picsift.operators.ranking import global_index, rank_within
from picsift.operators.upsert import upsert
from picsift.params import Params

IMG = "path string, status string, sha256 string, width int, height int, date_taken string"


def test_exact_keeper_null_date_last(spark):
    rows = [("/a", "ok", "h1", 10, 10, None), ("/b", "ok", "h1", 10, 10, "2019-01-01T00:00:00"),
            ("/c", "ok", "h2", None, 10, "2000"), ("/d", "ok", "h2", 1, 1, None),
            ("/e", "ok", "h3", 5, 5, "x"), ("/f", "ok", "h3", 5, 5, "x"),        # full tie -> smaller path
            ("/g", "deleted_tiny", "h1", 99, 99, None), ("/h", "ok", None, 9, 9, None)]
    df = spark.createDataFrame(rows, IMG)
    got = {r.path: (r.keeper_path, r.is_keeper) for r in exact_duplicates(df).collect()}
    assert got == {"/a": ("/b", False), "/b": ("/b", True), "/c": ("/d", False), "/d": ("/d", True),
                   "/e": ("/e", True), "/f": ("/e", False)}


def test_near_keeper_null_date_first(spark):
    v = [1.0, 0.0]
    rows = [(1, 5, v, 10, 10, "2019"), (2, 5, v, 10, 10, None), (3, 5, v, 5, 5, None)]
    df = spark.createDataFrame(rows, "asset_id long, phash long, vec array<double>, width int, height int, date_taken string")
    got = {r.asset_id: r.keeper for r in near_duplicates(df, "asset_id").collect()}
    assert got == {1: 2, 2: 2, 3: 2}


def _check_names(wanted, got, existing=()):
    """Every file has the first name that was free when its turn came."""
    taken = set(existing)
    for want, name in zip(wanted, got, strict=True):
        assert name not in taken
        if want in taken:
            stem, suffix = os.path.splitext(want)
            assert name.startswith(f"{stem}_") and name.endswith(suffix)
            number = int(name[len(stem) + 1:len(name) - len(suffix)])
            assert number >= 2 and taken.issuperset(f"{stem}_{k}{suffix}" for k in range(2, number))
        else:
            assert name == want
        taken.add(name)


def _layout(spark, names, existing=None):
    rows = [(f"/src/{i:05d}/{n}", "ok", "2018-06-01T00:00:00") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "path string, status string, date_taken string")
    ex = None if existing is None else spark.createDataFrame([(e,) for e in existing], "path string")
    got = place_files(df, Params(output_root="out"), existing=ex).collect()
    by = {r.path: r.new_path.split("/")[-1] for r in got}
    return [by[f"/src/{i:05d}/{n}"] for i, n in enumerate(names)]


def test_layout_numbering_matches_sequential(spark):
    assert _layout(spark, ["a.jpg", "a.jpg", "a_2.jpg", "b.jpg"]) == ["a.jpg", "a_2.jpg", "a_2_2.jpg", "b.jpg"]
    assert _layout(spark, ["a.JPG", "a.jpg"]) == ["a.JPG", "a.jpg"]
    assert _layout(spark, ["a.jpg", "a.jpg"], existing=["out/by_date/2018/06/a.jpg"]) == ["a_2.jpg", "a_3.jpg"]
    long = "a_99999999999999999999.jpg"           # no copy number: it interferes with nothing
    assert _layout(spark, ["a.jpg", "a.jpg", "a_2.jpg", long, long]) == ["a.jpg", "a_2.jpg", "a_2_2.jpg", long, "a_99999999999999999999_2.jpg"]
    rnd = random.Random(9)
    pool = ["a.jpg", "a_2.jpg", "a_3.jpg", "a_2_2.jpg", "b.jpg", "b_2.jpg", "c.JPG", "c.jpg", "d"]
    for _ in range(3):
        names = [rnd.choice(pool) for _ in range(40)]
        _check_names(names, _layout(spark, names))


def test_view_links_first_wins(spark):
    rows = [("/x/1/a.jpg", "out/by_date/2018/06/a.jpg", "food", "Canon", None, 3),
            ("/x/2/a.jpg", "out/by_date/2019/01/a.jpg", "food", "Canon", None, -1)]
    df = spark.createDataFrame(rows, "path string, new_path string, category string, camera_make string, "
                                     "camera_model string, face_cluster_id int")
    got = {(r.view, r.link, r.path) for r in view_links(df, Params(output_root="out")).collect()}
    assert got == {("by_category", "out/by_category/food/a.jpg", "/x/1/a.jpg"),
                   ("by_camera", "out/by_camera/Canon/a.jpg", "/x/1/a.jpg"),
                   ("by_person", "out/by_person/person_0003/a.jpg", "/x/1/a.jpg")}


def test_rank_within_hot_key(spark):
    rows = [("hot", f"p{i:05d}") for i in range(3000)] + [(f"k{i % 50}", f"q{i:05d}") for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o string")
    got = {(r.k, r.o): r.rn for r in rank_within(df, ["k"], ["o"], partitions=6).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        for i, o in enumerate(sorted(o for kk, o in rows if kk == k), 1):
            want[(k, o)] = i
    assert got == want


def test_global_index(spark):
    df = spark.createDataFrame([(x,) for x in random.Random(1).sample(range(10000), 700)], "v long")
    got = sorted((r.idx, r.v) for r in global_index(df, ["v"], partitions=5).collect())
    assert [i for i, _ in got] == list(range(700)) and [v for _, v in got] == sorted(v for _, v in got)


def test_upsert_provided_columns(spark):
    base = spark.createDataFrame([("/a", "ok", 10, "food", 3), ("/b", "ok", 20, None, -1)],
                                 "path string, status string, width int, category string, face_cluster_id int")
    upd = spark.createDataFrame([("/a", "deleted_corrupt", None, ["status"]),
                                 ("/b", "ok", None, ["status", "width"]),
                                 ("/c", "deleted_tiny", 30, ["status", "width"])],
                                "path string, status string, width int, provided array<string>")
    got = {r.path: tuple(r)[1:] for r in upsert(base, upd).collect()}
    assert got == {"/a": ("deleted_corrupt", 10, "food", 3), "/b": ("ok", None, None, -1),
                   "/c": ("deleted_tiny", 30, None, -1)}


def test_driver_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["path", "sha256", "keeper_path", "is_keeper"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_layout_numbering_adversarial(spark):
    """Deep chains, interfering originals and existing files vs the sequential rule."""
    rnd = random.Random(17)
    pool = ["a.jpg"] * 6 + ["a_2.jpg", "a_3.jpg", "a_4.jpg", "a_2_2.jpg", "a_2_3.jpg", "a_3_2.jpg",
                            "a_2_2_2.jpg", "a_10.jpg", "a_1.jpg", "a_02.jpg", "b.jpg", "b_2.jpg"]
    for trial in range(4):
        names = [rnd.choice(pool) for _ in range(60)]
        existing = rnd.sample(["a.jpg", "a_2.jpg", "a_5.jpg", "a_2_2.jpg", "b_3.jpg"], trial)
        ex_paths = [f"out/by_date/2018/06/{e}" for e in existing]
        _check_names(names, _layout(spark, names, existing=ex_paths if existing else None), existing)


def test_layout_hot_name_with_interferers(spark):
    names = ["a.jpg"] * 400 + ["a_5.jpg", "a_150.jpg", "a_2.jpg", "a_399.jpg"]
    random.Random(2).shuffle(names)
    _check_names(names, _layout(spark, names))


def test_layout_numbering_at_sf01_matches_window(spark):
    """The sf0.1 assets put hundreds of same-named files into one folder; the
    ranked frame feeds several branches of one plan.  Every destination must
    equal a plain window numbering (no clashing families exist there)."""
    from pyspark.sql import Window
    from picsift.functions import paths as P
    from picsift.plans import stages
    placed = stages.placed(spark, "/root/testdata/sf0.1")
    name = P.basename(F.col("path"))
    w = Window.partitionBy("dst_dir", "_n").orderBy("path")
    want = (placed.select("path", "dst_dir", name.alias("_n"))
                  .withColumn("rn", F.row_number().over(w))
                  .select("path", F.concat_ws("/", "dst_dir", F.when(F.col("rn") == 1, F.col("_n")).otherwise(
                      F.concat(P.stem(F.col("_n")), F.lit("_"), F.col("rn").cast("string"), P.suffix(F.col("_n")))))
                          .alias("new_path")))
    got = placed.select("path", "new_path")
    assert got.count() == want.count() == 8631
    assert got.exceptAll(want).count() == 0


def test_layout_chains_query_gives_the_first_free_names(spark):
    from picsift.plans.catalog import QUERIES
    rows = sorted(tuple(r) for r in QUERIES["layout_chains"](spark, "/root/testdata/sf0.001").collect())
    assert len({n for _, n in rows}) == len(rows) > 100
    _check_names([p.rsplit("/", 1)[1] for p, _ in rows], [n.rsplit("/", 1)[1] for _, n in rows])


def test_layout_rerun_stats_counts_every_link(spark):
    from picsift.plans import catalog, stages
    sf = "/root/testdata/sf0.001"
    rows = stages.rerun_layout(spark, sf)[1].collect()
    want = set()
    for r in rows:
        name = r.new_path.rsplit("/", 1)[-1]
        want |= {("category", r.category or "uncategorized", name), ("camera", r.camera_make, r.camera_model, name)}
        if r.face_cluster_id is not None and r.face_cluster_id >= 0:
            want.add(("person", r.face_cluster_id, name))
    got = catalog.q_layout_rerun_stats(spark, sf).first()
    assert got.links == len(want) > 0 and got.moved == len(rows)


def test_persons_come_from_survivors_only(spark, tmp_path):
    """Deleted images have no person and don't count towards a cluster's size: of 16 images of one person all but a
    few are exact copies of one, of 15 images of another one is corrupt."""
    import datetime

    import numpy as np

    from picsift.plans import stages
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(48, 64))
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    tables = {
        "embeddings": ([(v, vecs[v].tolist(), v % 10) for v in range(48)], "vec_id long, embedding array<float>, label int"),
        "documents": ([(d, "same" if 100 <= d < 110 else f"text {d}") for d in range(100, 220)], "doc_id long, text string"),
        "orders": ([(d, datetime.datetime(2018, 1, 1 + d % 28)) for d in range(100, 220)], "o_orderkey long, o_orderdate timestamp")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.doc_id: r for r in stages.labelled(spark, str(tmp_path)).collect()}
    assert len(got) == 120
    assert all(r.face_cluster_id == -1 for r in got.values() if r.status != "ok")
    few = [d for d in range(100, 116) if got[d].status == "ok"]         # faces of vector 15
    assert 0 < len(few) < 10 and all(got[d].face_cluster_id == -1 for d in few)
    many = [d for d in range(200, 215) if got[d].status == "ok"]        # faces of vector 30
    assert 10 <= len(many) < 15 and got[212].status == "deleted_corrupt"
    assert len({got[d].face_cluster_id for d in many}) == 1 and got[many[0]].face_cluster_id >= 0
