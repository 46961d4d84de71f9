"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables through the fixture derivations, so its
work grows with the scale factor.  Column names equal those of the DuckDB
oracle in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import bits
from ..operators import exact as exact_ops
from ..operators import boxes, hamming, infer, near as near_ops, people, reports, scan
from ..operators import layout, ledger, upsert as upsert_ops
from ..operators.similarity import top_k
from ..operators.zeroshot import zero_shot
from ..sources import fixtures
from ..sources.tables import read_table
from ..operators.status import current_images
from ..params import DEFAULT, OK
from ..session import cut_lineage
from . import stages


def q_scan_status(spark: SparkSession, sf: str) -> DataFrame:
    return stages.images(spark, sf).select("path", "status", "width", "height", "sha256")


def q_exif_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return (stages.images(spark, sf).filter(F.col("status") == OK)
            .select("path", "date_taken", "camera_make", "camera_model"))


def q_scan_counters(spark: SparkSession, sf: str) -> DataFrame:
    return scan.scan_counters(stages.images(spark, sf))


def q_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return stages.exact(spark, sf)


def q_exact_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    return exact_ops.exact_dedup_stats(stages.exact(spark, sf))


def q_status_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.status_summary(stages.current(spark, sf))


def q_images_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return reports.images_by_year(stages.current(spark, sf))


def q_category_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.category_distribution(stages.current(spark, sf))


def q_clusters_over_10(spark: SparkSession, sf: str) -> DataFrame:
    return reports.clusters_larger_than(stages.current(spark, sf), 10)


def q_fingerprint_hex(spark: SparkSession, sf: str) -> DataFrame:
    v = stages.vectors(spark, sf)
    hx = bits.to_hex(F.col("phash"))
    return v.select("asset_id", hx.alias("phash_hex"), bits.from_hex(hx).alias("phash_back"))


def q_hamming_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = hamming.hamming_pairs(stages.vectors(spark, sf), "phash", 8)
    return pairs.select(bits.to_hex(F.col("hash_a")).alias("hash_a"), bits.to_hex(F.col("hash_b")).alias("hash_b"),
                        "dist")


def q_candidate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return hamming.candidate_groups(stages.vectors(spark, sf), "asset_id", "phash", 8).select(
        "asset_id", "candidate_group")


def q_near_dups(spark: SparkSession, sf: str) -> DataFrame:
    return stages.near(spark, sf)


def q_near_dup_stats(spark: SparkSession, sf: str) -> DataFrame:
    v = cut_lineage(stages.vectors(spark, sf))
    cand = cut_lineage(hamming.candidate_groups(v, "asset_id", "phash", 8))
    return near_ops.near_dup_stats(cand, near_ops.near_duplicates(v, "asset_id", cand=cand))


def q_near_dup_list(spark: SparkSession, sf: str) -> DataFrame:
    v = stages.vectors(spark, sf).select("asset_id", F.lit(OK).alias("status"))
    cur = current_images(v, near=stages.near(spark, sf), near_key="asset_id")
    return reports.near_dup_paths(cur, "asset_id")


def q_zero_shot(spark: SparkSession, sf: str) -> DataFrame:
    z = zero_shot(fixtures.embedding_vectors(spark, sf), fixtures.label_vectors(spark, sf), "vec_id")
    return z.select("vec_id", "label_idx", "category", F.round("score", 6).alias("score"),
                    F.round("prob", 6).alias("prob"))


def q_topk_similar(spark: SparkSession, sf: str) -> DataFrame:
    e = fixtures.embedding_vectors(spark, sf)
    t = top_k(e, e, "vec_id", "vec", 5, exclude_self=True)
    return t.select("query_id", "rank", "neighbor_id", F.round("sim", 6).alias("sim"))


def q_dbscan_labels(spark: SparkSession, sf: str) -> DataFrame:
    return stages.face_labels(spark, sf).select("face_id", "cluster")


def q_dbscan_min3_labels(spark: SparkSession, sf: str) -> DataFrame:
    """G6 with min_samples = 3: core points, border points, noise."""
    from ..operators.dbscan import dbscan
    f = cut_lineage(stages.faces(spark, sf))
    return dbscan(f, "face_id", "vec", ["img", "face_ord"], 0.4, 3)


def q_person_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return people.person_clusters(stages.face_labels(spark, sf))


def q_cluster_report(spark: SparkSession, sf: str) -> DataFrame:
    return people.cluster_report(stages.face_labels(spark, sf))


def q_box_clip(spark: SparkSession, sf: str) -> DataFrame:
    return boxes.clip_boxes(stages.faces(spark, sf))


def q_layout_paths(spark: SparkSession, sf: str) -> DataFrame:
    return stages.placed(spark, sf).select("path", "year", "month", "new_path")


def q_view_membership(spark: SparkSession, sf: str) -> DataFrame:
    return layout.view_links(stages.placed(spark, sf))


def q_layout_stats(spark: SparkSession, sf: str) -> DataFrame:
    placed = cut_lineage(stages.placed(spark, sf))
    return layout.layout_stats(stages.current(spark, sf), placed, layout.view_links(placed))


def q_regroup(spark: SparkSession, sf: str) -> DataFrame:
    return people.regroup(stages.current(spark, sf), stages.placed(spark, sf))


def q_upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    base = stages.current(spark, sf)
    scan_rows = stages.images(spark, sf)
    cols = ["path", "status", "width", "height", "date_taken", "camera_make", "camera_model", "sha256"]
    rescan = scan_rows.select(*cols, upsert_ops.scan_provided(F.col("status")).alias("provided"))
    incoming = (scan_rows.filter(F.col("category").isNull())
                .select(F.regexp_replace("path", "^/recovered/", "/incoming/").alias("path"), *cols[1:],
                        upsert_ops.scan_provided(F.col("status")).alias("provided")))
    base = base.select(*cols, "category", "face_cluster_id")
    return upsert_ops.upsert(base, rescan.unionByName(incoming))


def q_unscanned(spark: SparkSession, sf: str) -> DataFrame:
    ok = stages.current(spark, sf).filter(F.col("status") == OK)
    done = ok.filter(F.col("date_taken") < "1998")
    return ledger.unprocessed(ok, done).select("path")


def q_cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return people.cluster_sizes(stages.face_labels(spark, sf))


def q_labelled_images(spark: SparkSession, sf: str) -> DataFrame:
    """Q1: every file after phases 1-4, each phase on what the ones before decided."""
    return stages.labelled(spark, sf).select("path", "status", "category", "face_cluster_id")


def q_labelled_views(spark: SparkSession, sf: str) -> DataFrame:
    """The view links of phase 5 over the scored categories and clustered persons."""
    return layout.view_links(cut_lineage(layout.place_files(cut_lineage(stages.labelled(spark, sf, every_face=True)))))


def q_labelled_categories(spark: SparkSession, sf: str) -> DataFrame:
    """A16 over the scored categories."""
    return reports.category_distribution(stages.labelled(spark, sf, every_face=True))


def q_regroup_stats(spark: SparkSession, sf: str) -> DataFrame:
    cur, placed = cut_lineage(stages.current(spark, sf)), cut_lineage(stages.placed(spark, sf))
    return people.regroup_stats(people.regroup(cur, placed), cur, placed)


def q_first_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """L3: the first 100 survivors by path (the ``limit N`` trial run)."""
    return stages.current(spark, sf).filter(F.col("status") == OK).select("path").orderBy("path").limit(100)


def q_pipeline_status(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses after scan, exact and near duplicates, one after the other."""
    return reports.status_summary(stages.chained(spark, sf))


def q_rescan_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A later scan finds four files in five, one in eleven of them corrupt
    by now, and some new ones; rows of files that are gone stay."""
    from ..sources.fixtures import assets
    cols = ["path", "status", "width", "height", "date_taken", "sha256"]
    base = cut_lineage(scan.scan_status(assets(spark, sf), keep=("doc_id",)))
    corrupt = F.when(F.col("doc_id") % 11 == 0, F.lit("deleted_corrupt")).otherwise(F.col("status"))
    found = base.filter(F.col("doc_id") % 5 != 0).withColumn("status", corrupt)
    later = base.filter((F.col("doc_id") % 9 == 0) & (F.col("status") == OK)).withColumn("path", F.regexp_replace("path", "^/recovered/", "/later/"))
    updates = found.unionByName(later).select(*cols, upsert_ops.scan_provided(F.col("status")).alias("provided"))
    return upsert_ops.upsert(base.select(*cols), updates)


def q_rescan_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """A stored images table in buckets; a re-scan of one file in nine, one in eleven of them corrupt by now, and
    of new files, merged into the buckets they fall into."""
    import uuid

    from ..session import ensure_checkpoint_dir
    cols = ["path", "status", "width", "height", "date_taken", "sha256"]
    schema = "path string, status string, width int, height int, date_taken string, sha256 string"
    base = cut_lineage(scan.scan_status(fixtures.assets(spark, sf), keep=("doc_id",)))
    table = f"{ensure_checkpoint_dir(spark)}/images-{uuid.uuid4().hex}"
    upsert_ops.store_bucketed(base.select(*cols), table)
    again = base.filter(F.col("doc_id") % 9 == 0)
    status = F.when(F.col("doc_id") % 11 == 0, F.lit("deleted_corrupt")).otherwise(F.col("status"))
    later = again.filter(F.col("status") == OK).withColumn("path", F.regexp_replace("path", "^/recovered/", "/later/"))
    updates = again.withColumn("status", status).unionByName(later).select(*cols, upsert_ops.scan_provided(F.col("status")).alias("provided"))
    upsert_ops.upsert_stored(updates, table, schema)
    return upsert_ops.read_bucketed(spark, table, schema)


def q_layout_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Placing with names already taken and some files gone."""
    return stages.rerun_layout(spark, sf)[1].select("path", "new_path")


def q_layout_rerun_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A12 with skipped files."""
    cur, placed = stages.rerun_layout(spark, sf)
    placed = cut_lineage(placed)
    return layout.layout_stats(cur, placed, layout.view_links(placed))


def q_layout_chains(spark: SparkSession, sf: str) -> DataFrame:
    """W5, exact path: all survivors in one folder under names that interfere
    with each other's copy numbers (``a``, ``a_2``, ``a_2_2``, ``a_3``, ...)."""
    cur = stages.current(spark, sf)
    name = F.concat(F.element_at(F.array(*map(F.lit, ("a", "a", "a", "a_2", "a_3", "a_2_2", "a_5", "b", "b_2", "a_99999999999999999999"))),
                                 ((F.ascii(F.substring(F.md5("path"), 1, 1)) + 7 * F.ascii(F.substring(F.md5("path"), 2, 1))) % 10 + 1)), F.lit(".jpg"))
    moved = cur.withColumn("path", F.concat(F.col("path"), F.lit("/"), name)).withColumn("date_taken", F.lit("2018-06-01T00:00:00"))
    return layout.place_files(cut_lineage(moved)).select("path", "new_path")


def q_effective_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Where each file is read from when part of the layout was carried out."""
    from ..operators.status import effective_path
    rows = fixtures.assets(spark, sf).select("path", "doc_id", F.when(F.col("doc_id") % 3 != 0, F.concat(
        F.lit("output/by_date/"), F.col("doc_id").cast("string"), F.lit(".jpg"))).alias("new_path"))
    there = rows.filter((F.col("doc_id") % 2 == 0) & F.col("new_path").isNotNull()).select(F.col("new_path").alias("path"))
    return effective_path(rows, there).select("path", "read_path")


def q_scan_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """S8e: paths attempted by an earlier run and by this one."""
    img = scan.scan_status(fixtures.assets(spark, sf), keep=("doc_id",)).filter(F.col("status") == OK)
    return ledger.mark_processed(img.filter(F.col("date_taken") < "1998"), img.filter(F.col("doc_id") % 4 == 1)).select("path")


def q_conform(spark: SparkSession, sf: str) -> DataFrame:
    """An older table without later columns, brought to the declared schema."""
    from ..schema import conform
    old = fixtures.assets(spark, sf).select("path", F.when(F.col("doc_id") % 7 != 0, F.lit("deleted_tiny")).alias("status"),
                                            F.col("width").cast("long").alias("width"))
    return conform(old).select("path", "status", "width", "face_cluster_id", "face_scanned", "new_path")


def q_brightness_status(spark: SparkSession, sf: str) -> DataFrame:
    """Scan decisions with the opt-in pixel check."""
    from ..params import Params
    lum = F.struct(((F.col("doc_id") * 17) % 256).cast("double").alias("mean"), ((F.col("doc_id") * 7) % 40).cast("double").alias("std"))
    return scan.scan_status(fixtures.assets(spark, sf).withColumn("lum", lum), Params(check_brightness=True)).select("path", "status", "width")


def _toy_detector():
    def fn(pdf):
        if (pdf["doc_id"] % 29 == 0).any():
            raise RuntimeError("no image")
        return [[] if i % 5 == 0 else [(-3.7 + i % 7, 2.5, w * 0.5, h + 10.0, 0.9), (5.0, 5.0, 5.5, 9.0, 0.8), (1.0, 1.0, 20.0, 20.0, i % 100 / 100)]
                for i, w, h in zip(pdf["doc_id"].tolist(), pdf["width"].tolist(), pdf["height"].tolist())]
    return fn


def _toy_embedder():
    import numpy as np

    def fn(pdf):
        if (pdf["vec_id"] % 17 == 0).any():
            raise ValueError("bad input")
        return np.array([list(v) for v in pdf["embedding"]], dtype=np.float64)
    return fn


def _detections(spark: SparkSession, sf: str) -> DataFrame:
    return infer.detect(fixtures.assets(spark, sf).select("path", "doc_id", "width", "height"), "path", ["doc_id", "width", "height"],
                        _toy_detector, DEFAULT.face_conf_threshold, 16)


def _embedded(spark: SparkSession, sf: str) -> DataFrame:
    return infer.embed(read_table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", ["vec_id", "embedding"], _toy_embedder, 16)


def q_detections(spark: SparkSession, sf: str) -> DataFrame:
    """A detector in mini-batches, failing images retried alone."""
    return _detections(spark, sf).select("path", "face_ord", "x1", "y1", "x2", "y2", "conf", "error")


def q_embed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """An embedder in mini-batches, unit vectors, failing rows isolated.  ``digest`` weighs every component by its place."""
    weighted = F.transform("vec", lambda x, i: x * (i + 1))
    digest = F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x)
    return _embedded(spark, sf).select("vec_id", F.size("vec").alias("dims"), F.round(F.col("vec")[0], 6).alias("v0"),
                                       F.round(digest, 6).alias("digest"), "error")


def q_inference_counters(spark: SparkSession, sf: str) -> DataFrame:
    """A6."""
    return infer.inference_counters(_detections(spark, sf), _embedded(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_status": q_scan_status,
    "exif_normalize": q_exif_normalize,
    "scan_counters": q_scan_counters,
    "exact_dedup": q_exact_dedup,
    "exact_dedup_stats": q_exact_dedup_stats,
    "status_summary": q_status_summary,
    "images_by_year": q_images_by_year,
    "category_distribution": q_category_distribution,
    "clusters_over_10": q_clusters_over_10,
    "fingerprint_hex": q_fingerprint_hex,
    "hamming_pairs": q_hamming_pairs,
    "candidate_groups": q_candidate_groups,
    "near_dups": q_near_dups,
    "near_dup_stats": q_near_dup_stats,
    "near_dup_list": q_near_dup_list,
    "zero_shot": q_zero_shot,
    "topk_similar": q_topk_similar,
    "dbscan_labels": q_dbscan_labels,
    "dbscan_min3_labels": q_dbscan_min3_labels,
    "person_clusters": q_person_clusters,
    "cluster_report": q_cluster_report,
    "box_clip": q_box_clip,
    "layout_paths": q_layout_paths,
    "view_membership": q_view_membership,
    "layout_stats": q_layout_stats,
    "regroup": q_regroup,
    "upsert_merge": q_upsert_merge,
    "unscanned": q_unscanned,
    "cluster_sizes": q_cluster_sizes,
    "labelled_images": q_labelled_images,
    "labelled_views": q_labelled_views,
    "labelled_categories": q_labelled_categories,
    "regroup_stats": q_regroup_stats,
    "first_survivors": q_first_survivors,
    "pipeline_status": q_pipeline_status,
    "rescan_merge": q_rescan_merge,
    "rescan_buckets": q_rescan_buckets,
    "layout_rerun": q_layout_rerun,
    "layout_rerun_stats": q_layout_rerun_stats,
    "layout_chains": q_layout_chains,
    "effective_paths": q_effective_paths,
    "scan_ledger": q_scan_ledger,
    "conform": q_conform,
    "brightness_status": q_brightness_status,
    "detections": q_detections,
    "embed_vectors": q_embed_vectors,
    "inference_counters": q_inference_counters,
}
