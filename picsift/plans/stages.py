"""Stage tables of the curation run over the derived fixtures.

Each function derives one stage from the stages before it; nothing is
updated in place, so any stage can be recomputed or previewed on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.exact import exact_duplicates
from ..operators.scan import scan_status
from ..operators.status import current_images
from ..params import DEFAULT, OK, Params
from ..session import cut_lineage
from ..sources import fixtures


def images(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Phase 1: the images base table (scan decisions) of the assets fixture."""
    return scan_status(fixtures.assets(spark, sf_dir), p, keep=("category", "face_cluster_id"))


def exact(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    return exact_duplicates(images(spark, sf_dir, p))


def current(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Images with statuses after phases 1-2."""
    img = images(spark, sf_dir, p)
    return current_images(img, exact=exact_duplicates(img))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.vectors_table(spark, sf_dir)


def near(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    from ..operators.near import near_duplicates
    return near_duplicates(cut_lineage(vectors(spark, sf_dir)), "asset_id", p)


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.faces(spark, sf_dir)


def face_labels(spark: SparkSession, sf_dir: str, p: Params = DEFAULT, images: DataFrame | None = None) -> DataFrame:
    """DBSCAN over all face vectors, or those of ``images`` (img): ``(face_id, img, face_ord, cluster)``."""
    from ..operators.dbscan import dbscan
    f = faces(spark, sf_dir)
    f = cut_lineage(f if images is None else f.join(images, "img", "left_semi"))    # read by the clustering and by the join below
    lab = dbscan(f, "face_id", "vec", ["img", "face_ord"], p.dbscan_eps, p.dbscan_min_samples, p.block_rows)
    return f.select("face_id", "img", "face_ord").join(lab, "face_id")


def placed(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Phase 5 layout of the survivors of phases 1-2."""
    from ..operators.layout import place_files
    return place_files(cut_lineage(current(spark, sf_dir, p)), p)


def chained(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Images after phases 1-3, each phase working on what the one before kept:
    file ``doc_id`` has the fixture vector of asset ``doc_id // 4 * 40 + doc_id % 4``."""
    from ..operators.near import near_duplicates
    img = scan_status(fixtures.assets(spark, sf_dir), p, keep=("doc_id",))
    cur = cut_lineage(current_images(img, exact=exact_duplicates(img)))
    asset = (F.floor(F.col("doc_id") / 4) * 40 + F.col("doc_id") % 4).alias("asset_id")
    vecs = fixtures.vectors_table(spark, sf_dir).select("asset_id", "vec", "phash")
    ok = cur.filter(F.col("status") == OK).select("path", "width", "height", "date_taken", asset)
    rows = cut_lineage(ok.join(vecs, "asset_id"))
    near = near_duplicates(rows, "asset_id", p).join(rows.select("asset_id", "path"), "asset_id")
    return current_images(cur, near=near)


def labelled(spark: SparkSession, sf_dir: str, p: Params = DEFAULT, every_face: bool = False) -> DataFrame:
    """Images after phases 1-4: the category of a survivor is that of its own vector, scored against the
    label vectors; its person is the cluster of the faces found in it (image ``doc_id`` of the faces fixture).
    Faces are sought in survivors only, so an image that was deleted has no part in a person.  ``every_face``
    clusters the whole fixture and gives deleted images their person too."""
    from ..operators.people import person_clusters
    from ..operators.zeroshot import zero_shot
    cur = cut_lineage(chained(spark, sf_dir, p))
    left = cur.filter(F.col("status") == OK)
    ok = left.select("path", (F.floor(F.col("doc_id") / 4) * 40 + F.col("doc_id") % 4).alias("asset_id"))
    vecs = ok.join(fixtures.vectors_table(spark, sf_dir).select("asset_id", "vec"), "asset_id")
    scored = zero_shot(vecs.select("asset_id", "vec"), fixtures.label_vectors(spark, sf_dir), "asset_id")
    categories = vecs.select("asset_id", "path").join(scored.select("asset_id", "category"), "asset_id").select("path", "category")
    labels = face_labels(spark, sf_dir, p, None if every_face else left.select(F.col("doc_id").alias("img")))
    persons = person_clusters(labels, p).select(F.col("img").alias("doc_id"), F.col("cluster_id").alias("_person"))
    has = F.lit(True) if every_face else F.col("status") == OK
    return (cur.drop("category", "face_cluster_id").join(categories, "path", "left").join(persons, "doc_id", "left")
            .withColumn("face_cluster_id", F.coalesce(F.when(has, F.col("_person")), F.lit(-1)).cast("int")).drop("_person"))


def rerun_layout(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(images, placed): a layout run in which one file in seven is gone and every
    folder already holds an ``IMG_0001``."""
    from ..functions import paths as P
    from ..operators.layout import place_files
    img = scan_status(fixtures.assets(spark, sf_dir), p, keep=("category", "face_cluster_id", "doc_id"))
    cur = cut_lineage(current_images(img, exact=exact_duplicates(img)))
    here = cur.filter(F.col("doc_id") % 7 != 3).select("path")
    tree = F.concat_ws("/", F.lit(p.output_root), F.lit("by_date"), P.date_dir(F.col("date_taken")), P.basename(F.col("path")))
    taken = (cur.filter((F.col("status") == OK) & P.basename(F.col("path")).startswith("IMG_0001."))
                .select(tree.alias("path")).distinct())
    return cur, place_files(cur, p, listing=here, existing=taken)
