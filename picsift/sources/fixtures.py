"""Representative inputs derived from the given tables (see FIXTURES.md).

The original pipeline ships no data, so each stage gets an input built with
plain column expressions over ``documents``, ``orders`` and ``embeddings``.
Every derivation uses all rows of its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import bits, vectors
from ..params import DATE_TAGS, LABELS, MAKE_TAG, MODEL_TAG
from .tables import read_table

STAMP = "yyyy:MM:dd HH:mm:ss"
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _case(key: F.Column, values: dict) -> F.Column:
    out = None
    for k, v in values.items():
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(key == k, lit) if out is None else out.when(key == k, lit)
    return out


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file as the scan sees it: path, decode result, decoded size,
    EXIF tag map, content hash, and the label/cluster values of later phases."""
    # hashed before the join: the text itself is never shuffled
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text"), 256).alias("sha256"))
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate")
    d = docs.join(orders, "doc_id", "left")
    i = F.col("doc_id")
    ext = _case(i % 3, {0: ".jpg", 1: ".JPG", 2: ".jpeg"})
    path = F.concat(F.lit("/recovered/"), F.floor(i / 40).cast("string"), F.lit("/IMG_"),
                    F.lpad((i % 40).cast("string"), 4, "0"), ext)
    stamp = F.date_format("o_orderdate", STAMP)
    tag_original = F.when(i % 6 == 0, F.lit(None).cast("string")).when(i % 6 == 1, F.lit("unknown")) \
        .otherwise(F.concat(F.lit(" "), stamp))
    tag_digitized = F.when(i % 12 == 0, stamp)
    tag_make = _case(i % 5, {0: None, 1: "Canon", 2: " Apple ", 3: "unknown", 4: "NIKON CORP/JP"})
    tag_model = _case(i % 4, {0: None, 1: "EOS 5D", 2: "iPhone: 12", 3: "unknown"})
    tags = F.map_filter(
        F.create_map(F.lit(DATE_TAGS[0]), tag_original, F.lit(DATE_TAGS[1]), tag_digitized,
                     F.lit(DATE_TAGS[2]), F.lit(None).cast("string"),
                     F.lit(MAKE_TAG), tag_make, F.lit(MODEL_TAG), tag_model),
        lambda k, v: v.isNotNull())
    label_names = F.array(*[F.lit(x) for x in LABELS])
    return d.select(
        path.alias("path"),
        i.alias("doc_id"),
        (i % 53 != 0).alias("decode_ok"),
        (F.lit(40) + (i * 37) % 400).cast("int").alias("width"),
        (F.lit(40) + (i * 53) % 300).cast("int").alias("height"),
        tags.alias("tags"),
        "sha256",
        F.when(i % 10 == 9, F.lit(None).cast("string"))
         .otherwise(F.element_at(label_names, (i % 13 + 1).cast("int"))).alias("category"),
        F.when(i % 4 == 0, F.lit(-1)).otherwise(F.floor(F.sqrt(i.cast("double")))).cast("int").alias("face_cluster_id"),
    )


_AMP = {0: 0.0, 1: 0.01, 2: 0.012, 3: 0.03}


def vectors_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate input: every embedding plus perturbed copies 1-3 for
    ``vec_id % 4 = 0``; unit vector, 64-bit fingerprint (56 gradient bits), and the
    size/date fields the keeper rule reads."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    v = F.col("vec_id")
    e = e.withColumn("copy", F.explode(F.when(v % 4 == 0, F.array(*[F.lit(k) for k in range(4)]))
                                       .otherwise(F.array(F.lit(0)))))
    c = F.col("copy")
    amp = F.when(c == 1, F.lit(_AMP[1])).when(c == 2, F.lit(_AMP[2])).when(c == 3, F.lit(_AMP[3])) \
        .otherwise(F.lit(_AMP[0]))
    raw = F.transform("embedding", lambda x, j: x.cast("double") + amp * (
        ((j + 1) * 7 + v * 3 + c * 5) % 5 - 2).cast("double"))
    e = e.withColumn("raw", raw).withColumn("asset_id", v * 10 + c)
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("asset_id"), "o_orderdate")
    a = F.col("asset_id")
    return (e.join(orders, "asset_id", "left")
             .select(a, v, c.alias("copy"), "label",
                     vectors.l2_normalize(F.col("raw")).alias("vec"),
                     # 56 gradient bits below the low byte of vec_id (signed: the top bit may
                     # be set); no fingerprint for one in 44
                     F.when(v % 44 != 8, bits.dhash(F.col("raw"), 8, 8)
                            + (v % 256 - F.when(v % 256 >= 128, F.lit(256)).otherwise(F.lit(0))) * F.lit(1 << 56)).alias("phash"),
                     (F.lit(40) + (a * 37) % 400).cast("int").alias("width"),
                     (F.lit(40) + (a * 53) % 300).cast("int").alias("height"),
                     F.when(a % 6 != 0, F.date_format("o_orderdate", ISO)).alias("date_taken")))


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw embeddings as (vec_id, vec array<double>, label)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"), "label")


def label_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label vectors: mean embedding of each label, L2-normalised.

    Element sums are a partial aggregation over (label, position), so no
    label's vectors are ever gathered in one place."""
    e = read_table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = e.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    per_label = means.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("elems"))   # bounded by the dimension
    names = F.array(*[F.lit(x) for x in LABELS])
    return per_label.select(
        F.col("label").cast("int").alias("label_idx"),
        F.try_element_at(names, F.col("label").cast("int") + 1).alias("label"),
        vectors.l2_normalize(F.transform("elems", lambda s: s["m"])).alias("vec"))


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Face detections: copies ``0 .. vec_id % 16`` of every embedding with a
    per-copy perturbation; singleton copies land in an image of their own."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    v = F.col("vec_id")
    e = e.withColumn("copy", F.explode(F.sequence(F.lit(0), (v % 16).cast("int"))))
    c = F.col("copy")
    raw = F.transform("embedding", lambda x, j: x.cast("double") + F.lit(0.02) * (
        ((j + 1) * 7 + v * 3 + c * 5 + (j + 1) * c) % 7 - 3).cast("double"))
    fid = v * 100 + c
    f = e.select(
        fid.alias("face_id"),
        F.when(v % 16 == 0, F.lit(1000000) + v).otherwise(F.floor(v / 3) * 20 + c).cast("long").alias("img"),
        vectors.l2_normalize(raw).alias("vec"),
        ((fid * 13) % 500 - 20.5).alias("x1"),
        ((fid * 7) % 400 - 10.5).alias("y1"),
        ((fid * 37) % 100 / 100.0).alias("conf"),
        (fid % 90).alias("w_off"), (fid % 70).alias("h_off"))
    f = f.select("face_id", "img", "vec", "x1", "y1",
                 (F.col("x1") + F.col("w_off")).alias("x2"), (F.col("y1") + F.col("h_off")).alias("y2"),
                 "conf", F.lit(480).alias("img_w"), F.lit(360).alias("img_h"))
    # at most three detections share an image here, so this window is tiny
    return f.withColumn("face_ord", (F.row_number().over(Window.partitionBy("img").orderBy("face_id")) - 1).cast("int"))
