"""The curation run over real files (Q1-Q5).

Every phase is a pure function from stage tables to a decision table;
writing it (``apply``) is a separate step, so a dry run is simply "compute,
do not write" (Q3): the tables that a phase decides are handed to the later phases unwritten
(``Preview``).  Counters are observed on the rows as they are written, by the same job (A3-A6, A12).  Re-running a phase loses nothing (Q4): a re-scan is merged into the
``images`` table by path, so files that are gone keep their row; images that can no longer be
scored keep their category; files that were moved to their place keep it.  A limited trial
run of phase 3 writes under ``<tables_dir>/trial`` and leaves the full tables alone.
Stage tables live as Parquet under ``tables_dir``:

    images        phase 1 scan decisions (path, status, size, date, camera, sha256)
    exact_dups    phase 2 (path, sha256, keeper_path, is_keeper)
    fingerprints  phase 3 (path, phash)
    embeddings    phase 3 (path, vec, error)
    near_dups     phase 3 (path, candidate_group, near_group, keeper, is_keeper)
    categories    phase 4 (path, category, score)
    faces         phase 4 (path, face_ord, box, vec)
    face_clusters phase 4 (path, face_cluster_id)
    face_run      phase 4 (counters of the run: detector errors, images with faces, ...)
    layout        phase 5 (path, year, month, dst_dir, new_path)
    links         phase 5 (view, key, link, path, target)
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.bits import dhash
from ..operators import infer, layout, people
from ..operators.dbscan import dbscan
from ..operators.exact import exact_duplicates
from ..operators.near import near_duplicates
from ..operators.ranking import global_index
from ..operators.scan import scan_status, scan_totals
from ..operators.prefilter import keep_probable
from ..operators.status import current_images, effective_path
from ..operators.upsert import scan_provided, upsert
from ..operators.zeroshot import zero_shot
from ..operators.ledger import mark_processed, unprocessed
from ..params import DEFAULT, OK, Params
from ..schema import IMAGES, conform
from ..session import cut_lineage
from ..sources import files


@dataclass
class Models:
    """User-supplied model functions (see ``operators.infer``)."""
    make_image_embedder: infer.EmbedderFactory | None = None
    label_vectors: DataFrame | None = None          # (label_idx, label, vec)
    make_face_detector: infer.DetectorFactory | None = None
    make_face_embedder: infer.EmbedderFactory | None = None
    tag_reader: files.TagReader = files.no_tags
    # Any classifier (path, vec) -> (path, category) replaces zero-shot scoring
    classify: Callable[[DataFrame], DataFrame] | None = None


def _t(tables_dir: str, name: str) -> str:
    return os.path.join(tables_dir, name)


#: Schemas of the tables that are written partitioned: an empty one has no file to read it from.
SCHEMAS = {
    "layout": "path string, dst_dir string, new_path string, year string, month string",
    "links": "key string, link string, path string, target string, view string",
}


class Preview:
    """The stage tables of a dry run: those decided so far, kept in the checkpoint folder,
    stand before the stored ones of ``tables_dir``, which stay as they are."""

    def __init__(self, tables_dir: str):
        self.tables_dir = tables_dir
        self.decided: dict[str, DataFrame] = {}


Tables = str | Preview


class Results(dict):
    """What a run decided, by table, and in ``counters`` the totals of each table."""

    def __init__(self) -> None:
        super().__init__()
        self.counters: dict[str, dict[str, int]] = {}


def totals_of(name: str) -> list[Column]:
    """The counters of a stage table as aggregates over its rows (``images``: of the rows scanned now)."""
    rows = F.count(F.lit(1))
    kept = {"exact_dups": "groups", "near_dups": "confirmed_groups"}
    if name == "images":
        return scan_totals()
    if name in kept:
        return [F.count_if(F.col("is_keeper")).alias(kept[name]), F.count_if(~F.col("is_keeper")).alias("removed")]
    if name == "embeddings":
        return [F.count("vec").alias("embeddings"), F.count("error").alias("embed_errors")]
    return [rows.alias({"layout": "moved", "links": "links"}.get(name, "rows"))]

#: Tables that are written partitioned, and by what.
PARTITIONED = {"layout": ["year", "month"], "links": ["view"]}


def read(spark: SparkSession, tables_dir: Tables, name: str) -> DataFrame | None:
    """A stage table, None when its stage has not run yet.  Any other failure
    to read it is raised.  ``images`` is brought to the declared schema (S12)."""
    if isinstance(tables_dir, Preview):
        if name in tables_dir.decided:
            df = tables_dir.decided[name]
            return conform(df, SCANNED) if name == "images" else df
        tables_dir = tables_dir.tables_dir
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    try:
        df = reader.parquet(_t(tables_dir, name))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return conform(df, SCANNED) if name == "images" else df


def apply(df: DataFrame, tables_dir: str, name: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(_t(tables_dir, name))


def apply_view(links: DataFrame, tables_dir: str, name: str = "links") -> None:
    """Replace only the views present in ``links`` (dynamic partition
    overwrite on ``view``), e.g. rebuild ``by_person`` and keep the others."""
    (links.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("view").parquet(_t(tables_dir, name)))


def current(spark: SparkSession, tables_dir: Tables, upto: int = 6) -> DataFrame:
    """The ``images`` view: scan rows with the statuses and values of the
    phases *before* ``upto`` (exact dups from 3 on, near dups from 4 on,
    categories and person clusters from 5 on, layout from 6 on).  A phase
    never sees its own earlier output, so re-running it reproduces it (Q4)
    and never reads the table it overwrites."""
    img = read(spark, tables_dir, "images")
    exact = read(spark, tables_dir, "exact_dups") if upto >= 3 else None
    near = read(spark, tables_dir, "near_dups") if upto >= 4 else None
    cur = current_images(img, exact, near)
    later = [("categories", "category", "string", 5), ("face_clusters", "face_cluster_id", "int", 5),
             ("layout", "new_path", "string", 6)]
    for name, col, typ, phase in later:
        t = read(spark, tables_dir, name) if upto >= phase else None
        if t is not None:
            cur = cur.join(t.select("path", col), "path", "left")
        else:
            cur = cur.withColumn(col, F.lit(None).cast(typ))
    return cur.withColumn("face_cluster_id", F.coalesce(F.col("face_cluster_id"), F.lit(-1)))


def scan_schema() -> T.StructType:
    """The declared columns that phase 1 sets."""
    names = ("path", "status", "width", "height", "date_taken", "camera_make", "camera_model", "sha256")
    return T.StructType([f for f in IMAGES.fields if f.name in names])


SCANNED = scan_schema()


def phase1(spark: SparkSession, source: str, p: Params = DEFAULT, models: Models = Models(),
           exclude: str | None = None, tables_dir: Tables | None = None, seen: Observation | None = None) -> DataFrame:
    """Scan decisions; with ``tables_dir`` merged into the stored ones (S7):
    a row sets only the columns its status provides, files that are gone keep
    their row.  ``seen`` gets the counters of this scan."""
    rows = scan_status(files.scan_input(spark, source, models.tag_reader, exclude, pixel_stats=p.check_brightness), p)
    if seen is not None:
        rows = rows.observe(seen, *totals_of("images"))
    stored = read(spark, tables_dir, "images") if tables_dir else None
    if stored is None:
        return rows
    if "reason" not in stored.columns:
        stored = stored.withColumn("reason", F.lit(None).cast("string"))
    provided = F.array_append(scan_provided(F.col("status")), F.lit("reason"))
    # read before the stored table is overwritten
    return cut_lineage(upsert(stored, rows.withColumn("provided", provided), defaults={}))


def output_listing(spark: SparkSession, p: Params) -> DataFrame | None:
    """(path) of the files in the output tree, written as the layout writes
    them (S15); None when there is no such tree yet."""
    root = p.output_root.rstrip("/")
    try:
        listed = files.list_files(spark, root).select("path")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return listed.select(_as_placed(F.col("path"), p).alias("path"))


def phase2(spark: SparkSession, tables_dir: Tables) -> DataFrame:
    return exact_duplicates(current(spark, tables_dir, upto=2))


def _survivors(spark: SparkSession, tables_dir: Tables, upto: int, limit: int | None = None) -> DataFrame:
    ok = current(spark, tables_dir, upto).filter(F.col("status") == OK)
    return ok.orderBy("path").limit(limit) if limit else ok          # L3 / Q5: the first N survivors


def _placed_root(p: Params) -> tuple[str, str | None]:
    """The output root and, when it is relative, the folder it stands for."""
    root = p.output_root.rstrip("/")
    return root, None if os.path.isabs(root) or "://" in root else os.path.abspath(root)


def _as_placed(path: Column, p: Params) -> Column:
    """A listed path of the output tree as the layout writes it."""
    root, full = _placed_root(p)
    return path if full is None else F.concat(F.lit(root), F.substring(path, len(full) + 1, 1 << 20))


def _readable(spark: SparkSession, tables_dir: Tables, p: Params, wanted: DataFrame) -> DataFrame:
    """(path, read_path) of ``wanted`` (path): where each file is now."""
    placed, moved = read(spark, tables_dir, "layout"), output_listing(spark, p)
    if placed is None or moved is None:
        return cut_lineage(wanted.select("path", F.col("path").alias("read_path")))
    at = wanted.select("path").join(placed.select("path", "new_path"), "path", "left")
    return cut_lineage(effective_path(at, moved).select("path", "read_path"))


def _pixels(spark: SparkSession, source: str, p: Params, readable: DataFrame) -> DataFrame:
    """Decoded images, from the source and the output tree, whose path is
    probably a ``read_path``: a bitmap of bounded size thins them out before any
    work; ``_owned`` joins exactly after the pixels are reduced."""
    wanted = readable.select("read_path")
    pix = keep_probable(files.decode_images(spark, source).filter("decode_ok"), "path", wanted)
    if output_listing(spark, p) is not None:
        placed = files.decode_images(spark, p.output_root).filter("decode_ok").withColumn("path", _as_placed(F.col("path"), p))
        pix = pix.unionByName(keep_probable(placed, "path", wanted))
    return pix


def _owned(rows: DataFrame, readable: DataFrame) -> DataFrame:
    """Rows by read path -> rows by the image's own path."""
    own = readable.select(F.col("path").alias("own_path"), F.col("read_path").alias("path"))
    return rows.join(own, "path").withColumn("path", F.col("own_path")).drop("own_path").dropDuplicates(
        [c for c in ("path", "face_ord") if c in rows.columns])


def _with_earlier(new: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Rows of now and the earlier rows of images that have none now."""
    if earlier is None:
        return new
    new = cut_lineage(new)
    return cut_lineage(new.unionByName(earlier.select(*new.columns).join(new.select("path"), "path", "left_anti")))


def phase3(spark: SparkSession, source: str, tables_dir: Tables, models: Models, p: Params = DEFAULT,
           limit: int | None = None) -> dict[str, DataFrame]:
    ok = cut_lineage(_survivors(spark, tables_dir, 3, limit).select("path", "width", "height", "date_taken"))
    readable = _readable(spark, tables_dir, p, ok)
    pix = _pixels(spark, source, p, readable)
    grid = files.luminance_grid(8, 9)(F.col("data"), F.col("height"), F.col("width"), F.col("n_channels"))
    pix = pix.withColumn("phash", F.when(grid.isNotNull(), dhash(grid, 8, 9)))
    earlier = (lambda name: None) if limit else (lambda name: read(spark, tables_dir, name))
    if models.make_image_embedder is None:
        return {"fingerprints": _with_earlier(_owned(pix.select("path", "phash"), readable), earlier("fingerprints"))}
    # one decode feeds both the fingerprint and the model, in the task that
    # read the file: what is joined by path is a hash and a vector, not pixels.
    # Materialised once because it is written as two stage tables and read
    # again below.  The 64-bit hash travels through pandas as text (a nullable
    # int64 column would become float64 there and lose bits).
    both = infer.embed(pix.withColumn("phash_text", F.col("phash").cast("string")), "path",
                       ["data", "height", "width", "n_channels"], models.make_image_embedder,
                       p.infer_batch, carry=["phash_text"])
    both = cut_lineage(_owned(both, readable))
    fp = _with_earlier(both.select("path", F.col("phash_text").cast("long").alias("phash")), earlier("fingerprints"))
    emb = _with_earlier(both.select("path", "vec", "error"), earlier("embeddings"))
    out = {"fingerprints": fp, "embeddings": emb}
    ids = global_index(fp.select("path"), ["path"], out="pid")
    rows = (ids.join(fp, "path").join(emb.select("path", "vec"), "path", "left")
               .join(ok, "path"))
    near = near_duplicates(rows, "pid", p)
    out["near_dups"] = near.join(ids, "pid").select(
        "path", "candidate_group", "near_group",
        F.col("keeper").alias("keeper_pid"), "is_keeper").join(
        ids.select(F.col("pid").alias("keeper_pid"), F.col("path").alias("keeper")), "keeper_pid").drop("keeper_pid")
    return out


def phase4(spark: SparkSession, source: str, tables_dir: Tables, models: Models, p: Params = DEFAULT,
           limit: int | None = None) -> dict[str, DataFrame]:
    out = {}
    emb = read(spark, tables_dir, "embeddings")
    if emb is not None and (models.classify is not None or models.label_vectors is not None):
        ok = _survivors(spark, tables_dir, 4).select("path")
        scored = emb.filter(F.col("vec").isNotNull())
        if models.classify is not None:
            new = models.classify(ok.join(scored, "path").select("path", "vec")).select(
                "path", "category", F.lit(None).cast("double").alias("score"))
        else:
            ids = global_index(ok, ["path"], out="pid")
            z = zero_shot(ids.join(scored, "path"), models.label_vectors, "pid", "vec", p)
            new = z.join(ids, "pid").select("path", "category", F.col("score").cast("double").alias("score"))
        earlier = read(spark, tables_dir, "categories")
        if earlier is not None and "score" not in earlier.columns:
            earlier = earlier.withColumn("score", F.lit(None).cast("double"))
        new = _with_earlier(new, earlier)  # an image that was not scored now keeps its category
        out["categories"] = new
    if models.make_face_detector is not None and models.make_face_embedder is not None:
        survivors = _survivors(spark, tables_dir, 4, limit).select("path")
        ledger = read(spark, tables_dir, "face_scanned")
        if ledger is not None:                 # P4: only images no earlier run attempted
            survivors = unprocessed(survivors, ledger, "path")
        readable = _readable(spark, tables_dir, p, survivors)
        pix = _pixels(spark, source, p, readable)
        # boxes are clamped and cropped in the detection task: no pixel row leaves it but the crops
        det = infer.detect(pix, "path", ["data", "height", "width", "n_channels"], models.make_face_detector,
                           p.face_conf_threshold, p.infer_batch, crops=True)
        found = det.withColumn("fkey", F.concat_ws("#", "path", F.col("face_ord").cast("string")))
        carry = ["path", "face_ord", "x1", "y1", "x2", "y2", "conf"]
        fv = infer.embed(found.filter(F.col("crop").isNotNull()), "fkey", ["crop", "crop_h", "crop_w", "n_channels"],
                         models.make_face_embedder, p.infer_batch, carry=carry)
        failed = found.filter(F.col("face_ord").isNull()).select(
            "fkey", F.lit(None).cast("array<double>").alias("vec"), "error",
            *[F.col(c).cast(fv.schema[c].dataType) for c in carry])
        rows = cut_lineage(_owned(fv.unionByName(failed).drop("fkey"), readable))
        out["face_run"] = infer.inference_counters(
            rows.select("path", "face_ord", F.when(F.col("face_ord").isNull(), F.col("error")).alias("error")),
            rows.filter(F.col("face_ord").isNotNull()))
        faces = rows.filter(F.col("face_ord").isNotNull()).select("path", "face_ord", "x1", "y1", "x2", "y2", "vec", "error")
        stored = read(spark, tables_dir, "faces")
        if stored is not None:                 # cluster all faces, old and new (ids stay consistent)
            faces = stored.unionByName(faces)
        faces = cut_lineage(faces)             # read before the stored table is overwritten
        out["faces"] = faces
        attempted = readable.select("path")   # S8e: failures count as scanned too
        out["face_scanned"] = cut_lineage(attempted if ledger is None else mark_processed(ledger, attempted))
        pts = global_index(faces.filter(F.col("vec").isNotNull()).select("path", "face_ord", "vec"),
                           ["path", "face_ord"], out="fid")
        lab = dbscan(pts, "fid", "vec", ["path", "face_ord"], p.dbscan_eps, p.dbscan_min_samples, p.block_rows)
        labelled = pts.select("fid", "path", "face_ord").join(lab, "fid")
        pc = people.person_clusters(labelled, p, img="path")
        out["face_clusters"] = pc.withColumnRenamed("cluster_id", "face_cluster_id")
    return out


def phase5(spark: SparkSession, source: str, tables_dir: Tables, p: Params = DEFAULT,
           seen: Observation | None = None) -> dict[str, DataFrame]:
    """Places survivors that are still at their source; an image whose source
    is gone, or whose place is taken by its file, keeps its earlier place.
    Names in the output tree and kept places are taken.  ``seen`` gets the number of survivors."""
    cols = ["path", "dst_dir", "new_path", "year", "month"]
    cur = current(spark, tables_dir, 5)
    cur = cut_lineage(cur if seen is None else cur.observe(seen, F.count_if(F.col("status") == OK).alias("survivors")))
    here = files.list_files(spark, source).select("path")
    there, earlier = output_listing(spark, p), read(spark, tables_dir, "layout")
    taken, kept = there, None
    if earlier is not None:
        gone = earlier.join(here, "path", "left_anti")
        if there is not None:
            at_place = earlier.join(there.select(F.col("path").alias("new_path")), "new_path", "left_semi")
            gone = gone.select(*cols).unionByName(at_place.select(*cols)).distinct()
        kept = cut_lineage(gone.select(*cols))
        names = kept.select(F.col("new_path").alias("path"))
        taken = names if there is None else there.unionByName(names).distinct()
        cur_new = cur.join(kept.select("path"), "path", "left_anti")
    else:
        cur_new = cur
    placed = layout.place_files(cur_new, p, listing=here, existing=taken)
    if kept is not None:
        again = cur.filter(F.col("status") == OK).drop("new_path", "year", "month", "dst_dir").join(kept, "path")
        placed = placed.unionByName(again.select(*placed.columns))
    placed = cut_lineage(placed)
    return {"layout": placed.select("path", "year", "month", "dst_dir", "new_path"),
            "links": layout.view_links(placed, p)}


def run(spark: SparkSession, source: str, tables_dir: str, models: Models = Models(), p: Params = DEFAULT,
        phases: tuple = (1, 2, 3, 4, 5), dry_run: bool = False, limit: int | None = None) -> Results:
    """Q1-Q5: run the phases in order; each phase reads the tables of
    the phases before it.  ``dry_run`` previews them: later phases see what earlier ones decided, and no stage
    table is written.  ``counters`` of the result has the totals of each table, observed on the rows it was made of."""
    results = Results()
    tables: Tables = Preview(tables_dir) if dry_run else tables_dir
    for ph in phases:
        seen = Observation()
        if ph == 1:
            outside = os.path.isabs(p.output_root) or "://" in p.output_root
            root = p.output_root if outside else os.path.abspath(p.output_root)
            outs = {"images": phase1(spark, source, p, models, exclude=root, tables_dir=tables, seen=seen)}
        elif ph == 2:
            outs = {"exact_dups": phase2(spark, tables)}
        elif ph == 3:
            outs = phase3(spark, source, tables, models, p, limit)
        elif ph == 4:
            outs = phase4(spark, source, tables, models, p, limit)
        else:
            outs = phase5(spark, source, tables, p, seen)
        # a trial run of phase 3 sees some survivors only: its tables stand apart
        trial = bool(limit) and ph == 3
        for name, df in outs.items():
            counted = seen if name == "images" else Observation()
            df = df if name == "images" else df.observe(counted, *totals_of(name))
            parts = PARTITIONED.get(name)
            if isinstance(tables, Preview):
                # a partition of empty text is read back as null
                outs[name] = df = cut_lineage(df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in parts or []}))
                if not trial:
                    tables.decided[name] = df
            else:
                apply(df, os.path.join(tables, "trial") if trial else tables, name, parts)
            results.counters[name] = counted.get
        if ph == 5:
            results.counters["layout"]["skipped"] = seen.get["survivors"] - results.counters["layout"]["moved"]
        results.update(outs)
    return results


def regroup(spark: SparkSession, source: str, tables_dir: str, p: Params = DEFAULT,
            apply_links: bool = False, placed_root: str | None = None) -> DataFrame:
    """G11 on the stored tables (no inference); with ``apply_links`` the
    ``by_person`` view of the links table is rebuilt (S13).  ``placed_root``:
    when the layout has been carried out on disk, only targets found under it
    get a link (S15); by default the layout manifest is taken as is."""
    cur = current(spark, tables_dir)
    lay = read(spark, tables_dir, "layout")
    present = files.list_files(spark, placed_root).select("path") if placed_root else None
    out = people.regroup(cur, lay, p, present=present)
    if apply_links:
        lay_paths = lay.select("path", "new_path")
        links = (out.filter(F.col("link").isNotNull()).join(lay_paths, "path")
                    .select(F.lit("by_person").alias("view"),
                            F.regexp_extract("link", r"by_person/([^/]+)/", 1).alias("key"), "link", "path",
                            F.col("new_path").alias("target")))
        win = links.groupBy("view", "key", "link").agg(F.min(F.struct("path", "target")).alias("w"))
        apply_view(cut_lineage(win.select("view", "key", "link", "w.path", "w.target")), tables_dir)
    return out
