"""DuckDB oracle SQL for the registered queries.

Each string is self-contained: the fixture derivations are repeated as CTEs
over the pre-registered table views, then the operator is written the plain
relational way (window ranks, recursive CTEs for components, cross joins
for brute-force pair checks).
"""

from __future__ import annotations

from ..params import LABELS

_LABEL_LIST = "[" + ", ".join("'" + x + "'" for x in LABELS) + "]"

ASSETS = r"""
assets AS (
  SELECT d.doc_id,
         '/recovered/' || CAST(d.doc_id // 40 AS VARCHAR) || '/IMG_' || lpad(CAST(d.doc_id % 40 AS VARCHAR), 4, '0')
           || CASE d.doc_id % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.JPG' ELSE '.jpeg' END AS path,
         d.doc_id % 53 <> 0 AS decode_ok,
         CAST(40 + (d.doc_id * 37) % 400 AS INTEGER) AS width,
         CAST(40 + (d.doc_id * 53) % 300 AS INTEGER) AS height,
         CASE WHEN d.doc_id % 6 = 0 THEN NULL WHEN d.doc_id % 6 = 1 THEN 'unknown'
              ELSE ' ' || strftime(o.o_orderdate, '%Y:%m:%d %H:%M:%S') END AS tag_original,
         CASE WHEN d.doc_id % 12 = 0 THEN strftime(o.o_orderdate, '%Y:%m:%d %H:%M:%S') END AS tag_digitized,
         CAST(NULL AS VARCHAR) AS tag_datetime,
         CASE d.doc_id % 5 WHEN 1 THEN 'Canon' WHEN 2 THEN ' Apple ' WHEN 3 THEN 'unknown' WHEN 4 THEN 'NIKON CORP/JP' END AS tag_make,
         CASE d.doc_id % 4 WHEN 1 THEN 'EOS 5D' WHEN 2 THEN 'iPhone: 12' WHEN 3 THEN 'unknown' END AS tag_model,
         sha256(d.text) AS sha256,
         CASE WHEN d.doc_id % 10 = 9 THEN NULL ELSE LABELS[d.doc_id % 13 + 1] END AS category,
         CAST(CASE WHEN d.doc_id % 4 = 0 THEN -1 ELSE floor(sqrt(d.doc_id)) END AS INTEGER) AS face_cluster_id
  FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id
),
scan0 AS (
  SELECT *,
         CASE WHEN NOT decode_ok THEN 'deleted_corrupt' WHEN width < 50 OR height < 50 THEN 'deleted_tiny' ELSE 'ok' END AS status,
         regexp_replace(coalesce(tag_original, tag_digitized, tag_datetime), '^\s+|\s+$', '', 'g') AS raw_date
  FROM assets
),
scan AS (
  SELECT path, doc_id, status,
         CASE WHEN decode_ok THEN width END AS width,
         CASE WHEN decode_ok THEN height END AS height,
         CASE WHEN status = 'ok' AND regexp_matches(raw_date, '^[0-9]')
              THEN replace(substr(raw_date, 1, 10), ':', '-') || 'T' || substr(raw_date, 12) END AS date_taken,
         CASE WHEN status = 'ok' THEN regexp_replace(tag_make, '^\s+|\s+$', '', 'g') END AS camera_make,
         CASE WHEN status = 'ok' THEN regexp_replace(tag_model, '^\s+|\s+$', '', 'g') END AS camera_model,
         CASE WHEN status = 'ok' THEN sha256 END AS sha256,
         category, face_cluster_id
  FROM scan0
),
exact_ranked AS (
  SELECT path, sha256,
         row_number() OVER (PARTITION BY sha256 ORDER BY CAST(coalesce(width, 0) AS BIGINT) * coalesce(height, 0) DESC,
                                                          date_taken ASC NULLS LAST, path) AS rn,
         count(*) OVER (PARTITION BY sha256) AS n
  FROM scan WHERE status = 'ok' AND sha256 IS NOT NULL
),
exact AS (
  SELECT r.path, r.sha256, k.path AS keeper_path, r.rn = 1 AS is_keeper
  FROM exact_ranked r JOIN exact_ranked k ON k.sha256 = r.sha256 AND k.rn = 1
  WHERE r.n > 1
),
cur AS (
  SELECT s.path, s.doc_id,
         CASE WHEN s.status = 'ok' AND e.path IS NOT NULL THEN 'deleted_exact_dup' ELSE s.status END AS status,
         s.width, s.height, s.date_taken, s.camera_make, s.camera_model, s.sha256, s.category, s.face_cluster_id
  FROM scan s LEFT JOIN exact e ON e.path = s.path AND NOT e.is_keeper
)""".replace("LABELS", _LABEL_LIST)


VECTORS = r"""
vec_base AS (
  SELECT e.vec_id, e.label, c.copy, e.embedding
  FROM embeddings e JOIN (SELECT unnest([0, 1, 2, 3]) AS copy) c ON c.copy = 0 OR e.vec_id % 4 = 0
),
vec_raw AS (
  SELECT vec_id, label, copy, vec_id * 10 + copy AS asset_id,
         list_transform(embedding, lambda x, i: CAST(x AS DOUBLE)
            + (CASE copy WHEN 1 THEN 0.01::DOUBLE WHEN 2 THEN 0.012::DOUBLE WHEN 3 THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END)
              * CAST((i * 7 + vec_id * 3 + copy * 5) % 5 - 2 AS DOUBLE)) AS raw
  FROM vec_base
),
vec_n AS (
  SELECT *, sqrt(list_sum(list_transform(raw, lambda y: y * y))) AS nrm,
         CASE WHEN vec_id % 44 <> 8 THEN CAST(list_sum(list_transform(range(56), lambda k:
             CASE WHEN raw[(k // 7) * 8 + k % 7 + 2] > raw[(k // 7) * 8 + k % 7 + 1]
                  THEN CAST(1 AS BIGINT) << (55 - k) ELSE CAST(0 AS BIGINT) END)) AS BIGINT)
             + (vec_id % 256 - CASE WHEN vec_id % 256 >= 128 THEN 256 ELSE 0 END) * 72057594037927936 END AS phash
  FROM vec_raw
),
vectors AS (
  SELECT v.asset_id, v.vec_id, v.copy, v.label, list_transform(v.raw, lambda x: x / nrm) AS vec, v.phash,
         CAST(40 + (v.asset_id * 37) % 400 AS INTEGER) AS width,
         CAST(40 + (v.asset_id * 53) % 300 AS INTEGER) AS height,
         CASE WHEN v.asset_id % 6 <> 0 THEN strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS date_taken
  FROM vec_n v LEFT JOIN orders o ON o.o_orderkey = v.asset_id
),
hedge AS (
  SELECT a.asset_id AS x, b.asset_id AS y FROM vectors a JOIN vectors b
    ON a.asset_id <> b.asset_id AND bit_count(xor(a.phash, b.phash)) <= 8
),
reach(x, y) AS (
  SELECT asset_id, asset_id FROM vectors WHERE phash IS NOT NULL
  UNION
  SELECT r.x, e.y FROM reach r JOIN hedge e ON e.x = r.y
),
cg AS (SELECT x AS asset_id, min(y) AS candidate_group, count(*) AS n FROM reach GROUP BY x),
cand AS (SELECT asset_id, candidate_group FROM cg WHERE n > 1),
cedge AS (
  SELECT ca.asset_id AS x, cb.asset_id AS y
  FROM cand ca JOIN cand cb ON ca.candidate_group = cb.candidate_group AND ca.asset_id < cb.asset_id
  JOIN vectors a ON a.asset_id = ca.asset_id JOIN vectors b ON b.asset_id = cb.asset_id
  WHERE list_dot_product(a.vec, b.vec) >= 0.97
),
cedge2 AS (SELECT x, y FROM cedge UNION ALL SELECT y, x FROM cedge),
reach2(x, y) AS (
  SELECT x, x FROM cedge2
  UNION
  SELECT r.x, e.y FROM reach2 r JOIN cedge2 e ON e.x = r.y
),
ng AS (SELECT x AS asset_id, min(y) AS near_group FROM reach2 GROUP BY x),
nk AS (
  SELECT n.asset_id, n.near_group,
         row_number() OVER (PARTITION BY n.near_group ORDER BY CAST(v.width AS BIGINT) * v.height DESC,
                                                             coalesce(v.date_taken, '') ASC, n.asset_id) AS rn
  FROM ng n JOIN vectors v ON v.asset_id = n.asset_id
),
near AS (
  SELECT n.asset_id, c.candidate_group, n.near_group, k.asset_id AS keeper, n.asset_id = k.asset_id AS is_keeper
  FROM nk n JOIN nk k ON k.near_group = n.near_group AND k.rn = 1 JOIN cand c ON c.asset_id = n.asset_id
)"""


# the survivors of phases 1-2 as input of phase 3: four files share a base vector
CHAIN = VECTORS[:VECTORS.index("vectors AS (")] + r"""vectors AS (
  SELECT v.asset_id, list_transform(v.raw, lambda x: x / nrm) AS vec, v.phash, c.path, c.width, c.height, c.date_taken
  FROM vec_n v JOIN cur c ON v.asset_id = (c.doc_id // 4) * 40 + c.doc_id % 4
  WHERE c.status = 'ok'
),
""" + VECTORS[VECTORS.index("hedge AS ("):] + r""",
chained AS (
  SELECT c.path, CASE WHEN n.path IS NOT NULL THEN 'deleted_near_dup' ELSE c.status END AS status
  FROM cur c LEFT JOIN (SELECT v.path FROM near k JOIN vectors v ON v.asset_id = k.asset_id WHERE NOT k.is_keeper) n ON n.path = c.path
)"""

EMB = r"""
emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
lab_elems AS (
  SELECT label, pos, avg(x) AS m
  FROM (SELECT label, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM emb)
  GROUP BY label, pos
),
lab_raw AS (SELECT label, list(m ORDER BY pos) AS raw FROM lab_elems GROUP BY label),
lab_n AS (SELECT label, raw, sqrt(list_sum(list_transform(raw, lambda y: y * y))) AS nrm FROM lab_raw),
labels_vec AS (
  SELECT CAST(label AS INTEGER) AS label_idx, LABELS[label + 1] AS label, list_transform(raw, lambda x: x / nrm) AS vec
  FROM lab_n
)""".replace("LABELS", _LABEL_LIST)

FACES = r"""
face_base AS (
  SELECT e.vec_id, e.embedding, c.copy
  FROM embeddings e JOIN (SELECT unnest(range(16)) AS copy) c ON c.copy <= e.vec_id % 16
),
face_raw AS (
  SELECT vec_id, copy, vec_id * 100 + copy AS face_id,
         CAST(CASE WHEN vec_id % 16 = 0 THEN 1000000 + vec_id ELSE (vec_id // 3) * 20 + copy END AS BIGINT) AS img,
         list_transform(embedding, lambda x, i: CAST(x AS DOUBLE)
             + 0.02::DOUBLE * CAST((i * 7 + vec_id * 3 + copy * 5 + i * copy) % 7 - 3 AS DOUBLE)) AS raw
  FROM face_base
),
face_n AS (SELECT *, sqrt(list_sum(list_transform(raw, lambda y: y * y))) AS nrm FROM face_raw),
faces AS (
  SELECT face_id, img, list_transform(raw, lambda x: x / nrm) AS vec,
         CAST((face_id * 13) % 500 AS DOUBLE) - 20.5 AS x1,
         CAST((face_id * 7) % 400 AS DOUBLE) - 10.5 AS y1,
         CAST((face_id * 13) % 500 AS DOUBLE) - 20.5 + CAST(face_id % 90 AS DOUBLE) AS x2,
         CAST((face_id * 7) % 400 AS DOUBLE) - 10.5 + CAST(face_id % 70 AS DOUBLE) AS y2,
         CAST((face_id * 37) % 100 AS DOUBLE) / 100.0 AS conf, 480 AS img_w, 360 AS img_h,
         CAST(row_number() OVER (PARTITION BY img ORDER BY face_id) - 1 AS INTEGER) AS face_ord
  FROM face_n
),
fedge AS (
  SELECT a.face_id AS x, b.face_id AS y FROM faces a JOIN faces b ON a.face_id < b.face_id
  WHERE 1 - list_dot_product(a.vec, b.vec) <= 0.4
),
fedge2 AS (SELECT x, y FROM fedge UNION ALL SELECT y, x FROM fedge),
deg AS (SELECT x AS face_id, count(*) AS nb FROM fedge2 GROUP BY x),
core AS (SELECT face_id FROM deg WHERE nb + 1 >= MIN_SAMPLES),
cedges AS (
  SELECT e.x, e.y FROM fedge2 e JOIN core a ON a.face_id = e.x JOIN core b ON b.face_id = e.y
),
creach(x, y) AS (
  SELECT face_id, face_id FROM core
  UNION
  SELECT r.x, e.y FROM creach r JOIN cedges e ON e.x = r.y
),
croot AS (SELECT x AS face_id, min(y) AS root FROM creach GROUP BY x),
cfirst AS (
  SELECT root, img, face_ord FROM (
    SELECT c.root, f.img, f.face_ord, row_number() OVER (PARTITION BY c.root ORDER BY f.img, f.face_ord) AS rn
    FROM croot c JOIN faces f ON f.face_id = c.face_id) WHERE rn = 1
),
clab AS (SELECT root, CAST(row_number() OVER (ORDER BY img, face_ord) - 1 AS INTEGER) AS label FROM cfirst),
corelab AS (SELECT c.face_id, l.label FROM croot c JOIN clab l ON l.root = c.root),
border AS (
  SELECT e.x AS face_id, min(cl.label) AS label FROM fedge2 e JOIN corelab cl ON cl.face_id = e.y
  WHERE e.x NOT IN (SELECT face_id FROM core) GROUP BY e.x
),
dbscan AS (
  SELECT f.face_id, f.img, f.face_ord, CAST(coalesce(cl.label, b.label, -1) AS INTEGER) AS cluster
  FROM faces f LEFT JOIN corelab cl ON cl.face_id = f.face_id LEFT JOIN border b ON b.face_id = f.face_id
),
pc_counts AS (
  SELECT img, cluster, count(*) AS n, min(face_ord) AS first FROM dbscan WHERE cluster >= 0 GROUP BY img, cluster
),
pc_mode AS (
  SELECT img, cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY img ORDER BY n DESC, first ASC) AS rn FROM pc_counts) WHERE rn = 1
),
pc_img AS (
  SELECT i.img, coalesce(m.cluster, -1) AS cluster FROM (SELECT DISTINCT img FROM dbscan) i
  LEFT JOIN pc_mode m ON m.img = i.img
),
pc_size AS (SELECT cluster, count(*) AS n FROM pc_img WHERE cluster >= 0 GROUP BY cluster),
persons AS (
  SELECT p.img, CAST(CASE WHEN s.n >= 10 THEN p.cluster ELSE -1 END AS INTEGER) AS cluster_id
  FROM pc_img p LEFT JOIN pc_size s ON s.cluster = p.cluster
)"""
FACES_M3 = FACES.replace("MIN_SAMPLES", "3")
FACES = FACES.replace("MIN_SAMPLES", "2")


def _links(p: str, layout: str) -> str:
    """CTEs that end in ``<p>links``: the view links of the placed files ``layout``."""
    return r"""lnk0 AS (
  SELECT 'by_category' AS view,
         CASE WHEN category IS NULL OR category = '' THEN 'uncategorized'
              ELSE substr(translate(regexp_replace(category, '^\s+|\s+$', '', 'g'), '/\: ', '____'), 1, 64) END AS key,
         path, new_path FROM layout
  UNION ALL
  SELECT 'by_camera' AS view,
         coalesce(nullif(concat_ws('_',
            CASE WHEN sm NOT IN ('', 'unknown') THEN sm END,
            CASE WHEN so NOT IN ('', 'unknown') THEN so END), ''), 'unknown_camera') AS key,
         path, new_path
  FROM (SELECT path, new_path,
          CASE WHEN camera_make IS NULL OR camera_make = '' THEN 'unknown'
               ELSE substr(translate(regexp_replace(camera_make, '^\s+|\s+$', '', 'g'), '/\: ', '____'), 1, 64) END AS sm,
          CASE WHEN camera_model IS NULL OR camera_model = '' THEN 'unknown'
               ELSE substr(translate(regexp_replace(camera_model, '^\s+|\s+$', '', 'g'), '/\: ', '____'), 1, 64) END AS so
        FROM layout)
  UNION ALL
  SELECT 'by_person' AS view, printf('person_%04d', face_cluster_id) AS key, path, new_path
  FROM layout WHERE coalesce(face_cluster_id, -1) >= 0
),
lnk1 AS (SELECT *, 'output/' || view || '/' || key || '/' || regexp_extract(new_path, '[^/]*$') AS link FROM lnk0),
links AS (
  SELECT view, key, link, path, new_path AS target FROM (
    SELECT *, row_number() OVER (PARTITION BY view, key, link ORDER BY path) AS rn FROM lnk1) WHERE rn = 1
)""".replace("lnk0", p + "lnk0").replace("lnk1", p + "lnk1").replace("links AS", p + "links AS").replace("FROM layout", "FROM " + layout)


LAYOUT = r"""
lay0 AS (
  SELECT c.*,
         CASE WHEN length(date_taken) >= 7 AND regexp_matches(substr(date_taken, 1, 7), '^[0-9]+-[0-9]+$')
              THEN regexp_extract(substr(date_taken, 1, 7), '^([0-9]+)-([0-9]+)$', 1) ELSE 'unknown' END AS year,
         CASE WHEN length(date_taken) >= 7 AND regexp_matches(substr(date_taken, 1, 7), '^[0-9]+-[0-9]+$')
              THEN regexp_extract(substr(date_taken, 1, 7), '^([0-9]+)-([0-9]+)$', 2) ELSE '' END AS month,
         regexp_extract(path, '[^/]*$') AS name
  FROM cur c WHERE status = 'ok'
),
lay1 AS (
  SELECT *, 'output/by_date/' || CASE WHEN year = 'unknown' THEN 'unknown' ELSE year || '/' || month END AS dst_dir
  FROM lay0
),
lay2 AS (SELECT *, row_number() OVER (PARTITION BY dst_dir, name ORDER BY path) AS rn FROM lay1),
layout AS (
  SELECT *, dst_dir || '/' || CASE WHEN rn = 1 THEN name
         ELSE regexp_replace(name, '\.[^.]+$', '') || '_' || CAST(rn AS VARCHAR) || regexp_extract(name, '^.+(\.[^.]+)$', 1) END
         AS new_path
  FROM lay2
),
""" + _links("", "layout") + r""",
rg_size AS (SELECT face_cluster_id, count(*) AS n FROM layout WHERE face_cluster_id >= 0 GROUP BY face_cluster_id),
regroup AS (
  SELECT path, cid AS face_cluster_id,
         CASE WHEN cid >= 0 THEN 'output/by_person/' || printf('person_%04d', cid) || '/' || regexp_extract(new_path, '[^/]*$') END AS link
  FROM (SELECT l.path, l.new_path, CAST(CASE WHEN s.n >= 10 THEN l.face_cluster_id ELSE -1 END AS INTEGER) AS cid
        FROM layout l LEFT JOIN rg_size s ON s.face_cluster_id = l.face_cluster_id)
)"""


LABELLED = r"""
file_label AS (
  SELECT path, category FROM (
    SELECT v.path, l.label AS category, row_number() OVER (PARTITION BY v.path ORDER BY list_dot_product(v.vec, l.vec) DESC, l.label_idx) AS rn
    FROM vectors v JOIN chained c ON c.path = v.path AND c.status = 'ok' CROSS JOIN labels_vec l) WHERE rn = 1
),
labelled AS (
  SELECT c.path, c.doc_id, n.status, c.width, c.height, c.date_taken, c.camera_make, c.camera_model, c.sha256, z.category,
         coalesce(p.cluster_id, -1) AS face_cluster_id
  FROM cur c JOIN chained n ON n.path = c.path LEFT JOIN file_label z ON z.path = c.path LEFT JOIN persons p ON p.img = c.doc_id
)"""


# faces are sought in what phases 1-3 left, and only that has a person
SURVIVORS_FACES = FACES.replace("  FROM face_n\n)", "  FROM face_n WHERE img IN (SELECT c.doc_id FROM cur c JOIN chained n ON n.path = c.path WHERE n.status = 'ok')\n)")
SURVIVORS_LABELLED = LABELLED.replace("LEFT JOIN persons p ON p.img = c.doc_id", "LEFT JOIN persons p ON p.img = c.doc_id AND n.status = 'ok'")


RERUN = r"""
here AS (SELECT * FROM lay1 WHERE doc_id % 7 <> 3),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dst_dir, name ORDER BY path)
            + CASE WHEN name LIKE 'IMG_0001.%' THEN 1 ELSE 0 END AS k FROM here),
relayout AS (
  SELECT *, dst_dir || '/' || CASE WHEN k = 1 THEN name
         ELSE regexp_replace(name, '\.[^.]+$', '') || '_' || CAST(k AS VARCHAR) || regexp_extract(name, '^.+(\.[^.]+)$', 1) END AS new_path
  FROM numbered)"""


DETECTED = """
, raw_boxes AS (
  SELECT path, 0 AS face_ord, -3.7 + doc_id % 7 AS x1, 2.5 AS y1, width * 0.5 AS x2, height + 10.0 AS y2, CAST(0.9 AS DOUBLE) AS conf, width, height, doc_id FROM assets
  UNION ALL
  SELECT path, 2, 1.0, 1.0, 20.0, 20.0, CAST(doc_id % 100 AS DOUBLE) / 100, width, height, doc_id FROM assets WHERE doc_id % 100 >= 25
),
detected AS (
  SELECT path, CAST(face_ord AS INTEGER) AS face_ord, greatest(0, CAST(trunc(x1) AS INTEGER)) AS x1, greatest(0, CAST(trunc(y1) AS INTEGER)) AS y1,
         least(width, CAST(trunc(x2) AS INTEGER)) AS x2, least(height, CAST(trunc(y2) AS INTEGER)) AS y2, conf, CAST(NULL AS VARCHAR) AS error
  FROM raw_boxes WHERE doc_id % 5 <> 0 AND doc_id % 29 <> 0
  UNION ALL
  SELECT path, NULL, NULL, NULL, NULL, NULL, NULL, 'RuntimeError: no image' FROM assets WHERE doc_id % 29 = 0
)"""


def _with(*ctes: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n" + body


ORACLE: dict[str, str] = {
    "scan_status": _with(ASSETS, body="SELECT path, status, width, height, sha256 FROM scan"),
    "exif_normalize": _with(ASSETS, body="SELECT path, date_taken, camera_make, camera_model FROM scan WHERE status = 'ok'"),
    "scan_counters": _with(ASSETS, body="""
        SELECT count(*) AS files_found, count(*) FILTER (WHERE status = 'ok') AS ok,
               count(*) FILTER (WHERE status = 'deleted_tiny') AS tiny,
               count(*) FILTER (WHERE status = 'deleted_corrupt') AS corrupt FROM scan"""),
    "exact_dedup": _with(ASSETS, body="SELECT path, sha256, keeper_path, is_keeper FROM exact"),
    "exact_dedup_stats": _with(ASSETS, body="""
        SELECT count(DISTINCT sha256) AS groups, count(*) FILTER (WHERE NOT is_keeper) AS files_removed FROM exact"""),
    "status_summary": _with(ASSETS, body="""
        SELECT status, count(*) AS cnt FROM cur GROUP BY status
        UNION ALL SELECT 'TOTAL' AS status, count(*) AS cnt FROM cur"""),
    "images_by_year": _with(ASSETS, body="""
        SELECT substr(date_taken, 1, 4) AS year, count(*) AS cnt FROM cur WHERE status = 'ok' GROUP BY 1"""),
    "category_distribution": _with(ASSETS, body="""
        SELECT category, count(*) AS cnt FROM cur WHERE status = 'ok' GROUP BY category"""),
    "clusters_over_10": _with(ASSETS, body="""
        SELECT face_cluster_id, count(*) AS cnt FROM cur WHERE status = 'ok' AND face_cluster_id >= 0
        GROUP BY face_cluster_id HAVING count(*) > 10"""),
    "fingerprint_hex": _with(VECTORS, body="""
        SELECT asset_id, printf('%016x', phash) AS phash_hex, phash AS phash_back FROM vectors"""),
    "hamming_pairs": _with(VECTORS, body="""
        SELECT printf('%016x', ha) AS hash_a, printf('%016x', hb) AS hash_b, CAST(bit_count(xor(ha, hb)) AS INTEGER) AS dist
        FROM (SELECT DISTINCT a.phash AS ha, b.phash AS hb FROM vectors a JOIN vectors b ON a.phash < b.phash
              WHERE bit_count(xor(a.phash, b.phash)) <= 8)"""),
    "candidate_groups": _with(VECTORS, body="SELECT asset_id, candidate_group FROM cand"),
    "near_dups": _with(VECTORS, body="SELECT asset_id, candidate_group, near_group, keeper, is_keeper FROM near"),
    "near_dup_stats": _with(VECTORS, body="""
        SELECT (SELECT count(DISTINCT candidate_group) FROM cand) AS candidate_groups,
               (SELECT count(DISTINCT near_group) FROM near) AS confirmed_groups,
               (SELECT count(*) FROM near WHERE NOT is_keeper) AS removed"""),
    "near_dup_list": _with(VECTORS, body="SELECT asset_id FROM near WHERE NOT is_keeper"),
    "zero_shot": _with(EMB, body="""
        SELECT vec_id, label_idx, category, round(score, 6) AS score, round(1.0 / denom, 6) AS prob FROM (
          SELECT vec_id, label_idx, category, score,
                 sum(exp(100.0 * (score - mx))) OVER (PARTITION BY vec_id) AS denom,
                 row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label_idx) AS rn
          FROM (SELECT *, max(score) OVER (PARTITION BY vec_id) AS mx FROM (
                  SELECT e.vec_id, l.label_idx, l.label AS category, list_dot_product(e.vec, l.vec) AS score
                  FROM emb e CROSS JOIN labels_vec l))) WHERE rn = 1"""),
    "topk_similar": _with(EMB, body="""
        SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, round(sim, 6) AS sim FROM (
          SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, list_dot_product(a.vec, b.vec) AS sim,
                 row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.vec, b.vec) DESC, b.vec_id) AS rank
          FROM emb a JOIN emb b ON a.vec_id <> b.vec_id) WHERE rank <= 5"""),
    "dbscan_labels": _with(FACES, body="SELECT face_id, cluster FROM dbscan"),
    "dbscan_min3_labels": _with(FACES_M3, body="SELECT face_id, cluster FROM dbscan"),
    "person_clusters": _with(FACES, body="SELECT img, cluster_id FROM persons"),
    "cluster_report": _with(FACES, body="""
        SELECT (SELECT count(*) FROM dbscan) AS faces,
               CAST((SELECT coalesce(max(cluster), -1) + 1 FROM dbscan) AS INTEGER) AS n_clusters,
               (SELECT count(*) FROM dbscan WHERE cluster = -1) AS noise_faces,
               (SELECT count(DISTINCT img) FROM dbscan) AS images_with_faces,
               (SELECT count(*) FROM pc_size WHERE n >= 10) AS clusters_kept,
               (SELECT count(*) FROM pc_size WHERE n < 10) AS clusters_dropped"""),
    "layout_paths": _with(ASSETS, LAYOUT, body="SELECT path, year, month, new_path FROM layout"),
    "view_membership": _with(ASSETS, LAYOUT, body="SELECT view, key, link, path, target FROM links"),
    "layout_stats": _with(ASSETS, LAYOUT, body="""
        SELECT (SELECT count(*) FROM layout) AS moved,
               (SELECT count(*) FROM cur WHERE status = 'ok') - (SELECT count(*) FROM layout) AS skipped,
               (SELECT count(*) FROM links) AS links"""),
    "regroup": _with(ASSETS, LAYOUT, body="SELECT path, face_cluster_id, link FROM regroup"),
    "upsert_merge": _with(ASSETS, body="""
        , upd AS (
          SELECT path, status, width, height, date_taken, camera_make, camera_model, sha256,
                 CASE status WHEN 'deleted_corrupt' THEN ['status'] WHEN 'deleted_tiny' THEN ['status', 'width', 'height']
                      ELSE ['status', 'width', 'height', 'date_taken', 'camera_make', 'camera_model', 'sha256'] END AS provided
          FROM scan
          UNION ALL
          SELECT regexp_replace(path, '^/recovered/', '/incoming/'), status, width, height, date_taken, camera_make,
                 camera_model, sha256,
                 CASE status WHEN 'deleted_corrupt' THEN ['status'] WHEN 'deleted_tiny' THEN ['status', 'width', 'height']
                      ELSE ['status', 'width', 'height', 'date_taken', 'camera_make', 'camera_model', 'sha256'] END
          FROM scan WHERE category IS NULL
        )
        SELECT coalesce(b.path, u.path) AS path,
          CASE WHEN list_contains(u.provided, 'status') THEN u.status WHEN b.path IS NOT NULL THEN b.status ELSE 'ok' END AS status,
          CASE WHEN list_contains(u.provided, 'width') THEN u.width ELSE b.width END AS width,
          CASE WHEN list_contains(u.provided, 'height') THEN u.height ELSE b.height END AS height,
          CASE WHEN list_contains(u.provided, 'date_taken') THEN u.date_taken ELSE b.date_taken END AS date_taken,
          CASE WHEN list_contains(u.provided, 'camera_make') THEN u.camera_make ELSE b.camera_make END AS camera_make,
          CASE WHEN list_contains(u.provided, 'camera_model') THEN u.camera_model ELSE b.camera_model END AS camera_model,
          CASE WHEN list_contains(u.provided, 'sha256') THEN u.sha256 ELSE b.sha256 END AS sha256,
          b.category AS category,
          CAST(CASE WHEN b.path IS NOT NULL THEN b.face_cluster_id ELSE -1 END AS INTEGER) AS face_cluster_id
        FROM cur b FULL OUTER JOIN upd u ON u.path = b.path"""),
    "pipeline_status": _with(ASSETS, CHAIN, body="""
        SELECT status, count(*) AS cnt FROM chained GROUP BY status
        UNION ALL SELECT 'TOTAL' AS status, count(*) AS cnt FROM chained"""),
    "rescan_merge": _with(ASSETS, body="""
        SELECT path,
               CASE WHEN doc_id % 5 <> 0 AND doc_id % 11 = 0 THEN 'deleted_corrupt' ELSE status END AS status,
               width, height, date_taken, sha256 FROM scan
        UNION ALL
        SELECT regexp_replace(path, '^/recovered/', '/later/'), status, width, height, date_taken, sha256
        FROM scan WHERE doc_id % 9 = 0 AND status = 'ok'"""),
    "rescan_buckets": _with(ASSETS, body="""
        SELECT path, CASE WHEN doc_id % 9 = 0 AND doc_id % 11 = 0 THEN 'deleted_corrupt' ELSE status END AS status,
               width, height, date_taken, sha256 FROM scan
        UNION ALL
        SELECT regexp_replace(path, '^/recovered/', '/later/'), status, width, height, date_taken, sha256
        FROM scan WHERE doc_id % 9 = 0 AND status = 'ok'"""),
    "layout_rerun": _with(ASSETS, LAYOUT, RERUN, body="SELECT path, new_path FROM relayout"),
    "layout_rerun_stats": _with(ASSETS, LAYOUT, RERUN, _links("re_", "relayout"), body="""
        SELECT (SELECT count(*) FROM lay1 WHERE doc_id % 7 <> 3) AS moved, (SELECT count(*) FROM lay1 WHERE doc_id % 7 = 3) AS skipped,
               (SELECT count(*) FROM re_links) AS links"""),
    # one file after the other in path order: its name, or the first number that no file before it took
    "layout_chains": _with(ASSETS, body="""
        , named AS (
          SELECT path || '/' || nm || '.jpg' AS path, nm, row_number() OVER (ORDER BY path || '/' || nm || '.jpg') AS i
          FROM (SELECT path, (['a', 'a', 'a', 'a_2', 'a_3', 'a_2_2', 'a_5', 'b', 'b_2', 'a_99999999999999999999'])
                             [(ascii(substr(md5(path), 1, 1)) + 7 * ascii(substr(md5(path), 2, 1))) % 10 + 1] AS nm
                FROM cur WHERE status = 'ok')),
        step AS (
          SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS path, CAST(NULL AS VARCHAR) AS got, CAST([] AS VARCHAR[]) AS taken
          UNION ALL
          SELECT i, path, got, list_append(taken, got) AS taken FROM (
            SELECT n.i, n.path, s.taken,
                   CASE WHEN NOT list_contains(s.taken, n.nm) THEN n.nm
                        ELSE list_filter(list_transform(range(2, len(s.taken) + 3), lambda k: n.nm || '_' || CAST(k AS VARCHAR)),
                                         lambda x: NOT list_contains(s.taken, x))[1] END AS got
            FROM step s JOIN named n ON n.i = s.i + 1))
        SELECT path, 'output/by_date/2018/06/' || got || '.jpg' AS new_path FROM step WHERE i > 0"""),
    "effective_paths": _with(ASSETS, body="""
        SELECT path, CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 = 0 THEN 'output/by_date/' || CAST(doc_id AS VARCHAR) || '.jpg' ELSE path END AS read_path
        FROM assets"""),
    "scan_ledger": _with(ASSETS, body="""
        SELECT DISTINCT path FROM scan WHERE status = 'ok' AND (date_taken < '1998' OR doc_id % 4 = 1)"""),
    "conform": _with(ASSETS, body="""
        SELECT path, CASE WHEN doc_id % 7 <> 0 THEN 'deleted_tiny' ELSE 'ok' END AS status, width, CAST(-1 AS INTEGER) AS face_cluster_id,
               false AS face_scanned, CAST(NULL AS VARCHAR) AS new_path FROM assets"""),
    "brightness_status": _with(ASSETS, body="""
        SELECT path, CASE WHEN NOT decode_ok OR (doc_id * 17) % 256 < 10 OR (doc_id * 7) % 40 < 5 THEN 'deleted_corrupt'
                          WHEN width < 50 OR height < 50 THEN 'deleted_tiny' ELSE 'ok' END AS status,
               CASE WHEN decode_ok THEN width END AS width FROM assets"""),
    "detections": _with(ASSETS, body=DETECTED + """
        SELECT path, face_ord, x1, y1, x2, y2, conf, error FROM detected"""),
    "embed_vectors": """
        WITH unit AS (
          SELECT vec_id, len(embedding) AS dims, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS norm,
                 list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
        SELECT vec_id, CASE WHEN vec_id % 17 <> 0 THEN CAST(dims AS INTEGER) END AS dims,
               CASE WHEN vec_id % 17 <> 0 THEN round(v[1] / norm, 6) END AS v0,
               CASE WHEN vec_id % 17 <> 0 THEN round(list_sum(list_transform(v, lambda x, i: x / norm * i)), 6) END AS digest,
               CASE WHEN vec_id % 17 = 0 THEN 'ValueError: bad input' END AS error FROM unit""",
    "inference_counters": _with(ASSETS, body=DETECTED + """
        SELECT (SELECT count(error) FROM detected) AS detector_errors,
               (SELECT count(DISTINCT path) FROM detected WHERE face_ord IS NOT NULL) AS images_with_faces,
               (SELECT count(*) FROM embeddings WHERE vec_id % 17 = 0) AS embed_errors,
               (SELECT count(*) FROM embeddings WHERE vec_id % 17 <> 0) AS embeddings"""),
    "unscanned": _with(ASSETS, body="""
        SELECT path FROM cur WHERE status = 'ok'
          AND path NOT IN (SELECT path FROM cur WHERE status = 'ok' AND date_taken < '1998')"""),
    "cluster_sizes": _with(FACES, body="SELECT cluster, n AS images FROM pc_size"),
    "labelled_images": _with(ASSETS, CHAIN, EMB, SURVIVORS_FACES, SURVIVORS_LABELLED, body="SELECT path, status, category, face_cluster_id FROM labelled"),
    "labelled_views": _with(ASSETS, CHAIN, EMB, FACES, LABELLED, LAYOUT.replace("FROM cur c WHERE", "FROM labelled c WHERE"),
                            body="SELECT view, key, link, path, target FROM links"),
    "labelled_categories": _with(ASSETS, CHAIN, EMB, FACES, LABELLED, body="""
        SELECT category, count(*) AS cnt FROM labelled WHERE status = 'ok' GROUP BY category"""),
    "regroup_stats": _with(ASSETS, LAYOUT, body="""
        SELECT (SELECT count(*) FROM rg_size) AS clusters_found,
               (SELECT count(*) FROM rg_size WHERE n >= 10) AS clusters_kept,
               (SELECT count(*) FROM rg_size WHERE n < 10) AS clusters_dropped,
               (SELECT count(link) FROM regroup) AS links_created"""),
    "first_survivors": _with(ASSETS, body="SELECT path FROM cur WHERE status = 'ok' ORDER BY path LIMIT 100"),
    "box_clip": _with(FACES, body="""
        SELECT face_id, x1, y1, x2, y2 FROM (
          SELECT face_id, greatest(0, CAST(trunc(x1) AS INTEGER)) AS x1, greatest(0, CAST(trunc(y1) AS INTEGER)) AS y1,
                 least(img_w, CAST(trunc(x2) AS INTEGER)) AS x2, least(img_h, CAST(trunc(y2) AS INTEGER)) AS y2
          FROM faces WHERE conf >= 0.25) WHERE x2 > x1 AND y2 > y1"""),
}
