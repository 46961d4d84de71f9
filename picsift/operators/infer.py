"""Model plug-ins.

Models are user functions; this module only distributes them.  A factory
is called once in a Python worker, which keeps its model for later tasks and jobs (at most
``MODELS`` of them, the least recently used one goes), so weights load once per worker; the model
sees Arrow batches cut into mini-batches of ``batch_size`` rows.  A failing batch is retried row by row so one bad
file only costs its own row: its vector is NULL (it never pairs) and its
``error`` column says why.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

# make_embedder() -> fn(pandas.DataFrame of input columns) -> np.ndarray (n, d)
EmbedderFactory = Callable[[], Callable[[pd.DataFrame], np.ndarray]]
# make_detector() -> fn(pandas.DataFrame of input columns) -> for each row a list of (x1, y1, x2, y2, conf)
DetectorFactory = Callable[[], Callable[[pd.DataFrame], list]]

#: Models that a Python worker keeps.
MODELS = 3
_loaded: OrderedDict[str, Callable] = OrderedDict()


class Shipped:
    """A model factory as its bytes, by whose hash a worker knows the model it has made."""

    def __init__(self, make: Callable[[], Callable]):
        self.data = cloudpickle.dumps(make)
        self.name = hashlib.sha256(self.data).hexdigest()

    def model(self) -> Callable:
        if self.name not in _loaded:
            while len(_loaded) >= MODELS:
                _loaded.popitem(last=False)
            _loaded[self.name] = pickle.loads(self.data)()
        _loaded.move_to_end(self.name)
        return _loaded[self.name]


def _unit_rows(m: np.ndarray) -> list:
    m = np.asarray(m, dtype=np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.where(n > 0, m / np.where(n > 0, n, 1.0), m)
    return [r.tolist() for r in m]


def embed(df: DataFrame, key: str, inputs: list[str], make_embedder: EmbedderFactory,
          batch_size: int = 64, out: str = "vec", carry: list[str] | None = None) -> DataFrame:
    """``(key, out array<double> unit norm or NULL, error string,
    *carry)``; ``carry`` columns pass through unchanged, so values computed
    from the same decoded pixels (e.g. a fingerprint) need no second read."""
    carry = list(carry or [])
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField(out, T.ArrayType(T.DoubleType())),
                           T.StructField("error", T.StringType())] + [df.schema[c] for c in carry])

    shipped = Shipped(make_embedder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = shipped.model()
        for pdf in batches:
            keys, vecs, errs = [], [], []
            extra = {c: [] for c in carry}
            for s in range(0, len(pdf), batch_size):
                chunk = pdf.iloc[s:s + batch_size]
                try:
                    rows = _unit_rows(fn(chunk[inputs]))
                    errs_chunk = [None] * len(chunk)
                except Exception:
                    rows, errs_chunk = [], []
                    for i in range(len(chunk)):
                        try:
                            rows.extend(_unit_rows(fn(chunk[inputs].iloc[i:i + 1])))
                            errs_chunk.append(None)
                        except Exception as e:  # noqa: BLE001 - per-row isolation is the contract
                            rows.append(None)
                            errs_chunk.append(f"{type(e).__name__}: {e}")
                keys.extend(chunk[key].tolist())
                vecs.extend(rows)
                errs.extend(errs_chunk)
                for c in carry:
                    extra[c].extend(chunk[c].tolist())
            yield pd.DataFrame({key: keys, out: vecs, "error": errs, **extra})
    return df.select(*dict.fromkeys([key, *inputs, *carry])).mapInPandas(run, schema)


DETECTION_SCHEMA = ("{key} {ktype}, face_ord int, x1 int, y1 int, x2 int, y2 int, conf double, "
                    "error string, crop binary, crop_h int, crop_w int, n_channels int")


def clamp(box: tuple, width: int, height: int) -> tuple[int, int, int, int]:
    """Whole pixels within the image."""
    x1, y1, x2, y2 = (int(v) for v in box[:4])
    return max(0, x1), max(0, y1), min(width, x2), min(height, y2)


def detect(df: DataFrame, key: str, inputs: list[str], make_detector: DetectorFactory,
           conf: float, batch_size: int = 64, crops: bool = False, data: str = "data", width: str = "width",
           height: str = "height", channels: str = "n_channels") -> DataFrame:
    """One row per detection at confidence ``>= conf`` with its box clamped
    to the image (boxes without area are left out), or one row with
    ``face_ord`` NULL and ``error`` set when the detector failed for the image.
    Images without faces yield no row.  The detector sees ``batch_size`` images at a time; a
    failing batch is retried image by image.  With ``crops`` the pixels inside
    each box come with its row, cut out in the task that holds the image."""
    ktype = df.schema[key].dataType.simpleString()
    columns = list(dict.fromkeys([key, *inputs, width, height] + ([data, channels] if crops else [])))

    def attempt(fn, chunk: pd.DataFrame) -> list:
        found = fn(chunk[inputs])
        if len(found) != len(chunk):
            raise ValueError(f"the detector returned {len(found)} results for {len(chunk)} images")
        return list(found)

    shipped = Shipped(make_detector)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = shipped.model()
        names = [key, "face_ord", "x1", "y1", "x2", "y2", "conf", "error", "crop", "crop_h", "crop_w", "n_channels"]
        for pdf in batches:
            out = []
            for s in range(0, len(pdf), batch_size):
                chunk = pdf.iloc[s:s + batch_size]
                try:
                    results = attempt(fn, chunk)
                except Exception:
                    results = []
                    for i in range(len(chunk)):
                        try:
                            results += attempt(fn, chunk.iloc[i:i + 1])
                        except Exception as e:  # noqa: BLE001 - per-image isolation is the contract
                            results.append(f"{type(e).__name__}: {e}")
                for result, row in zip(results, chunk[columns].to_dict("records")):
                    if isinstance(result, str):
                        out.append((row[key], None, None, None, None, None, None, result, None, None, None, None))
                        continue
                    w, h = int(row[width]), int(row[height])
                    for i, box in enumerate(b for b in result if b[4] >= conf):
                        x1, y1, x2, y2 = clamp(box, w, h)
                        if x2 <= x1 or y2 <= y1:
                            continue
                        cut = n = None
                        if crops:
                            n = int(row[channels])
                            px = np.frombuffer(bytes(row[data]), dtype=np.uint8).reshape(h, w, n)
                            cut = px[y1:y2, x1:x2].tobytes()
                        out.append((row[key], i, x1, y1, x2, y2, float(box[4]), None, cut, y2 - y1, x2 - x1, n))
            frame = pd.DataFrame(out, columns=names)
            for c in ("face_ord", "x1", "y1", "x2", "y2", "crop_h", "crop_w", "n_channels"):
                frame[c] = frame[c].astype("Int32")
            yield frame

    return df.select(*columns).mapInPandas(run, DETECTION_SCHEMA.format(key=key, ktype=ktype))


def inference_counters(detections: DataFrame, face_vectors: DataFrame) -> DataFrame:
    """Detector errors, images with faces, embedding errors, embeddings."""
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("string")
    d = detections.select(F.col("error").alias("_derr"), F.when(F.col("face_ord").isNotNull(),
                          F.col(detections.columns[0]).cast("string")).alias("_img"),
                          none_s.alias("_eerr"), none_l.alias("_vec"))
    v = face_vectors.select(none_s.alias("_derr"), none_l.alias("_img"), F.col("error").alias("_eerr"),
                            F.when(F.col("vec").isNotNull(), F.lit("1")).alias("_vec"))
    return d.unionByName(v).agg(F.count("_derr").alias("detector_errors"),
                                F.count_distinct("_img").alias("images_with_faces"),
                                F.count("_eerr").alias("embed_errors"), F.count("_vec").alias("embeddings"))
