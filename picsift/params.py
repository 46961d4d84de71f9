"""Job parameters.

Every threshold that decides a result lives in one frozen dataclass that is
passed to the jobs explicitly, so a run is reproducible from its arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must equal the original pipeline's for identical results) ---
MIN_WIDTH = 50
MIN_HEIGHT = 50
PHASH_THRESHOLD = 8
COSINE_THRESHOLD = 0.97
FACE_CONF_THRESHOLD = 0.25
DBSCAN_EPS = 0.4
DBSCAN_MIN_SAMPLES = 2
FACE_MIN_CLUSTER_SIZE = 10
INFER_BATCH = 64
LABELS = (
    "people portrait",
    "group of people",
    "landscape nature",
    "urban city",
    "food",
    "document text",
    "screenshot",
    "animals pets",
    "vehicles",
    "indoor home",
    "events celebration",
    "sports",
    "night scene",
)
# EXIF tag names read for capture date (in priority order) and camera.
DATE_TAGS = ("EXIF DateTimeOriginal", "EXIF DateTimeDigitized", "Image DateTime")
MAKE_TAG = "Image Make"
MODEL_TAG = "Image Model"
# status values
OK = "ok"
TINY = "deleted_tiny"
CORRUPT = "deleted_corrupt"
EXACT_DUP = "deleted_exact_dup"
NEAR_DUP = "deleted_near_dup"
# --- end fixed values ---


@dataclass(frozen=True)
class Params:
    min_width: int = MIN_WIDTH
    min_height: int = MIN_HEIGHT
    phash_threshold: int = PHASH_THRESHOLD
    cosine_threshold: float = COSINE_THRESHOLD
    face_conf_threshold: float = FACE_CONF_THRESHOLD
    dbscan_eps: float = DBSCAN_EPS
    dbscan_min_samples: int = DBSCAN_MIN_SAMPLES
    face_min_cluster_size: int = FACE_MIN_CLUSTER_SIZE
    infer_batch: int = INFER_BATCH
    labels: tuple = field(default=LABELS)
    output_root: str = "output"
    # rows per side of one block-pair similarity task.  Memory per task is
    # about 2 * block_rows * dim * 8 bytes of vectors, block_rows^2 bytes of
    # boolean adjacency and a 512-row slice of the float product; all-pairs
    # jobs shuffle n^2 / block_rows row copies, so larger is cheaper overall.
    block_rows: int = 8192
    # bands of the fingerprint join (hamming.py); None: phash_threshold + 3
    hash_bands: int | None = None
    # opt-in pixel check: near-black or flat frames count as corrupt
    check_brightness: bool = False
    min_brightness: float = 10.0
    min_std: float = 5.0


DEFAULT = Params()
