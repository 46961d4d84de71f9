"""Model plug-in contracts: per-row error isolation, unit vectors, box rules."""

import os
import tempfile

import numpy as np
import pytest

from picsift.operators import infer
from picsift.operators.boxes import clip_boxes
from picsift.operators.infer import detect, embed, inference_counters


def flaky_embedder():
    def fn(pdf):
        if (pdf["x"] < 0).any():
            raise ValueError("bad input")
        return np.stack([pdf["x"].values.astype(float), np.ones(len(pdf))], axis=1)
    return fn


def test_embed_isolates_failures(spark):
    df = spark.createDataFrame([(i, float(i if i != 7 else -1)) for i in range(20)], "k long, x double")
    got = {r.k: (r.vec, r.error) for r in embed(df, "k", ["x"], flaky_embedder, batch_size=4).collect()}
    assert got[7][0] is None and got[7][1].startswith("ValueError")
    for k in (4, 5, 6, 8, 19):
        v = np.array(got[k][0])
        assert abs(np.linalg.norm(v) - 1) < 1e-12 and got[k][1] is None


def test_detect_and_clip(spark):
    def make():
        def fn(pdf):
            if (pdf["w"] == 0).any():
                raise RuntimeError("no image")
            return [[(-3.9, 5.5, 50.2, 500.0, 0.9), (1, 1, 2, 2, 0.2), (10, 10, 10.5, 20, 0.5)] for _ in range(len(pdf))]
        return fn
    boxes = (-3.9, 5.5, 50.2, 500.0, 0.9), (1.0, 1.0, 2.0, 2.0, 0.2), (10.0, 10.0, 10.5, 20.0, 0.5)
    df = spark.createDataFrame([(1, 100, 80), (2, 0, 0)], "img long, w int, h int")
    det = detect(df, "img", ["w"], make, 0.25, width="w", height="h")     # the failing pair is retried one by one
    rows = det.collect()
    assert sum(r.error is not None for r in rows) == 1
    got = sorted((r.img, r.x1, r.y1, r.x2, r.y2) for r in rows if r.face_ord is not None)
    # (-3.9 -> -3 -> 0), y2 clamped to 80; the 10..10.5 box truncates to empty and is dropped
    assert got == [(1, 0, 5, 50, 80)]
    given = spark.createDataFrame([(1, *b, 100, 80) for b in boxes], "face_id long, x1 double, y1 double, x2 double, y2 double, "
                                  "conf double, img_w int, img_h int")
    assert sorted(tuple(r) for r in clip_boxes(given).collect()) == got      # the column form of the same rule
    fv = embed(spark.createDataFrame([(1, 1.0), (2, -1.0)], "k long, x double"), "k", ["x"], flaky_embedder)
    c = inference_counters(det, fv).collect()[0]
    assert (c.detector_errors, c.images_with_faces, c.embed_errors, c.embeddings) == (1, 1, 1, 1)


def test_a_worker_loads_a_model_once(spark):
    """Many tasks in several jobs: each worker loads the weights once, and another model is another load."""
    log = tempfile.mkdtemp(prefix="picsift-loads-")

    def factory(name):
        def make():
            with open(os.path.join(log, f"{name}-{os.getpid()}"), "a") as f:
                f.write("x")
            return lambda pdf: np.stack([pdf["x"].to_numpy(), np.ones(len(pdf))], axis=1)
        return make

    df = spark.range(240).selectExpr("id AS k", "id + 1D AS x").repartition(24)
    for name in ("one", "other", "one"):
        assert embed(df, "k", ["x"], factory(name)).filter("error IS NULL").count() == 240
    for name in ("one", "other"):
        files = [f for f in os.listdir(log) if f.startswith(name)]
        assert 1 <= len(files) <= 8 and all(os.path.getsize(os.path.join(log, f)) == 1 for f in files)


def test_a_worker_keeps_few_models(monkeypatch):
    monkeypatch.setattr(infer, "_loaded", type(infer._loaded)())
    shipped = [infer.Shipped(lambda i=i: lambda pdf: i) for i in range(infer.MODELS + 2)]
    assert [s.model()(None) for s in shipped] == list(range(infer.MODELS + 2))
    assert list(infer._loaded) == [s.name for s in shipped[2:]]
    shipped[2].model()
    shipped[0].model()
    assert shipped[2].name in infer._loaded and shipped[3].name not in infer._loaded


def test_a_failing_factory_is_raised(spark):
    def make():
        raise RuntimeError("no weights")

    with pytest.raises(Exception, match="no weights"):
        embed(spark.createDataFrame([(1, 1.0)], "k long, x double"), "k", ["x"], make).collect()
