"""Tiny real image files (PNG bytes under JPEG names; the JVM decoder reads
by content) for ingest tests."""

import os
import struct
import zlib

import numpy as np


def png(w, h, seed=0, tweak=False):
    rows = []
    for y in range(h):
        line = bytes(((x * 7 + y * 13 + seed * 31) % 256) for x in range(w * 3))
        if tweak and y == 0:
            line = bytes([(line[0] + 1) % 256]) + line[1:]
        rows.append(b"\x00" + line)
    raw = b"".join(rows)

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xffffffff)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def make_tree(d):
    os.makedirs(os.path.join(d, "sub"), exist_ok=True)
    files = {"a.JPG": png(80, 60), "sub/a_copy.jpg": png(80, 60), "near.jpg": png(80, 60, tweak=True),
             "b.jpg": png(20, 60), "c.jpeg": b"junk bytes", "d.txt": b"text", "e.jpg": png(64, 64, seed=5),
             "sub/e.jpg": png(70, 70, seed=9)}
    for name, data in files.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    return d


def _pixels(row):
    return np.frombuffer(bytes(row["data"]), dtype=np.uint8).reshape(int(row["height"]), int(row["width"]),
                                                                    int(row["n_channels"]))


def toy_embedder():
    def fn(pdf):
        out = []
        for _, r in pdf.iterrows():
            px = np.frombuffer(bytes(r.iloc[0]), dtype=np.uint8).reshape(int(r.iloc[1]), int(r.iloc[2]),
                                                                       int(r.iloc[3])).astype(float)
            ys = np.linspace(0, px.shape[0], 5).astype(int)
            xs = np.linspace(0, px.shape[1], 5).astype(int)
            out.append([px[ys[i]:ys[i + 1], xs[j]:xs[j + 1], c].mean() - 128
                        for i in range(4) for j in range(4) for c in range(px.shape[2])])
        return np.array(out)
    return fn


def toy_detector():
    def fn(pdf):
        # two overlapping faces, one below the confidence cut, one outside the frame
        return [[(-5.7, 2.2, w * 0.6, h * 0.7, 0.9), (-4.7, 3.2, w * 0.6 + 1, h * 0.7 + 1, 0.85),
                 (1, 1, 5, 5, 0.1), (w + 1, h + 1, w + 9, h + 9, 0.8)]
                for h, w in zip(pdf["height"].astype(int), pdf["width"].astype(int))]
    return fn
