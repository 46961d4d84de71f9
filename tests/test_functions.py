"""Hand-made edge rows for the scalar expressions."""

from pyspark.sql import functions as F

from picsift.functions import bits, exif, paths, vectors
from picsift.params import DATE_TAGS, MAKE_TAG


def _one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_capture_date(spark):
    o, d, t = DATE_TAGS
    rows = [({o: "2018:06:15 10:23:45"},), ({o: "2018"},), ({o: ""},), ({o: "unknown"},),
            ({o: "unknown", d: "2019:01:01 00:00:00"},), ({d: "\t2019:01:02 03:04:05 "},), ({},)]
    got = _one(spark, exif.capture_date(F.col("tags")), rows, "tags map<string,string>")
    # a present but unusable tag stops the search
    assert got == ["2018-06-15T10:23:45", "2018T", None, None, None, "2019-01-02T03:04:05", None]


def test_camera_strip(spark):
    got = _one(spark, exif.camera_make(F.col("tags")), [({MAKE_TAG: " \tCanon \n"},), ({},)],
               "tags map<string,string>")
    assert got == ["Canon", None]


def test_date_parts(spark):
    rows = [(None,), ("2018-06-15T1",), ("2018-6-15",), ("0000-00-00T",), ("201-123",), ("2018:06",), ("2018-06",)]
    df = spark.createDataFrame(rows, "d string")
    got = df.select(paths.date_year(F.col("d")), paths.date_month(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [("unknown", ""), ("2018", "06"), ("unknown", ""), ("0000", "00"),
                                       ("201", "123"), ("unknown", ""), ("2018", "06")]


def test_safe_dirname(spark):
    rows = [(None,), ("",), ("   ",), ("a/b\\c:d e",), ("x" * 70,)]
    got = _one(spark, paths.safe_dirname(F.col("n")), rows, "n string")
    assert got == ["unknown", "unknown", "", "a_b_c_d_e", "x" * 64]


def test_camera_and_person_dirs(spark):
    df = spark.createDataFrame([(" Apple ", "iPhone: 12", 7), ("unknown", None, -1), (None, None, 12345),
                                ("  ", "EOS", 0)], "mk string, md string, c int")
    got = df.select(paths.camera_dir(F.col("mk"), F.col("md")), paths.person_dir(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("Apple_iPhone__12", "person_0007"), ("unknown_camera", None),
                                       ("unknown_camera", "person_12345"), ("EOS", "person_0000")]


def test_name_parts(spark):
    df = spark.createDataFrame([("/a/b/IMG_1.JPG",), ("/a/x.tar.gz",), ("/a/.hidden",), ("/a/noext",)], "p string")
    n = paths.basename(F.col("p"))
    got = df.select(n, paths.stem(n), paths.suffix(n)).collect()
    assert [tuple(r) for r in got] == [("IMG_1.JPG", "IMG_1", ".JPG"), ("x.tar.gz", "x.tar", ".gz"),
                                       (".hidden", ".hidden", ""), ("noext", "noext", "")]


def test_hex_and_hamming(spark):
    hs = ["0000000000000000", "ffffffffffffffff", "8000000000000000", None]
    df = spark.createDataFrame([(h,) for h in hs], "h string")
    back = df.select(bits.from_hex(F.col("h")).alias("v"))
    assert [r[0] for r in back.collect()] == [0, -1, -(1 << 63), None]
    assert [r[0] for r in back.select(bits.to_hex(F.col("v"))).collect()] == hs
    d = spark.createDataFrame([(0, -1), (-(1 << 63), 0), (5, 3)], "a long, b long")
    assert [r[0] for r in d.select(bits.hamming(F.col("a"), F.col("b"))).collect()] == [64, 1, 2]


def test_dhash_matches_python(spark):
    import random
    rnd = random.Random(3)
    grids = [[rnd.random() for _ in range(72)] for _ in range(20)]
    df = spark.createDataFrame([(g,) for g in grids], "g array<double>")
    got = [r[0] for r in df.select(bits.dhash(F.col("g"), 8, 9)).collect()]
    for g, h in zip(grids, got):
        v = 0
        for r in range(8):
            for c in range(8):
                v = (v << 1) | (1 if g[r * 9 + c + 1] > g[r * 9 + c] else 0)
        if v >= 1 << 63:
            v -= 1 << 64
        assert h == v


def test_normalize_and_dot(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = df.select(vectors.l2_normalize(F.col("a")).alias("n"), vectors.dot(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == [0.6, 0.8] and got[0][1] == 3.0
    assert got[1][0] == [0.0, 0.0] and got[1][1] == 0.0
