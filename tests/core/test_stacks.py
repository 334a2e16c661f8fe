"""Image stacks: files made by hand in every form that is read, and what the source writes."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roistack.sources.stacks import planes_of, plane_values, read_stacks, stack_header, write_stacks

KINDS = {"u1": 1, "u2": 1, "i2": 2, "f4": 3, "f8": 3}


def tiff(planes, order="<", kind="u2", strips=1, deflate=False, description=None, one_directory=False, resolution=None, big=False):
    """A file of the given planes, directories behind the values."""
    kind = np.dtype(order + kind)
    height, width = planes[0].shape
    out = bytearray((b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, 0) if big else struct.pack(order + "HI", 42, 0)))
    word, inline = ("Q", 8) if big else ("I", 4)
    pieces = []
    for p in planes:
        rows = np.array_split(p.astype(kind), strips)
        own = []
        for r in rows:
            data = zlib.compress(r.tobytes()) if deflate else r.tobytes()
            own.append((len(out), len(data)))
            out += data
        pieces.append(own)
    link = 8 if big else 4
    for k, own in enumerate(pieces[:1] if one_directory else pieces):
        entries = {256: (4, [width]), 257: (4, [height]), 258: (3, [8 * kind.itemsize]), 259: (3, [8 if deflate else 1]), 262: (3, [1]), 273: (4, [o for o, _ in own]), 277: (3, [1]), 278: (4, [height]), 279: (4, [n for _, n in own]), 339: (3, [KINDS[kind.str[1:]]])}
        if k == 0 and description:
            entries[270] = (2, description.encode() + b"\0")
        if k == 0 and resolution:
            entries[282] = entries[283] = (5, resolution)
        encoded = {t: (kind_of, v if isinstance(v, bytes) else struct.pack(order + {3: "H", 4: "I", 5: "I"}[kind_of] * len(v), *v), len(v) // (2 if kind_of == 5 else 1)) for t, (kind_of, v) in entries.items()}
        places = {}
        for t, (_, data, _) in encoded.items():
            if len(data) > inline:
                places[t] = len(out)
                out += data
        struct.pack_into(order + word, out, link, len(out))
        out += struct.pack(order + ("Q" if big else "H"), len(encoded))
        for t in sorted(encoded):
            kind_of, data, n = encoded[t]
            out += struct.pack(order + "HH" + word, t, kind_of, n) + (struct.pack(order + word, places[t]) if t in places else data.ljust(inline, b"\0"))
        link = len(out)
        out += struct.pack(order + word, 0)
    return bytes(out)


RNG = np.random.default_rng(1)
PLANES = [RNG.integers(0, 200, (5, 7)) for _ in range(6)]
HYPERSTACK = "ImageJ=1.53t\nimages=6\nchannels=3\nslices=2\nframes=1\nhyperstack=true\nunit=micron\n"


@pytest.mark.parametrize("form", [{}, {"order": ">"}, {"kind": "u1"}, {"kind": "f4", "order": ">"}, {"kind": "i2"}, {"kind": "f8"}, {"strips": 3}, {"deflate": True, "strips": 2}, {"one_directory": True}, {"big": True}, {"big": True, "order": ">", "deflate": True}])
def test_forms(tmp_path, form):
    path = tmp_path / "a.b.tif"
    path.write_bytes(tiff(PLANES, description=HYPERSTACK, resolution=[4, 1], **form))
    with path.open("rb") as f:
        found = planes_of(f, str(path), "run_")
        assert [(p.ch, p.z, p.frame) for p in found] == [(1, 1, 1), (2, 1, 1), (3, 1, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1)]
        assert {(p.name, p.width, p.height, p.pixel_width, p.unit) for p in found} == {("run_a.b", 7, 5, 0.25, "micron")}
        assert all((plane_values(f, p) == v).all() for p, v in zip(found, PLANES, strict=True))


def test_files_that_are_not_read(tmp_path):
    path = tmp_path / "x.tif"
    for data, message in ((b"no image at all.", "no TIFF"), (tiff(PLANES[:1]).replace(struct.pack("<HHII", 259, 3, 1, 1), struct.pack("<HHII", 259, 3, 1, 5)), "compressed"), (tiff(PLANES[:2], description=HYPERSTACK), "2 of 6")):
        path.write_bytes(data)
        with path.open("rb") as f, pytest.raises(ValueError, match=message):
            planes_of(f, str(path))


def test_read(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "one.tif").write_bytes(tiff(PLANES, description=HYPERSTACK))
    (tmp_path / "two.TIFF").write_bytes(tiff(PLANES[:2], order=">", kind="u1"))
    (tmp_path / "notes.txt").write_text("none")
    where = f"file://{tmp_path}"
    planes = {(r["name"], r.ch, r.z) for r in read_stacks(spark, where, "planes").collect()}
    assert planes == {("one", c, z) for c in (1, 2, 3) for z in (1, 2)} | {("two", 1, 1), ("two", 1, 2)}
    pixels = read_stacks(spark, where)
    assert pixels.rdd.getNumPartitions() == 8
    got = {(r["name"], r.ch, r.z, r.y, r.x): r.v for r in pixels.collect()}
    assert got == {("one", k % 3 + 1, k // 3 + 1, y, x): p[y, x] for k, p in enumerate(PLANES) for y in range(5) for x in range(7)} | {("two", 1, k + 1, y, x): p[y, x] for k, p in enumerate(PLANES[:2]) for y in range(5) for x in range(7)}
    few = pixels.where((F.col("ch") == 2) & F.col("z").isin(1, 2) & (F.col("name") == "one"))
    assert few.rdd.getNumPartitions() == 2 and few.count() == 70 and few.where("v < 0").count() == 0
    assert read_stacks(spark, f"{where}/deep/one.tif", channels=[3], slices=[2]).count() == 35
    assert read_stacks(spark, where, channels=[9]).count() == 0


def test_write(spark, tmp_path):
    rows = [("Position1", c, z, y, x, float(100 * c + 10 * z + y - x / 2)) for c in (1, 2) for z in (1, 3) for y in range(4) for x in range(3) if (y, x) != (2, 1)] + [("b", 1, 1, 0, 0, -3.5), ("b", 1, 1, 1, 4, 300.25)]
    pixels = spark.createDataFrame(rows, "name string, ch int, z int, y int, x int, v double")
    where = f"file://{tmp_path}/out"
    write_stacks(pixels.repartition(5), where, pixel_width=0.5, unit="micron")
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["Position1.tif", "b.tif"]
    got = {(r["name"], r.ch, r.z, r.y, r.x): r.v for r in read_stacks(spark, where).collect()}
    # pixels and planes that were not given are zero
    assert len(got) == 2 * 3 * 12 + 10 and {k: v for k, v in got.items() if v} == {r[:5]: r[5] for r in rows if r[5]}
    planes = read_stacks(spark, where, "planes").where("name = 'Position1'").collect()
    assert {(r.label, r.pixel_width, r.pixel_height, r.unit) for r in planes} == {(f"Position1/c:{c}/2 z:{z}/3", 0.5, 0.5, "micron") for c in (1, 2) for z in (1, 2, 3)}
    write_stacks(pixels.where("name = 'b'"), where, mode="overwrite", kind="u1")
    assert {r.v for r in read_stacks(spark, where).collect()} == {0, 255}
    bad = pixels.withColumn("x", F.when(F.col("name") == "b", F.col("x") - 9).otherwise(F.col("x")))
    with pytest.raises(Exception):  # noqa: B017
        write_stacks(bad, where)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["b.tif"]


def test_large_stacks_have_wide_offsets():
    head = stack_header((40_000, 40_000), (2, 1, 1), np.dtype("<u2"), "n", {})
    assert struct.unpack("<2sH", head[:4]) == (b"II", 43)
