"""Image hyperstacks as a data source: ``spark.read.format("stack")``, a plane for each input partition.

A stack is a TIFF file (BigTIFF beyond 4 GB) of planes, channels fastest, then
slices, then frames, with the sizes of the axes, the unit and the slices' labels
in the descriptive entries that image tools write.  The driver reads entries
only; a task reads the bytes of its own planes, so a stack of any size is read by
as many tasks as it has planes, and planes of other channels or slices are never
opened.  Files are reached through Arrow's file systems (local, HDFS, object
stores); a store that only Spark reads is served by its binary files instead,
then a file at a time.

``form`` is ``pixels`` (a row for each pixel) or ``planes`` (a row for each plane:
position, label, sizes, pixel size).  A stack's name is the part of its first
label that names a position, else the file's own name.

Writing takes pixel rows that :func:`write_stacks` has dealt by stack: each stack
is streamed into a staging folder, plane by plane, and moved into place when all
tasks have ended well.  Pixels that are not given are zero.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from io import BytesIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

PIXELS = "name string, ch int, z int, frame int, y int, x int, v double"
PLANES = "name string, path string, label string, ch int, z int, frame int, width int, height int, pixel_width double, pixel_height double, unit string, n_bytes long"
#: What the writer gets: pixels and the sizes of their stack.
DEALT = PIXELS + ", width int, height int, n_ch int, n_z int, n_frame int"
#: Pixels of a record batch.
ROWS = 1 << 16

#: Numbers of the entries of a file's directories.
WIDTH, HEIGHT, DEPTH, COMPRESSION, PHOTOMETRIC, DESCRIPTION, OFFSETS, SAMPLES, ROWS_PER_STRIP, COUNTS, X_RESOLUTION, Y_RESOLUTION, RESOLUTION_UNIT, KIND = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279, 282, 283, 296, 339
PREDICTOR, TILES, LABEL_COUNTS, LABELS = 317, 322, 50838, 50839
#: Bytes of an entry's value by type, and how struct reads it.
TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 7: (1, "B"), 8: (2, "h"), 9: (4, "i"), 10: (8, "ii"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}
#: Compression schemes that are read, none and two numbers of zlib's.
PLAIN, DEFLATED = 1, (8, 32946)
#: What a label block begins with, and the mark of labels in it.
LABEL_MAGIC, LABEL_MARK = b"IJIJ", b"labl"


@dataclass(frozen=True)
class Plane:
    """Where a plane's values are, and what is known of them."""

    name: str
    path: str
    label: str | None
    ch: int
    z: int
    frame: int
    width: int
    height: int
    pixel_width: float
    pixel_height: float
    unit: str
    dtype: str
    deflated: bool
    strips: tuple[tuple[int, int], ...]

    @property
    def n_bytes(self) -> int:
        return sum(n for _, n in self.strips)


def _entries(f, at: int, order: str, big: bool) -> tuple[dict[int, tuple[int, int, bytes]], int]:
    """Type, count and value bytes of a directory's entries by number, and where the next directory is."""
    head, item, word = (8, 20, "Q") if big else (2, 12, "I")
    f.seek(at)
    n = struct.unpack(order + ("Q" if big else "H"), f.read(head))[0]
    block = f.read(n * item + struct.calcsize(word))
    found = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + ("HHQ" if big else "HHI"), block, k * item)
        size = TYPES.get(kind, (1, "B"))[0] * count
        inline = block[k * item + (12 if big else 8) : (k + 1) * item]
        if size > len(inline):
            f.seek(struct.unpack(order + word, inline)[0])
            inline = f.read(size)
        found[tag] = (kind, count, inline[:size])
    return found, struct.unpack_from(order + word, block, n * item)[0]


def _values(entry: tuple[int, int, bytes], order: str) -> list:
    kind, count, data = entry
    size, code = TYPES[kind]
    if code == "s":
        return [data]
    flat = struct.unpack(order + code * count, data[: size * count])
    return [a / b if b else 0.0 for a, b in zip(flat[::2], flat[1::2], strict=True)] if len(code) == 2 else list(flat)


def _labels(entries: dict, order: str) -> list[str]:
    """The slices' labels of a label block: marks and numbers of entries, then the entries, of the lengths listed beside."""
    if LABELS not in entries or LABEL_COUNTS not in entries:
        return []
    block, lengths = entries[LABELS][2], _values(entries[LABEL_COUNTS], order)
    if block[:4] not in (LABEL_MAGIC, LABEL_MAGIC[::-1]):
        return []
    out, at, k = [], lengths[0], 1
    for i in range(4, lengths[0], 8):
        mark, many = block[i : i + 4], struct.unpack_from(order + "I", block, i + 4)[0]
        for _ in range(many):
            if mark in (LABEL_MARK, LABEL_MARK[::-1]):
                out.append(block[at : at + lengths[k]].decode("utf-16-le" if order == "<" else "utf-16-be"))
            at, k = at + lengths[k], k + 1
    return out


def planes_of(f, path: str, basename: str = "") -> list[Plane]:
    """The planes of an open file, in its order."""
    start = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    if order is None or struct.unpack(order + "H", start[2:4])[0] not in (42, 43):
        raise ValueError(f"{path} is no TIFF file")
    big = struct.unpack(order + "H", start[2:4])[0] == 43
    at = struct.unpack(order + "Q", start[8:16])[0] if big else struct.unpack(order + "I", start[4:8])[0]
    directories, seen = [], set()
    while at and at not in seen:
        seen.add(at)
        entries, at = _entries(f, at, order, big)
        directories.append(entries)
    first = directories[0]
    one = lambda e, tag, default: _values(e[tag], order)[0] if tag in e else default
    text = one(first, DESCRIPTION, b"").rstrip(b"\0").decode("utf-8", "replace")
    known = dict(line.split("=", 1) for line in text.splitlines() if "=" in line)
    number = lambda key: max(1, int(float(known.get(key, 1))))
    n_ch, n_z, n_frame = number("channels"), number("slices"), number("frames")
    if n_ch * n_z * n_frame == 1:
        n_z = max(len(directories), number("images"))
    images = n_ch * n_z * n_frame
    sizes = [1 / r if r else 1.0 for r in (one(first, X_RESOLUTION, 1.0), one(first, Y_RESOLUTION, 1.0))]
    labels = _labels(first, order)
    position = next((part for part in (labels[0] if labels else "").split("/") if "Position" in part), path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0])
    out = []
    for p in range(images):
        if p < len(directories):
            e = directories[p]
        elif len(directories) > 1:
            raise ValueError(f"{path} holds {len(directories)} of {images} planes")
        if TILES in e or one(e, SAMPLES, 1) != 1 or one(e, PREDICTOR, 1) != 1 or one(e, COMPRESSION, PLAIN) not in (PLAIN, *DEFLATED):
            raise ValueError(f"{path}: planes in tiles, of several samples, or compressed other than by zlib are not read")
        bits, kind = one(e, DEPTH, 8), one(e, KIND, 1)
        dtype = {1: "u", 2: "i", 3: "f"}.get(kind, "?") + str(bits // 8)
        if dtype not in ("u1", "u2", "u4", "i1", "i2", "i4", "f4", "f8"):
            raise ValueError(f"{path}: values of {bits} bits of kind {kind} are not read")
        strips = tuple(zip(_values(e[OFFSETS], order), _values(e[COUNTS], order), strict=True))
        if p >= len(directories):
            # one directory for all: the planes follow each other
            size = sum(n for _, n in strips)
            strips = ((strips[0][0] + p * size, size),)
        out.append(Plane(basename + position, path, labels[p] if p < len(labels) else None, p % n_ch + 1, p // n_ch % n_z + 1, p // (n_ch * n_z) + 1, one(e, WIDTH, 0), one(e, HEIGHT, 0), *sizes, known.get("unit", "pixel"), order + dtype, one(e, COMPRESSION, PLAIN) != PLAIN, strips))
    return out


def plane_values(f, plane: Plane) -> np.ndarray:
    """A plane's values as doubles, by row and column."""
    data = b""
    for at, n in plane.strips:
        f.seek(at)
        data += zlib.decompress(f.read(n)) if plane.deflated else f.read(n)
    values = np.frombuffer(data, plane.dtype, plane.width * plane.height)
    return values.astype(np.float64).reshape(plane.height, plane.width)


def _pixel_batches(plane: Plane, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = values.ravel()
    for a in range(0, len(flat), ROWS):
        at = np.arange(a, min(a + ROWS, len(flat)))
        same = lambda v, kind, n=len(at): pa.array(np.full(n, v), kind)
        name = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(at), np.int32)), pa.array([plane.name])).cast(pa.string())
        yield pa.RecordBatch.from_arrays([name, same(plane.ch, pa.int32()), same(plane.z, pa.int32()), same(plane.frame, pa.int32()), pa.array((at // plane.width).astype(np.int32)), pa.array((at % plane.width).astype(np.int32)), pa.array(flat[at])], names=["name", "ch", "z", "frame", "y", "x", "v"])


def _plane_batch(planes: list[Plane]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PLANES.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "long": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([getattr(p, n) for p in planes], kinds[c.split()[1]]) for n, c in zip(names, PLANES.split(", "), strict=True)], names=names)


class StackReader(DataSourceReader):
    """Options: path, form, basename; channels, slices and frames (comma separated) to read no other planes; planesPerTask."""

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.form, self.wanted = self.options.get("form", "pixels"), {}
        for option, column in (("channels", "ch"), ("slices", "z"), ("frames", "frame")):
            if option in self.options:
                self.wanted[column] = {int(x) for x in self.options[option].split(",")}

    def partitions(self) -> list[InputPartition]:
        store, root = fs.FileSystem.from_uri(self.options["path"])
        info = store.get_file_info(root)
        files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
        paths = sorted(i.path for i in files if i.type == fs.FileType.File and i.path.lower().endswith((".tif", ".tiff")) and "/_" not in i.path[len(root) :])

        def listed(path: str) -> list[Plane]:
            with store.open_input_file(path) as f:
                return planes_of(f, path, self.options.get("basename", ""))

        with ThreadPoolExecutor(16) as pool:
            planes = [p for found in pool.map(listed, paths) for p in found]
        planes = [p for p in planes if all(getattr(p, c) in values for c, values in self.wanted.items())]
        each = 4096 if self.form == "planes" else int(self.options.get("planespertask", 1))
        return [InputPartition(planes[i : i + each]) for i in range(0, len(planes), each)]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no plane
            return
        if self.form == "planes":
            yield _plane_batch(partition.value)
            return
        store, _ = fs.FileSystem.from_uri(self.options["path"])
        for plane in partition.value:
            with store.open_input_file(plane.path) as f:
                yield from _pixel_batches(plane, plane_values(f, plane))


class PushingStackReader(StackReader):
    """Takes equalities on a plane's columns from the query, so that other planes are no partitions."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in (("name",), ("ch",), ("z",), ("frame",)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], values) & values
            else:
                yield f


class StackWriter(DataSourceArrowWriter):
    """Options: path; kind (u1, u2, f4: values are rounded to whole ones and cut off for the first two), pixel_width, pixel_height, unit."""

    def __init__(self, options: dict, overwrite: bool):
        self.options, self.overwrite = {k.lower(): v for k, v in options.items()}, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = fs.FileSystem.from_uri(self.options["path"])
        folder = f"{root.rstrip('/')}/{self.staging}/{uuid.uuid4().hex}"
        store.create_dir(folder, recursive=True)
        kind = np.dtype("<" + self.options.get("kind", "f4"))
        files: list[str] = []
        name, out, plane, at, n_planes = None, None, None, -1, 0

        def flush(until: int) -> None:
            nonlocal plane, at
            if plane is not None:
                values = plane if kind.kind == "f" else np.clip(np.rint(plane), 0, np.iinfo(kind).max)
                out.write(values.astype(kind).tobytes())
                at += 1
            while at < until:
                out.write(bytes(shape[0] * shape[1] * kind.itemsize))
                at += 1
            plane = None

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("name").to_pylist()
            ch, z, frame, y, x, v = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ch", "z", "frame", "y", "x", "v"))
            number = np.zeros(len(names), np.int64)
            cut = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if names[a] != name:
                    if out:
                        flush(n_planes)
                        out.close()
                    name, plane, at = names[a], None, 0
                    width, height, n_ch, n_z, n_frame = (batch.column(c)[a].as_py() for c in ("width", "height", "n_ch", "n_z", "n_frame"))
                    shape, n_planes = (height, width), n_ch * n_z * n_frame
                    files.append(f"{folder}/{name}.tif")
                    out = store.open_output_stream(files[-1])
                    out.write(stack_header(shape, (n_ch, n_z, n_frame), kind, name, self.options))
                number[a:b] = ((frame[a:b] - 1) * n_z + z[a:b] - 1) * n_ch + ch[a:b] - 1
                own = [a, *(a + 1 + np.flatnonzero(np.diff(number[a:b]))).tolist(), b]
                for i, j in zip(own[:-1], own[1:], strict=True):
                    if plane is None or number[i] != at:
                        flush(int(number[i]))
                        plane = np.zeros(shape)
                    plane[y[i:j], x[i:j]] = v[i:j]
        if out:
            flush(n_planes)
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, root = fs.FileSystem.from_uri(self.options["path"])
        root = root.rstrip("/")
        files = [f for m in messages if m for f in m.files]
        if self.overwrite:
            for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if i.path.lower().endswith((".tif", ".tiff")):
                    store.delete_file(i.path)
        for f in files:
            store.move(f, f"{root}/{f.rsplit('/', 1)[-1]}")
        if files:
            store.delete_dir(f"{root}/{self.staging}")

    def abort(self, messages: list) -> None:
        store, root = fs.FileSystem.from_uri(self.options["path"])
        if store.get_file_info(f"{root.rstrip('/')}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{root.rstrip('/')}/{self.staging}")


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


def stack_header(shape: tuple[int, int], axes: tuple[int, int, int], kind: np.dtype, name: str, options: dict) -> bytes:
    """All that comes before the planes of a stack whose planes follow each other: directories, description and labels."""
    (height, width), (n_ch, n_z, n_frame) = shape, axes
    n, size = n_ch * n_z * n_frame, height * width * kind.itemsize
    unit, sizes = options.get("unit", "pixel"), [float(options.get("pixel_width", 1.0))]
    sizes.append(float(options.get("pixel_height", sizes[0])))
    text = f"ImageJ=1.53t\nimages={n}\nchannels={n_ch}\nslices={n_z}\nframes={n_frame}\nhyperstack=true\nunit={unit}\n".encode() + b"\0"
    labels = [f"{name}/c:{p % n_ch + 1}/{n_ch} z:{p // n_ch % n_z + 1}/{n_z}".encode("utf-16-le") for p in range(n)]
    block = LABEL_MAGIC + LABEL_MARK + struct.pack("<I", n)
    lengths = [len(block), *map(len, labels)]
    block += b"".join(labels)
    big = n * (size + 400) + len(block) + len(text) > 4_000_000_000
    word, entry, count, head = ("Q", "<HHQ", "<Q", 16) if big else ("I", "<HHI", "<H", 8)
    inline, offset_kind = (8, 16) if big else (4, 4)
    fraction = lambda v: struct.pack("<II", 1_000_000, max(1, round(v * 1_000_000)))
    shared = {DESCRIPTION: (2, len(text), text), LABEL_COUNTS: (4, len(lengths), struct.pack(f"<{len(lengths)}I", *lengths)), LABELS: (1, len(block), block), X_RESOLUTION: (5, 1, fraction(sizes[0])), Y_RESOLUTION: (5, 1, fraction(sizes[1]))}
    small = {WIDTH: width, HEIGHT: height, DEPTH: 8 * kind.itemsize, COMPRESSION: PLAIN, PHOTOMETRIC: 1, SAMPLES: 1, ROWS_PER_STRIP: height, RESOLUTION_UNIT: 1, KIND: 3 if kind.kind == "f" else 1}
    directory = lambda m: struct.calcsize(count) + m * struct.calcsize(entry + word) + struct.calcsize("<" + word)
    more = len(small) + 2
    directories = directory(more + len(shared)) + (n - 1) * directory(more)
    places, at = {}, head + directories
    for tag, (_, _, data) in shared.items():
        if len(data) > inline:
            places[tag], at = at, at + len(data) + len(data) % 2
    first_plane = at
    out, next_at = BytesIO(), head
    out.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, head) if big else struct.pack("<2sHI", b"II", 42, head))
    for p in range(n):
        own = {t: (4, 1, struct.pack("<I", v)) for t, v in small.items()} | {OFFSETS: (offset_kind, 1, struct.pack("<" + word, first_plane + p * size)), COUNTS: (offset_kind, 1, struct.pack("<" + word, size))} | (shared if p == 0 else {})
        next_at += directory(len(own))
        out.write(struct.pack(count, len(own)))
        for tag in sorted(own):
            kind_of, many, data = own[tag]
            out.write(struct.pack(entry, tag, kind_of, many) + (struct.pack("<" + word, places[tag]) if tag in places and p == 0 else data.ljust(inline, b"\0")))
        out.write(struct.pack("<" + word, next_at if p < n - 1 else 0))
    for tag, (_, _, data) in shared.items():
        if tag in places:
            out.write(data + b"\0" * (len(data) % 2))
    return out.getvalue()


class StackSource(DataSource):
    """The format ``stack``."""

    @classmethod
    def name(cls) -> str:
        return "stack"

    def schema(self) -> str:
        return PLANES if self.options.get("form") == "planes" else PIXELS

    def reader(self, schema: StructType) -> DataSourceReader:
        return (PushingStackReader if self.options.get("pushdown") == "true" else StackReader)(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return StackWriter(dict(self.options), overwrite)


def _spark_only(path: str) -> bool:
    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, OSError, ImportError):
        return True
    return False


def read_stacks(spark: SparkSession, path: str, form: str = "pixels", basename: str = "", channels: list[int] | None = None, slices: list[int] | None = None) -> DataFrame:
    """Pixels or planes of the stacks at a URI, or below it.

    Equalities on name, ch, z and frame reach the source.  Where Arrow knows no file system of the URI, Spark reads
    the files (of at most 2 GB) and tasks cut them into planes.
    """
    if _spark_only(path):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif*").load(path).select("path", "content")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for where, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    f = pa.BufferReader(content.as_buffer())
                    planes = [p for p in planes_of(f, where, basename) if (not channels or p.ch in channels) and (not slices or p.z in slices)]
                    if form == "planes":
                        yield _plane_batch(planes)
                    else:
                        for p in planes:
                            yield from _pixel_batches(p, plane_values(f, p))

        return files.mapInArrow(cut, PLANES if form == "planes" else PIXELS)
    spark.dataSource.register(StackSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("stack").option("form", form).option("basename", basename).option("pushdown", "true")
    for option, values in (("channels", channels), ("slices", slices)):
        reader = reader.option(option, ",".join(map(str, values))) if values else reader
    return reader.load(path)


def write_stacks(pixels: DataFrame, path: str, mode: str = "append", kind: str = "f4", pixel_width: float = 1.0, unit: str = "pixel") -> None:
    """Write pixel rows (name, ch, z, y, x, v and frame if there is one) as a stack for each name; stacks are dealt over the tasks.

    ``path`` is a URI of a file system that Arrow knows.  A task holds one plane at a time.
    """
    spark = pixels.sparkSession
    spark.dataSource.register(StackSource)
    pixels = pixels if "frame" in pixels.columns else pixels.withColumn("frame", F.lit(1))
    own = pixels.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in PIXELS.split(", ")])
    sizes = own.groupBy("name").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"), *[F.max(c).alias(f"n_{c}") for c in ("ch", "z", "frame")])
    dealt = own.join(sizes, "name").select(*[c.split()[0] for c in DEALT.split(", ")]).repartition("name").sortWithinPartitions("name", "frame", "z", "ch", "y", "x")
    dealt.write.format("stack").mode(mode).option("kind", kind).option("pixel_width", pixel_width).option("unit", unit).save(path)
