"""Readers and writers of outline and measurement tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.geometry import hilbert
from ..functions.labels import clean_name, parse_labels
from ..operators.numbering import numbered
from ..plans.scratch import materialize
from .appends import Append, Folder, append_rows, committed_folders, history

OUTLINE = T.StructType([T.StructField("name", T.StringType()), T.StructField("roi", T.StringType()), T.StructField("z", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def _text(spark: SparkSession, path: str | list[str], pattern: str | None):
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"')
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def read_outlines(spark: SparkSession, path: str | list[str], pattern: str | None = None, regex: str | None = None, white_space: bool = False, version: int | None = None) -> DataFrame:
    """Vertex rows of outline files (tab separated, header) with ``ord``, the order within a file, and ``path``.

    ``pattern``: a glob that file names must match; ``regex``: searched for in the whole path.  ``white_space``: any
    white space separates.  A table that was appended to has the rows of its committed appends (up to ``version``),
    and holds its row number in ``idx``, which then is the order.
    """
    if isinstance(path, str):
        path = committed_folders(spark, path, version) or path
    raw = read_white_space(spark, path, pattern) if white_space else _text(spark, path, pattern).csv(path)
    own = raw.columns
    kinds = {f.name: f.dataType for f in OUTLINE}
    columns = [F.col(c).cast(kinds.get(c, T.LongType() if c == "idx" else T.StringType())).alias(c) for c in own if c not in ("path", "_place")]
    place = [F.col("path"), F.col("_place")] if white_space else [F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("_place")]
    df = raw.select(*columns, *place)
    df = df.where(F.col("path").rlike(regex)) if regex else df
    return df.withColumnRenamed("_place", "ord") if "idx" not in own else df.withColumn("ord", F.col("idx")).drop("_place")


#: A value in quotes, or one without white space.
_VALUE = r"""("[^"]*"|'[^']*'|\S+)"""


def read_white_space(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Files of values that any white space separates, quotes around values that hold some, all with one header.

    Columns are strings, with ``path`` and ``_place``, the order within a file.  Where rows have one value more than the
    header, the first is the row's name and is left out.  Empty lines are; the word NA and missing values are null.
    """
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    lines = reader.text(path).select(F.regexp_extract_all("value", F.lit(_VALUE), F.lit(1)).alias("_v"), F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("_place"))
    lines = lines.where(F.size("_v") > 0).withColumn("_v", F.transform("_v", lambda v: F.when(v.rlike("^[\"']"), F.substring(v, 2, F.greatest(F.length(v) - 2, F.lit(0)))).otherwise(v)))
    head = lines.orderBy("path", "_place").select("_v").first()
    if head is None:
        raise ValueError(f"{path}: no header")
    names = head["_v"]
    first = F.when(F.size("_v") == len(names) + 1, 1).otherwise(0)
    value = lambda k: F.get("_v", first + k)
    rows = lines.where(F.col("_v") != F.array(*map(F.lit, names)))
    return rows.select(*[F.when(value(k) != "NA", value(k)).alias(n) for k, n in enumerate(names)], "path", "_place")


def write_outlines(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """Vertices as tab separated text with a header; ``compression``: a codec of the files, which their names then end with."""
    df.write.mode(mode).option("sep", "\t").option("header", True).option("compression", compression).csv(path)


def in_file_order(df: DataFrame) -> DataFrame:
    """Rows that :func:`read_outlines` gave with ``ord``, the order of all rows by path and place, instead of a path in each."""
    spark = df.sparkSession
    files = spark.createDataFrame(list(enumerate(sorted(df.inputFiles()))), "_file int, _path string")
    # file:/x and file:///x are one file
    plain = lambda c: F.regexp_replace(c, "^([^/:]+):/+", "$1:/")
    placed = df.join(F.broadcast(files), plain(df["path"]) == plain(files["_path"]), "left")
    file = F.coalesce("_file", F.raise_error(F.concat(F.lit("no file of the table: "), "path")).cast("int"))
    return placed.select(*[c for c in df.columns if c not in ("path", "ord")], F.struct(file.alias("file"), "ord").alias("ord"))


def append_outlines(spark: SparkSession, df: DataFrame, path: str, transaction: str | None = None) -> Append:
    """Append vertices to a table whose ``idx`` numbers its rows, going on from its largest number: all of them, or none.

    ``transaction``: a name under which rows are appended once, however often it is tried.
    """
    numbers = materialize(numbered(df, [], ["ord"], "_number"), "appended")
    columns = [c for c in df.columns if c not in ("idx", "ord", "path")]

    def write(folder: str, first: int) -> None:
        write_outlines(numbers.select((F.col("_number") - 1 + first).alias("idx"), *columns), folder)

    first = None
    if not history(spark, path) and Folder(spark, path).names():
        first = read_outlines(spark, path).agg(F.coalesce(F.max("idx") + 1, F.lit(0))).first()[0]
    return append_rows(spark, path, numbers.count(), write, transaction, first)


def _on_curve(df: DataFrame, bits: int = 16) -> DataFrame:
    """``df`` with ``curve``, the place of each box's centre along a space-filling curve over all boxes."""
    ends = df.agg(F.min("xmin").alias("_x0"), F.max("xmax").alias("_x1"), F.min("ymin").alias("_y0"), F.max("ymax").alias("_y1"))
    cell = lambda a: F.least(F.floor(F.coalesce(F.try_divide((F.col(f"{a}min") + F.col(f"{a}max")) / 2 - F.col(f"_{a}0"), F.col(f"_{a}1") - F.col(f"_{a}0")), F.lit(0.0)) * (1 << bits)), F.lit((1 << bits) - 1))
    return df.join(F.broadcast(ends)).withColumn("curve", hilbert(cell("x"), cell("y"), bits)).drop("_x0", "_x1", "_y0", "_y1")


def write_polygons(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """Measured ROI polygons as Parquet, by position and within it along a space-filling curve.

    A file's polygons lie close together, so the smallest and largest values that Parquet keeps of their boxes
    rule out most files and row groups for a query of an area.  ``files``: about how many there are, one for each
    shuffle partition unless given; a position of any size is spread over several.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges are drawn from a first look at all places on the curve, which itself takes one for the extent
    placed = materialize(_on_curve(materialize(df, "polygons")), "placed")
    dealt = placed.repartitionByRange(files, "name", "curve", "z").sortWithinPartitions("name", "curve", "z")
    dealt.drop("curve").write.mode(mode).partitionBy("name").parquet(path)


def read_polygons(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, names: list[str] | None = None) -> DataFrame:
    """Polygons of a written table; ``box`` (xmin, ymin, xmax, ymax): those whose boxes meet it, the border included."""
    df = spark.read.option("mergeSchema", "false").parquet(path)
    df = df.withColumn("name", F.col("name").cast("string"))
    df = df.where(F.col("name").isin(names)) if names else df
    if box is None:
        return df
    x0, y0, x1, y1 = map(float, box)
    return df.where((F.col("xmax") >= x0) & (F.col("xmin") <= x1) & (F.col("ymax") >= y0) & (F.col("ymin") <= y1))


def _is_row_number(df: DataFrame, column: str) -> bool:
    """Whether a column holds 1, 2, ... in the order of the rows of a table just read.

    One look at it: in each piece of a file numbers go up with the rows' places, and a piece begins where those before it end.
    """
    placed = df.select(F.col(f"`{column}`").cast("double").alias("_own"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_place"))
    ahead = F.col("_own") - F.col("_place")
    pieces = placed.groupBy("_path", "_start").agg(F.count("*").alias("_rows"), F.count("_own").alias("_own_rows"), F.min("_own").alias("_first"), F.min(ahead).alias("_lo"), F.max(ahead).alias("_hi"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fine = (F.col("_own_rows") == F.col("_rows")) & (F.col("_first") == before + 1) & (F.col("_lo") == F.col("_hi"))
    # a row for each piece of a file: few
    return bool(pieces.select(F.coalesce(fine, F.lit(False)).alias("fine")).agg(F.bool_and("fine")).first()[0])


def read_measurements(spark: SparkSession, path: str | list[str], parse: bool = True) -> DataFrame:
    """A measurement table (tab separated, header): names cleaned, a leading row number dropped, labels parsed.

    The first column is a row number if it holds exactly 1 to the number of rows, in order.
    """
    df = _text(spark, path, None).option("inferSchema", True).csv(path)
    df = df.drop(df[f"`{df.columns[0]}`"]) if _is_row_number(df, df.columns[0]) else df
    df = df.toDF(*[clean_name(c) for c in df.columns])
    return parse_labels(df) if parse and "label" in df.columns else df


def write_measurements(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_outlines(df, path, mode)


def path_list(folder: str, names: dict[str, str]) -> dict[str, str]:
    """Named paths of base names in a folder."""
    return {k: f"{folder.rstrip('/')}/{v}" for k, v in names.items()}
