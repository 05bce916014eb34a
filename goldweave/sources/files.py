"""Records of files with their place: file, block of the file, line.

Files are read once. A record's place travels with it as a struct; `in_order`
turns it into numbers that do not depend on how the files were split: the line
in the file, and an arrival number over all files in the order of their paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.storage import new_folder, settle, written

# Lists with one row per file or block are broadcast up to this many rows;
# beyond, the join is left to the engine.
MAX_BROADCAST_ROWS = 20_000

PLACES = ["file", "line"]


def place() -> Column:
    """Where a row of a file scan comes from. Within one block, rows are
    numbered in the order of the file."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_lines(spark: SparkSession, paths: str | list[str], whole_files: bool = False) -> DataFrame:
    """(payload, position): lines, or whole files."""
    return spark.read.text(paths, wholetext=whole_files).select(
        F.col("value").alias("payload"), place().alias("position"))


def few(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MAX_BROADCAST_ROWS else table


def in_order(table: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table with a `position` out, and give it `file`, `line` (from 1)
    and `record_ord` in its place. A record that brings a number of its own
    keeps it; rows marked `blank` are counted as lines and left out. One row per
    block and one per file are all that is ranked."""
    spark = table.sparkSession
    if folder is None:
        rows = written(table, "records")
    else:
        table.write.parquet(folder)
        rows = spark.read.schema(table.schema).parquet(folder)
    blocks = settle(
        rows.groupBy(F.col("position.file").alias("_file"), F.col("position.block").alias("_block"))
        .agg(F.min("position.row").alias("_first"), F.count("*").alias("_n")))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.withColumn("_before", before(Window.partitionBy("_file").orderBy("_block")))
    files = blocks.groupBy("_file").agg(F.sum("_n").alias("_n"))
    # one row per file: as many as the driver lists anyway
    files = files.select("_file", before(Window.orderBy("_file")).alias("_start"))
    n_blocks = blocks.count()
    starts = starts.join(few(files, n_blocks), "_file").select("_file", "_block", "_first", "_before", "_start")
    same = (F.col("position.file") == F.col("_file")) & (F.col("position.block") == F.col("_block"))
    line = F.col("position.row") - F.col("_first") + F.col("_before") + 1
    kept = [c for c in table.columns if c not in ("position", "record_ord", "blank", *PLACES)]
    full = ~F.col("blank") if "blank" in table.columns else F.lit(True)
    own = F.col("record_ord") if "record_ord" in table.columns else F.lit(None)
    return rows.filter(full).join(few(starts, n_blocks), same).select(
        *kept[:1], F.coalesce(own, F.col("_start") + line - 1).cast("bigint").alias("record_ord"), *kept[1:],
        F.col("_file").alias("file"), line.cast("bigint").alias("line"))


# --- records of CSV files ---------------------------------------------------------

# monotonically_increasing_id counts within a partition below this bit
ROW_BITS = 33


def _one_split_each(spark: SparkSession) -> SparkSession:
    """A session in which every block of a file is a partition of its own, so
    that the first row of a file's first block is the first of its partition."""
    other = spark.newSession()
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    other.conf.set("spark.sql.files.maxPartitionBytes", size)
    other.conf.set("spark.sql.files.openCostInBytes", size)
    return other


def csv_records(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> tuple[DataFrame, int, int]:
    """(only, record, is_header, position) of CSV files, the largest number of
    names in a header, and the number of headers. A record is kept as it is written, `only` is the one
    value of a record without a separator.

    The files are read once, by one job: how many columns there are is not
    known before the headers are. So records are told apart as records with
    more than one value, which the reader keeps as written, and parsed when the
    headers are at hand.
    """
    seen = Observation()
    folder = new_folder(spark, "csv-records")
    first = (F.col("position.block") == 0) & (F.col("position.row").bitwiseAND((1 << ROW_BITS) - 1) == 0)
    commas = F.coalesce(F.length("record") - F.length(F.translate("record", ",", "")), F.lit(0))
    rows = (
        _one_split_each(spark).read.schema("only string, record string")
        .options(header=False, multiLine=multi_line, columnNameOfCorruptRecord="record", escape='"', mode="PERMISSIVE")
        .csv(paths)
        .select("only", "record", place().alias("position")).withColumn("is_header", first)
        .observe(seen, F.max(F.when(F.col("is_header"), commas + 1)).alias("width"),
                 F.count_if("is_header").alias("files"))
    )
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder), seen.get["width"] or 1, seen.get["files"]


def cells(width: int) -> Column:
    """The values of a record, null where it has fewer."""
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv("record", F.lit(", ".join(f"{n} string" for n in names)), {"escape": '"'})
    return F.when(F.col("record").isNull(), F.array("only")).otherwise(
        F.transform(F.array(parsed), lambda r: F.array(*[r[n] for n in names]))[0])
