"""Text and JSON-line files of windows and centres, read by Spark and parsed with SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of a window's line before its coordinates.
HEAD = 5


def _tokens(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"\s+", " ")).alias("line"))
    return lines.where("line <> '' AND NOT startswith(line, '#')").select("line", F.split("line", " ").alias("t"))


def _numbers(tokens: Column, first: int, count: Column | int) -> Column:
    return F.transform(F.slice(tokens, first, count), lambda v: v.cast("double"))


def _window(width: Column) -> list[Column]:
    t = F.col("t")
    head = [t[0].cast("long").alias("traj_id"), t[1].alias("dataset"), t[2].alias("clip"), t[3].cast("long").alias("t0_us"), t[4].cast("int").alias("t0_index")]
    return [*head, _numbers(t, HEAD + 1, width).alias("xy")]


def future_windows(spark: SparkSession, path: str, steps: int, strict: bool = True) -> DataFrame:
    """Windows of lines ``traj_id dataset clip t0_us t0_index x0 y0 ...``; blank and ``#`` lines are passed
    over. A strict read fails on a line of another width when its rows are computed; a lenient one takes the
    first ``steps`` points of longer lines and leaves shorter ones out."""
    rows, width = _tokens(spark, path), HEAD + 2 * steps
    if strict:
        said = F.concat(F.lit("Bad row with "), F.size("t").cast("string"), F.lit(" columns: "), F.substring("line", 1, 120))
        rows = rows.withColumn("t", F.when(F.size("t") == width, F.col("t")).otherwise(F.raise_error(said)))
    else:
        rows = rows.where(F.size("t") >= width)
    return rows.select(*_window(F.lit(2 * steps)))


def windows_with_horizon(spark: SparkSession, path: str, steps: int) -> DataFrame:
    """As the lenient read, with all points of the line in ``compare_xy``."""
    rows = _tokens(spark, path).where(F.size("t") >= HEAD + 2 * steps)
    return rows.select(*_window(F.lit(2 * steps)), _numbers(F.col("t"), HEAD + 1, F.size("t") - HEAD).alias("compare_xy"))


def centres(spark: SparkSession, path: str) -> DataFrame:
    """Centres of lines ``CENTER id count x0 y0 ...``; other lines are passed over."""
    t = F.col("t")
    rows = _tokens(spark, path).where(t[0] == "CENTER")
    return rows.select(t[1].cast("int").alias("center_id"), t[2].cast("long").alias("count"), _numbers(t, 4, F.size("t") - 3).alias("xy")).orderBy("center_id")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-line file; malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def last_of_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with one key, the one that was read last."""
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    value = F.max_by(F.struct(*rows.columns), F.col("_at")).alias("row")
    return numbered.groupBy(*keys).agg(value).select("row.*")


def window_lines(rows: DataFrame) -> DataFrame:
    """One text column ``value``: the lines that ``future_windows`` reads, coordinates to 6 decimals."""
    xy = F.transform("xy", lambda v: F.format_string("%.6f", v))
    return rows.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in ("traj_id", "dataset", "clip", "t0_us", "t0_index")], F.array_join(xy, " ")).alias("value"))


def write_clips(rows: DataFrame, path: str, order: tuple[str, ...] = ("t0_us", "sample_idx")) -> None:
    """Parquet by dataset and clip, each file in ``order``. The clips written are overwritten, others stay."""
    dealt = rows.repartition("dataset", "clip").sortWithinPartitions("dataset", "clip", *order)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "clip").parquet(path)
