"""Camera calibrations: XML folders beside a data set, JSON lines for all data sets, and the cascade from one to the other.

All readers give one row for each camera: camera, fx, fy, cx, cy, distortion (eight numbers), transform (three rows of four, from bird's-eye axes in
metres to the camera's), width, height, model. Files are parsed by Spark where they are read; a record that can't be parsed counts as not
there, or, for a folder of XML, makes the whole folder count as broken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Camera folders and the names of their cameras.
CAMERAS = {"fc120": "FC", "fc30": "FC_FAR", "fl": "FL", "fr": "FR", "rc": "RC", "rl": "RL", "rr": "RR"}
#: The size of the image intrinsics may be for, the share of the wanted size from which a centre shows it, the
#: translation (in millimetres) from which it isn't in metres.
LARGE, SHARE, MILLIMETRES = (3840.0, 2160.0), 0.75, 100.0
#: Intrinsics, size and model of a camera that the manifest doesn't know.
DEFAULT = {"fx": 1000.0, "fy": 1000.0, "cx": 960.0, "cy": 540.0, "width": 1920, "height": 1080, "model": "opencv_rational_8"}
FIELDS = ["fx", "fy", "cx", "cy", "distortion", "transform", "width", "height", "model"]
SUFFIX, CONVERTED = "_roll_only_3d_raw_distorted_extrinsics", "_converted"

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_MATRIX = "struct<rows:int,cols:int,data:string>"


def _numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(f"({_NUMBER})"), F.lit(1)), lambda v: v.try_cast("double"))


def _matrix(node: Column) -> Column:
    """A matrix's numbers row by row; null unless there are as many as rows times columns."""
    values = F.filter(F.transform(F.split(F.trim(F.regexp_replace(node["data"], r"\s+", " ")), " "), lambda v: v.try_cast("double")), lambda v: v.isNotNull())
    whole = (node["rows"] > 0) & (node["cols"] > 0) & (F.size(values) == node["rows"] * node["cols"])
    return F.when(whole, values)


def _padded(values: Column) -> Column:
    return F.slice(F.concat(values, F.array_repeat(F.lit(0.0), 8)), 1, F.greatest(F.size(values), F.lit(8)))


def local_calibrations(spark: SparkSession, root: str, height: int = 1080, width: int = 1920) -> DataFrame:
    """Cameras of the folders ``<root>/<data set>/calibration`` and ``<root>/calibration`` (data set ''), with ``sound``, false for all cameras of a
    folder in which one of them can't be read or none has both of its files. A folder without any XML file isn't seen."""
    files = None
    for pattern in (f"{root}/*/calibration/*/camera*.xml", f"{root}/calibration/*/camera*.xml"):
        try:
            found = spark.read.text(pattern, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
        except Exception as error:  # a pattern that no file fits
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        files = found if files is None else files.unionByName(found)
    if files is None:
        return spark.createDataFrame([], "dataset string, sound boolean, camera string, fx double, fy double, cx double, cy double, distortion array<double>, transform array<double>, width int, height int, model string")
    prefix = F.regexp_extract("path", r"([^/]*)/calibration/[^/]+/camera[^/]*\.xml$", 1)
    outer = F.col("path").rlike(f"{root.rstrip('/').rsplit('/', 1)[-1]}/calibration/[^/]+/[^/]+$")
    files = files.select(F.when(outer, "").otherwise(prefix).alias("dataset"), F.regexp_extract("path", r"([^/]+)/camera[^/]*\.xml$", 1).alias("folder"), F.regexp_extract("path", r"camera(\w+)\.xml$", 1).alias("kind"), "value")
    parsed = files.where(F.col("folder").isin(*CAMERAS)).withColumn("x", F.from_xml("value", f"camIntrinsicMat {_MATRIX}, distortion_coefficients {_MATRIX}, extrinsicMatrix {_MATRIX}"))
    one = lambda kind, node: F.max(F.when(F.col("kind") == kind, _matrix(F.col(f"x.{node}"))))
    has = lambda kind: F.max(F.col("kind") == kind)
    rows = F.max(F.when(F.col("kind") == "Extrinsic", F.struct("x.extrinsicMatrix.rows", "x.extrinsicMatrix.cols")))
    cameras = parsed.groupBy("dataset", "folder").agg(one("Intrinsic", "camIntrinsicMat").alias("k"), one("Intrinsic", "distortion_coefficients").alias("d"), one("Extrinsic", "extrinsicMatrix").alias("t"), rows.alias("shape"), (has("Intrinsic") & has("Extrinsic")).alias("both"))
    fits = F.col("shape.cols").eqNullSafe(F.lit(4)) & F.col("shape.rows").isin(3, 4)
    good = F.col("k").isNotNull() & (F.size("k") >= 6) & F.col("t").isNotNull() & fits
    folder = Window.partitionBy("dataset")
    sound = F.coalesce(F.min(F.when(F.col("both"), F.coalesce(good, F.lit(False)))).over(folder), F.lit(False))
    cameras = cameras.withColumn("sound", sound)
    # Without a camera that has both of its files the folder still counts, as broken.
    cameras = cameras.where(F.col("both") | ~F.col("sound"))
    k = lambda i: F.get("k", F.lit(i))
    large = (k(2) > width * SHARE) & (k(5) > height * SHARE)
    scaled = lambda v, wanted, full: F.when(large, v * (wanted / full)).otherwise(v)
    moved = F.array(*(F.get("t", F.lit(i)) for i in (3, 7, 11)))
    unit = F.when(F.array_max(F.transform(moved, F.abs)) > MILLIMETRES, 0.001).otherwise(1.0)
    transform = F.transform(F.slice("t", 1, 12), lambda v, i: F.when(i % 4 == 3, v * unit).otherwise(v))
    name = F.element_at(F.create_map(*[F.lit(v) for pair in CAMERAS.items() for v in pair]), F.col("folder"))
    return cameras.select(
        "dataset",
        "sound",
        name.alias("camera"),
        scaled(k(0), width, LARGE[0]).alias("fx"),
        scaled(k(4), height, LARGE[1]).alias("fy"),
        scaled(k(2), width, LARGE[0]).alias("cx"),
        scaled(k(5), height, LARGE[1]).alias("cy"),
        _padded(F.coalesce("d", F.array_repeat(F.lit(0.0), 8))).alias("distortion"),
        transform.alias("transform"),
        F.lit(width).alias("width"),
        F.lit(height).alias("height"),
        F.lit(DEFAULT["model"]).alias("model"),
    )


def camera_models(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest's cameras, or no rows where there is no manifest."""
    fields = "fx double, fy double, cx double, cy double, distortion_coefficients_k1_k2_p1_p2_k3_k4_k5_k6 array<double>, raw_image_width int, raw_image_height int, distortion_model string"
    schema = f"camera_models map<string, struct<{fields.replace(' double', ':double').replace(' array', ':array').replace(' int', ':int').replace(' string', ':string')}>>"
    try:
        text = spark.read.text(f"{folder}/manifest.json", wholetext=True)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        text = spark.createDataFrame([], "value string")
    return text.select(F.explode(F.from_json("value", schema)["camera_models"]).alias("camera", "m")).select("camera", "m.*")


def global_calibrations(spark: SparkSession, folder: str) -> DataFrame:
    """Cameras of all records of ``<folder>/<data set><SUFFIX>.jsonl``: file_dataset, dataset, segment, timestamp (0 where there is none), place (an order of a
    file's records) and the camera's columns. A camera that the manifest doesn't name has the default model."""
    lines = spark.read.text(f"{folder}/*{SUFFIX}.jsonl").select(
        "value",
        F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*){SUFFIX}\.jsonl$", 1).alias("file_dataset"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("place"),
    )
    record = F.from_json("value", "dataset string, segment string, timestamp long, cameras map<string, struct<T_bev_m_to_camera_m_3x4:string>>")
    records = lines.where(F.trim("value") != "").select("file_dataset", "place", record.alias("r"))
    cameras = records.select("file_dataset", "r.dataset", F.coalesce("r.segment", F.lit("")).alias("segment"), F.coalesce("r.timestamp", F.lit(0)).alias("timestamp"), "place", F.explode("r.cameras").alias("camera", "c"))
    cameras = cameras.withColumn("transform", _numbers(F.col("c.T_bev_m_to_camera_m_3x4"))).where(F.size("transform") == 12).drop("c")
    models = camera_models(spark, folder).withColumn("known", F.lit(True))
    met = cameras.join(models, "camera", "left")
    model = lambda name, column=None: F.when(F.col("known"), F.col(name) if column is None else F.coalesce(column, F.lit(DEFAULT[name]))).otherwise(F.lit(DEFAULT[name]))
    coefficients = F.coalesce("distortion_coefficients_k1_k2_p1_p2_k3_k4_k5_k6", F.array().cast("array<double>"))
    return met.select(
        *["file_dataset", "dataset", "segment", "timestamp", "place", "camera"],
        *[model(c).alias(c) for c in ("fx", "fy", "cx", "cy")],
        _padded(coefficients).alias("distortion"),
        "transform",
        model("width", F.col("raw_image_width")).alias("width"),
        model("height", F.col("raw_image_height")).alias("height"),
        model("model", F.col("distortion_model")).alias("model"),
    )


def _at_first(rows: DataFrame, by: list[str], order) -> DataFrame:
    """The rows of the first record of each group."""
    first = rows.groupBy(*by).agg(F.min(order).alias("_first"))
    met = rows.join(first, by)
    return met.where(order == F.col("_first")).drop("_first")


def of_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Cameras of each segment's first record; records that name another data set than their file don't count."""
    own = global_calibrations(spark, folder).where("dataset = file_dataset")
    return _at_first(own, ["dataset", "segment"], F.col("place")).drop("file_dataset", "timestamp", "place")


def timed(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, segment, timestamp, cameras): all calibrations by the file's data set; of two records of one time the later one stands."""
    rows = global_calibrations(spark, folder)
    packed = rows.groupBy(F.col("file_dataset").alias("dataset"), "segment", "timestamp", "place").agg(F.sort_array(F.collect_list(F.struct("camera", *FIELDS))).alias("cameras"))
    return packed.groupBy("dataset", "segment", "timestamp").agg(F.max_by("cameras", "place").alias("cameras"))


def nearest_in_time(samples: DataFrame, calibrations: DataFrame, by: list[str], ts: str, at: str, values: list[str]) -> DataFrame:
    """``samples`` with the ``values`` of the calibration of their group that is nearest in time, the earlier of two equally near ones. A segment has few
    calibrations and may have very many samples: the times of a group become one sorted array, which its samples search, so samples aren't sorted
    and a hot segment is split as any join is. Samples of a group without calibrations drop out."""
    lists = calibrations.where(F.col(at).isNotNull()).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(at).cast("long").alias("at"), *values))).alias("_known"))
    met = samples.join(lists, by)
    nearest = F.reduce("_known", F.get("_known", F.lit(0)), lambda best, c: F.when(F.abs(c["at"] - F.col(ts)) < F.abs(best["at"] - F.col(ts)), c).otherwise(best))
    picked = met.withColumn("_nearest", nearest)
    return picked.select(*samples.columns, *[F.col(f"_nearest.{v}").alias(v) for v in values])


def resolved(segments: DataFrame, local: DataFrame, segment_wise: DataFrame, files: DataFrame) -> DataFrame:
    """Cameras for each (dataset, segment): those of the first folder that is there, out of the data set's own, that of its name with or
    without ``_converted``, and the outer one, if that folder is sound; else those of the JSON lines of the data set, or of its name without ``_converted``
    where it has no file, for that segment. ``files`` are the data sets with a file. Adds ``origin``, xml or jsonl. Segments without any are left out, and
    told of by an anti join with the result."""
    segments = segments.select("dataset", "segment").distinct()
    stripped = F.regexp_replace("dataset", f"{CONVERTED}$", "")
    toggled = F.when(F.col("dataset").endswith(CONVERTED), stripped).otherwise(F.concat("dataset", F.lit(CONVERTED)))
    names = segments.select("dataset").distinct()
    folders = local.groupBy(F.col("dataset").alias("_folder")).agg(F.first("sound").alias("sound"))
    tried = names.select("dataset", F.posexplode(F.array("dataset", toggled, F.lit(""))).alias("rank", "_folder")).join(folders, "_folder")
    chosen = tried.groupBy("dataset").agg(F.min(F.struct("rank", "_folder", "sound")).alias("c")).select("dataset", "c._folder", "c.sound")
    xml = segments.join(chosen.where("sound"), "dataset").join(local.drop("sound").withColumnRenamed("dataset", "_folder"), "_folder")
    there = files.select(F.col("dataset").alias("_file")).distinct()
    asked = names.join(chosen.where("sound"), "dataset", "left_anti").select("dataset", F.posexplode(F.array_distinct(F.array("dataset", stripped))).alias("rank", "_file")).join(there, "_file")
    picked = asked.groupBy("dataset").agg(F.min(F.struct("rank", "_file")).alias("c")).select("dataset", F.col("c._file").alias("_file"))
    lines = segments.join(picked, "dataset").join(segment_wise.withColumnRenamed("dataset", "_file"), ["_file", "segment"])
    columns = ["dataset", "segment", "camera", *FIELDS]
    return xml.select(*columns, F.lit("xml").alias("origin")).unionByName(lines.select(*columns, F.lit("jsonl").alias("origin")))


def for_segments(spark: SparkSession, segments: DataFrame, root: str | None, folder: str, height: int = 1080, width: int = 1920) -> DataFrame:
    """``resolved`` over the folders under ``root`` (None: none) and the JSON lines in ``folder``."""
    local = local_calibrations(spark, root or f"{folder}/.none", height, width)
    whole = of_segments(spark, folder)
    files = spark.read.format("binaryFile").load(f"{folder}/*{SUFFIX}.jsonl").select(F.regexp_extract("path", rf"([^/]+){SUFFIX}\.jsonl$", 1).alias("dataset"))
    return resolved(segments, local, whole, files)
