"""Reading frames, labels, detections, annotations and dimension tables.

Row order of a file is kept as ``row_idx``: each file is one row of text or bytes
first, so the index is exact and files are read in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REQUIRED = ("x", "y", "z", "intensity")
OPTIONAL = ("azimuth", "vertical", "distance", "reflectivity", "slot", "pixel", "block_id", "cxd", "cyd", "timestamp")


def stem_of(path: str = "path") -> Column:
    """The file's name without its suffix."""
    return F.regexp_extract(F.col(path), r"([^/]+?)(\.[^./]+)?$", 1)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of each file, through Spark's reader only."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def point_csv(spark: SparkSession, path: str, columns: Sequence[str] = (*REQUIRED, *OPTIONAL)) -> DataFrame:
    """SRC1 to SRC3: points of CSV files with tab, comma or white space between fields, told by each header.

    Names match in any case, ``blockid`` is ``block_id``. Blank lines are skipped; a
    short row or a field that is no number raises. Distance and reflectivity are derived where absent.
    """
    files = whole_texts(spark, path)
    lines = F.filter(F.split("text", r"\r?\n"), lambda line: F.trim(line) != "")
    head = F.try_element_at("lines", F.lit(1))
    by = F.when(F.instr(head, "\t") > 0, "\t").when(F.instr(head, ",") > 0, ",").otherwise("\\s+")
    cut = lambda line: F.transform(F.split(F.trim(line), F.col("by")), lambda x: F.trim(x))
    named = files.withColumn("lines", lines).withColumn("by", by)
    header = F.transform(cut(F.try_element_at("lines", F.lit(1))), lambda n: F.regexp_replace(F.lower(n), "^blockid$", "block_id"))
    rows = named.withColumn("header", header).select("path", "by", "header", F.posexplode(F.slice("lines", 2, 1 << 30)).alias("row_idx", "line"))
    cells = rows.withColumn("cells", F.split(F.trim("line"), F.col("by")))
    whole = cells.withColumn("checked", F.when(F.size("cells") < F.size("header"), F.raise_error(F.concat(F.lit("short row in "), "path"))).otherwise(F.lit(0)))

    def value(name: str) -> Column:
        at = F.array_position("header", name)
        missing = F.raise_error(F.concat(F.lit(f"no column {name} in "), F.col("path"))) if name in REQUIRED else F.lit(None)
        return F.when(at > 0, F.trim(F.try_element_at("cells", at.cast("int"))).cast("double")).otherwise(missing.cast("double"))

    out = whole.select(stem_of().alias("frame_id"), F.col("row_idx").cast("bigint"), *[value(c).alias(c) for c in columns], "checked").where("checked = 0").drop("checked")
    if "distance" in columns:
        out = out.withColumn("distance", F.coalesce("distance", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))))
    if "reflectivity" in columns:
        out = out.withColumn("reflectivity", F.coalesce("reflectivity", "intensity"))
    return out


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")


def float_records(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """SRC4, SRC6: little-endian float32 records of files; a file whose size doesn't divide raises."""
    return decoded_floats(binary_files(spark, path), fields)


def decoded_floats(contents: DataFrame, fields: Sequence[str]) -> DataFrame:
    """SRC4, SRC6: the records of (path, content) rows."""
    n = len(fields)

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path_, data in zip(part["path"], part["content"]):
                if len(data) % (4 * n):
                    raise ValueError(f"{path_}: {len(data)} bytes are no whole records of {n} floats")
                values = np.frombuffer(data, "<f4").reshape(-1, n).astype("f8")
                yield pd.DataFrame(values, columns=list(fields)).assign(path=path_, row_idx=np.arange(len(values)))[["path", "row_idx", *fields]]

    schema = "path string, row_idx bigint, " + ", ".join(f"`{f}` double" for f in fields)
    return contents.mapInPandas(decode, schema).select(stem_of().alias("frame_id"), "row_idx", *fields)


def organised_frames(contents: DataFrame, fields: Sequence[str], rows: int = 192, columns: int = 480) -> DataFrame:
    """SRC6: frames of ``rows`` x ``columns`` records, in (path, content) rows: frame_id, ring, column and the fields; a file of another size raises."""
    size = F.octet_length("content")
    wrong = F.raise_error(F.concat("path", F.lit(": "), size.cast("string"), F.lit(f" bytes are no frame of {rows} x {columns} records of {len(fields)} floats"))).cast("boolean")
    whole = contents.where(F.when(size == 4 * len(fields) * rows * columns, True).otherwise(wrong))
    place = F.col("row_idx")
    return decoded_floats(whole, fields).select("frame_id", F.floor(place / columns).cast("bigint").alias("ring"), (place % columns).alias("column"), *fields)


#: Pixels and echoes of a packet slot, and the layout of one record.
SLOT_PIXELS, ECHOES = 128, 3
RECORD = np.dtype([("distance", "<f4"), ("intensity", "<f4"), ("reflectivity", "<f4"), ("azimuth", "<f4"), ("vertical", "<f4"), ("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("rest", "V20")])


def packet_frames(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: frames of packet files."""
    return decoded_packets(binary_files(spark, path))


def decoded_packets(contents: DataFrame) -> DataFrame:
    """SRC5: frames with a 16-byte header (width, height), then slots of 128 pixels by 3 echoes of 52-byte records; a cut tail ends the frame."""
    names = [n for n in RECORD.names if n != "rest"]

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path_, data in zip(part["path"], part["content"]):
                whole = max(0, len(data) - 16) // RECORD.itemsize
                for at in range(0, max(1, whole), RECORDS):
                    k = np.arange(at, min(at + RECORDS, whole))
                    rows = np.frombuffer(data, RECORD, count=len(k), offset=16 + at * RECORD.itemsize) if len(k) else np.zeros(0, RECORD)
                    slot, pixel, echo = k // (SLOT_PIXELS * ECHOES), k // ECHOES % SLOT_PIXELS, k % ECHOES
                    yield pd.DataFrame({"path": path_, "row_idx": k, "slot": slot, "pixel": pixel, "block_id": echo, **{n: rows[n].astype("f8") for n in names}})

    schema = "path string, row_idx bigint, slot bigint, pixel bigint, block_id bigint, " + ", ".join(f"{n} double" for n in names)
    return contents.mapInPandas(decode, schema).withColumn("frame_id", stem_of()).drop("path")


def packet_csv_points(wide: DataFrame, beams: int, row: str = "row_idx") -> DataFrame:
    """SRC7, SRC8: a wide packet table (dis0.., int0.., ref0..) as one row per beam.

    Distances below 0 are 0; azimuth and elevation run evenly over the fields of view.
    """
    arrays = [F.array(*[F.col(f"{p}{k}").cast("double") for k in range(beams)]).alias(p) for p in ("dis", "int", "ref")]
    long = wide.select("frame_id", row, *arrays).select("frame_id", row, F.posexplode(F.arrays_zip("dis", "int", "ref")).alias("beam", "c"))
    n = F.count("*").over(Window.partitionBy("frame_id", "beam"))
    azimuth = F.radians(-60 + 120 * F.col(row) / F.greatest(n - 1, F.lit(1)))
    elevation = F.radians(F.lit(-12.5) + 25.0 * F.col("beam") / max(1, beams - 1))
    d = F.greatest(F.lit(0.0), F.col("c.dis"))
    return long.select(
        "frame_id", F.col(row).alias("azimuth_idx"), "beam", (d * F.cos(elevation) * F.cos(azimuth)).alias("x"), (d * F.cos(elevation) * F.sin(azimuth)).alias("y"), (d * F.sin(elevation)).alias("z"),
        F.col("c.int").alias("strength"), F.col("c.ref").alias("reflectivity"),
    )


def npy_pixels(spark: SparkSession, path: str, value: str = "label") -> DataFrame:
    """SRC9, SRC11: array files as long rows."""
    return decoded_arrays(binary_files(spark, path), value)


def decoded_arrays(contents: DataFrame, value: str = "label") -> DataFrame:
    """SRC9, SRC11: ``.npy`` arrays, one or two dimensional, and ``.label`` files of uint32, as long rows."""
    import io

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path_, data in zip(part["path"], part["content"]):
                a = np.frombuffer(data, "<u4") if path_.endswith(".label") else np.load(io.BytesIO(data), allow_pickle=False)
                if a.ndim not in (1, 2):
                    raise ValueError(f"{path_}: {a.ndim} dimensions")
                a = a.reshape(-1, a.shape[-1])
                v, u = np.divmod(np.arange(a.size), a.shape[1])
                yield pd.DataFrame({"path": path_, "v": v, "u": u, value: a.reshape(-1).astype("f8")})

    return contents.mapInPandas(decode, f"path string, v bigint, u bigint, `{value}` double").withColumn("frame_id", stem_of())


def label_files(found: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """SRC9: of each frame's label files (frame_id, kind, path) the kind that comes first in ``kinds``."""
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    return found.where(rank > 0).groupBy("frame_id").agg(F.min_by(F.struct("kind", "path"), rank).alias("f")).select("frame_id", "f.*")


#: Masks of an archive, and records of a packet file, that a task unpacks at a time.
MASKS, RECORDS = 1024, 1 << 16


def detection_archives(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: detections of archive files."""
    return decoded_archives(binary_files(spark, path))


def decoded_archives(contents: DataFrame) -> DataFrame:
    """SRC12: ``.npz`` archives of masks, scores and labels as runs of each detection; lengths that differ raise.

    Masks leave an archive ``MASKS`` at a time, so that memory goes with its packed size.
    """
    import io
    import zipfile

    def planes(data: bytes, path_: str, n: int) -> Iterator[tuple[int, np.ndarray]]:
        with zipfile.ZipFile(io.BytesIO(data)) as z, z.open("masks.npy") as stream:
            version = np.lib.format.read_magic(stream)
            shape, fortran, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(stream)
            if len(shape) != 3 or shape[0] != n:
                raise ValueError(f"{path_}: masks, scores and labels differ in number")
            if fortran or kind.hasobject:  # not laid out mask by mask
                yield 0, np.load(io.BytesIO(data), allow_pickle=False)["masks"].astype(bool)
                return
            size = shape[1] * shape[2] * kind.itemsize
            for at in range(0, n, MASKS):
                count = min(MASKS, n - at)
                held = stream.read(count * size)
                if len(held) != count * size:
                    raise ValueError(f"{path_}: masks end early")
                yield at, np.frombuffer(held, kind).reshape(count, *shape[1:]).astype(bool)

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path_, data in zip(part["path"], part["content"]):
                z = np.load(io.BytesIO(data), allow_pickle=False)
                scores, labels = z["scores"], z["labels"]
                if len(scores) != len(labels):
                    raise ValueError(f"{path_}: masks, scores and labels differ in number")
                for at, masks in planes(data, path_, len(scores)):
                    edge = np.diff(np.pad(masks.astype(np.int8), ((0, 0), (0, 0), (1, 1))), axis=2)
                    d, v, u0 = np.nonzero(edge == 1)
                    u1 = np.nonzero(edge == -1)[2]
                    d = d + at
                    yield pd.DataFrame({"path": path_, "det_id": d, "label": [str(labels[k]) for k in d], "score": scores[d].astype("f8"), "v": v, "u0": u0, "u1": u1})

    return contents.mapInPandas(decode, "path string, det_id bigint, label string, score double, v bigint, u0 bigint, u1 bigint").withColumn("image_id", stem_of())


def frame_index(frames: DataFrame, key: str = "frame_id") -> DataFrame:
    """SRC13: ordinals of the sorted frame names. Only the distinct names are ranked, never points."""
    names = frames.select(key).distinct()
    return names.withColumn("frame_ord", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key)) - 1).cast("bigint"))


WRAPPERS = ("objects", "annotations", "labels", "items", "data", "result", "results")


def annotations(spark: SparkSession, path: str, wrappers: Sequence[str] = WRAPPERS) -> DataFrame:
    """SRC14: manual annotations from a JSON array, an object that wraps one, or JSON lines; (frame_id, object_index, object)."""
    files = whole_texts(spark, path).withColumn("v", F.try_parse_json("text"))
    lined = F.try_parse_json(F.concat(F.lit("["), F.array_join(F.filter(F.split("text", r"\r?\n"), lambda x: F.trim(x) != ""), ","), F.lit("]")))
    first = F.col("v")
    inner = F.coalesce(*[F.try_variant_get(first, f"$.{w}", "variant") for w in wrappers])
    deeper = F.coalesce(*[F.try_variant_get(inner, f"$.{w}", "variant") for w in wrappers])
    is_list = lambda c: F.schema_of_variant(c).startswith("ARRAY")
    payload = F.when(is_list(first), first).when(is_list(inner), inner).when(is_list(deeper), deeper).otherwise(lined)
    objects = F.try_variant_get(payload, "$", "array<variant>")
    return files.select(stem_of().alias("frame_id"), F.posexplode(objects).alias("object_index", "object"))


def delimited_map(spark: SparkSession, path: str, columns: Sequence[str], by: str = ">>") -> DataFrame:
    """SRC16: lines of ``>>``-separated values, all of them non-empty; others raise."""
    rows = spark.read.text(path).where(F.trim("value") != "").withColumn("c", F.transform(F.split("value", by), lambda x: F.trim(x)))
    good = (F.size("c") == len(columns)) & ~F.exists("c", lambda x: x == "")
    checked = rows.withColumn("ok", F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad line: "), "value")).cast("boolean"))).where("ok")
    return checked.select(*[F.element_at("c", k + 1).alias(n) for k, n in enumerate(columns)])


def timestamps_csv(spark: SparkSession, path: str, index: str, stamp: str, unit: str) -> DataFrame:
    """SRC17: frame indexes and whole microseconds."""
    from pointloom.functions.scalars import microseconds

    rows = spark.read.option("header", True).csv(path)
    return rows.select(F.col(index).cast("bigint").alias("frame_index"), microseconds(F.col(stamp).cast("double"), unit).alias("ts_us"))


def pose_log(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """SRC18: inertial poses; time is secs * 1e6 + nsecs div 1000."""
    rows = spark.read.option("header", True).option("sep", sep).csv(path)
    numbers = [c for c in rows.columns if c not in ("secs", "nsecs")]
    return rows.select((F.col("secs").cast("bigint") * 1_000_000 + F.floor(F.col("nsecs").cast("bigint") / 1000)).alias("ts_us"), *[F.col(c).cast("double").alias(c) for c in numbers])


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC19: JSON lines of a known schema; a line that is no object raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def frame_logs(spark: SparkSession, path: str, schema: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC20: logs found in all folders below, and the malformed ones; ``strict`` raises for these."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", schema).alias("log"), "value")
    bad = F.col("log").isNull() | F.forall(F.array(*[F.col(f"log.{n.split()[0]}").isNull() for n in schema.split(",")[:1]]), lambda x: x)
    if strict:
        raw = raw.withColumn("log", F.when(bad, F.raise_error(F.concat(F.lit("malformed log "), "path")).cast(raw.schema["log"].dataType)).otherwise(F.col("log")))
        return raw.select("path", "log.*"), raw.where("false").select("path", "value")
    return raw.where(~bad).select("path", "log.*"), raw.where(bad).select("path", "value")


def images(spark: SparkSession, path: str, suffixes: str = "*.{jpg,jpeg,png,bmp}", recursive: bool = True) -> DataFrame:
    """SRC21: (path, stem, suffix) of image files, without their contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", suffixes).option("recursiveFileLookup", recursive).load(path).select("path")
    return files.select("path", stem_of().alias("stem"), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("suffix"))


def doubled_stems(found: DataFrame) -> DataFrame:
    """SRC21: stems that several images have."""
    return found.groupBy("stem").agg(F.count("*").alias("n")).where("n > 1")


def dimension(spark: SparkSession, rows: Sequence[tuple], schema: str, unique: Sequence[str] = ()) -> DataFrame:
    """SRC22: a small table from configuration; a value twice in a ``unique`` column raises."""
    df = spark.createDataFrame(list(rows), schema)
    for c in unique:
        k = df.columns.index(c)
        values = [r[k] for r in rows]
        if len(set(values)) != len(values):
            raise ValueError(f"{c} holds a value twice")
    return df


def dimension_file(spark: SparkSession, path: str, schema: str, unique: Sequence[str] = (), row_tag: str = "class") -> DataFrame:
    """SRC22: a dimension table from JSON (lines, or one array) or XML files; a value twice in a ``unique`` column raises."""
    reader = spark.read.schema(schema)
    rows = reader.option("rowTag", row_tag).format("xml").load(path) if row_tag and path.rstrip("/").endswith("xml") else reader.json(path)
    for c in unique:
        twice = F.count("*").over(Window.partitionBy(c)) > 1
        rows = rows.withColumn(c, F.when(twice, F.raise_error(F.concat(F.lit(f"{c} holds a value twice: "), F.col(c).cast("string"))).cast(rows.schema[c].dataType)).otherwise(F.col(c)))
    return rows


def yaml_sections(spark: SparkSession, path: str) -> DataFrame:
    """SRC22: (file, section, key, value, item) of configuration files in plain YAML: sections of ``key: value`` and of keys with a list.

    A section's name stands at the margin, its keys are indented by two, items of a list by four behind a dash; what
    follows a # is a comment, quotes around a value go. ``item`` counts a list's entries from 0 and is null for plain
    values. Lines that fit none of these have no row. A file is one row until its lines are parted.
    """
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("at", "raw")).withColumn("line", F.rtrim(F.regexp_replace("raw", "#.*", ""))).where("trim(line) <> ''")
    indent, text = F.length("line") - F.length(F.ltrim("line")), F.trim("line")
    found = lambda pattern, level: F.when(indent == level, F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")))
    order = Window.partitionBy("file").orderBy("at")
    heads = lines.withColumns({"head": found("^(.+):$", 0), "name": found("^([^:]+?)\\s*:", 2), "plain": found("^[^:]+:\\s*(.+)$", 2), "entry": found("^-\\s+(.+)$", 4)})
    inside = heads.withColumn("section", F.last("head", ignorenulls=True).over(order)).where("section IS NOT NULL AND head IS NULL")
    keyed = inside.withColumn("key", F.last("name", ignorenulls=True).over(Window.partitionBy("file", "section").orderBy("at")))
    open_list = F.last(F.when(F.col("name").isNotNull(), F.col("plain").isNull()), ignorenulls=True).over(Window.partitionBy("file", "section").orderBy("at"))
    rows = keyed.withColumn("open", open_list).where("key IS NOT NULL AND (plain IS NOT NULL OR entry IS NOT NULL AND open)")
    item = F.when(F.col("entry").isNotNull(), F.count("entry").over(Window.partitionBy("file", "section", "key").orderBy("at")) - 1)
    value = F.regexp_replace(F.coalesce("plain", "entry"), "^([\"'])(.*)\\1$", "$2")
    return rows.select("file", "section", "key", value.alias("value"), item.cast("int").alias("item"))


def synced_frames(spark: SparkSession, path: str) -> DataFrame:
    """SRC23: frames of a match manifest that are synchronised."""
    return spark.read.option("multiLine", True).json(path).select(F.inline("frames")).where("synced")


def annotation_for_frames(frames: DataFrame, found: DataFrame, suffixes: Sequence[str] = ("_labels", "_annotation", "_annotations", "_manual")) -> DataFrame:
    """SRC15: the annotation file of each frame: the same stem, else the stem without a known suffix. (frame_id, path)"""
    short = F.regexp_replace("stem", "(" + "|".join(suffixes) + ")$", "")
    ranked = found.select(F.col("stem").alias("frame_id"), "path", F.lit(0).alias("rank")).union(found.where(short != F.col("stem")).select(short, "path", F.lit(1)))
    best = ranked.groupBy("frame_id").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))
    return frames.join(best, "frame_id", "left")


def flat_labels(labels: DataFrame, points: DataFrame) -> DataFrame:
    """SRC10: labels of primary points, from files of primary or of all returns, told by each frame's length.

    labels: frame_id, row_idx, label; points: frame_id, row_idx, is_primary. Other lengths raise.
    """
    w = Window.partitionBy("frame_id").orderBy("row_idx")
    primary = points.where("is_primary").withColumn("rank", (F.row_number().over(w) - 1).cast("bigint"))
    sizes = points.groupBy("frame_id").agg(F.count("*").alias("n_all"), F.count_if("is_primary").alias("n_primary")).join(labels.groupBy("frame_id").agg(F.count("*").alias("n")), "frame_id")
    layout = F.when(F.col("n") == F.col("n_primary"), "primary").when(F.col("n") == F.col("n_all"), "all").otherwise(F.raise_error(F.concat(F.lit("labels don't fit frame "), "frame_id")))
    at = primary.join(sizes.select("frame_id", layout.alias("layout")), "frame_id").withColumn("place", F.when(F.col("layout") == "primary", F.col("rank")).otherwise(F.col("row_idx")))
    # both sides have a row a point: never one for a broadcast, whatever their size is guessed to be
    return at.join(labels.withColumnRenamed("row_idx", "place").hint("merge"), ["frame_id", "place"]).select("frame_id", "row_idx", "label")


def _calibration(text: str, name: str) -> tuple[list[float], list[float]]:
    import json

    data = json.loads(text)

    def found(*names: str):
        for n in names:
            if data.get(n) is not None:
                return np.array(data[n], dtype=float).reshape(-1)
        raise ValueError(f"{name} has none of {', '.join(names)}")

    k, t = found("K", "camera_matrix", "intrinsic", "intrinsics"), found("T", "extrinsic", "T_lidar_camera", "lidar_to_camera", "transform")
    m = np.vstack([t.reshape(3, 4), [0, 0, 0, 1]]) if len(t) == 12 else t.reshape(4, 4)
    if data.get("direction") == "camera_to_lidar":
        m = np.linalg.inv(m)
    return k.tolist(), m.reshape(-1).tolist()


def calibration(spark: SparkSession, path: str) -> tuple[list[float], list[float]]:
    """SRC24: intrinsics (9) and transform (16) of one small JSON file, under any of several keys; 3x4 gets a last row, an inverse direction is inverted."""
    return _calibration(spark.read.text(path, wholetext=True).first()["value"], path)


def calibrations(texts: DataFrame, name: str = "camera", text: str = "value") -> DataFrame:
    """SRC24 for many cameras: (name, k, t) of rows that hold a JSON text each."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            both = [_calibration(v, str(n)) for n, v in zip(part["name"], part["text"])]
            yield pd.DataFrame({"name": part["name"], "k": [b[0] for b in both], "t": [b[1] for b in both]})

    kind = texts.schema[name].dataType.simpleString()
    return texts.select(F.col(name).alias("name"), F.col(text).alias("text")).mapInPandas(read, f"name {kind}, k array<double>, t array<double>").withColumnRenamed("name", name)
