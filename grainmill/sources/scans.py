"""Scans of the inputs: files whose rows need their number within the file, and whole files."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.functions.text import joined_text
from grainmill.schemas import LOCK, SAMPLE

#: The files of each source and their splits; ``*`` stands for any ending before ``.parquet``.
SOURCE_FILES = {
    "aegis": (("train.json", "train"), ("refusals_train.json", "train"), ("validation.json", "validation"), ("refusals_validation.json", "validation"), ("test.json", "test")),
    "wildguard": (("train/wildguard_train.parquet", "train"), ("test/wildguard_test.parquet", "test")),
    "deepset": (("data/train-*", "train"), ("data/test-*", "test")),
    "notinject": (("data/NotInject_one-*", "test"), ("data/NotInject_two-*", "test"), ("data/NotInject_three-*", "test")),
}


def name_of(path: str = "_metadata.file_path"):
    return F.element_at(F.split(F.col(path), "/"), -1)


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold a JSON list of objects: ``file, row_index`` and the fields. Anything else fails."""
    whole = spark.read.text(path, wholetext=True).select(name_of().alias("file"), F.col("value"))
    parsed = F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST"})
    sound = F.when(F.trim("value").startswith("["), parsed).otherwise(F.raise_error(F.concat(F.lit("not a JSON list of objects: "), "file")))
    return whole.select("file", F.posexplode(sound).alias("row_index", "r")).select("file", "row_index", "r.*")


def parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with ``file`` and ``row_index`` within it."""
    df = spark.read.parquet(path)
    return df.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row_index"), *df.columns)


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with ``row_index`` through all files of a table, in the order of their paths.

    Row counts come from the files' footers; a row for each file is numbered and broadcast.
    """
    df = spark.read.parquet(path)
    place = F.col("_metadata.file_path").alias("__file")
    sizes = df.select(place).groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__file", F.coalesce(before, F.lit(0)).alias("__start"))
    rows = df.select(place, F.col("_metadata.row_index").alias("__k"), *df.columns).join(F.broadcast(starts), "__file")
    return rows.select((F.col("__start") + F.col("__k")).alias("row_index"), *df.columns)


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A source file by its ending; other formats fail."""
    if path.endswith(".json"):
        return json_array(spark, path, schema)
    if path.endswith(".parquet"):
        return parquet_rows(spark, path)
    raise ValueError(f"unsupported file format: {posixpath.splitext(path)[1]}")


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with ``ordinal``, the number among the file's non-empty lines from 0."""
    whole = spark.read.text(path, wholetext=True).select(name_of().alias("file"), F.filter(F.split("value", r"\r\n|\r|\n"), lambda x: x != "").alias("l"))
    return whole.select("file", F.posexplode("l").alias("ordinal", "line")).select("file", "ordinal", F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r")).select("file", "ordinal", "r.*")


def attacks(spark: SparkSession, path: str) -> DataFrame:
    """A JSON map of families to variants: ``ord, attack_name, payload``, families in order. An empty pool fails."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>", {"mode": "FAILFAST"}).alias("m"))
    flat = flatten_attacks(whole.select(F.map_entries("m").alias("e")))
    if not flat.take(1):
        raise ValueError(f"no attacks in {path}")
    return flat


def flatten_attacks(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Entries of family and variants (column ``e``) flattened in the order of families; numbered within ``keys``."""
    family = F.transform(F.array_sort("e"), lambda e: F.transform(e["value"], lambda v, i: F.struct(F.concat(e["key"], F.lit("-"), i.cast("string")).alias("attack_name"), joined_text(F.array(v), "attack").alias("payload"))))
    return df.select(*keys, F.posexplode(F.flatten(family)).alias("ord", "a")).select(*keys, "ord", "a.*")


def samples(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of ``id, text``; blank lines are passed over, none at all fails."""
    df = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", SAMPLE, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    if not df.take(1):
        raise ValueError(f"no samples in {path}")
    return df


def whole_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, text`` of files, each one document; line ends become line feeds."""
    df = spark.read.text(list(paths), wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def lock(spark: SparkSession, path: str) -> DataFrame:
    """``source, revision, path, sha256`` of a lock file, a row for each file (one with nulls if it lists none)."""
    return lock_entries(spark.read.schema(LOCK).option("multiLine", True).json(path))


def lock_entries(df: DataFrame) -> DataFrame:
    entries = df.select(F.explode("sources").alias("s"))
    return entries.select("s.source", "s.revision", F.explode_outer("s.files").alias("f")).select("source", "revision", "f.path", "f.sha256")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """``path, sha256, bytes`` of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def select_files(files: DataFrame, source: str) -> DataFrame:
    """``filename, source_split`` of the files (column ``filename``) that a source consists of."""
    cases = F.lit(None).cast("string")
    for pattern, split in SOURCE_FILES[source]:
        name = F.col("filename")
        hit = name.startswith(pattern[:-1]) & name.endswith(".parquet") if pattern.endswith("*") else name == pattern
        cases = F.when(hit, split).otherwise(cases)
    return files.select("filename", cases.alias("source_split")).where("source_split is not null")


def require_files(files: DataFrame, source: str) -> DataFrame:
    """As :func:`select_files`; fails if a part of the source has no file."""
    chosen = select_files(files, source)
    names = [r[0] for r in chosen.select("filename").collect()]  # as many as the source has files
    for pattern, _ in SOURCE_FILES[source]:
        if not any(n.startswith(pattern[:-1]) if pattern.endswith("*") else n == pattern for n in names):
            raise ValueError(f"{source}: upstream source file missing: {pattern}")
    return chosen
