"""Scans with declared schemas."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skytune import schemas

REJECT = "_reject"


def scan_json(
    spark: SparkSession, path: str, schema: StructType, rejects: str = "raise"
) -> DataFrame:
    """JSON of a declared schema; ``rejects`` says what happens to documents that do not fit it.

    ``raise`` ends the job at the first one, ``keep`` adds their text as a column ``_reject``
    (NULL for all others) for the caller to count or to write to a folder of their own.
    """
    if rejects == "raise":
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    if rejects != "keep":
        raise ValueError(f"rejects must be 'raise' or 'keep', not {rejects!r}")
    kept = StructType([*schema.fields, StructField(REJECT, StringType())])
    return spark.read.schema(kept).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECT)


def whole(number: Column) -> Column:
    """A code landed as a real number; NULL unless it is whole."""
    return F.when(number == F.floor(number), number.cast("bigint"))


def scan_weather_records(spark: SparkSession, path: str, rejects: str = "raise") -> DataFrame:
    """Weather JSON; a file may hold one record per line or a whole array per line."""
    landed = scan_json(spark, path, schemas.WEATHER_RECORD, rejects)
    return landed.withColumn("weathercode", whole(F.col("weathercode")))


def scan_weather_arrays(spark: SparkSession, path: str, rejects: str = "raise") -> DataFrame:
    landed = scan_json(spark, path, schemas.WEATHER_ARRAYS, rejects)
    codes = F.transform("hourly.weathercode", whole)
    return landed.withColumn("hourly", F.col("hourly").withField("weathercode", codes))


def scan_music_pulls(spark: SparkSession, path: str, rejects: str = "raise") -> DataFrame:
    """Nested music JSON. The declared schema keeps an empty track list typed."""
    return scan_json(spark, path, schemas.MUSIC_PULL, rejects)


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` (a file, folder or glob) by the names in their first line.

    One line of each file is read, by the store's own client and sixteen files at a time.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(place: JavaObject) -> tuple[str, ...] | None:
        stream = place.getFileSystem(conf).open(place)
        try:
            codec = codecs.getCodec(place)
            plain = codec.createInputStream(stream) if codec else stream
            lines = jvm.java.io.InputStreamReader(plain, "UTF-8")
            line = jvm.java.io.BufferedReader(lines).readLine()
        finally:
            stream.close()
        # an empty file has no header and no rows
        return tuple(next(csv.reader([line.removeprefix("\ufeff")]))) if line else None

    listed = sorted(spark.read.text(path).inputFiles())
    places = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)) for file in listed]
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(first_line, places))
    found: dict[tuple[str, ...], list[str]] = {}
    for place, header in zip(places, headers, strict=True):
        if header:
            found.setdefault(header, []).append(place.toString())
    return found


def scan_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV by the names in each file's own header; quotes are doubled inside quotes.

    The files of a folder may order their columns differently: files are read together per header
    and united by name. Columns that the schema does not name are left out; a file that lacks one
    or names it twice is an error.
    """
    parts = []
    for header, files in csv_headers(spark, path).items():
        missing = sorted(set(schema.names) - set(header))
        if missing:
            raise ValueError(f"{files[0]} lacks the columns {missing}")
        twice = sorted(n for n in schema.names if header.count(n) > 1)
        if twice:
            raise ValueError(f"{files[0]} names the columns {twice} more than once")
        places = [StructField(f"_c{i}", StringType()) for i in range(len(header))]
        landed = spark.read.schema(StructType(places)).csv(files, header=True, escape='"')
        parts.append(
            landed.select(
                *(F.col(f"_c{header.index(f.name)}").cast(f.dataType).alias(f.name) for f in schema)
            )
        )
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def scan_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, schemas.METADATA)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A staged table or the view of an upstream model."""
    return spark.table(name)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: Files that a micro-batch takes at most, so that a backlog comes in several batches.
FILES_PER_BATCH = 64


def stream_parquet(
    spark: SparkSession, path: str, schema: StructType, files: int = FILES_PER_BATCH
) -> DataFrame:
    """File stream over a parquet file or folder of files.

    The name is written as a one-choice glob: a plain path would have to be a folder.
    """
    folder, name = path.rsplit("/", 1)
    stem, dot, suffix = name.partition(".")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{folder}/{{{stem}}}{dot}{suffix}")


def stream_music_pulls(
    spark: SparkSession, path: str, files: int = FILES_PER_BATCH
) -> DataFrame:
    """Music documents as they land in a folder."""
    reader = spark.readStream.schema(schemas.MUSIC_PULL).option("maxFilesPerTrigger", files)
    return reader.json(path)
