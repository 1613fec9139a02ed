"""File sources and sinks.

Readers never infer types: flights are read as strings (header names kept),
airports get the 14 supplied names, weather an explicit typed schema.
"""

from __future__ import annotations

import io
import zipfile
from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuo import config as C
from punctuo.functions import columns as X

# --- fixed values: column names of the airport file (it has no header) -------
AIRPORT_COLUMNS = (
    "Airport_ID", "Name", "City", "Country", "IATA", "ICAO",
    "Latitude", "Longitude", "Altitude", "Timezone", "DST", "Tz", "Type", "Source",
)
AIRPORT_NUMERIC = ("Latitude", "Longitude", "Altitude", "Timezone")
# Columns of the daily weather file.
WEATHER_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("tavg", "tmin", "tmax", "prcp", "snow", "tsun", "wspd", "wpgt", "pres")]
)
# --- end of fixed values -----------------------------------------------------


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_flights_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, headers: str = "same") -> DataFrame:
    """Header CSV, UTF-8 (BOM stripped by the reader), every column a string.

    Columns are bound by their header names (``inferSchema`` is never switched
    on): those named in ``columns`` come first and must be there, others pass
    through behind them. An empty cell is '' (the cleaning makes it NULL), as in
    the archives. ``headers``: see ``read_headed``."""
    return read_headed(spark, path, columns, headers).na.fill("")


def read_headed(spark: SparkSession, path: str, columns: Sequence[str] | None, headers: str = "same") -> DataFrame:
    """A file or a folder of header CSV files as strings, every file bound by its own header.

    ``headers="same"``: all files must have the same header; a file with another one
    (names, order or number) fails the query and is named in the error. ``"each"``: the
    header line of every file is read first (one short job a file, some at a time),
    files of one header share a reader, and the readers' rows are united by name; a
    file without a wanted column, or without one that another file has, is an error."""
    if headers not in ("same", "each"):
        raise ValueError("headers must be 'same' or 'each'")
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST").option("enforceSchema", False)
    if headers == "same":
        return by_name(reader.csv(path), columns)
    found = header_lines(spark, path)
    parts = [(files, by_name(reader.csv(files), columns)) for files in found.values()]
    first = parts[0][1]
    for files, part in parts[1:]:
        if odd := sorted({*part.columns} ^ {*first.columns}):
            raise ValueError(f"not in all files: columns {odd}; compare {parts[0][0][0]} and {files[0]}")
    out = first
    for _, part in parts[1:]:
        out = out.unionByName(part)
    return out


def header_lines(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by header line, in order of names. Lists the folder (without reading it) and reads one line of each file."""
    from concurrent.futures import ThreadPoolExecutor

    files = sorted(r["path"] for r in spark.read.format("binaryFile").load(path).select("path").toLocalIterator())
    if not files:
        raise ValueError(f"no files in {path}")

    def first_line(file: str) -> str:
        row = spark.read.text(file).head()
        return (row["value"] if row else "").lstrip("\ufeff")

    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(files, pool.map(first_line, files)):
            out.setdefault(line, []).append(file)
    return out


def by_name(raw: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The wanted columns by name, then the others; a missing one is an error."""
    if columns is None:
        return raw
    if missing := [c for c in columns if c not in raw.columns]:
        raise ValueError(f"columns missing from the file: {missing}; it has {raw.columns}")
    return raw.select(*[F.col(f"`{c}`") for c in [*columns, *[c for c in raw.columns if c not in columns]]])


def _unzip_batches(batches: Iterator[pd.DataFrame], columns: Sequence[str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for content in pdf["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for member in zf.namelist():
                    if member.endswith("/"):
                        continue
                    with zf.open(member) as fh:
                        for chunk in pd.read_csv(fh, dtype=str, keep_default_na=False, encoding="utf-8-sig",
                                                 chunksize=200_000):
                            if unknown := [c for c in chunk.columns if c not in columns]:
                                raise ValueError(f"{member} has columns that the first archive lacks: {unknown}")
                            yield chunk.reindex(columns=list(columns))


def _zip_header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for content in pdf["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                member = next(m for m in zf.namelist() if not m.endswith("/"))
                with zf.open(member) as fh:
                    header = pd.read_csv(fh, dtype=str, nrows=0, encoding="utf-8-sig").columns
            yield pd.DataFrame({"name": list(header), "pos": list(range(len(header)))})
            return


def read_flights_zip(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Zipped CSV archives, unpacked in parallel (one task per archive).

    Spark's CSV reader cannot open ``.zip``; ``binaryFile`` + ``mapInPandas``
    streams each archive member in chunks. The header of one archive is read by a
    bounded job (one archive, header line only); a member with other columns besides
    is an error. Columns are bound as in ``read_flights_csv``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    hdr = files.limit(1).mapInPandas(_zip_header, "name string, pos int").orderBy("pos").collect()
    known = [r["name"] for r in hdr]
    raw = files.mapInPandas(lambda it: _unzip_batches(it, known), string_schema(known))
    return by_name(raw, columns)


def read_flights(spark: SparkSession, path: str, columns: Sequence[str] | None = None, headers: str = "same") -> DataFrame:
    """S2 choice: ``.zip`` archives when the path names them, plain CSV otherwise."""
    if path.lower().endswith(".zip"):
        return read_flights_zip(spark, path, columns)
    return read_flights_csv(spark, path, columns, headers)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """S3: headerless airport CSV; trim, ``\\N``/'' → NULL, numeric columns coerced."""
    raw = (spark.read.schema(string_schema(AIRPORT_COLUMNS)).option("header", False)
           .option("escape", '"').option("nullValue", "\\N").csv(path))
    df = X.null_tokens(X.trim_strings(raw), C.AIRPORT_NULL_TOKENS)
    return df.select(*[X.lenient_double(c).alias(c) if c in AIRPORT_NUMERIC else F.col(c) for c in AIRPORT_COLUMNS])


def read_weather(spark: SparkSession, path: str, headers: str = "same") -> DataFrame:
    """Daily weather CSV, columns bound by header name and cast strictly
    (``date`` as DATE, the others as numbers): a value that is no date or number
    fails the query. Columns beyond the known ones pass through as strings.
    ``headers``: see ``read_headed``."""
    raw = read_headed(spark, path, [f.name for f in WEATHER_SCHEMA.fields], headers)

    def strict(name: str, kind: T.DataType):
        c = F.col(f"`{name}`")
        value = F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date") if isinstance(kind, T.DateType) else c.try_cast(kind)
        wrong = F.raise_error(F.concat(F.lit(f"weather file, column {name}: not a value of its type: "), c)).cast(kind)
        return F.when(c.isNull() | value.isNotNull(), value).otherwise(wrong).alias(name)

    kinds = {f.name: f.dataType for f in WEATHER_SCHEMA.fields}
    return raw.select(*[strict(c, kinds[c]) if c in kinds else F.col(f"`{c}`") for c in raw.columns])


def clean_weather(weather: DataFrame, bad_from: str = C.BAD_RAIN_FROM) -> DataFrame:
    """S4 follow-up: ``date`` → ``day``, drop the always-empty columns (snow,
    tsun), NULL the precipitation of the suspect period (C15)."""
    w = weather.withColumnRenamed("date", "day").drop("snow", "tsun")
    return w.withColumn("prcp", X.null_from("prcp", "day", bad_from))


def narrow_ints(df: DataFrame, cols: Sequence[str] = ("year", "month", "weekday", "hour", "hour_load")) -> DataFrame:
    """C17: small integer columns as SMALLINT at the sink (text columns need no
    'category' type: Parquet dictionary-encodes them)."""
    return df.select(*[F.col(f"`{c}`").cast("short").alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def write_fact(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",), mode: str = "overwrite",
               max_records_per_file: int = 5_000_000, narrow: bool = True) -> None:
    """The clean fact table as Parquet, partitioned so year filters prune files.

    No ``repartition(year)`` before the write: with a handful of years that
    would funnel a whole year through one task. Every task writes its own
    files per year instead (bounded by ``maxRecordsPerFile``)."""
    if narrow:
        df = narrow_ints(df)
    (df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*partition_by).parquet(path))


def file_order():
    """The place of a row in its files, for a column of a DataFrame just read: file, start of the block that the
    task reads, row number. Rising within a file, whatever the blocks and tasks; files in order of their names.

    (Row numbers of a task rise, and a block belongs to one task; Parquet and CSV alike.)"""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def preview(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in an explicit order (a top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
