"""Scans and sinks.

* ``read_keyed``: one table from a directory of per-entity files; the
  entity label comes from the file name (``_metadata.file_name``).
* ``read_reconciled``: files whose headers differ; per file the first
  matching name column and value column are chosen, files lacking either
  are skipped and reported; unwanted files are dropped at listing (S4).
* ``split_quarantine``: rows that fail a parse check go to a quarantine
  DataFrame instead of vanishing or failing the job.
* ``write_partitioned`` / ``write_table``: per-entity and whole-table sinks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchspark.functions.text import label_from_stem

# Accepted header names, first match wins.
NAME_HEADERS = ["player", "name"]
RATING_HEADERS = ["rating", "averageRating"]
MINUTE_MARKERS = ["minute", "mins"]


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", header: bool = True) -> DataFrame:
    """Single table (S2). CSV gets a declared schema when given, never inference at scale."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | str, key_col: str = "country",
               suffix: str = ".csv", fmt: str = "csv", folder: bool = False) -> DataFrame:
    """Directory of per-entity files -> one table with the entity from the file name.

    ``south_korea_cleaned.csv`` with ``suffix='_cleaned.csv'`` -> ``South korea``.
    With ``folder`` the label is that of the file's folder, as
    ``write_partitioned`` lays tables out (``key=south_korea_cleaned.csv``).
    """
    reader = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", folder)
    df = (reader.option("header", True) if fmt == "csv" else reader).load(path)
    return df.withColumn(key_col, label_from_stem(file_label(folder), suffix))


def file_label(folder: bool = False) -> Column:
    """The name of a row's file or, as ``write_partitioned`` lays tables out, the key in the name of its folder.

    It depends on the file alone, so a filter on it drops files when they are listed. Spark also applies the filter to
    every row, so it takes a cut of the path and no search by pattern.
    """
    if not folder:
        return F.col("_metadata.file_name")
    key = F.substring_index(F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1), "=", -1)
    return F.when(F.contains(key, F.lit("%")), F.url_decode(F.replace(key, F.lit("+"), F.lit("%2B")))).otherwise(key)


@dataclass
class Reconciled:
    """``data``: source_file, player, value; ``skipped``: source_file, header of files without the wanted columns;
    ``corrupt``: source_file, line of rows that do not fit their file's header; ``unreadable``: source_file, reason of files
    that hold bytes but gave no line."""

    data: DataFrame
    skipped: DataFrame
    corrupt: DataFrame
    unreadable: DataFrame


def read_reconciled(spark: SparkSession, path: str, value: str = "rating",
                    only: Callable[[Column], Column] | None = None, folder: bool = False) -> Reconciled:
    """Header-reconciling scan of all CSV files below ``path``.

    ``source_file`` is ``file_label(folder)``. ``only``, a condition on that label,
    chooses the files: it is a partition filter of every scan, so other files are
    neither opened nor reported as skipped or unreadable.

    ``value='rating'`` picks ``rating`` then ``averageRating``;
    ``value='minutes'`` picks the first header containing ``minute`` or
    ``mins``. The name column is ``player`` then ``name``. The files are one
    text scan. Each file's first line is its header; a table of files (header, number of fields,
    positions of name and value, made by DataFrame expressions) is joined to the lines by file, and
    every line is parsed once into an array of fields of which these positions are taken, so
    the plan does not grow with the number of layouts and columns never shift between
    them. A line with more or fewer fields than its header is corrupt. Fields may be quoted
    (a doubled quote stands for one) but hold no newline. Values stay text, empty
    ones are null.

    A file that cannot be read (a broken archive) does not stop the job: the listed files,
    whose contents are not read for this, are anti-joined with those that gave a line.
    """
    label = file_label(folder)
    wanted_file = only(label) if only else F.lit(True)
    marked_line = F.startswith("value", F.lit("\ufeff")) | F.contains("value", F.lit("\r"))
    lines = (spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).text(path).where(wanted_file)
             .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata").alias("_metadata"), F.col("_metadata.file_block_start").alias("_start"),
                     F.when(marked_line, F.regexp_replace("value", "^\\ufeff|\r$", "")).otherwise(F.col("value")).alias("line")))
    # The first row of a file's first block: one task reads the block in order. The label is made once a file, not for every line.
    heads = lines.where("_start = 0").groupBy("_file").agg(F.first("line").alias("header"), F.first(F.struct("_metadata.file_path", "_metadata.file_name")).alias("_metadata"))
    heads = heads.withColumn("source_file", label).drop("_metadata")
    heads = heads.withColumn("_names", F.transform(F.split("header", ","), lambda h: F.trim(F.trim(h), F.lit('"'))))

    def place(exact: list[str], markers: list[str]) -> Column:
        found = [F.nullif(F.array_position("_names", name), F.lit(0)) for name in exact]
        if markers:
            marked = F.transform("_names", lambda h: F.exists(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(F.lower(h), m)))
            found.append(F.nullif(F.array_position(marked, True), F.lit(0)))
        return F.coalesce(*found)

    wanted = place(RATING_HEADERS, []) if value == "rating" else place([], MINUTE_MARKERS)
    heads = heads.withColumns({"_name": place(NAME_HEADERS, []), "_value": wanted, "_n": F.size("_names")})
    known = F.col("_name").isNotNull() & F.col("_value").isNotNull()
    # One row a file, fewer than the listing that the driver holds already: lines are not shuffled by their few files.
    rows = lines.select("_file", "line").join(F.broadcast(heads.where(known)), "_file").where("line <> header and line <> ''")
    # Through a generator, so a line is parsed once whatever later steps filter or compute on its fields.
    rows = rows.select("source_file", "line", "_name", "_value", "_n", F.explode_outer(F.array(csv_fields("line"))).alias("_fields"))
    good = F.size("_fields") == F.col("_n")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where("length > 0").where(wanted_file)
              .select(F.col("_metadata.file_path").alias("_file"), label.alias("source_file")))
    unreadable = listed.join(heads.select("_file"), "_file", "left_anti").select("source_file", F.lit("no line could be read").alias("reason"))
    return Reconciled(rows.where(good).select("source_file", F.get("_fields", F.col("_name").cast("int") - 1).alias("player"), F.get("_fields", F.col("_value").cast("int") - 1).alias(value)),
                      heads.where(~known).select("source_file", "header"), rows.where(~good).select("source_file", "line"), unreadable)


def csv_fields(line: str) -> Column:
    """The fields of a CSV line as an array: quoted ones without their quotes, empty ones null.

    White space before a field is no part of it. Lines without a quotation mark are split,
    only the others go through the pattern for quoted fields.
    """
    plain = F.split(F.regexp_replace(line, r"^\s+", ""), r",\s*", -1)
    found = F.regexp_extract_all(F.concat(F.lit(","), F.col(line)), F.lit(r',\s*("[^"\\]*(?:(?:\\.|"")[^"\\]*)*"|[^,]*)'), F.lit(1))
    inside = lambda x: F.regexp_replace(F.substring(F.rtrim(x), F.lit(2), F.length(F.rtrim(x)) - 2), r'\\(.)|"(")', "$1$2")
    is_quoted = lambda x: F.startswith(x, F.lit('"')) & F.endswith(F.rtrim(x), F.lit('"')) & (F.length(F.rtrim(x)) > 1)
    quoted = F.transform(found, lambda x: F.nullif(F.when(is_quoted(x), inside(x)).otherwise(x), F.lit("")))
    return F.when(F.contains(F.col(line), F.lit('"')), quoted).otherwise(F.transform(plain, lambda x: F.nullif(x, F.lit(""))))


def split_quarantine(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) by a parse check."""
    flag = F.coalesce(ok, F.lit(False))
    return df.where(flag), df.where(~flag)


def write_partitioned(df: DataFrame, path: str, key: str, fmt: str = "parquet", header: bool = True) -> None:
    """One folder per entity (S6); readers prune partitions by ``key``."""
    w = df.write.mode("overwrite").partitionBy(key).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> None:
    """Overwrite a whole table."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)
