"""File sources: CSV (plain, checked, through store options), JSON arrays,
JSON lines and opaque bytes. Every reader returns a lazy DataFrame; none of
them collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# a quote inside a quoted field is written twice
QUOTING = {"quote": '"', "escape": '"'}


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def scan_csv(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, **options) -> DataFrame:
    """All CSV files under a path or glob, first row as header, every column
    read as text (no schema inference pass over the data).

    With the declared ``columns`` Spark does not run a job to read the
    header for the names; each file's header is still checked against them
    while it is scanned (``enforceSchema=False``), so a file with other
    columns fails instead of being mapped by position.
    """
    if columns:
        return spark.read.schema(_text_schema(columns)).options(**{"header": True, "enforceSchema": False, **QUOTING, **options}).csv(path)
    return spark.read.options(**{"header": True, "inferSchema": False, **QUOTING, **options}).csv(path)


def header_columns(spark: SparkSession, path: str | list[str], **options) -> list[str]:
    """Column names from the header row (Spark reads one line, not the data)."""
    return spark.read.options(**{"header": True, "inferSchema": False, **QUOTING, **options}).csv(path).columns


def scan_csv_checked(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, **options
) -> DataFrame:
    """CSV as text plus ``_corrupt_record``: a row whose token count does not
    match the header keeps its raw line there instead of failing the job or
    being dropped silently. Blank lines are not records. Files without a
    header row take ``columns`` and ``header=False``.
    """
    header = options.pop("header", True)
    names = columns or header_columns(spark, path, **options)
    schema = _text_schema(names).add(T.StructField(CORRUPT, T.StringType(), True))
    if header:
        # declared names are checked against each file's header row
        options.setdefault("enforceSchema", False)
    return (
        spark.read.schema(schema)
        .options(**{"header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **QUOTING, **options})
        .csv(path)
    )


def scan_csv_typed(spark: SparkSession, path: str | list[str], rules, **options) -> DataFrame:
    """CSV typed to a declared table: text read, then ``try_cast`` per rule.
    Returns typed columns plus ``_reasons`` (see ``operators.quality``)."""
    from prodlake.operators.quality import type_and_check

    raw = scan_csv_checked(spark, path, **options)
    return type_and_check(raw, rules)


def scan_lake(spark: SparkSession, uri: str, store_options: dict[str, str] | None = None, **csv_options) -> DataFrame:
    """The same CSV reader whatever the store: pass-through, mounted or by
    account key. Store settings (``fs.*`` keys) go in as read options and
    reach the Hadoop file system of this read only, not the whole session."""
    return spark.read.options(**{"header": True, "inferSchema": False, **QUOTING, **(store_options or {}), **csv_options}).csv(uri)


def scan_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Files each holding one JSON array of objects; each object is a row.

    ``multiLine`` files are parsed whole by one task each, so they are not
    split; land them to Parquet before querying them repeatedly.
    """
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def scan_json_array_checked(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """``scan_json_array`` plus ``_corrupt_record``: a file that doesn't parse
    (cut off, not JSON) is one row whose values are NULL and whose text is
    kept there, so it can be told from a row of NULLs and rejected. Filter or
    type it with ``operators.quality.type_and_check``: the record is a reason."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(with_corrupt).option("multiLine", True).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def scan_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON Lines (what Spark writes); never with ``multiLine``, which would
    keep only the first record of each file."""
    return spark.read.schema(schema).json(path)


def scan_binary(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    recursive: bool = False,
    piece_bytes: int | None = None,
    piece_end: bytes = b"\n",
) -> DataFrame:
    """Files as opaque bytes: (path, modificationTime, length, content).

    Each file is one row whose content is held in memory by one task (Spark
    refuses files over 2 GiB here); it suits many small files. Column
    pruning to path / length / modificationTime reads no content.

    With ``piece_bytes`` a row is a piece instead, (path, length, start, content),
    cut behind a ``piece_end`` byte: large files are read by several tasks, and
    memory follows the piece, not the file."""
    if piece_bytes is not None:
        from prodlake.sources.ranged import scan_pieces

        return scan_pieces(spark, path, piece_bytes, piece_end, glob, recursive)
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)
