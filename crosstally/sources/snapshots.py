"""Delimited text snapshots, every field read as text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

SOURCE_FILE = "source_file"


class MissingInputs(FileNotFoundError):
    """One or more required inputs do not exist."""

    def __init__(self, missing: Sequence[str]):
        self.missing = list(missing)
        super().__init__("Missing required inputs:\n- " + "\n- ".join(missing))


def require_inputs(spark: SparkSession, paths: Iterable[str] = (), tables: Iterable[str] = ()) -> None:
    """Name every missing path or table at once, before any work starts."""
    missing = [p for p in paths if not _path_exists(spark, p)]
    missing += [t for t in tables if not spark.catalog.tableExists(t)]
    if missing:
        raise MissingInputs(missing)


def read_snapshot(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    sep: str = ",",
    encoding: str = "utf-8",
    lineage: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Header CSV with untouched column names; an empty field is NULL.

    With `columns` the header is checked against them; without, it is read from the
    files. A row with too few or too many fields fails the read. `multiline` allows
    line breaks inside quotes but makes each file one task.
    """
    reader = _reader(spark, sep, encoding, multiline).option("header", True).option("mode", "FAILFAST")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if columns is None:
        columns = reader.csv(paths).columns
    # Pruned columns would hide rows of the wrong length; header names must match the schema.
    reader = reader.schema(_text(columns)).option("enforceSchema", False).option("columnPruning", False)
    df = _decode(reader.csv(paths), columns, encoding)
    return _with_lineage(df, lineage)


def read_titled_snapshot(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    title: str | None = None,
    *,
    sep: str = ",",
    encoding: str = "utf-8",
) -> DataFrame:
    """CSV files that open with a title line, then a header line.

    The title is the first line of a file, whatever it says: the first row of the split that
    starts the file, so files stay splittable. With `title` it is instead every line whose
    first field matches that pattern. The header is recognised by its names; all other rows
    are kept, even if they look like a title, and short rows are padded.
    `titled_line_problems` verifies one title and one header per file.
    """
    lines = _titled_lines(spark, paths, columns, title, sep, encoding)
    return lines.filter(F.col("_kind") == "row").drop("_kind", _BEYOND)


def titled_line_problems(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    title: str | None = None,
    *,
    sep: str = ",",
    encoding: str = "utf-8",
) -> DataFrame:
    """Files that do not hold one title line and one header line, or have rows with too many fields."""
    lines = _titled_lines(spark, paths, columns, title, sep, encoding)
    counts = lines.groupBy(SOURCE_FILE).agg(
        F.count_if(F.col("_kind") == "title").alias("title_lines"),
        F.count_if(F.col("_kind") == "header").alias("header_lines"),
        F.count_if((F.col("_kind") == "row") & F.col(_BEYOND).isNotNull()).alias("long_lines"),
    )
    return counts.filter("title_lines <> 1 OR header_lines <> 1 OR long_lines > 0")


_BEYOND = "_beyond_last_column"


def _titled_lines(spark, paths, columns, title, sep, encoding) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    # One column more than the source has shows fields that would be dropped.
    wide = [*columns, _BEYOND]
    reader = _reader(spark, sep, encoding, False).schema(_text(wide)).option("mode", "PERMISSIVE")
    df = _decode(reader.csv(paths), wide, encoding)
    place = {"_line": F.monotonically_increasing_id(), "_block": F.col("_metadata.file_block_start")}
    df = df.select(*map(raw, wide), F.col("_metadata.file_path").alias(SOURCE_FILE), *(c.alias(n) for n, c in place.items()))
    is_header = F.lit(True)
    for name in columns:
        is_header = is_header & F.col(_quoted(name)).eqNullSafe(F.lit(name))
    if title is None:
        # Row numbers rise within a split, and the split that starts a file holds its first row.
        firsts = df.groupBy(F.col(SOURCE_FILE).alias("_file")).agg(F.min(F.when(F.col("_block") == 0, F.col("_line"))).alias("_first"))
        df = df.join(firsts, F.col(SOURCE_FILE) == F.col("_file"), "left")
        kind = F.when(F.col("_line") == F.col("_first"), "title").when(is_header, "header").otherwise("row")
    else:
        is_title = F.coalesce(F.col(_quoted(columns[0])).rlike(title), F.lit(False))
        kind = F.when(is_header, "header").when(is_title, "title").otherwise("row")
    return df.select(*map(raw, wide), SOURCE_FILE, kind.alias("_kind"))


def _reader(spark: SparkSession, sep: str, encoding: str, multiline: bool):
    return (
        spark.read.option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("encoding", "ISO-8859-1" if _is_cp1252(encoding) else encoding)
    )


def _decode(df: DataFrame, columns: Sequence[str], encoding: str) -> DataFrame:
    """Spark's CSV source refuses Windows-1252; read Latin-1 and fix the bytes that differ."""
    if not _is_cp1252(encoding):
        return df
    pairs = [(chr(b), bytes([b]).decode("cp1252", errors="ignore")) for b in range(0x80, 0xA0)]
    pairs = [(latin, win) for latin, win in pairs if win]
    latin, win = "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)
    return df.select(*(F.translate(F.col(_quoted(c)), latin, win).alias(c) for c in columns), "_metadata")


def _with_lineage(df: DataFrame, lineage: bool) -> DataFrame:
    names = [c for c in df.columns if c != "_metadata"]
    if not lineage:
        return df.select(*map(_quoted, names))
    return df.select(*map(_quoted, names), F.col("_metadata.file_path").alias(SOURCE_FILE))


def _path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _is_cp1252(encoding: str) -> bool:
    return encoding.lower().replace("-", "").replace("_", "") in {"cp1252", "windows1252"}


def _text(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def raw(name: str) -> Column:
    """Column with a name as it stands in a source header, spaces and brackets included."""
    return F.col(_quoted(name))
