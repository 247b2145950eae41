"""Typed scans of CSV feeds."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from siltgate.functions.rules import CORRUPT_COLUMN, ORIGIN, boolean_flag
from siltgate.sources.storage import files_at, first_line

# Declared type names and the Spark types they stand for; any other name is read as text.
DECLARED_TYPES = {
    "integer": "int",
    "string": "string",
    "double": "double",
    "decimal": "decimal(18,9)",
    "boolean": "boolean",
}


def declared_schema(fields: Iterable[tuple[str, str]]) -> StructType:
    """Schema from (column, type name) pairs. `decimal(p,s)` keeps its precision; unknown names become strings."""
    types = [(name, type_name.strip().lower()) for name, type_name in fields]
    return StructType(
        [
            StructField(name, DataType.fromDDL(t if t.startswith("decimal(") else DECLARED_TYPES.get(t, "string")))
            for name, t in types
        ]
    )


def parse_declaration(text: str) -> tuple[StructType, list[str]]:
    """Schema and checked columns from text: a line per column with its name, its type, and `col` if it is checked.

    The parts are separated by commas or spaces; empty lines are skipped.
    """
    lines = [re.split(r"\s*,\s*(?![^(]*\))|\s+(?![^(]*\))", line.strip()) for line in text.splitlines() if line.strip()]
    if bad := [line for line in lines if len(line) < 2]:
        raise ValueError(f"a declared column needs a name and a type: {bad[0]}")
    return declared_schema((line[0], line[1]) for line in lines), [line[0] for line in lines if "col" in line[2:]]


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    *,
    header: bool = False,
    keep_corrupt: bool = False,
    flags: Sequence[str] = (),
    origin: bool = False,
) -> DataFrame:
    """Read a CSV file, or all files of a folder, under a declared schema matched by position.

    Cells that do not fit their type are read as NULL. With `keep_corrupt` the raw text of such lines, and of lines
    with too few or too many fields, is kept in `corrupt_line`. `flags` are boolean columns delivered as words; a line
    with another word there counts as unreadable too, and its text is put together from its cells.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    flagged = {f.lower() for f in flags}
    read = StructType(
        [StructField(f.name, StringType() if f.name.lower() in flagged else f.dataType) for f in declared.fields]
    )
    reader = spark.read.option("header", header)
    if keep_corrupt:
        read = read.add(CORRUPT_COLUMN, "string")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    rows = reader.schema(read).csv(path)
    if origin:
        place = F.concat_ws("@", "_metadata.file_path", F.col("_metadata.file_block_start").cast("string"))
        rows = rows.select("*", place.alias(ORIGIN))
    if keep_corrupt:
        # The reader judges only the columns a query asks for, so one that selects fewer would see fewer broken lines.
        # An always-true test over all columns keeps them in the scan and the verdict the same for every query.
        whole_line = F.hash(*declared.names).bitwiseOR(F.lit(1)) != F.lit(0)
        rows = rows.withColumn(CORRUPT_COLUMN, F.when(whole_line, F.col(CORRUPT_COLUMN)))
        for f in declared.fields:
            # A flag is read as text, so a word that is none is not noticed by the reader.
            if f.name.lower() in flagged:
                unread = F.col(f.name).isNotNull() & boolean_flag(f.name).isNull()
                line = F.concat_ws(",", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in declared.names])
                rows = rows.withColumn(CORRUPT_COLUMN, F.coalesce(F.col(CORRUPT_COLUMN), F.when(unread, line)))
    return rows.withColumns({f.name: boolean_flag(f.name) for f in declared.fields if f.name.lower() in flagged})


def scan_csv_named(
    spark: SparkSession, path: str, schema: StructType | str, **options
) -> tuple[DataFrame, dict[str, str]]:
    """As `scan_csv` for files with a header, but columns are matched by name, in any order and any case.

    Of each file the driver reads the first line; files of equal headers are then scanned together. Columns that are
    not declared are left out. Returns the rows under the declared schema and the files that were refused, each with
    the reason: a declared column is missing or there twice, or the file has no header. Nothing of those is read.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = {f.name.lower(): f for f in declared.fields}
    groups: dict[tuple[str, ...], list[str]] = {}
    refused = {}
    for file in files_at(spark, path):
        names = tuple(n.strip().lower() for n in next(csv.reader([first_line(spark, file)]), []))
        often = Counter(names)
        missing = [f.name for n, f in wanted.items() if not often[n]]
        twice = [f.name for n, f in wanted.items() if often[n] > 1]
        if missing or twice:
            refused[file] = "; ".join(f"{what}: {', '.join(c)}" for what, c in (("missing", missing), ("twice", twice)) if c)
        else:
            groups.setdefault(names, []).append(file)
    scans = []
    for names, files in sorted(groups.items()):
        # Other columns are read as text under names that clash with none.
        shape = StructType([wanted.get(n, StructField(f"_other_{i}", StringType())) for i, n in enumerate(names)])
        rows = scan_csv(spark, files, shape, header=True, **options)
        scans.append(rows.drop(*[f.name for f in shape.fields if f.name.startswith("_other_")]))
    if not scans:
        return spark.createDataFrame([], declared), refused
    # The first scan settles the order of columns that options add.
    added = [c for c in scans[0].columns if c.lower() not in wanted]
    return reduce(DataFrame.unionByName, scans).select(*declared.names, *added), refused


def as_text(df: DataFrame) -> DataFrame:
    """Nested reasons as one text column, for sinks that hold flat text only."""
    return df.withColumns(
        {f.name: F.array_join(f.name, "; ") for f in df.schema.fields if f.dataType.typeName() == "array"}
    )
