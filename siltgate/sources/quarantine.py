"""CSV quarantine for rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from siltgate.sources.feed import as_text
from siltgate.sources.storage import WITH_MARKER, mode_for

# Doubled quotes instead of backslash escapes, and no trimming, so that any single-line text survives a round trip.
# Feeds are read line by line, so none of their texts holds a line break.
_FORMAT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Stands for a quoted empty text while reading; Spark would take `""` for its NULL mark otherwise.
_EMPTY = "\x01empty\x01"


def write_quarantine(bad: DataFrame, path: str, *, header: bool = False, mode: str = "ignore") -> None:
    """Write rejected rows. Mode `ignore` keeps what an earlier run left there, `overwrite` replaces it."""
    (
        as_text(bad)
        .write.mode(mode_for(bad.sparkSession, path, mode))
        .options(header=header, **_FORMAT, **WITH_MARKER)
        .csv(path)
    )


def read_quarantine(spark: SparkSession, path: str, schema: StructType | str, *, header: bool = False) -> DataFrame:
    """Read a quarantine folder back. Texts that were empty come back empty, not NULL: the writer quotes them."""
    rows = spark.read.schema(schema).options(header=header, emptyValue=_EMPTY, **_FORMAT).csv(path)
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType)]
    return rows.withColumns({c: F.when(F.col(c) == _EMPTY, F.lit("")).otherwise(F.col(c)) for c in texts})
