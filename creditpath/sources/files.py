"""File sources for raw touches (CSV). Columns are found by their name in each file's own header.

Files of one folder may order their columns differently, or have more of them.
Lines are read as text with the file they come from; a file's header is its
first line that names all needed columns. Every line is then parsed and its
values taken by position in the header of its own file. Lines that don't fit
their header, and all lines of a file without such a header, keep their text in
``_corrupt_record`` beside the file's name, for quarantine.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import checkpoint_root
from ..functions.typing import type_touch_columns

# Fixed value: how the ingested bronze columns map onto touch columns.
BRONZE_TO_TOUCH = {"uid": "user_id", "channel": "event_type", "time": "time",
                   "conversion": "conversion"}
TOUCH_COLUMNS = ["uid", "channel", "time", "conversion"]
#: Holds a line that doesn't fit the header; such rows go to quarantine.
CORRUPT = "_corrupt_record"


#: Names the file of a line.
SOURCE_FILE = "_source_file"
#: Closes each line, so that its number of values can be told; no value of a text file holds it.
END_OF_LINE = "\u0001"


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """Column names from the first file's CSV header, every column as text (no inference pass)."""
    return spark.read.option("header", True).csv(path).schema


def layouts_for(mapping: dict[str, str] | None) -> list[dict[str, str]]:
    """Raw column of each touch column: the given names, or the plain layout and that of bronze."""
    return [mapping] if mapping is not None else [{c: c for c in TOUCH_COLUMNS}, BRONZE_TO_TOUCH]


def text_lines(lines: DataFrame) -> DataFrame:
    """``value`` and where it stands: its file, and where the part of the file begins that a task reads."""
    return lines.select(
        F.col("value"), F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias("_block")
    )


def _names(line: Column, separator: str) -> Column:
    """Names of a header line in lower case; a separator inside quotes doesn't count."""
    cells = F.split(line, re.escape(separator) + r'(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(cells, lambda c: F.lower(F.regexp_replace(c, r'^[\s\uFEFF"]+|[\s"]+$', "")))


def _holds(names: Column, layout: dict[str, str]) -> Column:
    return reduce(and_, (F.array_contains(names, c.lower()) for c in layout.values()))


def file_headers(lines: DataFrame, mapping: dict[str, str] | None = None, separator: str = ",") -> DataFrame:
    """One row per file with a usable header: the file, its header line, and the names in it.

    Lines are first searched for the names as text; only those that hold them
    all are taken apart. Of several such lines the first in the file counts.
    """
    layouts = layouts_for(mapping)
    low = F.lower("value")
    likely = reduce(or_, (reduce(and_, (F.contains(low, F.lit(c.lower())) for c in x.values())) for x in layouts))
    found = lines.where(likely).withColumn("_names", _names(F.col("value"), separator))
    found = found.where(reduce(or_, (_holds(F.col("_names"), x) for x in layouts)))
    place = F.struct(F.col("_block"), F.monotonically_increasing_id().alias("_n"))
    first = found.withColumn("_place", place).groupBy(SOURCE_FILE).agg(F.min_by(F.struct("value", "_names"), "_place").alias("_h"))
    return first.select(SOURCE_FILE, F.col("_h.value").alias("_header"), F.col("_h._names").alias("_names"))


def touches_by_header(
    lines: DataFrame, mapping: dict[str, str] | None = None, separator: str = ","
) -> DataFrame:
    """Touch columns as text from :func:`text_lines`, with ``_corrupt_record`` and the file's name.

    The lines are read twice: for the headers, and whole. The table of headers
    has one row a file; how it is joined is left to the optimizer. A line equal
    to its file's header is none of the rows, wherever it stands; blank lines
    aren't either. A layout is taken if the header has all its columns, the
    plain one first.
    """
    spark = lines.sparkSession
    checkpoint_root(spark)
    headers = file_headers(lines, mapping, separator).checkpoint()
    width = headers.agg(F.max(F.size("_names"))).first()[0] or 1
    cells_type = ", ".join(f"c{i} string" for i in range(width + 1))
    rows = lines.where(F.trim("value") != "").join(headers, SOURCE_FILE, "left")
    rows = rows.where(F.col("_header").isNull() | (F.col("value") != F.col("_header")))
    closed = F.concat(F.regexp_replace("value", r"\r$", ""), F.lit(separator + END_OF_LINE))
    parsed = F.from_csv(closed, F.lit(cells_type), {"sep": separator})
    cells = rows.withColumn("_cells", parsed).withColumn("_cells", F.array(*[F.col(f"_cells.c{i}") for i in range(width + 1)]))
    good = F.coalesce(F.try_element_at("_cells", F.size("_names") + 1) == END_OF_LINE, F.lit(False))

    def value(touch_column: str) -> Column:
        by_layout = F.lit(None).cast("string")
        for layout in reversed(layouts_for(mapping)):
            at = F.array_position("_names", layout[touch_column].lower()).cast("int")
            by_layout = F.when(_holds(F.col("_names"), layout), F.try_element_at("_cells", at)).otherwise(by_layout)
        return F.when(good, by_layout).alias(touch_column)

    return cells.select(
        *[value(c) for c in TOUCH_COLUMNS], F.when(~good, F.col("value")).alias(CORRUPT), F.col(SOURCE_FILE)
    )


def touch_columns(raw: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Touch columns of a table by name, for either raw layout; a table without them is refused."""
    if mapping is None:
        plain = {"uid", "channel"} <= set(raw.columns)
        mapping = {c: c for c in TOUCH_COLUMNS} if plain else BRONZE_TO_TOUCH
    missing = sorted(set(mapping.values()) - set(raw.columns))
    if missing:
        raise ValueError(f"the table has no columns {missing}; it has {raw.columns}")
    return raw.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])


def read_touch_csv(
    spark: SparkSession, path: str, fmt: str | None = None, mapping: dict[str, str] | None = None, separator: str = ","
) -> DataFrame:
    """Batch read of raw touch CSV, each file by its own header, then the typing projection."""
    touches = touches_by_header(text_lines(spark.read.text(path)), mapping, separator)
    return type_touch_columns(touches, fmt=fmt) if fmt else type_touch_columns(touches)


def touches_from_bronze(bronze: DataFrame, mapping: dict[str, str] | None = None,
                        fmt: str | None = None) -> DataFrame:
    """Bronze rows (``time, conversion, ad_id, user_id, revenue, event_type``) -> typed touches."""
    touches = touch_columns(bronze, mapping or BRONZE_TO_TOUCH)
    return type_touch_columns(touches, fmt=fmt) if fmt else type_touch_columns(touches)
