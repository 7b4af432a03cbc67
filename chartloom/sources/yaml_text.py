"""YAML list documents written and read by Spark.

Each row becomes one ``- ...`` block, so shards put end to end are one
document.  Blocks are built from column expressions; strings are written as
double-quoted scalars, whose escapes JSON and YAML share.

Reading splits a document at the starts of its blocks, so one file gives many
tasks, and takes each field out of its block by name and indentation, as the
schema asks.  It reads block lists and maps of quoted or plain scalars on one
line, in any order of keys; flow collections other than ``[]`` and scalars over
several lines are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------
# Characters JSON leaves as they are but YAML must see escaped: DEL and the C1
# controls, the two line separators, the byte order mark, the non-characters.
_SPECIAL = "[\\x7F-\\x9F\\u2028\\u2029\\uFEFF\\uFFFE\\uFFFF]"
_SPECIAL_CODES = [*range(0x7F, 0xA0), 0x2028, 0x2029, 0xFEFF, 0xFFFE, 0xFFFF]
# -----------------------------------------------------------------------------


def _string(c: Column) -> Column:
    as_json = F.to_json(F.array(c))
    quoted = F.substring(as_json, F.lit(2), F.length(as_json) - 2)
    codes = F.array(*[F.lit(f"{x:04X}") for x in _SPECIAL_CODES])
    escaped = F.aggregate(
        codes,
        quoted,
        lambda text, code: F.replace(text, F.decode(F.unhex(code), "UTF-16BE"), F.concat(F.lit("\\u"), code)),
    )
    return F.when(quoted.rlike(_SPECIAL), escaped).otherwise(quoted)


def _float(c: Column) -> Column:
    text = F.regexp_replace(c.cast("string"), r"E(\d)", "E+$1")
    return (
        F.when(F.isnan(c), ".nan")
        .when(c == float("inf"), ".inf")
        .when(c == float("-inf"), "-.inf")
        .otherwise(text)
    )


def _scalar(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = _float(c)
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        text = c.cast("string")
    else:
        text = _string(c.cast("string"))
    return F.coalesce(text, F.lit("null"))


def _fields(c: Column, kind: T.StructType, indent: int, lead: str) -> Column:
    """All fields of a struct, the first line starting with ``lead``."""
    parts = []
    for i, f in enumerate(kind.fields):
        start = lead if i == 0 else "\n" + " " * indent
        parts += [F.lit(f"{start}{f.name}:"), _value(c[f.name], f.dataType, indent)]
    return F.concat(*parts)


def _value(c: Column, kind: T.DataType, indent: int) -> Column:
    """What follows ``key:``, with its leading space or line break."""
    pad = " " * indent
    if isinstance(kind, T.StructType):
        block = _fields(c, kind, indent + 2, f"\n{pad}  ")
        return F.when(c.isNull(), " null").otherwise(block)
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType

        def item(x):
            if isinstance(inner, T.StructType):
                return _fields(x, inner, indent + 2, f"{pad}- ")
            return F.concat(F.lit(f"{pad}- "), _scalar(x, inner))

        lines = F.array_join(F.transform(c, item), "\n")
        return (
            F.when(c.isNull(), " null").when(F.size(c) == 0, " []").otherwise(F.concat(F.lit("\n"), lines))
        )
    return F.concat(F.lit(" "), _scalar(c, kind))


def yaml_blocks(df: DataFrame, order: str) -> DataFrame:
    """(order, block): one YAML list item per row, keys in column order."""
    shape = T.StructType([f for f in df.schema.fields if f.name != order])
    row = F.struct(*[f.name for f in shape.fields])
    return df.select(order, row.alias("__row")).select(order, _fields(F.col("__row"), shape, 2, "- ").alias("value"))


def write_yaml(df: DataFrame, path: str, order: str, shards: int | None = None) -> None:
    """Ordered shards: file names sort like ``order``."""
    blocks = yaml_blocks(df, order)
    ranged = blocks.repartitionByRange(shards, order) if shards else blocks.repartitionByRange(order)
    ranged.sortWithinPartitions(order).select("value").write.mode("overwrite").text(path)


def _read_scalar(text: Column, kind: T.DataType) -> Column:
    text = F.trim(text)
    if isinstance(kind, T.StringType):
        quoted = F.get(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), F.lit(0))
        single = F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit("''"), F.lit("'"))
        value = F.when(text.startswith('"'), quoted).when(text.startswith("'"), single).otherwise(text)
        return F.when(text.isin("null", "~", ""), None).otherwise(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = F.when(text == ".nan", "NaN").when(text == ".inf", "Infinity").when(text == "-.inf", "-Infinity").otherwise(text)
    return text.try_cast(kind)


def _read_items(text: Column, indent: int) -> Column:
    """Texts of the items of a block list whose dashes stand at the indentation."""
    parts = F.split(text, f"\\n {{{indent}}}- ")
    return F.slice(parts, F.lit(2), F.size(parts) - 1)


def _read_value(text: Column, kind: T.DataType, indent: int) -> Column:
    """The value after ``key:``, where keys stand at the indentation; NULL where the key is missing."""
    if isinstance(kind, T.StructType):
        return F.when(text.contains("\n"), _read_fields(text, kind, indent + 2))
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType

        def item(x: Column) -> Column:
            if isinstance(inner, T.StructType):
                return _read_fields(F.concat(F.lit(" " * (indent + 2)), x), inner, indent + 2)
            return _read_scalar(x, inner)

        empty = F.array().cast(kind)
        return F.when(text.contains("\n"), F.transform(_read_items(text, indent), item)).when(F.trim(text) == "[]", empty)
    return _read_scalar(text, kind)


def _read_fields(text: Column, kind: T.StructType, indent: int) -> Column:
    def one(f: T.StructField) -> Column:
        pattern = rf"(?ms)^ {{{indent}}}{re.escape(f.name)}:(.*?)(?=\n {{{indent}}}[^ \-]|\z)"
        found = F.when(text.rlike(rf"(?m)^ {{{indent}}}{re.escape(f.name)}:"), F.regexp_extract(text, pattern, 1))
        return _read_value(found, f.dataType, indent).cast(f.dataType).alias(f.name)

    return F.struct(*[one(f) for f in kind.fields])


def read_yaml(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a list document, one per block; keys the schema does not name are left out."""
    kind = spark.createDataFrame([], schema).schema
    blocks = spark.read.option("lineSep", "\n- ").text(path).filter(~F.col("value").rlike(r"^\s*(\[\])?\s*$"))
    body = F.regexp_replace(F.concat(F.lit("  "), F.regexp_replace("value", r"^- ", "")), r"\s+\z", "")
    return blocks.select(_read_fields(body, kind, 2).alias("r")).select("r.*")
