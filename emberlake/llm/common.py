"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.sizing import materialize
from emberlake.session import ship_package

# Name prefix of columns an operator adds beside a caller's own columns.
OWN = "__el_"

# Fixed value: the white-space characters that separate words.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: the
    lineage ends in shared files, so a lost executor costs a re-read only."""
    return materialize(df, f"llm-{name}")


def with_code(spark: SparkSession) -> None:
    """Make this package importable in Python tasks."""
    ship_package(spark)


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def any_case(word: str) -> str:
    """A regular expression for ``word`` with ASCII letters in either case.

    Character classes instead of a case flag: engines differ on which
    non-ASCII letters a flag folds.
    """
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() and c.islower() else c for c in word)


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII string expression."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a & 1) * 3988292384))"
    codes = (f"list_transform(range(length({text}) + 1), lambda i: CASE WHEN i = 0 THEN 4294967295 "
             f"ELSE CAST(ascii(substr({text}, CAST(i AS INT), 1)) AS BIGINT) END)")
    return f"xor(list_reduce({codes}, lambda c, b: {step}), 4294967295)"
