"""Result files: delimited text, dated archives and the two analysis outputs."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions.nulls import col
from pricelens.settings import Names, as_names

# the function that runs in the tasks travels with its job, so the executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def number_text(c: Column, kind: T.DataType) -> Column:
    """A number as plain text: digits with a point up to 16 places before it and from 0.0001 on, else with an exponent."""
    text = c.cast("string")
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return text
    digits = F.regexp_replace(text.cast("decimal(38,22)").cast("string"), "(?<=[.][0-9])0+$|(?<=[.][0-9]{1,21}[1-9])0+$", "")
    power = F.regexp_replace(F.regexp_replace(text, "[.]0E", "E"), "E(?=[0-9])", "e+")
    power = F.regexp_replace(F.regexp_replace(power, "E-", "e-"), "(?<=e[+-])([0-9])$", "0$1")
    plain = (F.abs(c) < 1e16) & ((F.abs(c) >= 1e-4) | (c == 0))
    return F.when(~F.contains(text, F.lit("E")), text).when(plain, digits).otherwise(power)


def quoted_line(df: DataFrame) -> Column:
    """A row as ``;``-separated text: numbers as they are, everything else in quotes, null as an empty text in quotes."""
    cells = []
    for field in df.schema:
        value = col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            value = F.initcap(value.cast("string"))
        elif isinstance(field.dataType, T.NumericType):
            value = number_text(value, field.dataType)
        else:
            value = F.concat(F.lit('"'), F.replace(value.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
        cells.append(F.coalesce(value, F.lit('""')))
    return F.concat_ws(";", *cells)


def header_line(df: DataFrame) -> str:
    return ";".join('"' + name.replace('"', '""') + '"' for name in df.columns)


def delimited_text(df: DataFrame, keys: Names = ()) -> DataFrame:
    """``keys, value``: the rows as lines, the first line of each output file with the header before it.

    Write it as text, partitioned by the keys: each task then has one file for each of its keys.
    """
    names = list(as_names(keys))
    rest = df.drop(*names)
    header = header_line(rest) + "\n"
    lines = df.select(*(col(n) for n in names), quoted_line(rest).alias("line"))
    if not names:
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        return lines.select(F.when(first, F.concat(F.lit(header), "line")).otherwise(F.col("line")).alias("value"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # as many as output files
        for batch in batches:
            found = list(zip(*(batch.column(n).to_pylist() for n in names), strict=True))
            first = [key not in seen and not seen.add(key) for key in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], names=[*batch.schema.names, "__first"])

    schema = T.StructType([*lines.schema, T.StructField("__first", T.BooleanType())])
    marked = lines.mapInArrow(mark, schema).sortWithinPartitions(*(col(n) for n in names), F.desc("__first"))
    value = F.when(F.col("__first"), F.concat(F.lit(header), "line")).otherwise(F.col("line"))
    return marked.select(*(col(n) for n in names), value.alias("value"))


def write_semicolon(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``;``-separated UTF-8 text with the header and all values but numbers in quotes."""
    delimited_text(df).write.mode(mode).text(path)


def write_tabs(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated UTF-8 text, quoted where needed; one file per partition of the result."""
    df.write.mode(mode).options(sep="\t", header=True, escape='"', encoding="utf-8").csv(path)


def write_archive(df: DataFrame, path: str, as_of: str, form: str = "parquet") -> None:
    """A copy in a folder per run date. Only that date's folder is replaced."""
    rows = delimited_text(df) if form == "csv" else df
    (
        rows.withColumn("snapshot_date", F.lit(as_of).cast("date"))
        .write.mode("overwrite")
        .partitionBy("snapshot_date")
        .option("partitionOverwriteMode", "dynamic")
        .format("text" if form == "csv" else form)
        .save(path)
    )


def write_by_origin(df: DataFrame, path: str, name: str = "base_name") -> None:
    """One folder per output name, so that each input catalogue gives one output of its own."""
    delimited_text(df, name).write.mode("overwrite").partitionBy(name).text(path)


def write_analysis(df: DataFrame, path: str, as_of: str) -> dict[str, str]:
    """The whole table and the part with sales, each under the run date and as the current one.

    ``df`` should be materialised (``materialise``), since it is written four times.
    """
    tables = {"full": df, "with_sales": df.where(col("Sales_LTM") > 0)}
    targets = {}
    for part, table in tables.items():
        for stem in (f"{as_of}_Output_Analysis_{part}", f"Output_Analysis_{part}"):
            targets[stem] = f"{path}/{stem}"
            write_tabs(table, targets[stem])
    return targets
