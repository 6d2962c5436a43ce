"""File sources and sinks: text, JSON lines, CSV, delimited text, libsvm.

Readers take explicit schemas except where inference *is* the operator
(``read_json_inferred``). Writers never ``coalesce(1)`` unless asked: one file
per task keeps the write parallel (plans spread a small scan first, see
``tessera.session.spread``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text scan: one row ``value`` per line (``\\n``, ``\\r\\n`` or ``\\r`` end a line)."""
    return spark.read.text(path)


def write_text(df: DataFrame, path: str, col: str | Column = "value", single_file: bool = False) -> str:
    """Text sink: one line per row of the single string column ``col``."""
    out = df.select(F.col(col) if isinstance(col, str) else col)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").text(path)
    return path


def read_json_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON-lines scan with an inferred schema (one extra pass over the files;
    lower ``sampling_ratio`` on big inputs)."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("overwrite").option("header", header).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, header: bool = True,
             **options) -> DataFrame:
    """CSV scan. With ``schema`` only the selected columns are parsed; without it
    every column is a string (no inference pass)."""
    r = spark.read.option("header", header)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def schema_from_names(names: str, sep: str = " ") -> T.StructType:
    """A programmatic all-string schema from a string of field names."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names.split(sep) if n])


def parse_delimited(lines: DataFrame, sep: str, fields: list[tuple[str, str]], col: str = "value") -> DataFrame:
    """Split each line at the literal ``sep`` and cast field *i* to its type with
    ``try_cast`` (text that does not parse becomes null instead of failing; so do the
    missing fields of a short line)."""
    parts = F.split(F.col(col), _regex_literal(sep), -1)
    return lines.select(*[F.trim(F.get(parts, F.lit(i))).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)])


#: Columns that the checked readers add; names of a quarantine table.
REJECT_SCHEMA = "line string, reason string"


@dataclass
class Checked:
    """What a reader made of its lines: ``good`` rows in the asked types, and ``rejects`` (line, reason).
    Every line is in exactly one of them. Both read the stored parse, so the input is parsed once."""

    good: DataFrame
    rejects: DataFrame


def _split_checked(parsed: DataFrame, names: list[str], stored: str) -> Checked:
    """``parsed`` has the rows' struct ``row``, the ``line`` and its ``reason`` (null: good)."""
    parsed.select("row", F.when(F.col("reason").isNotNull(), F.col("line")).alias("line"), "reason").write.parquet(stored)
    kept = parsed.sparkSession.read.parquet(stored)
    return Checked(kept.filter("reason IS NULL").select(*[F.col(f"row.{n}").alias(n) for n in names]),
                   kept.filter("reason IS NOT NULL").select("line", "reason"))


def check_delimited(lines: DataFrame, sep: str, fields: list[tuple[str, str]], stored: str, col: str = "value",
                    required: tuple[str, ...] = ()) -> Checked:
    """``parse_delimited`` with a reject channel. A line is rejected with the first reason that holds:
    ``fields: <found> of <wanted>`` (too few or too many), ``<name>: not a <type>`` (a text that
    is not empty does not parse), ``<name>: missing`` (a required field is empty). Empty fields that are not
    required are null."""
    parts = F.split(F.col(col), _regex_literal(sep), -1)
    texts = [F.trim(F.get(parts, F.lit(i))) for i in range(len(fields))]
    values = [F.when(x == "", F.lit(None)).otherwise(x).try_cast(t) for x, (_, t) in zip(texts, fields)]
    reason = F.when(F.col(col).isNull(), F.lit("no line")).when(
        F.size(parts) != len(fields), F.concat(F.lit("fields: "), F.size(parts).cast("string"), F.lit(f" of {len(fields)}")))
    for x, v, (n, t) in zip(texts, values, fields):
        reason = reason.when((x != "") & v.isNull(), F.lit(f"{n}: not a {t}"))
        if n in required:
            reason = reason.when(x == "", F.lit(f"{n}: missing"))
    row = F.struct(*[v.alias(n) for v, (n, _) in zip(values, fields)])
    return _split_checked(lines.select(row.alias("row"), F.col(col).alias("line"), reason.alias("reason")),
                          [n for n, _ in fields], stored)


def check_json(lines: DataFrame, schema: str, stored: str, col: str = "value", required: tuple[str, ...] = ()) -> Checked:
    """JSON lines with a reject channel: ``not JSON`` (the text does not parse as an object),
    ``<name>: not a <type>`` (a value that is there does not fit its column), ``<name>: missing``."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*kinds.fields, T.StructField("__bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    parsed = lines.select(F.col(col).alias("line"), F.from_json(F.col(col), wide, options).alias("row"),
                          F.try_parse_json(F.col(col)).alias("tree"))
    is_object = F.schema_of_variant("tree").startswith("OBJECT")
    reason = F.when(F.col("line").isNull(), F.lit("no line")).when(F.col("tree").isNull() | ~is_object, F.lit("not JSON"))
    for f in kinds.fields:
        there = F.try_variant_get("tree", f"$.{f.name}", "string")
        reason = reason.when(there.isNotNull() & F.col(f"row.{f.name}").isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
        if f.name in required:
            reason = reason.when(there.isNull(), F.lit(f"{f.name}: missing"))
    reason = reason.when(F.col("row.__bad").isNotNull(), F.lit("not JSON"))
    return _split_checked(parsed.select(F.struct(*[F.col(f"row.{f.name}").alias(f.name) for f in kinds.fields]).alias("row"), "line",
                                        reason.alias("reason")), kinds.names, stored)


def check_csv(spark: SparkSession, path: str, schema: str, stored: str, header: bool = True, required: tuple[str, ...] = (),
              **options) -> Checked:
    """CSV with a reject channel. Every column is read as text along with the whole record, which the
    reader itself marks when it has too few or too many fields (``fields``); then each
    field is checked like a delimited one."""
    kinds = T.StructType.fromDDL(schema)
    wide = T.StructType([*[T.StructField(f.name, T.StringType()) for f in kinds.fields], T.StructField("__bad", T.StringType())])
    r = spark.read.schema(wide).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad")
    for k, v in options.items():
        r = r.option(k, v)
    raw = r.csv(path)
    texts = [F.trim(F.col(f.name)) for f in kinds.fields]
    values = [F.when(x == "", F.lit(None)).otherwise(x).try_cast(f.dataType) for x, f in zip(texts, kinds.fields)]
    reason = F.when(F.col("__bad").isNotNull(), F.lit("fields"))
    for x, v, f in zip(texts, values, kinds.fields):
        reason = reason.when((x != "") & v.isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
        if f.name in required:
            reason = reason.when(x.isNull() | (x == ""), F.lit(f"{f.name}: missing"))
    line = F.coalesce("__bad", F.concat_ws(options.get("sep", ","), *[F.coalesce(f.name, F.lit("")) for f in kinds.fields]))
    row = F.struct(*[v.alias(f.name) for v, f in zip(values, kinds.fields)])
    return _split_checked(raw.select(row.alias("row"), line.alias("line"), reason.alias("reason")), kinds.names, stored)


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$|?*+()[]{}\\" else ch for ch in s)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> str:
    df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")) \
        .write.mode("overwrite").format("libsvm").save(path)
    return path


def read_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """libsvm scan -> ``(label double, features vector)``. Passing ``num_features``
    skips the extra pass that would find the largest index."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)
