"""Scans and sinks: Parquet, CSV (with pandas-style NA tokens), JSON reports,
CSV folder export and model directories. Paths may be on any Hadoop
file system; nothing here uses the local file API."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NA_TOKENS, WHOLE, na_to_null, parse_double
from ..session import ensure_checkpoint_dir


class MissingInput(FileNotFoundError):
    """An input path does not exist (the reference logs and exits with 2)."""

    exit_code = 2


def _guard(fn, path):
    try:
        return fn()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise MissingInput(f"input missing: {path}") from exc
        raise


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; selecting ``columns`` prunes the read schema."""
    df = _guard(lambda: spark.read.parquet(path), path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             na_tokens: Sequence[str] | None = NA_TOKENS) -> DataFrame:
    """CSV with a header. With a schema nothing is inferred (no extra pass);
    without one types are inferred, as the reference does.

    ``na_tokens`` (default: pandas' list) become null: string columns are
    read as text first, mapped, then cast, since Spark's ``nullValue`` takes
    a single token.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if na_tokens is None:
        if schema is not None:
            return _guard(lambda: reader.schema(schema).csv(path), path)
        return _guard(lambda: reader.option("inferSchema", True).csv(path), path)
    raw = _guard(lambda: reader.option("inferSchema", False).csv(path), path)
    cleaned = raw.select(*[na_to_null(c, na_tokens).alias(c) for c in raw.columns])
    if schema is not None:
        st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        return _typed(cleaned, st)
    return infer_types(cleaned)


class UnparsableValues(ValueError):
    """Text that does not fit the type a schema gives it."""


def _typed(df: DataFrame, st: T.StructType) -> DataFrame:
    """Cast text columns to a schema. Values that do not fit are counted in one
    aggregation and refused by name, rather than turned into nulls."""
    def cast(f):
        return _cast(F.col(f.name), f.dataType)

    lost = [F.count_if(F.col(f.name).isNotNull() & cast(f).isNull()).alias(f.name) for f in st.fields]
    row = df.agg(*lost).first() if lost else {}
    bad = {f.name: row[f.name] for f in st.fields if row[f.name]}
    if bad:
        raise UnparsableValues(f"values that do not fit the schema, by column: {bad}")
    return df.select(*[cast(f).alias(f.name) for f in st.fields])


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str,
                     na_tokens: Sequence[str] = NA_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, misfits) of a CSV with a header, from one pass.

    Misfits are (file, record, column, text): one row per value that does not fit its type,
    with the whole record as CSV text, and one with null column per record with too many or
    too few fields. A record with a misfit is in no other output. The parsed rows are written
    once to the shared checkpoint folder; both frames read them from there. ``read_csv`` with
    a schema refuses such files instead.
    """
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    reader = spark.read.option("header", True)
    names = _guard(lambda: reader.csv(path), path).columns
    broken = "_dl_broken"
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, broken]])
    raw = reader.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken) \
        .csv(path).select("*", F.col("_metadata.file_path").alias("_dl_file"))
    cells, wrong = [], []
    for f in st.fields:
        value = na_to_null(f.name, na_tokens)
        typed = _cast(value, f.dataType)
        cells.append(typed.alias(f.name))
        wrong.append(F.when(value.isNotNull() & typed.isNull(),
                            F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text"))))
    record = F.coalesce(broken, F.to_csv(F.struct(*[F.col(c) for c in names])))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("text")))
    misfits = F.when(F.col(broken).isNotNull(), whole).otherwise(F.array_compact(F.array(*wrong)))
    ensure_checkpoint_dir(spark)
    once = raw.select(F.struct(*cells).alias("row"), misfits.alias("misfits"),
                      F.when(F.size(misfits) > 0, record).alias("record"), F.col("_dl_file").alias("file")).checkpoint()
    return (once.where(F.size("misfits") == 0).select("row.*"),
            once.where(F.size("misfits") > 0).select("file", "record", F.inline("misfits")))


def _cast(value, kind: T.DataType):
    return parse_double(value).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else value.try_cast(kind)


def infer_types(df: DataFrame) -> DataFrame:
    """Type text columns like pandas: boolean if every value is True or False, int if
    every value is a whole number, double if every value is a number (by pattern, so
    that "33D" stays text), else text. One aggregation over all columns; a column
    without values is double."""
    cols = df.columns
    if not cols:
        return df
    checks = []
    for i, c in enumerate(cols):
        v = F.col(c)
        checks += [F.count_if(v.isNotNull() & parse_double(c).isNull()).alias(f"d{i}"),
                   F.count_if(v.isNotNull() & ~(v.rlike(WHOLE) & F.trim(v).try_cast("long").isNotNull()))
                   .alias(f"l{i}"),
                   F.count_if(v.isNotNull() & ~F.lower(v).isin("true", "false")).alias(f"b{i}"),
                   F.count(v).alias(f"n{i}")]
    row = df.agg(*checks).first()
    out = []
    for i, c in enumerate(cols):
        v = F.col(c)
        if row[f"n{i}"] and not row[f"b{i}"]:
            out.append((F.lower(v) == "true").alias(c))
        elif row[f"n{i}"] and not row[f"l{i}"]:
            out.append(F.trim(v).try_cast("long").alias(c))
        elif not row[f"d{i}"]:
            out.append(parse_double(c).alias(c))
        else:
            out.append(v)
    return df.select(*out)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV folder with a header in every part, one part per partition,
    written in parallel. (A single-file export would pass every row through
    one task; the folder reads back as one table.)"""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Report rows as JSON lines. A frame of one text column named ``report`` (the
    nested report) already is JSON and is written as it stands."""
    if df.columns == ["report"] and df.dtypes[0][1] == "string":
        df.write.mode(mode).text(path)
    else:
        df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel
    try:
        return PipelineModel.load(path)
    except Exception as exc:  # Py4J / Hadoop errors for a missing directory
        if "does not exist" in str(exc) or "not exist" in str(exc) or "InvalidInputException" in str(exc):
            raise MissingInput(f"model missing: {path}") from exc
        raise
