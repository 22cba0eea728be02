"""Table scans (SRC-1..6): declared schemas, format dispatch, v1 -> v2 renaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, TS = T.StringType(), T.DoubleType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Declared input schemas (registry format, version 2 names).  Ids are strings.
SCHEMAS: dict[str, T.StructType] = {
    "adt": _schema(("hospitalization_id", S), ("location_category", S), ("in_dttm", TS),
                   ("out_dttm", TS)),
    "hospitalization": _schema(("patient_id", S), ("hospitalization_id", S),
                               ("age_at_admission", D), ("discharge_category", S),
                               ("admission_dttm", TS)),
    "patient": _schema(("patient_id", S), ("race_category", S), ("ethnicity_category", S),
                       ("sex_category", S)),
    "vitals": _schema(("hospitalization_id", S), ("recorded_dttm", TS), ("vital_category", S),
                      ("vital_value", S)),
    "labs": _schema(("hospitalization_id", S), ("lab_order_dttm", TS), ("lab_category", S),
                    ("lab_value", S), ("lab_value_numeric", D)),
    "respiratory_support": _schema(("hospitalization_id", S), ("recorded_dttm", TS),
                                   ("device_category", S), ("mode_category", S), ("fio2_set", D),
                                   ("peep_set", D), ("tidal_volume_set", D), ("lpm_set", D)),
    "medication_admin_continuous": _schema(("hospitalization_id", S), ("admin_dttm", TS),
                                           ("med_category", S), ("med_dose", D),
                                           ("med_dose_unit", S)),
    "patient_assessments": _schema(("hospitalization_id", S), ("recorded_dttm", TS),
                                   ("assessment_category", S), ("numerical_value", D)),
}

# Version 1 column names and their version 2 equivalents.
V1_RENAMES = {
    "encounter_id": "hospitalization_id",
    "disposition": "discharge_category",
    "disposition_category": "discharge_category",
    "pulse": "heart_rate",
}

# Declared columns that a CSV file may leave out.
OPTIONAL = ("lab_value_numeric", "lpm_set")

ID_COLUMNS = ("hospitalization_id", "encounter_id", "patient_id")


def to_ntz(df: DataFrame) -> DataFrame:
    """Drop time zones: zone-aware timestamps become wall-clock UTC ``timestamp_ntz``
    (the session zone is UTC); ids are cast to string."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out[f.name] = F.col(f.name).cast(TS)
        elif f.name in ID_COLUMNS and not isinstance(f.dataType, T.StringType):
            out[f.name] = F.col(f.name).cast(S)
    return df.withColumns(out) if out else df


def load_table(spark: SparkSession, name: str, root: str, fmt: str = "parquet",
               version: int = 2, schema: T.StructType | None = None, prefix: str = "", strict: bool = True) -> DataFrame:
    """Read ``{root}/{prefix}{name}.{fmt}``; unknown formats raise ``ValueError``.

    CSV columns are matched to the declared schema by name, whatever their order (no inference
    pass over the data); columns beyond the schema stay, as strings, and a missing one raises
    ``ValueError`` unless it is in ``OPTIONAL`` (then it is NULL).  Values that do not parse raise
    with ``strict`` and become NULL without.  Parquet uses its own footer schema, then ids and
    timestamps are normalised.
    """
    path = f"{root}/{prefix}{name}.{fmt}"
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        sch = schema or SCHEMAS.get(name)
        r = spark.read.option("header", True)
        if sch is None:
            df = r.option("inferSchema", True).csv(path)
        else:
            df = by_name(harmonise_v1(r.csv(path)) if version == 1 else r.csv(path), sch, strict)
    else:
        raise ValueError(f"unsupported file type: {fmt!r}")
    if version == 1:
        df = harmonise_v1(df)
    return to_ntz(df)


def by_name(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The declared columns of a frame of strings, cast, then its other columns."""
    missing = [f.name for f in schema if f.name not in df.columns and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"missing columns: {missing}")

    def cast(f: T.StructField):
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.nullif(F.trim(F.col(f.name)), F.lit("")) if not isinstance(f.dataType, T.StringType) else F.col(f.name)
        return (c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name)

    return df.select(*[cast(f) for f in schema], *[c for c in df.columns if c not in schema.names])


def harmonise_v1(df: DataFrame) -> DataFrame:
    """Rename version 1 columns to version 2 names (PRJ-2)."""
    ren = {k: v for k, v in V1_RENAMES.items() if k in df.columns and v not in df.columns}
    return df.withColumnsRenamed(ren) if ren else df


def register(df: DataFrame, name: str) -> DataFrame:
    """SRC-4: expose a DataFrame to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def unregister(spark: SparkSession, name: str) -> bool:
    """SRC-4: drop a temporary view; whether there was one."""
    return spark.catalog.dropTempView(name)


def site_rows(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """Every data line of the result files that match ``pattern``: the columns of ``schema`` by each file's own
    header, then ``_file``, ``_line``, ``_text`` and ``_fault`` (NULL for a good line).

    Result files are summaries of a few hundred lines, so a file is read as one row; fields may be quoted, but hold no line
    ends.  Faults: a schema column that the header lacks, a number of fields other than the header's, a
    value that its type does not parse.  Blank lines are skipped; a null or empty field is NULL."""
    raw = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), "value")
    lines = raw.select("_file", F.posexplode(F.split(F.regexp_replace("value", "^\ufeff", ""), "\r?\n")).alias("_at", "_text"),
                       F.regexp_extract(F.regexp_replace("value", "^\ufeff", ""), r"^([^\r\n]*)", 1).alias("_head"))
    lines = lines.where((F.col("_at") > 0) & (F.trim("_text") != ""))
    # fields one after the other, each with the comma that ends it; a quoted one may hold commas and doubled quotes
    field = F.lit(r'\s*("(?:[^"]|"")*"|[^,"]*)\s*,')
    unquoted = lambda x: F.when(F.startswith(x, F.lit('"')), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(F.trim(x))
    cells = lambda c: F.transform(F.regexp_extract_all(F.concat(F.col(c), F.lit(",")), field, F.lit(1)), unquoted)
    parsed = lines.withColumns({"_names": cells("_head"), "_cells": cells("_text")})
    at = lambda f: F.array_position("_names", f.name)
    text = lambda f: F.when(at(f) > 0, F.nullif(F.get("_cells", at(f).cast("int") - 1), F.lit("")))
    fault = F.when(F.size("_names") != F.size("_cells"), F.lit("number of fields"))
    for f in schema:
        fault = F.coalesce(fault, F.when(F.coalesce(at(f), F.lit(0)) == 0, F.lit(f"no column {f.name}")),
                           F.when(text(f).isNotNull() & text(f).try_cast(f.dataType).isNull(), F.lit(f"value of {f.name}")))
    return parsed.select(*[text(f).try_cast(f.dataType).alias(f.name) for f in schema], "_file", (F.col("_at") + 1).alias("_line"),
                         "_text", fault.alias("_fault"))


def read_site_results(spark: SparkSession, pattern: str, schema: T.StructType | None = None, fmt: str = "csv") -> DataFrame:
    """SRC-6 / SET-1: all per-site result files matching a glob, as one DataFrame.  With a schema, CSV columns are matched by name, file by
    file, whatever their order, and faulty lines are left to ``quarantined_site_lines``."""
    if fmt == "csv" and schema is not None:
        return site_rows(spark, pattern, schema).where(F.col("_fault").isNull()).select(*schema.names)
    r = spark.read.option("header", True).option("inferSchema", True)
    return r.format(fmt).load(pattern)


def quarantined_site_lines(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """(file, line, text, fault) of the lines that ``read_site_results`` leaves out."""
    bad = site_rows(spark, pattern, schema).where(F.col("_fault").isNotNull())
    return bad.select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_text").alias("text"), F.col("_fault").alias("fault"))
