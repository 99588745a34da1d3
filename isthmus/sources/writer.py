"""Loading a query's result into an existing table, whole or not at all.

Columns are matched and every value checked by expressions, and cast to the table's own types, before rows are staged in a folder of the
load's own; the driver then publishes the staged files by renames, at the end, takes them back and removes the stage on any error. Only
where a published file cannot be taken back is the load partial, and said to be. Task retries only ever touch the stage. A load with a name
(a micro-batch) is done once: its files carry the name, and a repeated load first removes what an earlier one left half done.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isthmus.functions.temporal import in_range, whole_seconds
from isthmus.sources.names import BridgeError
from isthmus.sources.types import RemoteColumn, number_limits, read_type, write_fits

REFUSED = ("per_thread_output", "partition_by", "file_size_bytes", "use_tmp_file")


class PartialLoadError(BridgeError):
    """Some staged files were published and some were not."""


def matched_columns(schema: T.StructType, target: list[RemoteColumn]) -> list[tuple[str, RemoteColumn]]:
    """Each source column with its target: by exact name, else by a unique name without regard to case."""
    pairs = []
    for f in schema:
        same = [c for c in target if c.name == f.name] or [c for c in target if c.name.lower() == f.name.lower()]
        if len(same) != 1:
            raise BridgeError(f"column {f.name}: {'no' if not same else 'more than one'} target column")
        if any(c is same[0] for _, c in pairs):
            raise BridgeError(f"column {same[0].name} is given twice")
        if not write_fits(f.dataType, same[0]):
            raise BridgeError(f"column {f.name}: {f.dataType.simpleString()} is unsupported for {same[0].data_type}; convert with CAST")
        pairs.append((f.name, same[0]))
    missing = [c.name for c in target if not c.nullable and not any(c is t for _, t in pairs)]
    if missing:
        raise BridgeError(f"columns {', '.join(missing)} may not be null and are not given")
    return pairs


def matched(df: DataFrame, target: list[RemoteColumn]) -> list[tuple[str, RemoteColumn]]:
    return matched_columns(df.schema, target)


def _number(c: Column, source: T.DataType, target: RemoteColumn, fail) -> Column:
    """The value rounded half away from zero to the target's scale, or an error if it has more digits before the point than fit."""
    if (limits := number_limits(target)) is None:
        return c
    whole, scale = limits
    exact = c.cast("string").try_cast("decimal(38,10)") if isinstance(source, (T.FloatType, T.DoubleType)) else c.cast("decimal(38,0)") if isinstance(source, T.IntegralType) else c
    rounded = F.round(exact, scale)
    width = max(1, min(38, whole + max(scale, 0)))
    kept = rounded.try_cast(f"decimal({width},{max(scale, 0)})")
    if scale < 0:  # digits before the point are rounded away
        kept = F.when(F.abs(rounded) < F.lit(10).cast("decimal(38,0)") * 0 + F.lit(f"1{'0' * whole}").cast("decimal(38,0)"), rounded.try_cast(f"decimal({min(38, whole)},0)"))
    return F.when(c.isNotNull() & kept.isNull(), fail(f"out of range for NUMBER({target.precision or '*'},{scale})").cast(f"decimal({width},{max(scale, 0)})")).otherwise(kept)


def checked(name: str, source: T.DataType, target: RemoteColumn) -> Column:
    """The value as the target holds it, or an error that names the column."""
    c, t = F.col(f"`{name}`"), target.data_type.upper()
    fail = lambda what: F.raise_error(F.concat(F.lit(f"column {target.name}: {what}: "), F.coalesce(c.cast("string"), F.lit("null"))))
    if isinstance(source, T.StringType):
        v = F.nullif(c, F.lit(""))
        v = F.when(F.octet_length(v) > target.length, fail(f"longer than {target.length} bytes")).otherwise(v) if target.length else v
        v = F.rpad(v, target.length, " ") if t in ("CHAR", "NCHAR") and target.length else v
    elif isinstance(source, T.BooleanType):
        v = c.cast("int")
        v = _number(v, T.IntegerType(), target, fail) if t == "NUMBER" else v
    elif isinstance(source, (T.FloatType, T.DoubleType)) and t in ("NUMBER", "FLOAT"):
        v = F.when(F.isnan(c) | F.abs(c).eqNullSafe(F.lit(float("inf"))), fail("not finite").cast(source)).otherwise(c)
        v = _number(v, source, target, fail) if t == "NUMBER" else v
    elif isinstance(source, (T.DateType, T.TimestampNTZType)):
        v = F.when(~in_range(c), fail("year outside 1 to 9999").cast(source)).otherwise(c)
        v = whole_seconds(v) if t == "DATE" and isinstance(source, T.TimestampNTZType) else v
        digits = t[t.find("(") + 1 : t.find(")")] if t.startswith("TIMESTAMP") and "(" in t else "6"
        if isinstance(source, T.TimestampNTZType) and digits.isdigit() and int(digits) < 6 and t != "DATE":
            step = 10 ** (6 - int(digits))
            us = F.unix_micros(v.cast("timestamp"))
            v = F.timestamp_micros((F.floor((us + step // 2) / F.lit(step)) * step).cast("long")).cast("timestamp_ntz")
    elif isinstance(source, (T.IntegralType, T.DecimalType)) and t == "NUMBER":
        v = _number(c, source, target, fail)
    else:
        v = c
    return v if target.nullable else F.when(v.isNull(), fail("null")).otherwise(v)


def stored_types(target: list[RemoteColumn], known: T.StructType | None) -> dict[str, T.DataType]:
    """What each column is stored as: the table's own type where it has files, else the type that it reads as."""
    have = {f.name: f.dataType for f in known or ()}
    return {c.name: have.get(c.name) or read_type(c) or T.StringType() for c in target}


def _fs(spark: SparkSession, place: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return path(place).getFileSystem(conf), path


def load(df: DataFrame, folder: str, target: list[RemoteColumn], job: str | None = None, **options: object) -> int:
    """Appends df to the Parquet table in folder; returns the rows loaded. With a job name, a load that was published before is not
    repeated (0 rows)."""
    for o in options:
        raise BridgeError(f"option {o}: " + ("is for files" if o.lower() in REFUSED else "is not known"))
    pairs = matched(df, target)
    spark, folder = df.sparkSession, folder.rstrip("/")
    name = job or uuid.uuid4().hex
    stage, mark = f"{folder}/_stage-{name}", f"{folder}/_done-{name}"
    fs, path = _fs(spark, stage)
    if job:
        if fs.exists(path(mark)):
            return 0
        for s in fs.listStatus(path(folder)) if fs.exists(path(folder)) else ():  # of an attempt that died while it published
            if s.getPath().getName().startswith(f"part-{name}-"):
                fs.delete(s.getPath(), False)
        fs.delete(path(stage), True)
    data = [s for s in fs.listStatus(path(folder)) if not s.getPath().getName().startswith(("_", "."))] if fs.exists(path(folder)) else []
    kinds = stored_types(target, spark.read.parquet(folder).schema if data else None)
    given = {c.name: checked(n, df.schema[n].dataType, c) for n, c in pairs}
    rows = df.select(*((given[c.name] if c.name in given else F.lit(None)).cast(kinds[c.name]).alias(c.name) for c in target))
    done: list[str] = []
    try:
        rows.write.parquet(stage)
        loaded = spark.read.schema(rows.schema).parquet(stage).count()
        staged = [n for s in fs.listStatus(path(stage)) if (n := s.getPath().getName()).startswith("part-")]
        try:
            for n in staged:
                final = f"{folder}/part-{name}-{n.removeprefix('part-')}"
                if not publish(fs, path(f"{stage}/{n}"), path(final)):
                    raise OSError(f"cannot rename {n}")
                done.append(final)
            if job:
                fs.create(path(mark), True).close()
        except Exception as e:
            left = [f for f in done if not taken_back(fs, path(f))]
            raise (PartialLoadError if left else BridgeError)(f"{'PARTIAL load' if left else 'load failed'}: {len(left)} of {len(staged)} files stay in {folder}: {e}") from e
        return loaded
    finally:
        fs.delete(path(stage), True)


def publish(fs, staged, final) -> bool:
    return fs.rename(staged, final)


def taken_back(fs, file) -> bool:
    try:
        return fs.delete(file, False)
    except Exception:  # noqa: BLE001  whatever a store raises, the file may still be there
        return False


def create(df: DataFrame, folder: str, target: list[RemoteColumn]) -> int:
    """CREATE TABLE AS: a new table of the target's columns with df's rows; an error if the folder is there."""
    fs, path = _fs(df.sparkSession, folder)
    if fs.exists(path(folder)):
        raise BridgeError(f"{folder} exists")
    fs.mkdirs(path(folder))
    try:
        return load(df, folder, target)
    except Exception:
        fs.delete(path(folder), True)
        raise
