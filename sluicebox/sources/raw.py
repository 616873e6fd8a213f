"""The four raw tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicebox.session import size_shuffles


# Behind the name of a timestamp column: its nanoseconds within the microsecond.
NANOS = "_nanos"


def key_columns(df: DataFrame, key: tuple[str, ...]) -> tuple[str, ...]:
    """A key's columns, with the nanoseconds of its timestamps where the table has them."""
    return (*key, *[f"{name}{NANOS}" for name in key if f"{name}{NANOS}" in df.columns])


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STRING, _DOUBLE, _TIME = T.StringType(), T.DoubleType(), T.TimestampNTZType()

SCHEMAS = {
    "traffic_logs": _schema(
        session_id=_STRING, user_id=_STRING, timestamp=_TIME, traffic_source=_STRING, device=_STRING, product_id_viewed=_STRING
    ),
    "cart_actions": _schema(session_id=_STRING, user_id=_STRING, timestamp=_TIME, action=_STRING, product_id=_STRING),
    "checkout_events": _schema(
        checkout_id=_STRING, session_id=_STRING, user_id=_STRING, timestamp=_TIME, checkout_status=_STRING, cart_value=_DOUBLE
    ),
    "orders": _schema(
        order_id=_STRING,
        session_id=_STRING,
        user_id=_STRING,
        timestamp=_TIME,
        gross_revenue=_DOUBLE,
        discount_applied=_DOUBLE,
        product_id=_STRING,
        order_status=_STRING,
    ),
}


@dataclass(frozen=True)
class RawTables:
    traffic_logs: DataFrame
    cart_actions: DataFrame
    checkout_events: DataFrame
    orders: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(field.name, getattr(self, field.name)) for field in fields(self)]


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Lazy scan. With a schema, its timestamps are read as UTC wall-clock time whatever the session time zone.

    Declared columns that the file lacks are left out, so using one fails instead of giving NULLs. A timestamp stored
    in nanoseconds, a unit Spark has no type for, arrives as a number and is cut to microseconds; what is cut off is
    kept in a column of its name with ``_NANOS`` behind, so that events within a microsecond stay apart.
    """
    stored = spark.read.parquet(path)
    if schema is None:
        return stored
    in_file = {field.name: field.dataType for field in stored.schema}
    wanted = T.StructType()
    for field in schema:
        if field.name in in_file:
            as_declared = isinstance(field.dataType, T.TimestampNTZType) and isinstance(in_file[field.name], T.TimestampType)
            wanted.add(field.name, field.dataType if as_declared else in_file[field.name])
    # The files are listed a second time only if a column's type differs from the stored one.
    as_stored = all(in_file[field.name] == field.dataType for field in wanted)
    table = stored.select(*wanted.names) if as_stored else spark.read.schema(wanted).parquet(path)
    nanos = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType) and isinstance(in_file.get(f.name), T.LongType)]
    rest = {f"{name}{NANOS}": F.expr(f"int(pmod({name}, 1000))") for name in nanos}
    return table.withColumns(rest).withColumns({name: _from_nanos(name) for name in nanos}) if nanos else table


def _from_nanos(name: str) -> Column:
    micros = f"({name} - pmod({name}, 1000)) DIV 1000"
    return F.expr(f"TIMESTAMP_NTZ'1970-01-01' + make_dt_interval(0, 0, 0, CAST({micros} AS DECIMAL(20, 0)) / 1000000)")


def load_raw(spark: SparkSession, directory: str) -> RawTables:
    """The raw tables of a folder with one parquet file or folder per table."""
    paths = {name: f"{directory}/{name}.parquet" for name in SCHEMAS}
    size_shuffles(spark, *paths.values())
    return RawTables(**{name: read_parquet(spark, path, SCHEMAS[name]) for name, path in paths.items()})


def register_raw(raw: RawTables) -> None:
    """Make the raw tables available to SQL under their names."""
    for name, table in raw.items():
        table.createOrReplaceTempView(name)
