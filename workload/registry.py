"""Registration of queries next to the SQL they must agree with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions.values import joined
from casebook.session import tune
from workload.views import Tables
from workload.views_sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and arrays as text, so that both engines' results compare byte by byte."""
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    columns = {}
    for field in df.schema:
        if isinstance(field.dataType, dates):
            columns[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            columns[field.name] = joined(F.col(field.name))
    return df.withColumns(columns) if columns else df


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under a name, with its SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Tables(tune(spark), sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
