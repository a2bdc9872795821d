"""Relational sink over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 10000


@dataclass(frozen=True)
class JdbcTarget:
    """Where to write. ``num_partitions`` bounds the connections opened at once."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    num_partitions: int = 16
    batch_size: int = BATCH_ROWS


def flatten_for_jdbc(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text; relational columns cannot hold them."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def write_jdbc(df: DataFrame, target: JdbcTarget, table: str, mode: str = "append") -> None:
    """Append, or overwrite by truncating so that the table keeps its definition.

    JDBC has no commit across tasks: a task that is retried may repeat rows already
    sent. The table's primary key is what rejects them, and the error is raised here.
    """
    properties = {
        **target.properties,
        "batchsize": str(target.batch_size),
        "numPartitions": str(target.num_partitions),
        "truncate": "true" if mode == "overwrite" else "false",
    }
    flatten_for_jdbc(df).write.jdbc(url=target.url, table=table, mode=mode, properties=properties)
