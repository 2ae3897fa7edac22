"""Tables for serving: a JDBC database, or Parquet folders, replaced one by one or together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Protocol, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from fundflow.sources.lake import with_audit
from fundflow.sources.snapshots import Conflict, Snapshots

__all__ = [
    "Conflict",
    "JdbcWarehouse",
    "ParquetWarehouse",
    "SnapshotWarehouse",
    "Warehouse",
    "jdbc_properties",
    "postgres_url",
    "side_by_side",
    "write_jdbc",
]

Item = TypeVar("Item")
Result = TypeVar("Result")


def postgres_url(host: str, port: int | str, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def jdbc_properties(
    user: str, password: str, driver: str = "org.postgresql.Driver"
) -> dict[str, str]:
    return {"user": user, "password": password, "driver": driver}


def write_jdbc(
    df: DataFrame,
    table: str,
    url: str,
    props: Mapping[str, str],
    truncate: bool = True,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """Replace a database table.

    ``truncate`` keeps the table and its grants when the schema is unchanged.
    ``connections`` bounds the number of tasks that write at once, whatever the
    size of the frame: rows are dealt to them by a shuffle of their own, so that
    what computes the frame keeps its tasks. Each task commits on its own: replacing several tables,
    or one table from several tasks, is not one transaction, so re-run the step
    if it fails.
    """
    (
        df.repartition(connections)
        .write.mode("overwrite")
        .option("truncate", str(truncate).lower())
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .jdbc(url, table, properties=dict(props))
    )


def side_by_side(
    spark: SparkSession, job: Callable[[Item], Result], items: Sequence[Item]
) -> list[Result]:
    """Run independent Spark jobs at once, so that one fills the tail of another.

    All are awaited; the first error, if any, is then raised.
    """
    # Each thread takes over the caller's job group, tags and other properties.
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        running = [pool.submit(inherit(partial(job, item))) for item in items]
    return [one.result() for one in running]


class Warehouse(Protocol):
    """What the gold step needs of a target: replace tables, read one back."""

    def publish(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> None: ...

    def read(self, spark: SparkSession, table: str) -> DataFrame: ...

    def count(self, spark: SparkSession, table: str) -> int: ...


@dataclass(frozen=True)
class JdbcWarehouse:
    """Gold tables in a database."""

    url: str
    props: Mapping[str, str] = field(repr=False)
    truncate: bool = True

    def publish(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
        """Replace tables side by side; each becomes visible on its own."""
        side_by_side(spark, lambda name: self.replace(name, tables[name]), list(tables))

    def replace(self, table: str, df: DataFrame) -> None:
        write_jdbc(with_audit(df), table, self.url, self.props, self.truncate)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.jdbc(self.url, table, properties=dict(self.props))

    def count(self, spark: SparkSession, table: str) -> int:
        """Counted by the database, so one row comes back."""
        counted = f"(SELECT count(*) AS n FROM {table}) AS counted"
        row = spark.read.jdbc(self.url, counted, properties=dict(self.props)).first()
        return int(row["n"])


@dataclass(frozen=True)
class ParquetWarehouse:
    """Gold tables as Parquet folders, one per table."""

    root: str

    def publish(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
        """Replace tables side by side; each becomes visible on its own."""
        side_by_side(spark, lambda name: self.replace(name, tables[name]), list(tables))

    def replace(self, table: str, df: DataFrame) -> None:
        with_audit(df).write.parquet(f"{self.root}/{table}", mode="overwrite")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{table}")

    def count(self, spark: SparkSession, table: str) -> int:
        return self.read(spark, table).count()


@dataclass(frozen=True)
class SnapshotWarehouse:
    """Gold tables as Parquet folders that become visible together.

    Every table goes to a new folder; one commit then names all of them. A run
    that fails before it leaves the tables as they were, whichever it had
    written. Readers that resolved a version go on reading its files until
    ``Snapshots.clean`` removes them.
    """

    root: str

    def publish(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
        """Replace all these tables at once; other tables stay as they are."""
        versions = Snapshots(spark, self.root)
        before = versions.current()
        folders = {name: versions.folder(name) for name in tables}
        side_by_side(
            spark,
            lambda name: with_audit(tables[name]).write.parquet(folders[name]),
            list(tables),
        )
        versions.commit({**before.content, **folders}, before)

    def replace(self, table: str, df: DataFrame) -> None:
        self.publish(df.sparkSession, {table: df})

    def read(self, spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
        """A table of the last commit, or of an earlier one that was kept."""
        versions = Snapshots(spark, self.root)
        found = versions.current() if version is None else versions.read(version)
        if table not in found.content:
            raise ValueError(f"no table {table} in version {found.number} of {self.root}")
        return spark.read.parquet(found.content[table])

    def count(self, spark: SparkSession, table: str) -> int:
        return self.read(spark, table).count()
