"""Warehouse tables as Parquet folders under one root."""

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import TABLES


# The column whose values are the folders of a fact, and the date key it is the year of. Transfers lie
# in folders of their season, a column of their own.
YEAR = "folder_year"
FOLDERS: dict[str, tuple[str, str | None]] = {
    "fact_games": (YEAR, "date_id"),
    "fact_appearances": (YEAR, "date_id"),
    "fact_game_events": (YEAR, "date_id"),
    "fact_transfers": ("transfer_season", None),
    "fact_player_valuations": (YEAR, "date_id"),
}


def read_folders(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as it is stored, with the column of its folders."""
    try:
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException as error:
        # A table in folders that has no rows has no file to tell its columns.
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA" or name not in FOLDERS:
            raise
        return spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in TABLES[name].items()))


def declared(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a stored fact in their order; other tables as they are."""
    return df.select(*[c for c in TABLES[name] if c in df.columns]) if name in FOLDERS else df


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A loaded table; Spark reads only the columns a query uses."""
    return declared(read_folders(spark, root, name), name)


def write_table(
    df: DataFrame, root: str, name: str, mode: str = "append", partition_by: Sequence[str] = (), dynamic: bool = False
) -> None:
    """Append to or replace a table; every task writes its own part.

    With ``dynamic``, replacing a table in folders replaces only the folders that have new rows.
    """
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{name}")


def in_folders(df: DataFrame, name: str, years: tuple[int, int] | None = None) -> DataFrame:
    """The rows of a fact as its folders want them: dealt by folder, in order of folder and date.

    The rebalance lets Spark split the folders that have more rows than a task should write and put
    small ones together, so neither one large year nor many small ones make bad files. In order of the
    date, the date filters of the reports also skip row groups by their statistics. ``years``
    keeps a span of folders. Other tables are returned as they are.
    """
    if name not in FOLDERS:
        return df
    folder, date_key = FOLDERS[name]
    if date_key:
        df = df.withColumn(folder, F.floor(F.col(date_key) / 10000).cast("int"))
    if years:
        df = df.filter(F.col(folder).between(*years))
    return df.hint("rebalance", folder).sortWithinPartitions(folder, date_key or "transfer_date_id")


def write_folders(
    df: DataFrame, root: str, name: str, years: tuple[int, int] | None = None, ready: bool = False, more: bool = False
) -> None:
    """Replace a table, or with ``years`` these folders of it; ``ready`` rows have been through ``in_folders``.

    With ``more``, the rows are added to the table instead.
    """
    rows = df if ready else in_folders(df, name, years)
    folder = [FOLDERS[name][0]] if name in FOLDERS else []
    write_table(rows, root, name, mode="append" if more else "overwrite", partition_by=folder, dynamic=years is not None)


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make the tables in ``root/version`` the current ones, by one committed append."""
    row = spark.range(1).select(F.current_timestamp().alias("loaded_at"), F.lit(version).alias("version"))
    row.write.mode("append").parquet(f"{root}/current")


def current_root(spark: SparkSession, root: str) -> str:
    """The folder of the version published last, or ``root`` where none was."""
    try:
        versions = spark.read.parquet(f"{root}/current")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return root
    return f"{root}/{versions.orderBy(F.desc('loaded_at'), F.desc('version')).first().version}"


def load_metrics(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while it is written, without another scan."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


class Warehouse(Mapping):
    """The tables of a warehouse by name, each opened when it is first asked for."""

    def __init__(self, open_table: Callable[[str], DataFrame], names: Sequence[str] = tuple(TABLES)):
        """``open_table`` may return a fact with the column of its folders, which is not shown."""
        self._open_table = open_table
        self._names = tuple(names)
        self._opened: dict[str, DataFrame] = {}

    @classmethod
    def at(cls, spark: SparkSession, root: str) -> "Warehouse":
        """The tables published last under ``root``, or those in it."""
        return cls.in_folder(spark, current_root(spark, root))

    @classmethod
    def in_folder(cls, spark: SparkSession, folder: str) -> "Warehouse":
        """The tables of one version."""
        return cls(lambda name: read_folders(spark, folder, name))

    def _stored(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._opened:
            self._opened[name] = self._open_table(name)
        return self._opened[name]

    def __getitem__(self, name: str) -> DataFrame:
        stored = self._stored(name)
        return declared(stored, name) if YEAR in stored.columns or name == "fact_transfers" else stored

    def in_years(self, name: str, first: int, last: int) -> DataFrame:
        """A fact without the folders outside of a span of years; the caller still filters its dates."""
        stored = self._stored(name)
        return declared(stored.filter(F.col(YEAR).between(first, last)), name) if YEAR in stored.columns else self[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)
