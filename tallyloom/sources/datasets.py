"""Named Parquet and CSV datasets."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.operators.keys import first_rows


# Text comes back as it was: blanks at its ends, empty text apart from null, line breaks in quotes.
# Files with line breaks in text are not split, so they are kept small.
CSV_FORM = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\\N",
    "emptyValue": "",
    "lineSep": "\n",
}
CSV_ROWS_PER_FILE = 500_000


def dataset_path(root: str, name: str, suffix: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{name}.{suffix}"


def read_dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A named dataset, ``<root>/<name>.parquet``."""
    return spark.read.parquet(dataset_path(root, name))


def read_landing(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str
) -> DataFrame:
    """All landed files of one entity in one scan.

    The schema is given, so nothing is inferred: columns a file lacks are null, files with other
    columns are fine, and a code used as a directory name keeps its leading zeros.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).parquet(*paths)


def sql_over_tables(spark: SparkSession, tables: Mapping[str, str | DataFrame], sql: str) -> DataFrame:
    """Run SQL over Parquet paths (or DataFrames) known by alias for this one query.

    The aliases are views of a session that is made for the call, so the statement is any SQL (comments, hints,
    recursion, tables of its own) and the caller's views are neither seen nor touched. Settings are the caller's;
    the names of its permanent tables can be used.
    """
    apart = spark.newSession()
    mine = spark._jsparkSession.sessionState().conf().getAllConfs()
    theirs = apart._jsparkSession.sessionState().conf()
    for setting in mine.keys().mkString("\n").split("\n"):
        theirs.setConfString(setting, mine.apply(setting))
    for alias, table in tables.items():
        frame = apart.read.parquet(table) if isinstance(table, str) else _moved(apart, table)
        frame.createOrReplaceTempView(alias)
    return _moved(spark, apart.sql(sql))


def _moved(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The same plan in another session of the application."""
    plan = df._jdf.queryExecution().analyzed()
    rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan)
    return DataFrame(rows, spark)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own making, wherever it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def recover(spark: SparkSession, path: str) -> bool:
    """Put back the dataset of a replacement that ended between its two renames; whether there was one."""
    files, folder = _folder(spark, path)
    _, aside = _folder(spark, _aside(path))
    if files.exists(aside) and not files.exists(folder):
        return files.rename(aside, folder)
    return False


def _aside(path: str) -> str:
    root, _, name = path.rpartition("/")
    return f"{root}/_replaced-{name}"


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Replace a dataset by what ``write`` writes to the path it is given; returns the dataset's path.

    All rows are written beside the dataset first, so a job that fails leaves the old rows, and a job may read what it replaces.
    Then the old folder is renamed aside, the new one renamed into its place, and the old one deleted. A process
    that ends between the renames leaves the old rows aside: the next call, or ``recover``, puts them back. File systems that rename by copying
    take longer, not another result. One writer of a dataset at a time.
    """
    recover(spark, path)
    files, folder = _folder(spark, path)
    root, _, name = path.rpartition("/")
    staged = f"{root}/_staged-{name}-{uuid.uuid4().hex}"
    try:
        write(staged)
        _, fresh = _folder(spark, staged)
        _, aside = _folder(spark, _aside(path))
        files.delete(aside, True)
        if files.exists(folder) and not files.rename(folder, aside):
            raise OSError(f"cannot move {path} aside")
        if not files.rename(fresh, folder):
            recover(spark, path)
            raise OSError(f"cannot move the new rows to {path}")
        files.delete(aside, True)
    finally:
        remove(spark, staged)
    return path


def write_parquet(df: DataFrame, root: str, name: str) -> str:
    """Replace a named Parquet dataset (see ``replace``); returns its path."""
    return replace(df.sparkSession, dataset_path(root, name), lambda staged: df.write.parquet(staged))


def write_csv(df: DataFrame, root: str, name: str) -> str:
    """Replace a named CSV dataset, a header row in each file, quotes doubled; returns its path."""
    form = {**CSV_FORM, "emptyValue": '""', "maxRecordsPerFile": CSV_ROWS_PER_FILE}
    write = df.write.options(**form)
    return replace(df.sparkSession, dataset_path(root, name, "csv"), lambda staged: write.csv(staged))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV dataset as written by ``write_csv``, under a given schema."""
    return spark.read.schema(schema).options(**CSV_FORM, multiLine=True).csv(path)


def write_csv_sample(
    df: DataFrame, root: str, name: str, keys: Sequence[str], rows: int = 5000
) -> str:
    """The first ``rows`` rows by key as one CSV file next to the full dataset."""
    return write_csv(first_rows(df, keys, rows), root, name)
