"""Session, table and checkpoint helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Characters that count as blanks around keys: ASCII blanks and the no-break spaces.
BLANKS = " \t\r\n  　"


def local_session(name: str = "daybook", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime settings for the jobs run inside, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def checkpoint_folder(spark: SparkSession) -> str:
    """The reliable checkpoint folder: that of the context, else the one in ``spark.checkpoint.dir``.

    Where none is named a temporary folder is set on one machine (tests); on a
    cluster that is an error, as its executors don't share such a folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="daybook-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint folder and read back, with its partitions as they are."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Written:
    """Tables written to the checkpoint folder, one after the other, by a job of many rounds.

    Unlike a checkpoint, a table read back has its true size: estimates that
    were carried through the joins of many rounds would grow beyond all bounds.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_folder(spark)}/daybook-{uuid.uuid4().hex}"
        self.paths: list[str] = []

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_counted(self, df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
        """The written table, and aggregates of its rows taken while they are written.

        A task that is run twice may count twice, so a count says that there are
        rows and about how many.
        """
        seen = Observation()
        table = self.write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
        return table, seen.get

    def drop_before(self, keep: int) -> None:
        """Deletes all but the last ``keep`` tables."""
        jvm = self.spark.sparkContext._jvm
        for path in self.paths[: len(self.paths) - keep]:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clean_key(column: Column | str) -> Column:
    """A key without surrounding blanks, in lower case; blank becomes null."""
    c = F.col(column) if isinstance(column, str) else column
    c = F.lower(F.btrim(c, F.lit(BLANKS)))
    return F.when(c != "", c)


def bounded_rows(df: DataFrame, bound: int, what: str) -> list:
    """Rows of a lookup table that is small by nature, with its size checked.

    Raises ``ValueError`` where the table has more than ``bound`` rows, so that
    a grown table can never be gathered on the driver unnoticed.
    """
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows; it is meant to be a small lookup table")
    return rows
