"""Session defaults and the scratch tables that cut lineage in iterative operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build(app: str = "tracewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is made only where that setting is absent and
    the session is local (tests, bench); a cluster without the setting is an error, not a machine-local folder.
    """
    named = spark.sparkContext.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if getattr(context, "_tracewright_dir", None) is None:
        context._tracewright_dir = tempfile.mkdtemp(prefix="tracewright-")
        atexit.register(shutil.rmtree, context._tracewright_dir, ignore_errors=True)
    return "file://" + context._tracewright_dir


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables written to the shared folder and read back: they survive lost executors and give the planner sizes."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tracewright/{label}-{uuid.uuid4().hex[:12]}"
        self.paths: dict[str, str] = {}

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back; an earlier table of that name is kept until ``drop``."""
        path = f"{self.root}/{name}-{len(self.paths)}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        self.paths[path] = name
        return self.spark.read.schema(df.schema).parquet(path)

    def counted(self, name: str, df: DataFrame, of: Column | None = None) -> tuple[DataFrame, int]:
        """``table``, and the number of its rows for which ``of`` holds (all without it), counted as they are written."""
        seen = Observation()
        out = self.table(name, df.observe(seen, F.count_if(F.lit(True) if of is None else of).alias("n")))
        return out, seen.get["n"]

    def append(self, name: str, part: int, df: DataFrame, of: Column | None = None) -> tuple[DataFrame, int]:
        """Write ``df`` as one part of a table that grows with each round; that part and its number of rows, as in ``counted``."""
        path = f"{self.root}/{name}/round={part}"
        seen = Observation()
        df.observe(seen, F.count_if(F.lit(True) if of is None else of).alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get["n"]

    def appended(self, name: str, schema: StructType) -> DataFrame:
        """All parts of such a table in one scan."""
        return self.spark.read.schema(StructType([*schema.fields, StructField("round", IntegerType())])).parquet(f"{self.root}/{name}").drop("round")

    def drop(self, *names: str) -> None:
        """Delete the tables of these names that nothing reads any more."""
        for path, name in list(self.paths.items()):
            if name in names:
                _delete(self.spark, path)
                del self.paths[path]
                self.paths[f"{path}-gone"] = ""
