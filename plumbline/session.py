"""Session settings and the shared folder that state and cut lineage live in."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(app: str = "plumbline", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """New folder below the one the cluster names in `spark.checkpoint.dir`.

    Where the setting is absent only a local session may fall back to a
    temporary folder: other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="plumbline-")
    elif root.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        # A mounted share is possible, a machine's own temporary folder is not.
        place = root.removeprefix("file:").replace("//", "/")
        if place.startswith((tempfile.gettempdir() + "/", "/tmp/", "/var/tmp/")):
            raise ValueError(f"spark.checkpoint.dir names {root}, which other machines cannot read")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tasks that list the folders of one read.
LISTING_TASKS = 64
#: Bytes, as shuffled, of the largest partition that a join may hold as a hash table.
HASHED_PARTITION = 64 << 20


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Reads opened inside list their folders in few tasks; Spark would start one for every folder."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    with _setting(spark, name, str(min(int(spark.conf.get(name)), LISTING_TASKS))):
        yield


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Joins run inside needn't sort their sides where every partition of one turns out small."""
    with _setting(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", str(HASHED_PARTITION)):
        yield


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python workers import it.

    Clusters that install it, or put it on PYTHONPATH, lose nothing by it.
    """
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="plumbline-")) / "plumbline.zip"
    with zipfile.ZipFile(out, "w") as pack:
        for source in sorted(here.rglob("*.py")):
            pack.write(source, source.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(out))
    _SHIPPED.add(spark.sparkContext.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a DataFrame once and keep it reliably, so later uses re-read it."""
    spark = df.sparkSession
    path = shared_folder(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
