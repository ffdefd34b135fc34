"""Session defaults and the helpers that every stage shares."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Settings that suit a laptop run and do not hurt on a cluster; a caller's own settings win.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
_SHIPPED: set[str] = set()
#: Where stored() wrote each frame that it returned.
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Frames stored since settled() began, of this thread alone.
_SINCE: ContextVar[list[DataFrame] | None] = ContextVar("since", default=None)


def session(master: str = "local[*]", app: str = "lexiloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under a directory; the path may be of any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, which their Python workers import; once an application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lexiloom-code-")  # of the driver, which serves the file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder, f"{top.name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(top.rglob("*.py")):
            file.write(source, source.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(path))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where none is set, on a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='lexiloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Removes scratch space in any store; the session may be gone by now."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:
        return


def scratch(spark: SparkSession, kind: str) -> str:
    """A new place in the shared folder, which goes when the driver ends."""
    path = f"{shared_dir(spark)}/lexiloom-{kind}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """df, written once as parquet in the shared folder and read again: the lineage ends there, what made it is not
    done again by later passes, and a lost executor costs no more than the read."""
    path = scratch(df.sparkSession, "stage")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PLACES[out] = path
    if _SINCE.get() is not None:
        _SINCE.get().append(out)
    return out


def released(*frames: DataFrame) -> None:
    """Removes what stored() wrote for the frames. Only for those that nothing reads any more: all that was made of them is stored
    in its own place. Frames that stored() did not return are left alone."""
    for df in frames:
        path = _PLACES.pop(df, None)
        if path:
            remove(df.sparkSession, path)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """stored(make()), after which all that make() stored on its way is removed."""
    made: list[DataFrame] = []
    token = _SINCE.set(made)
    try:
        df = make()
    finally:
        _SINCE.reset(token)
    out = stored(df)
    released(*made)
    return out
