"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from py4j.java_gateway import JavaObject, JVMView
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Settings that change results: instants are UTC, a repeated key in an event keeps its last value.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# HotSpot never compiles a method above 8000 bytes of bytecode. Beyond it, Spark is to
# generate code per operator, in small methods, instead of one method per stage.
SPEED_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(app_name: str = "velolake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on; extra keyword settings win.

    `conf` keys use "__" for ".", e.g. spark__sql__shuffle__partitions="64".
    """
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Compiled stages are kept for more than a hundred plans of a long session.
        "spark.sql.codegen.cache.maxEntries": "2000",
        **RESULT_SETTINGS,
        **SPEED_SETTINGS,
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_library_settings(spark: SparkSession) -> SparkSession:
    """Put the settings that can be changed at run time on a session someone else built."""
    for key, value in (RESULT_SETTINGS | SPEED_SETTINGS).items():
        spark.conf.set(key, value)
    return spark


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver has it.

    Executors on other machines need it installed, or sent with --py-files.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))
    return spark


# Where the applications of this process keep their scratch folders: application id -> folder.
_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared spark.checkpoint.dir, removed when the process ends.

    Only a local session may go without the setting: it gets a temporary folder of its own,
    which executors elsewhere could not see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _SCRATCH:
        if base:
            _SCRATCH[application] = f"{base.rstrip('/')}/velolake-{application}"
        else:
            _SCRATCH[application] = tempfile.mkdtemp(prefix="velolake-")
            atexit.register(shutil.rmtree, _SCRATCH[application], ignore_errors=True)
        # The file system does not need the session, so the folder also goes if that was stopped before.
        context = spark.sparkContext
        atexit.register(_remove, context._jvm, context._jsc.hadoopConfiguration(), _SCRATCH[application])
    return f"{_SCRATCH[application]}/{name}-{uuid.uuid4().hex}"


def _remove(jvm: JVMView, configuration: JavaObject, folder: str) -> None:
    """Delete the folder with the file system that it is on, as long as the virtual machine answers."""
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(configuration).delete(path, True)
    except (Py4JError, OSError):
        pass


# Folders that the open scopes answer for, the innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that were stored inside when the block ends.

    Yields a function that marks a DataFrame as needed later: the tables that its plan reads stay,
    and the enclosing scope, if any, answers for them. After an error nothing is deleted.
    """
    needed: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        needed.update(_read_folders(df))
        return df

    _SCOPES.append([])
    try:
        yield keep
    except BaseException:
        _SCOPES.pop()
        raise
    folders = _SCOPES.pop()
    context = spark.sparkContext
    for folder in folders:
        if os.path.basename(folder) in needed:
            if _SCOPES:
                _SCOPES[-1].append(folder)
        else:
            _remove(context._jvm, context._jsc.hadoopConfiguration(), folder)


def _read_folders(df: DataFrame) -> set[str]:
    """Names of the folders whose files the plan of `df` reads."""
    names, leaves = set(), df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            names.update(paths.apply(k).getName() for k in range(paths.size()))
    return names


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds for the block only."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Shuffle files of a finished write are deleted at once; a table that is stored needs them no longer.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as parquet in the shared folder and return the stored table.

    This cuts the lineage, survives lost executors, and gives the optimizer the
    table's real size, so small dimensions are broadcast and large ones are not.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    with setting(spark, _CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# What stored_once wrote: key -> path and schema.
_STORED: dict[tuple, tuple[str, StructType]] = {}


def stored_once(spark: SparkSession, key: tuple, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table stored under `key` earlier in this application, or `build()` stored now.

    A table that is no longer in the shared folder is built again.
    """
    key = (spark.sparkContext.applicationId, name, *key)
    if key in _STORED:
        path, schema = _STORED[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:
            del _STORED[key]
    df = build()
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    _STORED[key] = (path, df.schema)
    return spark.read.schema(df.schema).parquet(path)


def was_stored(spark: SparkSession, key: tuple, name: str) -> bool:
    """Whether stored_once has a table under `key` in this application."""
    return (spark.sparkContext.applicationId, name, *key) in _STORED


def fingerprint(spark: SparkSession, *paths: str) -> tuple:
    """Number of the files at `paths` and a hash of the path, size and change time of each, from their listing alone."""
    files = spark.read.format("binaryFile").load(list(paths))
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    return tuple(files.agg(F.count(F.lit(1)), F.bit_xor(each), F.sum(F.pmod(each, F.lit(1 << 31)))).first())
