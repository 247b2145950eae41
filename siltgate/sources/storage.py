"""Folders on whatever file system the paths name, and scratch space shared by all executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Write option for the `_SUCCESS` marker, which a cluster may have turned off.
WITH_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": True}
PARKED = "_parked_"
REQUESTS = 16

T, R = TypeVar("T"), TypeVar("R")


def join_path(*parts: str | int) -> str:
    first, *rest = [str(p) for p in parts]
    return "/".join([first.rstrip("/"), *[p.strip("/") for p in rest]])


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def for_each(work: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """Small requests to a file system, many at a time: they wait, they do not compute."""
    with ThreadPoolExecutor(REQUESTS) as pool:
        return list(pool.map(work, items))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written this folder to the end."""
    return exists(spark, join_path(path, "_SUCCESS"))


def _entries(spark: SparkSession, path: str) -> dict[str, bool]:
    """What lies directly below `path`: names, and whether they are folders. Not recursive."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    return {s.getPath().getName(): s.isDirectory() for s in fs.listStatus(hadoop_path)}


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below `path`, none if it does not exist."""
    return sorted(_entries(spark, path))


def sizes_below(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the files directly below `path`, by name."""
    fs, hadoop_path = _open(spark, path)
    return {s.getPath().getName(): s.getLen() for s in fs.listStatus(hadoop_path) if s.isFile()}


def files_at(spark: SparkSession, path: str) -> list[str]:
    """The data files that Spark would read at a file or folder: those directly in it whose names are not hidden."""
    fs, hadoop_path = _open(spark, path)
    found = fs.listStatus(hadoop_path)
    return sorted(
        s.getPath().toString() for s in found if s.isFile() and s.getLen() and not s.getPath().getName().startswith(("_", "."))
    )


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, of which no more is read than a buffer holds."""
    fs, hadoop_path = _open(spark, path)
    java = spark._jvm.java
    reader = java.io.BufferedReader(java.io.InputStreamReader(fs.open(hadoop_path), "UTF-8"))
    try:
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        reader.close()


def add_file(spark: SparkSession, new: str, path: str) -> bool:
    """Move a file to a place where there is none yet; False if there is one."""
    files = spark._jvm.org.apache.hadoop.fs
    source = files.Path(new)
    context = files.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(files.Options.Rename, 0)
    try:
        context.rename(source, files.Path(path), none)
    except Py4JJavaError as error:
        if exists(spark, path):
            return False
        raise OSError(f"{new} could not be moved to {path}") from error
    return True


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below `path`, none if it does not exist."""
    return sorted(name for name, is_folder in _entries(spark, path).items() if is_folder)


def mode_for(spark: SparkSession, path: str, mode: str) -> str:
    """The save mode to use: what a job that died left behind does not count as being there.

    Such remains are known by the folder in which committers keep unfinished work, or by the lack of any file. Files
    without a marker may be anything, so they are neither replaced nor taken for a finished result.
    """
    if mode == "overwrite" or not exists(spark, path) or is_complete(spark, path):
        return mode
    names = _entries(spark, path)
    if all(n.startswith(("_", ".")) for n in names) or any(n.startswith(("_temporary", "__magic")) for n in names):
        return "overwrite"
    raise FileExistsError(f"{path} holds files but no _SUCCESS marker: remove it or overwrite it")


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a complete folder in the place of another, which is parked beside it until then and comes back if that fails."""
    fs, target = _open(spark, path)
    parent, name = path.rstrip("/").rsplit("/", 1)
    parked = join_path(parent, f"{PARKED}{name}")
    if fs.exists(target):
        remove(spark, parked)
        if not fs.rename(target, _open(spark, parked)[1]):
            raise OSError(f"{path} could not be moved aside")
    try:
        moved = fs.rename(_open(spark, new)[1], target)
    finally:
        restore_parked(spark, parent)
    if not moved:
        raise OSError(f"{new} could not be moved to {path}")
    remove(spark, parked)


def restore_parked(spark: SparkSession, parent: str) -> None:
    """Bring back folders that a run which died in `replace_folder` left parked, where nothing took their place."""
    for name in subfolders(spark, parent):
        place = join_path(parent, name.removeprefix(PARKED))
        if name.startswith(PARKED) and not exists(spark, place):
            fs, parked = _open(spark, join_path(parent, name))
            fs.rename(parked, _open(spark, place)[1])


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, below the session's `spark.checkpoint.dir`.

    The folder must be visible to every executor, so only a local session may fall back to a temporary folder of
    this machine. Spark's JVM removes the scratch folder when it exits.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="siltgate-")
    folder = join_path(root, f"siltgate-{uuid.uuid4().hex}")
    fs, hadoop_path = _open(spark, folder)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return folder


def clear_scratch(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder whose tables are no longer read, instead of leaving it until the JVM exits."""
    remove(spark, folder)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs run inside, put back afterwards; `_` in a name stands for `.`."""
    names = {n.replace("_", "."): v for n, v in values.items()}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file from any file system, as for schemas."""
    return "\n".join(row["value"] for row in spark.read.text(path, wholetext=True).collect())


def read_note_text(spark: SparkSession, path: str) -> str | None:
    """What `write_note` wrote, None if there is nothing."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small hidden file beside data files; Spark's readers skip names with an underscore."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
