"""Names of files and folders through the session's own file systems.

Control data alone: listings of folders, single small files, moves of finished files. The driver's
JVM does it with the credentials and schemes that Spark itself uses; no rows pass through here.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DEFAULT_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_DAY = re.compile(r"([0-9]{4})(?:-([0-9]{1,2})(?:-([0-9]{1,2}))?)?")


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_folder: bool
    size: int
    modified_at: datetime


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _is_a(error: Py4JJavaError, name: str) -> bool:
    kind = error.java_exception.getClass()
    while kind is not None:
        if kind.getName().endswith(name):
            return True
        kind = kind.getSuperclass()
    return False


def children(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly below a folder, by name; nothing if there is no such folder."""
    try:
        found = _files(spark, path).listStatus(_path(spark, path))
    except Py4JJavaError as error:
        if _is_a(error, "FileNotFoundException"):
            return []
        raise
    entries = [
        Entry(
            s.getPath().toString(),
            s.getPath().getName(),
            s.isDirectory(),
            s.getLen(),
            datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc).replace(tzinfo=None),
        )
        for s in found
    ]
    return sorted(entries, key=lambda e: e.name)


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder with all below it."""
    return _files(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Move one file or folder to a name that is not taken; False if it is."""
    jvm = spark._jvm
    if not exists(spark, parent := target.rsplit("/", 1)[0]):
        _files(spark, parent).mkdirs(_path(spark, parent))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, target).toUri(), spark._jsc.hadoopConfiguration()
    )
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = getattr(kinds, "NONE")
    try:
        context.rename(_path(spark, source), _path(spark, target), how)
    except Py4JJavaError as error:
        if _is_a(error, "FileAlreadyExistsException"):
            return False
        raise
    return True


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name that is not taken, whole or not at all; False if it is."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.draft-{name}-{uuid.uuid4().hex[:12]}"
    files = _files(spark, folder)
    stream = files.create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    done = move(spark, draft, path)
    if not done:
        remove(spark, draft)
    return done


def folder_day(name: str) -> date | None:
    """The day of a folder ``dt=…`` in any spelling that Spark casts to a date."""
    found = _DAY.fullmatch(name.removeprefix("dt=").strip()) if name.startswith("dt=") else None
    if found is None:
        return None
    try:
        return date(*[int(part) if part else 1 for part in found.groups()])
    except ValueError:
        return None


def day_folders(spark: SparkSession, root: str) -> list[tuple[date | None, Entry]]:
    """Folders ``dt=…`` of a table with the day each stands for (None: no day)."""
    found = [e for e in children(spark, root) if e.is_folder and e.name.startswith("dt=")]
    return [(folder_day(e.name), e) for e in found]
