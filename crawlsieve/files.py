"""One view of paths for Spark and for Python tasks.

A path without a scheme means the session's default file system, as it does
to Spark.  Paths are qualified on the driver and opened in tasks through
`pyarrow.fs`; a scheme pyarrow does not know fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Spark's names of object-store schemes -> pyarrow's
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualify(spark: SparkSession, path: str) -> str:
    """`path` with scheme and authority, as Spark itself resolves it."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other trouble is raised."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p))


def folder_keys(spark: SparkSession, path: str) -> list[str]:
    """The keys of the ``key=value`` folders that the first file found below a folder lies in."""
    sc = spark.sparkContext
    system = sc._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(sc._jsc.hadoopConfiguration())

    def below(folder) -> list[str] | None:
        entries = system.listStatusIterator(folder)
        while entries.hasNext():
            entry = entries.next()
            name = entry.getPath().getName()
            if name.startswith((".", "_")):
                continue
            keys = below(entry.getPath()) if entry.isDirectory() else []
            if keys is not None:
                return [*([name.partition("=")[0]] if entry.isDirectory() and "=" in name else []), *keys]
        return None

    top = sc._jvm.org.apache.hadoop.fs.Path(path)
    return (below(top) or []) if system.exists(top) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it, if it is there."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not system.delete(p, True) and system.exists(p):
        raise OSError(f"could not delete {path!r}")


def claim(spark: SparkSession, path: str, owner: str) -> bool:
    """Create a file that must not exist; False where another owner has it.  One
    creator wins on file systems whose create is atomic (HDFS, local disks)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if system.exists(p):
        return False
    try:
        out = system.create(p, False)
    except Exception as e:
        if system.exists(p):
            return False
        raise e
    out.write(bytearray(owner.encode()))
    out.close()
    return True


def qualified(spark: SparkSession, path: Column) -> Column:
    """A column of paths, qualified as `qualify` does."""
    root, here = qualify(spark, "/").rstrip("/"), qualify(spark, ".").rstrip("/")
    return (F.when(path.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), path)
             .when(F.startswith(path, F.lit("/")), F.concat(F.lit(root), path))
             .otherwise(F.concat(F.lit(f"{here}/"), path)))


class UnknownStore(ValueError):
    """A path that no file system here can open: the job fails, whatever the row."""


def open_path(uri: str):
    """(pyarrow file system, path in it) of a qualified path."""
    import pyarrow as pa
    from pyarrow import fs

    scheme, sep, rest = uri.partition(":")
    if not sep or "/" in scheme:
        raise UnknownStore(f"path without a scheme reached a task: {uri!r}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError) as e:
        raise UnknownStore(f"no file system for {uri!r}: {e}") from e


def write_whole(uri: str, write) -> None:
    """Create one file: `write(stream)` fills a temporary name, which a move
    then puts in place, so that a reader or a second attempt of the task never
    sees half a file."""
    put_whole(*open_path(uri), write)


def put_whole(system, path: str, write) -> None:
    """`write_whole` in a file system that is open already.  The temporary name begins
    with a dot, so readers of the folder pass over what a killed task left."""
    import uuid

    from pyarrow import fs

    if isinstance(system, fs.LocalFileSystem) or system.type_name == "hdfs":
        folder, _, name = path.rpartition("/")
        system.create_dir(folder, recursive=True)
        part = f"{folder}/.{name}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(part, compression=None) as out:
            write(out)
        system.move(part, path)
    else:  # object stores show a file only when its upload is complete
        with system.open_output_stream(path, compression=None) as out:
            write(out)
