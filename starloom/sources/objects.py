"""Small objects that are created once and never overwritten.

Claims and manifests are such objects.  ``put_if_absent`` makes one appear with
its whole content, or not at all because another writer was first; of any number
of writers of one name exactly one wins:

* local and mounted folders: a hard link to a finished file, which fails if the
  name is taken;
* object stores (S3A): a conditional create, visible when it is closed;
* other Hadoop file systems (HDFS): a rename of a finished file, which the name
  node refuses if the name is taken.
"""

from __future__ import annotations

import os
import re
from uuid import uuid4

from pyspark.sql import SparkSession

#: Schemes whose create can be made conditional, and the option that does it.
CONDITIONAL_CREATE = {"s3a": "fs.s3a.create.conditional.overwrite"}


def _open(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, the path there, and its scheme."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(at), fs.getUri().getScheme()


def _local(at) -> str:
    return at.toUri().getPath()


def _write(out, content: bytes) -> None:
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def put_if_absent(spark: SparkSession, path: str, content: bytes) -> bool:
    """Create ``path`` with ``content``; false if it is there already."""
    fs, at, scheme = _open(spark, path)
    fs.mkdirs(at.getParent())
    if scheme == "file":
        draft = f"{os.path.dirname(_local(at))}/.{uuid4().hex}"
        with open(draft, "xb") as out:
            out.write(content)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(draft, _local(at))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    if scheme in CONDITIONAL_CREATE:
        try:
            _write(fs.createFile(at).overwrite(False).must(CONDITIONAL_CREATE[scheme], "true").build(), content)
            return True
        except Exception as failed:  # the store says so when the object is closed
            if re.search("FileAlreadyExists|PreconditionFailed|412", str(failed)):
                return False
            raise
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid4().hex}")
    _write(fs.create(draft, False), content)
    won = fs.rename(draft, at)
    if not won:
        fs.delete(draft, False)
    if not won and not fs.exists(at):
        raise OSError(f"could not create {path}")
    return won


def read_object(spark: SparkSession, path: str) -> bytes:
    """The whole content of a small object."""
    fs, at, scheme = _open(spark, path)
    if scheme == "file":
        with open(_local(at), "rb") as source:
            return source.read()
    source = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    finally:
        source.close()


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The objects of ``folder`` that are named by a number, ascending; none if there is no folder."""
    fs, at, _ = _open(spark, folder)
    if not fs.exists(at):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(at)]
    return sorted(int(name) for name in names if name.isdigit())
