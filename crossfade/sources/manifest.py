"""Commit records: small numbered JSON files below a folder; the last one is what holds.

Everything a record names is written before the record, and the record appears whole or not at all (written under
another name, then renamed without overwriting). So a reader sees the state before or after a step, never one
between, and a writer that lost a race gets an error instead of undoing the other's step.
"""

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_FOLDER = "_commits"


def _context(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all records below ``root``, ascending."""
    files, folder = _context(spark, f"{root}/{_FOLDER}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """(number, record) of the last commit; (0, {}) if there is none."""
    found = versions(spark, root)
    if not found:
        return 0, {}
    text = spark.read.text(f"{root}/{_FOLDER}/{found[-1]:012d}.json", wholetext=True).first()[0]
    return found[-1], json.loads(text)


def commit(spark: SparkSession, root: str, record: dict, after: int) -> int:
    """Write the record that follows number ``after``; fails if another writer was first."""
    files, folder = _context(spark, f"{root}/{_FOLDER}")
    _, draft = _context(spark, f"{root}/{_FOLDER}/.{uuid.uuid4().hex}")
    _, final = _context(spark, f"{root}/{_FOLDER}/{after + 1:012d}.json")
    files.mkdirs(folder)
    stream = files.create(draft)
    stream.write(bytearray(json.dumps(record, sort_keys=True).encode()))
    stream.close()
    gateway, hadoop = spark.sparkContext._gateway, spark.sparkContext._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, final, gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception.getClass()):
            raise RuntimeError(f"{root} was changed by another writer (record {after + 1})") from error
        raise
    return after + 1


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own output that no record names any more."""
    files, place = _context(spark, path)
    files.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what stands directly below a folder; none if it is missing."""
    files, place = _context(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def fingerprint(values: dict) -> str:
    """A short digest that is equal exactly for equal values."""
    return hashlib.sha256(json.dumps(values, sort_keys=True, default=str).encode()).hexdigest()[:16]
