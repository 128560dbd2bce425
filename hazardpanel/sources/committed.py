"""Partitioned Parquet tables whose changes appear all at once.

Below a table's folder::

    data/write=<id>/<column>=<value>/...   files of one write, never changed afterwards
    commits/<number>.json                  the partitions that are live, each with its write

A change writes its partitions under a new id and then renames one finished
commit into place.  Readers take the commit of the highest number, so they see
the table as it was before or after the change, and a reader that began earlier
keeps its files.  A job that stops anywhere before the rename leaves the table as
it was; repeating it gives the same rows.  Dropping a partition is leaving it out
of the next commit.  Files that no kept commit names go with ``vacuum``.

A commit is as long as the table has partitions (days, feeds), whatever they
hold.  Tables have one writer at a time: a second one that starts from the same
commit fails at the rename (which replaces nothing on a shared file system).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the table's commits, oldest first (none: no table)."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/commits") if n.endswith(".json") and not n.startswith("_")]


def _commit(spark: SparkSession, path: str, version: int) -> dict:
    name = f"{path}/commits/{version:012d}.json"
    return json.loads("".join(r[0] for r in spark.read.text(name, wholetext=True).collect()))


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The last commit's number and content; 0 and nothing live for no table."""
    found = versions(spark, path)
    return (found[-1], _commit(spark, path, found[-1])) if found else (0, {"live": {}, "note": None})


def read(spark: SparkSession, path: str, version: int | None = None, where: Callable[[str], bool] | None = None) -> DataFrame:
    """The table at a commit (the last one), or those of its partitions whose value ``where`` accepts."""
    found = _commit(spark, path, version) if version else latest(spark, path)[1]
    if "schema" not in found:
        raise ValueError(f"{path} has no commit")
    schema = T.StructType.fromJson(found["schema"])
    live = {p: w for p, w in found["live"].items() if where is None or where(p.partition("=")[2])}
    if not live:
        return spark.createDataFrame([], schema)
    wide = T.StructType([*schema.fields, T.StructField("write", T.StringType())])
    files = [f"{path}/data/write={w}/{p}" for p, w in sorted(live.items())]
    return spark.read.schema(wide).option("basePath", f"{path}/data").parquet(*files).select(*schema.names)


def replace(spark: SparkSession, path: str, new: DataFrame, column: str, drop: Callable[[str], bool] | None = None, note=None) -> int:
    """Commit the partitions (by ``column``) of ``new`` in place of those of the same
    value; live partitions whose value ``drop`` accepts go.  Returns the commit's number."""
    if "write" in new.columns:
        raise ValueError("a column named write is the table's own")
    version, before = latest(spark, path)
    if "schema" in before and sorted(T.StructType.fromJson(before["schema"]).names) != sorted(new.columns):
        raise ValueError(f"columns {sorted(new.columns)} differ from the table's")
    write = uuid.uuid4().hex
    new.write.partitionBy(column).parquet(f"{path}/data/write={write}")
    staged = [n for n in _names(spark, f"{path}/data/write={write}") if n.startswith(f"{column}=")]
    live = {p: w for p, w in before["live"].items() if not (drop and drop(p.partition("=")[2]))}
    live.update({p: write for p in staged})
    ordered = T.StructType([*[f for f in new.schema if f.name != column], new.schema[column]])
    return publish(spark, path, version, {"schema": json.loads(ordered.json()), "live": live, "note": note})


def publish(spark: SparkSession, path: str, version: int, content: dict) -> int:
    """Make ``content`` the commit after ``version``: a finished file under another name, then one rename."""
    fs, _ = _fs(spark, path)
    spare = _fs(spark, f"{path}/commits/_{uuid.uuid4().hex}")[1]
    target = _fs(spark, f"{path}/commits/{version + 1:012d}.json")[1]
    out = fs.create(spare, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(spare, target):
        fs.delete(spare, False)
        raise RuntimeError(f"another writer committed {version + 1} to {path}")
    return version + 1


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove commits but the last ``keep`` and the writes that none of these names
    (also those of stopped jobs); run by the table's writer.  Returns the writes removed."""
    if keep < 1:
        raise ValueError("the last commit stays")
    found = versions(spark, path)
    named = {w for v in found[-keep:] for w in _commit(spark, path, v)["live"].values()}
    for v in found[:-keep]:
        fs, p = _fs(spark, f"{path}/commits/{v:012d}.json")
        fs.delete(p, False)
    gone = [n for n in _names(spark, f"{path}/data") if n.partition("=")[2] not in named]
    for n in gone:
        fs, p = _fs(spark, f"{path}/data/{n}")
        fs.delete(p, True)
    return gone
