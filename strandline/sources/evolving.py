"""Tables whose columns may change their type from batch to batch.

``<table>/_log/schema-<k>`` holds the k-th schema of the table, each at least as wide as the one before and created once by
one writer. A batch lies in ``<table>/layout=<k>/batch=<name>`` under the types of the schema that was the newest when it
was written; files are never rewritten when a later batch widens a column. A read widens each layout's columns to the newest schema,
so a plan has as many scans as the table has had schemas, however many batches there are. Columns whose type has not
changed are read without a cast, and filters on them reach the files.

A batch's layout is fixed (``_log/batch-<name>``) before its rows are written: written again under the same name it replaces itself,
also where the schema has been widened meanwhile. Folders without Spark's success mark are batches that were
never finished; reads leave them out.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strandline.operators import widening
from strandline.sources.commits import create_once, filesystem, read_text


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem(spark, path)
    return fs.exists(target)


def _schema(spark: SparkSession, path: str, number: int) -> T.StructType:
    return T.StructType.fromJson(json.loads(read_text(spark, f"{path}/_log/schema-{number}")))


def schema_versions(spark: SparkSession, path: str) -> int:
    """How many schemas the table has had."""
    fs, log = filesystem(spark, f"{path.rstrip('/')}/_log")
    if not fs.exists(log):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return max([0, *(int(n.removeprefix("schema-")) for n in names if re.fullmatch(r"schema-\d+", n))])


def _untyped_as_text(kind: T.DataType) -> T.DataType:
    """Parquet has no untyped nulls: inside nested types they are strings."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _untyped_as_text(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_untyped_as_text(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_untyped_as_text(kind.keyType), _untyped_as_text(kind.valueType), True)
    return kind


def _storable(rows: DataFrame) -> DataFrame:
    """Columns that are untyped nulls as a whole tell nothing about a type and are left out; a later batch may give them one."""
    kept = [f for f in rows.schema.fields if not isinstance(f.dataType, T.NullType)]
    if not kept:
        raise ValueError("a batch needs a column that has a type")
    return rows.select(*[f"`{f.name}`" for f in kept])


def append_batch(rows: DataFrame, path: str, batch: str | int) -> int:
    """Write ``rows`` as the batch of that name and return the number of its schema. Names: letters, digits, ``_``, ``.`` and ``-``."""
    spark, path = rows.sparkSession, path.rstrip("/")
    if not re.fullmatch(r"[\w.-]+", str(batch), re.ASCII):
        raise ValueError(f"not a batch name: {batch!r}")
    rows = _storable(rows)
    mine = T.StructType([T.StructField(f.name, _untyped_as_text(f.dataType), True) for f in rows.schema.fields])
    mark = f"{path}/_log/batch-{batch}"
    number = int(read_text(spark, mark)) if _exists(spark, mark) else 0
    if number and widening.merge(_schema(spark, path, number), mine) != _schema(spark, path, number):
        raise ValueError(f"batch {batch} was begun with narrower columns; write it under another name")
    while not number:
        newest = schema_versions(spark, path)
        known = _schema(spark, path, newest) if newest else None
        wider = widening.merge(known, mine) if known else widening.merge(mine, mine)
        if wider != known and not create_once(spark, f"{path}/_log/schema-{newest + 1}", wider.json()):
            continue  # another writer was first: start over from its schema
        number = newest if wider == known else newest + 1
        if not create_once(spark, mark, str(number)):
            number = int(read_text(spark, mark))
    widening.conform(rows, _schema(spark, path, number)).write.mode("overwrite").parquet(f"{path}/layout={number}/batch={batch}")
    return number


def finished_batches(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Folders of the finished batches by the number of their schema."""
    fs, pattern = filesystem(spark, f"{path.rstrip('/')}/layout=*/batch=*/_SUCCESS")
    out: dict[int, list[str]] = {}
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath().getParent()
        out.setdefault(int(folder.getParent().getName().removeprefix("layout=")), []).append(folder.toString())
    return out


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All finished batches under the newest schema."""
    path = path.rstrip("/")
    newest = schema_versions(spark, path)
    if not newest:
        raise ValueError(f"no table at {path}")
    schema = _schema(spark, path, newest)
    parts = [
        widening.conform(spark.read.schema(_schema(spark, path, number)).parquet(*sorted(folders)), schema)
        for number, folders in sorted(finished_batches(spark, path).items())
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
