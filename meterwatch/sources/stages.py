"""Stages that are kept on disk, and jobs that go on where they stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwatch.session import persist_table


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A stage counts only with its success marker, so a broken write is redone."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def identity(**what: object) -> str:
    """A short digest of what a stage was made from, for its name."""
    return hashlib.sha256(json.dumps(what, sort_keys=True, default=str).encode()).hexdigest()[:12]


def input_identity(spark: SparkSession, path: str) -> str:
    """A digest of a path's files with their sizes and times: changes when the input does."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return identity(files=sorted(found))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path`` if it is complete, else build it and keep it."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Keys that are computed and committed together.
KEYS_PER_RANGE = 1_000_000


def committed(spark: SparkSession, path: str) -> list[dict]:
    """The manifest of a resumable table: one entry per committed range, in order.

    ``folder``, the range ``low <= hash < high`` of the keys' hash, and how many keys it holds.
    """
    where = f"{path.rstrip('/')}/_manifest"
    if not path_exists(spark, where):
        return []
    return [r.asDict() for r in spark.read.parquet(where).orderBy("folder").collect()]  # one row per commit


def committed_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that are committed; an interrupted range is not among them."""
    return spark.read.parquet(*[f"{path.rstrip('/')}/{c['folder']}/rows" for c in committed(spark, path)])


def resume(spark: SparkSession, path: str, inputs: DataFrame, key: Sequence[str],
           compute: Callable[[DataFrame], DataFrame], keys_per_range: int = KEYS_PER_RANGE) -> DataFrame:
    """Compute the keys that the table at ``path`` lacks, range by range, and return all rows.

    Keys are dealt into ranges of their hash, ``keys_per_range`` keys in each on the
    average. A range is computed, its rows and keys are written to a folder of its
    own, and then the manifest names it: that is the commit. A run that is
    interrupted in a range loses that range only; the next one leaves out every
    committed key, whether or not it gave rows, and deals what is left anew. ``compute``
    gets all rows of its keys. A NULL in a key is a value like any other.
    """
    root = path.rstrip("/")
    done = committed(spark, path)
    keys = inputs.select(*key).distinct()
    if done:
        known = spark.read.parquet(*[f"{root}/{c['folder']}/keys" for c in done]).select(*[F.col(k).alias(f"__done_{k}") for k in key])
        keys = keys.join(known, _same(keys, key, "__done_"), "left_anti")
    todo = persist_table(keys.withColumn("__hash", F.xxhash64(*key)))
    count = todo.count()
    if not count and done:
        return committed_rows(spark, path)
    ranges = max(1, -(-count // keys_per_range))
    edges = [-(1 << 63) + (1 << 64) * k // ranges for k in range(ranges + 1)]
    for k, (low, high) in enumerate(zip(edges, edges[1:])):
        folder = f"commit-{len(done) + k:06d}"
        inside = F.col("__hash") >= low
        part = todo.filter(inside & (F.col("__hash") < high) if k + 1 < ranges else inside).drop("__hash")
        part.write.mode("overwrite").parquet(f"{root}/{folder}/keys")
        mine = spark.read.schema(part.schema).parquet(f"{root}/{folder}/keys").select(*[F.col(c).alias(f"__own_{c}") for c in key])
        rows = inputs.join(mine, _same(inputs, key, "__own_"), "left_semi")
        compute(rows).write.mode("overwrite").parquet(f"{root}/{folder}/rows")
        entry = spark.createDataFrame([(folder, low, min(high, (1 << 63) - 1), mine.count())], "folder string, low long, high long, keys long")
        entry.coalesce(1).write.mode("append").parquet(f"{root}/_manifest")
    return committed_rows(spark, path)


def _same(df: DataFrame, key: Sequence[str], prefix: str) -> Column:
    found = F.lit(True)
    for k in key:
        found = found & df[k].eqNullSafe(F.col(f"{prefix}{k}"))
    return found


def fill_missing(df: DataFrame, key: Sequence[str], columns: Sequence[str],
                 compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``compute`` only on the rows whose first result column is NULL."""
    open_rows = df.filter(F.col(columns[0]).isNull())
    found = compute(open_rows.select(*[c for c in df.columns if c not in columns]).dropDuplicates(list(key)))
    found = found.select(*key, *[F.col(c).alias(f"__new_{c}") for c in columns])
    return df.join(found, list(key), "left").select(
        *[F.coalesce(F.col(c), F.col(f"__new_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])


def sample_entities(df: DataFrame, n: int, id_col: str = "series_id") -> DataFrame:
    """All rows of the ``n`` smallest ids."""
    chosen = df.select(id_col).distinct().orderBy(id_col).limit(n)
    return df.join(chosen, id_col, "left_semi")
