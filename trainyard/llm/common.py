"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from trainyard.session import apply_runtime_conf, ensure_checkpoint_dir, work_dir

# Upper to lower case for A-Z only, on UTF-8 bytes; other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def prepare(spark: SparkSession) -> None:
    """Session settings every operator of this package relies on."""
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    # Python workers started from another folder must find this package too
    # (on a cluster it is shipped, e.g. with --py-files)
    env = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and go on from the files:
    the plan before it is not run again, also when executors are lost."""
    path = work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_count(spark: SparkSession, rows: int,
                 rows_per_bucket: int = 50_000) -> int:
    """Hash buckets for sorts that must not end in one task."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * width, 128, rows // rows_per_bucket)


def running_start(df: DataFrame, parts: Sequence[str], bucket: str,
                  order: Sequence[str], value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` within ``parts``, in the order of
    (``bucket``, ``order``), as column ``out``.

    A part may hold most of the rows: rows are sorted per (part, bucket) and
    only the bucket totals per part, so no task sorts a whole part.  ``df``
    is read twice and should be a written table."""
    keys = [*parts, bucket]
    before = Window.partitionBy(*parts).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_t")).select(
        *keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    return (df.join(totals, keys)
            .withColumn(out, (F.col("_base") + F.coalesce(
                F.sum(value).over(inside), F.lit(0))).cast("long"))
            .drop("_base"))


def permuted(x: Column, n: Column, key: Sequence[Column], rounds: int = 16,
             inverse: bool = False) -> Column:
    """Pseudorandom permutation of 0..n-1 at ``x``, chosen by ``key``: the
    swap-or-not shuffle, which takes any n and never leaves the range.  Each
    round pairs x with (k - x) mod n and swaps the two by a keyed bit; a
    round is its own inverse."""
    steps = F.sequence(F.lit(rounds - 1), F.lit(0)) if inverse else \
        F.sequence(F.lit(0), F.lit(rounds - 1))

    def step(acc: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - acc, n)
        bit = F.xxhash64(*key, r, F.greatest(acc, other)).bitwiseAND(
            F.lit(1).cast("long"))
        return F.when(bit == 1, other).otherwise(acc)

    return F.aggregate(steps, x.cast("long"), step)


def hash_share(h: Column, wanted: int, n: int) -> Column:
    """Whether a row is in the sample of about ``wanted`` of ``n`` rows that
    its hash ``h`` picks (all, if they are no more)."""
    share = 1.0 if n <= wanted else wanted / n
    return F.pmod(h, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def spread_join(rows: DataFrame, one: DataFrame, keys: Sequence[str],
                counts: DataFrame | None = None, least: int = 2_000
                ) -> DataFrame:
    """Inner join of ``rows`` with ``one`` (one row a key, no null keys), where
    a key may hold any share of ``rows``.

    A key with more than 1/(4 w) of the rows (w: shuffle partitions; at least
    ``least`` rows) is split by a hash of the whole row, its partner is
    repeated for each part.  There are at most 4 w such keys, so collecting
    and broadcasting them is bounded.  ``counts`` (keys, _n: rows of the key)
    saves counting them; it, else ``rows``, is read twice and should be a
    written table."""
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if counts is None:
        total = rows.count()
        counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    else:
        total = counts.agg(F.sum("_n")).first()[0] or 0
    limit = max(least, total // (4 * width))
    hot = counts.where(F.col("_n") > limit).select(
        *keys, F.ceil(F.col("_n") / limit).cast("int").alias("_parts")) \
        .collect()
    if not hot:
        return rows.join(one, list(keys))
    parts = F.broadcast(spark.createDataFrame(
        hot, one.select(*keys).schema.add("_parts", "integer")))
    n = F.coalesce("_parts", F.lit(1))
    left = rows.withColumn("_row", F.xxhash64(*rows.columns)).join(
        parts, list(keys), "left").withColumn(
        "_part", F.pmod("_row", n).cast("int")).drop("_row", "_parts")
    right = one.join(parts, list(keys), "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), n - 1))).drop("_parts")
    return left.join(right, [*keys, "_part"]).drop("_part")
