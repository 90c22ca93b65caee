"""Session helpers shared by the operators: lineage cuts and confs."""

from __future__ import annotations

import gc
import tempfile

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


#: A share of a key that meets several rows has so many rows at least: the other side is repeated for each share.
SHARE_ROWS = 4096
#: A key is hot if it makes up more than one in so many rows, so there are fewer hot keys than that.
HOT = 1000


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files and checkpoints that no plan needs, which it does once the driver has collected the plans.

    The driver's heap shrinks as well, and what the JVM's compiler has freed goes back to the system.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _trim(spark)


def _trim(spark: SparkSession) -> None:
    """Gives back freed memory that the driver's allocator keeps, where the JVM has a command for it (Linux, from 17.0.9 on)."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        kinds, values = gateway.new_array(jvm.java.lang.Class, 4), gateway.new_array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = jvm.java.lang.Class.forName(kind)
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # By the interface, as the server's own class is not open to callers.
        jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, values)
    except Py4JError:
        pass


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    A folder of our own is made in local mode alone, where driver and executors
    are one machine; on a cluster a missing setting is an error.  The files of a
    checkpoint go once no plan refers to it any more, unless the session says otherwise.
    """
    context = df.sparkSession.sparkContext
    # Spark looks at this setting whenever it checkpoints.
    context._jsc.sc().conf().setIfMissing("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    # The shuffles behind earlier cuts are not needed any more.
    release(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or in local mode one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a shared folder")
    return folder or tempfile.mkdtemp(prefix="checkpoint-")


def _shares(counts: DataFrame, key: str, count: str, limit: int) -> Column:
    """In how many shares a key is dealt: a power of two from its rows over ``limit``; 1 for all but the hot keys, which the driver gets."""
    levels: dict[int, set] = {}
    for value, rows in counts.where(F.col(count) > limit).select(key, count).collect():
        levels.setdefault((-(-rows // limit) - 1).bit_length(), set()).add(value)
    out = F.lit(1)
    for level in sorted(levels):
        out = F.when(F.col(key).isin(*levels[level]), 1 << level).otherwise(out)
    return out.cast("int")


def _dealt(rows: DataFrame, others: DataFrame, on: list[str], shares: Column) -> DataFrame:
    left = rows.withColumn("__share", F.pmod(F.xxhash64(*rows.columns), shares).cast("int"))
    right = others.withColumn("__share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return left.join(right, [*on, "__share"]).drop("__share")


def join_with_hot(rows: DataFrame, keys: DataFrame, on: list[str], count: str, shares_as: str | None = None) -> DataFrame:
    """``rows`` joined with ``keys``, which has one row for each key and in ``count`` the number of rows it meets.

    A key that makes up more than one in HOT of the rows met is dealt over as many
    shares as it exceeds that; a row's share is a hash of its columns.  The driver
    gets the hot keys, fewer than HOT, and each is repeated for its shares, so
    ``rows`` is read once and no task gets all rows of a key.  ``shares_as`` names
    a column for the number of shares of each row's key, for joins that follow.
    """
    shares = _shares(keys, on[0], count, (keys.agg(F.sum(count)).first()[0] or 0) // HOT + 1)
    return _dealt(rows, (keys.withColumn(shares_as, shares) if shares_as else keys).drop(count), on, shares)


def join_dealt(rows: DataFrame, others: DataFrame, on: list[str], counts: DataFrame, count: str) -> DataFrame:
    """``rows`` joined with ``others``, which may have several rows for a key; ``counts`` has each key's rows.

    As in ``join_with_hot``, the rows of a hot key are dealt over shares, and the others of that key are repeated for each share.
    """
    return _dealt(rows, others, on, _shares(counts, on[0], count, max(SHARE_ROWS, (counts.agg(F.sum(count)).first()[0] or 0) // HOT + 1)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int):
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))

