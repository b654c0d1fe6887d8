"""Running numbers over a total order without a single-partition window.

``row_number() over (order by k)`` with no partition key pulls every row
into one task.  Instead the small per-key count table is range-partitioned,
checkpointed (so both passes see identical partitions, even after an
executor loss) and totalled per partition; the partition bases - one number
per partition - enter the plan as a literal array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def global_offsets(counts: DataFrame, key: str, count_col: str,
                   out_col: str = "offset", partitions: int | None = None) -> DataFrame:
    """For a table ``(key, count)`` with unique keys, add the sum of the
    counts of all rows with a smaller key (exclusive prefix sum).

    Returns ``(key, count, offset)``.
    """
    spark = counts.sparkSession
    ensure_checkpoint_dir(spark)
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (counts.select(key, count_col)
              .repartitionByRange(partitions, key)
              .withColumn("_pid", F.spark_partition_id()))
    # Reliable checkpoint in the session's shared checkpoint folder: fixes
    # the partition membership used by both passes below.
    ranged = ranged.checkpoint(eager=True)
    # One total per range partition: at most `partitions` numbers.  They are
    # read back as a literal array (a bounded action, like a count) so the
    # plan needs neither a single-partition window nor a broadcast join.
    totals = dict(ranged.groupBy("_pid").agg(F.sum(count_col).alias("_t")).collect())
    bases, acc = [], 0
    for pid in range(partitions):
        bases.append(acc)
        acc += int(totals.get(pid) or 0)
    base = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in bases]), F.col("_pid") + 1)
    local = Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged
            .withColumn(out_col, (base + F.coalesce(F.sum(count_col).over(local), F.lit(0))).cast("bigint"))
            .drop("_pid"))
