"""Ascending surrogate keys that continue from a high-water mark per table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.schemas import ENTITIES, FIRST_HIGH_WATER_MARK
from retail_strata.session import scratch_path

# monotonically_increasing_id() packs the partition number above 33 bits of row position.
POSITION_BITS = 33


def assign_surrogate_keys(
    df: DataFrame,
    order_by: Sequence[str],
    last_id: int = FIRST_HIGH_WATER_MARK,
    key: str = "id",
) -> DataFrame:
    """``df`` with ids ``last_id + 1 .. last_id + rows``, ascending in ``order_by``.

    One range shuffle sorts the rows; (partition, position) is written with them to the shared
    scratch folder, so a lost executor cannot change a number already given out. The id is then
    the position plus the sizes of the earlier partitions: one number per partition, which is all
    that is broadcast. Ties in ``order_by`` are broken by arrival, which also lets the range
    shuffle cut through a value, or a set of identical rows, that makes up much of the data.

    Arrival order must not change on a retry. That holds for a scan of files with row-wise steps
    on top; any other input is first written to the scratch folder and read back.
    """
    spark = df.sparkSession
    if not replays_in_order(df):
        staged = scratch_path(spark, "surrogate-key-input")
        df.write.parquet(staged)
        df = spark.read.schema(df.schema).parquet(staged)
    path = scratch_path(spark, "surrogate-keys")
    (
        df.withColumn("_arrival", F.monotonically_increasing_id())
        .orderBy(*order_by, "_arrival")
        .drop("_arrival")
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    part = F.shiftright("_place", POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))

    # One row per sort partition, so this window is small however large the table is.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select((F.lit(last_id + 1) + F.col("_start") + position).alias(key), *df.columns)
    )


def replays_in_order(df: DataFrame) -> bool:
    """Whether the plan is a scan of files with deterministic row-wise steps and nothing else."""
    execution = df._jdf.queryExecution()

    def row_wise(plan) -> bool:
        children = plan.children()
        if children.size() == 0:
            return plan.nodeName().startswith("Scan ") and plan.nodeName() != "Scan ExistingRDD"
        return plan.nodeName() in ("Project", "Filter") and row_wise(children.head())

    return execution.analyzed().deterministic() and row_wise(execution.sparkPlan())


def high_water_marks(spark: SparkSession, marks: DataFrame | None = None) -> DataFrame:
    """``(entity, last_id)`` for every entity; those without a mark yet start at the default."""
    default = spark.createDataFrame(
        [(entity, FIRST_HIGH_WATER_MARK) for entity in ENTITIES], "entity string, last_id bigint"
    )
    if marks is None:
        return default
    return default.unionByName(marks).groupBy("entity").agg(F.max("last_id").alias("last_id"))


def advance_mark(marks: DataFrame, entity: str, keyed: DataFrame, key: str = "id") -> DataFrame:
    """``marks`` with ``entity`` moved up to the greatest id in ``keyed``; an empty batch moves none."""
    batch = keyed.agg(F.max(key).alias("last_id")).select(F.lit(entity).alias("entity"), "last_id")
    return marks.unionByName(batch).groupBy("entity").agg(F.max("last_id").alias("last_id"))


_COMMITS = "position bigint, batch string, attempt string, first_id bigint, last_id bigint"


class KeyedBatches:
    """Batches of one entity with ids that go on from batch to batch, under a folder.

    A batch is written under a name of its own attempt. It takes effect by one commit row, which
    names the attempt and holds the mark the batch ends at: rows and mark are there together or not
    at all. A batch that is committed gives the rows it got then when it comes again, whatever is
    in it now; an attempt that broke off is never read, and its ids are given out anew. One
    writer at a time is assumed.
    """

    def __init__(self, spark: SparkSession, root: str, entity: str, key: str = "id") -> None:
        self.spark, self.entity, self.key = spark, entity, key
        self.path = f"{root.rstrip('/')}/{entity}"

    def commits(self) -> DataFrame:
        """One row a batch, with the ids it got; ``last_id`` is the mark after it."""
        path = f"{self.path}/commits"
        if not storage.exists(self.spark, path):
            return self.spark.createDataFrame([], _COMMITS)
        return self.spark.read.schema(_COMMITS).parquet(path)

    def marks(self) -> DataFrame:
        """``(entity, last_id)``, as ``high_water_marks`` takes it; no row without a batch."""
        found = self.commits().groupBy(F.lit(self.entity).alias("entity"))
        return found.agg(F.max("last_id").alias("last_id"))

    def _read(self, attempts: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/rows/{attempt}" for attempt in attempts])

    def add(self, batch: str, df: DataFrame, order_by: Sequence[str]) -> DataFrame:
        """``df`` with its ids, ascending in ``order_by``; those given before if it was committed."""
        commits = self.commits()
        known = commits.filter(F.col("batch") == batch).select("attempt").first()
        if known is not None:
            return self._read([known["attempt"]])
        last = commits.agg(F.max("last_id"), F.max("position")).first()
        mark = FIRST_HIGH_WATER_MARK if last[0] is None else last[0]
        attempt = f"{batch}-{uuid.uuid4().hex}"
        keyed = assign_surrogate_keys(df, order_by, mark, self.key)
        keyed.write.parquet(f"{self.path}/rows/{attempt}")
        rows = self._read([attempt])
        added = rows.count()  # from the footers
        commit = [((last[1] or 0) + 1, batch, attempt, mark + 1, mark + added)]
        committed = self.spark.createDataFrame(commit, _COMMITS).coalesce(1)
        committed.write.mode("append").parquet(f"{self.path}/commits")
        return rows

    def rows(self) -> DataFrame | None:
        """All committed batches; None without one."""
        attempts = [r["attempt"] for r in self.commits().orderBy("position").collect()]
        return self._read(attempts) if attempts else None
