"""A weekly report kept current from the windows a stream updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.committed import CommittedTable
from ..sinks.writers import path_exists, upsert_partitions

#: kWh are sums of readings of two decimals
_KWH = "decimal(28,2)"


class WeeklyReport:
    """Totals per ward and week from update-mode windows (``windows.ward_energy``).

    A micro-batch brings new versions of some windows.  Each is compared with
    the version known so far, which stands in a table of one current row per
    window by date, of which only the dates of the batch are read.
    What a version adds to or takes from its week -- energy, and one window if
    it is new -- is committed once as a signed row per week and ward; the
    report is the sum of these rows, which ``fold`` makes one again.  The peak of
    a window only grows as readings arrive, so the largest version counts.

    A batch replayed after a failure finds its differences committed and only
    brings the windows up to date; the archive is never read.
    """

    def __init__(self, spark: SparkSession, path: str, query: str = "weekly"):
        self.spark, self.query = spark, query
        self.windows = f"{path}/windows"
        self.deltas = CommittedTable(spark, f"{path}/deltas", T.StructType.fromDDL(
            f"week_start timestamp, ward_id string, total_kwh {_KWH}, peak_voltage double, windows long"))
        self._upsert = upsert_partitions(self.windows, ["ward_id", "window_start"], ["date"])

    def _known(self, batch: DataFrame) -> DataFrame:
        cols = ["ward_id", "window_start", "total_kwh_consumed"]
        if not path_exists(self.spark, self.windows):
            return batch.select(*cols).limit(0)
        dates = [r["date"] for r in batch.select("date").distinct().collect()]       # days that a batch touches
        schema = T.StructType([*batch.schema.fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.windows).where(F.col("date").isin(dates)).select(*cols)

    def differences(self, batch: DataFrame) -> DataFrame:
        """Signed rows (week_start, ward_id, total_kwh, peak_voltage, windows) of a batch of versions."""
        old = self._known(batch).select(F.col("ward_id").alias("o_ward"), F.col("window_start").alias("o_start"),
                                        F.col("total_kwh_consumed").cast(_KWH).alias("o_kwh"))
        j = batch.join(old, F.col("ward_id").eqNullSafe(F.col("o_ward")) & (F.col("window_start") == F.col("o_start")), "left")
        kwh = F.coalesce(F.col("total_kwh_consumed").cast(_KWH), F.lit(0)) - F.coalesce("o_kwh", F.lit(0))
        return (j.groupBy(F.date_trunc("week", "window_start").alias("week_start"), "ward_id")
                .agg(F.sum(kwh).cast(_KWH).alias("total_kwh"), F.max("peak_voltage").alias("peak_voltage"),
                     F.count_if(F.col("o_start").isNull()).alias("windows")))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` writer of an update-mode stream of windows."""
        batch = batch.persist()
        try:
            if not self.deltas.done(self.query, batch_id):
                self.deltas.append(self.differences(batch), self.query, batch_id)
            self._upsert(batch, batch_id)                # after the differences: they need the versions before
        finally:
            batch.unpersist()

    def read(self) -> DataFrame:
        """(week_start, ward_id, total_kwh, peak_voltage, windows)."""
        d = self.deltas.read()
        return d.groupBy("week_start", "ward_id").agg(F.sum("total_kwh").cast("double").alias("total_kwh"), F.max("peak_voltage").alias("peak_voltage"),
                                                      F.sum("windows").alias("windows"))

    def fold(self) -> int:
        """Make one row of the differences of each week and ward; the number of files that went."""
        return self.deltas.rewrite(lambda d: d.groupBy("week_start", "ward_id").agg(
            F.sum("total_kwh").cast(_KWH).alias("total_kwh"), F.max("peak_voltage").alias("peak_voltage"), F.sum("windows").alias("windows")))

