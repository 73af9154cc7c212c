"""Incremental monthly panel over new registry extracts.

The reference has no streaming operator; its batch input is a set of
period files.  When new period files land in a folder, this job ingests only
the new files (file source + checkpoint), cleans them with the same narrow
operators as the batch build, stores the typed rows, and recomputes the panel
rows of the months the micro-batch touched:

* the micro-batch is written under ``sales/_batch=<id>`` with overwrite, so a
  replayed batch (after a failure) replaces its own output: idempotent;
* the touched months are re-aggregated from the stored rows (partition
  pruning on ``annee_mois``) and written with dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from realty_spark import constants as K
from realty_spark.operators.panel import monthly_panel, with_zone
from realty_spark.plans.build_dataset import prepare_sales
from realty_spark.sources.readers import canonical_raw


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def start_incremental_panel(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_location: str,
                            columns: Sequence[str], sep: str = "|", date_format: str = "dd/MM/yyyy",
                            departments: Iterable[str] | None = K.IDF_DEPARTMENTS,
                            available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``output_dir/sales`` holds cleaned rows, ``output_dir/panel`` the monthly panel."""
    src = (spark.readStream.option("header", True).option("sep", sep).option("enforceSchema", False)
           .schema(text_schema(columns)).csv(input_dir))
    sales_dir, panel_dir = f"{output_dir}/sales", f"{output_dir}/panel"
    depts = list(departments) if departments is not None else None

    def upsert(batch: DataFrame, batch_id: int) -> None:
        clean = with_zone(prepare_sales(canonical_raw(batch, date_format), depts, date_format="yyyy-MM-dd"))
        clean = clean.where(F.col("annee_mois").isNotNull())
        (clean.write.mode("overwrite").partitionBy("annee_mois")
         .parquet(f"{sales_dir}/_batch={batch_id}"))
        stored = spark.read.parquet(sales_dir)
        touched = clean.select("annee_mois").distinct()
        rows = stored.join(F.broadcast(touched), "annee_mois", "left_semi")   # months of one batch: small
        (monthly_panel(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("annee_mois").parquet(panel_dir))

    w = src.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
