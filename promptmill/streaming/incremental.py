"""Curation of logs as they arrive, each row processed once.

Each micro-batch goes through the same plan as a batch run, near-duplicates included, and the
checkpoint of the stream remembers which files were read. The sink replaces the folder of a
batch id, so a repeated batch leaves no second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from promptmill import schemas
from promptmill.config import CurationConfig
from promptmill.functions.text import sample_text
from promptmill.operators.dedup import dropped_rows, fingerprints, first_of_each, rows_per_bucket, rows_with_keys, shape_for
from promptmill.operators.filters import filter_logs
from promptmill.operators.skew import attach
from promptmill.plans.curation import LOG_ORDER, curate
from promptmill.session import materialise, spread
from promptmill.streaming.band_index import PREFIX_BITS, BandIndex


def log_stream(spark: SparkSession, path: str, schema: str = schemas.INFERENCE_LOGS, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def start_curation(
    stream: DataFrame,
    *,
    output: str,
    checkpoint: str,
    cfg: CurationConfig = CurationConfig(),
    order_by: list[str] | None = None,
    across_batches: bool = False,
    fold_every: int = 8,
    prefix_bits: int = PREFIX_BITS,
) -> StreamingQuery:
    """Curate all available logs into ``output/samples`` and stop.

    ``across_batches`` also drops rows that share a band with a sample kept by an earlier batch, so that all batches
    together keep what one keep-first pass over them in turn would. Off, each batch is deduplicated on its own. Only
    band keys of kept samples are stored for it, in a :class:`BandIndex` that is folded after ``fold_every`` batches.

    A batch that is repeated, after it died anywhere, writes the same rows to the same place: its samples replace those
    of the first attempt, and keys that the first attempt committed are neither seen by it nor written again.
    """
    order_by = order_by or LOG_ORDER
    text = sample_text(F.col("prompt"), F.col("response"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folder = f"{output}/samples/batch_id={batch_id}"
        pulled = spread(batch)
        if not across_batches:
            curate(pulled, cfg, order_by).write.mode("overwrite").parquet(folder)
            return
        index = BandIndex(batch.sparkSession, f"{output}/bands", prefix_bits, fold_every)
        index.fold_before(batch_id)
        samples = materialise(filter_logs(pulled, cfg))
        # Texts are signed once, for the index and for the batch itself.
        shape = shape_for(cfg.dedup_threshold, verify=False)
        prints = materialise(fingerprints(samples, text, order_by, shape))
        bands = rows_per_bucket(prints)
        seen = attach(bands, index.before(batch_id, bands), ["h1", "h2"], spread=F.col("ord"))
        firsts = materialise(first_of_each(prints.join(seen.select("ord").distinct(), "ord", "left_anti")))
        kept = materialise(firsts.select("ord").join(dropped_rows(firsts), "ord", "left_anti"))
        rows_with_keys(samples, kept, order_by).write.mode("overwrite").parquet(folder)
        index.add(batch_id, bands.join(kept, "ord", "left_semi"))

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
