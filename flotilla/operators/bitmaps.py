"""Exact distinct counts by bitmaps (W5, A1): a bit for each value instead of a row.

A dictionary table gives values dense numbers, once for all queries. Counting then keeps 4 kB for
each group and 32,768 numbers (``bitmap_construct_agg``), however many values come, where the
chained count keeps a row for each value; as a stream that is the state. Values that the dictionary
lacks keep a row each, so the count is exact with any dictionary, also an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flotilla.notes import read_note, write_note

DICTIONARY = "valor string, id long"


def extend_dictionary(spark: SparkSession, path: str, values: DataFrame) -> int:
    """Give numbers to the values of ``values`` (its only column; null has none) that the dictionary
    at ``path`` lacks, from its size on without gaps. Returns how many are new. Numbers stay for life;
    a failed extension leaves the dictionary as it was. One writer at a time."""
    path = path.rstrip("/")
    now = read_note(spark, f"{path}/_current") or {"size": 0, "folders": []}
    value = F.col(f"`{values.columns[0]}`").cast("string").alias("valor")
    new = values.select(value).where(F.col("valor").isNotNull()).distinct()
    if now["folders"]:
        new = new.join(dictionary(spark, path), "valor", "left_anti")
    # written first: that fixes the task and the row that a value has
    raw, folder = f"{path}/nuevos={now['size']}", f"desde={now['size']}"
    new.select("valor", F.spark_partition_id().alias("parte"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("fila")) \
        .write.mode("overwrite").parquet(raw)
    rows = spark.read.parquet(raw)
    counts = sorted((r["parte"], r["n"]) for r in rows.groupBy("parte").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, size = [], now["size"]
    for part, n in counts:              # one number for each task
        starts.append((part, size))
        size += n
    if size == now["size"]:
        return 0
    begin = spark.createDataFrame(starts, "parte int, desde long")
    rows.join(F.broadcast(begin), "parte").select("valor", (F.col("desde") + F.col("fila")).alias("id")) \
        .write.mode("overwrite").parquet(f"{path}/{folder}")
    write_note(spark, f"{path}/_current", {"size": size, "folders": [*now["folders"], folder]})
    return size - now["size"]


def dictionary(spark: SparkSession, path: str, size: int | None = None) -> DataFrame:
    """``valor, id``; with ``size`` as it was when it had so many values."""
    now = read_note(spark, f"{path.rstrip('/')}/_current") or {"size": 0, "folders": []}
    if not now["folders"]:
        return spark.createDataFrame([], DICTIONARY)
    out = spark.read.schema(DICTIONARY).parquet(*[f"{path.rstrip('/')}/{f}" for f in now["folders"]])
    return out if size is None else out.where(F.col("id") < size)


def pinned_dictionary(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """The dictionary as it was at a stream's first start: a value that is unknown in one batch of a
    window must not be known in the next."""
    note = f"{checkpoint.rstrip('/')}/_diccionario"
    held = read_note(spark, note)
    if held is None:
        held = {"size": (read_note(spark, f"{path.rstrip('/')}/_current") or {"size": 0})["size"]}
        write_note(spark, note, held)
    return dictionary(spark, path, held["size"])


def distinct_by_bitmap(df: DataFrame, keys: list, column: str, numbers: DataFrame, rows_as: str, distinct_as: str) -> DataFrame:
    """Rows and distinct values of ``column`` (null not counted) for each group of ``keys`` (columns):
    bitmaps by (group, bucket), then their bits are added up."""
    value = F.col(column).cast("string")
    named = df.withColumn("_valor", value).join(numbers.select(F.col("valor").alias("_valor"), F.col("id").alias("_id")), "_valor", "left")
    names = [f"_k{i}" for i in range(len(keys))]
    unknown = F.when(F.col("_id").isNull(), F.col("_valor"))
    bit = F.col("_id") + 1          # Spark's buckets begin with 1
    by_bucket = named.groupBy(*[k.alias(n) for k, n in zip(keys, names, strict=True)],
                              F.bitmap_bucket_number(bit).alias("_cubo"), unknown.alias("_otro")) \
        .agg(F.count(F.lit(1)).alias("_n"), F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits"))
    return by_bucket.groupBy(*names).agg(
        F.sum("_n").alias(rows_as), (F.sum(F.bitmap_count("_bits")) + F.count("_otro")).alias(distinct_as))


def events_by_type_bitmap(events: DataFrame, numbers: DataFrame, ts: str = "kafka_timestamp", duration: str = "1 minute",
                          watermark: str | None = None) -> DataFrame:
    """As ``windows.events_by_type``, batch or stream (append)."""
    from flotilla.operators.windows import event_time, flatten_window
    df = event_time(events, ts).withWatermark(ts, watermark) if watermark else events
    out = distinct_by_bitmap(df, [F.window(ts, duration), F.col("tipo_evento")], "placa_vehiculo", numbers,
                             "cantidad_eventos", "vehiculos_afectados")
    return flatten_window(out.withColumnsRenamed({"_k0": "window", "_k1": "tipo_evento"}))
