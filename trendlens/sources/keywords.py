"""Keyword sources: the Kafka source, its file twin, JSON parsing and row admission.

Also the stand-in keyword streams derived from the test tables. A stand-in only
renames columns into the stream schema ``(keyword, timestamp, uid)``; every
operator downstream works on any data of that schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions.scalar import epoch_millis
from trendlens.schema import KEYWORD_PAYLOAD


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a parquet table; how it is split is left to the file reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def admit_keywords(events: DataFrame, keyword_col: str = "keyword") -> DataFrame:
    """Row admission (P2, P3): drop null and empty keywords.

    Whitespace-only keywords pass; there is no trim and no case folding.
    """
    kw = F.col(keyword_col)
    return events.where(kw.isNotNull() & (kw != F.lit("")))


def parse_keywords(raw: DataFrame, value_col: str = "value", uid: Column | None = None) -> DataFrame:
    """Cast the message value to string, parse the JSON payload, flatten, admit.

    Malformed JSON, a top-level array or a null value parse to a null keyword and
    are dropped. ``uid`` (one id per occurrence) defaults to the payload's ``uid``
    field; the Kafka source passes ``topic:partition:offset`` instead.
    """
    # generated columns: the admission filter runs on them and doesn't parse the message again below
    parsed = F.inline(F.array(F.from_json(F.col(value_col).cast("string"), KEYWORD_PAYLOAD)))
    flat = raw.select(parsed, *([uid.alias("_uid")] if uid is not None else []))
    flat = flat.select("keyword", "timestamp", F.col("_uid" if uid is not None else "uid").alias("uid"))
    return admit_keywords(flat)


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of the Kafka source; ``max_offsets_per_trigger`` bounds a micro-batch after downtime."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    return options | ({"maxOffsetsPerTrigger": str(max_offsets_per_trigger)} if max_offsets_per_trigger else {})


def source_keywords(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "latest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """A streaming keyword source, parsed and admitted before ``writeStream``.

    ``fmt="kafka"`` subscribes one topic (the connector jar must be on the
    classpath; it is not in this image). ``fmt="text"`` reads JSON lines from a
    folder, the file twin used for replay. Parsing happens here, upstream of
    ``foreachBatch``, so Catalyst prunes and filters inside the source plan.
    """
    if fmt == "kafka":
        if not bootstrap_servers or not topic:
            raise ValueError("kafka source needs bootstrap_servers and topic")
        options = kafka_options(bootstrap_servers, topic, starting_offsets, max_offsets_per_trigger, fail_on_data_loss)
        raw = spark.readStream.format("kafka").options(**options).load()
        uid = F.concat_ws(":", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string"))
        return parse_keywords(raw, "value", uid)
    if fmt == "text":
        if not path:
            raise ValueError("text source needs a path")
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return parse_keywords(reader.load(path), "value")
    raise ValueError(f"unknown source format {fmt!r}")


# ---------------------------------------------------------------------------
# Stand-in keyword streams derived from the test tables.
# ---------------------------------------------------------------------------


def _event_millis(events: DataFrame) -> Column:
    return epoch_millis(events, "ts")


def event_type_stream(events: DataFrame) -> DataFrame:
    """``events.event_type`` as the keyword (few distinct values)."""
    return admit_keywords(
        events.select(
            F.col("event_type").alias("keyword"),
            _event_millis(events).alias("timestamp"),
            F.col("event_id").cast("string").alias("uid"),
        )
    )


def props_stream(events: DataFrame) -> DataFrame:
    """The integer ``k`` of the JSON ``props`` column, as text."""
    return admit_keywords(
        events.select(
            F.from_json("props", "k INT").getField("k").cast("string").alias("keyword"),
            _event_millis(events).alias("timestamp"),
            F.col("event_id").cast("string").alias("uid"),
        )
    )


def user_stream(events: DataFrame) -> DataFrame:
    """``events.user_id`` as text: a flat distribution."""
    return admit_keywords(
        events.select(
            F.col("user_id").cast("string").alias("keyword"),
            _event_millis(events).alias("timestamp"),
            F.col("event_id").cast("string").alias("uid"),
        )
    )


def doc_token_stream(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Space-split, lower-cased tokens of every document (the long tail).

    ``uid`` is ``doc_id:position`` with the 0-based position in the split list,
    counted before empty tokens are dropped.
    """
    tokens = documents.select(
        "doc_id",
        *keep,
        F.posexplode(F.split(F.lower(F.col("text")), " ")).alias("pos", "keyword"),
    )
    return admit_keywords(tokens).select(
        "keyword",
        F.lit(None).cast("long").alias("timestamp"),
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("pos").cast("string")).alias("uid"),
        "doc_id",
        *keep,
    )
