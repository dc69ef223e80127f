"""Command-line entry points for the streaming jobs (``spark-submit`` or
``python -m citylens.cli``).

    python -m citylens.cli ward-energy --bootstrap host:9092 --out /shared/ward_energy \\
        --checkpoints /shared/ckpt/ward_energy
    python -m citylens.cli advisory --files /data/air_quality --zones zone_profile.csv ...

A source is either Kafka (``--bootstrap``; topics ``<prefix><stream>``) or
a folder of JSON-lines files per stream (``--files``, for replays and
tests).  Outputs are JSON folders unless ``--bootstrap`` is given, in which
case results go to the keyed output topics.  The job runs until stopped.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .session import prepare, ship_package
from .sinks.writers import kafka_sink_options
from .sources.dims import route_schedule, zone_profile
from .sources.streams import fan_in, read_kafka, read_topic_files
from .streaming import jobs

STREAMS = ("air_quality", "bus_gps", "traffic_signals", "smart_meters")


def _source(spark: SparkSession, a: argparse.Namespace, stream: str) -> DataFrame:
    if a.bootstrap:
        return read_kafka(spark, a.bootstrap, a.prefix + stream, starting=a.starting,
                          max_offsets_per_trigger=a.max_offsets)
    return read_topic_files(spark, f"{a.files.rstrip('/')}/{stream}", a.prefix + stream,
                            max_files_per_trigger=a.max_files)


def _sink(a: argparse.Namespace, topic: str) -> dict | None:
    return kafka_sink_options(a.bootstrap, a.prefix + topic) if a.bootstrap else None


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="citylens")
    p.add_argument("job", choices=["ward-energy", "advisory", "enrich", "dlq", "incidents", "aqi-history"])
    p.add_argument("--bootstrap", help="Kafka bootstrap servers (else --files)")
    p.add_argument("--files", help="folder with one sub-folder of JSON-lines files per stream")
    p.add_argument("--prefix", default="city.", help="topic name prefix")
    p.add_argument("--starting", default="latest", help="Kafka startingOffsets")
    p.add_argument("--max-offsets", type=int, default=None, help="maxOffsetsPerTrigger")
    p.add_argument("--max-files", type=int, default=None, help="maxFilesPerTrigger")
    p.add_argument("--out", required=True, help="output folder (JSON / Parquet)")
    p.add_argument("--checkpoints", required=True, help="checkpoint root on shared storage")
    p.add_argument("--trigger", default="5 seconds", help="processing-time trigger, or available_now")
    p.add_argument("--zones", help="zone profile CSV (advisory)")
    p.add_argument("--routes", help="route schedule CSV (enrich)")
    a = p.parse_args(argv)
    if not a.bootstrap and not a.files:
        p.error("one of --bootstrap / --files is required")

    spark = prepare(SparkSession.builder.appName(f"citylens-{a.job}").getOrCreate())
    ship_package(spark)
    out, ck, trig = a.out.rstrip("/"), a.checkpoints.rstrip("/"), a.trigger
    if a.job == "ward-energy":
        jobs.ward_energy_job(_source(spark, a, "smart_meters"), f"{out}/parquet",
                             None if a.bootstrap else f"{out}/summary", ck, trigger=trig,
                             kafka=_sink(a, "ward_energy_summary"))
    elif a.job == "advisory":
        if not a.zones:
            p.error("--zones is required")
        jobs.advisory_job(spark, _source(spark, a, "air_quality"), zone_profile(spark, a.zones, view=None),
                          None if a.bootstrap else out, ck, trigger=trig, kafka=_sink(a, "health_advisories"))
    elif a.job == "enrich":
        if not a.routes:
            p.error("--routes is required")
        jobs.enrichment_job(_source(spark, a, "bus_gps"), route_schedule(spark, a.routes, view=None),
                            None if a.bootstrap else f"{out}/enriched", f"{out}/unmatched", ck, trigger=trig,
                            kafka=_sink(a, "bus_gps_enriched"))
    elif a.job == "dlq":
        raw = fan_in({a.prefix + s: _source(spark, a, s).drop("topic") for s in STREAMS})
        jobs.dlq_job(raw, None if a.bootstrap else f"{out}/dlq", f"{out}/report", ck, trigger=trig,
                     kafka=_sink(a, "dlq"))
    elif a.job == "incidents":
        jobs.incidents_job(_source(spark, a, "air_quality"), _source(spark, a, "traffic_signals"),
                           _source(spark, a, "bus_gps"), None if a.bootstrap else out, ck, trigger=trig,
                           kafka=_sink(a, "incidents"))
    else:
        jobs.aqi_history_job(_source(spark, a, "air_quality"), out, ck, trigger=trig)
    jobs.run_until_stopped(spark)


if __name__ == "__main__":
    main()
