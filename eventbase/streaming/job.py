"""Command line of the ingest job: ``spark-submit ... job.py -Dkafka.brokers=... -Dkafka.topics=...``"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from eventbase.operators.store import EventStore
from eventbase.session import create_session
from eventbase.sources.kafka import stream_kafka
from eventbase.streaming.ingest import DEFAULT_BATCH_MS, IngestOptions, run_ingest

# Names of the job options.
BROKERS = "kafka.brokers"
TOPIC = "kafka.topics"
BATCH_MS = "spark.streaming.batchms"
STORE = "store.path"
CHECKPOINT = "checkpoint.path"
SAVED_OFFSETS = "kafka.offsets"
# Names of our own for the controls of a large backlog and of the store.
MAX_OFFSETS = "kafka.max.offsets"  # messages per batch at most
MIN_PARTITIONS = "kafka.min.partitions"  # parts a batch is fetched in at least
CACHE = "ingest.cache"
COMPACT_EVERY = "ingest.compact.every"  # 0: compaction is another job
BUCKETS = "store.buckets"

USAGE = f"""Usage: job.py -D{BROKERS}=<brokers> -D{TOPIC}=<topic> -D{STORE}=<folder> -D{CHECKPOINT}=<folder>
  [-D{BATCH_MS}=<milliseconds>] [-D{SAVED_OFFSETS}=<partition:offset,...>] [-D{MAX_OFFSETS}=<n>] [-D{MIN_PARTITIONS}=<n>]
  [-D{CACHE}=true] [-D{COMPACT_EVERY}=<batches>] [-D{BUCKETS}=<n>] [-D<spark setting>=<value>]"""


def job_options(args: Sequence[str]) -> dict[str, str]:
    """``-Dname=value`` arguments; everything after the first ``=`` is the value."""
    options = dict(a[2:].split("=", 1) for a in args if a.startswith("-D") and "=" in a)
    missing = [name for name in (BROKERS, TOPIC, STORE, CHECKPOINT) if not options.get(name)]
    if missing:
        raise ValueError(f"missing {', '.join(missing)}\n{USAGE}")
    return options


def ingest_options(options: dict[str, str]) -> IngestOptions:
    every = int(options.get(COMPACT_EVERY, IngestOptions.compact_every))
    return IngestOptions(cache=options.get(CACHE, "").lower() == "true", compact_every=every or None)


def main(args: Sequence[str]) -> None:
    options = job_options(args)
    settings = {k: v for k, v in options.items() if k.startswith("spark.") and k != BATCH_MS}
    spark = create_session(**settings)
    limits = {"max_offsets_per_trigger": MAX_OFFSETS, "min_partitions": MIN_PARTITIONS}
    given = {k: int(options[name]) for k, name in limits.items() if name in options}
    messages = stream_kafka(spark, options[BROKERS], options[TOPIC], saved_offsets=options.get(SAVED_OFFSETS), **given)
    query = run_ingest(
        messages,
        EventStore(spark, options[STORE], buckets=int(options.get(BUCKETS, 64))),
        checkpoint=options[CHECKPOINT],
        options=ingest_options(options),
        batch_ms=int(options.get(BATCH_MS, DEFAULT_BATCH_MS)),
    )
    query.awaitTermination()


if __name__ == "__main__":
    try:
        main(sys.argv[1:])
    except ValueError as problem:
        sys.exit(str(problem))
