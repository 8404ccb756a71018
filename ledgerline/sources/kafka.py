"""Kafka reader/writer options built from this library's arguments (a pure function, no connection).

The Kafka connector jar is not bundled; on a cluster that has it, ``read_log_stream(source="kafka")``
and :func:`publish` with ``fmt="kafka"`` use these options.
"""

from __future__ import annotations

import json


def kafka_options(
    bootstrap: str,
    topic: str | None = None,
    partitions: list[int] | None = None,
    starting: str | dict | None = "earliest",
    ending: str | dict | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = True,
    group_id_prefix: str | None = None,
) -> dict[str, str]:
    """Options for ``spark.read[Stream].format("kafka")``.

    - ``topic`` subscribes to a whole topic (S1); ``partitions`` assigns explicit partitions (S2).
    - ``starting``: ``"earliest"``/``"latest"`` (S3) or ``{partition: offset}`` (S4, seek).
    - ``max_offsets_per_trigger`` bounds a micro-batch (S5); ``min_partitions`` decouples read
      parallelism from topic partitions (O2).
    """
    if not bootstrap:
        raise ValueError("bootstrap servers are required")
    if topic is None:
        raise ValueError("a topic is required")
    opts: dict[str, str] = {"kafka.bootstrap.servers": bootstrap}
    if partitions is None:
        opts["subscribe"] = topic
    else:
        opts["assign"] = json.dumps({topic: sorted(int(p) for p in partitions)})
    if starting is not None:
        opts["startingOffsets"] = _offsets_json(topic, starting)
    if ending is not None:
        opts["endingOffsets"] = _offsets_json(topic, ending)
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    opts["failOnDataLoss"] = "true" if fail_on_data_loss else "false"
    if group_id_prefix is not None:
        opts["groupIdPrefix"] = group_id_prefix
    return opts


#: The offset that stands for the earliest record in a seek map (fixed by the connector).
EARLIEST = -2


def full_seek_map(starts: dict[int, int], partitions: list[int] | None) -> dict[int, int]:
    """A start for every partition, as the connector wants it: the earliest record where ``starts`` has none.

    Raises if the partitions are not known, since a map of some of them would be refused at run time."""
    if partitions is None:
        raise ValueError("a Kafka seek map must name every partition: give the partitions")
    return {int(p): starts.get(int(p), EARLIEST) for p in partitions}


def _offsets_json(topic: str, spec: str | dict) -> str:
    if isinstance(spec, str):
        if spec not in ("earliest", "latest"):
            raise ValueError(f"offset spec must be earliest/latest or a dict, not {spec!r}")
        return spec
    return json.dumps({topic: {str(int(p)): int(o) for p, o in sorted(spec.items())}})


def kafka_write_options(bootstrap: str, topic: str) -> dict[str, str]:
    """Options for ``df.write.format("kafka")`` (K1)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}
