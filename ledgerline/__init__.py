"""ledgerline: partitioned-log ingestion on Spark (tables and Structured Streaming).

The main entry points, re-exported here::

    from ledgerline import read_log, decode_posts, first_success_per_key, run_exactly_once
"""

from .functions.codec import decode_posts, encode_post, iso_text, key_partition
from .operators.audit import audit_duplicates, audit_missing, completion_frontier, missing_ranges
from .operators.joins import fits_broadcast, join_bounded
from .operators.ledger import (
    commit_ledger,
    commits_per_batch,
    highest_offset,
    records_by_partition,
    resume_from_ledger,
    resume_from_sink,
    sink_max_offset,
    starts_from_ledger,
    starts_from_sink,
)
from .operators.ordering import OrderedFold, decouple, dense_positions, fold_in_order, in_partition_order, ordered_positions, per_partition, ranged_positions
from .operators.projections import deliveries, drop_tombstones, for_partition, key_value, next_offsets, split_bad, storable
from .operators.sink import (
    first_success_per_key,
    init_sink,
    jdbc_create_table,
    jdbc_merge,
    new_ids,
    publish,
    published_records,
    read_sink,
    sink_jdbc,
    write_sink_batch,
)
from .operators.split import assign_splits, even_split, split_list
from .operators.table import ResultTable
from .session import build_session, checkpoint_root, scratch_path, sized_session
from .sources.kafka import kafka_options
from .sources.log import (
    log_heads,
    log_partitions,
    partition_count,
    poll_batches,
    read_log,
    read_log_stream,
    seek,
    write_log,
)
from .sources.offsets import read_log_polls
from .streaming.keyed import keyed_state_session, run_exactly_once_keyed
from .streaming.runs import (
    drain,
    drain_polls,
    exactly_once_writer,
    at_least_once_writer,
    read_ledger,
    run_at_least_once,
    run_exactly_once,
    run_foreach,
    run_highest_offset,
    read_highest,
)

__all__ = [name for name in dir() if not name.startswith("_")]
