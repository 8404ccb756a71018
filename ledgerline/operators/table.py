"""The result table of effectively-once delivery as immutable files under a manifest.

Rows are stored by bucket of the key's hash, in folders that are written once: ``data/<name>/bucket=<b>``. A version
of the manifest (one small JSON file, put in place by a rename that fails if the version exists) lists the folders
that make up the table; readers see nothing else. A commit names its batch, so a batch that runs again after a
failure is found stored, and one that failed before its commit has left no trace.

Beside its rows a folder has a sketch: per bucket and slot a bitmap of the keys' hashes. A batch's keys are tested
against the bitmaps first; stored ids are read only from the buckets of folders that may hold one of them. Sketches
merge by OR, so compaction makes them without reading a key.

Inside a file rows follow a space-filling curve over (position in the log, key hash): both a (topic, partition)
predicate and a look-up by key hash meet narrow ranges of row groups.

One writer at a time; a second one fails at its rename. ``path`` is on a file system whose rename is atomic.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SINK_COLUMNS, SINK_SCHEMA
from ..session import list_files, path_exists, put_file, read_text, remove_path, scratch_table
from .joins import BROADCAST_MAX_ROWS, fits_broadcast, join_bounded

#: Buckets and, per bucket, bitmaps of 4 KB (32,768 bits): at four bits a key, 16 slots tell some 130,000 keys a bucket
#: apart well. Both are fixed when a table is created; more keys than that make look-ups slower, not wrong.
BUCKETS = 16
SLOTS = 16
SLOT_BITS = 32_768
PROBES = 4
#: Folders of like size that a bucket collects before they are merged.
FAN_IN = 8
#: Row groups are small enough for the curve to be worth it.
ROW_GROUP_BYTES = 16 << 20
#: Versions of the manifest that are kept.
VERSIONS = 20
CURVE_BITS = 12

_STORED = T.StructType([*SINK_SCHEMA.fields, T.StructField("id_hash", T.LongType(), True)])


@dataclass
class Manifest:
    """One version of a table. ``parts``: [folder, bucket, rows]; ``progress``: [topic, partition, greatest offset]."""

    version: int
    buckets: int
    slots: int
    last_batch: int | None = None
    parts: list = field(default_factory=list)
    progress: list = field(default_factory=list)


class ResultTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.probed: dict[str, int] = {}

    # --- the manifest ---------------------------------------------------------------------------------

    @classmethod
    def exists(cls, spark: SparkSession, path: str) -> bool:
        return path_exists(spark, path.rstrip("/") + "/_manifest")

    @classmethod
    def create(cls, spark: SparkSession, path: str, reset: bool = False, buckets: int = BUCKETS, slots: int = SLOTS) -> ResultTable:
        """K2: an empty table; refuses one that has rows unless ``reset``."""
        table = cls(spark, path)
        version = -1
        if cls.exists(spark, path):
            now = table.manifest()
            if now.parts and not reset:
                raise ValueError(f"sink {path} is not empty; pass reset=True to start over")
            version = now.version
        table._commit(Manifest(version + 1, buckets, slots))
        return table

    def manifest(self) -> Manifest:
        return Manifest(**json.loads(read_text(self.spark, self._versions()[-1])))

    def _versions(self) -> list[str]:
        names = [p for p in list_files(self.spark, f"{self.path}/_manifest") if p.endswith(".json")]
        if not names:
            raise ValueError(f"no result table at {self.path}")
        return sorted(names)

    def _commit(self, manifest: Manifest) -> None:
        put_file(self.spark, f"{self.path}/_manifest/{manifest.version:020d}.json", json.dumps(asdict(manifest)))
        for old in self._versions()[:-VERSIONS]:
            remove_path(self.spark, old)

    def holds(self, batch_id: int) -> bool:
        last = self.manifest().last_batch
        return last is not None and batch_id <= last

    # --- reading --------------------------------------------------------------------------------------

    def _folders(self, manifest: Manifest, parts: list) -> list[str]:
        """The folders to read for ``parts``: one path where all that a folder holds is wanted."""
        every: dict[str, set] = {}
        for name, bucket, _ in manifest.parts:
            every.setdefault(name, set()).add(bucket)
        wanted: dict[str, set] = {}
        for name, bucket, _ in parts:
            wanted.setdefault(name, set()).add(bucket)
        # a bucket that was merged away may still lie in the folder: then each bucket is named
        return [f"{self.path}/data/{name}/rows/bucket={b}" for name, own in wanted.items() for b in sorted(own)]

    def _rows(self, manifest: Manifest, parts: list) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], _STORED)
        return self.spark.read.schema(_STORED).parquet(*self._folders(manifest, parts))

    def read(self) -> DataFrame:
        """The table's rows as of now; later commits do not show in the DataFrame."""
        manifest = self.manifest()
        return self._rows(manifest, manifest.parts).select(*SINK_COLUMNS)

    def starts(self, inclusive: bool = True) -> DataFrame:
        """J1/G3 from the manifest: (topic, partition, start_offset), no row is read."""
        rows = [(t, p, o + (0 if inclusive else 1)) for t, p, o in self.manifest().progress if o is not None]
        return self.spark.createDataFrame(rows, "topic string, partition int, start_offset long")

    def lookup(self, ids: list[str]) -> DataFrame:
        """Rows of a few keys: only their buckets are opened, and row groups that their hashes fall into."""
        manifest = self.manifest()
        hashes = self.spark.createDataFrame([(i,) for i in ids], "id string").select(F.xxhash64("id").alias("h"), _bucket(F.xxhash64("id"), manifest.buckets).alias("b")).collect()
        buckets = {r["b"] for r in hashes}
        rows = self._rows(manifest, [p for p in manifest.parts if p[1] in buckets])
        return rows.where(F.col("id_hash").isin([r["h"] for r in hashes]) & F.col("id").isin(list(ids))).select(*SINK_COLUMNS)

    # --- membership (J2) ------------------------------------------------------------------------------

    def _sketches(self, manifest: Manifest, parts: list) -> DataFrame:
        names = sorted({name for name, _, _ in parts})
        schema = "name string, bucket int, slot int, bits binary"
        sketches = self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{n}/sketch" for n in names])
        live = self.spark.createDataFrame([(n, b) for n, b, _ in parts], "name string, bucket int")
        return join_bounded(sketches, live, ["name", "bucket"], "left_semi", rows=len(parts))

    def new_rows(self, rows: DataFrame, key_col: str = "id", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
        """The rows whose key is not in the table; a null key is never in it.

        Keys meet the bitmaps of their own bucket and slot (a hot key is one key by then), those that may be stored
        are kept in a scratch table with the folder that may hold them, and only such folders' ids are read.
        """
        manifest = self.manifest()
        self.probed = {"parts": len(manifest.parts), "opened": 0, "maybe": 0}
        if not manifest.parts:
            return rows
        h = F.xxhash64("_id")
        keys = rows.select(F.col(key_col).alias("_id")).where("_id is not null")
        keys = keys.select("_id", _bucket(h, manifest.buckets).alias("bucket"), _slot(h, manifest.slots).alias("slot"))
        # keys of a (bucket, slot) together: a bitmap is moved once, not once per key; hashing keeps the sets even,
        # and a hot key is one element of each task's set
        lists = keys.groupBy("bucket", "slot").agg(F.collect_set("_id").alias("ids"))
        met = lists.join(self._sketches(manifest, manifest.parts), ["bucket", "slot"])
        maybe = F.filter("ids", lambda i: _all_set(F.col("bits"), _positions(i)))
        hits = met.select("name", "bucket", F.explode(maybe).alias("_id"))
        hits = scratch_table(hits, "maybe-stored")
        counted = hits.groupBy("name", "bucket").count().collect()  # a row per part of the manifest at most
        opened = [[r["name"], r["bucket"], r["count"]] for r in counted]
        n_hits = sum(r["count"] for r in counted)
        self.probed.update(opened=len(opened), maybe=n_hits)
        if not opened:
            return rows
        candidates = hits.select("_id").distinct()
        ids = self._rows(manifest, opened).select(F.col("id").alias("_id"))
        if fits_broadcast(candidates, n_hits, max_rows):
            stored = F.broadcast(ids.join(F.broadcast(candidates), "_id", "left_semi"))  # no more than the candidates
        else:
            stored = ids.join(candidates, "_id", "left_semi")
        return rows.join(stored, rows[key_col] == stored["_id"], "left_anti")

    # --- writing --------------------------------------------------------------------------------------

    def append(self, rows: DataFrame, batch_id: int) -> bool:
        """K3: store ``rows`` as batch ``batch_id``; False (and nothing done) if that batch is stored already.
        Batches are committed in order; ``rows`` are read more than once and should be kept."""
        manifest = self.manifest()
        if manifest.last_batch is not None and batch_id <= manifest.last_batch:
            return False
        tagged = rows.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).select(*SINK_COLUMNS)
        tagged = tagged.withColumn("id_hash", F.xxhash64("id")).withColumn("bucket", _bucket(F.col("id_hash"), manifest.buckets))
        parts, progress = self._store(tagged, manifest, _name(batch_id))
        reached = {(t, p): o for t, p, o in manifest.progress}
        for t, p, o in progress:
            reached[t, p] = max(o, reached.get((t, p), o))
        self._commit(Manifest(manifest.version + 1, manifest.buckets, manifest.slots, int(batch_id), manifest.parts + parts, sorted(([*k, v] for k, v in reached.items()), key=str)))
        return True

    def _store(self, rows: DataFrame, manifest: Manifest, name: str, sketch: DataFrame | None = None) -> tuple[list, list]:
        """Writes a folder of rows (with ``id_hash`` and ``bucket``) and its sketch; what the manifest says of them."""
        folder = f"{self.path}/data/{name}"
        # one small pass: rows per bucket, and progress per log partition (at most buckets + partitions rows)
        known = rows.groupingSets([[F.col("bucket")], [F.col("topic"), F.col("topic_partition")]], "bucket", "topic", "topic_partition")
        stats = known.agg(F.grouping("bucket").alias("by_position"), F.count(F.lit(1)).alias("n"), F.max("partition_offset").alias("top")).collect()
        parts = [[name, r["bucket"], r["n"]] for r in stats if not r["by_position"]]
        progress = [[r["topic"], r["topic_partition"], r["top"]] for r in stats if r["by_position"] and None not in (r["topic_partition"], r["top"])]
        if not parts:
            return [], []
        curve = _curve(progress)
        (
            rows.withColumn("_curve", curve).repartition("bucket").sortWithinPartitions("bucket", "_curve").drop("_curve")
            .write.option("parquet.block.size", str(ROW_GROUP_BYTES)).partitionBy("bucket").parquet(f"{folder}/rows")
        )
        if sketch is None:
            bits = rows.where("id is not null").select("bucket", _slot(F.xxhash64("id"), manifest.slots).alias("slot"), F.explode(_positions(F.col("id"))).alias("at"))
            sketch = bits.groupBy("bucket", "slot").agg(F.bitmap_construct_agg("at").alias("bits"))
        sketch.select(F.lit(name).alias("name"), "bucket", "slot", "bits").write.parquet(f"{folder}/sketch")
        return parts, progress

    def compact(self, fan_in: int = FAN_IN) -> int:
        """Merges, bucket by bucket, folders of like size once there are ``fan_in`` of them: a row is written again
        as often as its folder's size grows by that factor, whatever the table holds. Returns how many went."""
        manifest = self.manifest()
        tiers: dict[tuple, list] = {}
        for part in manifest.parts:
            tiers.setdefault((part[1], int(math.log(max(part[2], 1), fan_in))), []).append(part)
        old = [p for own in tiers.values() if len(own) >= fan_in for p in own]
        if not old:
            return 0
        rows = self._rows(manifest, old).withColumn("bucket", _bucket(F.col("id_hash"), manifest.buckets))
        merged = self._sketches(manifest, old).groupBy("bucket", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
        parts, _ = self._store(rows, manifest, _name("merged"), merged)
        gone = {(n, b) for n, b, _ in old}
        kept = [p for p in manifest.parts if (p[0], p[1]) not in gone]
        self._commit(Manifest(manifest.version + 1, manifest.buckets, manifest.slots, manifest.last_batch, kept + parts, manifest.progress))
        return len(old)

    def vacuum(self, versions: int = 2) -> int:
        """Removes folders that none of the last ``versions`` manifests lists (merged ones, and those of writes
        that failed). Not while a batch is being written."""
        listed = {p[0] for v in self._versions()[-versions:] for p in json.loads(read_text(self.spark, v))["parts"]}
        gone = [p for p in list_files(self.spark, f"{self.path}/data") if p.rsplit("/", 1)[-1] not in listed]
        for p in gone:
            remove_path(self.spark, p)
        return len(gone)


def _name(batch) -> str:
    return f"{batch}-{uuid.uuid4().hex[:12]}"


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def _slot(h: Column, slots: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 40), F.lit(slots)).cast("int")


def _positions(key: Column) -> Column:
    """The bits of a key in its bitmap: 15 bits each of a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    return F.array(*[F.shiftrightunsigned(h, 15 * k).bitwiseAND(F.lit(SLOT_BITS - 1)) for k in range(PROBES)])


def _all_set(bits: Column, positions: Column) -> Column:
    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1

    return F.forall(positions, is_set)


def _curve(progress: list) -> Column:
    """A Z-order key: bits of the row's place in the log (partition, then offset) and of its key's hash, by turns."""
    span = max((p for _, p, _ in progress), default=0) + 1
    longest = max((o for _, _, o in progress), default=0) + 1
    top = 1 << CURVE_BITS
    place = (F.col("topic_partition") + F.greatest(F.lit(0.0), F.col("partition_offset") / F.lit(float(longest)))) / F.lit(float(span))
    place = F.coalesce(F.least(F.lit(top - 1), F.greatest(F.lit(0), F.floor(place * top))), F.lit(0)).cast("long")
    hashed = F.shiftright(F.coalesce("id_hash", F.lit(0).cast("long")), 64 - CURVE_BITS) + F.lit(top // 2)  # in the order of row groups' bounds
    out = F.lit(0).cast("long")
    for k in range(CURVE_BITS):
        out = out + F.shiftleft(F.shiftright(place, k).bitwiseAND(F.lit(1)), 2 * k + 1) + F.shiftleft(F.shiftright(hashed, k).bitwiseAND(F.lit(1)), 2 * k)
    return out
