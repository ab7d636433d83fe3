"""Keyed tables on parquet files: upserts by primary key, last write wins.

A batch costs what the batch weighs: it is reduced to one row per key and appended as a
delta. Reading lays the deltas over the base. ``compact`` joins deltas with deltas until they make up
a share of the base, and only then folds them in, rewriting the buckets they touch; buckets that have
outgrown their size are doubled in number. What a reader sees is named by the newest state file, which is
published last and whole, so a lost job or executor leaves the table as it was.

Nothing that a state names is deleted but by ``expire``, and that by age: a reader may go on with what it
opened for as long as files are kept. A table has one writer at a time, compaction included.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.sources.files import Files

# Struct column that orders the writes of one key.
ORDER = "__order"
_BUCKET = "__bucket"
# Keys of deltas are broadcast up to this many bytes.
KEY_LIMIT = 64 << 20
# Hours for which replaced states, and the files they name, are kept: longer than any query runs.
KEPT_HOURS = 48.0
# Deltas with fewer rows than this share of the base are joined with each other, not folded in.
FOLD_SHARE = 0.1
# Rows of a bucket (about 1 GB at 100 bytes) above which the number of buckets doubles.
BUCKET_ROWS = 10_000_000
# Rows that one task of a compaction takes, about.
TASK_ROWS = 2_000_000


_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


def latest_by_key(rows: DataFrame, primary_key: Sequence[str], *also_partition_by: str) -> DataFrame:
    """The last write of each key.

    Spark keeps one row per key in every task before the shuffle (a group limit on the
    row number), so a key that holds a large share of the rows stays small on the wire.
    A window, unlike an aggregate over whole rows, lets unused columns be pruned.
    """
    keys = [_column(k) for k in (*also_partition_by, *primary_key)]
    by_key = Window.partitionBy(*keys).orderBy(F.col(ORDER).desc())
    return rows.withColumn("__n", F.row_number().over(by_key)).filter("__n = 1").drop("__n")


def key_width(primary_key: Sequence[str]) -> Column:
    """Bytes a key takes in memory, estimated from above."""
    width = F.lit(32)  # what a hash table adds to each key
    for k in primary_key:
        width = width + F.coalesce(F.octet_length(_column(k).cast("string")), F.lit(0))
    return width


def bucket_of(primary_key: Sequence[str], buckets: int | Column) -> Column:
    number = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(F.xxhash64(*map(_column, primary_key)), number).cast("int")


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


@dataclass
class Delta:
    folder: str  # below the table's, or a whole path where a batch was written for several tables at once
    rows: int
    key_bytes: int  # size of its primary keys in memory, estimated from above
    buckets: list[int] | None = None  # those it touches; None: not known


@dataclass
class State:
    schema: str
    order_schema: str
    primary_key: list[str]
    buckets: int
    base: dict[str, str] = field(default_factory=dict)  # bucket -> version folder
    deltas: dict[str, Delta] = field(default_factory=dict)  # by batch
    base_rows: int = 0  # in all buckets, from above
    runs: list[str] = field(default_factory=list)  # streams that have written, in order

    def __post_init__(self):
        self.deltas = {b: d if isinstance(d, Delta) else Delta(**d) for b, d in self.deltas.items()}

    @property
    def key_bytes(self) -> int:
        return sum(d.key_bytes for d in self.deltas.values())


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.files = Files(spark, self.path)

    # -- state -----------------------------------------------------------------------

    def _sequence(self) -> list[int]:
        names = self.files.names(f"{self.path}/_states")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != "_")

    def exists(self) -> bool:
        return bool(self._sequence())

    def find_state(self) -> State | None:
        sequence = self._sequence()
        if not sequence:
            return None
        return State(**json.loads(self.files.read_text(self._state_file(sequence[-1]))))

    def state(self) -> State:
        state = self.find_state()
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return state

    def _state_file(self, number: int) -> str:
        return f"{self.path}/_states/{number:012d}.json"

    def _publish(self, state: State) -> None:
        sequence = self._sequence()
        number = sequence[-1] + 1 if sequence else 1
        self.files.publish_text(self._state_file(number), json.dumps(asdict(state)))

    def create(
        self,
        schema: T.StructType,
        primary_key: Sequence[str],
        order_schema: T.StructType,
        buckets: int = 64,
    ) -> KeyedTable:
        """An empty typed table. ``buckets`` is where it starts; compaction doubles them as the table grows."""
        if self.exists():
            raise FileExistsError(self.path)
        self.files.make_folder(f"{self.path}/_states")
        self._publish(State(schema.json(), order_schema.json(), list(primary_key), buckets))
        return self

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.state().schema))

    def add_columns(self, schema: T.StructType) -> None:
        """Widen the table, by new columns or wider types; any other change of its columns is refused.

        Files written before stay as they are: the parquet reader casts up what it finds in them. Key columns keep
        their type, as rows are laid out by a hash that depends on it.
        """
        state = self.state()
        known = T.StructType.fromJson(json.loads(state.schema))
        wanted = {f.name: f.dataType for f in schema}
        changed = [
            f.name for f in known
            if wanted.get(f.name) != f.dataType and (f.name in state.primary_key or not widens(f.dataType, wanted.get(f.name)))
        ]
        if changed:
            raise ValueError(f"columns of {self.path} missing or of a type that is not wider: {changed}")
        added = [f for f in schema if f.name not in known.fieldNames()]
        widened = [T.StructField(f.name, wanted[f.name]) for f in known]
        if added or [f.dataType for f in widened] != [f.dataType for f in known]:
            state.schema = T.StructType([*widened, *added]).json()
            self._publish(state)

    def places(self) -> list[str]:
        """Folders that hold its data: its own, and those of batches written together with other tables."""
        return [self.path, *(d.folder for d in self.state().deltas.values() if "/" in d.folder)]

    # -- reading ---------------------------------------------------------------------

    def _load(self, state: State, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state.schema))
        order = T.StructType.fromJson(json.loads(state.order_schema))
        stored = T.StructType([*schema.fields, T.StructField(ORDER, order)])
        if not folders:
            return empty(self.spark, stored)
        return self.spark.read.schema(stored).parquet(*folders)

    def _base_folders(self, state: State, buckets: Sequence[int] | None = None) -> list[str]:
        return [
            f"{self.path}/base/{version}/{_BUCKET}={bucket}"
            for bucket, version in sorted(state.base.items())
            if buckets is None or int(bucket) in buckets
        ]

    def _delta_folders(self, state: State, batches: Sequence[str] | None = None) -> list[str]:
        return [
            d.folder if "/" in d.folder else f"{self.path}/delta/{d.folder}"
            for b, d in sorted(state.deltas.items())
            if d.rows and (batches is None or b in batches)
        ]

    def _latest(self, state: State, batches: Sequence[str] | None = None) -> DataFrame:
        """One row per key over all deltas, or those of the given batches; a single delta is that already."""
        folders = self._delta_folders(state, batches)
        rows = self._load(state, folders)
        return rows if len(folders) == 1 else latest_by_key(rows, state.primary_key)

    @staticmethod
    def _bucket_of(state: State) -> Column:
        return bucket_of(state.primary_key, state.buckets)

    def read(self, broadcast_limit: int = KEY_LIMIT, with_order: bool = False) -> DataFrame:
        """Current rows.

        Buckets that no delta touches stream through. In the others, while the keys of the deltas are
        known to fit in ``broadcast_limit`` bytes, only the base rows they name are compared with the
        deltas; all other base rows are not shuffled, and filters reach their scan. Beyond it those
        buckets are merged with the deltas in one shuffle on the key.
        """
        state = self.state()
        deltas = self._delta_folders(state)
        touched = self._touched(state) if deltas else None
        bases = self._base_folders(state, touched)
        untouched = [f for f in self._base_folders(state) if f not in set(bases)] if touched is not None else []
        base = self._load(state, bases)
        if not deltas:
            rows = base
        elif not bases:
            rows = self._latest(state)
        elif state.key_bytes > broadcast_limit:
            rows = latest_by_key(base.unionByName(self._load(state, deltas)), state.primary_key)
        else:
            latest = self._latest(state)
            named = latest.select(*[_column(k).alias(f"__key{n}") for n, k in enumerate(state.primary_key)])
            keys = F.broadcast(named)  # size checked above
            same = F.lit(True)
            for n, k in enumerate(state.primary_key):
                same = same & _column(k).eqNullSafe(F.col(f"__key{n}"))
            contested = base.join(keys, same, "left_semi").unionByName(latest)
            rows = base.join(keys, same, "left_anti").unionByName(
                latest_by_key(contested, state.primary_key)
            )
        if untouched:
            rows = rows.unionByName(self._load(state, untouched))
        names = T.StructType.fromJson(json.loads(state.schema)).fieldNames()
        return rows.select(*[_column(n) for n in names], *([ORDER] if with_order else []))

    @staticmethod
    def _touched(state: State) -> set[int] | None:
        """Buckets with rows in some delta; None if a delta does not say."""
        found: set[int] = set()
        for d in state.deltas.values():
            if d.rows and d.buckets is None:
                return None
            found |= set(d.buckets or ())
        return found

    # -- writing ---------------------------------------------------------------------

    def run_number(self, stream: str) -> int:
        """A number for a stream that writes here, greater than those of all streams before it."""
        state = self.state()
        if stream not in state.runs:
            state.runs.append(stream)
            self._publish(state)
        return state.runs.index(stream)

    def upsert(self, rows: DataFrame, batch: str) -> State:
        """Apply one batch. Applying it again, in whole or after a crash, changes nothing."""
        state = self.state()
        check_columns(rows, [*T.StructType.fromJson(json.loads(state.schema)).fieldNames(), ORDER])
        folder = f"{batch}-{uuid.uuid4().hex[:8]}"
        written = Observation()
        width = key_width(state.primary_key)
        latest = latest_by_key(rows, state.primary_key).observe(
            written,
            F.count("*").alias("rows"),
            F.coalesce(F.sum(width), F.lit(0)).alias("key_bytes"),
            F.collect_set(self._bucket_of(state)).alias("buckets"),  # at most `buckets` numbers
        )
        latest.write.mode("errorifexists").parquet(f"{self.path}/delta/{folder}")
        found = written.get
        state.deltas[batch] = Delta(folder, found["rows"], found["key_bytes"], sorted(found["buckets"]))
        self._publish(state)
        return state

    def add_delta(self, batch: str, delta: Delta) -> State:
        """Take as a batch what was written elsewhere: one row per key, with all columns."""
        state = self.state()
        state.deltas[batch] = delta
        self._publish(state)
        return state

    def drop_batch(self, batch: str) -> None:
        """Nothing to keep of this batch, whatever an earlier attempt at it wrote."""
        state = self.state()
        if state.deltas.pop(batch, None):
            self._publish(state)

    def compact(
        self,
        keep: Sequence[str] = (),
        fold_share: float = FOLD_SHARE,
        bucket_rows: int = BUCKET_ROWS,
        task_rows: int = TASK_ROWS,
    ) -> None:
        """Make reading cheaper; the rows stay the same.

        Deltas that hold less than ``fold_share`` of the base's rows are joined into one. More of them are folded
        into the base, rewriting the buckets they touch, or all if the number of buckets is doubled.
        Batches named in ``keep`` stay deltas: one that is not committed may be repeated and must then be replaceable.
        """
        state = self.state()
        batches = [b for b, d in state.deltas.items() if d.rows and b not in keep]
        rows = sum(state.deltas[b].rows for b in batches)
        if not batches:
            return
        if rows < fold_share * state.base_rows:
            if len(batches) > 1:
                self._join_deltas(state, batches)
            return
        buckets = state.buckets
        while state.base_rows + rows > bucket_rows * buckets:
            buckets *= 2
        self._fold(state, batches, buckets, task_rows)

    def rewrite(self, task_rows: int = TASK_ROWS) -> None:
        """Fold everything into a base of one folder."""
        state = self.state()
        batches = [b for b, d in state.deltas.items() if d.rows]
        if batches or len(set(state.base.values())) > 1:
            self._fold(state, batches, state.buckets, task_rows, whole=True)

    def _join_deltas(self, state: State, batches: list[str]) -> None:
        folder = f"joined-{uuid.uuid4().hex[:12]}"
        self._latest(state, batches).write.mode("errorifexists").parquet(f"{self.path}/delta/{folder}")
        parts = [state.deltas.pop(b) for b in batches]
        known = all(d.buckets is not None for d in parts)
        buckets = sorted(set().union(*(d.buckets for d in parts))) if known else None
        # rows and key bytes are bounded from above: a key may be in several of them
        state.deltas[folder] = Delta(folder, sum(d.rows for d in parts), sum(d.key_bytes for d in parts), buckets)
        self._publish(state)

    def _fold(self, state: State, batches: list[str], buckets: int, task_rows: int, whole: bool = False) -> None:
        rows = sum(state.deltas[b].rows for b in batches)
        if buckets == state.buckets and not whole:
            bucket = self._bucket_of(state)
            deltas = self._load(state, self._delta_folders(state, batches))
            touched = [r[0] for r in deltas.select(bucket.alias(_BUCKET)).distinct().collect()]  # at most `buckets` numbers
        else:
            touched = None
            state.buckets = buckets
            bucket = self._bucket_of(state)
        old = self._load(state, self._base_folders(state, touched))
        # Both sides hold a key once, so buckets are even, and so are the parts that tasks take of them.
        merged = (old.unionByName(self._latest(state, batches)) if batches else old).withColumn(_BUCKET, bucket)
        parts = max(1, -(-(state.base_rows + rows) // (buckets * task_rows)))
        part = F.pmod(F.xxhash64(F.lit(1), *map(_column, state.primary_key)), F.lit(parts))
        merged = merged.withColumn("__part", part)
        n = (buckets if touched is None else len(touched)) * parts
        # Each part of a bucket is a task of its own: by a hash of the two, several could fall to one.
        place = _BUCKET if touched is None else f"array_position(array({', '.join(map(str, touched))}), {_BUCKET}) - 1"
        merged = merged.withColumn("__task", F.expr(f"cast(({place}) * {parts} + __part AS int)"))
        merged = latest_by_key(merged.repartitionById(n, F.col("__task")), state.primary_key, _BUCKET, "__task").drop("__part", "__task")
        version = uuid.uuid4().hex[:12]
        merged.write.option("partitionOverwriteMode", "static").partitionBy(_BUCKET).parquet(f"{self.path}/base/{version}")
        if touched is None:
            found = self.files.names(f"{self.path}/base/{version}")
            state.base = {n.split("=")[1]: version for n in found if n.startswith(f"{_BUCKET}=")}
            for d in state.deltas.values():
                d.buckets = None  # they named buckets of the old number
        else:
            state.base |= {str(b): version for b in touched}
        for b in batches:
            del state.deltas[b]
        state.base_rows += rows  # from above: updates are counted as new rows
        self._publish(state)

    def expire(self, keep_hours: float = KEPT_HOURS) -> None:
        """Remove what was replaced more than ``keep_hours`` ago. To be run apart from reading and writing, now and then.

        The newest state stays whatever its age; files it or a kept state names stay, and so does
        everything younger, which may belong to a batch that is being written.
        """
        sequence = self._sequence()
        states = self.files.ages(f"{self.path}/_states")
        # A state was in use until the next one was written: its age counts from there.
        ended = {n: states[f"{m:012d}.json"] for n, m in zip(sequence, sequence[1:])}
        outside: set[str] = set()
        for number in [n for n, age in ended.items() if age >= keep_hours]:
            state = State(**json.loads(self.files.read_text(self._state_file(number))))
            outside |= {d.folder for d in state.deltas.values() if "/" in d.folder}
            self.files.delete(self._state_file(number))
        used: set[str] = set()
        for number in self._sequence():
            state = State(**json.loads(self.files.read_text(self._state_file(number))))
            used |= set(state.base.values()) | {d.folder for d in state.deltas.values()}
        for path in outside - used:
            self.files.delete(path)
        for kind in ("base", "delta"):
            for name, age in self.files.ages(f"{self.path}/{kind}").items():
                if name not in used and age >= keep_hours:
                    self.files.delete(f"{self.path}/{kind}/{name}")


def widens(narrow: T.DataType, wide: T.DataType | None) -> bool:
    """Whether every value of one type is exactly a value of the other, and files of the one can be read as the other."""
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    return type(wide) in _WIDER.get(type(narrow), ())


def check_columns(df: DataFrame, expected: Sequence[str]) -> None:
    """Values are bound by name; a missing or surplus column is an error."""
    missing = sorted(set(expected) - set(df.columns))
    surplus = sorted(set(df.columns) - set(expected))
    if missing or surplus:
        raise ValueError(f"columns do not match the table: missing {missing}, not in the table {surplus}")
