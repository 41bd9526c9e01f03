"""Tables of documents' rows that follow their documents: plain Parquet by batch.

A table is three folders. `rows/batch=N` holds what batch N added, `void/batch=N` the documents whose earlier rows it
replaced, and `commits/batch=N` one row, written last: a batch without it is not there. A change writes the rows of the
documents that changed and nothing else; nothing is rewritten and no text or vector is shuffled. Reading leaves out the
void rows by a semi join on ids, broadcast as long as they are few, which `maintain` sees to: it copies what is left into
one new batch when many rows are void or batches have become many.

One job at a time writes a table. A batch that was not committed is overwritten by the next attempt.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.sizes import SLIM_ROWS

BATCH = "batch"
COMMIT = (
    "batch BIGINT, base BIGINT, n_rows BIGINT, voided BIGINT, since_base BIGINT, rows_since_base BIGINT, key STRING, "
    "sorted_by ARRAY<STRING>, schema STRING, parts ARRAY<STRING>"
)
# Batches, and the share of replaced documents among the rows, at which a table is copied into one batch.
MOST_BATCHES, MOST_VOID = 64, 0.25


@dataclass(frozen=True)
class Commit:
    """The state of a table after a batch: rows of the batches from `base` on count, but for void ones."""

    batch: int
    base: int
    n_rows: int
    voided: int
    since_base: int  # documents voided since the base
    rows_since_base: int
    key: str
    sorted_by: list[str]
    schema: str
    parts: list[str] | None = field(default_factory=list)  # partition columns of the rows

    @property
    def keys(self) -> list[str]:
        return self.key.split(",") if self.key else []

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)


def _key_schema(state: Commit) -> str:
    return ", ".join(f"{k} STRING" for k in state.keys)


class TableStore:
    """Named tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    # -- state ----------------------------------------------------------------------------------------------------

    def commits(self, name: str) -> DataFrame:
        """One row per batch."""
        return self.spark.read.schema(COMMIT).parquet(f"{self.root}/{name}/commits")

    def state(self, name: str, version: int | None = None) -> Commit:
        """The table after its last batch, or after batch `version`."""
        if not self.exists(name):
            raise ValueError(f"no table {name}; create it with ensure()")
        known = self.commits(name)
        row = (known if version is None else known.where(F.col(BATCH) == version)).orderBy(F.desc(BATCH)).first()
        if row is None:
            raise ValueError(f"table {name} has no version {version}")
        return Commit(**row.asDict())

    def exists(self, name: str) -> bool:
        return self._exists(f"{self.root}/{name}/commits")

    def ensure(
        self, name: str, schema: str, key: str = "", sorted_by: tuple[str, ...] = (), parts: tuple[str, ...] = ()
    ) -> bool:
        """Create an empty table unless there is one. True when it was created. `key` may be several columns, with commas;
        rows lie in a folder for each value of `parts`."""
        if self.exists(name):
            return False
        self._commit(name, Commit(0, 0, 0, 0, 0, 0, key, list(sorted_by), schema, list(parts)))
        return True

    # -- reading --------------------------------------------------------------------------------------------------

    def read(self, name: str, version: int | None = None) -> DataFrame:
        state = self.state(name, version)
        rows = self._part(name, "rows", state, state.schema)
        if rows is None:
            # Known to be empty by the planner, so that nothing is shuffled to be compared with it.
            return self.spark.createDataFrame([], state.fields).where("false")
        if state.since_base:
            voids = self._part(name, "void", state, _key_schema(state))
            last = voids.groupBy(*[F.col(k).alias(f"_{k}") for k in state.keys]).agg(F.max(BATCH).alias("_before"))
            # How many there are at most is known from the commits.
            last = F.broadcast(last) if state.since_base <= SLIM_ROWS else last
            gone = F.col(BATCH) < F.col("_before")
            for k in state.keys:
                gone = (F.col(k) == F.col(f"_{k}")) & gone
            rows = rows.join(last, gone, "left_anti")
        return rows.drop(BATCH)

    def is_empty(self, name: str) -> bool:
        """Whether no batch that counts has rows; a table all of whose rows are void may count as not empty."""
        return not self.state(name).rows_since_base

    def _part(self, name: str, kind: str, state: Commit, schema: str) -> DataFrame | None:
        path = f"{self.root}/{name}/{kind}"
        if not state.rows_since_base or not self._exists(path):
            return None
        rows = self.spark.read.schema(f"{schema}, {BATCH} BIGINT").parquet(path)
        return rows.where(F.col(BATCH).between(state.base, state.batch))

    # -- writing --------------------------------------------------------------------------------------------------

    def _commit(self, name: str, commit: Commit) -> int:
        row = self.spark.createDataFrame([tuple(vars(commit).values())], COMMIT).drop(BATCH)
        # Fails when another job was first.
        row.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/{name}/commits/{BATCH}={commit.batch}")
        return commit.batch

    def _write(self, name: str, state: Commit, rows: DataFrame, checks: dict[str, Column]) -> int:
        """Write the rows of the next batch; refused, and never committed, if a check counts any. Returns their number."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in state.fields]
        counted = Observation()
        bad = [F.count(F.when(check, 1)).alias(f"bad{i}") for i, check in enumerate(checks.values())]
        rows = rows.select(*columns).observe(counted, F.count(F.lit(1)).alias("n"), *bad)
        if state.sorted_by:
            rows = rows.sortWithinPartitions(*state.sorted_by)
        self._write_rows(name, state, rows)
        found = counted.get
        broken = {check: found[f"bad{i}"] for i, check in enumerate(checks) if found[f"bad{i}"]}
        if broken:
            raise ValueError(f"table {name}: rows refused: {broken}")
        return found["n"]

    def _write_rows(self, name: str, state: Commit, rows: DataFrame) -> None:
        path = f"{self.root}/{name}/rows/{BATCH}={state.batch + 1}"
        # Half of a row are hashes in hexadecimal, which codecs without an entropy stage leave as they are.
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*(state.parts or [])).parquet(path)

    def overwrite(self, name: str, rows: DataFrame, checks: dict[str, Column] | None = None) -> int:
        """Replace the whole table."""
        state = self.state(name)
        n = self._write(name, state, rows, checks or {})
        batch = state.batch + 1
        return self._commit(name, replace(state, batch=batch, base=batch, n_rows=n, voided=0, since_base=0, rows_since_base=n))

    def append(self, name: str, rows: DataFrame) -> int:
        """Add rows; nothing that is there changes."""
        return self.replace(name, None, rows)

    def replace(
        self, name: str, keys: DataFrame | None, rows: DataFrame | None, checks: dict[str, Column] | None = None
    ) -> int:
        """Put `rows` in the place of all rows of `keys`, a slim table of key values; without rows they only go.

        Of the keys, those that the table has are noted as void. `rows` may be read from this very table.
        """
        state = self.state(name)
        batch, path = state.batch + 1, f"{self.root}/{name}"
        n = self._write(name, state, rows, checks or {}) if rows is not None else 0
        voided = 0
        there = self._part(name, "rows", state, _key_schema(state)) if keys is not None else None
        if there is not None:
            counted = Observation()
            known = there.select(*state.keys).distinct().join(keys.select(*state.keys).distinct(), state.keys, "left_semi")
            known.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/void/{BATCH}={batch}")
            voided = counted.get["n"]
        if not n and not voided:
            return state.batch
        if rows is None:
            # What an attempt that was not committed may have left.
            self._write_rows(name, state, self.spark.createDataFrame([], state.fields))
        after = replace(
            state, batch=batch, n_rows=n, voided=voided, since_base=state.since_base + voided, rows_since_base=state.rows_since_base + n
        )
        return self._commit(name, after)

    def maintain(self, name: str, batches: int = MOST_BATCHES, void: float = MOST_VOID) -> bool:
        """Copy what counts into one batch if batches, or replaced documents, have become many. True when it did.

        Readers of earlier versions go on; `clean` removes what no present reader needs.
        """
        state = self.state(name)
        many = state.batch - state.base >= batches
        if not many and state.since_base <= max(void * state.rows_since_base, 0):
            return False
        if not state.since_base and state.batch == state.base:
            return False
        # A shuffle by key here, and only here, puts rows of a document together and evens out files.
        rows = self.read(name)
        self.overwrite(name, rows.hint("rebalance", *(state.parts or state.keys)))
        return True

    def clean(self, name: str) -> int:
        """Remove the batches before the base of the present version; returns how many folders went."""
        state, removed = self.state(name), 0
        for kind in ("rows", "void"):
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/{kind}")
            fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for found in fs.listStatus(folder) if fs.exists(folder) else []:
                path = found.getPath()
                if path.getName().startswith(f"{BATCH}=") and int(path.getName().split("=")[1]) < state.base:
                    removed += fs.delete(path, True)
        return removed
