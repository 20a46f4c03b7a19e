"""The news store: tables of news in batches, in one shared folder, changed by commits of a log.

Data is written first and counts later.  A run writes all its rows, whatever tables they go to, in one pass into a folder
of a new attempt; then one commit names the batches, the source batches they use up, and a note.  Readers see what commits
name, so a run that ends half-way leaves everything as it was, and its repetition is a run like any other.  Nothing is
overwritten; a later commit for a batch replaces it.

Batches are handed over once: a run claims the batches it works on, another run that comes meanwhile takes only the
others, and a commit fails with ``Conflict`` if one of its source batches has been used up by another run.  Claims of a
run that broke off can be taken over after ``lease`` seconds, or go to its retry.

Seen ids are kept apart from texts, as sorted runs of (agency, word, mask): a word stands for 64 consecutive ids, a mask
for those of them that occur.  Every batch adds a run; of tables that are never handed over, eight runs of one level are merged
into one of the next, so the files to be read grow with the logarithm of the number of batches.

Changes of a column by key are small tables of their own (key, value), merged in the same way and joined when rows are
read; rows that were written after a change do not get it.

If a write fails, its rows are computed again and kept aside, and the failure names the run and its source batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom.functions.links import url_part_id
from wireloom.operators import ids as ids_of
from wireloom.operators.joins import lookup_join
from wireloom.schemas import conform, table_schema
from wireloom.sources.commits import SNAPSHOT_EVERY, CommitLog, State, now
from wireloom.sources.tables import read_or_empty

BATCH, ATTEMPT = "batch_id", "attempt"
#: Columns that say which table a row goes to.
DATABASE, NAME = "database", "name"
#: Runs of ids, and tables of changes, of one level that are merged into one.
FAN = 8
LEASE = 3600.0

CHANGES = "key string, value string, seq long"
FAILURES = "run string, targets array<string>, sources array<string>, error string"

Table = tuple[str, str]


class Conflict(RuntimeError):
    """Another run has used up a source batch of this one."""


def named(table: Table) -> str:
    return "/".join(table)


class NewsStore:
    """Tables under ``root``, named by database and table; ``data`` may name another place for their rows."""

    def __init__(self, spark: SparkSession, root: str, data: str | None = None, lease: float = LEASE, snapshot_every: int = SNAPSHOT_EVERY) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.data = (data or f"{self.root}/data").rstrip("/")
        self.lease = lease
        self.log = CommitLog(spark, f"{self.root}/log", snapshot_every)

    # --- what the log says ---

    def committed(self, run: str) -> str | None:
        """The note of a run that is done, else None."""
        return self.log.state().runs.get(run)

    def _attempts(self, table: Table, pending: bool = False) -> dict[str, str]:
        """Batch to attempt that counts; of all batches or of those that have not been handed over."""
        state = self.log.state()
        used = state.used.get(named(table), {}) if pending else {}
        return {batch: attempt for batch, (attempt, _) in sorted(state.live.get(named(table), {}).items()) if batch not in used}

    def batches(self, database: str, table: str) -> list[str]:
        """Ids of all batches."""
        return list(self._attempts((database, table)))

    def consumed(self, database: str, table: str) -> list[str]:
        """Ids of the batches that have been handed over."""
        return sorted(self.log.state().used.get(f"{database}/{table}", {}))

    def pending_batches(self, database: str, table: str) -> list[str]:
        """Ids of the batches that have not been handed over."""
        return list(self._attempts((database, table), pending=True))

    # --- reading ---

    def _place(self, kind: str, attempt: str, table: Table) -> str:
        return f"{kind}/{ATTEMPT}={attempt}/{DATABASE}={table[0]}/{NAME}={table[1]}"

    def _read(self, folder: str, attempts: Iterable[str], table: Table, schema: T.StructType) -> DataFrame:
        """Rows of some attempts of a table, with the columns that their folders name; no other folder is listed."""
        whole = T.StructType([*schema, *(T.StructField(name, T.StringType()) for name in (ATTEMPT, DATABASE, NAME, BATCH))])
        paths = [self._place(folder, attempt, table) for attempt in attempts if attempt]
        return self.spark.read.schema(whole).option("basePath", folder).parquet(*paths) if paths else self.spark.createDataFrame([], whole)

    def _rows(self, table: Table, attempts: Mapping[str, str]) -> DataFrame:
        """Rows of some batches, with their batch and all changes; only folders of these attempts are listed."""
        schema = table_schema(*table)
        rows = self._read(self.data, attempts.values(), table, schema)
        changes = self.log.state().changes.get(named(table), [])
        for key, column in sorted({(own[2], own[3]) for own in changes}):
            rows = self._changed(rows, table, [own for own in changes if (own[2], own[3]) == (key, column)], key, column)
        return rows.select(*schema.fieldNames(), BATCH)

    def _told(self, changes: Iterable[list]) -> DataFrame:
        """(key, value, seq) of some changes; those that have not been merged have one commit's number."""
        schema = T._parse_datatype_string(CHANGES)
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/changes/{own[0]}").withColumn("seq", F.coalesce("seq", F.lit(own[4]))) for own in changes]
        return reduce(DataFrame.unionByName, parts)

    def _changed(self, rows: DataFrame, table: Table, changes: list[list], key: str, column: str) -> DataFrame:
        """Rows with the newest value of a column, unless they were written after it."""
        newest = self._told(changes).groupBy(F.col("key").alias(key)).agg(F.max(F.struct("seq", "value")).alias("_change"))
        oldest = min(own[4] for own in changes) if all(own[1] == 0 for own in changes) else 0
        later = {attempt: seq for attempt, seq in self.log.state().live.get(named(table), {}).values() if seq > oldest and attempt}
        written = F.lit(0).cast("long")
        if later:
            numbers = F.create_map(*[F.lit(x) for pair in later.items() for x in pair])
            written = F.coalesce(F.try_element_at(numbers, F.col(ATTEMPT)), F.lit(0)).cast("long")
        joined = lookup_join(rows.withColumn("_written", written), newest, key, "left")
        value = F.when(F.col("_change.seq") > F.col("_written"), F.col("_change.value")).otherwise(F.col(column))
        return joined.select(*[value.alias(column) if name == column else F.col(name) for name in rows.columns])

    def read(self, database: str, table: str) -> DataFrame:
        """Every row of a table, with its batch."""
        return self._rows((database, table), self._attempts((database, table)))

    def batch_rows(self, database: str, table: str, batch_ids: Iterable[str]) -> DataFrame:
        """Rows of some batches."""
        wanted, attempts = set(batch_ids), self._attempts((database, table))
        return self._rows((database, table), {batch: attempts[batch] for batch in attempts if batch in wanted}).drop(BATCH)

    def pending(self, database: str, table: str) -> DataFrame:
        """Rows that have not been handed over."""
        return self._rows((database, table), self._attempts((database, table), pending=True)).drop(BATCH)

    def known_words(self, database: str, table: str, pending: bool = False) -> DataFrame:
        """(agency, word, mask) of the ids of a table, or of its pending batches; words may come in several rows."""
        state = self.log.state()
        used = state.used.get(f"{database}/{table}", {}) if pending else {}
        runs = [own[0] for own in state.ids.get(f"{database}/{table}", ()) if own[2] not in used]
        return self._read(f"{self.root}/ids", runs, (database, table), ids_of.WORDS).select(ids_of.WORDS.fieldNames())

    # --- writing ---

    def commit(
        self,
        run: str,
        batch: str,
        rows: DataFrame,
        targets: Sequence[Table],
        uses: Sequence[tuple[Table, str]] = (),
        counts: Mapping[str, Column] | None = None,
        digests: Column | None = None,
    ) -> dict[str, int]:
        """Write one batch of several tables in one pass, and make it count; returns its counts.

        ``rows`` carry ``database`` and ``name`` of the table they go to.  ``counts`` are aggregates over the rows, taken
        while they are written, and kept as the run's note.  ``digests`` is an id for rows whose address has none; these are
        indexed apart (``error/digests``).  A run that is done is not done again.
        """
        done = self.committed(run)
        if done is not None:
            return json.loads(done or "{}")
        attempt, sources = uuid.uuid4().hex, [f"{named(table)}/{name}" for table, name in uses]
        told = [f"{named(table)}/{batch}" for table in targets]
        columns = {field.name: field for table in targets for field in table_schema(*table)}
        digests = F.lit(None).cast("long") if digests is None else digests
        seen = Observation()
        observed = rows.observe(seen, *[count.alias(name) for name, count in counts.items()]) if counts else rows
        whole = T.StructType([T.StructField(DATABASE, T.StringType()), T.StructField(NAME, T.StringType()), *columns.values(), T.StructField("_digest", T.LongType())])
        made = conform(observed.withColumn("_digest", digests), whole).withColumn(BATCH, F.lit(batch))
        try:
            made.write.partitionBy(DATABASE, NAME, BATCH).parquet(f"{self.data}/{ATTEMPT}={attempt}")
            present = [table for table in targets if self._present(attempt, table)]
            indexed = self._index(attempt, present)
        except Exception as problem:
            self._aside(made, attempt, problem)
            self._failed(run, told, sources, problem)
            raise
        note = json.dumps(seen.get if counts else {})
        used = {(named(table), name) for table, name in uses}

        def entry(state: State) -> dict | None:
            if run in state.runs:
                return None
            lost = sorted(name for table, name in used if name in state.used.get(table, {}))
            if lost:
                raise Conflict(f"{run}: used up by another run: {lost}")
            return {
                "run": run,
                "writes": [[named(table), batch, attempt if table in present else ""] for table in targets],
                "uses": sorted(map(list, used)),
                "ids": [[named(table), attempt, 0, batch] for table in indexed],
                "note": note,
            }

        if self.log.commit(entry) is None:  # the run was done meanwhile, by itself
            note = self.committed(run) or "{}"
        return json.loads(note)

    def _present(self, attempt: str, table: Table) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._place(self.data, attempt, table))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def _index(self, attempt: str, tables: Sequence[Table]) -> list[Table]:
        """Write the ids of an attempt that has been written, reading addresses only; returns the tables that have some."""
        if not tables:
            return []
        columns = T.StructType([T.StructField("url", T.StringType()), T.StructField("agency", T.StringType()), T.StructField("_digest", T.LongType())])
        rows = reduce(DataFrame.unionByName, [self._read(self.data, [attempt], table, columns) for table in tables])
        numbered = rows.select(DATABASE, NAME, "agency", url_part_id(F.col("url")).alias("id"))
        odd = rows.filter("_digest is not null").select(F.lit("error").alias(DATABASE), F.lit("digests").alias(NAME), "agency", F.col("_digest").alias("id"))
        words = ids_of.words(numbered.unionByName(odd), (DATABASE, NAME))
        words.sortWithinPartitions(DATABASE, NAME, "agency", "word").write.partitionBy(DATABASE, NAME).parquet(f"{self.root}/ids/{ATTEMPT}={attempt}")
        made = [*tables, ("error", "digests")]
        files = self.log.files
        return [table for table in made if files.system.exists(files._path(self._place(f"{self.root}/ids", attempt, table)))]

    def append(self, database: str, table: str, rows: DataFrame, batch_id: str) -> None:
        """Write one batch; writing it again replaces it."""
        self.commit(f"append/{database}/{table}/{batch_id}/{uuid.uuid4().hex}", batch_id, to_table(rows, (database, table)), [(database, table)])

    def mark_consumed(self, database: str, table: str, batch_ids: Iterable[str]) -> None:
        """Mark batches as handed over; marking twice changes nothing."""
        wanted, table_name = set(batch_ids), f"{database}/{table}"
        run = f"mark/{table_name}/{uuid.uuid4().hex}"

        def entry(state: State) -> dict | None:
            left = sorted(wanted - set(state.used.get(table_name, {})))
            return {"run": run, "uses": [[table_name, batch] for batch in left]} if left else None

        self.log.commit(entry)

    def take(self, run: str, database: str, table: str) -> list[str]:
        """The batches that a run works on, claimed for it: those it took before and nobody has used up, else all that are free.

        A run that is done is told what it used.
        """
        name = f"{database}/{table}"
        found: list[str] = []

        def entry(state: State) -> dict | None:
            used, claims = state.used.get(name, {}), state.claims.get(name, {})
            if run in state.runs:
                found[:] = sorted(batch for batch, by in used.items() if by == run)
                return None
            own = sorted(batch for batch, (by, _) in claims.items() if by == run)
            if own:
                found[:] = own
                return None
            free = [batch for batch in sorted(state.live.get(name, {})) if batch not in used and (batch not in claims or claims[batch][1] + self.lease <= now())]
            found[:] = free
            return {"by": run, "time": now(), "claims": [[name, batch] for batch in free]} if free else None

        self.log.commit(entry)
        return found

    def move(self, source: Table, target: Table, rows: DataFrame, batch_id: str, taken: Iterable[str]) -> None:
        """Write ``rows`` to the target and use up the source batches they were made from, at once."""
        self.commit(f"move/{named(target)}/{batch_id}", batch_id, to_table(rows, target), [target], [(source, batch) for batch in taken])

    # --- failures ---

    def _aside(self, made: DataFrame, attempt: str, problem: Exception) -> None:
        """Keep the rows of a write that failed; if they cannot be computed either, only the failure is kept."""
        try:
            made.write.partitionBy(DATABASE, NAME, BATCH).parquet(f"{self.root}/dead_letter/{ATTEMPT}={attempt}")
        except Exception as second:  # noqa: BLE001 - the first problem is the one that is told
            problem.add_note(f"rows were not kept aside: {str(second)[:200]}")

    def dead_letters(self, database: str, table: str) -> DataFrame:
        """Rows of batches that were computed and could not be written."""
        schema = T.StructType([*table_schema(database, table), *(T.StructField(name, T.StringType()) for name in (ATTEMPT, DATABASE, NAME, BATCH))])
        rows = read_or_empty(self.spark, f"{self.root}/dead_letter", schema)
        return rows.filter((F.col(DATABASE) == database) & (F.col(NAME) == table)).select(*table_schema(database, table).fieldNames(), BATCH)

    def failures(self) -> DataFrame:
        """Runs that failed, with their targets and source batches."""
        return read_or_empty(self.spark, f"{self.root}/failures", FAILURES)

    def _failed(self, run: str, targets: list[str], sources: list[str], problem: Exception) -> None:
        row = self.spark.createDataFrame([(run, targets, sources, str(problem)[:2000])], FAILURES)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/failures")

    # --- changes ---

    def update(self, database: str, table: str, updates: DataFrame, key: str, column: str) -> int:
        """Set a column by key on all rows that are there; returns the number of keys.

        Only keys and values are written.  Of several values for one key the greatest counts.
        """
        name, table_name, seen = uuid.uuid4().hex, f"{database}/{table}", Observation()
        changes = updates.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.max(F.col(column).cast("string")).alias("value"))
        present = self.read(database, table).select(F.col(key).cast("string").alias("key")).distinct()
        changes = changes.join(present, "key", "left_semi").withColumn("seq", F.lit(None).cast("long"))
        changes.observe(seen, F.count(F.lit(1)).alias("keys")).write.parquet(f"{self.root}/changes/{name}")
        keys = seen.get["keys"]
        if keys:
            run = f"update/{table_name}/{name}"
            self.log.commit(lambda state: {"run": run, "changes": [[table_name, name, 0, key, column, None]]})
        return keys

    # --- upkeep ---

    def tend(self, tables: Iterable[Table]) -> None:
        """Merge runs of ids and changes of tables whose batches are not handed over, until no level has ``FAN`` of them."""
        for table in tables:
            while self._merge_ids(table) or self._merge_changes(table):
                pass

    @staticmethod
    def _crowded(runs: Sequence[list]) -> list[list]:
        """The runs of the lowest level that has enough of them."""
        levels = sorted({own[1] for own in runs})
        return next((found for level in levels if len(found := [own for own in runs if own[1] == level]) >= FAN), [])

    def _merge_ids(self, table: Table) -> bool:
        runs = self._crowded(self.log.state().ids.get(named(table), []))
        if not runs:
            return False
        name = uuid.uuid4().hex
        merged = ids_of.merged_words(self._read(f"{self.root}/ids", [own[0] for own in runs], table, ids_of.WORDS)).sortWithinPartitions("agency", "word")
        merged.write.parquet(self._place(f"{self.root}/ids", name, table))
        return self._replaced("ids", table, runs, [named(table), name, runs[0][1] + 1, ""])

    def _merge_changes(self, table: Table) -> bool:
        for key, column in sorted({(own[2], own[3]) for own in self.log.state().changes.get(named(table), [])}):
            runs = self._crowded([own for own in self.log.state().changes[named(table)] if (own[2], own[3]) == (key, column)])
            if not runs:
                continue
            name = uuid.uuid4().hex
            newest = self._told(runs).groupBy("key").agg(F.max(F.struct("seq", "value")).alias("c")).select("key", "c.value", "c.seq")
            newest.write.parquet(f"{self.root}/changes/{name}")
            return self._replaced("changes", table, runs, [named(table), name, runs[0][1] + 1, key, column, max(own[4] for own in runs)])
        return False

    def _replaced(self, kind: str, table: Table, runs: Sequence[list], new: list) -> bool:
        """Commit a merge, unless another one came first."""
        gone = [own[0] for own in runs]

        def entry(state: State) -> dict | None:
            there = {own[0] for own in getattr(state, kind).get(named(table), ())}
            return {kind: [new], f"{kind}_gone": gone} if there.issuperset(gone) else None

        return self.log.commit(entry) is not None


def to_table(rows: DataFrame, table: Table) -> DataFrame:
    """Rows that all go to one table."""
    return rows.withColumns({DATABASE: F.lit(table[0]), NAME: F.lit(table[1])})


def routed(rows: DataFrame, targets: Mapping[Table, Column]) -> DataFrame:
    """Rows with the first table whose condition holds."""
    database = name = F.lit(None).cast("string")
    for table, condition in reversed(targets.items()):
        database, name = F.when(condition, F.lit(table[0])).otherwise(database), F.when(condition, F.lit(table[1])).otherwise(name)
    return rows.withColumns({DATABASE: database, NAME: name})
