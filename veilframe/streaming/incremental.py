"""Incremental anonymisation of a growing table.

Each micro-batch goes on with the ledger the batch before it left: the map, the
name tokens and the marks of the slots. That ledger is a *version*. A version
names folders, and a batch adds one folder to each table, so what a batch writes
is what the batch has learned; every few batches the folders are merged into one,
clustered by the key the table is looked up by. The map is stored with its reuse
keys, and a batch reads of it the rows of its own keys.

A version becomes visible when its file is renamed into place, which is atomic,
and it is found by the number of the batch. A batch that is repeated after a
failure reads the version before it, writes its output anew and replaces its own
version; folders of the failed attempt are named by no version and never read. So
no pair is appended twice. One query owns a state folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veilframe.config import DEFAULT, Config
from veilframe.operators.allocate import MARKS
from veilframe.operators.apply import anonymize
from veilframe.operators.ledger import TOKENS, Ledger
from veilframe.plans.plan import ColumnPlan
from veilframe.sources import entity_map as em

# Stored tables: schema, and the column they are clustered by.
TABLES = {
    "map": (f"{em.SCHEMA}, nk string, label_cf string, fake_cf string, excluded boolean", "nk"),
    "tokens": (TOKENS, "nk"),
    "marks": (MARKS, "family"),
}


@dataclass
class Version:
    """Folders of each table as of a batch."""

    batch: int = -1
    folders: dict[str, list[str]] = field(default_factory=lambda: {name: [] for name in TABLES})


class IncrementalAnonymizer:
    """Paths and settings of one incremental copy."""

    def __init__(
        self,
        spark: SparkSession,
        plan: list[ColumnPlan],
        state: str,
        base_map: DataFrame | None = None,
        table: str = "table",
        keys: list[str] | None = None,
        config: Config = DEFAULT,
        compact_every: int = 16,
        **options,
    ) -> None:
        self.spark, self.plan, self.state = spark, plan, state.rstrip("/")
        self.base_map, self.table, self.keys = base_map, table, keys
        self.config, self.compact_every, self.options = config, compact_every, options

    # -- versions --------------------------------------------------------------

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        folder = path(f"{self.state}/versions")
        return path, folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self, before: int | None = None) -> Version:
        """The last version, or the last one before a batch."""
        path, folder, files = self._files()
        if not files.exists(folder):
            return Version()
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))
        numbers = [n for n in numbers if before is None or n < before]
        if not numbers:
            return Version()
        text = self.spark.read.text(f"{self.state}/versions/{numbers[-1]:020d}.json", wholetext=True).first()[0]
        return Version(**json.loads(text))

    def _publish(self, version: Version) -> None:
        path, folder, files = self._files()
        name = f"{version.batch:020d}.json"
        hidden, target = path(f"{self.state}/versions/.{uuid.uuid4().hex}"), path(f"{self.state}/versions/{name}")
        files.mkdirs(folder)
        out = files.create(hidden, True)
        out.write(bytearray(json.dumps(version.__dict__).encode()))
        out.close()
        if files.exists(target):  # of an attempt that is now repeated
            files.delete(target, False)
        if not files.rename(hidden, target):
            raise OSError(f"{target} could not be put in place")

    def _table(self, version: Version, name: str) -> DataFrame | None:
        schema, _ = TABLES[name]
        folders = version.folders[name]
        return self.spark.read.schema(schema).parquet(*folders) if folders else None

    def ledger(self, before: int | None = None) -> Ledger:
        """What is known after the last batch, or before a batch."""
        version = self.version(before)
        stored = self._table(version, "map")
        known = None if self.base_map is None else em.clean(self.base_map)
        if stored is not None:
            known = stored if known is None else known.unionByName(stored)
        if known is None:
            known = em.clean(em.empty_map(self.spark))
        marks = self._table(version, "marks")
        if marks is not None:
            marks = marks.groupBy("family", "bucket").agg(F.max("next").alias("next"))
        return Ledger(known, self._table(version, "tokens"), marks)

    def entity_map(self, before: int | None = None) -> DataFrame:
        columns = [c.split()[0] for c in em.SCHEMA.split(", ")]
        return self.ledger(before).entity_map.select(*columns)

    def output(self) -> str:
        return f"{self.state}/copy"

    # -- batches ---------------------------------------------------------------

    def process(self, batch: DataFrame, number: int) -> None:
        """One micro-batch; safe to repeat."""
        before, known = self.version(number), self.ledger(number)
        result = anonymize(batch, self.plan, self.table, self.keys, config=self.config, ledger=known, **self.options)
        result.df.write.mode("overwrite").parquet(f"{self.output()}/batch={number}")
        learned: dict[str, DataFrame] = {}
        if result.calls:
            learned["map"] = em.clean(result.map_rows(known.entity_map))
            marks = [call.new_marks() for call in result.calls]
            if self.base_map is not None and not before.folders["marks"]:
                marks.append(result.calls[0].before.marks)  # counted from the base map once
            merged = marks[0]
            for part in marks[1:]:
                merged = merged.unionByName(part)
            learned["marks"] = merged.groupBy("family", "bucket").agg(F.max("next").alias("next"))
            tokens = result.tokens
            if tokens is not None:
                learned["tokens"] = tokens if known.tokens is None else tokens.join(known.tokens.select("role", "nk"), ["role", "nk"], "left_anti")
        version = Version(number, {name: list(folders) for name, folders in before.folders.items()})
        for name, rows in learned.items():
            version.folders[name].append(self._store(rows, name))
        for name, folders in version.folders.items():
            if len(folders) >= self.compact_every:
                rows = self._table(version, name)
                if name == "marks":
                    rows = rows.groupBy("family", "bucket").agg(F.max("next").alias("next"))
                version.folders[name] = [self._store(rows, name, True)]
        self._publish(version)

    def _store(self, rows: DataFrame, name: str, whole: bool = False) -> str:
        """A new folder of a table; clustered by its key, so a reader can leave out row groups."""
        schema, key = TABLES[name]
        columns = [c.split()[0] for c in schema.split(", ")]
        path = f"{self.state}/{name}/{uuid.uuid4().hex}"
        rows = rows.select(*columns)
        if whole:
            rows = rows.repartitionByRange(key).sortWithinPartitions(key)
        rows.write.parquet(path)
        return path

    def start(self, source: str, schema: StructType, fmt: str = "parquet", max_files: int | None = None) -> StreamingQuery:
        """Work off all input files not seen yet, then stop."""
        reader = self.spark.readStream.schema(schema).format(fmt)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return (
            reader.load(source)
            .writeStream.foreachBatch(lambda df, number: self.process(df, number))
            .option("checkpointLocation", f"{self.state}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
