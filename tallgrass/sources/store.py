"""Stored tables that change as a whole: immutable files, numbered snapshots, one new snapshot file per commit.

A commit writes its files to a folder of its own and then creates ``snapshots/<number>.json``, which says for every table which folders
hold its parts. The file is written beside its place and renamed, and a number that is taken is never overwritten, so whoever reads
sees a whole snapshot, the old or the new one. No commit touches the files of an earlier one: a DataFrame stays bound to the snapshot
it was opened at until ``vacuum`` deletes what no kept snapshot names.

A commit may name its source and number there (a stream and its batch): the snapshot keeps the last number of each
source, so that work that runs again can see that it is in already. Two commits that touch different tables or parts both
succeed; of two that touch the same, the later one fails with ``Conflict`` and must start from the new snapshot.

Renaming without overwriting is atomic on HDFS and checked first on local disks; on object stores it is as safe as their connector makes it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .files import listed, write_json

#: The column that the folders of a table's parts are named by.
PART = "part"


class Conflict(RuntimeError):
    """Another commit has changed what this one changes."""


@dataclass
class Snapshot:
    """``tables``: name -> {"schema": JSON, "parts": {part: folder below the root}}; ``sources``: source -> last number."""

    number: int = -1
    tables: dict[str, dict] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)

    def parts(self, table: str) -> dict[str, str]:
        return self.tables.get(table, {}).get("parts", {})


@dataclass
class Change:
    """New folders of a table's parts. ``whole``: they are all of the table; else other parts stay."""

    schema: T.StructType
    parts: dict[str, str]
    whole: bool


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def step(self, what: str) -> None:
        """Called before each change to the store's files; tests break off here."""

    # ------------------------------------------------------------ reading

    def numbers(self) -> list[int]:
        """Numbers of all snapshots, ascending."""
        names = (p.rpartition("/")[2].removesuffix(".json") for p in listed(self.spark, f"{self.root}/snapshots/*.json"))
        return sorted(int(n) for n in names if n.isdigit())

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The snapshot of that number, else the last one; an empty one before the first commit."""
        if number is None:
            number = max(self.numbers(), default=-1)
        if number < 0:
            return Snapshot()
        text = "\n".join(r.value for r in self.spark.read.text(f"{self.root}/snapshots/{number}.json").collect())
        return Snapshot(**json.loads(text))

    def read(self, table: str, at: Snapshot | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """A table, or some of its parts, as of a snapshot; the last one unless told. One scan, however many commits wrote the parts."""
        at = at or self.snapshot()
        if table not in at.tables:
            raise KeyError(f"{self.root} has no table {table} in snapshot {at.number}")
        schema = T.StructType.fromJson(json.loads(at.tables[table]["schema"]))
        have = at.parts(table)
        folders = [f"{self.root}/{have[p]}" for p in (have if parts is None else parts) if p in have]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*sorted(folders)).select(*(F.col(f"`{f.name}`") for f in schema))

    # ------------------------------------------------------------ writing

    def write(self, table: str, df: DataFrame, part: Column | None = None, partitioned: Sequence[str] = ()) -> Change:
        """Write ``df`` to a new folder, not yet seen by anybody: as one part, or by the text ``part``. Without ``part`` the files may be
        partitioned by columns, which stay columns of the table. A null part is left out."""
        folder = f"data/{uuid.uuid4().hex}/{table}"
        self.step(f"write {table}")
        if part is None:
            out = df.write
            (out.partitionBy(*partitioned) if partitioned else out).parquet(f"{self.root}/{folder}")
            return Change(df.schema, {"": folder}, True)
        if PART in df.columns:
            raise ValueError(f"a table in parts cannot have a column {PART}")
        df.withColumn(PART, part).filter(F.col(PART).isNotNull()).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        made = [p.rpartition("/")[2] for p in listed(self.spark, f"{self.root}/{folder}/{PART}=*")]
        return Change(df.schema, {unquote(name.partition("=")[2]): f"{folder}/{name}" for name in made}, False)

    def commit(self, base: Snapshot, changes: dict[str, Change], source: tuple[str, int] | None = None) -> Snapshot:
        """Make ``changes``, which were derived from ``base``, the next snapshot."""
        now = base
        while True:
            new = Snapshot(now.number + 1, {k: dict(v) for k, v in now.tables.items()}, dict(now.sources))
            for table, c in changes.items():
                parts = c.parts if c.whole else now.parts(table) | c.parts
                new.tables[table] = {"schema": json.dumps(json.loads(c.schema.json())), "parts": parts}
            if source:
                new.sources[source[0]] = source[1]
            if self._create(new):
                return new
            now = self.snapshot()
            for table, c in changes.items():
                was, is_ = base.parts(table), now.parts(table)
                if (c.whole and was != is_) or any(was.get(p) != is_.get(p) for p in c.parts):
                    raise Conflict(f"{table} of {self.root} has changed since snapshot {base.number}")
            if source and now.sources.get(source[0], -1) >= source[1]:
                return now  # the same work, done by somebody else meanwhile

    def _create(self, new: Snapshot) -> bool:
        """Create the file of a snapshot whole; False if its number is taken."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        place = jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshots/{new.number}.json")
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshots/.{uuid.uuid4().hex}")
        self.step("draft")
        write_json(self.spark, draft.toString(), new.__dict__)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)
        self.step("rename")
        if files.util().exists(place):
            files.delete(draft, False)
            return False
        try:
            files.rename(draft, place, self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            files.delete(draft, False)
            return False
        self.step("renamed")
        return True

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all snapshots but the last ``keep``, and folders of data that no kept one names; those folders. Not while a commit is being made."""
        numbers = self.numbers()
        used = {f.split("/")[1] for n in numbers[-keep:] for t in self.snapshot(n).tables.values() for f in t["parts"].values()}
        gone = [p for p in listed(self.spark, f"{self.root}/data/*") if p.rpartition("/")[2] not in used]
        jvm, conf = self.spark.sparkContext._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for place in [*(f"{self.root}/snapshots/{n}.json" for n in numbers[:-keep]), *gone]:
            p = jvm.org.apache.hadoop.fs.Path(place)
            p.getFileSystem(conf).delete(p, True)
        return gone


# ---------------------------------------------------------------- keyed tables

BUCKETS = 64


def upsert(store: Store, table: str, rows: DataFrame, keys: Sequence[str], newest: Sequence[str], buckets: int = BUCKETS, source: tuple[str, int] | None = None) -> Snapshot:
    """Put ``rows`` into a keyed table: of the rows of a key, stored or new, the one with the greatest ``newest`` stays.

    The table lies in ``buckets`` parts by the hash of its key (the number of its first commit holds). Only buckets that get a row are read and
    written again. NULLs are equal keys; a NULL in ``newest`` is oldest; where ``newest`` is equal, new rows win over stored ones, and of
    those the one with the greatest hash. Columns that only one side has are kept, NULL on the other. A source's number that is in already changes nothing.
    """
    base = store.snapshot()
    if source and base.sources.get(source[0], -1) >= source[1]:
        return base
    have = base.parts(table)
    if have:
        buckets = int(next(iter(have)).partition("of")[2])
    bucket = F.format_string(f"%06dof{buckets}", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    touched = [r[0] for r in rows.select(bucket).distinct().collect()]  # no more than there are buckets
    both = rows.withColumn("_new", F.lit(1))
    if table in base.tables:
        both = both.unionByName(store.read(table, base, touched).withColumn("_new", F.lit(0)), allowMissingColumns=True)
    names = [f.name for f in both.schema if not isinstance(f.dataType, (T.MapType, T.VariantType)) and f.name != "_new"]
    order = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in newest), F.desc("_new"), F.desc(F.xxhash64(*names)))
    latest = both.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank", "_new")
    return store.commit(base, {table: store.write(table, latest, bucket)}, source)
