"""Committed folders: how several runs append to one Parquet table and nothing is lost or read twice.

A micro-batch (or a batch job) writes its rows into a folder of its own, of its own
attempt, and then adds one small entry to the table's manifest. Readers follow the
manifest only, so what a lost executor, a failed or a doubled attempt leaves behind is
never seen:

    table/data/commit=<run>-<batch>-<attempt>/reading_date=<day>/part-...
    table/_manifest/<run>-<batch>.json      {"seq", "run", "batch", "parts", "replaces", "key", "schema"}
    table/_manifest/folded-<number>.json    all entries up to then

* ``run`` is the streaming query's id. It is kept in the checkpoint, so a restart goes
  on under the same run, and a query on a new checkpoint is a new run that overwrites
  nothing, whatever its batch numbers.
* The entry of (run, batch) is made by a rename that fails where the name exists (on a file
  system with atomic renames): a replayed batch finds its entry and writes nothing.
* Two runs over the same input hold a reading twice until :func:`compact` has rewritten
  the days that more than one commit wrote: it keeps one row per reading (see
  ``identity``), that of the earliest commit, and its entry names the parts it replaces.
  :func:`read_table` with that key gives the same rows before.
* :func:`vacuum` removes folders that no live entry names.

The manifest has one small file per micro-batch. Every ``FOLD_EVERY`` commits, and at each
compaction, all entries are folded into one file, so a reader opens that one and the few
files since; a commit itself only lists names. A part is one day of one commit, so a
compaction reads the days it rewrites only.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA, MANIFEST, COMMIT, FOLDED = "data", "_manifest", "commit", "folded-"
FOLD_EVERY = 256


class Folder:
    """Listing, small files and renames through the Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, sub: str) -> list[str]:
        p = self._hadoop(f"{self.path}/{sub}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def age_seconds(self, sub: str) -> float:
        return time.time() - self.fs.getFileStatus(self._hadoop(f"{self.path}/{sub}")).getModificationTime() / 1000

    def exists(self, sub: str) -> bool:
        return self.fs.exists(self._hadoop(f"{self.path}/{sub}"))

    def read(self, sub: str) -> str:
        stream = self.fs.open(self._hadoop(f"{self.path}/{sub}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, sub: str, text: str) -> bool:
        """Write ``text`` under ``sub`` in one step; False where the name is taken."""
        draft = self._hadoop(f"{self.path}/{MANIFEST}/.{uuid.uuid4().hex}")
        out = self.fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        target = self._hadoop(f"{self.path}/{sub}")
        if not self.fs.exists(target) and self.fs.rename(draft, target):
            return True
        self.fs.delete(draft, False)
        return False

    def remove(self, sub: str) -> None:
        self.fs.delete(self._hadoop(f"{self.path}/{sub}"), True)


@dataclass(frozen=True)
class Entry:
    """One commit: the parts it adds and the parts it replaces."""

    name: str
    seq: int
    run: str
    batch: int
    parts: tuple[str, ...]
    replaces: tuple[str, ...]
    key: tuple[str, ...]
    schema: str


def _names(folder: Folder) -> tuple[list[str], list[str]]:
    """(entries, foldings), both sorted by name."""
    names = [n for n in folder.names(MANIFEST) if n.endswith(".json") and not n.startswith(".")]
    return [n for n in names if not n.startswith(FOLDED)], [n for n in names if n.startswith(FOLDED)]


def _entry(name: str, e: dict) -> Entry:
    return Entry(name, e["seq"], e["run"], e["batch"], tuple(e["parts"]), tuple(e["replaces"]), tuple(e["key"]), e["schema"])


def entries(spark: SparkSession, path: str) -> list[Entry]:
    folder = Folder(spark, path)
    names, foldings = _names(folder)
    known = json.loads(folder.read(f"{MANIFEST}/{foldings[-1]}")) if foldings else []
    out = [_entry(e["name"], e) for e in known]
    held = {e.name for e in out}
    out += [_entry(n, json.loads(folder.read(f"{MANIFEST}/{n}"))) for n in names if n not in held]
    return sorted(out, key=lambda e: (e.seq, e.run, e.batch))


def fold(spark: SparkSession, path: str) -> None:
    """All entries in one file more; the files of single entries stay, as their names tell what is committed."""
    folder = Folder(spark, path)
    foldings = _names(folder)[1]
    number = 1 + int(foldings[-1][len(FOLDED):-len(".json")]) if foldings else 0
    folder.publish(f"{MANIFEST}/{FOLDED}{number:09d}.json", json.dumps([asdict(e) for e in entries(spark, path)]))


def live_parts(found: list[Entry]) -> dict[str, int]:
    """Part -> seq of its commit, for the parts that no later entry replaces."""
    gone = {p for e in found for p in e.replaces}
    return {p: e.seq for e in found for p in e.parts if p not in gone}


def query_run(spark: SparkSession) -> str | None:
    """The id of the streaming query whose ``foreachBatch`` is running (kept in its checkpoint)."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def is_committed(spark: SparkSession, path: str, run: str, batch: int) -> bool:
    return Folder(spark, path).exists(f"{MANIFEST}/{run}-{batch}.json")


def commit(df: DataFrame, path: str, run: str, batch: int, by: str | None = None, order: tuple[str, ...] = (),
           key: tuple[str, ...] = (), replaces: tuple[str, ...] = (), options: dict | None = None) -> bool:
    """Add the rows of ``df`` to the table as (run, batch); False where that is committed already.

    ``by`` is the partition column (days), ``order`` sorts the rows within a file. ``key`` states
    that the rows hold each key once (the caller has seen to it).
    """
    spark, folder = df.sparkSession, Folder(df.sparkSession, path)
    if folder.exists(f"{MANIFEST}/{run}-{batch}.json"):
        return False
    name = f"{COMMIT}={run}-{batch}-{uuid.uuid4().hex[:12]}"
    # REBALANCE: a large day goes to many writers, small days share one
    out = df.hint("rebalance", by) if by else df
    if order:
        out = out.sortWithinPartitions(*([by] if by else []), *order)
    writer = out.write.options(**(options or {}))
    (writer.partitionBy(by) if by else writer).parquet(f"{path}/{DATA}/{name}")
    # one day of one commit is a part: the list is bounded by the batch's time span
    days = [n for n in folder.names(f"{DATA}/{name}") if by and n.startswith(f"{by}=")]
    parts = [f"{name}/{d}" for d in days] if by else [name]
    # later than every entry that is there: names are never removed
    seq = 1 + len(_names(folder)[0])
    entry = {"seq": seq, "run": run, "batch": int(batch), "parts": parts,
             "replaces": list(replaces), "key": list(key), "schema": df.schema.json()}
    done = folder.publish(f"{MANIFEST}/{run}-{batch}.json", json.dumps(entry))
    if done and seq % FOLD_EVERY == 0:
        fold(spark, path)
    return done


def _schema(found: list[Entry], by: str | None) -> T.StructType:
    """Columns of all commits, later ones last; a column that a commit lacks reads as NULL."""
    fields: dict[str, T.StructField] = {}
    for e in found:
        for f in T.StructType.fromJson(json.loads(e.schema)).fields:
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType([*(f for n, f in fields.items() if n != by), T.StructField(COMMIT, T.StringType()),
                         *([fields[by]] if by in fields else [])])


def _load(spark: SparkSession, path: str, found: list[Entry], parts: list[str], by: str | None) -> DataFrame:
    schema = _schema(found, by)
    if not parts:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", f"{path}/{DATA}")
            .parquet(*[f"{path}/{DATA}/{p}" for p in sorted(parts)]))


def _once(df: DataFrame, parts: dict[str, int], key: tuple[str, ...]) -> DataFrame:
    """One row per key, that of the earliest commit."""
    seq = {p.split("/")[0].removeprefix(f"{COMMIT}="): s for p, s in parts.items()}
    # one row per commit since the last compaction
    ranks = F.broadcast(df.sparkSession.createDataFrame(list(seq.items()), f"{COMMIT} string, _seq int"))
    first = Window.partitionBy(*key).orderBy("_seq")
    return (df.join(ranks, COMMIT).withColumn("_n", F.row_number().over(first))
            .where("_n = 1").select(*df.columns))


def read_table(spark: SparkSession, path: str, by: str | None = None, key: tuple[str, ...] | None = None,
               run: str | None = None, empty: T.StructType | None = None) -> DataFrame:
    """The rows of all live commits (of one run); with ``key`` one row per key, as after a compaction.

    A table without a commit has no columns yet: it has those of ``empty``, or is an error.

    Days that one commit wrote with that key need no second look.
    """
    found = entries(spark, path)
    own = {p for e in found if run is None or e.run == run for p in e.parts}
    if not any(run is None or e.run == run for e in found):
        if empty is not None:
            return spark.createDataFrame([], empty)
        raise FileNotFoundError(f"no committed table at {path}")
    parts = {p: s for p, s in live_parts(found).items() if p in own}
    if key is None:
        return _load(spark, path, found, list(parts), by).drop(COMMIT)
    shared = {p: s for p, s in _shared(found, key).items() if p in own}
    rows = _load(spark, path, found, [p for p in parts if p not in shared], by)
    if shared:
        rows = rows.unionByName(_once(_load(spark, path, found, list(shared), by), shared, key))
    return rows.drop(COMMIT)


def _shared(found: list[Entry], key: tuple[str, ...]) -> dict[str, int]:
    """Parts that may hold a key twice: days of more than one commit, or of one that was not written by key."""
    live, plain = live_parts(found), {p for e in found if e.key != key for p in e.parts}
    per: dict[str, list[str]] = {}
    for p in live:
        per.setdefault(p.partition("/")[2], []).append(p)
    return {p: live[p] for ps in per.values() if len(ps) > 1 or ps[0] in plain for p in ps}


def compact(spark: SparkSession, path: str, key: tuple[str, ...], by: str | None = None, order: tuple[str, ...] = (),
            options: dict | None = None) -> int:
    """Rewrite the days that may hold a key twice, each key once; returns the number of parts replaced.

    Commits made meanwhile stay as they are: the entry names exactly the parts that were read.
    """
    found = entries(spark, path)
    shared = _shared(found, key)
    if not shared:
        return 0
    rows = _once(_load(spark, path, found, list(shared), by), shared, key).drop(COMMIT)
    run = f"compact{uuid.uuid4().hex[:12]}"
    commit(rows, path, run, 0, by, order, key, tuple(sorted(shared)), options)
    fold(spark, path)
    return len(shared)


def vacuum(spark: SparkSession, path: str, older_than_seconds: float) -> int:
    """Remove folders of commits that no live entry names and that are older than the given age."""
    folder, live = Folder(spark, path), {p.split("/")[0] for p in live_parts(entries(spark, path))}
    gone = [n for n in folder.names(DATA) if n.startswith(f"{COMMIT}=") and n not in live
            and folder.age_seconds(f"{DATA}/{n}") > older_than_seconds]
    for n in gone:
        folder.remove(f"{DATA}/{n}")
    return len(gone)
