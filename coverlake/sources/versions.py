"""Versioned tables: files by bucket, an order-free digest of each bucket, one manifest per version.

Rows are dealt to a fixed number of buckets by their key. The digest of a bucket is its number of rows and two sums of row
hashes, so it does not depend on order or layout and counts repeated rows. A new version writes only buckets whose digest
changed, reads them back, and is published by one rename of its manifest, which names the folder of every bucket. So a
reader always sees one whole version, two versions are compared by the buckets in which they differ, a rerun writes
nothing, and what was cut short on the way is never published.

A manifest has one entry per bucket, whatever the size of the table. ``vacuum`` removes versions that no reader holds and
files that no remaining version names. The table to write is read twice (digest, files) and must be the same both
times, which the digest of the written files proves. Writers exclude each other by the number of the version.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
INSERTED, UPDATED, DELETED = 0, 1, 2
_BUCKET = "_bucket"


class Conflict(Exception):
    """Another writer published the same version first."""


class Damaged(Exception):
    """Written files do not hold the rows they should."""


# -- digests


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """64 bits of all columns; a null differs from every value and from a null beside it."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def digest(columns: Sequence[str]) -> Column:
    """Digest of the multiset of rows of a group: rows and two sums of hashes, as text."""
    sums = [F.sum(row_hash(columns, seed).cast("decimal(38,0)")).cast("string") for seed in (0, 1)]
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums)


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(row_hash(keys, 7), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(``_bucket``, ``digest``) of the rows of each bucket, at most ``buckets`` rows."""
    columns = df.columns
    return df.groupBy(bucket_of(keys, buckets).alias(_BUCKET)).agg(digest(columns).alias("digest"))


def compared(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that are not in ``old`` (0), rows whose other columns differ (1), and rows of ``old`` that are gone (2).

    Both sides have the same columns and one row per key; a null in a key is a value.
    """
    columns = new.columns
    rest = [c for c in columns if c not in keys]
    match = None
    for k in keys:
        same = F.col(f"n.`{k}`").eqNullSafe(F.col(f"o.`{k}`"))
        match = same if match is None else match & same
    left, right = (d.select(*columns, F.lit(True).alias("_here"), row_hash(rest).alias("_hash")) for d in (new, old.select(*columns)))
    both = left.alias("n").join(right.alias("o"), match, "full")
    kind = (
        F.when(F.col("o._here").isNull(), INSERTED)
        .when(F.col("n._here").isNull(), DELETED)
        .when(F.col("n._hash") != F.col("o._hash"), UPDATED)
    )
    shown = [F.when(F.col("n._here"), F.col(f"n.`{c}`")).otherwise(F.col(f"o.`{c}`")).alias(c) for c in columns]
    return both.select(*shown, kind.alias("inc_type")).where("inc_type is not null")


def changed_rows(new: DataFrame, old: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """:func:`compared` on the buckets whose digests differ. The rows of equal buckets never reach the join."""
    old = old.select(*new.columns)
    a, b = digests(new, keys, buckets), digests(old, keys, buckets)
    differ = (
        a.withColumnRenamed("digest", "new_digest").join(b.withColumnRenamed("digest", "old_digest"), _BUCKET, "full").where(~F.col("new_digest").eqNullSafe(F.col("old_digest")))
    ).select(F.col(_BUCKET).alias("_differs"))

    def part(df: DataFrame) -> DataFrame:
        return df.join(differ, bucket_of(keys, buckets) == F.col("_differs"), "left_semi")

    return compared(part(new), part(old), keys)


# -- files


class Folder:
    """A folder of any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._at(name), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write a file under its name at once, unless there is one; says whether it did."""
        own = f"_new-{uuid4().hex}"
        self.write(own, text)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._fs.mkdirs(self._at(name).getParent())
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(
                self._fs.makeQualified(self._at(own)), self._fs.makeQualified(self._at(name)), none
            )
        except Exception as error:
            self.remove(own)
            if "AlreadyExists" in str(error):
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: str
    buckets: dict[int, tuple[str, str]]  # bucket -> (folder, digest)
    labels: tuple[str, ...] = ()
    note: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.__dict__ | {"buckets": [[b, *v] for b, v in sorted(self.buckets.items())]})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        d = json.loads(text)
        return cls(d["version"], d["schema"], {b: (p, g) for b, p, g in d["buckets"]}, tuple(d["labels"]), d["note"])


class VersionedTable:
    """A table of one row per key (or any rows, if versions are not compared), see the module."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.folder = Folder(spark, path)

    # versions

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("versions") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """One version, the latest by default; none before the first."""
        known = self.versions()
        if version is None and not known:
            return None
        return Manifest.from_json(self.folder.text(f"versions/{known[-1] if version is None else version:010d}.json"))

    def labelled(self, label: str) -> Manifest | None:
        """The newest version that carries a label."""
        for version in reversed(self.versions()):
            found = self.manifest(version)
            if label in found.labels:
                return found
        return None

    # reading

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of a version, or of some buckets of it: other files are not listed."""
        found = self.manifest(version)
        if found is None:
            raise PySparkException(f"no version of {self.path}")
        return self._rows(found, found.buckets if buckets is None else [b for b in buckets if b in found.buckets])

    def _rows(self, found: Manifest, buckets: Sequence[int]) -> DataFrame:
        schema = StructType.fromJson(json.loads(found.schema))
        paths = [f"{self.path}/data/{found.buckets[b][0]}/{_BUCKET}={b}" for b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @contextmanager
    def held(self, version: int | None = None) -> Iterator[int]:
        """Keep a version's files while it is read."""
        found = self.manifest(version)
        mark = f"held/{found.version:010d}-{uuid4().hex}"
        self.folder.write(mark, "")
        try:
            self.folder.text(f"versions/{found.version:010d}.json")  # still there: a vacuum may have come between
            yield found.version
        finally:
            self.folder.remove(mark)

    # writing

    def write(self, df: DataFrame, label: str | None = None, note: dict | None = None) -> Manifest:
        """Publish ``df`` as the next version. If no bucket changed and the label is there, the last version stays."""
        last = self.manifest()
        schema = df.schema.json()
        old = last.buckets if last and last.schema == schema else {}
        now = {r[_BUCKET]: r.digest for r in digests(df, self.keys, self.buckets).collect()}  # a row per bucket
        changed = [b for b, d in now.items() if old.get(b, ("", ""))[1] != d]
        gone = set(last.buckets) - set(now) if last else set()
        labels = tuple(x for x in [label] if x)
        if last and last.schema == schema and not changed and not gone and set(labels) <= set(last.labels) and note is None:
            return last
        place = uuid4().hex
        self.folder.write(f"held/writing-{place}", "")
        try:
            if changed:
                rows = df.withColumn(_BUCKET, bucket_of(self.keys, self.buckets)).where(F.col(_BUCKET).isin(changed))
                rows.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{place}")
            kept = {b: old[b] for b in now if b not in changed} | {b: (place, now[b]) for b in changed}
            made = Manifest(last.version + 1 if last else 1, schema, kept, labels, note or {})
            wrong = self.damaged(made, changed)
            if wrong:
                raise Damaged(f"buckets {wrong} of {self.path}")
            if not self.folder.publish(f"versions/{made.version:010d}.json", made.to_json()):
                raise Conflict(f"version {made.version} of {self.path}")
        finally:
            self.folder.remove(f"held/writing-{place}")
        return made

    def damaged(self, found: Manifest, buckets: Sequence[int] | None = None) -> list[int]:
        """Buckets whose files do not have the digest that the manifest has for them."""
        asked = list(found.buckets if buckets is None else buckets)
        if not asked:
            return []
        is_ = {r[_BUCKET]: r.digest for r in digests(self._rows(found, asked), self.keys, self.buckets).collect()}
        return sorted(b for b in asked if is_.get(b) != found.buckets[b][1])

    # comparing and cleaning

    def changes(self, old: int, new: int) -> DataFrame:
        """Rows inserted (0), updated (1) and deleted (2) from one version to another; equal buckets are not read."""
        a, b = self.manifest(old), self.manifest(new)
        differ = sorted(k for k in a.buckets.keys() | b.buckets.keys() if a.buckets.get(k, ("", None))[1] != b.buckets.get(k, ("", None))[1])
        before, after = (self._rows(m, [k for k in differ if k in m.buckets]) for m in (a, b))
        return compared(after, before, self.keys)

    def vacuum(self, keep: int = 1, labels: Sequence[str] = ()) -> list[int]:
        """Remove versions but the last ``keep``, those with one of ``labels`` and those held; says which went.

        Then files go that no remaining version names and no writer is writing.
        """
        marks = self.folder.names("held")
        held = {int(m.split("-")[0]) for m in marks if not m.startswith("writing-")}
        writing = {m.removeprefix("writing-") for m in marks if m.startswith("writing-")}
        every = self.versions()
        stay = {v for v in every if v in held or v in every[-keep:] or set(self.manifest(v).labels) & set(labels)}
        gone = [v for v in every if v not in stay]
        for version in gone:
            self.folder.remove(f"versions/{version:010d}.json")
        used = {(place, b) for v in stay for b, (place, _) in self.manifest(v).buckets.items()}
        for place in set(self.folder.names("data")) - writing:
            files = [n for n in self.folder.names(f"data/{place}") if n.startswith(f"{_BUCKET}=")]
            unused = [n for n in files if (place, int(n.split("=")[1])) not in used]
            if len(unused) == len(files):
                self.folder.remove(f"data/{place}")
            else:
                for name in unused:
                    self.folder.remove(f"data/{place}/{name}")
        return gone


def copy_tables(spark: SparkSession, tables: dict[str, tuple[DataFrame, Sequence[str]]], root: str, label: str, buckets: int = BUCKETS) -> dict[str, int]:
    """Verified copies of tables (frame, keys) under ``root`` as versions with a label such as a day or a week.

    Returns the version of each. A rerun with the same label and rows copies nothing; a table that did not change since the
    last label shares its files with it.
    """
    return {name: VersionedTable(spark, f"{root}/{name}", keys, buckets).write(df, label).version for name, (df, keys) in tables.items()}


def expire_copies(spark: SparkSession, names: Sequence[str], root: str, labels: Sequence[str], buckets: int = BUCKETS) -> dict[str, list[int]]:
    """Keep the versions with ``labels`` (days and weeks to retain) and the last one."""
    return {name: VersionedTable(spark, f"{root}/{name}", [], buckets).vacuum(1, labels) for name in names}
