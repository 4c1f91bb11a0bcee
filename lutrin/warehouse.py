"""Parquet tables of the warehouse, written so that a repeated run gives the same result.

Every write goes to a folder `version=N` of its table that nothing reads yet. A commit
(`manifests`) then says, for each partition, which version is read, so whole days, states and
several tables of a domain change at once or not at all, on any file system. Readers list only
the folders that the commit names. Four kinds of tables:

* facts, partitioned by `journee`: a run replaces whole days, once the gates of their table
  have passed on what was written. Keys hold the day or a moment of it, so no other day is read;
* states without a stable day (events, registrations): each run merges into the latest
  version and writes the next one. It counts once its gates have passed;
* people, and their copies by link key: bucketed by a hash of their key, so that a
  delivery rewrites the buckets of its persons alone, and joins on the key find them in place;
* staging and reports: a folder per run, outside the commits. Staging is removed once the run
  has succeeded.
"""

import re
import threading
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lutrin.manifests import VERSION, WHOLE, Manifests
from lutrin.operators.gates import Watch, contract_gates, row_conditions, run_gates
from lutrin.schemas import LINKS, PEOPLE, TABLES, conform, empty_table, spec

DAY = "journee"
BUCKET = "seau"
# Entry of a manifest that holds the number of buckets.
BUCKETS = "#seaux"
# Buckets of a new warehouse, by the session's setting: choose it so that each holds some hundred MB of persons.
BUCKETS_CONF, DEFAULT_BUCKETS = "spark.lutrin.buckets", "32"
# Bucketed tables and their keys.
BUCKETED = {PEOPLE: "usager", **LINKS}


def latest_version(folders):
    """The highest number among the (name, published) folders of a table, or None."""
    numbers = [
        int(name.removeprefix(f"{VERSION}="))
        for name, published in folders
        if published and re.fullmatch(rf"{VERSION}=\d+", name)
    ]
    return max(numbers, default=None)


def bucket_of(column, buckets):
    """The bucket of a key, as Spark's bucketed tables number them."""
    return F.pmod(F.hash(column), F.lit(buckets))


class Warehouse:
    def __init__(self, spark, root, run_id=None, buckets=None):
        self.spark = spark
        self.root = root.rstrip("/")
        now = datetime.now(timezone.utc)
        self.run_id = run_id or f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        self.manifests = Manifests(spark, self.root)
        self._buckets = buckets or int(spark.conf.get(BUCKETS_CONF, DEFAULT_BUCKETS))
        self._open = threading.local()  # what the commit of a thread has written so far

    def path(self, name):
        return f"{self.root}/{name}"

    def staging_path(self, name):
        return f"{self.root}/_staging/{self.run_id}/{name}"

    def reports_path(self):
        """Folder of this run's gate reports. They name people: restrict access to `_reports`."""
        return f"{self.root}/_reports/{self.run_id}"

    # ---- commits

    @contextmanager
    def commit(self):
        """All tables written inside become readable together at the end, or none if it fails."""
        if getattr(self._open, "changes", None) is not None:
            yield  # part of the outer one
            return
        self._open.changes = {}
        try:
            yield
            if self._open.changes:
                self.manifests.publish(self._open.changes)
        finally:
            self._open.changes = None

    def _publish(self, name, changed):
        pending = getattr(self._open, "changes", None)
        if pending is None:
            self.manifests.publish({name: changed})
        else:
            own = {} if WHOLE in changed else pending.get(name, {})
            pending[name] = {**own, **changed}

    def entries(self, name):
        """{partition: version} of a table, with what the open commit of this thread has written."""
        found = self.manifests.entries(name, self.manifests.latest()[1].get(name))
        changed = (getattr(self._open, "changes", None) or {}).get(name)
        if changed is None:
            return found
        if WHOLE in changed or WHOLE in found:
            found = {}
        return {p: v for p, v in {**found, **changed}.items() if v is not None}

    def last_commit(self):
        """The number of the commit that is read now; 0 before the first."""
        return self.manifests.latest()[0]

    def as_of(self, number):
        """This warehouse as an earlier commit left it, for reading, as long as its files are kept."""
        other = Warehouse(self.spark, self.root, self.run_id, self._buckets)
        other.manifests = Manifests(self.spark, self.root, number)
        return other

    def _next(self, name):
        """A version that no folder has yet, published or left by a run that died."""
        folders = [(folder, True) for folder in self.manifests.files.names(self.path(name))]
        return (latest_version(folders) or 0) + 1

    def versions(self, name):
        """(folder name, published) of every version of a table: a listing, no file is opened."""
        used = set(self.entries(name).values())
        names = self.manifests.files.names(self.path(name))
        return [(n, int(n.removeprefix(f"{VERSION}=")) in used) for n in names if re.fullmatch(rf"{VERSION}=\d+", n)]

    # ---- facts

    def _load(self, name, schema, entries):
        paths = [f"{self.path(name)}/{VERSION}={v}" + ("" if p == WHOLE else f"/{p}") for p, v in sorted(entries.items())]
        return self.spark.read.option("basePath", self.path(name)).schema(schema).parquet(*paths)

    def _read(self, name, extra, entries):
        more = T.StructType.fromDDL(extra).fields if extra else []
        if entries:
            found = self._load(name, T.StructType([*spec(name).schema.fields, *more]), entries)
        else:
            found = empty_table(self.spark, name).select(
                "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in more]
            )
        if not more:
            return conform(found, name)
        return found.select(*spec(name).schema.names, *[f.name for f in more])

    def read(self, name, extra=""):
        """A table as in its contract. `extra` adds technical columns that its files hold, as DDL."""
        return self._read(name, extra, self.entries(name))

    def read_days(self, name, days, extra=""):
        """Only some days, a list of dates: no other folder is listed or read."""
        wanted = {f"{DAY}={day}" for day in days}
        return self._read(name, extra, {p: v for p, v in self.entries(name).items() if p in wanted})

    def _write_days(self, name, rows):
        """({partition: version}, results of gates) of days that are written and found right, not published yet."""
        version = self._next(name)
        path = f"{self.path(name)}/{VERSION}={version}"
        watch = Watch(rows, row_conditions(name, rows.columns))
        watch.rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(path)
        written = {folder: version for folder in self.manifests.files.names(path) if folder.startswith(f"{DAY}=")}
        if not written:
            return {}, []
        fresh = self._read(name, "", written)
        fresh.seen = watch.seen()
        return written, run_gates(contract_gates(fresh, name), self.reports_path())

    def write_days(self, name, rows):
        """Replace the days that occur in `rows`, all at once. Large days are split over several files.

        Nothing is published if a key is missing or occurs twice, a text is too long, or a row
        lies in another day than its moment. Returns the results of these gates.
        """
        written, checks = self._write_days(name, rows)
        self._publish(name, written)
        return checks

    def write_day(self, name, rows, day):
        """Replace one day, also by nothing; gates as in `write_days`."""
        written, checks = self._write_days(name, rows.filter(F.col(DAY) == F.lit(str(day)).cast("date")))
        self._publish(name, written or {f"{DAY}={day}": None})
        return checks

    def drop_day(self, name, day):
        self._publish(name, {f"{DAY}={day}": None})

    def overwrite(self, name, rows):
        """Replace a whole table."""
        version = self._next(name)
        rows.write.parquet(f"{self.path(name)}/{VERSION}={version}")
        self._publish(name, {WHOLE: version})

    # ---- staging

    def stage(self, name, rows):
        """Write staging rows once, so that gates and plans do not parse the source again.

        Gates that look at single rows are counted on the way (`seen`).
        """
        path = self.staging_path(name)
        watch = Watch(rows, row_conditions(name, rows.columns) if name in TABLES else {})
        watch.rows.write.mode("overwrite").parquet(path)
        staged = self.spark.read.schema(rows.schema).parquet(path)
        staged.seen = watch.seen()
        return staged

    def clear_staging(self, *names):
        """Remove staging of this run, raw identifiers with it: some tables, or all."""
        for path in [self.staging_path(n) for n in names] or [f"{self.root}/_staging/{self.run_id}"]:
            self.manifests.files.delete(path)

    # ---- states

    def _state(self, name, entries):
        if not entries:
            return empty_table(self.spark, name)
        if name in BUCKETED:
            return self._bucketed(name, entries)
        return conform(self._load(name, spec(name).schema, entries), name)

    def read_state(self, name):
        """A state as the latest commit has it."""
        return self._state(name, self.entries(name))

    def has_state(self, name):
        return bool(self.entries(name))

    def read_pinned(self, name, domain):
        """The state that a domain has used last, or None."""
        pinned = self.manifests.pinned(name, domain)
        return self._state(name, self.manifests.entries(name, max(pinned))) if pinned else None

    def pin(self, name, domain):
        """Note that a domain has used the latest state, and keep that until the next pin."""
        self.manifests.pin(name, domain)

    def write_state(self, name, rows):
        """Write the next version; it is only published if the gates of its table pass."""
        if name in BUCKETED:
            return self.write_buckets(name, rows)
        version = self._next(name)
        path = f"{self.path(name)}/{VERSION}={version}"
        watch = Watch(rows, row_conditions(name, rows.columns))
        watch.rows.write.parquet(path)
        written = self.spark.read.schema(spec(name).schema).parquet(path)
        written.seen = watch.seen()
        checks = run_gates(contract_gates(written, name), self.reports_path())
        self._publish(name, {WHOLE: version})
        return checks

    # ---- bucketed states

    def buckets(self, name):
        """Into how many buckets a table is cut: fixed by its first write."""
        return self.entries(name).get(BUCKETS, self._buckets)

    def _catalog_table(self, name, entries=None):
        """A bucketed table of the session's catalog over the files of `entries`; nothing is read."""
        view = f"lutrin_{name}_{uuid.uuid4().hex[:12]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec(name).schema.fields)
        count = (entries or {}).get(BUCKETS) or self.buckets(name)
        place = self.path(name).replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {view} ({columns}, {VERSION} INT, {BUCKET} INT) USING parquet PARTITIONED BY ({VERSION}, {BUCKET})"
            f" CLUSTERED BY ({BUCKETED[name]}) INTO {count} BUCKETS LOCATION '{place}'"
        )
        parts = [f"PARTITION ({VERSION}={v}, {p})" for p, v in sorted((entries or {}).items()) if p != BUCKETS]
        if parts:
            self.spark.sql(f"ALTER TABLE {view} ADD {' '.join(parts)}")
        return view

    def _bucketed(self, name, entries):
        return conform(self.spark.table(self._catalog_table(name, entries)), name)

    def read_buckets(self, name, numbers):
        """Only some buckets of a state, given by their numbers."""
        wanted = {f"{BUCKET}={n}" for n in numbers} | {BUCKETS}
        entries = {p: v for p, v in self.entries(name).items() if p in wanted}
        return self._bucketed(name, entries) if set(entries) - {BUCKETS} else empty_table(self.spark, name)

    def buckets_of(self, name, keys):
        """Buckets of the keys in the first column of `keys`: as many numbers as buckets at most."""
        number = bucket_of(F.col(keys.columns[0]), self.buckets(name))
        return sorted(r[0] for r in keys.select(number.alias("n")).distinct().collect())

    def write_buckets(self, name, rows, numbers=None):
        """Replace some buckets of a state, or all, by `rows`, which hold all rows of these buckets.

        Gates of the table are run on what was written before it is published: equal keys
        share a bucket, so the other buckets need no look.
        """
        count, version, key = self.buckets(name), self._next(name), BUCKETED[name]
        view = self._catalog_table(name)
        placed = conform(rows, name).repartition(count, key)
        placed = placed.select("*", F.lit(version).alias(VERSION), bucket_of(F.col(key), count).alias(BUCKET))
        watch = Watch(placed, row_conditions(name, spec(name).schema.names))
        watch.rows.sortWithinPartitions(BUCKET, key).write.insertInto(view)
        path = f"{self.path(name)}/{VERSION}={version}"
        written = {folder: version for folder in self.manifests.files.names(path) if folder.startswith(f"{BUCKET}=")}
        fresh = self._bucketed(name, {**written, BUCKETS: count}) if written else empty_table(self.spark, name)
        fresh.seen = watch.seen()
        checks = run_gates(contract_gates(fresh, name), self.reports_path())
        gone = [p for p in self.entries(name) if p != BUCKETS] if numbers is None else [f"{BUCKET}={n}" for n in numbers]
        self._publish(name, {**dict.fromkeys(gone), **written, BUCKETS: count})
        return checks


def days_in(rows, day=DAY):
    """The days that occur in `rows`: a list no longer than the calendar they cover."""
    return [r[0] for r in rows.select(day).distinct().filter(F.col(day).isNotNull()).collect()]
