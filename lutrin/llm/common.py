"""Written intermediate tables and connected components."""

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import functions as F

import lutrin


def ship_code(spark):
    """Send this package to the Python workers, once for a context."""
    context = spark.sparkContext
    if getattr(context, "_lutrin_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(lutrin.__file__))
    place = os.path.join(tempfile.mkdtemp(prefix="lutrin-"), "lutrin_code.zip")  # read by this driver alone
    with zipfile.ZipFile(place, "w") as bundle:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.join("lutrin", os.path.relpath(path, top)))
    context.addPyFile(place)
    context._lutrin_shipped = True


def own_folder(spark):
    """A folder for sessions that name none."""
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="lutrin-scratch-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


_local = []


class Scratch:
    """Parquet tables in the folder that driver and executors share.

    The folder is the one in `spark.checkpoint.dir`. Where that is unset it is one below the
    warehouse, or in a local session, where all tasks run in this process, a temporary one
    that goes with the process. Tables replace checkpoints: they cut lineage, survive lost
    executors, and are columnar. A result may still read them, so they stay until
    `clear_scratch`; tables that are superseded are dropped at once.
    """

    def __init__(self, spark, name):
        root = spark.conf.get("spark.checkpoint.dir", None) or own_folder(spark)
        self.spark = spark
        self.root = f"{root.rstrip('/')}/lutrin-{spark.sparkContext.applicationId}"
        self.path = f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
        self.tables = 0
        ship_code(spark)

    def save(self, df, name, **options):
        """Write `df` and read it back."""
        self.tables += 1
        path = f"{self.path}/{self.tables:03d}-{name}"
        df.write.options(**options).parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved.scratch_path = path
        return saved

    def drop(self, *saved):
        for df in saved:
            delete(self.spark, df.scratch_path)


def delete(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark):
    """Remove all intermediate tables of this application, once its results are written."""
    delete(spark, Scratch(spark, "none").root)


def is_empty(df):
    return not df.take(1)


def components(scratch, edges, a="a", b="b"):
    """Connected components of an undirected graph: (node, component) for every node with an edge.

    Each round hooks every node to its smallest neighbour, follows these pointers to their
    roots by doubling, and keeps only the edges between different roots, so the number of
    nodes at least halves. Everything stays in DataFrames; each step is written.
    """
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = scratch.save(both.union(both.select("b", "a")).distinct(), "edges")
    labels = None
    while not is_empty(both):
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        parents = scratch.save(parents.select("node", F.least("node", "least").alias("parent")), "parents")
        while True:
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
            jumped = parents.join(up, "parent").select("node", F.col("up").alias("parent"), (F.col("up") != F.col("parent")).alias("moved"))
            jumped = scratch.save(jumped, "jumped")
            moved = not is_empty(jumped.where("moved"))
            scratch.drop(parents)
            parents = jumped
            if not moved:
                break
        parents = parents.select("node", "parent")
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            root = parents.select(F.col("node").alias("component"), "parent")
            labels = labels.join(root, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        labels = scratch.save(labels, "labels")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        rest = both.join(left, "a").join(right, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b").distinct()
        rest = scratch.save(rest, "edges")
        scratch.drop(both, jumped)
        both = rest
    if labels is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
