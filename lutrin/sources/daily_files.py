"""Directories of daily people files, and their freshness."""

from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.dates import day_in_name
from lutrin.sources.fixed_width import read_staff, read_students


def by_day(rows, start):
    """Rows of files whose name begins with `start` and holds a date, with their day."""
    kept = rows.filter(F.col("fichier").startswith(start))
    return kept.withColumn("journee", day_in_name(F.col("fichier"))).filter(
        F.col("journee").isNotNull()
    )


def read_student_directory(spark, path, files=None):
    """All student files of a directory, or those listed, in one scan, each row with the day of its file."""
    rows = read_students(spark, f"{path}/{V.STUDENT_FILE_START}*" if files is None else files)
    return by_day(rows, V.STUDENT_FILE_START)


def read_staff_directory(spark, path, files=None):
    rows = read_staff(spark, f"{path}/{V.STAFF_FILE_START}*" if files is None else files)
    return by_day(rows, V.STAFF_FILE_START)


def people_files(spark, path):
    """The people files of a directory whose name holds a date: chemin, taille, modifie, journee, genre. A listing alone."""
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.when(name.startswith(V.STUDENT_FILE_START), V.STUDENT_FILE_START).when(
        name.startswith(V.STAFF_FILE_START), V.STAFF_FILE_START
    )
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("chemin"),
        F.col("length").alias("taille"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modifie"),
        day_in_name(name).alias("journee"),
        kind.alias("genre"),
    )
    return files.filter(F.col("journee").isNotNull() & F.col("genre").isNotNull())


def files_to_load(listed, ledger):
    """Files of the days on which a file is new, or has another size or time than when it was loaded."""
    known = ledger.select("chemin", "taille", "modifie")
    fresh = listed.join(known, ["chemin", "taille", "modifie"], "left_anti").select("journee").distinct()
    return listed.join(fresh, "journee", "left_semi")


def unpaired_days(students, staff):
    """Days with student rows but no staff rows."""
    return students.select("journee").distinct().join(
        staff.select("journee").distinct(), "journee", "left_anti"
    )


NO_STAFF, NO_STUDENTS = "sans personnel", "sans étudiants"


def one_sided_days(students, staff):
    """Days that lack one of the two files, and which: (journee, raison)."""
    return (
        unpaired_days(students, staff)
        .withColumn("raison", F.lit(NO_STAFF))
        .union(unpaired_days(staff, students).withColumn("raison", F.lit(NO_STUDENTS)))
    )


def stale_files(spark, paths, expected_day):
    """Files not last changed on the expected day. Only file listings are read."""
    files = (
        spark.read.format("binaryFile")
        .load(list(paths))
        .select("path", F.to_date("modificationTime").alias("jour"))
    )
    return files.filter(F.col("jour") != F.lit(str(expected_day)).cast("date"))
