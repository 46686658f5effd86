"""Files grouped into jobs that each hold as many files of every slice, and jobs cut into sub-jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def slice_files(files: DataFrame, only: list[str] | None = None) -> DataFrame:
    """(slice, path, tree): a path once for each slice, with the tree given last (by `at`, if there); slices whose name contains one of `only`."""
    if only:
        files = files.where(F.exists(F.array(*map(F.lit, only)), lambda s: F.col("slice").contains(s)))
    last = F.max_by("tree", "at") if "at" in files.columns else F.max("tree")
    return files.groupBy("slice", "path").agg(last.alias("tree"))


def slice_balanced_jobs(files: DataFrame, per_slice: int = 5, prefix: str = "job") -> DataFrame:
    """files (slice, path, tree) with nth (from 1 within the slice, by path), job_number and job; null for the files left over.

    Job k takes the k-th per_slice files of every slice; there are as many jobs as the
    smallest slice can fill.
    """
    if per_slice < 1:
        raise ValueError("per_slice must be 1 or more")
    jobs = files.groupBy("slice").count().agg(F.min(F.floor(F.col("count") / per_slice)).alias("_jobs"))  # one row
    number = F.floor((F.col("nth") - 1) / per_slice) + 1
    out = files.withColumn("nth", F.row_number().over(Window.partitionBy("slice").orderBy("path"))).join(F.broadcast(jobs))
    out = out.withColumn("job_number", F.when(number <= F.col("_jobs"), number).cast("long")).drop("_jobs")
    return out.withColumn("job", F.when(F.col("job_number").isNotNull(), F.concat(F.lit(f"{prefix}_"), F.col("job_number"))))


def job_files(assigned: DataFrame) -> DataFrame:
    """(job, path, tree): the files of each job, a path once."""
    return assigned.where(F.col("job").isNotNull()).groupBy("job", "path").agg(F.max_by("tree", "slice").alias("tree"))


def leftovers(assigned: DataFrame) -> DataFrame:
    return assigned.where(F.col("job").isNull()).groupBy("path").agg(F.max_by("tree", "slice").alias("tree"))


def sub_jobs(files: DataFrame, size: int, order: str = "path") -> DataFrame:
    """files (job, ...) with sub_job from 0, `size` files each; the group `unused` is left out."""
    nth = F.row_number().over(Window.partitionBy("job").orderBy(order))
    return files.where(F.col("job") != "unused").withColumn("sub_job", F.floor((nth - 1) / size).cast("long"))


def split_jobs(cut: DataFrame) -> DataFrame:
    """Jobs of more than one sub-job: their libraries would be split."""
    return cut.groupBy("job").agg(F.countDistinct("sub_job").alias("sub_jobs"), F.count(F.lit(1)).alias("files")).where("sub_jobs > 1")
