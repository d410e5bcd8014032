"""Runs over many samples: each is built once, and one that fails doesn't stop the others."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("transpark")


def built_once(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``: read if a run before finished it, else built and written there."""
    if not _finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a writer committed a table there, in whatever store the path names."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _tag(sample: str) -> str:
    return "sample-" + re.sub(r"[^A-Za-z0-9_.-]", "_", sample)


def _first_cause(error: Exception) -> str:
    """A line on what went wrong first."""
    cause = getattr(error, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    text = f"{type(error).__name__}: {error}" if cause is None else cause.toString()
    return text.splitlines()[0][:500]


def cancel_sample(spark: SparkSession, sample: str) -> None:
    """End the jobs of one sample that ``run_samples`` is building; its row tells that."""
    spark.sparkContext.cancelJobsWithTag(_tag(sample))


def run_samples(spark: SparkSession, samples: Iterable[str], build: Callable[[str], DataFrame], out: str, at_once: int = 4) -> DataFrame:
    """(sample, error): one row per sample, error null where its table is at out/sample=<name>.

    ``at_once`` samples are built side by side, so a slow one doesn't hold up the others; each one's
    jobs have a tag, by which ``cancel_sample`` ends them, and a scheduler pool of its own where the
    session's scheduler is fair. Finished samples aren't built again, so a run that was cut off goes on
    where it stopped. What fails for one sample is logged and told in its row. Samples are names of
    runs, as many as a driver can loop over; the rows of each are distributed.
    """
    sc = spark.sparkContext

    def one(sample: str) -> tuple[str, str | None]:
        sc.addJobTag(_tag(sample))
        sc.setLocalProperty("spark.scheduler.pool", _tag(sample))
        try:
            built_once(spark, f"{out}/sample={sample}", lambda: build(sample))
            log.info("%s: done", sample)
            return sample, None
        except (PySparkException, Py4JError, OSError, ValueError, KeyError) as error:
            log.warning("%s: %s", sample, error)
            return sample, _first_cause(error)
        finally:
            sc.removeJobTag(_tag(sample))
            sc.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # Wrapped for each sample: threads of one wrapper share their properties, and so their tags.
        running = [pool.submit(inheritable_thread_target(one), sample) for sample in dict.fromkeys(samples)]
    told = [r.result() for r in running]
    return spark.createDataFrame(told, "sample string, error string")
