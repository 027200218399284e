"""Shuffle files that nothing will read again are deleted at once, not when the driver collects garbage."""

import os
import time

from parchment.llm.common import FREE_SHUFFLES, table
from parchment.llm.suffix_dedup import deduplicated


def shuffle_bytes(spark):
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return sum(os.path.getsize(os.path.join(at, f)) for d in dirs for at, _, files in os.walk(d) for f in files if f.startswith("shuffle_"))


def test_anchors_leave_no_shuffle_files(spark):
    docs, setting = table(spark, "/root/testdata/sf0.01", "documents"), spark.conf.get(FREE_SHUFFLES, None)
    n_bytes = docs.selectExpr("sum(octet_length(text))").first()[0]
    before = shuffle_bytes(spark)
    left = deduplicated(docs)  # anchors are sorted and written
    end = time.time() + 20
    while shuffle_bytes(spark) - before > n_bytes / 10 and time.time() < end:  # they go in the background
        time.sleep(0.2)
    assert shuffle_bytes(spark) - before <= n_bytes / 10
    assert spark.conf.get(FREE_SHUFFLES, None) == setting
    assert left.count() == docs.count()
