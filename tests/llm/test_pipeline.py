import gc
import platform
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lensgraph.llm import decontaminate, mixing, session
from tests.llm import brute
from tests.llm.conftest import make

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = docs.count()
    seen = [first]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / name)
        result = stage(spark, docs, SMALL)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns
        result.write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        seen.append(docs.count())
        if name == "minhash_near_dedup":
            rows = [(r[0], r[1]) for r in before.select("doc_id", "text").collect()]
            assert {r[0] for r in docs.select("doc_id").collect()} == {c for _, c in brute.components(rows).values()}
        if name == "benchmark_decontamination":
            bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            assert decontaminate.contamination(docs, bench).where("contaminated").count() == 0
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * first
    assert docs.columns == [*before.columns, "size", "source_size", "target", "taken"] and seen[-1] == seen[-2]
    mixed = {tuple(r) for r in mixing.mix(before).collect()}
    assert mixed == {tuple(r) for r in docs.select("doc_id", "size", "source_size", "target", "taken").collect()}
    assert {(r[0], r[1]) for r in before.select("doc_id", "text").collect()} == {(r[0], r[1]) for r in docs.select("doc_id", "text").collect()}


def test_stages_on_odd_rows(spark, odd_rows):
    """Nulls in every column, empty and long texts, repeated rows, ties, clashing names, and an empty table."""
    clash = {"row": 1, "id": 2, "gone": 3, "th": 4, "bad": 5, "__row": 6, "__id": 7, "taken2": 8, "place": 9, "nth": 10, "share": 11}
    docs = make(spark, [*odd_rows, odd_rows[3], (None, None, None, None)], extra=False)
    docs = docs.select("*", *(F.lit(v).alias(k) for k, v in clash.items()))
    full = spark.createDataFrame([], docs.schema).union(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, full, SMALL)
        last = name == corpus_pipeline.STAGES[-1][0]
        assert out.columns[: len(docs.columns)] == docs.columns and (last or len(out.columns) == len(docs.columns))
        rows = out.collect()
        assert (len(rows) == full.count() if last else 0 < len(rows) <= full.count()) and all(r[k] == v for r in rows for k, v in clash.items())
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).where("taken > 0").count() > 50


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="freed memory is kept by glibc")
def test_release_gives_freed_memory_of_the_driver_back(spark):
    jvm = spark.sparkContext._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()
    held = lambda: sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text()))) // 1024
    buffers = [jvm.java.nio.ByteBuffer.allocateDirect(1 << 16) for _ in range(3000)]
    kept = buffers[::64]  # what lies between them can not be given back by itself
    del buffers
    for _ in range(3):
        gc.collect()
        jvm.System.gc()
        time.sleep(0.5)
    before = held()
    session.release(spark)
    assert before - held() > 100
    assert len(kept) == 47
