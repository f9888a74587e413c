"""Contents by hash: fetch once per host's clock, put once per content, verify; and the selection as JSON lines."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.names import host

from .transport import PermanentError, TransientError, Transport

_FETCHED = "doc_id long, ok boolean, kind string, error string, sha256 string, stored_path string, n_bytes long, was_new boolean"


def shard_path(root: str, sha: str, suffix: str = "pdf") -> str:
    return f"{root}/{sha[:2]}/{sha[2:4]}/{sha}.{suffix}"


def put(root: str, body: bytes, suffix: str = "pdf") -> tuple[str, str, bool]:
    """Writes a content under its hash unless it is there; the file appears as a whole or not at all, so a task that runs twice does
    no harm. Returns hash, path, and whether it was new."""
    sha = hashlib.sha256(body).hexdigest()
    path = shard_path(root, sha, suffix)
    if os.path.exists(path):
        return sha, path, False
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(part, "wb") as f:
        f.write(body)
    os.replace(part, path)
    return sha, path, True


def fetch(refs: DataFrame, root: str, partitions: int = 64, **transport) -> DataFrame:
    """Fetches (doc_id, url) and stores the contents; root must be shared by the executors. All rows of a host are in one task, whose
    clock spaces the requests. Contents stay out of the result, which is one row per document: ok, or the kind of failure
    (transient, permanent) and its text cut to 500 characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Transport(**transport)
        for b in batches:
            rows = []
            for i, url in zip(b.column("doc_id").to_pylist(), b.column("url").to_pylist()):
                try:
                    body = own.pdf(url or "")
                    sha, path, new = put(root, body)
                    rows.append((i, True, None, None, sha, path, len(body), new))
                except (TransientError, PermanentError) as e:
                    rows.append((i, False, "transient" if isinstance(e, TransientError) else "permanent", str(e)[:500], None, None, None, None))
            kinds = [pa.int64(), pa.bool_(), *[pa.string()] * 4, pa.int64(), pa.bool_()]
            names = ["doc_id", "ok", "kind", "error", "sha256", "stored_path", "n_bytes", "was_new"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=names)

    keyed = refs.select("doc_id", "url", host(F.lit(None).cast("string"), F.col("url")).alias("host"))
    return keyed.repartition(partitions, "host").mapInArrow(run, _FETCHED)


def verify(spark: SparkSession, root: str, catalogue: DataFrame) -> DataFrame:
    """Per stored document: ok, missing or mismatched, by hashing the files anew. Only hashes are shuffled, never contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.regexp_extract("path", "([^/]+)[.][^./]*$", 1).alias("sha256"), F.sha2("content", 256).alias("found"))
    joined = catalogue.filter("status = 'stored'").select("doc_id", "sha256").join(files.dropDuplicates(["sha256"]), "sha256", "left")
    return joined.select("doc_id", "sha256", F.when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("sha256"), "ok").otherwise("mismatched").alias("state"))


def selection_rows(selection: DataFrame, stem: str = "v2_%05d") -> DataFrame:
    """One row per selected page of (sha256, pages): pages once, in order, with a running stem. The number is the place in the whole
    selection, a hand-made list of bounded size."""
    pages = selection.select("sha256", F.explode(F.array_sort(F.array_distinct("pages"))).alias("page_no"))
    first = pages.groupBy("sha256").agg(F.count("*").alias("n"))
    before = first.withColumn("before", F.expr("coalesce(sum(n) over (order by sha256 rows between unbounded preceding and 1 preceding), 0)"))
    place = F.expr("row_number() over (partition by sha256 order by page_no)")
    return pages.withColumn("k", place).join(before, "sha256").select(F.format_string(stem, (F.col("before") + F.col("k") - 1).cast("int")).alias("stem"), "sha256", "page_no")


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; the folder gets its _SUCCESS mark last, so a reader never takes half a selection for a whole one."""
    df.write.mode("overwrite").json(path)
