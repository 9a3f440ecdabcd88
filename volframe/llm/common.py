"""What the corpus operators share: staged tables, word hashes and rolling hashes of bytes."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that every operator here means: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset (tests).

    A temporary folder is one machine's own, so it is only for a local master; elsewhere the setting must be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if app not in _own_dir:
            _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        base = _own_dir[app]
    return f"{base.rstrip('/')}/volframe-{app}"


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df as a table in the shared folder and read it again: later work no longer depends on any executor."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_stages(spark: SparkSession) -> None:
    """Delete the staged tables of this application; frames that still read them fail afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(name: str = "doc_id") -> Column:
    """Rows never used for learning: crc32 of the id as text is divisible by five. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def release_memory() -> None:
    """Give what Arrow and the C library hold unused back to the system: Python workers live on and serve later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # there is no malloc_trim outside glibc
        ctypes.CDLL(None).malloc_trim(0)


def first_by_hash(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most `rows` rows, the first by a hash of `by`, however the rows are dealt.

    Rows whose hash can't be among the first are filtered out where they are, so that one task sorts little more than it
    keeps. Of a small table nothing is filtered out.
    """
    n, of = df.count(), F.xxhash64(*by)
    share = (1.25 * rows + 200) / max(n, 1)
    near = df if share >= 1 else df.where(F.pmod(of, F.lit(1 << 40)) < int(share * (1 << 40)))
    return near.orderBy(F.pmod(of, F.lit(1 << 40)), *by).limit(rows)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered; forgets all at a fixed size so that memory stays bounded."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any byte range of a buffer after one pass: sums of byte values times powers of an odd base, modulo 2^64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(2**40, 2**62)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(n, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:n], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the ranges [start, end) of the buffer that sums() was given."""
        return (sums[end] - sums[start]) * self.down[start]
