"""Helpers shared by the operators: session settings, shared storage, words, keys, connected components.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z, in Spark SQL and in Arrow alike.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch.  Texts may be long, so a batch stays a few MB on average.
BATCH_ROWS = 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the user's setting grows with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where it is unset (one machine)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named


_LIBC = ctypes.CDLL(None)


def free_memory() -> None:
    """Give back what a worker's allocators keep: workers stay for later tasks, several of them on an executor."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def tidy(work):
    """A function of a group, or of two groups, that leaves no memory behind."""

    def freed(out: pa.Table) -> pa.Table:
        free_memory()
        return out

    def one(t: pa.Table) -> pa.Table:
        return freed(work(t))

    def two(a: pa.Table, b: pa.Table) -> pa.Table:
        return freed(work(a, b))

    return one if work.__code__.co_argcount == 1 else two


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes in a piece; a longer text is a piece by itself."""
    for b in batches:
        if not b.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(b[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < b.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield b.slice(start, stop - start)
            start = stop
        free_memory()


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def widened(df: DataFrame, more: str) -> StructType:
    """The frame's schema and more columns, for a map over its rows."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod)).cast("int")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


# ---------------------------------------------------------------- words in Arrow


def split_words(texts) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word number of every token, offsets per text, distinct words).  Null texts have no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    keep = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not keep.all():
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        flat = flat.filter(pa.array(keep))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, coded.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash for each distinct word, the same in every process."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Key of a sequence from the key of all but its last word and the last word's hash."""
    return scramble(left * np.uint64(0x9E3779B97F4A7C15) + right)


def owner_of(offsets: np.ndarray) -> np.ndarray:
    """Which text each token belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingle_keys(texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, key) of the distinct ``width``-word shingles, sorted by both.

    A text of fewer words gives its whole sequence as one shingle; a text without words gives none.
    """
    codes, offsets, words = split_words(texts)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = word_hashes(words)[codes]
    lens = np.diff(offsets)
    docs, keys = [], []
    n = len(h) - width + 1
    if n > 0:
        k = scramble(h[:n])
        for i in range(1, width):
            k = chain(k, h[i : n + i])
        who = owner_of(offsets)
        whole = who[:n] == who[width - 1 :]
        docs.append(who[:n][whole])
        keys.append(k[whole])
    for i in np.nonzero((lens > 0) & (lens < width))[0]:
        k = scramble(h[offsets[i] : offsets[i] + 1])
        for j in range(1, lens[i]):
            k = chain(k, h[offsets[i] + j : offsets[i] + j + 1])
        docs.append(np.array([i]))
        keys.append(scramble(k + np.uint64(lens[i])))
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[first], key[first]


# ---------------------------------------------------------------- packed columns of numbers


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys byte plane by byte plane: the high planes hardly change, so the shuffle's codec shrinks them."""
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte each; counts of 255 and more follow as (place, count)."""
    big = np.nonzero(counts >= 255)[0]
    head = np.array([len(counts)], np.int64).tobytes()
    return head + np.minimum(counts, 255).astype(np.uint8).tobytes() + big.astype(np.int64).tobytes() + counts[big].astype(np.int64).tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    out = np.frombuffer(blob, np.uint8, n, 8).astype(np.int64)
    rest = np.frombuffer(blob[8 + n :], np.int64)
    out[rest[: len(rest) // 2]] = rest[len(rest) // 2 :]
    return out


# ---------------------------------------------------------------- calibration


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Logistic regression of one score by Newton's method; the targets are smoothed, so separable data stay finite."""
    up, down = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        g = np.array([((t - p) * x).sum(), (t - p).sum()])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-6, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


# ---------------------------------------------------------------- corpus-wide counts, block by block


BOXES = "block int, box binary"


def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch that go to one block as one compressed box; texts cross the shuffle at half their size."""
    press = zstandard.ZstdCompressor()
    for b in batches:
        blocks = b["block"].to_numpy()
        by = np.argsort(blocks, kind="stable")
        rows = b.select([c for c in b.schema.names if c != "block"]).take(pa.array(by))
        cuts = np.nonzero(np.concatenate([[True], np.diff(blocks[by]) != 0]))[0].tolist() if len(by) else []
        boxes = []
        for i, j in zip(cuts, [*cuts[1:], len(by)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as w:
                w.write_batch(rows.slice(i, j - i))
            boxes.append(press.compress(sink.getvalue().to_pybytes()))
        yield pa.RecordBatch.from_arrays([pa.array(blocks[by][cuts], pa.int32()), pa.array(boxes, pa.binary())], ["block", "box"])


def unboxed(t: pa.Table) -> pa.Table:
    """All rows of the boxes of a block."""
    press = zstandard.ZstdDecompressor()
    return pa.concat_tables([pa.ipc.open_stream(press.decompress(b)).read_all() for b in t["box"].to_pylist()])


def shard_bounds(shards: int) -> np.ndarray:
    """First key of each of the equal key ranges but the first."""
    return np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)


def ask_rows(block: int, keys: np.ndarray, counts: np.ndarray, shards: int) -> pa.Table:
    """What a block has counted, one row for each key range."""
    cuts = np.concatenate([[0], np.searchsorted(keys, shard_bounds(shards)), [len(keys)]])
    rows = [(s, a, b) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    return pa.table({
        "shard": pa.array([s for s, _, _ in rows], pa.int32()),
        "block": pa.array([block] * len(rows), pa.int32()),
        "keys": pa.array([pack_keys(keys[a:b]) for _, a, b in rows], pa.binary()),
        "counts": pa.array([pack_counts(counts[a:b]) for _, a, b in rows], pa.binary()),
    })


ASK = "shard int, block int, keys binary, counts binary"


def tally(t: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sum one key range over all blocks: (blocks, their keys, distinct keys, sums, each block's places in them)."""
    blocks = t["block"].to_pylist()
    keys = [unpack_keys(b) for b in t["keys"].to_pylist()]
    counts = [unpack_counts(b) for b in t["counts"].to_pylist()]
    every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    distinct, place = np.unique(every, return_inverse=True)
    sums = np.bincount(place, np.concatenate(counts) if counts else None, len(distinct)).astype(np.int64)
    return blocks, keys, distinct, sums, np.split(place, np.cumsum([len(k) for k in keys])[:-1])


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Large-star and small-star rounds: every node that links to several others re-links them to the smallest.  Each is
    an aggregation (a hot node is one row per task) and an equi-join (split by the adaptive skew join).  Nothing is
    collected; each round is written to the shared folder.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        e = both.where("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        e = stored(e)
        low = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        pulled = e.join(low, F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(pulled.union(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())
