"""Shared pieces of the training-data operators: table access, written
intermediates and vectorised word hashing.

``hash_words`` turns UTF-8 bytes into one 64-bit hash per word with a handful
of numpy passes; shingles are mixes of consecutive word hashes. Separators are
ASCII bytes, so no multi-byte character is ever cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lexgrid.session import scratch_path

CHUNK = 1 << 18
SLICE = 256
_RNG = np.random.default_rng(20240607)
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]          # A-Z count as a-z
_CASED = _VALUE.copy()
_CASED[65:91] = _RNG.integers(1, 2**63, 26, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NON_WORD = np.ones(256, bool)           # ASCII letters, digits and all non-ASCII bytes are word bytes
NON_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, spent: list[str] | None = None, batch: int | None = None) -> DataFrame:
    """Cut the lineage of ``df`` with a Parquet table in the shared checkpoint folder; its path is added to ``spent``."""
    path = scratch_path(df.sparkSession, name)
    if spent is not None:
        spent.append(path)
    write(df, path, batch=batch)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write(df: DataFrame, path: str, *by: str, batch: int | None = None) -> None:
    """Write ``df`` as Parquet, a folder for each value of ``by``. Its shuffle files go when the write ends, not when the driver
    happens to collect its garbage. ``batch``: rows of an Arrow batch, for wide rows."""
    conf = df.sparkSession.conf
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch is not None:
        wanted["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch)
    before = {k: conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            conf.set(k, v)
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def remove(spark: SparkSession, spent: list[str]) -> None:
    """Delete tables of ``written`` that nothing reads any more: what was made from them is written itself."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while spent:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spent.pop())
        path.getFileSystem(hadoop).delete(path, True)


# integers stay integers beside nulls (``pd.NA``): a float would change those above 2**53
_EXACT = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}


def map_slices(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | StructType,
               rows: int = SLICE) -> DataFrame:
    """``mapInPandas`` that turns ``rows`` rows of an Arrow batch into Python objects at a time, so
    that a worker holds one batch in Arrow's form and a slice of it in Python's. Null integers arrive as ``pd.NA``."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (b.slice(at, rows).to_pandas(types_mapper=_EXACT.get) for b in batches for at in range(0, b.num_rows, rows))
        for frame in fn(slices):
            yield pa.RecordBatch.from_pandas(frame, schema=out, preserve_index=False)

    return df.mapInArrow(run, kind)


def keep_where(df: DataFrame, text: str, keep: Callable[[list[str | None]], np.ndarray]) -> DataFrame:
    """The rows whose texts ``keep`` wants; all columns pass through as they are."""
    def run(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            mask = np.concatenate([keep(texts.slice(at, SLICE).to_pylist()) for at in range(0, b.num_rows, SLICE)]) if b.num_rows else np.zeros(0, bool)
            yield b.filter(pa.array(mask))

    return map_batches(df, run, df.schema)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch], pa.Schema], Iterator[pa.RecordBatch]],
                schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose function is also given the Arrow schema of its output."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(kind)
    return df.mapInArrow(lambda batches: fn(batches, out), kind)


FILTER_BITS = 1 << 26
PAGE_BITS = 8 * 4096        # fixed value: bits of one bitmap of bitmap_construct_agg
WORD_BITS = 64


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return next(name for name in (stem + "_" * i for i in range(len(taken) + 1)) if name.lower() not in taken)


def _with_hit(df: DataFrame, column: str, keys: DataFrame, key: str, hit: str) -> DataFrame:
    """Add ``hit``: true where ``column`` may be in ``keys``; where it is false or null, it is not.

    A one-hash filter of ``FILTER_BITS`` bits: 2048 bitmaps of 4 kB at most, so its
    8 MB may be broadcast whatever the size of ``keys``. Keys always hit; the more
    there are, the more others hit too.
    """
    page, bits, at = (fresh(df, stem) for stem in ("_filter_page", "_filter_bits", "_filter_at"))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    slots = keys.select(slot(F.col(key)).alias("slot"))
    pages = slots.groupBy(F.bitmap_bucket_number("slot").alias(page)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias(bits))
    # pages as arrays of words: a row reads one word where it lies; of a binary value each row would get a copy of the page
    word = lambda i: F.conv(F.hex(F.substr(F.col(bits), i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    pages = pages.select(page, F.transform(F.sequence(F.lit(0), F.lit(PAGE_BITS // WORD_BITS - 1)), word).alias(bits))
    own = F.get(F.col(bits), F.shiftright(F.col(at), 6).cast("int"))
    bit = F.col(at).bitwiseAND(WORD_BITS - 1).bitwiseXOR(56).cast("int")     # the first of a word's bytes is its highest
    return (df.withColumn(page, F.bitmap_bucket_number(slot(F.col(column)))).join(F.broadcast(pages), page, "left")
            .withColumn(at, F.bitmap_bit_position(slot(F.col(column))))
            .withColumn(hit, F.getbit(own, bit) == 1).drop(page, bits, at))


def maybe_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """``df`` without most of the rows whose ``column`` is in no row of ``keys``, for use before a join on it."""
    hit = fresh(df, "_filter_hit")
    return _with_hit(df, column, keys, key, hit).where(F.col(hit)).drop(hit)


def without_keys(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``column`` is in ``keys``; only rows that the filter can't clear are
    shuffled for the anti-join. Rows with a null ``column`` stay."""
    hit, name = fresh(df, "_filter_hit"), fresh(df, "_filter_key")
    marked = _with_hit(df, column, keys, key, hit)
    clear = marked.where(~F.coalesce(F.col(hit), F.lit(False))).drop(hit)
    named = keys.select(F.col(key).alias(name)).distinct()
    return clear.unionByName(marked.where(F.col(hit)).drop(hit).join(named, F.col(column) == F.col(name), "left_anti")).select(*df.columns)


def named_once(df: DataFrame, name: str, special: DataFrame) -> DataFrame:
    """``df`` without the rows whose ``name`` has ``stays`` false in ``special`` (``name, stays``, a row per name), and
    with one row of each name for which it is true. Rows whose name is not in it stay where they are."""
    hit, again, verdict = fresh(df, "_filter_hit"), fresh(df, "_row_again"), fresh(df, "_row_stays")
    marked = _with_hit(df, name, special, "name", hit)
    clear = marked.where(~F.coalesce(F.col(hit), F.lit(False))).drop(hit)
    known = special.select(F.col("name").alias(again), F.col("stays").alias(verdict))
    met = marked.where(F.col(hit)).drop(hit).join(known, F.col(name) == F.col(again), "left").drop(again)
    return clear.unionByName(met.where(F.col(verdict).isNull()).drop(verdict)).unionByName(
        met.where(F.col(verdict)).drop(verdict).dropDuplicates([name])).select(*df.columns)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (bijective on 64 bits)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 4096)
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE)], dtype=np.uint64)
    return _powers


def _hash_span(buf: np.ndarray, sep: np.ndarray, cased: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gap = sep[buf]
    edge = np.flatnonzero(np.diff(np.r_[True, gap, True]))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    # places inside words: gaps get weight zero, so a segment may run to the next start
    place = np.arange(len(buf)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(buf)]))
    value = (_CASED if cased else _VALUE)[buf]
    value[gap] = 0
    value *= _power(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64)), starts, ends


def hash_words(text: bytes, sep: np.ndarray = WHITE, cased: bool = False
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of one text, in order.

    A text over ``CHUNK`` bytes is worked through in pieces cut at separators,
    so memory stays bounded by the piece (or by the longest word).
    """
    buf = np.frombuffer(text, np.uint8)
    if len(buf) <= CHUNK:
        return _hash_span(buf, sep, cased)
    parts, at = [], 0
    while at < len(buf):
        end = min(at + CHUNK, len(buf))
        while end < len(buf) and not sep[buf[end - 1]]:
            ahead = np.flatnonzero(sep[buf[end:end + CHUNK]])
            end = end + int(ahead[0]) + 1 if len(ahead) else min(end + CHUNK, len(buf))
        h, s, e = _hash_span(buf[at:end], sep, cased)
        parts.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))


def hash_many(texts: Sequence[str | None], sep: np.ndarray = WHITE, cased: bool = False
              ) -> Iterator[np.ndarray]:
    """Word hashes of each text; short texts share numpy calls."""
    group: list[bytes] = []
    size = 0
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if group and size + len(raw) > CHUNK:
            yield from _hash_group(group, sep, cased)
            group, size = [], 0
        group.append(raw)
        size += len(raw) + 1
    if group:
        yield from _hash_group(group, sep, cased)


def _hash_group(group: list[bytes], sep: np.ndarray, cased: bool) -> Iterator[np.ndarray]:
    if len(group) == 1:
        yield hash_words(group[0], sep, cased)[0]
        return
    h, s, _ = _hash_span(np.frombuffer(b"\n".join(group), np.uint8), sep, cased)
    cuts = np.searchsorted(s, np.cumsum([len(g) + 1 for g in group]))
    at = 0
    for cut in cuts:
        yield h[at:cut]
        at = cut


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, in order; a shorter text is one shingle
    of all its words; no words give none."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    total = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        total += words[i:n - width + 1 + i] * _SHINGLE[i]
    return mix(total)
