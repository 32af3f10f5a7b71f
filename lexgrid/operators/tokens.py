"""Tokenisation, vocabulary and encoding.

Two tokenisation routes:

* ``rule_tokens`` — a whitespace rule as one JVM expression (no Python).
* ``tokenise_with`` — any user tokenizer, hosted in an iterator Pandas UDF so it
  is loaded once per task and fed Arrow batches.

``encode`` and ``decode`` look values up without a row per token in any exchange. Rows are dealt into
groups of about ``GROUP_BYTES`` (one exchange, a row per document); each group's distinct values, which a
group has few of, are taken in one Arrow pass and joined with the vocabulary; and the group's rows are translated in another with the
group's own small dictionary. Both passes read all columns of the same exchange, so what comes before it is worked out once. Neither the vocabulary nor a hot token ever has to fit anywhere whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lexgrid.operators.ranking import sorted_positions

# The rule tokenizer's token and separator classes and the reserved ids.
RULE_SEPARATOR_PATTERN = "[ \\n\\t\\r]+"
PAD_ID = 0
UNK_ID = 1
SPECIALS = ("<pad>", "<unk>")

GROUP_BYTES = 16 << 20      # as stored: some times as much in memory
GROUP_ROWS = 10_000
UNKNOWN = 1 << 60           # a size that only a guess gives


def rule_tokens(text: Column | str) -> Column:
    """Q1 (rule route): maximal runs of characters other than space, tab, CR, LF.

    Written as a split on separator runs without the empty edge pieces: the
    same tokens as extracting every run of other characters, but faster.
    """
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(t, RULE_SEPARATOR_PATTERN), lambda x: x != "")


def token_lengths(tokens: Column | str) -> Column:
    """Token -> its length in characters: a stand-in id with an exact SQL twin."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.transform(t, lambda x: F.length(x))


def tokenise_with(df: DataFrame, text: str, make_tokenizer: Callable[[], Callable],
                  out: str = "input_ids") -> DataFrame:
    """Q1 (hosted route): ``make_tokenizer()`` returns ``f(list[str]) -> list[list[int]]``.

    The factory runs once per task (per iterator), not per batch or row.
    """

    @F.pandas_udf(ArrayType(IntegerType()))
    def encode_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = make_tokenizer()
        for s in batches:
            texts = s.fillna("").tolist()
            yield pd.Series([list(map(int, ids)) for ids in fn(texts)])

    return df.withColumn(out, encode_batches(F.col(text)))


def _counted(out):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            found = pc.value_counts(pc.drop_null(b.column(0).flatten()))
            yield pa.RecordBatch.from_arrays([found.field(0).cast(out.types[0]), found.field(1)], schema=out)
    return run


def build_vocab(df: DataFrame, tokens: str, min_count: int = 1,
                specials: tuple[str, ...] = SPECIALS) -> DataFrame:
    """``token, freq, id`` with ids by (freq desc, token), after the specials.

    Batches count their own tokens, and a partial aggregation adds these up; the ids come from an exact sorted
    position (range-partitioned sort + checkpoint), never a one-partition window.
    """
    kind = StructType.fromDDL(f"token {df.schema[tokens].dataType.elementType.simpleString()}, n bigint")
    counts = (df.select(tokens).mapInArrow(_counted(to_arrow_schema(kind)), kind)
              .groupBy("token").agg(F.sum("n").alias("freq"))
              .where(F.col("freq") >= min_count))
    ranked = sorted_positions(counts, [F.col("freq").desc(), F.col("token").asc()], "_pos")
    return ranked.select("token", "freq", (F.col("_pos") - 1 + len(specials)).alias("id"))


def _groups(df: DataFrame) -> int:
    """Groups for about ``GROUP_BYTES`` of the tables that ``df`` reads (or of ``GROUP_ROWS`` rows where their size isn't known),
    and one per shuffle partition at least."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    wanted = -(-size // GROUP_BYTES) if size < UNKNOWN else -(-df.count() // GROUP_ROWS)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def _looked_up(df: DataFrame, values: str, table: DataFrame, out: str, kind: str, finish: Callable) -> DataFrame:
    """``df`` with ``out``: ``finish(list array, its flat values' places in the dictionary, dictionary)``.

    ``table``: ``value, found``, one row per value.
    """
    n = _groups(df)
    dealt = df.withColumn("_group", F.pmod(F.xxhash64(*df.columns), F.lit(n))).repartition(n, "_group")
    page_kind = StructType([*StructType.fromDDL("_page bigint").fields, StructField("value", df.schema[values].dataType.elementType)])
    page_schema = to_arrow_schema(page_kind)

    def distinct_values(key, rows):
        import pyarrow as pa
        import pyarrow.compute as pc
        given = pa.concat_arrays(rows.column(values).chunks)
        own = pc.unique(given.flatten()).cast(page_schema.types[1])
        return pa.table([pa.repeat(key[0].cast(pa.int64()), len(own)), own], schema=page_schema)

    # the whole rows go in, so that the exchange is the one that ``translate`` reads
    own = dealt.groupBy("_group").applyInArrow(distinct_values, page_kind)
    pages = own.join(table, "value").select("_page", "value", "found")
    schema = StructType([*[f for f in df.schema.fields if f.name != out], *StructType.fromDDL(f"`{out}` {kind}").fields])
    target = to_arrow_schema(schema)

    def translate(_, rows, page):
        import pyarrow as pa
        import pyarrow.compute as pc
        given = rows.column(values).combine_chunks()
        given = pa.concat_arrays(given.chunks) if isinstance(given, pa.ChunkedArray) else given
        known = page.column("value").combine_chunks()
        places = pc.index_in(given.flatten(), value_set=known)
        found = finish(given, places, page.column("found").combine_chunks())
        return pa.table([*[rows.column(f.name) for f in schema.fields[:-1]], found.cast(target.types[-1])], schema=target)

    return dealt.groupBy("_group").cogroup(pages.groupBy("_page")).applyInArrow(translate, schema).select(
        *[c for c in df.columns if c != out], out)


def _relisted(given, flat):
    """``flat`` cut as the list array ``given`` is (its nulls too)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.list_value_length(given), 0)
    ends = pc.cumulative_sum(sizes.cast(pa.int32()))
    starts = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(starts, flat, mask=given.is_null())


def encode(df: DataFrame, tokens: str, vocab: DataFrame, key: str, out: str = "ids",
           unk_id: int = UNK_ID) -> DataFrame:
    """Token array -> id array through ``vocab`` (columns ``token``, ``id``).

    A null token array gives a null id array, an empty one an
    empty one; tokens outside the vocabulary (null tokens too) get ``unk_id``. ``key`` stays with its row; it need not be unique.
    """
    def finish(given, places, ids):
        import pyarrow.compute as pc
        return _relisted(given, pc.fill_null(pc.take(ids, places), unk_id))

    table = vocab.select(F.col("token").alias("value"), F.col("id").cast("long").alias("found"))
    return _looked_up(df, tokens, table, out, "array<bigint>", finish)


def decode(df: DataFrame, ids: str, vocab: DataFrame, key: str, out: str = "text",
           special_ids: tuple[int, ...] = (PAD_ID, UNK_ID), sep: str = " ") -> DataFrame:
    """Id array -> text through ``vocab``, the inverse of ``encode``.

    Special ids are skipped, and ids outside the vocabulary too. A null id array gives a null text, one without
    any token the empty text.
    """
    table = vocab.select(F.col("id").cast("long").alias("value"), F.col("token").alias("found")).where(~F.col("id").isin(*special_ids))
    wide = df.withColumn("_wide", F.col(ids).cast("array<bigint>"))

    def finish(given, places, tokens):
        import pyarrow as pa
        import pyarrow.compute as pc
        words = pc.take(tokens, places)
        kept = words.is_valid()
        rows = pc.list_parent_indices(given).filter(kept)
        counts = pc.value_counts(rows)
        sizes = dict(zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist()))
        ends = pc.cumulative_sum(pa.array([sizes.get(i, 0) for i in range(len(given))], pa.int32()))
        lists = pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), words.filter(kept).cast(pa.string()))
        return pc.if_else(given.is_null(), pa.scalar(None, pa.string()), pc.binary_join(lists, sep))

    return _looked_up(wide, "_wide", table, out, "string", finish).select(*[c for c in df.columns if c != out], out)
