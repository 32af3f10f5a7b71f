"""Best-fit packing by sums of squares.

Every piece goes into the open sequence for which the sum of the squared counts
of open sequences per residual gap becomes smallest: the counts stay even, so
every later length finds a gap. Long pieces are placed first, and a new
sequence is opened only where no open one has room.

Pieces of one length are alike, so the rule needs their histogram only (``window``
numbers at most, whatever the input), and all that counts of a length is how many of its pieces go into each gap. The driver
works that out for one piece at a time, or for many at once with the same numbers (``_flows``). The plan is a table
of rank intervals per length, and every piece finds its place by its rank in its length, in one Arrow pass.

1. One Arrow pass tokenises each text. Documents over ``window`` ids are cut into
   whole windows after a first, shorter piece; whole windows are sequences of
   their own. What is shorter is numbered in its partition and length.
2. Counts per partition and length give each piece its rank.
3. The plan turns (length, rank) into (sequence, offset).

Defined cases: a null or empty text is the end token alone; repeated rows are
packed once each; keys, nulls too, are carried through untouched; an empty table gives
no rows; only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from lexgrid.llm.common import SLICE, written
from lexgrid.llm.packing import _encoder

WINDOW = 1024
END_ID = 2
DECISIONS = 256             # pieces of a length that are decided one at a time

_CUT = "doc_tokens bigint, part int, first_full bigint, tail int, place bigint, crcs array<bigint>"


def _typed(keys: list[StructField], ddl: str) -> StructType:
    return StructType([*keys, *StructType.fromDDL(ddl).fields])


NEVER = np.iinfo(np.int64).min


def _gains(counts: np.ndarray, size: int) -> np.ndarray:
    """By gap, from ``size`` on: 2 more than the sum of squares falls by when a piece of ``size`` goes there (``NEVER``
    where no sequence is open)."""
    gains = 2 * (counts[size:] - counts[:len(counts) - size])
    gains[0] = 2 * counts[size] + 1                             # a full sequence is no open one
    gains[counts[size:] == 0] = NEVER
    return gains


def _settled(counts: np.ndarray, size: int, level: int, most: int) -> np.ndarray | None:
    """Pieces per gap until no gain is ``level`` or more; None if that takes more than ``most``. ``counts`` is changed."""
    flows = np.zeros(len(counts) - size, np.int64)
    while True:
        gains = np.maximum(_gains(counts, size), level - 8)
        many = np.maximum((gains - level) // 4 + 1, 0)          # a piece takes 4 off the gain of its gap,
        many[0] = max((gains[0] - level) // 2 + 1, 0)           # 2 off that of the last one before a full sequence
        many = np.minimum(many, counts[size:])
        if not many.any():
            return flows
        flows += many
        if flows.sum() > most:
            return None
        counts[size:] -= many
        counts[:len(many)] += many
        counts[0] = 0


def _flows(counts: np.ndarray, size: int, pieces: int, single: int) -> tuple[np.ndarray, int]:
    """How many of ``pieces`` pieces of ``size`` go into each gap from ``size`` on, and how many are left when no sequence has room.

    One at a time, a piece goes where the gain is largest (the smallest gap of these). A piece lowers the gain of its
    gap and raises those of the gaps ``size`` above and below, and closes no gap but its own: a choice that is open at some level
    stays open until it is taken. So gaps whose gain is that level or more take pieces until none is, in whichever order: the counts
    come out alike (such systems are abelian, like sandpiles). Whole levels are settled at once as long as the pieces last,
    and what remains of the last level goes one at a time.
    """
    counts, flows, left = counts.copy(), np.zeros(len(counts) - size, np.int64), pieces
    while left > single:
        top = int(_gains(counts, size).max(initial=NEVER))
        if top == NEVER:
            return flows, left
        # the lowest level that the pieces reach, tried from steps that double
        step, done = 1, None
        while done is None or done[0][size:].any():
            trial = counts.copy()
            found = _settled(trial, size, top - step + 1, left)
            if found is None:
                break
            done = trial, found
            step *= 2
        if done is None:
            break
        counts = done[0]
        flows += done[1]
        left -= int(done[1].sum())
    while left:
        gains = _gains(counts, size)
        at = int(gains.argmax()) if len(gains) else 0
        if not len(gains) or gains[at] == NEVER:
            break
        counts[size + at] -= 1
        counts[at] += at > 0
        flows[at] += 1
        left -= 1
    return flows, left


def sum_of_squares(histogram: dict[int, int], window: int = WINDOW, decisions: int = DECISIONS) -> np.ndarray:
    """The plan: rows ``size, lo, hi, sequence, offset``, sorted by size and lo.

    Pieces of ``size`` with rank ``lo <= r < hi`` go to sequence ``sequence + r - lo`` at ``offset``. ``decisions``
    (pieces of a length that are decided one at a time) does not change the plan.
    """
    counts = np.zeros(window, np.int64)                         # open sequences by residual gap
    runs: list[list[list[int]]] = [[] for _ in range(window + 1)]       # by gap: runs [first sequence, how many]
    rows: list[list[int]] = []
    fresh = 0

    def move(size: int, rank: int, gap: int, n: int) -> None:
        """The next ``n`` pieces of ``size``, from ``rank`` on, into sequences with ``gap``."""
        while n:
            run = runs[gap][-1]
            k = min(n, run[1])
            at = run[0] + run[1] - k
            rows.append([size, rank, rank + k, at, window - gap])
            run[1] -= k
            if not run[1]:
                runs[gap].pop()
            into = runs[gap - size]
            if gap > size:
                if into and into[-1][0] + into[-1][1] == at:
                    into[-1][1] += k
                elif into and at + k == into[-1][0]:
                    into[-1][0], into[-1][1] = at, into[-1][1] + k
                else:
                    into.append([at, k])
            rank, n = rank + k, n - k

    for size in sorted((s for s, n in histogram.items() if n > 0), reverse=True):
        flows, left = _flows(counts, size, int(histogram[size]), decisions)
        rank = 0
        for at in np.flatnonzero(flows)[::-1].tolist():         # wide gaps first: they fill narrower ones
            move(size, rank, size + at, int(flows[at]))
            rank += int(flows[at])
        counts[size:] -= flows
        counts[:len(flows)] += flows
        counts[0] = 0
        # no sequence has room: new ones are filled one after the other
        each = window // size
        full, rest = divmod(left, each)
        for n, many in ((full, each), (1 if rest else 0, rest)):
            if n:
                runs[window].append([fresh, n])
                fresh += n
                for i in range(many):
                    move(size, rank, window - i * size, n)
                    rank += n
                if many * size < window:
                    counts[window - many * size] += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _cut(path: str, window: int, end_id: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        part = TaskContext.get().partitionId()
        full, seen = 0, np.zeros(window, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                own = batch.slice(at, SLICE)
                rows = []
                for text in own.column(1).to_pylist():
                    raw = np.array([*(encode(text) if text else ()), end_id], "<u4")
                    n_full, tail = divmod(len(raw), window)
                    cuts = [*([0] if tail else []), *range(tail, len(raw), window)]
                    rows.append((len(raw), part, full, tail, int(seen[tail]),
                                 [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(cuts, [*cuts[1:], len(raw)])]))
                    full += n_full
                    seen[tail] += tail > 0
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), out.types[1:])]
                yield pa.RecordBatch.from_arrays([own.column(0), *columns], schema=out)
    return run


def _placed(plan, starts: np.ndarray, out: pa.Schema):
    """Rows ``key, doc_tokens, tail, crc, rank`` to pieces; ``plan`` is broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = plan.value
        lows = starts[steps[:, 0]] + steps[:, 1]                # ranks of all lengths in one line
        for b in batches:
            size, rank = b.column(2).to_numpy().astype(np.int64), b.column(4).to_numpy()
            at = np.searchsorted(lows, starts[size] + rank, "right") - 1
            zero = np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, t) for x, t in zip(
                (zero, zero, size, b.column(3).to_numpy(), steps[at, 3] + rank - steps[at, 1], steps[at, 4]), out.types[1:])]], schema=out)
    return run


def pack_best_fit(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                  end_id: int = END_ID, decisions: int = DECISIONS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    own = StructField("doc_id", docs.schema[key].dataType, True)
    kind = _typed([own], _CUT)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    cut = written(rows.mapInArrow(_cut(tokenizer_path, window, end_id, to_arrow_schema(kind)), kind), "pieces")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    full = F.floor(F.col("doc_tokens") / window).cast("bigint")
    counts = written(cut.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("n"), F.sum(full).alias("full")), "counts")
    histogram = {r["tail"]: r["n"] for r in counts.where("tail > 0").groupBy("tail").agg(F.sum("n").alias("n")).collect()}
    plan = sum_of_squares(histogram, window, decisions)
    starts = np.zeros(window + 1, np.int64)
    starts[1:] = np.cumsum([histogram.get(s, 0) for s in range(window)])
    n_planned = int((plan[:, 3] + plan[:, 2] - plan[:, 1]).max(initial=0))
    bases = counts.where("tail > 0").select("part", "tail", F.coalesce(F.sum("n").over(
        before(Window.partitionBy("tail").orderBy("part"))), F.lit(0)).alias("base"))
    ranked = cut.where("tail > 0").join(bases, ["part", "tail"]).select(
        "doc_id", "doc_tokens", "tail", F.element_at("crcs", 1).alias("crc"), (F.col("base") + F.col("place")).alias("rank"))
    out = _typed([own], "piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    first = ranked.mapInArrow(_placed(spark.sparkContext.broadcast(plan), starts, to_arrow_schema(out)), out)
    # one row per partition: bounded by the partitions of the scan
    fulls = counts.groupBy("part").agg(F.sum("full").alias("n")).select("part", (F.coalesce(F.sum("n").over(
        before(Window.orderBy("part"))), F.lit(0)) + n_planned).alias("full_base"))
    short = (F.col("tail") > 0).cast("int")
    whole = cut.where(F.col("doc_tokens") >= window).join(F.broadcast(fulls), "part").select(
        "doc_id", "tail", short.alias("short"), (F.col("full_base") + F.col("first_full")).alias("first"),
        F.posexplode(F.slice("crcs", short + 1, F.size("crcs"))).alias("i", "crc")).select(
            "doc_id", (F.col("i") + F.col("short")).alias("piece"), (F.col("tail") + F.col("i").cast("bigint") * window).alias("start"),
            F.lit(window).cast("bigint").alias("length"), F.col("crc").alias("ids_crc32"),
            (F.col("first") + F.col("i")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return whole.unionByName(first)
