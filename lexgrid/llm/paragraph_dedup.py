"""Substring deduplication with paragraph MinHash banding.

Units that may repeat across documents:

* paragraphs: every line, and every block of lines between blank lines, of ``SHINGLE``
  words or more, as sets of 5-word shingles. Equal paragraphs collapse first, however
  their lines are wrapped. MinHash signatures are cut into ``BANDS`` bands of
  ``ROWS`` values; paragraphs that collide in a band are compared exactly, and
  those with Jaccard 0.8 or more are linked (14 bands of 4 find 99.9 % of pairs at
  0.8, and more above). Sets of ``ALIKE`` shingles or fewer are linked to equal sets only,
  and those meet in every band, so one band is enough for them.
  Connected components of the links are the removal clusters.
* windows of ``WINDOW`` words that begin at content-chosen places (the lowest 4-gram
  hash of every ``STRIDE`` neighbouring places). For them one band holds the whole
  window, as equal passages choose equal places: every passage of
  ``WINDOW + STRIDE - 1`` = 51 words that stands in two documents has such a window in
  common, wherever it lies in its lines.

Of a cluster that touches several documents the occurrence with the smallest
``doc_id`` (then place) stays, the others are removed, also those of the same document
that begin after the kept one's end; clusters inside one document are left alone. Spans of a document are merged. Offsets are code points.

Defined cases: null texts and texts under ``SHINGLE`` words have no units; rows with a null id take no part; rows
that repeat an id count as one document; ties of places can't occur within a
text; a table without repeats, or an empty one, gives no rows; only the named
columns are read. Window hashes, and those that tell the texts of one id apart, have 64 bits, paragraph names 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.llm.common import (CHUNK, SLICE, fresh, hash_words, map_batches, map_slices, maybe_in, mix, named_once, remove, shingles,
                                write, written)
from lexgrid.llm.graph import components
from lexgrid.llm.simjoin import linked_forest
from lexgrid.session import scratch_path

SHINGLE = 5
SIMILAR = Fraction(4, 5)
BANDS, ROWS = 14, 4
ALIKE = 3                   # a set of 4 shingles is the smallest that another set can be 0.8 like
WINDOW, STRIDE = 44, 8
GRAM = 4

_ODD = np.random.default_rng(77).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, both modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 12)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, np.uint64(b))], dtype=np.uint64) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def window_places(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First words of the chosen windows: the place of the lowest gram hash of each ``STRIDE``
    places, or of all places of a text that has fewer. ``ends``: for each word, the end of its text."""
    n = len(words)
    at = np.arange(n)
    fits = at + WINDOW <= ends
    gram = np.full(n + STRIDE - 1, np.uint64(2**64 - 1))
    gram[:max(n - GRAM + 1, 0)] = shingles(words, GRAM)[:max(n - GRAM + 1, 0)]
    gram[:n][~fits] = np.uint64(2**64 - 1)
    if not fits.any():
        return np.empty(0, np.int64)
    low = np.lib.stride_tricks.sliding_window_view(gram, STRIDE).argmin(1) + at
    begins = np.r_[True, ends[1:] != ends[:-1]]
    return np.unique(low[fits & (begins | (at + STRIDE - 1 + WINDOW <= ends))])


def window_hashes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    up, down = _power(len(words) + 1)
    total = np.r_[np.uint64(0), np.cumsum(words * up[:len(words)], dtype=np.uint64)]
    return mix((total[at + WINDOW] - total[at]) * down[at])


def signatures(tokens: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """MinHash values of ranges of tokens (not empty, they may overlap), a row per range."""
    cuts = np.unique(np.r_[begins, ends])
    cuts = cuts[cuts < len(tokens)]
    # minima between neighbouring cuts first, then those of the pieces of each range
    pairs = np.stack([np.searchsorted(cuts, begins), np.searchsorted(cuts, ends)], 1).reshape(-1)
    end = np.uint64(2**64 - 1)
    # products with odd numbers: their high bits, which decide the minimum, are well mixed
    return np.stack([np.minimum.reduceat(np.r_[np.minimum.reduceat(tokens * a, cuts), end], pairs)[::2] for a in _ODD], 1)


def band_keys(values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(values), np.uint64(b + 1))
        for r in range(ROWS):
            key = mix(key ^ values[:, b * ROWS + r])
        out[:, b] = key
    return out


def _paragraphs(newlines: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end words of the lines, and of the blocks of several lines, that hold a shingle."""
    line = np.searchsorted(newlines, starts)
    step = np.diff(line)
    other = np.diff(doc) > 0
    ranges = []
    for new in (other | (step > 0), other | (step > 1)):
        edge = np.flatnonzero(np.r_[True, new, True])
        ranges.append((edge[:-1], edge[1:]))
    (a, b), (c, d) = ranges
    several = line[c] != line[d - 1]        # a block of one line is that line
    a, b = np.r_[a, c[several]], np.r_[b, d[several]]
    long = b - a >= SHINGLE
    return a[long], b[long]


# a row per text and part: its windows, its paragraphs, and the bands of these. Each part is written apart and goes when it is spent
WINDOWS, PLACES, BANDED = 0, 1, 2
_UNITS = ("part int, doc_id {0}, version bigint, hashes array<bigint>, starts array<int>, lengths array<int>, "
          "paragraphs array<struct<node:binary,size:int,start:int,end:int,bands:array<bigint>>>")


def _units(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    for rows in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
        raws, first, size = [], 0, 0
        for i, text in enumerate(rows.column(rows.schema.get_field_index("text")).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            if raws and size + len(raw) > CHUNK:
                yield from _units_of(rows.slice(first, len(raws)), raws, out)
                raws, first, size = [], i, 0
            raws.append(raw)
            size += len(raw) + 1
        yield from _units_of(rows.slice(first, len(raws)), raws, out)


def _joined(raws: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts put together: the whole, the hash, first byte and end byte of its words, and the first byte of each text (and the end)."""
    text = b"\n".join(raws)
    return text, *hash_words(text), np.r_[0, np.cumsum([len(r) + 1 for r in raws])]


def _units_of(rows: pa.RecordBatch, raws: list[bytes], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Units of some texts, worked out together."""
    text, words, s, e, first_byte = _joined(raws)
    if len(words) < SHINGLE:
        return
    buf = np.frombuffer(text, np.uint8)
    first_word = np.searchsorted(s, first_byte)
    ends, doc = np.repeat(first_word[1:], np.diff(first_word)), np.repeat(np.arange(len(raws)), np.diff(first_word))
    point = np.cumsum((buf & 0xC0) != 0x80, dtype=np.int32)      # code points up to and with each byte
    base = np.repeat(np.r_[0, point][np.minimum(first_byte[:-1], len(buf))], np.diff(first_word)).astype(np.int32)
    first, last = point[s] - 1 - base, point[e - 1] - base

    def part(number: int, count: np.ndarray, **lists: pa.Array) -> pa.RecordBatch:
        # a row for each text that has any; the elements of a text follow one another
        some = np.flatnonzero(count)
        cuts = pa.array(np.r_[0, np.cumsum(count[some])], pa.int32())
        own = rows.take(pa.array(some))
        fixed = {"part": pa.array(np.full(len(some), number), pa.int32()), **{n: own.column(own.schema.get_field_index(n)).cast(out.field(n).type) for n in ("doc_id", "version")}}
        return pa.RecordBatch.from_arrays([fixed[f.name] if f.name in fixed else pa.ListArray.from_arrays(cuts, lists[f.name], type=f.type)
                                           if f.name in lists else pa.nulls(len(some), f.type) for f in out], schema=out)

    at = window_places(words, ends)
    yield part(WINDOWS, np.diff(np.searchsorted(at, first_word)), hashes=pa.array(window_hashes(words, at).view(np.int64)),
               starts=pa.array(first[at]), lengths=pa.array(last[at + WINDOW - 1] - first[at]))
    begins, stops = _paragraphs(np.flatnonzero(buf == 10), s, doc)
    if not len(begins):
        return
    order = np.argsort(doc[begins], kind="stable")
    begins, stops = begins[order], stops[order]
    keys = band_keys(signatures(shingles(words, SHINGLE), begins, stops - SHINGLE + 1)).view(np.int64)
    raw = memoryview(words.tobytes())
    nodes = pa.array([hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() for a, b in zip(begins.tolist(), stops.tolist())], pa.binary())
    wide = np.where(stops - begins - SHINGLE + 1 > ALIKE, BANDS, 1)
    kind = out.field("paragraphs").type.value_type
    bands = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(wide)], pa.int32()), pa.array(keys[np.arange(BANDS) < wide[:, None]]),
                                     type=kind.field("bands").type)
    count = np.bincount(doc[begins], minlength=len(raws))
    for number, size, own in ((PLACES, pa.nulls(len(nodes), pa.int32()), pa.nulls(len(nodes), bands.type)),
                              (BANDED, pa.array((stops - begins).astype(np.int32)), bands)):
        yield part(number, count, paragraphs=pa.StructArray.from_arrays(
            [nodes, size, pa.array(first[begins]), pa.array(last[stops - 1]), own], fields=list(kind)))


def _paragraph_tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows, some, size = [], [], 0
        for text, wanted in zip(f["text"], f["wanted"]):
            for w in wanted:
                raw = text[w["start"]:w["end"]].encode("utf-8", "surrogatepass")
                if some and size + len(raw) > CHUNK:
                    rows += _tokens_of(some)
                    some, size = [], 0
                some.append((w["node"], w["grp"], raw))
                size += len(raw) + 1
        if some:
            rows += _tokens_of(some)
        yield pd.DataFrame(rows, columns=["node", "grp", "tokens"])


def _tokens_of(some: list[tuple]) -> list[tuple]:
    """Token sets of some paragraphs (``SHINGLE`` words or more each), hashed together."""
    _, words, s, _, first_byte = _joined([raw for *_, raw in some])
    tokens, cuts = shingles(words, SHINGLE), np.searchsorted(s, first_byte).tolist()
    return [(node, grp, np.unique(tokens[a:b - SHINGLE + 1]).tobytes()) for (node, grp, _), a, b in zip(some, cuts, cuts[1:])]


def _clusters(found: DataFrame, by: str) -> DataFrame:
    """Clusters of occurrences that touch more than one document, with the occurrence that stays."""
    return found.groupBy(by).agg(F.min(F.struct("doc_id", "start", "end")).alias("kept"), F.max("doc_id").alias("last")).where(
        F.col("kept.doc_id") < F.col("last")).select(by, F.col("kept.doc_id").alias("first_doc"), F.col("kept.end").alias("first_end"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, end, first_doc, removed``: every occurrence of a repeated unit."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("version", F.xxhash64("text"))     # rows may repeat an id with other texts
    units = map_batches(rows, _units, _UNITS.format(kind))
    path = scratch_path(docs.sparkSession, "units")
    write(units, path, "part")
    part = lambda n: docs.sparkSession.read.schema(units.schema).parquet(path).where(F.col("part") == n)

    windows = part(WINDOWS).select("doc_id", F.explode(F.arrays_zip("hashes", "starts", "lengths")).alias("w")).select(
        "doc_id", F.col("w.hashes").alias("hash"), F.col("w.starts").alias("start"), (F.col("w.starts") + F.col("w.lengths")).alias("end"))
    # counts move, windows don't: a window leaves its task only if its hash has company
    company = written(windows.groupBy("hash").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("hash"), "window-company")
    shared = written(maybe_in(windows, "hash", company, "hash").join(company, "hash"), "shared-windows")
    remove(docs.sparkSession, [f"{path}/part={WINDOWS}"])
    spans = shared.join(written(_clusters(shared, "hash"), "window-clusters"), "hash").select(
        "doc_id", "start", "end", "first_doc", "first_end")

    every = lambda n: part(n).select("doc_id", "version", F.explode("paragraphs").alias("p")).select("doc_id", "version", "p.*")
    paragraphs = every(PLACES)
    # equal paragraphs: the first place stands for all; bands don't move, but for the places that are the first ones
    place = F.struct("doc_id", "start", "end", "version")
    distinct = written(paragraphs.groupBy("node").agg(F.min(place).alias("p"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("rows")).select(
        "node", "p.*", "last", "rows"), "distinct-paragraphs")
    name = F.concat("node", F.concat_ws(":", "doc_id", "start", "end", "version").cast("binary"))
    copied = distinct.where("rows > 1").select(F.col("node").alias("_node"), place.alias("p"))
    copies = maybe_in(paragraphs.select("node", place.alias("at"), name.alias("name")), "node", copied, "_node").join(copied, F.col("node") == F.col("_node"))
    copies = written(copies.groupBy("name").agg(F.first(F.col("at") == F.col("p")).alias("stays"), F.count(F.lit(1)).alias("n")).where("NOT stays OR n > 1"), "copies")
    whole = every(BANDED).select("node", "size", "bands", name.alias("_name"))
    keys = named_once(whole, "_name", copies.select("name", "stays")).select(
        "node", F.col("size").cast("bigint").alias("size"), F.lit(1).alias("need"), F.explode(F.array_distinct("bands")).alias("cell"))

    def tokens_of(members: DataFrame) -> DataFrame:
        wanted = written(members.join(distinct.select("node", "doc_id", "version", "start", "end"), "node").groupBy("doc_id", "version").agg(
            F.collect_list(F.struct("node", "grp", "start", "end")).alias("wanted")), "wanted")
        texts = maybe_in(rows, "version", wanted, "version").dropDuplicates(["doc_id", "version"])
        return map_slices(texts.join(wanted, ["doc_id", "version"]).select("text", "wanted"), _paragraph_tokens,
                          "node binary, grp bigint, tokens binary")

    linked = components(linked_forest(keys, tokens_of, SIMILAR, [f"{path}/part={BANDED}"]))
    # a paragraph of one document without a link is a cluster of that document alone
    named = written(distinct.select("node", "doc_id", "last").join(linked, "node", "left").where("component_id IS NOT NULL OR doc_id < last").select(
        "node", F.coalesce("component_id", "node").alias("component_id")), "paragraph-components")
    occurrences = maybe_in(paragraphs.select("node", "doc_id", "start", "end"), "node", named, "node").join(named, "node")
    occurrences = written(occurrences.select("component_id", "doc_id", "start", "end"), "occurrences")
    whole = occurrences.join(written(_clusters(occurrences, "component_id"), "paragraph-clusters"), "component_id").select(
        "doc_id", "start", "end", "first_doc", "first_end")
    return spans.unionByName(whole).select("doc_id", "start", "end", "first_doc", (
        (F.col("doc_id") != F.col("first_doc")) | (F.col("start") >= F.col("first_end"))).alias("removed"))


def _merged(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        key, first, found = (b.column(b.schema.get_field_index(n)) for n in ("doc_id", "first_doc_id", "found"))
        row, code = np.repeat(np.arange(b.num_rows), found.value_lengths().to_numpy()), found.flatten().to_numpy()
        gone = code < 0
        place = np.where(gone, ~code, code)
        every = _merge(row, place, b.num_rows)
        removed = _merge(row[gone], place[gone], b.num_rows)
        yield pa.RecordBatch.from_arrays([key.cast(out.field(0).type), first.cast(out.field(1).type), *(pa.array(x, out.field(n).type) for n, x in zip(
            out.names[2:], (*every[:2], *removed[:2], every[2], removed[2])))], schema=out)


def _merge(row: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``merge`` for the spans of ``n`` rows at once (``start << 32 | end``): their number, characters and text by row."""
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    a, b = place >> 32, place & 0xFFFFFFFF
    reach = np.maximum.accumulate((row << 32) | b)
    new = np.r_[True, (row[1:] << 32 | a[1:]) > reach[:-1]][:len(row)]
    at = np.flatnonzero(new)
    row, a, b = row[at], a[at], reach[np.r_[at[1:], len(new)][:len(at)] - 1] & 0xFFFFFFFF
    cuts = np.searchsorted(row, np.arange(n + 1))
    spans = [f"{x}:{y}" for x, y in zip(a.tolist(), b.tolist())]
    chars = np.r_[0, np.cumsum(b - a)]
    return np.diff(cuts), chars[cuts[1:]] - chars[cuts[:-1]], [",".join(spans[x:y]) for x, y in zip(cuts.tolist(), cuts[1:].tolist())]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans; spans that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def repeat_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for every document with a passage that another document has too.

    ``first_doc_id``: the smallest document that keeps one of these passages; ``repeats``
    and ``removals``: merged spans ``start:end``, all and the removed ones.
    """
    kind = docs.schema[key].dataType.simpleString()
    # a span in one number: sets of numbers are gathered and moved at a part of the cost of sets of structs. Removed ones are inverted
    span = F.shiftleft(F.col("start").cast("bigint"), 32).bitwiseOR(F.col("end").cast("bigint"))
    found = repeated_spans(docs, key, text).groupBy("doc_id").agg(
        F.min("first_doc").alias("first_doc_id"), F.collect_set(F.when(F.col("removed"), F.bitwise_not(span)).otherwise(span)).alias("found"))
    return map_batches(found, _merged, f"doc_id {kind}, first_doc_id {kind}, n_repeats bigint, repeat_chars bigint, n_removed bigint, "
                                       "removed_chars bigint, repeats string, removals string")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed spans cut out of their texts."""
    own, spans_of, columns = fresh(docs, "_cut_id"), fresh(docs, "_cut_spans"), docs.columns
    report = written(repeat_report(docs, key, text).where("n_removed > 0").select(
        F.col("doc_id").alias(own), F.col("removals").alias(spans_of)), "removals")

    def cut(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = b.schema.get_field_index(text)
            for at in range(0, b.num_rows, SLICE):
                rows = b.slice(at, SLICE)
                texts = []
                for t, spans in zip(rows.column(place).to_pylist(), rows.column(spans_of).to_pylist()):
                    for part in reversed(spans.split(",") if spans else []):
                        first, end = map(int, part.split(":"))
                        t = t[:first] + t[end:]
                    texts.append(t)
                kept = [rows.column(i) if i != place else pa.array(texts, out.field(place).type) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays(kept, schema=out)

    return map_batches(docs.join(report, F.col(key) == F.col(own), "left").select(*columns, spans_of), cut, docs.schema)
