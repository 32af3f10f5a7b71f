"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

One automaton holds all pieces. Encoding walks it over a text once; at each
position it follows the output links, that is all pieces that end there from the
longest to the shortest, and relaxes the best score of that position. The path with the
highest sum of piece scores wins; of equal paths the one whose last piece is
longest (the rule of the reference Viterbi of SentencePiece's unigram type).
Characters that no piece covers become byte pieces.

No piece has a space mark behind another character, so a best path never
crosses the front of a space mark that follows one: a text falls into words that
can be solved apart, and a bounded memo of solved words is kept per worker.

The scores are those of the model file, summed in double precision. Where the
file is of the BPE type its scores are merge ranks; the result is then the best
unigram path over these scores, not the order of merges that SentencePiece's BPE
type would follow.

Defined cases: a null text is the empty text, which has no pieces; decoding gives back every
text that has no U+2581 of its own (the space mark stands for a space, as in
SentencePiece; such texts are marked by ``round_trip`` false);
repeated rows each get their row; an empty table gives no rows; only the named
columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.llm.common import map_slices

SPACE = "▁"
MEMO = 200_000          # words kept per worker
MEMO_CHARS = 64         # longer words are solved each time
UNKNOWN_PENALTY = 10.0  # fixed value: below the lowest piece score


@dataclass(frozen=True)
class Pieces:
    text: tuple[str, ...]           # by id
    score: tuple[float, ...]
    usable: tuple[bool, ...]        # may be produced by segmentation
    byte_id: dict[int, int]
    unknown_id: int


class Automaton:
    """Aho-Corasick automaton: ``step`` per node, and ``ends``: pieces that end there, longest first."""

    def __init__(self, words: dict[str, tuple[int, float]]):
        step: list[dict[str, int]] = [{}]
        own: list[tuple[int, int, float] | None] = [None]
        for word, (piece, score) in words.items():
            node = 0
            for c in word:
                if c not in step[node]:
                    step[node][c] = len(step)
                    step.append({})
                    own.append(None)
                node = step[node][c]
            own[node] = (len(word), piece, score)
        fail = [0] * len(step)
        link = [0] * len(step)      # nearest node on the failure path where a piece ends; 0: none
        queue = deque(step[0].values())
        while queue:
            node = queue.popleft()
            for c, child in step[node].items():
                f = fail[node]
                while f and c not in step[f]:
                    f = fail[f]
                fail[child] = step[f].get(c, 0)
                link[child] = fail[child] if own[fail[child]] else link[fail[child]]
                queue.append(child)
        self.step, self.own, self.fail, self.link = step, own, fail, link


class Codec:
    """Encoder and decoder over a set of pieces."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        usable = {t: (i, pieces.score[i]) for i, t in enumerate(pieces.text) if pieces.usable[i] and t}
        self.auto = Automaton(usable)
        self.low = min((s for _, s in usable.values()), default=0.0) - UNKNOWN_PENALTY
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        if any(re.search(f"[^{SPACE}]{SPACE}", t) for t in usable):
            self.words = re.compile("(?s:.+)")      # a piece crosses words: solve texts whole
        self.memo: dict[str, tuple[int, ...]] = {}
        self.byte_of = {i: b for b, i in pieces.byte_id.items()}

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        memo = self.memo
        for word in self.words.findall(SPACE + text.replace(" ", SPACE)):
            ids = memo.get(word)
            if ids is None:
                ids = self._solve(word)
                if len(word) <= MEMO_CHARS:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[word] = ids
            out += ids
        return out

    def _solve(self, word: str) -> tuple[int, ...]:
        step, own, fail, link = self.auto.step, self.auto.own, self.auto.fail, self.auto.link
        best = [0.0] + [-float("inf")] * len(word)
        back: list[tuple[int, int]] = [(0, -1)] * (len(word) + 1)
        node = 0
        for end, c in enumerate(word, 1):
            while node and c not in step[node]:
                node = fail[node]
            node = step[node].get(c, 0)
            at = node if own[node] else link[node]
            top, how, single = -float("inf"), None, False
            while at:
                length, piece, score = own[at]
                s = best[end - length] + score
                if s > top:
                    top, how = s, (length, piece)
                single = length == 1
                at = link[at]
            if not single:      # no piece for this character alone: it can stand as unknown
                s = best[end - 1] + self.low
                if s > top:
                    top, how = s, (1, -1)
            best[end], back[end] = top, how
        ids: list[int] = []
        end = len(word)
        while end:
            length, piece = back[end]
            if piece >= 0:
                ids.append(piece)
            else:
                raw = word[end - 1].encode("utf-8", "surrogatepass")
                ids += [self.pieces.byte_id[b] for b in reversed(raw)] if self.pieces.byte_id else [self.pieces.unknown_id]
            end -= length
        return tuple(reversed(ids))

    def score(self, ids: list[int]) -> float:
        return float(sum(self.pieces.score[i] for i in ids))

    def decode(self, ids: list[int]) -> str:
        text, byte_of = self.pieces.text, self.byte_of
        if not byte_of or not any(i in byte_of for i in ids):
            out = "".join([text[i] for i in ids])
        else:
            raw = b"".join(bytes([byte_of[i]]) if i in byte_of else text[i].encode() for i in ids)
            out = raw.decode("utf-8", "surrogatepass")
        return out.replace(SPACE, " ")[1:] if out[:1] == SPACE else out.replace(SPACE, " ")


@cache
def codec(model_path: str) -> Codec:
    """The codec of a SentencePiece model file (once per worker)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = model.vocab_size()
    text = tuple(model.id_to_piece(i) for i in range(n))
    return Codec(Pieces(
        text, tuple(model.get_score(i) for i in range(n)),
        tuple(not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)),
        {int(text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}, model.unk_id()))


def encode_texts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model_path)
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "ids": [
                np.array(own.encode(t) if isinstance(t, str) else [], np.int32) for t in f["text"]]})

    kind = docs.schema[key].dataType.simpleString()
    return map_slices(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model_path)
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "text": [own.decode(list(i)) for i in f["ids"]]})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_slices(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")


def encoding_report(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``n_ids``, ``ids_crc32`` (little-endian unsigned 32-bit ids), ``score``, ``n_bytes``
    (byte pieces) and ``round_trip``: decoding gave the text back."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model_path)
        score = np.array(own.pieces.score)
        is_byte = np.zeros(len(score), bool)
        is_byte[list(own.pieces.byte_id.values())] = True
        for f in frames:
            rows = []
            for key_, t in zip(f["doc_id"], f["text"]):
                t = t if isinstance(t, str) else ""
                ids = own.encode(t)
                raw = np.array(ids, "<u4")
                rows.append((key_, len(ids), zlib.crc32(raw.tobytes()), float(score[raw].sum()), int(is_byte[raw].sum()),
                             own.decode(ids) == t))
            yield pd.DataFrame(rows, columns=["doc_id", "n_ids", "ids_crc32", "score", "n_bytes", "round_trip"])

    kind = docs.schema[key].dataType.simpleString()
    return map_slices(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), run,
                      f"doc_id {kind}, n_ids bigint, ids_crc32 bigint, score double, n_bytes bigint, round_trip boolean")
