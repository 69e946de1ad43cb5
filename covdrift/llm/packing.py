"""Bounded-space online packing of token sequences.

Each task keeps ``open_windows`` windows. A document is tokenized; whole windows are cut off its
front, and the rest goes to the open window that it fills best. When none has room, the fullest is
topped up from the piece if its gap exceeds ``max_gap`` and emitted, and the piece is placed anew.
At the end of a task the open windows are cut into full ones and at most one leftover, and
leftovers of ``FAN_IN`` tasks are merged again and again until one group is left. A task holds
``open_windows`` windows, a merge ``FAN_IN``; both are bounded whatever the input is.

Tokenization keeps a bounded cache from each white-space-free chunk to its ids. Neither the
normalizer nor the split pattern of the tokenizer joins characters across white space, so the ids
equal those of the whole text; texts with the separators U+001C to U+001F are encoded whole.

Defined cases: a null or empty text is the end id alone; repeated rows and null ids are packed as
any other; a text of any length is cut into windows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import ensure_checkpoint_dir

WINDOW = 2048
OPEN_WINDOWS = 64
MAX_GAP = 16
END_ID = 1
FAN_IN = 16
CACHE = 300_000
#: Sequence ids: level, then task or group, then a counter.
_GROUP_BITS, _LEVEL_BITS = 30, 58
PIECE = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, part long, leftover boolean"
)
_COLUMNS = [field.split()[0] for field in PIECE.split(", ")]


class _Recent(dict):
    """A cache of two generations: at ``CACHE`` entries the older generation is forgotten."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


#: Marks that stand alone after a word.
_MARKS = frozenset(".,;:!?")


class ChunkEncoder:
    """Ids of texts as little-endian 32-bit bytes, equal to ``Tokenizer.encode`` on whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        #: Fixed value: the split pattern of the tokenizer file.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.shown = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}
        self.pieces = _Recent(self._piece)
        self.chunks = _Recent(self._chunk)
        # Below U+0250 (and without U+0130) lower-casing and composition are the same everywhere.
        self.plain = regex.compile(r"[\x00-įı-ɏ]*")

    def _ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _tokens(self, shown: str) -> bytes:
        return array("I", [t.id for t in self.whole.model.tokenize(shown)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._tokens(piece.encode().decode("latin-1").translate(self.shown))

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            # A plain word is one piece, shown as it is; a mark after it is another.
            if chunk.isalpha():
                return self._tokens(chunk) if chunk.islower() else self.pieces[chunk.lower()]
            if chunk[-1] in _MARKS and chunk[:-1].isalpha():
                return self.chunks[chunk[:-1]] + self.pieces[chunk[-1]]
        if "<|" in chunk or not self.plain.fullmatch(chunk):
            return self._ids(chunk)
        return b"".join(map(self.pieces.__getitem__, self.split.findall(chunk.lower())))

    def __call__(self, text: str) -> bytes:
        if any(mark in text for mark in "\x1c\x1d\x1e\x1f"):
            return self._ids(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


def _encoder(path: str) -> ChunkEncoder:
    """One encoder a worker process: its later tasks find the tokenizer loaded and words known."""
    import tokenizers

    # Code comes to the workers by value, so what outlives a task hangs on an imported module.
    known = vars(tokenizers).setdefault("_chunk_encoders", {})
    if path not in known:
        known[path] = ChunkEncoder(path)
    return known[path]


class Packer:
    """The windows of one task. Pieces are [doc_id, start, length, ids, doc_tokens]."""

    def __init__(self, first_id: int, part: int, window: int, open_windows: int, max_gap: int):
        self.next_id, self.part, self.window = first_id, part, window
        self.open_windows, self.max_gap = open_windows, max_gap
        self.open: list[list] = []  # [fill, pieces]
        self.rows: list[tuple] = []

    def _cut(self, piece: list, n: int) -> tuple[list, list]:
        doc, start, length, ids, total = piece
        head = [doc, start, n, ids[: 4 * n], total]
        return head, [doc, start + n, length - n, ids[4 * n :], total]

    def emit(self, pieces: list, leftover: bool = False) -> None:
        offset = 0
        for doc, start, length, ids, total in pieces:
            row = (doc, start, length, ids, total, self.next_id, offset, self.part, leftover)
            self.rows.append(row)
            offset += length
        self.next_id += 1

    def add(self, piece: list) -> None:
        while piece[2] >= self.window:
            head, piece = self._cut(piece, self.window)
            self.emit([head])
        while piece[2]:
            room = [w for w in self.open if w[0] + piece[2] <= self.window]
            if room:
                best = max(room, key=lambda w: w[0])
                best[0] += piece[2]
                best[1].append(piece)
                if best[0] == self.window:
                    self.open.remove(best)
                    self.emit(best[1])
                return
            if len(self.open) < self.open_windows:
                self.open.append([piece[2], [piece]])
                return
            fullest = max(self.open, key=lambda w: w[0])
            self.open.remove(fullest)
            if (gap := self.window - fullest[0]) > self.max_gap:
                head, piece = self._cut(piece, gap)
                fullest[1].append(head)
            self.emit(fullest[1])

    def finish(self) -> None:
        """Cut what is open into full windows; less than a window is left over."""
        fill, held = 0, []
        for _, pieces in sorted(self.open, key=lambda w: -w[0]):
            for piece in pieces:
                while fill + piece[2] >= self.window:
                    head, piece = self._cut(piece, self.window - fill)
                    self.emit([*held, head])
                    fill, held = 0, []
                if piece[2]:
                    held.append(piece)
                    fill += piece[2]
        self.open = []
        if held:
            self.emit(held, leftover=True)

    def take(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=_COLUMNS)
        out["doc_id"] = out["doc_id"].astype("Int64")
        self.rows = []
        return out


def _first(level: int, group: int) -> int:
    return (level << _LEVEL_BITS) + (group << _GROUP_BITS)


def _merger(level: int, window: int):
    """Merge the leftovers of one group of tasks."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["part"].iloc[0])
        packer = Packer(_first(level, group), group, window, FAN_IN, 0)
        rows = rows.sort_values(["sequence_id", "offset"])
        for _, pieces in rows.groupby("sequence_id", sort=True):
            held = [
                [None if pd.isna(p.doc_id) else int(p.doc_id), p.start, p.length, p.ids, p.doc_tokens]
                for p in pieces.itertuples()
            ]
            packer.open.append([sum(p[2] for p in held), held])
        packer.finish()
        return packer.take()

    return merge


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    max_gap: int = MAX_GAP,
    text: str = "text",
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all ``docs``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. Each level of merging
    is written once to the shared checkpoint folder, so no text is tokenized twice.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/packing-{uuid.uuid4().hex}"

    def first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer)
        part = TaskContext.get().partitionId()
        packer = Packer(_first(0, part), part, window, open_windows, max_gap)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for doc, words in zip(batch["doc_id"], batch["text"]):
                ids = (encode(words) if words else b"") + end
                packer.add([None if pd.isna(doc) else int(doc), 0, len(ids) // 4, ids, len(ids) // 4])
                if len(packer.rows) >= 1000:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    def stage(df: DataFrame, level: int) -> DataFrame:
        path = f"{folder}/{level}"
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    found = docs.select("doc_id", F.col(text).alias("text")).mapInPandas(first_pass, PIECE)
    levels = [stage(found, 0)]
    parts = levels[0].agg(F.max("part")).first()[0] or 0
    level = 0
    while parts:
        level, parts = level + 1, parts // FAN_IN
        rest = levels[-1].where("leftover").withColumn("part", F.expr(f"part div {FAN_IN}"))
        levels[-1] = levels[-1].where("not leftover")
        levels.append(stage(rest.groupBy("part").applyInPandas(_merger(level, window), PIECE), level))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.drop("part", "leftover")
