"""Token ids of texts, fast: what stands between blanks is encoded once and looked up after that."""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import ready
from ._text import pieces

#: Most tokens of a sequence, and the id that ends each document.
LENGTH = 1024
END = 2
#: Different strings that a worker remembers; beyond that it starts anew.
REMEMBERED = 300_000

#: Characters for which the split at blanks is not known to agree with the tokenizer's own.
_ODD = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-ɏ]")
_BLANK_PAIRS = (" \n", " \t", " \r", " \x0b", " \x0c")


def default_files() -> tuple[str, str]:
    """The byte-level vocabulary, once for each of the two libraries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class _Known(dict):
    """Strings by number; a new one is encoded when it is first asked for."""

    def __init__(self, encode, lead: str) -> None:  # noqa: ANN001
        self.encode, self.lead = encode, lead
        self.flat, self.starts = array("I"), array("q", [0])

    def __missing__(self, unit: str) -> int:
        self.flat.extend(self.encode(self.lead + unit))
        self.starts.append(len(self.flat))
        self[unit] = n = len(self.starts) - 2
        return n

    def ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one after the other, and how many each has."""
        at = np.fromiter(map(self.__getitem__, units), np.int64, len(units))
        starts = np.array(self.starts)
        first, n = starts[at], starts[at + 1] - starts[at]
        flat = np.array(self.flat, np.uint32)
        return flat[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())], n


class Encoder:
    """Ids as the tokenizer file gives them. ``ranks`` holds the same vocabulary for single strings."""

    def __init__(self, file: str, ranks: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.single = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.first, self.later = _Known(self.single.encode_ordinary, ""), _Known(self.single.encode_ordinary, " ")

    def units(self, text: str) -> list[str] | None:
        """The text cut before each blank that a word follows; None if that is not known to be safe."""
        if _ODD.search(text) or any(s in text for s in self.special):
            return None
        found = text.split(" ")
        if "" in found or any(p in text for p in _BLANK_PAIRS):
            found = re.split(r" (?=\S)", text)
        return found

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null has none."""
        if len(self.first) + len(self.later) > REMEMBERED:
            self.forget()
        heads, rest, count, odd = [], [], [], {}
        for i, text in enumerate(texts):
            units = self.units(text or "")
            if units is None:
                odd[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
                units = [""]
            heads.append(units[0])
            rest += units[1:]
            count.append(len(units) - 1)
        head, n_head = self.first.ids(heads)
        tail, n_tail = self.later.ids(rest)
        head_end = np.cumsum(n_head)
        tail_at = np.concatenate(([0], np.cumsum(n_tail)))[np.cumsum([0, *count])]
        return [
            odd[i] if i in odd else np.concatenate((head[head_end[i] - n_head[i] : head_end[i]], tail[tail_at[i] : tail_at[i + 1]]))
            for i in range(len(texts))
        ]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(files: tuple[str, str]) -> Encoder:
    if files not in _ENCODERS:
        _ENCODERS[files] = Encoder(*files)
    return _ENCODERS[files]


@dataclass
class Piece:
    number: int
    start: int
    ids: np.ndarray


def cut(ids: np.ndarray, length: int) -> Iterator[Piece]:
    """The ids in pieces of ``length``; what does not fill one comes first."""
    start, stop = 0, len(ids) % length or length
    number = 0
    while start < len(ids):
        yield Piece(number, start, ids[start:stop])
        start, stop, number = stop, stop + length, number + 1


def token_pieces(docs: DataFrame, doc_id: str, text: str, length: int, files: tuple[str, str] | None, with_ids: bool) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    Ids are little-endian unsigned 32-bit numbers; a document ends with ``END``.
    """
    files = files or default_files()
    ready(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(files)
        for batch in pieces(batches, "text"):
            rows: list[list] = [[] for _ in range(6)]
            for at, ids in enumerate(encode(batch.column("text").to_pylist())):
                for p in cut(np.append(ids, np.uint32(END)), length):
                    raw = p.ids.astype("<u4").tobytes()
                    for column, value in zip(rows, (at, p.number, p.start, len(p.ids), zlib.crc32(raw), raw), strict=True):
                        column.append(value)
            columns = [batch.column("doc_id").take(pa.array(rows[0], pa.int32())), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:5])]
            yield pa.record_batch(columns + [pa.array(rows[5], pa.binary())] * with_ids, names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
