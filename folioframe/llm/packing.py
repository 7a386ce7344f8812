"""Hierarchical multi-length packing of tokenised documents.

Documents are routed to context-size tiers (1024, 512, 256, 128 by default). A document of at least the
longest tier gives whole windows first; what is left of it goes to the smallest tier that holds it. Each tier is
packed from its longest piece on, the gap of a window is filled from shorter pieces, and a piece is cut only where
nothing fits. What remains at the end of a task is cut at powers of two, so no window needs padding. Windows of a
tier form step groups of an equal number of tokens; at the end of a task the tiers' incomplete groups are balanced against each
other, largest windows first, so that all groups of a task but one at most are full.

The plan is one stage without a shuffle: each task packs the documents of its own input split, with a buffer of a
bounded number of pieces, so memory doesn't depend on the input and a lost task is simply run again.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TIERS = (1024, 512, 256, 128)
#: Pieces that a task holds before it packs them.
BUFFER = 4096
#: Tokens of a step group.
STEP_TOKENS = 8192

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
#: Splits of GPT-2's byte-level pre-tokeniser: a fixed value of the tokenizer file's format.
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write bytes that don't print as characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


#: tiktoken's pattern gives up on runs of white space from some hundred thousand characters on; from these on ``tokenizers`` itself is used.
LONG_BLANKS = re.compile(r"\s{20000}")


def load_encoder(path: str):
    """text -> ids of a byte-level BPE file, as the ``tokenizers`` library gives them with ``add_special_tokens=False``.

    Ids of such a file follow its merge order, so the same vocabulary runs as ranks in the faster tiktoken; a test
    holds both against each other. A special token written out in a text gets its id, as that library does by default.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
    back = _byte_of_char()
    ranks = {bytes(back[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    fast, exact = tiktoken.Encoding("byte_bpe", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=special), []

    def encode(text: str) -> list[int]:
        if len(text) < 20_000 or not LONG_BLANKS.search(text):
            return fast.encode(text, allowed_special="all") if any(x in text for x in special) else fast.encode_ordinary(text)
        if not exact:
            from tokenizers import Tokenizer

            exact.append(Tokenizer.from_file(path))
        return exact[0].encode(text, add_special_tokens=False).ids

    return encode


class _Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, at: int) -> tuple[_Piece, _Piece]:
        return _Piece(self.doc, self.start, self.ids[:at], self.total), _Piece(self.doc, self.start + at, self.ids[at:], self.total)


class _Packer:
    """Packs the pieces of one task; rows are kept as columns until they are taken."""

    def __init__(self, task: int, tiers: tuple[int, ...], step_tokens: int):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.next_id, self.next_group = task << 36, task << 36
        #: Windows (lists of rows without a group) of the group that each size is filling.
        self.filling: dict[int, list[list[tuple]]] = {}
        self.held: list[_Piece] = []
        self.rows: list[tuple] = []

    def window(self, pieces: list[_Piece], size: int) -> None:
        rows, offset = [], 0
        for p in pieces:
            rows.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total, self.next_id, offset, size))
            offset += len(p.ids)
        self.next_id += 1
        windows = self.filling.setdefault(size, [])
        windows.append(rows)
        if (len(windows) + 1) * size > self.step_tokens:
            self.group(self.filling.pop(size))

    def group(self, windows: list[list[tuple]]) -> None:
        self.rows += [(*row, self.next_group) for rows in windows for row in rows]
        self.next_group += 1

    def balance(self) -> None:
        """Group what the sizes have left: sizes are powers of two, so taken from the largest on they fill groups without a gap."""
        group, held = [], 0
        for size in sorted(self.filling, reverse=True):
            for rows in self.filling.pop(size):
                if group and held + size > self.step_tokens:
                    self.group(group)
                    group, held = [], 0
                group.append(rows)
                held += size
        if group:
            self.group(group)

    def add(self, doc, ids: np.ndarray) -> None:
        top, total = self.tiers[0], len(ids)
        whole = total - total % top
        for at in range(0, whole, top):
            self.window([_Piece(doc, at, ids[at : at + top], total)], top)
        if whole < total:
            self.held.append(_Piece(doc, whole, ids[whole:], total))

    def pack(self, last: bool) -> None:
        """Fill windows tier by tier. Without ``last``, what can't fill a window waits for more documents."""
        pieces = sorted(self.held, key=lambda p: len(p.ids))
        sizes = [len(p.ids) for p in pieces]
        self.held = []

        def take(i: int) -> _Piece:
            sizes.pop(i)
            return pieces.pop(i)

        def put(p: _Piece) -> None:
            i = bisect.bisect_left(sizes, len(p.ids))
            sizes.insert(i, len(p.ids))
            pieces.insert(i, p)

        for k, size in enumerate(self.tiers):
            shorter = self.tiers[k + 1] if k + 1 < len(self.tiers) else 0
            while sizes and sizes[-1] > shorter:
                got = [take(len(sizes) - 1)]
                gap = size - len(got[0].ids)
                while gap and sizes:
                    i = bisect.bisect_right(sizes, gap) - 1
                    if i >= 0:
                        got.append(take(i))
                    else:
                        head, tail = take(0).cut(gap)
                        got.append(head)
                        put(tail)
                    gap -= len(got[-1].ids)
                if gap:
                    self.leftover(got, last)
                else:
                    self.window(got, size)

    def leftover(self, got: list[_Piece], last: bool) -> None:
        if not last:
            self.held += got
            return
        left = sum(len(p.ids) for p in got)
        while left:
            size = min(self.tiers[0], 1 << (left.bit_length() - 1))
            need, row = size, []
            while need:
                p = got.pop(0)
                if len(p.ids) > need:
                    p, rest = p.cut(need)
                    got.insert(0, rest)
                row.append(p)
                need -= len(p.ids)
            self.window(row, size)
            left -= size

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 9
        self.rows = []
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [pa.int32() if n == "tier" else pa.int64() for n in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", eos_id: int = 0, tiers: tuple[int, ...] = TIERS, buffer: int = BUFFER, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pack every row's token ids, followed by ``eos_id``, into windows.

    One row a piece: the document's id, the piece's first position and length there, CRC-32 of its little-endian
    unsigned 32-bit ids, the document's tokens, its window and place in it, the window's tier and step group.
    A null or empty text gives the one id ``eos_id``; a text of any length is taken whole, long runs of blanks too; repeated rows
    are packed each for itself; a null id stays null; an empty table gives no rows; other columns aren't read. ``tiers`` must be falling powers of two.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers must be falling powers of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), tiers, step_tokens)
        encode = None
        for b in batches:
            encode = encode or load_encoder(tokenizer_path)
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(eos_id)
                packer.add(doc, np.array(ids, dtype="<u4"))
                if len(packer.held) >= buffer:
                    packer.pack(last=False)
                    if len(packer.held) >= buffer:  # pieces too few to fill a window can't be so many, but stay bounded
                        packer.pack(last=True)
                if len(packer.rows) >= 20_000:
                    yield packer.batch()
        packer.pack(last=True)
        packer.balance()
        yield packer.batch()

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, SCHEMA)
