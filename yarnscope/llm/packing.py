"""Online sum-of-squares packing of tokenized texts into windows.

A document is its token ids and an end id. Full windows are cut off first,
each a sequence of its own. The rest goes, at once and for good, to the fill
level that makes the sum over all levels of (number of partly filled
windows)**2 least; the level array holds that number for every fill. When a
task has read its documents (or keeps MAX_OPEN windows open), the open windows
are closed: their pieces are cut and joined to full windows, and the last rest
is split into sequences whose lengths are powers of two, which take no
padding. So a task holds a bounded number of windows and leaves no padding.

Each task packs the documents it reads; nothing is shuffled. Reading the same
part of a table again, after a lost executor, gives the same sequences.

The ids are those of the byte-level BPE file named by the caller; the rank
file of the same vocabulary is read, as its encoder is several times faster
(the tests compare both encoders).
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
#: Partly filled windows a task holds.
MAX_OPEN = 4096
#: Strings that are one token wherever they occur, as in the tokenizer file.
SPECIAL = {"<|endoftext|>": 50256}

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


#: White space of the pattern in runs that its look-ahead may have no stack for.
_BLANKS = re.compile("[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
_TAIL = r"\s+(?!\S)|\s+"


def encoder(ranks: bytes, pattern: str):
    """A function from text to token ids (numpy) for a rank file's content.

    Very long white space makes the pattern's look-ahead fail. Such a text is
    cut where the pattern cuts it: a run before a word is one piece but for
    its last character, a run at the end is one piece.
    """
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=SPECIAL)
    special = re.compile(f"({'|'.join(map(re.escape, SPECIAL))})")

    def encode(text: str) -> np.ndarray:
        try:
            return encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            if not pattern.endswith(_TAIL) or not _BLANKS.search(text):
                raise
        # a special string ends the text before it for the pattern
        parts = special.split(text)
        if len(parts) > 1:
            return np.concatenate([encode(p) for p in parts])
        out, at = [], 0
        for m in _BLANKS.finditer(text):
            end = m.end() - (m.end() < len(text))
            out += [encode(text[at:m.start()]), np.array(encoding._encode_single_piece(text[m.start():end]), np.uint32)]
            at = end
        return np.concatenate([*out, encode(text[at:])])
    return encode


class Packer:
    """Packs one stream of documents; ``out`` collects rows of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN, first_sequence: int = 0):
        self.window, self.max_open, self.next = window, max_open, first_sequence
        self.level = np.zeros(window + 1, np.int64)  # partly filled windows of every fill
        self.open: list[list[list]] = [[] for _ in range(window)]  # their pieces
        self.n_open = 0
        self.out: list[tuple] = []

    def _emit(self, pieces) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), ids.tobytes(), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self._emit([(doc, start, ids[start:start + self.window], total)])
            start += self.window
        size = total - start
        if size == 0:
            return
        # change of the sum of squares for every fill that leaves room; fill 0 is a new window
        n = self.level
        last = self.window - size
        change = 2 * (n[size:self.window] - n[:last]) + 2
        change = np.append(change, 1 - 2 * n[last])  # this one fills the window
        change[0] = 2 * n[size] + 1
        change[1:][n[1:last + 1] == 0] = np.iinfo(np.int64).max
        fill = int(change.argmin())
        piece = (doc, start, ids[start:].copy(), total)
        pieces = [piece]
        if fill:
            pieces = self.open[fill].pop()
            pieces.append(piece)
            n[fill] -= 1
            self.n_open -= 1
        if fill + size == self.window:
            self._emit(pieces)
        else:
            self.open[fill + size].append(pieces)
            n[fill + size] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                self.close()

    def close(self) -> None:
        """Cuts and joins what is in open windows; nothing stays open."""
        row, room = [], self.window
        for fill in range(self.window - 1, 0, -1):
            for pieces in self.open[fill]:
                for doc, start, ids, total in pieces:
                    while len(ids):
                        part = ids[:room]
                        row.append((doc, start, part, total))
                        start, ids, room = start + len(part), ids[len(part):], room - len(part)
                        if room == 0:
                            self._emit(row)
                            row, room = [], self.window
            self.open[fill] = []
        self.level[:] = 0
        self.n_open = 0
        rest = self.window - room
        sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        for size in sizes:
            part, need = [], size
            while need:
                doc, start, ids, total = row.pop(0)
                if len(ids) > need:
                    row.insert(0, (doc, start + need, ids[need:], total))
                    ids = ids[:need]
                part.append((doc, start, ids, total))
                need -= len(ids)
            self._emit(part)

    def take(self) -> list[tuple]:
        rows, self.out = self.out, []
        return rows


def pack(docs: DataFrame, ranks_path: str, pattern: str, window: int = WINDOW, end_id: int = END_ID, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit token ids; ``start`` counts the
    document's ids before the piece, ``offset`` the sequence's.

    A null text is empty: its document is the end id alone. Repeated rows are
    packed one by one; a null doc_id stays null. An empty table gives no rows.
    Further columns are ignored.
    """
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())  # a file of fixed size, about 1 MB

    def run(batches):
        encode = encoder(ranks.value, pattern)
        packer = Packer(window, max_open, TaskContext.get().partitionId() << 40)

        def rows():
            for r in iter(lambda: packer.out[:2048], []):
                del packer.out[:2048]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*r, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py() or "")
                packer.add(doc, np.append(ids, end_id).astype("<u4"))
                if len(packer.out) >= 2048:
                    yield from rows()
        packer.close()
        yield from rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _DDL)
