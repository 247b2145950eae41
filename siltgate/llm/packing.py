"""Hierarchical packing: documents of several context sizes into sequences without padding."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from siltgate.llm.text import arrow_schema, columns, giving_back, record_batch
from siltgate.llm.tokens import ByteBpe

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " tier int, step_group long"
)


@dataclass(frozen=True)
class Sizes:
    """Context sizes, each a power of two, longest last; tokens of a step group; tokens packed at a time in a task."""

    tiers: tuple[int, ...] = (128, 256, 512, 1024)
    group_tokens: int = 8192
    block_tokens: int = 1 << 21

    def __post_init__(self) -> None:
        if any(t & (t - 1) for t in self.tiers) or list(self.tiers) != sorted(set(self.tiers)):
            raise ValueError(f"tiers must be ascending powers of two: {self.tiers}")


@dataclass
class Document:
    doc_id: int | None
    ids: np.ndarray


@dataclass
class Piece:
    document: Document
    start: int
    length: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        rest = Piece(self.document, self.start + length, self.length - length)
        return Piece(self.document, self.start, length), rest


class Shelf:
    """Pieces by length; which lengths are there is kept as bits of one number."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[Piece]] = {}
        self.lengths = 0

    def put(self, piece: Piece) -> None:
        self.by_length.setdefault(piece.length, []).append(piece)
        self.lengths |= 1 << piece.length

    def take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.lengths &= ~(1 << length)
        return piece

    def longest(self, most: int) -> int:
        """The greatest length up to `most` that is there, or 0."""
        return max(0, (self.lengths & ((2 << most) - 1)).bit_length() - 1)

    def shortest(self, over: int) -> int:
        """The least length over `over` that is there, or 0."""
        higher = self.lengths >> (over + 1)
        return (higher & -higher).bit_length() + over if higher else 0


@dataclass
class Packer:
    """Packs the documents of one task, `block_tokens` at a time, so that its memory is bounded.

    A document is cut into pieces of the longest size; what remains is routed to the smallest tier that holds it. Each
    tier packs its own pieces, longest tier first: a window starts with a piece of its tier, and its gap takes, best
    fit, whole pieces of shorter tiers. Where none fits, the next longer one of a shorter tier is cut, so every window
    is full. Pieces that shorter tiers cannot fill wait for later documents until they come to half a block; then their
    gaps are filled by cutting pieces of their own tier. What is left at the end becomes sequences of powers of two.
    """

    sizes: Sizes
    first_id: int
    shelf: Shelf = field(default_factory=Shelf)
    tokens: int = 0
    waiting: dict[int, list[list[Piece]]] = field(default_factory=dict)
    sequences: int = 0
    groups: int = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        longest, document = self.sizes.tiers[-1], Document(doc_id, ids)
        whole = len(ids) // longest * longest
        for start in range(0, whole, longest):
            self.waiting.setdefault(longest, []).append([Piece(document, start, longest)])
        if whole < len(ids):
            self.shelf.put(Piece(document, whole, len(ids) - whole))
        self.tokens += len(ids)

    def _fill(self, window: list[Piece], size: int, own_tier: bool) -> bool:
        """Fill the gap from shorter pieces, or else, if asked, from pieces of the same tier; False if they do not suffice."""
        gap = size - sum(p.length for p in window)
        below = size // 2 if size > self.sizes.tiers[0] else size
        most = size if own_tier else below
        while gap:
            if length := self.shelf.longest(min(gap, below)):
                window.append(self.shelf.take(length))
            elif 0 < (length := self.shelf.shortest(gap)) <= most:
                part, rest = self.shelf.take(length).cut(gap)
                window.append(part)
                self.shelf.put(rest)
            else:
                return False
            gap = size - sum(p.length for p in window)
        return True

    def _pack(self, own_tier: bool = False) -> None:
        for size in reversed(self.sizes.tiers):
            lower = size // 2 if size > self.sizes.tiers[0] else 0
            unfilled = []
            while (length := self.shelf.longest(size)) > lower:
                window = [self.shelf.take(length)]
                if self._fill(window, size, own_tier):
                    self.waiting.setdefault(size, []).append(window)
                else:
                    unfilled += window
            for piece in unfilled:
                self.shelf.put(piece)

    def _close(self) -> None:
        """The rest of the task, shorter pieces joined, as sequences of powers of two."""
        rest = [p for pieces in self.shelf.by_length.values() for p in pieces]
        self.shelf = Shelf()
        left = sum(p.length for p in rest)
        while left:
            size = min(self.sizes.tiers[-1], 1 << (left.bit_length() - 1))
            window, gap = [], size
            while gap:
                piece = rest.pop()
                if piece.length > gap:
                    piece, more = piece.cut(gap)
                    rest.append(more)
                window.append(piece)
                gap -= piece.length
            self.waiting.setdefault(size, []).append(window)
            left -= size

    def _groups(self, all_of_them: bool) -> Iterator[list[list[Piece]]]:
        """Step groups of equal tokens and nearly equal attention cost, tiers in turn."""
        ready = []
        for size, windows in self.waiting.items():
            each = max(1, self.sizes.group_tokens // size)
            n = -(-len(windows) // each) if all_of_them else len(windows) // each
            if not n:
                continue
            now, self.waiting[size] = windows[: n * each], windows[n * each :]
            now.sort(key=lambda w: -sum(p.length**2 for p in w))
            dealt: list[list[list[Piece]]] = [[] for _ in range(n)]
            for i, window in enumerate(now):
                turn, place = divmod(i, n)
                dealt[place if turn % 2 == 0 else n - 1 - place].append(window)
            ready += [((i + 0.5) / n, -size, group) for i, group in enumerate(dealt)]
        ready.sort(key=lambda x: x[:2])
        return (group for _, _, group in ready)

    def _held(self) -> int:
        return sum(length * len(p) for length, p in self.shelf.by_length.items())

    def flush(self, last: bool = False) -> dict[str, list]:
        self._pack()
        if self._held() > self.sizes.block_tokens // 2:
            self._pack(own_tier=True)
        if last:
            self._close()
        self.tokens = self._held()
        out: dict[str, list] = {name: [] for name in [c.split()[0] for c in PIECES.split(", ")] + ["ids"]}
        for group in self._groups(last):
            for window in group:
                offset, size = 0, sum(p.length for p in window)
                for piece in window:
                    ids = piece.document.ids[piece.start : piece.start + piece.length]
                    row = (
                        piece.document.doc_id,
                        piece.start,
                        piece.length,
                        zlib.crc32(ids),
                        len(piece.document.ids),
                        self.first_id + self.sequences,
                        offset,
                        size,
                        self.first_id + self.groups,
                        ids,
                    )
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
                    offset += piece.length
                self.sequences += 1
            self.groups += 1
        return out


def pack_documents(
    docs: DataFrame,
    *,
    json_path: str | None = None,
    ranks_path: str | None = None,
    sizes: Sizes = Sizes(),
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents of (doc_id, text) and their places in packed sequences; `ids` too, if asked for.

    One pass without a shuffle: each task packs what it reads, so sequence ids are the task's number, times 2**40, and
    a counter, and a task that runs again numbers its sequences as before. Every sequence is exactly as long as its
    `tier`, a power of two, so nothing is padded. `step_group` names groups of sequences of one tier with the same
    number of tokens (the last of a task may have fewer) and about the same attention cost.

    NULL text is empty. An empty text is the end id alone. A NULL `doc_id` stays NULL, and every row is a document of
    its own, also when ids or rows repeat. Texts of any length are encoded whole. No rows give no rows.
    """
    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = PIECES + (", ids array<int>" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    kind = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(json_path, ranks_path)
        packer = Packer(sizes, TaskContext.get().partitionId() << 40)
        for batch in batches:
            # Row by row, or the texts of a batch would be there twice.
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc_id.as_py(), np.frombuffer(bpe.encode(text.as_py() or "") + end, "<u4"))
                if packer.tokens >= sizes.block_tokens:
                    yield record_batch(kind, packer.flush())
        yield record_batch(kind, packer.flush(last=True))

    return columns(docs, doc_id="long", text="string").mapInArrow(giving_back(run), schema)
