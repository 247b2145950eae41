"""Secrets in texts and in what texts hold in encoded form, layer by layer."""

from __future__ import annotations

import binascii
import bz2
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from siltgate.llm.text import columns, encoded, giving_back, per_batch

# The kinds of secrets, in the order in which spans that start together are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};")
# A line end within base64, in mail also quoted, in string literals also as an escape.
_GAP = r"[\x20\t]*(?:\r\n?|\n|(?:\\r)?\\n)[\x20\t>]*"
_CODES = "[A-Za-z0-9+/_-]"
_LINE_END = re.compile(_GAP)
# Secrets, and what can hold them in encoded form, are ASCII; none has fewer than 14 characters (`token=` and eight),
# which are 19 in base64.
_BASE64 = re.compile(
    rf"(?<!{_CODES})(?:{_CODES}{{19,}}+(?:{_GAP}{_CODES}++)*+|{_CODES}++(?:{_GAP}{_CODES}++)++)={{0,2}}"
)
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
_READABLE = re.compile(rb"[\t\n\r\x20-\x7E]{14,}")
_UTF16 = re.compile(rb"(?:[\t\n\r\x20-\x7E]\x00){14,}|(?:\x00[\t\n\r\x20-\x7E]){14,}")
_ZLIB = [bytes([a, b]) for a in range(0x08, 0x79, 0x10) for b in range(256) if not ((a * 256 + b) % 31 or b & 32)]
_COMPRESSED = re.compile(rb"\x1F\x8B\x08|BZh[1-9]|\xFD7zXZ\x00|" + b"|".join(map(re.escape, _ZLIB)))
# Bytes of a compressed stream fed at once, bytes that the pieces of a long stream share, streams within streams.
FED, SHARED, NESTED = 1 << 16, 1 << 16, 50


@dataclass(frozen=True)
class Unwrapping:
    """Most characters of a compressed layer that are held at once, so that a small text cannot fill a task's memory.

    Longer layers are read in pieces that overlap, and counted in `n_skipped` as they are not read as one.
    """

    layer_chars: int = 16_000_000


@dataclass
class Layer:
    """A text and, for each of its characters, the span of the document it stands for."""

    text: str
    path: tuple[str, ...]
    left: np.ndarray
    right: np.ndarray
    cut: bool = False  # goes on in another piece
    unread: bool = False  # what is there could not be read


def findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets that stand in a text itself."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def _unescaped(match: str) -> str:
    if match.startswith("&#"):
        code = int(match[3:-1], 16) if match[2] in "xX" else int(match[2:-1])
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else match
    size = 6 if match[1] == "u" else 4
    units = [int(match[i + 2 : i + size], 16) for i in range(0, len(match), size)]
    if size == 4:
        return bytes(units).decode("latin-1")
    return b"".join(u.to_bytes(2, "big") for u in units).decode("utf-16-be", "replace")


def _inflated(data: memoryview, most: int) -> Iterator[bytes | int]:
    """What a compressed stream at the start of `data` holds, in parts of at most `most` bytes, then its length.

    The length is left out if the stream breaks off or has an error; what comes before that is given.
    """
    head = bytes(data[:1])
    plain = head not in (b"B", b"\xfd")
    stream = zlib.decompressobj(47) if plain else bz2.BZ2Decompressor() if head == b"B" else lzma.LZMADecompressor()
    fed, rest = 0, b""
    try:
        while not stream.eof:
            if not rest and (plain or stream.needs_input):
                rest = data[fed : fed + FED]
                fed += len(rest)
            last = not len(rest)
            made = stream.decompress(rest, most)
            rest = stream.unconsumed_tail if plain else b""
            if made:
                yield made
            elif last and (plain or stream.needs_input):
                return
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return
    yield fed - len(stream.unused_data) - len(rest)


class _Place:
    """The span of a layer that stands for bytes decoded from it."""

    def __init__(self, layer: Layer, at: np.ndarray | None, skip: int, end: int):
        self.layer, self.at, self.skip, self.end = layer, at, skip, end

    def spans(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left and right of pieces from byte `first` to before byte `last`."""
        if self.at is None:
            return tuple(np.broadcast_to(x[:1], len(first)) for x in (self.layer.left, self.layer.right))
        ends = np.minimum(self.skip + -(-last // 3) * 4, len(self.at)) - 1
        return self.layer.left[self.at[self.skip + first // 3 * 4]], self.layer.right[self.at[ends]]

    def whole(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Left and right of one piece, with the padding after it."""
        left, right = self.spans(np.array([first]), np.array([last]))
        if self.at is not None and self.skip + -(-last // 3) * 4 >= len(self.at):
            right = self.layer.right[self.end - 1 : self.end]
        return left, right


def _of_bytes(data: bytes, place: _Place, path: tuple[str, ...], most: int, cut: bool, above: tuple) -> Iterator[Layer | None]:
    """The readable stretches of bytes and the layers in the compressed streams among them."""
    for match in _READABLE.finditer(data):
        every = np.arange(*match.span())
        yield Layer(match[0].decode("ascii"), path, *place.spans(every, every + 1), cut and match.end() == len(data))
    if b"\x00" in data:
        for match in _UTF16.finditer(data):
            every = np.arange(match.start(), match.end(), 2)
            text = match[0].replace(b"\x00", b"").decode("ascii")
            yield Layer(text, path, *place.spans(every, every + 2), cut and match.end() >= len(data) - 1)
    at, inside = 0, (*path, "compressed")
    while match := _COMPRESSED.search(data, at):
        start, at = match.start(), match.start() + 1
        held, many, end = b"", False, None
        # Where the stream ends is known only afterwards; up to then it may be all the bytes that follow.
        one = _Place(Layer("", inside, *place.whole(start, len(data))), None, 0, 0)
        for made in _inflated(memoryview(data)[start:], most):
            if isinstance(made, int):
                end = start + made
                break
            held += made
            if len(held) > most:
                if not many:
                    yield None
                many = True
                yield from _of_stream(held, one, inside, most, True, above)
                held = held[-min(SHARED, most // 2) :]
        if end is not None:
            at = max(at, end)
            one = _Place(Layer("", inside, *place.whole(start, end)), None, 0, 0)
        elif cut and (held or many):
            yield Layer("", inside, one.layer.left, one.layer.right, unread=True)
        if held:
            yield from _of_stream(held, one, inside, most, False, above)


def _of_stream(data: bytes, place: _Place, path: tuple[str, ...], most: int, cut: bool, above: tuple) -> Iterator[Layer | None]:
    """As `_of_bytes`, but for streams that hold themselves."""
    mark = xxhash.xxh3_128_digest(data)
    if mark in above:
        return
    if len(above) == NESTED:
        yield Layer("", path, place.layer.left, place.layer.right, unread=True)
        return
    yield from _of_bytes(data, place, path, most, cut, (*above, mark))


def _of_base64(layer: Layer, match: re.Match, most: int) -> Iterator[Layer | None]:
    """The layers in a run of base64, read from each of its first four characters on.

    So it does not matter what stands before the code in the run, and what stands after it spoils its own bytes only.
    """
    run, start = match[0].rstrip("="), match.start()
    parts, at = [], 0
    for gap in _LINE_END.finditer(run):
        parts.append((at, gap.start()))
        at = gap.end()
    parts.append((at, len(run)))
    code = "".join([run[a:b] for a, b in parts]).encode("ascii").translate(_URL_SAFE)
    if len(code) < 19:
        return
    places = np.concatenate([np.arange(start + a, start + b) for a, b in parts])
    cut = layer.cut and match.end() == len(layer.text)
    for skip in range(4):
        whole = len(code) - ((len(code) - skip) % 4 == 1)
        data = binascii.a2b_base64(code[skip:whole] + b"=" * (-(whole - skip) % 4))
        yield from _of_bytes(data, _Place(layer, places[:whole], skip, match.end()), (*layer.path, "base64"), most, cut, ())


def _replaced(layer: Layer, start: int, end: int, pattern: re.Pattern, name: str) -> Layer | None:
    """The line from `start` to `end` with what `pattern` finds decoded."""
    parts, left, right, at, changed = [], [], [], start, False
    for match in pattern.finditer(layer.text, start, end):
        if name == "url":
            new = binascii.unhexlify(match[0].replace("%", "")).decode("utf-8", "replace")
        else:
            new = _unescaped(match[0])
        if new == match[0]:
            continue
        a, b = match.span()
        parts += [layer.text[at:a], new]
        left += [layer.left[at:a], np.full(len(new), layer.left[a])]
        right += [layer.right[at:a], np.full(len(new), layer.right[b - 1])]
        at, changed = b, True
    if not changed:
        return None
    parts.append(layer.text[at:end])
    left.append(layer.left[at:end])
    right.append(layer.right[at:end])
    cut = layer.cut and end == len(layer.text)
    return Layer("".join(parts), (*layer.path, name), np.concatenate(left), np.concatenate(right), cut)


def _lines_with(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Spans of the lines in which `pattern` is found. No secret reaches across lines."""
    at = 0
    while match := pattern.search(text, at):
        start = text.rfind("\n", 0, match.start()) + 1
        end = text.find("\n", match.end())
        end = len(text) if end < 0 else end
        yield start, end
        at = end


def _decoded(layer: Layer, most: int) -> Iterator[Layer | None]:
    """The layers below a layer; None before the pieces of one that is too long for one piece."""
    if "%" in layer.text:
        for start, end in _lines_with(_PERCENT, layer.text):
            if made := _replaced(layer, start, end, _PERCENT, "url"):
                yield made
    if "\\" in layer.text or "&#" in layer.text:
        for start, end in _lines_with(_ESCAPE, layer.text):
            if made := _replaced(layer, start, end, _ESCAPE, "unicode"):
                yield made
    for match in _BASE64.finditer(layer.text):
        yield from _of_base64(layer, match, most)


def scan(text: str, how: Unwrapping) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], int, int]:
    """Secrets of the text itself, secrets of its layers, layers read and layers read in pieces.

    The work ends when no layer gives a new one. A layer seen before, by its text and place, is not read again. Layers
    are read in depth, so that of a long one a single piece is held. What cannot be read is listed as `unread~…`.
    """
    base = findings(text)
    added: set[tuple[int, int, str]] = set()
    known = set(base)
    places = np.arange(len(text), dtype=np.int64)
    work, seen, layers, skipped = [_decoded(Layer(text, (), places, places + 1), how.layer_chars)], set(), 0, 0
    while work:
        layer = next(work[-1], done := object())
        if layer is done:
            work.pop()
            continue
        if layer is None:
            skipped += 1
            continue
        if layer.unread:
            added.add((int(layer.left[0]), int(layer.right[-1]), f"unread~{'+'.join(layer.path)}"))
            continue
        if not layer.text:
            continue
        key = (xxhash.xxh3_128_digest(encoded(layer.text)), int(layer.left[0]), int(layer.right[-1]))
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        work.append(_decoded(layer, how.layer_chars))
        for start, end, kind in findings(layer.text):
            span = (int(layer.left[start]), int(layer.right[end - 1]))
            if (*span, kind) not in known:
                added.add((*span, f"{kind}~{'+'.join(layer.path)}"))
    return base, sorted(added, key=lambda s: (s[0], s[2], s[1])), layers, skipped


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with each run of spans that touch or overlap replaced by one mark."""
    parts, at, reach = [], 0, -1
    for start, end, _ in sorted(spans):
        if start > reach:
            parts += [text[max(at, reach, 0) : start], mark]
        reach = max(reach, end)
        at = reach
    return "".join([*parts, text[at:]])


def _listed(spans: list[tuple[int, int, str]]) -> str:
    order = {kind: i for i, kind in enumerate(BASE_KINDS)}
    ranked = sorted(spans, key=lambda s: (s[0], order.get(s[2], len(order)), s[2], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ranked)


def _scan(how: Unwrapping):
    def work(ids: list, marks: list, texts: list) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": ids, "mark": marks}
        names = ("n_assign", "n_access", "n_hex", "base_spans", "spans", "n_layers", "n_skipped", "redacted")
        rows = []
        for text in texts:
            base, added, layers, skipped = scan(text or "", how)
            numbers = [sum(s[2] == kind for s in base) for kind in BASE_KINDS]
            spans = [*base, *added]
            safe = redacted(text, spans) if spans else text
            rows.append((*numbers, _listed(base), _listed(spans), layers, skipped, safe))
        return out | {name: [r[i] for r in rows] for i, name in enumerate(names)}

    return work


def scan_secrets(docs: DataFrame, how: Unwrapping = Unwrapping()) -> DataFrame:
    """Each row of (doc_id, text) with the secrets in it: counts, spans, and the text without them; mark is its xxhash64.

    `base_spans` are those of the text itself; `spans` adds those found after decoding URL and Unicode escapes,
    base64 and compressed streams, in any nesting, named `kind~layer+layer…` and given by the place in the document
    that the decoded characters come from. Spans are `kind:start:end` in code points, end exclusive, by start and then
    kind. `redacted` is the text with every span replaced by a mark.

    NULL text has no secrets, empty lists and NULL as `redacted`. Rows that repeat are scanned each, ids are passed
    on, NULL too. Texts are scanned whole. Base64 is read from any place of a run, over line ends, and of bytes that
    are no text every stretch of at least 14 readable characters, UTF-16 too. `n_skipped` counts compressed layers
    over the bound of `Unwrapping`, which are read in pieces; a stream inside one that goes over the end of a piece is
    read up to there and listed as `unread~layer…`, and masked.
    """
    texts = columns(docs, doc_id="long", text="string")
    return per_batch(
        texts.select("doc_id", F.xxhash64("text").alias("mark"), "text"),
        "doc_id long, mark long, n_assign long, n_access long, n_hex long, base_spans string, spans string, n_layers long,"
        " n_skipped long, redacted string",
        lambda: _scan(how),
    )


def mask_secrets(docs: DataFrame, how: Unwrapping = Unwrapping()) -> DataFrame:
    """The rows of `docs`, all columns as they are, but secrets in `text` replaced by a mark.

    Where that changes the text, `n_chars` is counted anew. One pass without a shuffle. NULL and empty texts, repeated
    rows, NULL ids and further columns of any type pass as they are.
    """
    kind = to_arrow_schema(docs.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = batch.column("n_chars").to_pylist()
            for i, text in enumerate(texts):
                base, added, _, _ = scan(text or "", how)
                if base or added:
                    texts[i] = redacted(text, [*base, *added])
                    counts[i] = len(texts[i])
            new = {"text": texts, "n_chars": counts}
            made = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in kind]
            yield pa.RecordBatch.from_arrays(made, schema=kind)

    return docs.mapInArrow(giving_back(run), docs.schema)
