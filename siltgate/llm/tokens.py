"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
import re

import numpy as np
import public_tokenizers
import tiktoken

# Texts in which a space may stand within or beside other white space are encoded as a whole.
_ODD_SPACE = re.compile(r"\s\x20(?:\s|\Z)")
REMEMBERED_CHUNKS = 200_000
# Fixed value: the only string that the vocabulary treats as special.
SPECIAL = "<|endoftext|>"


class ByteBpe:
    """Ids as `tokenizers` gives them for the JSON file, without special tokens added.

    Its pre-tokenizer never lets a token reach across a single space that stands between other characters, so texts are
    cut there and each chunk is encoded once per task, from the same vocabulary in its rank form, which is several
    times faster. A text that holds the string of the special token goes through `tokenizers` itself.
    """

    def __init__(self, json_path: str, ranks_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        self._json_path, self._whole = json_path, None
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._ranks = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._chunks: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self._ranks.encode_ordinary(text), "<u4").tobytes()

    def _by_tokenizers(self, text: str) -> bytes:
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._json_path)
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if SPECIAL in text:
            return self._by_tokenizers(text)
        if "\x20\x20" in text or _ODD_SPACE.search(text):
            return self._encode(text)
        first, *rest = text.split("\x20")
        known = self._chunks
        if len(known) > REMEMBERED_CHUNKS:
            known.clear()
        for chunk in set(rest).difference(known):
            known[chunk] = self._encode("\x20" + chunk)
        return self._encode(first) + b"".join(map(known.__getitem__, rest))
