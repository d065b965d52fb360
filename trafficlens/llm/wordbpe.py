"""Token ids of the word-level BPE, whitespace-separated chunk by chunk.

This tokenizer drops white space and never merges across it, so a text's ids
are the ids of its chunks in turn (special tokens' strings hold no white space
and stay inside a chunk). A chunk is a run of bytes outside
``[\\x20\\x09-\\x0D]``; Unicode white space inside one is left to the library.

A new chunk of plain Latin characters is cut into pre-tokens here and each
pre-token is merged by the library's model; any other chunk goes to the library
whole, and so does every chunk if the file's rules aren't those known here."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np

from .chunktable import ChunkTable
from .slot import held
from .textbatch import Words

MEMORY_PIECES = 100_000
# Fixed value: the pre-token rule of the tokenizer file that the cutting below follows.
RULE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_TOKENIZERS: dict = {}


def library(path: str):
    """The tokenizer at ``path``, loaded once in each worker."""
    if path not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte:
    printable Latin-1 bytes for themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_PLAIN = re.compile("[!-~¡-ſ]+")
_LATIN = [chr(c) for c in range(0x21, 0x180) if not 0x7f <= c <= 0xa0]


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == kind)


_CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^{_class('L')}{_class('N')}]+")
_SYMBOLS = {i: s for i, s in enumerate(byte_symbols())}


class Pieces:
    """Cuts chunks into pre-tokens and keeps what ``merge`` gives for each."""

    def __init__(self, path: str, merge: Callable, memory: int = MEMORY_PIECES):
        self.t, self.merge, self.memory, self.known = library(path), merge, memory, {}
        spec = json.loads(self.t.to_str())
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or []]
        self.rules_known = (split[0].get("pattern") == {"Regex": RULE} and kinds == ["NFC", "Replace", "Lowercase"]
                            and all("<|" in a["content"] for a in spec["added_tokens"]))

    def cut(self, chunk: str) -> list[str] | None:
        """The pre-tokens of a plain chunk in the vocabulary's letters, or None."""
        if not self.rules_known or "<|" in chunk or not _PLAIN.fullmatch(chunk):
            return None
        chunk = chunk.lower()
        if chunk.isascii():
            return _CUT.findall(chunk)
        if not _PLAIN.fullmatch(chunk):
            return None
        return [p.encode().decode("latin-1").translate(_SYMBOLS) for p in _CUT.findall(chunk)]

    def of(self, piece: str):
        got = self.known.get(piece)
        if got is None:
            got = self.merge(piece)
            if len(self.known) < self.memory:
                self.known[piece] = got
        return got


class WordEncoder:
    """``block(data, offsets)`` gives (ids, first): all ids of a block of texts
    and the limits of each text among them."""

    def __init__(self, path: str):
        model = library(path).model
        self.pieces = Pieces(path, lambda p: np.array([x.id for x in model.tokenize(p)], dtype="<u4").tobytes())
        self.table = ChunkTable(self._compute, 300_000)

    def _compute(self, chunks: list[bytes]) -> list[bytes]:
        out: list = []
        for raw in chunks:
            cut = self.pieces.cut(text := raw.decode())
            out.append(b"".join(map(self.pieces.of, cut)) if cut is not None else text)
        at = [i for i, x in enumerate(out) if isinstance(x, str)]
        for i, e in zip(at, self.pieces.t.encode_batch([out[i] for i in at], add_special_tokens=False) if at else []):
            out[i] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = Words(data, offsets)
        first, size, values = self.table.lookup(data, words.start, words.end)
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.table.expand(first, size, values), ends[words.first]


def encoder(path: str) -> WordEncoder:
    return held(("word ids", path), lambda: WordEncoder(path))
