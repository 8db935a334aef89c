"""Token ids of Arrow text columns by a public tokenizer file, encoded once per distinct word.

A byte-level BPE file of the tokenizers library splits text into pieces that never run on from a
printed character into white space, so a text may be cut there and its parts encoded alone; the
result equals that of the whole text. Texts with white space beyond ASCII, where a run of mixed
spaces must stay together, are encoded whole. Words of plain letters and closing punctuation skip
the library's per-call work and go to its merge model directly.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa

from skyledger.llm.textscan import SPACES, flat_ranges, process_cache, text_column

# Words of a generation of the cache, and their bytes with those of their ids; two generations are kept.
KEPT_WORDS = 120_000
KEPT_BYTES = 8 << 20
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
PLAIN_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|#%&$*]*)")


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def version_of(path: str) -> str:
    """A digest of the tokenizer file and of the library that reads it."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


def letters_of_bytes() -> dict[int, str]:
    """The printable letter that stands for each byte: itself, or the next one free from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in own]
    return {byte: chr(byte) for byte in own} | {byte: chr(256 + place) for place, byte in enumerate(others)}


class WordEncoder:
    """Token ids of texts; ``path`` names the file by whose letters and rules they are split."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = letters_of_bytes()
        # Both kinds of file map bytes to letters; one keeps spaces and case, the other drops them.
        self.lower = self.tokenizer.normalizer is not None
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}
        self.held = 0

    def keep(self, part: bytes, ids: bytes) -> bytes:
        self.words[part] = ids
        self.held += len(part) + len(ids)
        return ids

    def turn(self, coming: int) -> None:
        """Lets go of the words that were not met since the last turn, if those to come need room."""
        if len(self.words) + coming > KEPT_WORDS or self.held > KEPT_BYTES:
            self.older, self.words, self.held = self.words, {}, 0
            self.pieces = {"": b""}

    def piece(self, text: str) -> bytes:
        """Ids of one piece that the splitting rule leaves whole."""
        known = self.pieces.get(text)
        if known is None:
            letters = text.encode().decode("latin-1").translate(self.letters)
            known = np.array([token.id for token in self.model.tokenize(letters)], dtype="<u4").tobytes()
            self.pieces[text] = known
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as the library gives them."""
        return [np.array(found.ids, dtype="<u4").tobytes() for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, part: bytes) -> bytes | None:
        """Ids of a part that is one plain word, else None."""
        text = part.decode()
        plain = PLAIN_WORD.fullmatch(text.strip(" \t\n\v\f\r").lower() if self.lower else text)
        return plain and self.piece(plain[1]) + self.piece(plain[2])

    def parts(self, distinct: list[bytes]) -> list[bytes]:
        """Ids of each part, from the cache where it has them."""
        self.turn(len(distinct))
        found = [self.words.get(part) for part in distinct]
        odd = []
        for place, ids in enumerate(found):
            if ids is None:
                part = distinct[place]
                ids = self.older.get(part)
                ids = self.word(part) if ids is None else ids
                if ids is None:
                    odd.append(place)
                else:
                    found[place] = self.keep(part, ids)
        for place, ids in zip(odd, self.encode([distinct[place].decode() for place in odd])):
            found[place] = self.keep(distinct[place], ids)
        return found

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Parts of all texts: index of each in the distinct ones, part offsets of the texts, ids of
        the distinct parts, and their number."""
        data, offsets = text_column(texts)
        raw = data.tobytes()
        starts = part_starts(data, offsets)
        if WIDE_SPACE.search(raw):
            whole = np.array([bool(WIDE_SPACE.search(raw[a:b])) for a, b in zip(offsets[:-1], offsets[1:])])
            inside = np.repeat(whole, np.diff(offsets))[starts]
            heads = np.zeros(len(data) + 1, dtype=bool)
            heads[offsets] = True
            starts = starts[~inside | heads[starts]]
        ends = np.append(starts, len(data)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        coded = parts.dictionary_encode()
        ids = self.parts(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        return coded.indices.to_numpy(), np.searchsorted(starts, offsets), ids, sizes

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        index, offsets, _, sizes = self.column(texts)
        return np.diff(np.concatenate(([0], np.cumsum(sizes[index])))[offsets])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and their offsets."""
        index, offsets, ids, sizes = self.column(texts)
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        before = np.cumsum(sizes) - sizes
        return flat[flat_ranges(before[index], sizes[index])], np.concatenate(([0], np.cumsum(sizes[index])))[offsets]


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts start, and where white space follows a printed character."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    space = np.zeros(256, dtype=bool)
    space[list(SPACES)] = True
    blank = space[data]
    marks = np.zeros(len(data), dtype=bool)
    marks[1:] = blank[1:] & ~blank[:-1]
    marks[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(marks)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a file, which its tasks share with its cache of words."""
    kept = process_cache("encoders")
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]
