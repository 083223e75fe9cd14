"""Byte-level BPE by the tokenizers library, one distinct piece of text at a time.

A text is cut into pieces by the vocabulary's pattern. The library's BPE model encodes each
distinct piece once; the ids are kept, as little-endian 32-bit integers, in a bounded cache of the
worker. Byte-level models write each byte as one printable character, so a piece is mapped byte by
character before it is encoded, and decoding reverses that table.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer
from tokenizers.models import BPE

#: Fixed value: the pattern of the public byte-level vocabularies.
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Letters, digits and white space below U+0250, where the pattern runs without a Unicode table.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_BLANKS = "\\t-\\r \u0085\u00a0"
_ALL_BLANKS = _BLANKS + "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BEYOND = re.compile("[^\\x00-\u024f]")
_NEAR = re.compile(
    f" ?[{_LETTERS}]+| ?[{_NUMBERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
    f"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)


def splitter(pattern: str = GPT2_PATTERN) -> Callable[[str], list[str]]:
    """The function that cuts a text into pieces. White space is Unicode's, as in the libraries."""
    general = regex.compile(pattern.replace(r"[^\s", f"[^{_ALL_BLANKS}").replace(r"\S", f"[^{_ALL_BLANKS}]").replace(r"\s", f"[{_ALL_BLANKS}]")).findall
    if pattern != GPT2_PATTERN:
        return general
    near, beyond = _NEAR.findall, _BEYOND.search

    def split(text: str) -> list[str]:
        return near(text) if text.isascii() or not beyond(text) else general(text)

    return split


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next free one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    stand_in = {b: 256 + k for k, b in enumerate(hidden)}
    return [chr(stand_in.get(b, b)) for b in range(256)]


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts that each token of a rank file is merged from, in rank order.

    A token is rebuilt from its bytes by the merges of lower rank; the last two parts left are the
    pair that its own rank stands for.
    """
    found = []
    for token, own in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], own))
            if ranks.get(parts[best] + parts[best + 1], own) >= own:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            found.append((parts[0], parts[1]))
    return found


class _Cache(dict):
    """Ids of pieces by piece. The first ``most`` pieces stay; after many misses it begins anew."""

    def __init__(self, make: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.make, self.most, self.misses = make, most, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(self) >= self.most:
            self.misses += 1
            if self.misses > 4 * self.most:  # other texts than those it began with
                self.clear()
                self.misses = 0
            return ids
        self[piece] = ids
        return ids


class ByteLevelBpe:
    """Encoder and decoder of one vocabulary, given as the content of its file.

    ``content`` is a rank file (lines of base64 token and rank) or a tokenizer file (JSON). With
    ``added`` the added tokens of a tokenizer file are tokens wherever a text has their strings, as
    in the library; else those strings are ordinary text. A rank file has no added tokens.
    """

    def __init__(self, content: bytes, pattern: str = GPT2_PATTERN, most_pieces: int = 120_000, added: bool = False) -> None:
        self.split = splitter(pattern)
        self.characters = byte_characters()
        self.content = content
        self.added = self._added_tokens() if added and self._is_json else {}
        # The longest of those that start in one place is taken.
        self._cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._map, self._space = dict(enumerate(self.characters)), self.characters[32]
        self._cache = _Cache(self._encode_piece, most_pieces)

    @cached_property
    def _ranks(self) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.content.splitlines()) if a}

    @property
    def _is_json(self) -> bool:
        return self.content.lstrip()[:1] == b"{"

    def _added_tokens(self) -> dict[str, int]:
        found = Tokenizer.from_str(self.content.decode()).get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in found.values()):
            raise ValueError("added tokens that take in their surroundings are not supported")
        return {t.content: i for i, t in found.items() if t.content}

    @cached_property
    def model(self) -> BPE:
        """The library's model; only encoding needs it."""
        if self._is_json:
            return Tokenizer.from_str(self.content.decode()).model
        pairs = [(self.shown(a), self.shown(b)) for a, b in merges_of(self._ranks)]
        return BPE({self.shown(token): rank for token, rank in self._ranks.items()}, pairs, ignore_merges=True)

    def shown(self, data: bytes) -> str:
        return "".join(map(self.characters.__getitem__, data))

    def _encode_piece(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalnum():  # printable but for the space before a word
            mapped = self._space + piece[1:] if piece[0] == " " else piece
        else:
            mapped = piece.encode().decode("latin-1").translate(self._map)
        ids = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self._cut is None or not self._cut.search(text):
            return b"".join(map(self._cache.__getitem__, self.split(text)))
        parts, at = [], 0
        for match in self._cut.finditer(text):
            parts += map(self._cache.__getitem__, self.split(text[at : match.start()]))
            parts.append(struct.pack("<I", self.added[match[0]]))
            at = match.end()
        return b"".join([*parts, *map(self._cache.__getitem__, self.split(text[at:]))])

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; ids that no token has are empty."""
        if not self._is_json:
            found = {rank: token for token, rank in self._ranks.items()}
        else:
            reverse = {c: b for b, c in enumerate(self.characters)}
            tokens = Tokenizer.from_str(self.content.decode()).get_vocab(with_added_tokens=False)
            found = {i: bytes(reverse[c] for c in t) if all(c in reverse for c in t) else t.encode() for t, i in tokens.items()}
            found |= {i: t.encode() for t, i in self.added.items()}
        return [found.get(i, b"") for i in range(max(found, default=-1) + 1)]

    @cached_property
    def token_lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.token_bytes], dtype=np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids. A character whose bytes are split over tokens is whole again in them."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))

    def offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Code point in which each token starts; tokens that share a split character start in the same."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.token_lengths[ids])
        return character[ends - self.token_lengths[ids]] if len(ids) else np.zeros(0, dtype=np.int64)


class WordBpe:
    """Encoder of a word-end BPE vocabulary (lower case, white space dropped), one distinct piece at a time.

    ``content`` is a tokenizer file (JSON) that lower-cases and cuts text into
    ``'s|'t|'re|'ve|'m|'ll|'d|[letters]+|[digit]|[others]+``. No piece holds white space. Texts with
    characters from U+0180 on, or with strings of added tokens, are given to the library whole. Of
    many texts Arrow lower-cases and cuts all at once into words, and the distinct words into pieces;
    each distinct piece of them is looked up once, and encoded by the library's model if it is new.
    """

    def __init__(self, content: bytes, most_words: int = 250_000) -> None:
        self.whole = Tokenizer.from_str(content.decode())
        self.model = self.whole.model
        # Letters are what is left between the pieces of any other kind.
        apart = f"'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
        self.split = re.compile(f"[{_LETTERS}]+|{apart}").findall
        self._apart = f"({apart})"
        added = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values() if t.content]
        # Dotted capital I becomes two characters in lower case; Python alone takes 1C to 1F as white space.
        self._for_library = "|".join(["[^\\x00-\\x1b\\x20-\u012f\u0131-\u017f]", *added])
        self._whole = re.compile(self._for_library).search
        self._map = dict(enumerate(byte_characters()))
        self._cache = _Cache(self._encode_piece, most_words)

    def _encode_piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self._map)
        ids = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers, without special tokens around it."""
        if self._whole(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self._cache.__getitem__, self.split(text.lower())))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as :meth:`encode` gives them."""
        given = pa.array(texts, pa.large_string())
        whole = pc.match_substring_regex(given, self._for_library)
        apart = {i: self.encode(texts[i]) for i in pc.indices_nonzero(whole).to_pylist()}
        words = pc.utf8_split_whitespace(pc.utf8_lower(pc.if_else(whole, "", given)))
        found = words.flatten().dictionary_encode()
        # No word holds a line end; the empty pieces that cutting leaves have no ids.
        cut = pc.split_pattern(pc.replace_substring_regex(found.dictionary, self._apart, "\n\\1\n"), "\n")
        pieces = cut.flatten().dictionary_encode()
        known = pa.array(list(map(self._cache.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist())), pa.large_binary())
        of_words = _joined(known.take(pieces.indices), cut)
        of_texts = _joined(of_words.take(found.indices), words)
        return [np.frombuffer(apart.get(i, ids), dtype="<u4") for i, ids in enumerate(of_texts.to_pylist())]


def _joined(parts: pa.Array, lists: pa.ListArray) -> pa.Array:
    """The ids of each list, ``parts`` being those of the lists' elements one after the other."""
    starts = pc.subtract(lists.offsets, lists.offsets[0]).to_numpy()
    offsets = np.frombuffer(parts.buffers()[1], dtype=np.int64)[starts + parts.offset]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(offsets), parts.buffers()[2]])
