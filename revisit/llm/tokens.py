"""Token ids of texts with a public tokenizer file, each distinct piece looked up once per group of texts.

Both supported kinds of tokenizer cut a text at white space, and between a letter and a mark, before they merge
anything, so the ids of a text are those of its pieces one after the other. Texts are taken in groups of some
million characters: Arrow cuts them and numbers their distinct pieces, the parts of these are looked up in a
bounded table, only new ones are given to the tokenizers library, and the ids are dealt out by piece numbers.
Texts with characters on whose white-space class Python and the library may differ are given to the library
whole, as are texts with the string of a special token, which the library makes that token, and all texts if
the file cuts texts in any other way.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Control separators and white space beyond ASCII.
_ODD_LATIN = "\x1c\x1d\x1e\x1f\x85\xa0"
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u0300-\u036f\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
#: Leading white space belongs to a word's piece.
_SPACED = re.compile(r"\s*\S+|\s+")
#: Marks that end a word; not the apostrophe, which may belong to it.
_MARKS = ".,;:!?*#$%&|<>()[]{}-+=/\""
#: A string that ends in a letter below U+0100.
_LATIN_END = r"[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]\z"
#: In front of a key: the piece has no space before it.
_BARE = "\0"
#: How a text is cut: by Arrow, by a pattern, or not at all.
_PLAIN, _LOOSE, _WHOLE = range(3)


def _byte_characters() -> dict[int, str]:
    """The character by which byte-level merges write each byte: itself if it can be seen, else the next from 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTES = _byte_characters()


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


#: How the two supported kinds of files cut texts: spaced, and words alone.
_SPACED_CUTS = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
_WORD_CUTS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
)


def _strings(column: pa.Array) -> list[str | None]:
    """to_pylist() of strings, without a scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _dealt(ids: np.ndarray, n: np.ndarray, codes: np.ndarray, step: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """The ids of entries `codes` one after the other, and where each ends. n: ids of each entry, which lie in order."""
    first, much = np.cumsum(n) - n, n[codes]
    ends, parts = np.cumsum(much), [ids[:0]]
    for lo in range(0, len(codes), step):
        some = slice(lo, lo + step)
        begin = ends[some] - much[some]
        at = np.arange(begin[0], ends[some][-1])
        at += np.repeat(first[codes[some]] - begin, much[some])
        parts.append(ids[at])
    return np.concatenate(parts), ends


@dataclass(frozen=True)
class Room:
    """What an encoding worker may hold: keys of each generation of its table, and characters of a group of texts.

    Less room costs time, not ids: more parts are learned again, and fewer pieces of a group are alike.
    """

    most: int = 600_000
    together: int = 4 << 20


class Encoder:
    """Ids of texts. spaced: the tokenizer keeps white space, in front of words.

    A key is a word: with the space before it if spaced, else alone. Other pieces have a mark in front. The
    table has two generations of `most` keys of pieces' parts; what is used moves to the newer one.
    """

    def __init__(self, path: str, spaced: bool, most: int = Room.most, longest: int = 40):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        file = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in file["added_tokens"]]
        #: Whether pieces may be encoded one by one.
        self.by_pieces = (file["normalizer"], file["pre_tokenizer"]) == (_SPACED_CUTS if spaced else _WORD_CUTS)
        self.by_pieces &= file["model"]["type"] == "BPE" and not any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"])
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() < 65536 else np.dtype("<u4")
        self.spaced, self.most, self.longest = spaced, most, longest
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, keys: list[str]) -> list[bytes]:
        """The library's ids of keys. A run of letters is one piece for it, and can go to its merges at once."""
        kind, out, rest, merges = "H" if self.dtype.itemsize == 2 else "I", {}, [], self.model.tokenize
        before = " " if self.spaced else ""
        for key in keys:
            bare = key[:1] == _BARE
            word = key[1:] if bare else key
            if not self.by_pieces:
                rest.append(key)
                continue
            if word.isascii() and word.isalpha():
                # Such letters stand for themselves; only a space is written in another way.
                said = word.lower() if not self.spaced else word if bare else _BYTES[32] + word
            elif word.isalpha() and max(word) < "\u0100":
                said = ((before if not bare else "") + (word if self.spaced else word.lower())).encode().decode("latin-1").translate(_BYTES)
            else:
                rest.append(key)
                continue
            out[key] = array(kind, [x.id for x in merges(said)]).tobytes()
        if rest:
            texts = [x[1:] if x[:1] == _BARE else " " + x if self.spaced else x for x in rest]
            out.update(zip(rest, self._whole(texts)))
        return [out[key] for key in keys]

    def _whole(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.dtype.itemsize == 2 else "I"
        return [array(kind, x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _kind(self, text: str) -> int:
        if not text:
            return _PLAIN
        if not self.by_pieces or any(x in text for x in self.special):
            return _WHOLE
        if _BARE in text or (any(c in text for c in _ODD_LATIN) if _latin(text) else _ODD.search(text)):
            return _WHOLE
        # Only single spaces and line feeds: cut at spaces, and in front of line feeds.
        if self.spaced and any(x in text for x in ("\t", "\r", "\x0b", "\x0c", "  ", "\n\n", " \n", "\n ")):
            return _LOOSE
        return _PLAIN

    def _plain(self, texts: list[str]) -> pa.Array:
        """The keys of each text's pieces, as lists."""
        if not self.spaced:
            return pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        marked = pa.array([_BARE + x for x in texts], pa.large_string())
        return pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")

    def _loose(self, texts: list[str]) -> pa.Array:
        return pa.array([[_BARE + x for x in _SPACED.findall(text)] for text in texts], pa.list_(pa.large_string()))

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of parts, from the table or learned."""
        known, old = self.known, self.old
        out = list(map(known.get, parts))
        learned = {key: old.get(key) for key, ids in zip(parts, out) if ids is None}
        if not learned:
            return out
        new = [key for key, ids in learned.items() if ids is None]
        learned.update(zip(new, self._encode(new)))
        out = [learned[key] if ids is None else ids for key, ids in zip(parts, out)]
        if len(known) + len(learned) > self.most:
            self.known, self.old = {}, known
        self.known.update((key, ids) for key, ids in learned.items() if len(key) <= self.longest)
        return out

    def _pieces(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct keys one after the other, and how many each has.

        The tokenizer always cuts behind a line feed in front, and between a letter and marks at the end.
        """
        head = pc.starts_with(keys, "\n")
        body = pc.if_else(head, pc.binary_replace_slice(keys, 0, 1, _BARE), keys)
        core = pc.ascii_rtrim(body, _MARKS)
        cut = pc.and_(pc.less(pc.binary_length(core), pc.binary_length(body)), pc.match_substring_regex(core, _LATIN_END))
        stem = pc.if_else(cut, core, body).dictionary_encode()
        ends = zip(_strings(body.filter(cut)), pc.utf8_length(core.filter(cut)).to_numpy().tolist())
        tail = pa.array([_BARE + x[at:] for x, at in ends], pa.large_string()).dictionary_encode()
        stems, tails = _strings(stem.dictionary), _strings(tail.dictionary)
        known = self._known([*stems, *tails, _BARE + "\n", _BARE])
        # Up to three parts for each key; _BARE has no ids.
        parts = np.full((len(keys), 3), len(known) - 1)
        parts[head.to_numpy(zero_copy_only=False), 0] = len(known) - 2
        parts[:, 1] = stem.indices
        parts[cut.to_numpy(zero_copy_only=False), 2] = tail.indices.to_numpy() + len(stems)
        n = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        ids, ends = _dealt(np.frombuffer(b"".join(known), self.dtype), n, parts.ravel())
        return ids, np.diff(ends[2::3], prepend=0)

    def _cut(self, lists: pa.Array) -> Iterator[np.ndarray]:
        """The ids of texts, of whose pieces the keys are given as lists."""
        found = lists.values.dictionary_encode()
        ids, ends = _dealt(*self._pieces(found.dictionary), found.indices.to_numpy())
        at = np.concatenate([[0], ends])[lists.offsets.to_numpy()].tolist()
        return (ids[lo:hi] for lo, hi in zip(at, at[1:]))

    def _group(self, texts: list[str]) -> Iterator[np.ndarray]:
        kinds = [self._kind(x) for x in texts]
        some: list[list[str]] = [[], [], []]
        for kind, text in zip(kinds, texts):
            some[kind].append(text)
        whole = (np.frombuffer(x, self.dtype) for x in (self._whole(some[_WHOLE]) if some[_WHOLE] else ()))
        ids = [self._cut(cut(x)) if x else iter(()) for cut, x in ((self._plain, some[_PLAIN]), (self._loose, some[_LOOSE]))] + [whole]
        return (next(ids[kind]) for kind in kinds)

    def encode(self, texts: Iterable[str | None], together: int = Room.together) -> Iterator[np.ndarray]:
        """The ids of each text in turn; null texts are empty. together: characters of a group, its last text may go beyond."""
        some: list[str] = []
        size = 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1]) + 64
            if size >= together:
                yield from self._group(some)
                some, size = [], 0
        yield from self._group(some)


_encoders: dict[tuple[str, bool, int], Encoder] = {}


def column_texts(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """A column's texts, some rows at a time."""
    for lo in range(0, len(column), rows):
        yield from _strings(column.slice(lo, rows))


def encoder(path: str, spaced: bool, most: int = Room.most) -> Encoder:
    """This worker's encoder; it stays for the worker's later tasks."""
    if (path, spaced, most) not in _encoders:
        _encoders[path, spaced, most] = Encoder(path, spaced, most)
    return _encoders[path, spaced, most]
