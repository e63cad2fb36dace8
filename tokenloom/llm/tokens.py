"""Token ids of whole texts with a word cache."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np

#: What the tokenizer makes of a lower-case ASCII piece before it looks at its vocabulary.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def _byte_signs() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: itself if visible, else the next free one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in seen else next(others)) for b in range(256)}


_SIGNS = _byte_signs()


class _Codes(dict):
    """Word -> number; unseen words get the next number and wait in ``todo``."""

    def __init__(self):
        super().__init__()
        self.todo: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.todo.append(word)
        return code


def _lowered(text: str) -> str:
    """Lower case where that cannot change an id: Latin-1 (no composition, no context) without special tokens."""
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def _letters(word: str) -> bool:
    """Letters only, also as the tokenizer sees them: some capitals become a letter and a mark, which joins a sign behind it."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


def _check_kind(path: str) -> None:
    """Refuses a file whose tokenizer isn't of the kind that may be cut at white space."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    steps = lambda part, key: [p["type"] for p in (made[part] or {}).get(key, [])]
    if steps("normalizer", "normalizers") != ["NFC", "Replace", "Lowercase"] or steps("pre_tokenizer", "pretokenizers") != ["Split", "ByteLevel"]:
        raise ValueError(f"{path}: not a lower-casing word tokenizer that drops white space")


class WordTokenizer:
    """Ids of a lower-casing word BPE tokenizer, as ``tokenizers`` gives them for whole texts.

    Its tokens never cross white space, so texts are cut at spaces and line feeds, every distinct piece
    is encoded once, and its ids are remembered for up to about ``limit`` pieces. Made for files whose
    tokenizer drops white space, lowers case and splits letters from signs (tests compare the ids).
    """

    def __init__(self, path: str, limit: int = 1 << 19):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _check_kind(path)
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self._reset()

    def _reset(self) -> None:
        self.codes = _Codes()
        self.codes[""] = 0
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.counts = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _room(self) -> None:
        while len(self.codes) > len(self.starts):
            self.starts, self.counts = (np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.counts))

    def _store(self, codes: list[int], ids: np.ndarray, counts: np.ndarray) -> None:
        """The ids of the pieces ``codes``, one piece after the other."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.counts[codes] = counts
        self.starts[codes] = self.used + np.cumsum(counts) - counts
        self.used += len(ids)

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces ``codes`` in one array, and how many ids come before the end of each piece."""
        counts = self.counts[codes]
        after = np.cumsum(counts)
        return self.flat[np.arange(int(after[-1]) if len(after) else 0) + np.repeat(self.starts[codes] - (after - counts), counts)], after

    def _learn(self) -> None:
        """Ids of the pieces in ``todo``: words of Latin-1 letters by the model alone, ASCII pieces by their parts, a word with one
        comma or full stop as its word and the sign, others by the whole tokenizer."""
        todo, codes, tokenize = self.codes.todo, self.codes, self.tokenizer.model.tokenize
        if not todo:
            return
        plain, ids, ends = [], [], [0]
        slow, joined, parts = [], [], []
        for k, piece in enumerate(todo, len(codes) - len(todo)):  # grows while it is read: parts join at its end
            if piece.isalpha():
                if piece.isascii() and piece.islower():
                    ids += [t.id for t in tokenize(piece)]
                elif piece.islower() and max(piece) <= "\xff":
                    ids += [t.id for t in tokenize(piece.encode().decode("latin-1").translate(_SIGNS))]
                else:
                    slow.append((k, piece))
                    continue
                plain.append(k)
                ends.append(len(ids))
            elif piece[-1] in ",." and _letters(piece[:-1]):
                joined.append((k, 2))
                parts += codes[piece[:-1]], codes[piece[-1]]
            elif piece.isascii() and piece.isprintable() and "<|" not in piece and len(found := _PARTS.findall(piece.lower())) > 1:
                joined.append((k, len(found)))
                parts += [codes[part] for part in found]
            else:
                slow.append((k, piece))
        self._room()
        self._store(plain, np.array(ids, np.uint32), np.diff(ends))
        for lo in range(0, len(slow), 4096):
            chosen = slow[lo : lo + 4096]
            found = [e.ids for e in self.tokenizer.encode_batch_fast([piece for _, piece in chosen], add_special_tokens=False)]
            self._store([k for k, _ in chosen], np.array([*chain.from_iterable(found)], np.uint32), np.fromiter(map(len, found), np.int64, len(found)))
        if joined:
            of_parts, after = self._gather(np.array(parts))
            whole, n_parts = zip(*joined, strict=True)
            self._store(list(whole), of_parts, np.diff(after[np.cumsum(n_parts) - 1], prepend=0))
        todo.clear()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        if len(self.codes) > self.limit:
            self._reset()
        pieces: list[str] = []
        ends = []
        for text in texts:
            pieces += _lowered(text).replace("\n", " ").split(" ")
            ends.append(len(pieces))
        codes = np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))
        self._learn()
        ids, after = self._gather(codes)
        until = np.r_[0, after][ends] if ends else np.empty(0, np.int64)
        return ids, np.diff(np.r_[0, until])

    def encode_all(self, texts: Iterator[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``encode`` over groups of about ``chars`` characters: (number of texts, ids, counts). Null is empty."""
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= chars:
                yield (len(held), *self.encode(held))
                held, size = [], 0
        if held:
            yield (len(held), *self.encode(held))


_KEPT: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each file and worker process."""
    if path not in _KEPT:
        _KEPT[path] = WordTokenizer(path)
    return _KEPT[path]
