"""Public tokenizers, loaded once per Python process, with bounded caches."""

from __future__ import annotations

import base64
import os
import re
from itertools import chain, islice

import numpy as np
import public_tokenizers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already use all cores

_loaded: dict[str, object] = {}


_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
#: Words that the tokenizer keeps as one piece, words whose pieces are known beforehand, and these pieces (in lower case, as it folds them) by its own rule.
_ONE = re.compile(f"[A-Za-z{_LATIN}]+").fullmatch
_KNOWN = re.compile(f"[!-~{_LATIN}]+").fullmatch
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+").findall
_SPECIAL = "<|"
_BATCH = 500


class _Numbers(dict):
    """Numbers words as they come; ``new`` are those not known yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class WordEncoder:
    """Whole texts by a tokenizer that drops white space and ends each piece by a token of its own, so that words can be encoded apart.

    Words get numbers, and ``coded`` has the ids of each. A new word whose pieces are known beforehand is put together
    from them; new pieces are encoded many at a time and told apart by their end tokens, other words one by one.
    Pieces are cached in two generations of at most about ``limit`` each; ``forget`` bounds the words.
    """

    def __init__(self, path: str, limit: int = 200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.limit, self.number, self.coded = limit, _Numbers(), []
        self.pieces, self.old = {}, {}

    def end(self, end_id: int) -> str:
        """A word (no text has it) whose ids are ``end_id`` alone."""
        word = f" {end_id}"  # texts are split at blanks
        if word not in self.number:
            self.number[word] = len(self.coded)
            self.coded.append(np.array([end_id], "<u4").tobytes())
        return word

    def numbers(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all words, words of each text); ``end_id`` ends each text as a word of its own."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if end_id is not None:
            end = self.end(end_id)
            for w in split:
                w.append(end)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        out = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int32, int(sizes.sum()))
        try:
            self._learn(self.number.new)
        except BaseException:
            self.forget(np.zeros(0, bool))
            raise
        self.number.new = []
        return out, sizes

    def forget(self, keep: np.ndarray) -> None:
        """Drops all words but those marked in ``keep``; numbers change."""
        old, coded = self.number, self.coded
        self.number, self.coded = _Numbers(), []
        for w, i in old.items():
            if i < len(keep) and keep[i]:
                self.number[w] = len(self.coded)
                self.coded.append(coded[i])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        numbers, sizes = self.numbers(texts)
        words = map(self.coded.__getitem__, numbers.tolist())
        out = [b"".join(islice(words, n)) for n in sizes.tolist()]
        if len(self.coded) > self.limit:
            self.forget(np.bincount(numbers, minlength=len(self.coded)) > 1)
        return out

    def _learn(self, words: list[str]) -> None:
        if len(self.pieces) > self.limit:
            self.pieces, self.old = {}, self.pieces
        pieces, parts, single, wanted = self.pieces, [], [], set()
        for w in words:
            if _ONE(w):
                part = w.lower()
                wanted.add(part)
            elif _KNOWN(w) and _SPECIAL not in w:
                part = _PIECES(w.lower())
                wanted.update(part)
            else:
                part = w
                wanted.add(w)
                single.append(w)
            parts.append(part)
        new = wanted - pieces.keys()
        kept = new & self.old.keys()
        pieces.update((w, self.old[w]) for w in kept)
        new -= kept
        single = [w for w in single if w in new]
        new = list(new.difference(single))
        for at in range(0, len(new), _BATCH):
            part = new[at : at + _BATCH]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                single += part
                continue
            raw, x = ids.tobytes(), 0
            for w, y in zip(part, (4 * ends).tolist(), strict=True):
                pieces[w] = raw[x:y]
                x = y
        for at in range(0, len(single), 20_000):
            part = single[at : at + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                pieces[w] = np.array(e.ids, "<u4").tobytes()
        get = pieces.__getitem__
        self.coded += [get(p) if type(p) is str else b"".join(map(get, p)) for p in parts]


def word_encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


class RankEncoder:
    """A byte-level encoder of a rank file: the ids of the tokenizers file of the same vocabulary, whose special tokens count as such in a text."""

    def __init__(self, path: str, special: dict[str, int]):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = tuple(special)

    def encode(self, text: str) -> list[int]:
        if any(x in text for x in self.special):
            return self.encoding.encode(text, allowed_special="all")
        return self.encoding.encode_ordinary(text)


def rank_encoder(path: str) -> RankEncoder:
    if path not in _loaded:
        _loaded[path] = RankEncoder(path, {"<|endoftext|>": 50256})
    return _loaded[path]
