"""Byte-level BPE read from a tokenizer file: pieces of a text, their ids, and exact counts for every prefix.

Where every token is made by one merge and ids rise in the order of merges, merging the pair of least rank
is merging the pair of least id, so tiktoken over the same tokens gives the same ids several times faster.
It serves texts of plain Latin characters, whose classes all libraries agree on; all others go to the
tokenizer's own library. BPE never merges across pieces, so counts, and the ids of the other texts, are found
once a distinct piece and remembered in a table of bounded size; plain texts are cut by an equal pattern of
Python's re, others by the library's own pre-tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

MEMO = 800_000     # pieces a worker remembers; the others are worked out again
PAIRS = 1_200_000  # pairs of tokens whose fit a worker remembers
LONGEST_MEMO = 64  # bytes
SPACE_RUN = 10_000  # white-space characters in a row beyond which tiktoken's pattern could outgrow its stack
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(f"[\\t-\\r -~{_LETTER}¡«»¿‐-‧]*").fullmatch
GPT_PIECES = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_SPACE = re.compile(r"\s{%d}" % SPACE_RUN).search
PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s{_LETTER}0-9]+|\\s+(?!\\S)|\\s+").findall


class Vocabulary:
    """A tokenizers .json file with a byte-level BPE model."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model, added = spec["pre_tokenizer"] or {}, spec["model"], spec["added_tokens"]
        if (model["type"], pre.get("type"), pre.get("use_regex"), pre.get("add_prefix_space")) != ("BPE", "ByteLevel", True, False) \
                or spec["normalizer"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        self.library = Tokenizer.from_file(path)
        to_byte = _byte_letters()
        self.special = {t["content"]: t["id"] for t in added}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.ids = {bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        self.width = 2 if max([*self.ids.values(), *self.special.values()]) < 1 << 16 else 4
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {tuple(bytes(to_byte[c] for c in x) for x in p): i for i, p in enumerate(pairs)}
        self.to_byte = to_byte
        self.kind = f"<u{self.width}"
        made = [self.ids.get(a + b, -1) for a, b in self.ranks]
        in_order = len(made) + 256 == len(self.ids) and -1 not in made and all(a < b for a, b in zip(made, made[1:]))
        self.quick = tiktoken.Encoding("plain", pat_str=GPT_PIECES, mergeable_ranks=self.ids,
                                       special_tokens=self.special) if in_order else None

    def plain_ids(self, text: str) -> np.ndarray | None:
        """The ids of a text of plain Latin characters, by the library if white space is very long; None for other texts and vocabularies."""
        if not (self.quick and PLAIN(text)):
            return None
        if len(text) >= SPACE_RUN and LONG_SPACE(text):
            return self._library_ids(text)
        return self.quick.encode_to_numpy(text, allowed_special="all").astype(self.kind)

    def text_ids(self, text: str) -> np.ndarray:
        plain = self.plain_ids(text)
        return self._library_ids(text) if plain is None else plain

    def _library_ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def pieces(self, text: str) -> list:
        """The pieces of a text in order; a special token is a piece of its own."""
        if self.cut_special and any(s in text for s in self.special):
            return [p for part in self.cut_special(text) if part
                    for p in ([part] if part in self.special else self._plain_pieces(part))]
        return self._plain_pieces(text)

    def _plain_pieces(self, text: str) -> list:
        if PLAIN(text):
            return PIECES(text)
        return [bytes(map(self.to_byte.__getitem__, p)).decode() if text.isascii() else text[a:b]
                for p, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def merged(self, piece: bytes) -> list:
        """A short piece after all merges, lowest rank first."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


def _byte_letters() -> dict:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PieceIds(dict):
    """piece -> its ids as little-endian bytes, found by the library; a text's new pieces are encoded together.

    Plain texts are encoded whole and need no table.
    """

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab, self.kind = vocab, vocab.kind

    def encode(self, text: str) -> bytes:
        plain = self.vocab.plain_ids(text)
        if plain is not None:
            return plain.tobytes()
        pieces = self.vocab.pieces(text)
        known = list(map(self.get, pieces))
        if None in known:
            new = list({p: None for p, ids in zip(pieces, known) if ids is None})
            found = self.vocab.library.encode_batch_fast(new, add_special_tokens=False)
            extra = {p: np.array(x.ids, self.kind).tobytes() for p, x in zip(new, found)}
            known = [extra[p] if ids is None else ids for p, ids in zip(pieces, known)]
            if len(self) < MEMO:
                self.update((p, ids) for p, ids in extra.items() if len(p) <= LONGEST_MEMO)
        return b"".join(known)


class PieceCounts(dict):
    """piece -> its number of tokens, from the prefix table."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab
        self.ends = {t[i:] for t in vocab.ids for i in range(len(t))}  # every suffix of a token
        self.fits: dict = {}

    def __missing__(self, piece):
        n = 1 if piece in self.vocab.special else self.table(piece.encode())[1][-1]
        if len(self) < MEMO and len(piece) <= LONGEST_MEMO:
            self[piece] = n
        return n

    def table(self, piece: bytes) -> tuple:
        """(last, count): the last token's length and the number of tokens of every prefix of a piece.

        A prefix ends in the one token that fits behind the last token of what stands before it: the
        pair, put together, is cut into the same two tokens. No prefix is encoded a second time.
        """
        ids, ends, fits = self.vocab.ids, self.ends, self.fits
        last, count, token = [0], [0], [b""]
        for end in range(1, len(piece) + 1):
            found, size = [], 1
            while size <= end and (part := piece[end - size:end]) in ends:
                if part in ids:
                    found.append(part)
                size += 1
            for part in reversed(found):
                before = token[end - len(part)]
                fit = fits.get((before, part))
                if fit is None:
                    fit = self.vocab.merged(before + part) == ([before, part] if before else [part])
                    if len(fits) < PAIRS:
                        fits[before, part] = fit
                if fit:
                    last.append(len(part))
                    count.append(count[end - len(part)] + 1)
                    token.append(part)
                    break
            else:
                raise ValueError(f"no token ends at byte {end} of {piece[:80]!r}")
        return last, count

    def total(self, text: str) -> int:
        return sum(map(self.__getitem__, self.vocab.pieces(text)))

    def cut(self, text: str, budget: int) -> int:
        """Bytes covered by the first `budget` tokens of a text."""
        size = 0
        for piece in self.vocab.pieces(text):
            n, data = self[piece], piece.encode()
            if n <= budget:
                budget, size = budget - n, size + len(data)
                continue
            if budget:
                last, count = self.table(data)
                end = len(data)
                while count[end] > budget:
                    end -= last[end]
                size += end
            break
        return size

    def prefix(self, text: str, chars: int) -> int:
        """Tokens of text[:chars]: whole pieces before, and the few pieces around the cut once more."""
        pieces, at, k = self.vocab.pieces(text), 0, 0
        while k < len(pieces) and at + len(pieces[k]) <= chars:
            at += len(pieces[k])
            k += 1
        for step in (False, True):  # white space and a token string depend on what follows
            if step and k:
                k -= 1
                at -= len(pieces[k])
            while k and pieces[k - 1].isspace():
                k -= 1
                at -= len(pieces[k])
        return sum(map(self.__getitem__, pieces[:k])) + self.total(text[at:chars])


@lru_cache(maxsize=2)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(vocabulary(path))


@lru_cache(maxsize=2)
def piece_counts(path: str) -> PieceCounts:
    return PieceCounts(vocabulary(path))
