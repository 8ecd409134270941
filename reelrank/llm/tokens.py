"""Token ids of whole texts, the tokenizers library's own, with a bounded memory of words seen.

A byte-pair tokenizer cuts a text into pieces (words, marks, white space) and encodes each piece by
itself. Remembering the ids of a piece, and of the run of pieces up to the next space, gives the ids
of the whole text several times faster than encoding it anew. The shortcut is taken for texts over an
alphabet (ASCII and western European letters) in which Python's character classes are the tokenizer's;
any other text, and any that holds one of the tokenizer's added tokens, goes to the library whole.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from dataclasses import dataclass
from itertools import islice
from struct import pack

#: Strings remembered by one worker process (about 110 bytes each); beyond it the newer half is forgotten.
REMEMBERED = 1_000_000
#: Longer strings are not remembered as a whole.
LONGEST = 48
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿŒœŠšŽž"
ALPHABET = re.compile(f"[\t\n\r -~{LETTERS}]*").fullmatch


@dataclass(frozen=True)
class Scheme:
    """How a tokenizer cuts texts of the alphabet.

    ``pattern`` gives the pieces. ``spaced``: a space belongs to the piece after it; otherwise white space
    is dropped.
    """

    pattern: str
    lower: bool
    spaced: bool

    def runs(self, text: str, cut: Callable[[str], list[str]]) -> list[str]:
        """``text`` cut where a piece ends whatever follows: before spaces, around line ends."""
        if not self.spaced:
            return text.split()
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or "\t" in text or "\r" in text:
            return cut(text)  # white space next to white space: the pieces themselves
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


#: Fixed: the cuts of the two public tokenizer files, their letters and digits written for the alphabet above.
WORDS = Scheme(rf"[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\s{LETTERS}0-9]+", True, False)
BYTES = Scheme(
    rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+", False, True
)


class _Known(dict):
    """Ids of pieces and of runs of pieces, the pieces' straight from the tokenizer's own model."""

    def __init__(self, path: str, scheme: Scheme) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cut = re.compile(scheme.pattern).findall
        # The library looks for these before it cuts a text; those it seeks in the lowered text are met in any case.
        added = self.tokenizer.get_added_tokens_decoder().values()
        each = [f"(?i:{re.escape(t.content)})" if t.normalized else re.escape(t.content) for t in added]
        self.added = re.compile("|".join(each)).search if each else lambda text: None
        # The model sees bytes as printable letters; the library says which.
        letters = [chr(c) for c in range(33, 0x17F) if ALPHABET(chr(c))]
        shown = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.shown = {32: "Ġ"} | {ord(c): "".join(p for p, _ in shown(c)) for c in letters}

    def __missing__(self, run: str) -> bytes:
        pieces = self.cut(run)
        if len(pieces) != 1:
            raw = b"".join(map(self.__getitem__, pieces))
        elif run.isspace():
            raw = self.whole(run)
        else:
            ids = [t.id for t in self.model.tokenize(run.translate(self.shown))]
            raw = pack(f"<{len(ids)}I", *ids)
        if len(run) <= LONGEST:
            self[run] = raw
        return raw

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)


class Encoder:
    """``ids(texts)``: per text its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, scheme: Scheme, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        # One memory for all tasks of a worker process.
        memories = sys.__dict__.setdefault("_reelrank_token_memories", {})
        key = (path, scheme.pattern)
        if key not in memories:
            memories[key] = _Known(path, scheme)
        self.scheme, self.known = scheme, memories[key]
        self.whole = self.known.whole

    def one(self, text: str) -> bytes:
        if not ALPHABET(text) or self.known.added(text):
            return self.whole(text)
        text = text.lower() if self.scheme.lower else text
        return b"".join(map(self.known.__getitem__, self.scheme.runs(text, self.known.cut)))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > self.remembered:  # what was met first is frequent
            kept = list(islice(self.known.items(), self.remembered // 2))
            self.known.clear()
            self.known.update(kept)
        return [self.one(t or "") for t in texts]


def in_parts(texts: list[str | None], chars: int = 2_000_000):
    """Slices of a batch of about ``chars`` characters, one text at least."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= chars:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


__all__ = ["BYTES", "WORDS", "Encoder", "Scheme", "in_parts"]
