"""Token ids of whole texts, encoded piece by piece with a bounded memory of pieces seen."""

from __future__ import annotations

import json
import re
from array import array

# Pieces remembered by one worker before its memory is emptied.
REMEMBERED = 1_000_000
# The split of the byte-level tokenizers, a fixed value of theirs.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# White space other than the space and the line feed.
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, and the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Encoded pieces by their text; an unknown one is encoded when it is asked for."""

    def __init__(self, encode, before: str):
        super().__init__()
        self._encode, self._before = encode, before

    def __missing__(self, piece: str) -> bytes:
        found = self[piece] = self._encode(self._before + piece)
        return found


class ByteBpe:
    """Ids by the byte-level tokenizer of ``path``, as little-endian 32-bit bytes.

    In a text whose white space is all single, every space opens a word of the
    tokenizer's own split and every line feed is a word, so the pieces between
    them are encoded once and remembered. Other texts, and texts that hold a
    special token, go to the tokenizer whole. Pieces are encoded by a faster
    library with the same merges, provided that ids follow the order of the
    merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.no_truncation()
        self._whole.no_padding()
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        ranks = self._ordered(path)
        self._piece = self._encoded if ranks is None else lambda text: array("I", ranks.encode_ordinary(text)).tobytes()
        self._first, self._spaced = _Pieces(self._piece, ""), _Pieces(self._piece, " ")
        self._feed = self._encoded("\n")

    def _ordered(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(pair)] for pair in pairs]
        if made != sorted(made) or len(set(made)) < len(made) or min(made, default=256) < 256:
            return None
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in model["vocab"].items() if token not in self._special
        }
        return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encoded(self, text: str) -> bytes:
        return array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        return self._first[first] + b"".join(map(self._spaced.__getitem__, rest))

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if (
            "  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or text[-1] in " \n" or _OTHER_SPACE.search(text) or any(s in text for s in self._special)
        ):
            return self._encoded(text)
        if len(self._spaced) + len(self._first) > REMEMBERED:
            self._first.clear()
            self._spaced.clear()
        return self._feed.join(map(self._line, text.split("\n")))
