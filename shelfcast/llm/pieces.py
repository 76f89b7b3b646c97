"""How a tokenizers vocabulary without white-space tokens splits a word into the pieces that its merges work on."""

from __future__ import annotations

import re

#: Letters of the Latin blocks that lower-case to one letter and are composed already.
LATIN = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]"
_PLAIN = re.compile(f"({LATIN}+)([.,!]*)")


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: a visible Latin-1 character stands for its byte, the others for code points from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: 256 + i for i, b in enumerate(hidden)}


class Pieces:
    """Splits words under a vocabulary, given as the text of its file: Unicode normalizing, lower-casing, byte-level pieces."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = {x.content: i for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        self.suffix = self.tokenizer.model.end_of_word_suffix or ""
        names = sorted(self.special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else lambda word: [word]
        self._letters, self._plain = byte_letters(), _PLAIN.fullmatch

    def letters(self, piece: str) -> str:
        """Lower-case letters in the byte-level alphabet."""
        return piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._letters)

    def split(self, word: str) -> list[str | int]:
        """The pieces of a word in the byte-level alphabet, and the ids of special strings."""
        if found := self._plain(word):  # letters, then marks: two pieces under any such vocabulary
            letters, marks = found.groups()
            letters = self.letters(letters.lower())
            return [letters, marks] if marks else [letters]
        out: list[str | int] = []
        for part in self._cut(word):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                out += [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal) if piece]
        return out
