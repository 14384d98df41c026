"""How two kinds of public tokenizer files turn a text into words of byte letters.

One kind keeps words with the space before them, the other lower-cases and drops white
space. ``TextTreatment.of`` tells the kind from the file, or that it is another.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass

import regex


def byte_letters() -> list[str]:
    """The visible character that stands for each byte.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, get
    the characters from 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


LETTERS = byte_letters()
BYTE_OF = {c: b for b, c in enumerate(LETTERS)}
_ASCII = {b: LETTERS[b] for b in range(128)}

# Fixed patterns of the two kinds of tokenizers.
SPACED_WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
BARE_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
# The same as tokenizer files state them.
_BARE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@dataclass(frozen=True)
class TextTreatment:
    lowers: bool
    special: tuple[str, ...]

    @classmethod
    def of(cls, path: str) -> TextTreatment | None:
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        special = tuple(t["content"] for t in config["added_tokens"])
        before, cuts = config["normalizer"], config["pre_tokenizer"] or {}
        levels = cuts.get("pretokenizers", [cuts])
        byte_level = levels[-1].get("type") == "ByteLevel" and not levels[-1]["add_prefix_space"]
        if not byte_level or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
                                 for t in config["added_tokens"]):
            return None
        if before is None and len(levels) == 1 and levels[0].get("use_regex", True):
            return cls(False, special)
        steps = [s["type"] for s in (before or {}).get("normalizers", [])]
        if steps == ["NFC", "Replace", "Lowercase"] and len(levels) == 2 and levels[0]["type"] == "Split" \
                and levels[0]["pattern"] == {"Regex": _BARE_PATTERN}:
            return cls(True, special)
        return None

    def holds_special(self, text: str) -> bool:
        for special in self.special:
            if special in text:
                return True
        return False

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not self.lowers:
            return SPACED_WORDS.findall(text)
        if text.isascii():
            return BARE_WORDS.findall(text.lower())
        # Letter by letter: a final sigma is lower-cased like any other.
        return BARE_WORDS.findall("".join(map(str.lower, unicodedata.normalize("NFC", text))))

    def letters(self, word: str) -> str:
        """A word with a letter for each of its bytes."""
        if word.isascii():
            # Of the printable ones only the space has another letter.
            return word.replace(" ", LETTERS[32]) if word.isprintable() else word.translate(_ASCII)
        return "".join([LETTERS[b] for b in word.encode()])
