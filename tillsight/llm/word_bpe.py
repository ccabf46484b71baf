"""Token ids of a lower-casing word BPE file (`word_bpe_49k.json`), with a bounded memory of words.

A text's ids are those of its words in a row, and most words come again: each worker remembers those it
has met. Texts of plain Latin letters, digits, ASCII signs and common separators are cut at white space, which no piece
crosses; a new word is cut into pieces by the file's own pattern, and new pieces go through the same merges in a faster
encoder; its end-of-word mark is a zero byte, which such texts cannot hold. All other texts are taken word by word where white space is beyond doubt, and
words with other signs, like texts with separators on which libraries disagree, go to the file's own tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

REMEMBERED = 500_000  # words and pieces that a Python worker keeps, over all its tasks, before it starts anew

# Fixed values of the file format: the pieces that its pre-tokenizer finds in a lower-cased word.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
UNSURE = re.compile(r"[\x00\x1c-\x1f]")


def _bytes_of_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones for themselves, the
    others numbered from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def shared(path: str) -> WordBpe:
    """The worker's encoder: its tasks come one after the other and go on with what it remembers."""
    return WordBpe(path)


class WordBpe:
    """Keeps the ids of words it has met, as bytes; `encode` joins them. Ids must fit into 16 bits."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        symbols, end = _bytes_of_symbols(), model["end_of_word_suffix"]
        ranks = {}
        for token, i in model["vocab"].items():
            stem, mark = (token[:-len(end)], b"\0") if token.endswith(end) and token != end else (token, b"")
            if all(c in symbols for c in stem) and not token.startswith("<|"):
                ranks[bytes(symbols[c] for c in stem) + mark] = i
        self.fast = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.last = np.zeros(1 << 16, bool)
        self.last[[i for token, i in ranks.items() if token.endswith(b"\0")]] = True
        self.size = self.whole.get_vocab_size()
        if self.size > 1 << 16:
            raise ValueError("ids do not fit into 16 bits")
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Words are in lower case; those that the plain way cannot cut come with a mark in front."""
        known, cut = self.known, {}
        for word in words:
            if word[0] == "\0":
                known[word] = array("H", self.whole.encode(word[1:], add_special_tokens=False).ids).tobytes()
            else:
                cut[word] = PIECES.findall(word)
        fresh = list({p for pieces in cut.values() for p in pieces}.difference(known))
        # All new pieces at once; the token that ends in the end-of-word mark is the last of its piece.
        ids = np.array(self.fast.encode_ordinary("".join([p + "\0" for p in fresh])), np.uint16)
        blob, start = ids.tobytes(), 0
        for piece, end in zip(fresh, (np.flatnonzero(self.last[ids]) + 1).tolist(), strict=True):
            known[piece] = blob[2 * start:2 * end]
            start = end
        for word, pieces in cut.items():
            if len(pieces) > 1:
                known[word] = b"".join(map(known.__getitem__, pieces))

    def encode(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text):
            words = text.lower().split()
        elif UNSURE.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint16)
        else:
            words = [word.lower() if PLAIN.fullmatch(word) else "\0" + word for word in text.split()]
        if len(self.known) > self.remembered:
            self.known.clear()
        try:
            joined = b"".join(map(self.known.__getitem__, words))
        except KeyError:
            self._learn(list(set(words).difference(self.known)))
            joined = b"".join(map(self.known.__getitem__, words))
        return np.frombuffer(joined, np.uint16)
