"""Token ids of a public byte-level BPE vocabulary, with a bounded cache of blank-separated words."""

from __future__ import annotations

import functools
import json
import re
from array import array

import tiktoken

#: Fixed value: how a byte-level vocabulary of this family cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Some 80 MB a worker process; a full cache is emptied, and refilled from the texts that follow.
CACHED_WORDS = 200_000


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    table |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    return table


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of, special = _byte_of_char(), {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
        ranks = {bytes(of[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in special}
        self._plain = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        # longest first; None where the file adds none
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._added_ids = {t: array("I", [k]).tobytes() for t, k in special.items()}
        self._cache: dict[str, bytes | bool] = {}

    def _bytes(self, text: str) -> bytes:
        return array("I", self._plain.encode_ordinary(text)).tobytes()

    def _word(self, word: str) -> bytes | bool:
        """Ids of a word after a blank; False where white space touches that blank or the next, so the word can't stand alone."""
        if len(self._cache) >= CACHED_WORDS:
            self._cache.clear()
        alone = word and not word[0].isspace() and not word[-1].isspace()
        ids = self._cache[word] = self._bytes(" " + word) if alone else False
        return ids

    def encode(self, text: str, added_tokens: bool = False) -> bytes:
        """Ids as unsigned 32-bit numbers in the machine's order. Strings of the file's added tokens become their ids with
        added_tokens, as in the tokenizers library by default, and are ordinary text without."""
        if added_tokens and self._added and self._added.search(text):
            parts = self._added.split(text)
            return b"".join(self._added_ids[t] if k % 2 else self.encode(t) for k, t in enumerate(parts))
        head, *words = text.split(" ")
        if head[-1:].isspace():
            return self._bytes(text)
        found = list(map(self._cache.get, words))
        for k, ids in enumerate(found):
            if not ids:
                ids = found[k] = self._word(words[k])
                if ids is False:
                    return self._bytes(text)
        return self._bytes(head) + b"".join(found)


@functools.cache
def load(path: str) -> ByteBpe:
    """One tokenizer, with its cache, per worker process."""
    return ByteBpe(path)
