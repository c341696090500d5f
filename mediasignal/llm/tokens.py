"""Token ids of whole texts by a public tokenizer file, fast where words repeat.

``word_bpe_49k.json`` splits at white space, so the ids of a text are those of
its white-space-separated words in turn. Words are encoded once per worker and
kept. A word of Latin letters, digits and ASCII punctuation is split by the
tokenizer's own rule and merged by ``tiktoken`` with the file's merges; any
other word goes through the ``tokenizers`` library.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

#: Words kept per worker, and the longest kept, in bytes.
KEPT_WORDS, KEPT_BYTES = 300_000, 64
_PLAIN = re.compile(r"[0-9A-Za-zÀ-ÖØ-öø-ÿ!-&(-/:-@\[-`{-~]+")
_PIECE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_WORD_END, _END_BYTE = "</w>", b"\xff"  # the byte 0xFF occurs in no UTF-8 text


def _byte_symbols() -> dict[str, int]:
    """The printable symbol that byte-level vocabularies write for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordEncoder:
    """Ids as little-endian 16-bit numbers; the vocabulary must be smaller than 65,536."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], _byte_symbols()
        self.special = [t["content"] for t in spec["added_tokens"]]

        def raw(token: str) -> bytes:
            end = _END_BYTE if token.endswith(_WORD_END) else b""
            return bytes(symbols[c] for c in token.removesuffix(_WORD_END)) + end

        ranks = {bytes([b]): b for b in range(256)}
        names = {b: vocab[s] for s, b in symbols.items()}
        for s, b in symbols.items():  # the end of a word belongs to its last byte before any merge
            ranks[bytes([b]) + _END_BYTE] = 256 + b
            names[256 + b] = vocab[s + _WORD_END]
        for i, merge in enumerate(spec["model"]["merges"]):
            token = "".join(merge if isinstance(merge, list) else merge.split(" "))
            rank = ranks.setdefault(raw(token), 512 + i)
            names.setdefault(rank, vocab[token])
        self.names = np.zeros(max(names) + 1, dtype="<u2")
        for rank, name in names.items():
            self.names[rank] = name
        known = {rank for rank in ranks.values()}
        filler = (r for r in range(512, max(known)) if r not in known)  # tiktoken wants gapless ranks
        ranks |= {b"\xfe\xfe" + r.to_bytes(4, "big"): r for r in filler}
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks,
                                       special_tokens={})._encode_single_piece
        self.kept: dict[bytes, bytes] = {}

    def word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            ranks = [r for piece in _PIECE.findall(text.lower()) for r in self.merge(piece.encode() + _END_BYTE)]
            return self.names[ranks].tobytes()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def encode(self, data: bytes) -> bytes:
        """Ids of a UTF-8 text."""
        words, kept = data.split(), self.kept
        try:
            return b"".join(map(kept.__getitem__, words))
        except KeyError:
            pass
        own = {}
        for word in set(words):
            if word not in kept:
                home = kept if len(word) <= KEPT_BYTES and len(kept) < KEPT_WORDS else own
                home[word] = self.word(word)
        return b"".join(kept[w] if w in kept else own[w] for w in words)


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)
