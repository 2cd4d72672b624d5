"""Token ids of a public byte-level BPE vocabulary, as little-endian unsigned bytes."""

from __future__ import annotations

import base64
import re
import struct

import numpy as np
import tiktoken
from tokenizers import Tokenizer

LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: The vocabulary's own pattern for texts of SAFE characters; the alternatives start differently, so their order is free.
FAST = re.compile(rf" ?[{LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s0-9{LETTER}]+|\s+(?!\S)|\s+")
UNSAFE = re.compile(rf"[^\t-\r\x20-\x7e{LETTER}]")
#: Words whose ids a worker keeps, about 100 MB.
KEPT_WORDS = 400_000


class Words(dict):
    """Ids of a word, encoded when first met."""

    def __init__(self, pattern: str, ranks_file: str, kind: str):
        super().__init__()
        self.kind = kind
        # Words have few ids; an array for each costs more than to encode it.
        self.packer = [struct.Struct(f"<{n}{'H' if kind == '<u2' else 'I'}").pack for n in range(17)]
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        ids = self.encoding.encode_ordinary(word)
        packed = self.packer[len(ids)](*ids) if len(ids) < len(self.packer) else np.array(ids, self.kind).tobytes()
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = packed
        return packed


def id_kind(vocabulary: str) -> str:
    """The smallest type that holds every id of the ``tokenizers`` file."""
    return "<u2" if max(Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True).values()) < 1 << 16 else "<u4"


class Encoder:
    """Ids of whole texts, as bytes of the type ``kind``, equal to those of the ``tokenizers`` file with ``add_special_tokens=False``.

    Words repeat, so texts of Latin-1 letters and plain ASCII are split here and looked up word by word in
    the same vocabulary's ranks; every other text goes through the ``tokenizers`` file itself, and so does a
    text that holds the string of an added token, which gets that token's id.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str, kind: str = "<u4"):
        self.vocabulary, self.kind = vocabulary, kind
        self.words = Words(pattern, ranks, kind)
        self.whole = Tokenizer.from_file(vocabulary)
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> bytes:
        if UNSAFE.search(text) or any(token in text for token in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join(map(self.words.__getitem__, FAST.findall(text)))
