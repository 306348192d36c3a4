"""Token ids of a public byte-level vocabulary, remembered by chunk."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

MOST_CHUNKS_KEPT = 600_000  # chunks remembered by a Python worker, to bound its memory; ids do not depend on it

# A blank next to another blank: there, chunks cut at spaces are not independent.
TWO_BLANKS = re.compile(r"\s | \s")
# Letters on which the two libraries' Unicode tables cannot differ.
COMMON = re.compile(r"[\x00-ɏ]*")


@lru_cache(maxsize=1)
def token_ids(vocabulary: str) -> TokenIds:
    """The worker's encoder; what it remembers serves the worker's later tasks too."""
    return TokenIds(vocabulary)


class TokenIds(dict):
    """Little-endian unsigned 32-bit ids of a chunk of text without its left space.

    The vocabulary file is read by `tokenizers`. Its merges are the ranks of the
    tiktoken file of the same name beside it, which encodes several times faster;
    tests hold both against each other. Text outside the Latin blocks, and all
    text if there is no such file, goes to `tokenizers`.

    The pre-tokeniser never joins letters, digits or signs across a space, and a
    single space goes with what follows it, so a text without adjacent blanks is
    the sum of its chunks. A text that spells out a special token of the vocabulary
    goes to `tokenizers` whole, which gives that token's own id.
    """

    def __init__(self, vocabulary: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(vocabulary)
        self.special = [token.content for token in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        ranks_file = vocabulary.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_file):
            import public_tokenizers

            with open(ranks_file, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.fast is not None and COMMON.fullmatch(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.slow.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(" " + chunk)
        if len(self) < MOST_CHUNKS_KEPT and len(chunk) < 64:
            self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if TWO_BLANKS.search(text):
            return self.encode(text)
        first, *chunks = text.split(" ")
        return self.encode(first) + b"".join(map(self.__getitem__, chunks))
