"""Token ids of the public byte-level BPE vocabulary, by the faster of two libraries that give the same ids."""

from __future__ import annotations

import base64
import functools
import os

import numpy as np

DEFAULT = "byte_bpe_50k"


def vocabulary(name: str = DEFAULT) -> tuple[str, str, str]:
    """Paths of the tokenizers file and of the rank file, and the pattern that splits text before the merges."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


class Encoder:
    """``ids(text)`` equals ``tokenizers``' ``encode(text, add_special_tokens=False).ids``.

    tiktoken encodes the same ranks five times as fast; a text that holds the literal of a special token, which
    tokenizers makes one id of, goes to tokenizers itself.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(json_path)
        self.specials = [t.content for t in self.exact.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.specials):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


@functools.lru_cache(maxsize=2)
def encoder(paths: tuple[str, str, str]) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(*paths)
