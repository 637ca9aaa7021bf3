"""Token ids of the byte-level vocabulary.

Ids are those of ``tokenizers`` for the JSON file. The same vocabulary lies beside it as
ranks, which ``tiktoken`` encodes about five times as fast to the same ids; a text that it
cannot encode goes to ``tokenizers``.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

END_OF_TEXT = "<|endoftext|>"
END_OF_TEXT_ID = 50256


@lru_cache(maxsize=4)
def _ranks(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        path,
        pat_str=PATTERN,
        mergeable_ranks=ranks,
        special_tokens={END_OF_TEXT: END_OF_TEXT_ID},
    )


@lru_cache(maxsize=4)
def _exact(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _plain(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


class Encoder:
    """Encodes with the tokenizer file at ``path``, special strings as their ids."""

    def __init__(self, path: str):
        self.path = path
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        self.fast = _ranks(ranks) if os.path.exists(ranks) else None

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and len(text) < 1_000_000:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except BaseException as error:  # a panic in native code is no Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
        ids = _exact(self.path).encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32)

    def encode_plain(self, text: str) -> list[int]:
        """Special strings are ordinary text here."""
        if self.fast is None:
            raise ValueError(f"no ranks beside {self.path}")
        if len(text) < 1_000_000:
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as error:  # a panic in native code is no Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
        return _plain(self.path).encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.fast.decode(ids)
