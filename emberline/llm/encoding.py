"""Token ids of texts as a tokenizer's definition file gives them. The files' contents travel, not their paths."""

import base64
import json
import re
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np

from emberline.llm.tokencounts import _SETTLED


@dataclass(frozen=True)
class Definition:
    """Contents of the definition file and, if there are any, of a rank file of the same merges with its pattern."""

    json: bytes
    ranks: bytes | None = None
    pattern: str | None = None

    @classmethod
    def read(cls, json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> "Definition":
        return cls(Path(json_path).read_bytes(), Path(ranks_path).read_bytes() if ranks_path else None, pattern)


@lru_cache(maxsize=2)
def encoder(files: Definition):
    """A function from a text to its ids (unsigned 32 bits), special tokens added nowhere.

    The rank file's encoder is several times faster. Texts with characters whose class may differ between the two
    libraries' Unicode tables go to the library that defines the ids. Strings of added tokens inside a text become
    these tokens, as the defining library has it by default.
    """
    from tokenizers import Tokenizer

    defined = Tokenizer.from_str(files.json.decode())

    def slow(text: str) -> np.ndarray:
        return np.array(defined.encode(text, add_special_tokens=False).ids, np.uint32)

    if files.ranks is None:
        return slow
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, files.ranks.splitlines())}
    quick = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
    added = {t["content"]: t["id"] for t in json.loads(files.json)["added_tokens"]}
    cut = re.compile("|".join(f"({re.escape(t)})" for t in sorted(added, key=len, reverse=True))) if added else None

    def fast(text: str) -> np.ndarray:
        if not text.isascii() and not _SETTLED.fullmatch(text):
            return slow(text)
        if cut is None or not cut.search(text):
            return np.array(quick.encode_ordinary(text), np.uint32)
        ids, at = [], 0
        for found in cut.finditer(text):
            ids += [*quick.encode_ordinary(text[at : found.start()]), added[found.group()]]
            at = found.end()
        return np.array(ids + quick.encode_ordinary(text[at:]), np.uint32)

    return fast
