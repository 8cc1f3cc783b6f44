"""Token ids of a byte-level BPE vocabulary file, per Python worker.

The vocabulary is read from the tokenizer's own JSON file. A byte-level BPE
whose ids follow its merges gives the same ids under any engine; the faster one
is used here, and the tests hold it against the file's own library. The split
pattern is the file's, with possessive repeats, which cannot change a match.
The file's added tokens inside a text get their own ids, as the library gives
them; ``token_ids`` reads such strings as ordinary text.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np

# Fixed: the split pattern of the byte-level vocabulary.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def _loaded() -> dict[str, object]:
    """Encoders of this process. Tasks bring their own copy of this module, so they are kept beside it."""
    return sys.modules.setdefault("_veilframe_encoders", types.ModuleType("_veilframe_encoders")).__dict__


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str):
    """The encoder of a vocabulary file, made once per process."""
    loaded = _loaded()
    if name not in loaded:
        import tiktoken

        with open(vocabulary_path(name), encoding="utf-8") as file:
            model = json.load(file)
        added = {t["content"]: t["id"] for t in model["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in model["added_tokens"]):
            raise ValueError(f"{name}: added tokens that depend on what is beside them")
        of = _byte_of_character()
        ranks = {bytes(of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in added}
        loaded[name] = tiktoken.Encoding(name, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)
    return loaded[name]


def token_ids(name: str, text: str) -> np.ndarray:
    """Ids of a whole text as little-endian unsigned 32-bit integers; added tokens in it are ordinary text."""
    return np.array(encoder(name).encode_ordinary(text), dtype="<u4")


def document_ids(name: str, text: str) -> np.ndarray:
    """Ids of a whole text as the tokenizer's library gives them: added tokens in it have their own ids."""
    return np.array(encoder(name).encode(text, allowed_special="all"), dtype="<u4")


def pieces(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a token sequence: whole ones, the first may be shorter."""
    first = length % most or min(length, most)
    return [(0, first)] + [(at, most) for at in range(first, length, most)] if length else []
