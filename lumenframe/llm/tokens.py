"""Token ids of a byte-level BPE vocabulary file, by the fastest of the installed libraries."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
#: What a file's parts before its merges must be for ids to follow from the vocabulary alone.
PLAIN_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}
PLAIN_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _merges_by_id(file: dict) -> bool:
    """Whether the file is plain byte-level BPE whose merges are in the order of their results' ids."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    if any(t.get(k) for t in file.get("added_tokens", ()) for k in ("lstrip", "rstrip", "single_word")):
        return False
    if file.get("normalizer") or any(model.get(k, v) != v for k, v in PLAIN_MODEL.items()) or any(split.get(k, v) != v for k, v in PLAIN_SPLIT.items()) or split.get("type") != "ByteLevel":
        return False
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    return all(a < b for a, b in zip(made, made[1:], strict=False)) and made[:1] != [-1]


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids, as a tokenizers file gives them with add_special_tokens=False: a special token's string in a text is its id.

    If the file's merges are in the order of its ids, which is checked here, another library gives the
    same ids in a quarter of the time; else the file's own library does. path: where every worker finds
    the file; None is the installed vocabulary.
    """
    import public_tokenizers

    path = path or public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    if not _merges_by_id(file):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        return lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    # Byte-level files write byte b as itself if printable, else as the next free code point from 256.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
    ranks = {bytes(byte[c] for c in token): i for token, i in file["model"]["vocab"].items() if all(c in byte for c in token) and token not in added}
    fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: fast.encode_to_numpy(text, allowed_special="all")
