"""Ids by a byte-level BPE file, as its library gives them, at a quarter of its time.

The file's ids equal its merge order and every token is what merging its own bytes ends in
(tested), so merging whatever pair makes the token of least id takes the same steps as
the file's merge list; the faster library that merges so is used. It overflows its stack on
white space runs of about a million characters; texts with very long ones are encoded
by the file's own library, with the same ids.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

#: from so many white space characters in a row the file's own library encodes a text
LONG_SPACE = 100_000
_LONG = re.compile(r"\s{%d}" % LONG_SPACE)


def byte_level(path: str, special: bool) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """(encode, bytes of each id); strings of special tokens get their ids if ``special``, else they are plain text."""
    import public_tokenizers
    import tiktoken

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    added = {t["content"]: t["id"] for t in held["added_tokens"]}
    vocab = held["model"]["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the format writes other bytes as 256, 257, ...
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}
    merged = [vocab["".join(m) if not isinstance(m, str) else m.replace(" ", "")] for m in held["model"]["merges"]]
    if held["normalizer"] or held["pre_tokenizer"]["add_prefix_space"] or merged != sorted(merged):
        raise ValueError(f"{path} is no plain byte-level BPE in merge order")
    fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added if special else {})
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = not special

    def encode(text: str) -> list[int]:
        if len(text) >= LONG_SPACE and _LONG.search(text):
            return own.encode(text, add_special_tokens=False).ids
        return fast.encode(text, allowed_special="all") if special else fast.encode_ordinary(text)

    spelled = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        spelled[i] = token
    return encode, spelled
