"""Token ids of a `tokenizers` file, with a bounded cache of space-led units."""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Units kept at most; the cache starts anew when it is full.
CACHE_UNITS = 200_000
#: Where cutting before each space could change the ids: a space beside other white space. Such a text is encoded whole.
_IRREGULAR = re.compile(r" \s|\s ")
_loaded: dict[str, UnitEncoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class UnitEncoder:
    """The ids of a byte-level BPE whose pattern starts a new pre-token at each single space between other characters:
    the text is cut there, and each distinct unit is encoded once."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.ranked, self.size = _ranked(spec)
        #: The strings that the tokenizer takes for tokens of their own wherever they stand.
        self.added = re.compile("|".join(sorted((re.escape(t["content"]) for t in spec.get("added_tokens") or []), key=len, reverse=True)) or r"(?!)")
        self.cache: dict[str, bytes] = {}

    def encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of each of some units, as little-endian 32-bit numbers; by the faster engine where it merges alike.
        Units that begin with their only space and end with none are encoded at one go: no pre-token spans two."""
        if self.ranked is None:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(units, add_special_tokens=False)]
        out: list[bytes] = [b""] * len(units)
        bulk = []
        for k, u in enumerate(units):
            if len(u) > 1 and u[0] == " " and not u[1].isspace() and not u[-1].isspace():
                bulk.append(k)
            elif u:
                out[k] = np.array(self.ranked.encode_ordinary(u), "<u4").tobytes()
        if bulk:
            ids = np.array(self.ranked.encode_ordinary("".join([units[k] for k in bulk])), "<u4")
            ends = np.cumsum([len(units[k].encode()) for k in bulk])
            cuts = [0, *(4 * (np.searchsorted(np.cumsum(self.size[ids]), ends) + 1)).tolist()]
            raw = ids.tobytes()
            for k, s, e in zip(bulk, cuts, cuts[1:], strict=False):
                out[k] = raw[s:e]
        return out

    def encode(self, text: str) -> np.ndarray:
        if _IRREGULAR.search(text) or self.added.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        units = text.split(" ")
        units = [units[0], *[" " + u for u in units[1:]]]
        cache = self.cache
        try:
            return np.frombuffer(b"".join([cache[u] for u in units]), dtype="<u4")
        except KeyError:
            pass
        if len(cache) > CACHE_UNITS:
            cache.clear()
        new = [u for u in dict.fromkeys(units) if u not in cache]
        for u, ids in zip(new, self.encode_units(new), strict=True):
            cache[u] = ids
        return np.frombuffer(b"".join([cache[u] for u in units]), dtype="<u4")


def _ranked(spec: dict):
    """The same byte-level BPE for tiktoken, and the bytes of each id; or None where it could differ: ids have to be in the order of the merges, and
    the text has to be cut by the usual pattern and nothing else."""
    import public_tokenizers
    import tiktoken

    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if model.get("type") != "BPE" or not plain or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        return None, None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [model["vocab"].get(a + b, -1) for a, b in pairs]
    if merged != sorted(set(merged)) or (merged and merged[0] < 256):
        return None, None
    tokens = [*byte_of, *(a + b for a, b in pairs)]
    if any(t not in model["vocab"] for t in tokens):
        return None, None
    ranks = {bytes(byte_of[c] for c in t): model["vocab"][t] for t in tokens}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        size[i] = len(token)
    return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def encoder(path: str) -> UnitEncoder:
    if path not in _loaded:
        _loaded[path] = UnitEncoder(path)
    return _loaded[path]
