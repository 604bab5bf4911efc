"""Edit-aware token counts.

The pre-tokens of a document (pieces that the BPE encodes apart) are grouped to leaves of LEAF; a segment tree holds the
sums of their characters and tokens. An edit re-cuts the text only from the last boundary of leaves that can't have seen it
(a pre-token is decided by its own characters and at most two after them) to the first old boundary of leaves beyond it
that the new cut meets: from there on the same text is cut the same way. The leaves in between are replaced and the
sums above them updated.

Trees are kept as a table (``build``): the text, and the characters and tokens of its leaves.
``edited`` takes a batch of edits against it and gives the table as it is then, which the next batch is taken against;
nothing but the edited regions is cut or encoded again, and a text is put together once for all its edits. A text that
holds a string that the tokenizer takes for a token of its own is cut around it, and anew after an edit."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .tokens import CACHE_UNITS, default_path, encoder

LEAF = 8
#: Edits that the query applies: personal data becomes a mark. Each has a character that a text must hold to be searched,
#: and a pattern of bounded length, so that matching stays linear.
REDACTIONS = (("@", re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,4}"), "[EMAIL]"), ("", re.compile(r"\+?\d[\d ()-]{7,17}\d"), "[NUMBER]"))


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, path: str) -> None:
        import public_tokenizers

        self.encoder = encoder(path)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cache: dict[str, int] = {}
        self.read = 0  # characters that were cut and encoded

    def counts(self, pre: list[str]) -> list[int]:
        cache = self.cache
        new = list(dict.fromkeys(p for p in pre if p not in cache))
        if new:
            if len(cache) + len(new) > CACHE_UNITS:
                cache.clear()
                new = list(dict.fromkeys(pre))
            for p, ids in zip(new, self.encoder.encode_units(new), strict=True):
                cache[p] = 1 if self.encoder.added.fullmatch(p) else len(ids) // 4
        return [cache[p] for p in pre]

    def cut(self, text: str) -> list[str]:
        self.read += len(text)
        out, at = [], 0
        for m in self.encoder.added.finditer(text):
            out += [*self.pattern.findall(text[at : m.start()]), m.group()]
            at = m.end()
        return [*out, *self.pattern.findall(text[at:] if at else text)]

    def cut_on(self, head: str, tail: str, at: int) -> Iterator[str]:
        """The pre-tokens of head + tail[at:], of which no more is read than they need."""
        size, pos = 256, 0
        while True:
            text, whole = head + tail[at : at + size], at + size >= len(tail)
            while (m := self.pattern.match(text, pos)) and (whole or m.end() + 2 < len(text)):
                pos = m.end()
                yield m.group()
            if whole:
                return
            size *= 2


def leaves_of(sizes: list[int], tokens: list[int], per: int = LEAF) -> tuple[list[int], list[int]]:
    """Characters and tokens of leaves of ``per`` pre-tokens."""
    at = range(0, len(sizes), per)
    return [sum(sizes[i : i + per]) for i in at], [sum(tokens[i : i + per]) for i in at]


class TokenTree:
    """Sums of characters and tokens over the leaves of a document, as a segment tree each."""

    def __init__(self, counter: Counter, chars: list[int], tokens: list[int]) -> None:
        self.counter, self.n = counter, len(chars)
        n = self.width = max(1, 1 << (max(1, self.n) - 1).bit_length())
        self.chars, self.tokens = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)
        self.chars[n : n + self.n], self.tokens[n : n + self.n] = chars, tokens
        level = n
        while level > 1:
            half = level // 2
            for sums in (self.chars, self.tokens):
                sums[half:level] = sums[level : 2 * level].reshape(-1, 2).sum(axis=1)
            level = half

    @classmethod
    def of(cls, counter: Counter, text: str) -> TokenTree:
        pre = counter.cut(text)
        return cls(counter, *leaves_of(list(map(len, pre)), counter.counts(pre)))

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    @property
    def leaves(self) -> tuple[list[int], list[int]]:
        return tuple(x[self.width : self.width + self.n].tolist() for x in (self.chars, self.tokens))

    def _leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character (the last, beyond the end), and where it starts."""
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if char >= start + self.chars[k] and k + 1 < 2 * self.width and self.chars[k + 1]:
                start += int(self.chars[k])
                k += 1
        return k - self.width, start

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        k = self.width + leaf
        dc, dt = chars - int(self.chars[k]), tokens - int(self.tokens[k])
        while k:
            self.chars[k] += dc
            self.tokens[k] += dt
            k //= 2

    def edit(self, text: str, edits: list[tuple[int, int, str]]) -> str:
        """Replaces text[start:end] by new for each (start, end, new) of ``edits``, which are in order and apart; the
        text that this gives. They are applied from the last to the first, so that places stay."""
        parts, at = [], 0
        for start, end, new in edits:
            parts += [text[at:start], new]
            at = end
        out = "".join([*parts, text[at:]])
        if self.counter.encoder.added.search(text) or self.counter.encoder.added.search(out):
            self.__init__(self.counter, *TokenTree.of(self.counter, out).leaves)
            return out
        shift = len(out) - len(text)
        for start, end, new in reversed(edits):
            shift -= len(new) - (end - start)
            self._replace(text, out, start, end, len(new), shift)
        return out

    def _replace(self, text: str, out: str, start: int, end: int, size: int, shift: int) -> None:
        """The document reads text[:end] and then on as it will; text[start:end] becomes the ``size`` characters of
        ``out`` at start + shift."""
        delta, length = size - (end - start), int(self.chars[1])
        if not length:
            self.__init__(self.counter, *TokenTree.of(self.counter, out[start + shift :]).leaves)
            return
        # the last boundary before which no pre-token can have seen the edit
        first, pos = self._leaf_at(max(0, start - 2))
        # cut until an old boundary beyond the edit is met
        last, at = self._leaf_at(min(max(end, pos), length - 1))
        begin, bound = pos, at + int(self.chars[self.width + last])
        pre: list[str] = []
        met = False
        for piece in self.counter.cut_on(text[pos:start], out, start + shift):
            pre.append(piece)
            pos += len(piece)
            if pos >= start + size:
                while bound < pos - delta and last + 1 < self.n:
                    last += 1
                    bound += int(self.chars[self.width + last])
                if bound == pos - delta and bound >= end:
                    met = True
                    break
        self.counter.read += pos - begin
        if not met:
            last = self.n - 1
        sizes, tokens, touched = list(map(len, pre)), self.counter.counts(pre), last - first + 1
        if len(pre) <= LEAF * 2 * touched:
            # the touched leaves take the new content; leaves that are left without any hold nothing
            new = leaves_of(sizes, tokens, max(1, -(-len(pre) // touched)))
            for k in range(touched):
                self._set(first + k, *((new[0][k], new[1][k]) if k < len(new[0]) else (0, 0)))
        else:
            kept, new = self.leaves, leaves_of(sizes, tokens)
            self.__init__(self.counter, *(x[:first] + n + x[last + 1 :] for x, n in zip(kept, new, strict=True)))


def redactions(text: str) -> list[tuple[int, int, str]]:
    """(start, end, replacement) of the personal data of a text, in order and without overlaps."""
    found = sorted((m.start(), m.end(), mark) for need, p, mark in REDACTIONS if need in text for m in p.finditer(text))
    out, at = [], 0
    for s, e, mark in found:
        if s >= at:
            out.append((s, e, mark))
            at = e
    return out


# --- Spark ----------------------------------------------------------------------------------------------------------
TREES = "doc_id long, text string, n_tokens long, chars array<int>, tokens array<int>"
_LISTS = ("chars", "tokens")


def _lists(parts: list) -> pa.ListArray:
    """A list column from the rows' numbers."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate([np.asarray(p, np.int32) for p in parts]) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _build_rows(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                chars, tokens = [], []
                for text in b.column(1).to_pylist():
                    pre = counter.cut(text or "")
                    starts = np.arange(0, len(pre), LEAF)
                    for out, x in ((chars, list(map(len, pre))), (tokens, counter.counts(pre))):
                        out.append(np.add.reduceat(np.array(x, np.int64), starts) if x else [])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([int(sum(t)) for t in tokens], pa.int64()), _lists(chars), _lists(tokens)], names=["doc_id", "text", "n_tokens", *_LISTS])

    return rows


def build(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(doc_id, text, n_tokens, chars, tokens): the tree of each row of ``docs``. A null text stays null and counts as
    empty, with 0 tokens; very long texts are read at once by one task, in memory of a few times their size; repeated
    rows are counted alike; an empty table gives an empty result; other columns are not looked at."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_build_rows(path or default_path()), TREES)


def _edit_rows(path: str, find_edits, with_trees: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                ids, texts, before = (b.column(k) for k in range(3))
                texts, after = texts.to_pylist(), before.to_pylist()
                n_edits, recut = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
                kept = [[np.asarray(row.values) for row in b.column(3 + k)] if with_trees else None for k in range(2)]
                given = b.column(5).to_pylist() if find_edits is None else None
                for j, text in enumerate(texts):
                    edits = find_edits(text or "") if given is None else sorted((x["start"], x["end"], x["new"]) for x in given[j] or [])
                    if not edits:
                        continue
                    tree, read = TokenTree(counter, *(b.column(3 + k)[j].as_py() for k in range(2))), counter.read
                    texts[j] = tree.edit(text or "", edits)
                    after[j], n_edits[j], recut[j] = tree.total, len(edits), counter.read - read
                    if with_trees:
                        for k, new in enumerate(tree.leaves):
                            kept[k][j] = new
                out = [ids, *((pa.array(texts, pa.string()), pa.array(after, pa.int64()), *map(_lists, kept)) if with_trees else (pa.array(after, pa.int64()),)), before, pa.array(n_edits), pa.array(recut)]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", *(("text", "n_tokens", *_LISTS) if with_trees else ("n_tokens",)), "n_tokens_before", "n_edits", "chars_recut"])

    return rows


_COUNTS = "n_tokens_before long, n_edits long, chars_recut long"


def edited(trees: DataFrame, edits: DataFrame, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """The table of ``build`` after ``edits`` (key, start, end, new: replacements of text[start:end], which are apart and
    start at different places), with n_tokens_before, n_edits and chars_recut, the characters that were cut again. Rows
    that repeat an id take the same edits. Edits of one document travel together; their number is bounded by its length."""
    e = edits.groupBy(F.col(key).cast("long").alias("_of")).agg(F.collect_list(F.struct("start", "end", "new")).alias("edits"))
    rows = trees.select("doc_id", "text", "n_tokens", *_LISTS).join(e, F.col("doc_id") == F.col("_of"), "left").drop("_of")
    return rows.mapInArrow(_edit_rows(path or default_path(), None, True), f"{TREES}, {_COUNTS}")


def redacted(trees: DataFrame, path: str | None = None, with_trees: bool = True) -> DataFrame:
    """As ``edited``, with the marking of personal data as edits; without the trees only the numbers."""
    rows = trees.select("doc_id", "text", "n_tokens", *_LISTS)
    return rows.mapInArrow(_edit_rows(path or default_path(), redactions, with_trees), f"{TREES if with_trees else 'doc_id long, n_tokens long'}, {_COUNTS}")


def count_redacted(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_after, chars_recut): tokens of each text before and after personal data is
    marked, and how many characters had to be cut again for it. The trees are written as a table, which the edits are
    taken against."""
    out = redacted(materialize(build(docs, text, key, path), "token-trees"), path, with_trees=False)
    return out.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_after"), "chars_recut")
