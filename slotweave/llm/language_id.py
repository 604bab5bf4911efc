"""Language identification by a linear-chain conditional random field over the words of a text.

States are the languages that the training rows have. A word's emission scores come from hashed byte n-grams of it
with its ends marked (those at an end are its affixes), the word itself, and lexicons of the languages' most frequent
words; transitions are learned from code-switched sequences, put together from stretches of training documents. Words
are labelled by their forward-backward marginals over the whole text, and a text by the sum over its words.

Training reads the whole texts of a bounded sample of labelled documents: about SAMPLE_DOCS of each language and
SAMPLE_ALL of all, drawn by a hash. Every text is labelled from all its words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64

#: Expected number of sampled training documents of each language, and of all together.
SAMPLE_DOCS, SAMPLE_ALL = 300, 20_000
BITS = 16
LEXICON = 500
EPOCHS, STEP, L2 = 6, 0.3, 1e-6
LENGTH, BATCH = 48, 64
CHUNK = 64
CACHE_WORDS = 250_000
#: Numbers that the marginals of the texts labelled at once may take (a longer text alone may take more).
AT_ONCE = 4_000_000
UNDETERMINED = "und"
#: A word begins with a letter and goes on with letters and their marks.
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    """The runs of letters, lower-cased."""
    return _WORDS.findall(text.lower())


# --- features -------------------------------------------------------------------------------------------------------
def ngram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed ids of the byte 2- to 4-grams of each marked word and of the word itself, and where each word begins."""
    parts = [b"\x02" + w.encode() + b"\x03" for w in words]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    raw = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(parts)), size)
    ids, whose = [], []
    h = raw.copy()
    for n in (2, 3, 4):
        if len(raw) < n:
            break
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + raw[n - 1 :]
        inside = owner[: len(h)] == owner[n - 1 :]
        ids.append(mix64(h[inside] + np.uint64(n)) >> np.uint64(64 - BITS))
        whose.append(owner[: len(h)][inside])
    ids.append(np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts)) >> np.uint64(64 - BITS))
    whose.append(np.arange(len(parts)))
    ids, whose = np.concatenate(ids).astype(np.int64), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return ids[order], np.searchsorted(whose[order], np.arange(len(parts)))


class Model:
    """Weights of the n-grams (2**BITS x L), of the lexicons (L x L), and log transitions (L x L)."""

    def __init__(self, labels: list[str]) -> None:
        n = len(labels)
        self.labels = labels
        self.gram = np.zeros((1 << BITS, n), np.float32)
        self.lexical = np.zeros((n, n), np.float32)
        self.transition = np.zeros((n, n), np.float32)
        self.lexicon: dict[str, int] = {}

    def lexicon_rows(self, words: list[str]) -> np.ndarray:
        """One bit a language that has the word in its lexicon."""
        mask = np.array([self.lexicon.get(w, 0) for w in words], object)
        return np.array([[(m >> k) & 1 for k in range(len(self.labels))] for m in mask], np.float32).reshape(len(words), -1)

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        ids, start = ngram_ids(words)
        out = np.add.reduceat(self.gram[ids], start, axis=0)
        known = [i for i, w in enumerate(words) if w in self.lexicon]
        if known:
            out[known] += self.lexicon_rows([words[i] for i in known]) @ self.lexical
        return out


# --- inference ------------------------------------------------------------------------------------------------------
def marginals(e: np.ndarray, offsets: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """P(label of each word) by forward-backward, for the documents whose words are e[offsets[d]:offsets[d + 1]].

    Documents are cut to chunks that run in step: products of their transfer matrices give the vectors at the cuts,
    and then all chunks go forward and backward at once. A state before the first word is uniform."""
    n, labels = len(e), e.shape[1]
    t = np.exp(transition.astype(np.float64))
    lens = np.diff(offsets)
    per = -(-lens // CHUNK)
    total = int(per.sum())
    if not total:
        return np.zeros((0, labels))
    first = np.concatenate([[0], np.cumsum(per)[:-1]])
    doc = np.repeat(np.arange(len(lens)), per)
    number = np.arange(total) - first[doc]
    at = (offsets[:-1][doc] + number * CHUNK)[:, None] + np.arange(CHUNK)[None, :]
    real = at < offsets[1:][doc][:, None]
    x = np.ones((n + 1, labels))
    x[:n] = np.exp(e - e.max(axis=1, keepdims=True))
    x = x[np.where(real, at, n)]
    full = real.all(axis=0)

    m = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for k in range(CHUNK):
        new = (m.reshape(-1, labels) @ t).reshape(total, labels, labels) * x[:, k, None, :]
        m = new if full[k] else np.where(real[:, k, None, None], new, m)
        if k % 8 == 7:
            m /= m.sum(axis=(1, 2), keepdims=True)
    m /= m.sum(axis=(1, 2), keepdims=True)
    by_number = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[by_number], np.arange(number.max() + 2))
    ahead = np.full((total, labels), 1 / labels)
    behind = np.ones((total, labels))
    for r in range(1, number.max() + 1):
        c = by_number[bounds[r] : bounds[r + 1]]
        v = np.einsum("cl,clk->ck", ahead[c - 1], m[c - 1])
        ahead[c] = v / v.sum(axis=1, keepdims=True)
    for r in range(number.max(), 0, -1):
        c = by_number[bounds[r] : bounds[r + 1]]
        v = np.einsum("clk,ck->cl", m[c], behind[c])
        behind[c - 1] = v / v.sum(axis=1, keepdims=True)
    post = np.empty((total, CHUNK, labels))
    a = ahead
    for k in range(CHUNK):
        new = (a @ t) * x[:, k]
        a = new if full[k] else np.where(real[:, k, None], new, a)
        a = a / a.sum(axis=1, keepdims=True)
        post[:, k] = a
    b = behind
    for k in range(CHUNK - 1, -1, -1):
        post[:, k] *= b
        new = (x[:, k] * b) @ t.T
        b = new if full[k] else np.where(real[:, k, None], new, b)
        b = b / b.sum(axis=1, keepdims=True)
    post = post[real]
    return post / post.sum(axis=1, keepdims=True)


class Labeller:
    """Emissions by word, kept for the words met lately."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.row: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.labels)), np.float32)

    def emissions(self, words: list[str]) -> np.ndarray:
        row = self.row
        got = list(map(row.get, words))
        if None in got:
            new = list(dict.fromkeys(w for w, g in zip(words, got, strict=True) if g is None))
            if len(row) + len(new) > CACHE_WORDS:
                row.clear()
                new = list(dict.fromkeys(words))
            while len(row) + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            e = self.model.emissions(new)
            self.table[len(row) : len(row) + len(new)] = e
            for w in new:
                row[w] = len(row)
            got = list(map(row.__getitem__, words))
        return self.table[np.array(got, np.int64)] if words else np.zeros((0, self.table.shape[1]), np.float32)

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and the mean of its marginal over the words; texts go together as far as their
        marginals, and the products of their chunks, stay within AT_ONCE numbers."""
        names, scores, group, size = [], [], [], 0
        n = len(self.model.labels)
        for t in texts:
            words = words_of(t) if t else []
            need = n * (len(words) + n * -(-len(words) // CHUNK))
            if group and size + need > AT_ONCE:
                more = self._label(group)
                names, scores, group, size = names + more[0], scores + more[1], [], 0
            group.append(words)
            size += need
        more = self._label(group)
        return names + more[0], scores + more[1]

    def _label(self, words: list[list[str]]) -> tuple[list[str], list[float]]:
        lens = np.array([len(w) for w in words], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lens)])
        e = self.emissions([w for ws in words for w in ws])
        p = marginals(e, offsets, self.model.transition)
        some = np.flatnonzero(lens)
        names, scores = [UNDETERMINED] * len(words), [0.0] * len(words)
        if len(some):
            mean = np.add.reduceat(p, offsets[some], axis=0) / lens[some][:, None]
            for i, v in zip(some.tolist(), mean, strict=True):
                k = int(v.argmax())
                names[i], scores[i] = self.model.labels[k], float(min(1.0, max(0.0, v[k])))
        return names, scores

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, marginal) of each word of a text."""
        words = words_of(text)
        p = marginals(self.emissions(words), np.array([0, len(words)]), self.model.transition)
        return [(w, self.model.labels[int(v.argmax())], float(v.max())) for w, v in zip(words, p, strict=True)]


# --- training -------------------------------------------------------------------------------------------------------
def train(rows: list[tuple[str, list[str]]], seed: int = 10) -> Model | None:
    """``rows``: (language, consecutive words). Minimizes the negative log-likelihood of code-switched sequences."""
    labels = sorted({lang for lang, words in rows if words})
    if not labels:
        return None
    model, rng = Model(labels), np.random.default_rng(seed)
    index = {lang: k for k, lang in enumerate(labels)}
    counts = [Counter() for _ in labels]
    for lang, words in rows:
        counts[index[lang]].update(words)
    for k, c in enumerate(counts):
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            model.lexicon[w] = model.lexicon.get(w, 0) | (1 << k)
    types = sorted(set().union(*counts))
    type_of = {w: i for i, w in enumerate(types)}
    ids, start = ngram_ids(types)
    size = np.diff(np.append(start, len(ids)))
    lex = model.lexicon_rows(types)
    docs = [(np.array([type_of[w] for w in words]), index[lang]) for lang, words in rows if words]
    n = len(labels)
    g2, l2, t2 = np.full(model.gram.shape, 1e-2, np.float32), np.full((n, n), 1e-2), np.full((n, n), 1e-2)
    for _ in range(EPOCHS):
        tokens, truth = [], []
        # stretches of several documents one after another: languages switch inside a sequence
        stretches = [(d[i : i + k], lab) for d, lab in docs for i, k in _stretches(len(d), rng)]
        for j in rng.permutation(len(stretches)):
            d, lab = stretches[j]
            tokens.append(d)
            truth.append(np.full(len(d), lab))
        tokens, truth = np.concatenate(tokens), np.concatenate(truth)
        whole = len(tokens) // LENGTH
        if whole == 0:
            tokens, truth, length = tokens[None, :], truth[None, :], len(tokens)
        else:
            tokens, truth, length = tokens[: whole * LENGTH].reshape(whole, LENGTH), truth[: whole * LENGTH].reshape(whole, LENGTH), LENGTH
        for at in range(0, len(tokens), BATCH):
            tok, y = tokens[at : at + BATCH], truth[at : at + BATCH]
            use, back = np.unique(tok, return_inverse=True)
            span = np.concatenate([ids[start[u] : start[u] + size[u]] for u in use])
            begin = np.concatenate([[0], np.cumsum(size[use])[:-1]])
            e = np.add.reduceat(model.gram[span], begin, axis=0) + lex[use] @ model.lexical
            e = e[back.reshape(-1)].reshape(*tok.shape, n).astype(np.float64)
            d, dt = gradient(e, y, model.transition.astype(np.float64))
            by_type = np.stack([np.bincount(back.reshape(-1), d[:, :, k].ravel(), len(use)) for k in range(n)], axis=1)
            scale = 1 / len(tok)
            u, inv = np.unique(span, return_inverse=True)
            each = np.repeat(by_type, size[use], axis=0)
            grad = np.stack([np.bincount(inv.reshape(-1), each[:, k], len(u)) for k in range(n)], axis=1)
            grad = (grad * scale + L2 * model.gram[u]).astype(np.float32)
            g2[u] += grad**2
            model.gram[u] -= STEP * grad / np.sqrt(g2[u])
            for w, acc, gr in ((model.lexical, l2, lex[use].T @ by_type * scale), (model.transition, t2, dt * scale)):
                acc += gr**2
                w -= (STEP * gr / np.sqrt(acc)).astype(np.float32)
    return model


def _stretches(n: int, rng: np.random.Generator) -> Iterator[tuple[int, int]]:
    i = 0
    while i < n:
        k = int(rng.integers(5, 60))
        yield i, k
        i += k


def gradient(e: np.ndarray, y: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log-likelihood of labels ``y`` in a batch of equally long sequences, by emissions and by log
    transitions: what the model expects less what is there. The state before the first word is uniform and unseen; the
    transition from it counts by its share given the first label."""
    t = np.exp(transition)
    x = np.exp(e - e.max(axis=2, keepdims=True))
    rows, length, n = x.shape
    a, b = np.empty_like(x), np.empty_like(x)
    v = np.full((rows, n), 1 / n)
    for k in range(length):
        v = (v @ t) * x[:, k]
        v /= v.sum(axis=1, keepdims=True)
        a[:, k] = v
    v = np.ones((rows, n))
    for k in range(length - 1, -1, -1):
        b[:, k] = v
        v = (x[:, k] * v) @ t.T
        v /= v.sum(axis=1, keepdims=True)
    before = np.concatenate([np.full((rows, 1, n), 1 / n), a[:, :-1]], axis=1)
    xb = x * b
    # of each place the weights of the pairs (state before, state), each place to sum 1
    total = np.einsum("rki,ij,rkj->rk", before, t, xb)
    dt = t * np.einsum("rki,rkj->ij", before / total[:, :, None], xb)
    np.subtract.at(dt, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    np.subtract.at(dt.T, y[:, 0], (t / t.sum(axis=0)).T[y[:, 0]])
    post = a * b
    post /= post.sum(axis=2, keepdims=True)
    np.subtract.at(post, (np.arange(rows)[:, None], np.arange(length)[None, :], y), 1)
    return post, dt


# --- Spark ----------------------------------------------------------------------------------------------------------
def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) -> (lang, words)."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(1), pa.array([words_of(t) for t in b.column(0).to_pylist()], pa.list_(pa.string()))], names=["lang", "words"])


def learn(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", sample: int = SAMPLE_DOCS) -> Model | None:
    """A model from the rows of ``docs`` (all of them may be learned from) with a language; None if there is none.
    About ``sample`` of each language are drawn, or fewer where there are so many languages that all together would be
    more than SAMPLE_ALL. Rows that repeat an id are drawn together."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null")
    n = materialize(rows.groupBy("lang").agg(F.count("*").alias("n")), "lang-count")
    place = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 40)) / float(1 << 40)
    # ids are drawn without the texts; the tables are small and of known size, so that texts stay where they are
    each = min(float(sample), SAMPLE_ALL / max(1, n.count()))
    ids = rows.select("doc_id", "lang").join(n, "lang").where(place < F.lit(each) / F.col("n")).select("doc_id").distinct()
    chosen = rows.join(materialize(ids, "lang-sample"), "doc_id").select("text", "lang")
    got = chosen.mapInArrow(_sample_words, "lang string, words array<string>").collect()
    return train(sorted((r["lang"], list(r["words"])) for r in got))


def _label_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labeller = Labeller(model) if model else None
        for whole in batches:
            for at in range(0, whole.num_rows, 300):
                b = whole.slice(at, 300)
                texts = b.column(1).to_pylist()
                names, scores = labeller.label(texts) if labeller else ([UNDETERMINED] * len(texts), [0.0] * len(texts))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return rows


def identify(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score), a row for each row of ``docs``: the language of the whole text and the mean of its
    words' marginals; `und` and 0 where the text is null or has no letter, or nothing was learned. Repeated rows are
    labelled alike; columns other than the key and the text are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_label_rows(shared), "doc_id long, lang_pred string, score double")
