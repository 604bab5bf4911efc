"""Quality classifier by co-training of two views.

View 1 is the text's content: shares and pairs of character classes, line and word statistics, hashed words. View 2 is
the page's metadata: source, language and length. Each view has a logistic model, fitted until its gradient vanishes
(TOLERANCE). In each round both views judge every document that no label was drawn for, and the most confident
labels of one view over the whole corpus join the other's training rows. The views are calibrated on labelled rows that
neither was trained on, and combined by a logistic model of their two scores there, with weights of 0 or more: a view
that knows nothing gets no say. Every document is then scored from its whole text.

Features are taken from the texts once and kept as a table (80 statistics and the words that occur, about a third of the
text); the rounds read that. The one sample is of labelled rows: about LABELLED of them, drawn by a hash, are learned
from. PER_ROUND is how many pseudo-labels a view hands on in a round."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release, trimmed

LABELLED = 5000
#: Hashed groups in which the surest documents are cut before their keys come to the driver.
GROUPS = 32
WORDS, SOURCES, LANGS, SIZES = 1024, 256, 32, 24
ROUNDS, PER_ROUND, SURE = 4, 150, 0.97
#: A fit ends when the largest part of its gradient, for a mean loss, is below this.
TOLERANCE = 1e-7
#: Documents are rejected below this probability of being good.
THRESHOLD = 0.3

# classes: 0 control and white space but newline, 1 newline, 2 digit, 3 upper, 4 lower, 5 sentence marks, 6 other ASCII, 7 beyond
_CLASS = np.full(256, 6, np.uint8)
_CLASS[:33] = 0
_CLASS[10] = 1
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 2, 3, 4, 7
_CLASS[[33, 34, 39, 44, 45, 46, 58, 59, 63]] = 5
STATS = 8 + 64 + 8
TEXT = 1 + STATS + WORDS
META = 1 + SOURCES + LANGS + SIZES


def text_features(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, buckets of the words and their weights, in half precision: what is learned from is what is scored."""
    out = np.zeros(STATS, np.float32)
    if not text:
        return out.astype(np.float16), np.empty(0, np.uint16), np.empty(0, np.float16)
    c = _CLASS[np.frombuffer(text, np.uint8)].astype(np.int64)
    n = len(c)
    out[:8] = np.bincount(c, minlength=8) / n
    out[8:72] = 3 * np.bincount(c[:-1] * 8 + c[1:], minlength=64) / n
    words = text.split()
    lines = text.split(b"\n")
    k = len(words)
    if not k:
        return out.astype(np.float16), np.empty(0, np.uint16), np.empty(0, np.float16)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, k)
    size = np.fromiter(map(len, words), np.int64, k)
    out[72:] = (len(np.unique(h)) / k, np.log1p(k) / 10, min(size.mean() / 10, 100), min(size.std() / 10, 3), size.max() / (size.max() + 50), len(set(lines)) / len(lines), np.log1p(n / len(lines)) / 10, np.log1p(len(lines)) / 10)
    tf = np.log1p(np.bincount((h >> np.uint64(54)).astype(np.int64), minlength=WORDS))
    at = np.flatnonzero(tf)
    return out.astype(np.float16), at.astype(np.uint16), (tf[at] / np.linalg.norm(tf)).astype(np.float16)


def _bucket(value: str | None, n: int) -> int:
    return 0 if value is None else 1 + xxhash.xxh3_64_intdigest(value.encode()) % (n - 1)


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """The three columns that are 1 besides the constant."""
    size = 0 if n_chars is None else min(SIZES - 1, 1 + max(0, int(n_chars)).bit_length())
    return np.array([1 + _bucket(source, SOURCES), 1 + SOURCES + _bucket(lang, LANGS), 1 + SOURCES + LANGS + size], np.uint16)


def text_matrix(stats: list[bytes], words: list[bytes], tf: list[bytes]) -> np.ndarray:
    """A row of TEXT numbers from each row's features, the constant first."""
    x = np.zeros((len(stats), TEXT), np.float32)
    x[:, 0] = 1
    x[:, 1 : 1 + STATS] = np.frombuffer(b"".join(stats), np.float16).reshape(len(stats), STATS)
    row = np.repeat(np.arange(len(stats)), [len(w) // 2 for w in words])
    x[row, 1 + STATS + np.frombuffer(b"".join(words), np.uint16).astype(np.int64)] = np.frombuffer(b"".join(tf), np.float16)
    return x


def meta_matrix(meta: list[bytes]) -> np.ndarray:
    x = np.zeros((len(meta), META), np.float32)
    x[:, 0] = 1
    x[np.arange(len(meta))[:, None], np.frombuffer(b"".join(meta), np.uint16).astype(np.int64).reshape(len(meta), 3)] = 1
    return x


# --- models ---------------------------------------------------------------------------------------------------------
def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def loss_and_gradient(x: np.ndarray, y: np.ndarray, w: np.ndarray, reg: np.ndarray) -> tuple[float, np.ndarray]:
    """Of the mean logistic loss with L2 weights ``reg`` (divided by the rows as well)."""
    z, n = x @ w, len(x)
    return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (reg * w * w).sum()) / n, (x.T @ (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) + reg * w) / n


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, start: np.ndarray | None = None, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights by Newton steps, halved while they don't lower the loss, until no part of the gradient is above
    ``tolerance``. L2 on all but the first, the constant; the loss is strictly convex, so ``start`` only saves steps."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    n, reg = len(x), np.full(x.shape[1], l2)
    reg[0] = 1e-6 * max(l2, 1e-6)
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    loss, g = loss_and_gradient(x, y, w, reg)
    while np.abs(g).max() > tolerance:
        p = sigmoid(x @ w)
        curve = (x.T * np.maximum(p * (1 - p), 1e-12)) @ x + np.diag(reg)
        step, size = np.linalg.solve(curve, n * g), 1.0
        while size > 1e-10:
            new_loss, new_g = loss_and_gradient(x, y, w - size * step, reg)
            if new_loss <= loss - 1e-4 * size * float(g @ step):
                break
            size /= 2
        else:  # the loss can't be told apart any more
            return w
        w, loss, g = w - size * step, new_loss, new_g
    return w


def non_negative(x: np.ndarray, y: np.ndarray, l2: float) -> np.ndarray:
    """As ``logistic`` with all weights but the constant's 0 or more: of all sets of columns that may be used, the best
    fit whose weights are allowed."""
    k, best, best_loss = x.shape[1] - 1, None, np.inf
    reg = np.concatenate([[0.0], np.full(k, l2)])
    for mask in range(1 << k):
        use = [0, *(1 + j for j in range(k) if mask >> j & 1)]
        w = np.zeros(k + 1)
        w[use] = logistic(x[:, use], y, l2)
        loss = loss_and_gradient(x, y, w, reg)[0]
        if (w[1:] >= 0).all() and loss < best_loss:
            best, best_loss = w, loss
    return best


class CoTrained:
    """Weights of the two views, their calibrations (shift, slope) and the weights of the calibrated scores."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, calibration: list[np.ndarray], combined: np.ndarray) -> None:
        self.text, self.meta, self.calibration, self.combined = text, meta, calibration, combined

    def views(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        """The calibrated probabilities of each view alone."""
        return [sigmoid(z) for z in self._logits(text, meta)]

    def _logits(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        return [c[0] + c[1] * (x @ w) for c, x, w in zip(self.calibration, (text, meta), (self.text, self.meta), strict=True)]

    def probability(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        z = self._logits(text, meta)
        return sigmoid(self.combined[0] + self.combined[1] * z[0] + self.combined[2] * z[1])


#: (view, label, key, row of view 1, row of view 2) of a document, chosen by a view because it is sure of the label.
Pick = tuple[int, int, int, np.ndarray, np.ndarray]


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, fold: np.ndarray, most_sure: Callable[[list[np.ndarray], dict[tuple[int, int], int], set[int]], list[Pick]], rounds: int = ROUNDS) -> CoTrained | None:
    """``y``: 0 or 1; ``fold``: rows that only calibrate. ``most_sure(weights, quota, taken)`` gives, for each view and
    label, the ``quota`` documents without a label that the view is most sure of, but those ``taken`` before. They
    train the other view; where the two views disagree about a document, neither learns it. None if the training rows
    have but one class."""
    views, train = (text, meta), ~fold
    if len(np.unique(y[train])) < 2:
        return None
    extra: list[tuple[list, list]] = [([], []), ([], [])]  # rows and labels given to each view by the other
    taken: set[int] = set()
    share = float(y[train].mean())
    quota = {(v, label): max(1, round(PER_ROUND * part)) for v in range(2) for label, part in ((1, share), (0, 1 - share))}
    weights: list = [None, None]
    for r in range(rounds + 1):
        for v in range(2):
            rows, labels = extra[v]
            x = np.concatenate([views[v][train], np.array(rows, np.float32)]) if rows else views[v][train]
            weights[v] = logistic(x, np.concatenate([y[train], labels]), start=weights[v])
        picks = most_sure(weights, quota, taken) if r < rounds else []
        if not picks:
            break
        said: dict[int, set[int]] = {}
        for _, label, key, *_ in picks:
            said.setdefault(key, set()).add(label)
        for v, label, key, *rows in sorted(picks, key=lambda x: x[:3]):
            taken.add(key)
            if len(said[key]) == 1:
                extra[1 - v][0].append(rows[1 - v])
                extra[1 - v][1].append(label)
    held = fold if fold.any() and len(np.unique(y[fold])) == 2 else train
    one = np.ones(held.sum())
    calibration = [logistic(np.column_stack([one, views[v][held] @ weights[v]]), y[held], 1e-2) for v in range(2)]
    z = np.column_stack([one, *(c[0] + c[1] * (views[v][held] @ weights[v]) for v, c in enumerate(calibration))])
    return CoTrained(weights[0], weights[1], calibration, non_negative(z, y[held], 1e-2))


def sure_rows(weights: list[np.ndarray], text: np.ndarray, meta: np.ndarray, keys: np.ndarray, quota: dict[tuple[int, int], int], taken: set[int]) -> list[tuple[int, int, int, float]]:
    """(view, label, place, surety): of some documents those that a view is most sure of, ties by key, each key once."""
    _, first = np.unique(keys, return_index=True)
    first = first[[k not in taken for k in keys[first].tolist()]] if taken else first
    out = []
    for v, x in enumerate((text, meta)):
        p = sigmoid(x[first].astype(np.float64) @ weights[v])
        for label in (0, 1):
            sure = p if label else 1 - p
            ok = np.flatnonzero(sure >= SURE)
            top = ok[np.lexsort((keys[first][ok], -sure[ok]))][: quota[v, label]]
            out += [(v, label, int(first[i]), float(sure[i])) for i in top]
    return out


# --- Spark ----------------------------------------------------------------------------------------------------------
def _view_columns(docs: DataFrame, text: str, key: str) -> list:
    has = lambda c, kind: F.col(c).cast(kind).alias(c) if c in docs.columns else F.lit(None).cast(kind).alias(c)
    return [F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"), has("source", "string"), has("lang", "string"), has("n_chars", "long")]


FEATURES = "doc_id long, h long, stats binary, words binary, tf binary, meta binary"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            b = whole.slice(at, 1000)
            out: list[list[bytes]] = [[], [], [], []]
            h = np.empty(b.num_rows, np.uint64)
            for i, (text, *about) in enumerate(zip(*(c.to_pylist() for c in b.columns[1:5]), strict=True)):
                m = meta_features(*about).tobytes()
                for part, x in zip(out, (*text_features(text), m), strict=True):
                    part.append(x if isinstance(x, bytes) else x.tobytes())
                h[i] = xxhash.xxh3_64_intdigest((text or b"") + m)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h.view(np.int64)), *(pa.array(x, pa.binary()) for x in out)], names=["doc_id", "h", "stats", "words", "tf", "meta"])


def features(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each row of ``docs``: its id, a hash of text and metadata, and its features. A null text counts as empty,
    null metadata as a value of its own; columns that are missing count as null, others are not looked at."""
    return docs.select(*_view_columns(docs, text, key)).mapInArrow(trimmed(_features), FEATURES)


def _matrices(b: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    c = {n: b.column(n).to_pylist() for n in ("stats", "words", "tf", "meta")}
    return text_matrix(c["stats"], c["words"], c["tf"]), meta_matrix(c["meta"])


def _sure(shared, quota: dict[tuple[int, int], int], taken: set[int]):
    """The rows of a partition that a view is most sure of."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        best: pa.Table | None = None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                found = sure_rows(weights, *_matrices(b), b.column("h").to_numpy(), quota, taken)
                if not found:
                    continue
                v, label, place, sure = zip(*found, strict=True)
                new = pa.Table.from_batches([b.take(pa.array(place, pa.int64()))]).select(["h", "stats", "words", "tf", "meta"])
                for name, x in (("view", v), ("label", label)):
                    new = new.append_column(name, pa.array(x, pa.int32()))
                new = new.append_column("sure", pa.array(sure, pa.float64()))
                best = _best(new if best is None else pa.concat_tables([best, new]), quota)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return rows


def _best(t: pa.Table, quota: dict[tuple[int, int], int]) -> pa.Table:
    v, label, h, sure = (t[c].to_numpy() for c in ("view", "label", "h", "sure"))
    keep: list[int] = []
    for (view, lab), n in quota.items():
        at = np.flatnonzero((v == view) & (label == lab))
        at = at[np.lexsort((h[at], -sure[at]))]
        _, first = np.unique(h[at], return_index=True)
        keep += at[np.sort(first)][:n].tolist()
    return t.take(pa.array(keep, pa.int64()))


def _most_sure(unlabelled: DataFrame):
    """``most_sure`` of ``co_train`` over a table of features. A partition hands on its best rows only; they are cut again
    in hashed groups, so that no task sees the best of all partitions."""
    spark = unlabelled.sparkSession

    def pick(weights: list[np.ndarray], quota: dict[tuple[int, int], int], taken: set[int]) -> list[Pick]:
        shared = spark.sparkContext.broadcast(weights)
        best = unlabelled.drop("doc_id").mapInArrow(trimmed(_sure(shared, quota, taken)), "h long, stats binary, words binary, tf binary, meta binary, view int, label int, sure double")
        dealt = best.dropDuplicates(["view", "label", "h"]).withColumn("group", F.pmod("h", F.lit(GROUPS)))
        w = Window.partitionBy("view", "label", "group").orderBy(F.col("sure").desc(), "h")
        best = materialize(dealt.withColumn("r", F.row_number().over(w)).where(F.col("r") <= max(quota.values())), "quality-sure")
        # at most a quota of keys a group, view and label; then the features of the chosen ones
        seen: Counter[tuple[int, int]] = Counter()
        chosen = set()
        for r in sorted(best.select("view", "label", "h", "sure").collect(), key=lambda r: (-r["sure"], r["h"])):
            if seen[r["view"], r["label"]] < quota[r["view"], r["label"]]:
                seen[r["view"], r["label"]] += 1
                chosen.add((r["view"], r["label"], r["h"]))
        got = [r for r in best.where(F.col("h").isin([h for *_, h in chosen])).collect() if (r["view"], r["label"], r["h"]) in chosen] if chosen else []
        release(best)
        if not got:
            return []
        x, m = text_matrix(*([r[c] for r in got] for c in ("stats", "words", "tf"))), meta_matrix([r["meta"] for r in got])
        return [(r["view"], r["label"], r["h"], x[i], m[i]) for i, r in enumerate(got)]

    return pick


def learn(rows: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality", labelled: int = LABELLED, rounds: int = ROUNDS) -> CoTrained | None:
    """A model from a table of ``features`` and labels: 1 (good) or 0; other values, and null ones, are none; of several
    for one id the smallest counts.

    About ``labelled`` of the labels are drawn by a hash of their ids (the ids fit a broadcast), and no more than that of the
    rows that have them, where ids repeat; equal rows are learned once. All rows but those with a drawn id are the pool
    that the rounds judge. None without both classes."""
    lab = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(quality).cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    lab = lab.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    place = lambda seed, *by: F.pmod(F.xxhash64(*by, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    drawn = materialize(lab.where(place(7, "doc_id") < labelled / max(lab.count(), 1)), "quality-labels")
    of = materialize(rows.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id", "h"]), "quality-labelled")
    got = sorted(of.where(place(8, "doc_id", "h") < 1.5 * labelled / max(of.count(), 1)).collect(), key=lambda r: (r["doc_id"], r["h"]))
    if not got:
        return None
    x, m = text_matrix(*([r[c] for r in got] for c in ("stats", "words", "tf"))), meta_matrix([r["meta"] for r in got])
    y = np.array([r["quality"] for r in got], np.float64)
    fold = np.array([xxhash.xxh3_64_intdigest(f"fold{r['doc_id']}".encode()) % 4 == 0 for r in got])
    return co_train(x, m, y, fold, _most_sure(rows.join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_anti")), rounds)


def _probabilities(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                p = model.probability(*_matrices(b)) if model else np.ones(b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p.astype(np.float64))], names=["doc_id", "p_good"])

    return rows


def score(rows: DataFrame, model: CoTrained | None) -> DataFrame:
    """(doc_id, p_good), a row for each row of a table of ``features``. Without a model every document gets 1."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    return rows.select("doc_id", "stats", "words", "tf", "meta").mapInArrow(trimmed(_probabilities(shared)), "doc_id long, p_good double")


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", quality: str = "quality", labelled: int = LABELLED) -> tuple[DataFrame, CoTrained | None]:
    """The features of all documents as a table, and the model that was learned from them."""
    rows = materialize(features(docs, text, key), "quality-features")
    return rows, learn(rows, labels, key, quality, labelled)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, p_good, kept), a row for each row of ``docs``; null and repeated ids are judged by their own texts."""
    return score(*trained(docs, labels, text, key)).withColumn("kept", F.col("p_good") >= threshold)


def _kept(shared, text: str, threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                names = b.schema.names
                col = lambda c, kind: pc.cast(b.column(c), kind).to_pylist() if c in names else [None] * b.num_rows
                f = [text_features(t) for t in col(text, pa.binary())]
                m = [meta_features(*r).tobytes() for r in zip(col("source", pa.string()), col("lang", pa.string()), col("n_chars", pa.int64()), strict=True)]
                p = model.probability(text_matrix(*([x[k].tobytes() for x in f] for k in range(3))), meta_matrix(m))
                yield b.filter(pa.array(p >= threshold))

    return rows


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with all their columns. Each row is judged where it lies,
    by its own text, so nothing is joined, and null or repeated ids don't matter."""
    _, model = trained(docs, labels, text, key)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(trimmed(_kept(shared, text, threshold)), docs.schema)
