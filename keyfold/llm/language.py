"""Language of texts by a linear-chain conditional random field over their words.

Words are labelled, not texts, so code-switched texts are no special case: features of a
word (its prefixes, suffixes, character n-grams, and the word itself if it is in the
learned lexicon) score each language, learned transitions score the change from one word's
language to the next one's, and forward-backward gives each word's posterior. A text's
language is the one with the most expected words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
# Word types whose scores a worker keeps; a full table is emptied.
_TYPES_KEPT = 400_000
# How many times the wanted texts are ranked to choose them; covers the estimate's error.
_SPARE = 4
# Characters of text labelled at a time.
_CHUNK_CHARS = 1_000_000


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit.

    The sample is the only bounded part: ``docs_per_language`` different texts, those least
    by a hash, and a passage of ``chars`` characters of each, from a place anywhere in the
    text. Sequences of ``length`` words join runs of ``run`` words on average from different
    texts, so that transitions are learned.
    """

    docs_per_language: int = 300
    chars: int = 1200
    length: int = 30
    run: int = 10
    steps: int = 60
    rate: float = 0.15
    penalty: float = 1e-5
    seed: int = 7


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def features(word: str) -> list[str]:
    """A constant, the word for the lexicon, affixes of 1 to 3 letters, and inner trigrams."""
    found = ["", "w" + word, "p" + word[:1], "s" + word[-1:]]
    size = len(word)
    if size > 1:
        found += ("p" + word[:2], "s" + word[-2:])
    if size > 2:
        found += ("p" + word[:3], "s" + word[-3:])
        found += ["g" + word[i : i + 3] for i in range(size - 2)]
    return found


@dataclass
class Model:
    """``labels``, a weight row per known feature, and transition weights."""

    labels: list[str]
    known: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def scores(self, words: Sequence[str]) -> np.ndarray:
        """One row of label scores per word."""
        get, flat, starts = self.known.get, [], []
        for word in words:
            starts.append(len(flat))
            flat += [i for f in features(word) if (i := get(f)) is not None]
        return np.add.reduceat(self.weights[flat], starts, axis=0)

    def posteriors(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Forward-backward over many sequences at once, laid end to end.

        Sequences are sorted by length, and each step handles all that reach it. Sums are
        scaled at every step, so length does not matter.
        """
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        longest = int(lengths.max())
        active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")
        first = np.concatenate([[0], np.cumsum(active)])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        step = np.arange(len(scores)) - np.repeat(starts, lengths)
        place = first[step] + np.repeat(rank, lengths)

        local = np.empty_like(scores)
        local[place] = np.exp(scores - scores.max(axis=1, keepdims=True))
        move = np.exp(self.steps - self.steps.max()).astype(scores.dtype)
        ahead = np.empty_like(local)
        for t in range(longest):
            a, b = first[t], first[t + 1]
            now = local[a:b]
            if t:
                now = (ahead[first[t - 1] : first[t - 1] + b - a] @ move) * now
            ahead[a:b] = now / now.sum(axis=1, keepdims=True)
        back = np.ones((active[-1], len(self.labels)), scores.dtype)
        for t in range(longest - 1, -1, -1):
            a, b = first[t], first[t + 1]
            if b - a > len(back):  # sequences that end here
                back = np.concatenate([back, np.ones((b - a - len(back), back.shape[1]), back.dtype)])
            both = ahead[a:b] * back
            ahead[a:b] = both / both.sum(axis=1, keepdims=True)
            back = (back * local[a:b]) @ move.T
            back /= back.sum(axis=1, keepdims=True)
        return ahead[place]


def sample(docs: DataFrame, how: Training, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``label, text`` of the training sample: rows not held out, with text and label.

    Of each label's different texts those with the least hashes. A first pass estimates how
    many there are, and the second keeps hashes below a bound that leaves a few times as
    many as are wanted, so that what is sorted does not grow with the number of tasks.
    Copies of a text count once and are merged before the shuffle.
    """
    rows = docs.select(
        F.col(label_col).cast("string").alias("label"),
        F.col(text_col).cast("string").alias("text"),
        held_out(id_col).alias("held"),
    ).filter("label is not null and text is not null and held = false")
    # the passage's place is drawn by a hash of the text, so copies give the same passage
    places = F.greatest(F.lit(1), F.length("text") - how.chars + 1)
    start = F.pmod(F.xxhash64("text", F.lit(how.seed)), places) + 1
    passage = F.substr("text", start.cast("int"), F.lit(how.chars))
    rows = rows.select("label", passage.alias("text"), F.xxhash64("text").alias("h"))
    different = rows.groupBy("label").agg(F.approx_count_distinct("h", 0.05).alias("d"))
    share = F.least(F.lit(1.0), F.lit(_SPARE * how.docs_per_language) / F.col("d"))
    shares = [tuple(r) for r in different.select("label", share).collect()]
    bounds = docs.sparkSession.createDataFrame(shares, "_label string, _share double")
    place = F.shiftrightunsigned("h", 12) / F.lit(2.0**52)
    near = rows.join(F.broadcast(bounds), F.col("label") == F.col("_label")).filter(place < F.col("_share"))
    texts = near.groupBy("label", "h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("label").orderBy(F.shiftrightunsigned("h", 12), "h")
    ranked = texts.withColumn("k", F.row_number().over(order))
    return ranked.filter(F.col("k") <= how.docs_per_language).select("label", "text")


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves no remainder by 5; false for null ids.

    Rows with null ids are not trained on either.
    """
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % 5) == 0


def fit(rows: Sequence[tuple[str, str]], how: Training = Training()) -> Model | None:
    """Fit to labelled texts by gradient ascent on the sequences' log-likelihood."""
    texts = sorted((label, words) for label, text in rows if (words := words_of(text)))
    labels = sorted({label for label, _ in texts})
    if not labels:
        return None
    random = np.random.default_rng(how.seed)
    number = {label: k for k, label in enumerate(labels)}
    runs = []
    for label, words in texts:
        at = 0
        while at < len(words):
            size = int(random.integers(how.run // 2, how.run * 3 // 2 + 1))
            runs.append((words[at : at + size], number[label]))
            at += size
    types: dict[str, int] = {}
    word, truth = [], []
    for k in random.permutation(len(runs)):
        for w in runs[k][0]:
            word.append(types.setdefault(w, len(types)))
            truth.append(runs[k][1])
    n = max(1, len(word) // how.length)
    width = min(how.length, len(word))
    word_at = np.array(word[: n * width]).reshape(n, width)
    label_at = np.array(truth[: n * width]).reshape(n, width)

    seen = Counter(f for w in types for f in features(w))
    lexicon = Counter(word)
    kept = [
        f
        for f, c in seen.items()
        if not f or c > 1 or f[0] == "w" and lexicon[types[f[1:]]] > 1
    ]
    known = {f: k for k, f in enumerate(sorted(kept))}
    flat, owner = [], []
    for w, k in types.items():
        found = [known[f] for f in features(w) if f in known]
        flat += found
        owner += [k] * len(found)
    flat_a, owner_a = np.array(flat), np.array(owner)
    by_feature = np.argsort(flat_a, kind="stable")
    feature_starts = np.searchsorted(flat_a[by_feature], np.arange(len(known)))
    type_starts = np.searchsorted(owner_a, np.arange(len(types)))

    count = len(labels)
    params = [np.zeros((len(known), count)), np.zeros((count, count))]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    wanted = np.eye(count)[label_at]
    moved = np.einsum("nti,ntj->ij", wanted[:, :-1], wanted[:, 1:])
    for step in range(1, how.steps + 1):
        weights, change = params
        emit = np.add.reduceat(weights[flat_a], type_starts, axis=0)[word_at]
        local = np.exp(emit - emit.max(axis=2, keepdims=True))
        move = np.exp(change - change.max())
        ahead, back = np.empty_like(local), np.ones_like(local)
        for t in range(width):
            now = local[:, t] if not t else (ahead[:, t - 1] @ move) * local[:, t]
            ahead[:, t] = now / now.sum(axis=1, keepdims=True)
        for t in range(width - 2, -1, -1):
            now = (back[:, t + 1] * local[:, t + 1]) @ move.T
            back[:, t] = now / now.sum(axis=1, keepdims=True)
        likely = ahead * back
        likely /= likely.sum(axis=2, keepdims=True)
        pair = ahead[:, :-1, :, None] * move * (local * back)[:, 1:, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        by_type = np.zeros((len(types), count))
        np.add.at(by_type, word_at.ravel(), (wanted - likely).reshape(-1, count))
        slope = np.add.reduceat(by_type[owner_a[by_feature]], feature_starts, axis=0)
        slopes = [
            slope / word_at.size - how.penalty * weights,
            (moved - pair.sum(axis=(0, 1))) / word_at.size - how.penalty * change,
        ]
        for param, slope, (m, v) in zip(params, slopes, moments):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            size = np.sqrt(v / (1 - 0.99**step)) + 1e-8
            param += how.rate * (m / (1 - 0.9**step)) / size
    return Model(labels, known, params[0].astype(np.float32), params[1].astype(np.float32))


def train(
    docs: DataFrame,
    how: Training = Training(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
) -> Model | None:
    """Fit to the bounded sample; None if no row has a label and words."""
    rows = sample(docs, how, id_col, text_col, label_col).collect()
    return fit([(row.label, row.text) for row in rows], how)


class _Labeller:
    """Labels batches of texts; remembers the scores of words."""

    def __init__(self, model: Model):
        self._model = model
        self._empty()

    def _empty(self) -> None:
        self._types: dict[str, int] = {}
        self._scores = np.zeros((1024, len(self._model.labels)), np.float32)

    def _rows(self, words: list[str]) -> np.ndarray:
        fresh = list(set(words).difference(self._types))
        if len(self._types) + len(fresh) > _TYPES_KEPT:
            self._empty()
            fresh = list(set(words))
        if fresh:
            at = len(self._types)
            if at + len(fresh) > len(self._scores):
                more = np.zeros((at + 2 * len(fresh), self._scores.shape[1]), np.float32)
                more[:at] = self._scores[:at]
                self._scores = more
            self._scores[at : at + len(fresh)] = self._model.scores(fresh)
            self._types.update(zip(fresh, range(at, at + len(fresh))))
        places = np.fromiter(map(self._types.__getitem__, words), np.int64, len(words))
        return self._scores[places]

    def label(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [words_of(text) for text in texts]
        filled = [k for k, words in enumerate(split) if words]
        found: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not filled:
            return found
        lengths = np.array([len(split[k]) for k in filled])
        scores = self._rows([w for k in filled for w in split[k]])
        likely = self._model.posteriors(scores, lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        shares = np.add.reduceat(likely.astype(np.float64), starts, axis=0) / lengths[:, None]
        for k, share in zip(filled, shares):
            best = int(share.argmax())
            found[k] = self._model.labels[best], float(min(1.0, max(0.0, share[best])))
        return found


def labelled(
    docs: DataFrame,
    model: Model | None,
    text_col: str = "text",
    pred_col: str = "lang_pred",
    score_col: str = "score",
) -> DataFrame:
    """All rows and columns, with the predicted language and its share of expected words.

    ``und`` and 0 for null texts, texts without letters, and if there is no model. Only the
    text is read for the prediction. One pass without a shuffle; texts are labelled whole,
    a bounded number of characters at a time, or one text if it is longer.
    """
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _Labeller(model) if model else None
        for batch in batches:
            texts = [text or "" for text in batch.column(place).to_pylist()]
            found: list[tuple[str, float]] = []
            part: list[str] = []
            size = 0
            for text in [*texts, None]:
                if part and (text is None or size + len(text) > _CHUNK_CHARS):
                    found += labeller.label(part) if labeller else [(UNKNOWN, 0.0)] * len(part)
                    part, size = [], 0
                if text is not None:
                    part.append(text)
                    size += len(text)
            columns = [
                *batch.columns,
                pa.array([p for p, _ in found], pa.string()),
                pa.array([s for _, s in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, pred_col, score_col])

    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(pred_col, T.StringType()),
            T.StructField(score_col, T.DoubleType()),
        ]
    )
    return docs.mapInArrow(run, schema)


def report(
    docs: DataFrame,
    how: Training = Training(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    model = train(docs, how, id_col, text_col, label_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    return labelled(rows, model).drop("text")


def keep(
    docs: DataFrame,
    how: Training = Training(),
    least_score: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
) -> DataFrame:
    """Rows whose text has a language that holds at least this share of its words."""
    columns = list(docs.columns)
    model = train(docs, how, id_col, text_col, label_col)
    pred, score = "_language_pred", "_language_score"
    rows = labelled(docs, model, text_col, pred, score)
    return rows.filter((F.col(pred) != UNKNOWN) & (F.col(score) >= least_score)).select(*columns)
