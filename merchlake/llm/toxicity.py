"""Toxicity by weak supervision.

Many voters look at a text: one for each word or word beginning that toxic training texts use far
more often than others (the lexicon), each once for a single use and once for repeated use, and a
few for patterns (density of lexicon words, shouting, exclamation). A generative label model takes
each text's true class as hidden: it estimates by expectation maximisation how often each voter fires
in either class, the given label being one more, fallible voter, and estimates the correlations of
voters within a class so that voters who merely repeat each other count for less. A linear classifier
is then trained on the posterior labels, and alone scores the texts.

The fit takes a bounded sample of labelled rows; Spark gathers the lexicon's counts and the sample's
features, and the small matrices are solved on the driver. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.text import texts_of
from merchlake.session import fresh_path

# The fit reads at most this many labelled rows.
SAMPLE_ROWS = 20_000
# Entries of the lexicon: of all that are counted, those of greatest evidence.
LEXICON_SIZE = 150
MIN_TOXIC_TEXTS = 4
# How many times likelier in toxic texts an entry must be, after smoothing.
MIN_RATIO = 4.0
# Correlations below this are taken for chance.
MIN_CORRELATION = 0.1
STEMS = range(4, 9)
PATTERNS = 5
_WORD = re.compile(r"\w+")
_REMEMBERED_WORDS = 300_000


def entries_of(word: str) -> list[str]:
    """What a lexicon may hold of a word: the word itself, and its beginnings marked by a hyphen."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


class _Matches(dict):
    """word -> numbers of the lexicon entries it matches."""

    def __init__(self, lexicon: list[str]):
        super().__init__()
        self.number = {entry: n for n, entry in enumerate(lexicon)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.number[e] for e in entries_of(word) if e in self.number)
        if len(word) <= 64:
            if len(self) >= _REMEMBERED_WORDS:
                self.clear()
            self[word] = found
        return found


def count_matches(text: str, matches: _Matches) -> np.ndarray:
    """Uses of each lexicon entry, then the patterns: words, lexicon words, capitals, letters, exclamations."""
    counts = np.zeros(len(matches.number) + PATTERNS)
    words = _WORD.findall(text.lower())
    used = 0
    for word, n in Counter(words).items():
        if found := matches[word]:
            used += n
            for entry in found:
                counts[entry] += n
    letters = sum(map(len, words))
    counts[-PATTERNS:] = len(words), used, sum(map(str.isupper, text)) if letters else 0, letters, text.count("!")
    return counts


def _pattern_values(counts: np.ndarray) -> np.ndarray:
    words, used, capitals, letters, shouts = counts[:, -PATTERNS:].T
    return np.stack(
        [
            np.log1p(used),
            np.minimum(1, 20 * used / np.maximum(words, 1)),
            capitals / np.maximum(letters, 1),
            np.minimum(1, shouts / np.maximum(words, 1)),
        ],
        axis=1,
    )


def features(counts: np.ndarray) -> np.ndarray:
    """What the linear classifier sees."""
    return np.hstack([np.log1p(counts[:, :-PATTERNS]), _pattern_values(counts)])


def votes(counts: np.ndarray) -> np.ndarray:
    """0 or 1 for each voter: an entry used, an entry used again, and the pattern voters."""
    used, patterns = counts[:, :-PATTERNS], _pattern_values(counts)
    return np.hstack(
        [
            used >= 1,
            used >= 2,
            patterns[:, :1] >= np.log1p(2),
            patterns[:, :1] >= np.log1p(4),
            patterns[:, 1:2] >= 0.2,
            patterns[:, 1:2] >= 0.6,
            patterns[:, 2:3] >= 0.5,
            patterns[:, 3:4] >= 0.2,
        ]
    ).astype(float)


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior probability of the toxic class for each row of votes and its fallible label.

    In the first rounds the label counts as a voter of modest, fixed accuracy, so that the others can
    show where it errs; then its accuracy is estimated like theirs.
    """
    rows = np.hstack([votes, labels[:, None]])
    posterior = np.where(labels > 0, 0.8, 0.1)
    weight = np.ones(rows.shape[1])
    for turn in range(rounds):
        toxic, clean = posterior.sum() + 1, (1 - posterior).sum() + 1
        # How often each voter fires in either class, smoothed: its accuracy.
        fires = (posterior @ rows + 0.5) / (toxic + 1), ((1 - posterior) @ rows + 0.5) / (clean + 1)
        if turn < 8:
            fires[0][-1], fires[1][-1] = 0.8, 0.1
        elif turn % 4 == 0:  # what remains in common within a class is correlation
            left = rows - np.outer(posterior, fires[0]) - np.outer(1 - posterior, fires[1])
            spread = np.sqrt(np.maximum((left**2).mean(axis=0), 1e-9))
            shared = np.abs((left.T @ left) / len(left) / np.outer(spread, spread))
            weight = 1 / np.maximum(np.where(shared > MIN_CORRELATION, shared, 0).sum(axis=0), 1)
            weight[-1] = 1
        yes = np.log(fires[0] / fires[1])
        no = np.log((1 - fires[0]) / (1 - fires[1]))
        odds = np.log(toxic / clean) + (rows * (yes * weight) + (1 - rows) * (no * weight)).sum(axis=1)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def train(inputs: np.ndarray, targets: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (bias last) of a penalised logistic regression on soft labels, by Newton's method."""
    rows = np.hstack([inputs, np.ones((len(inputs), 1))])
    ridge = np.full(rows.shape[1], penalty)
    ridge[-1] = 1e-6
    weights = np.zeros(rows.shape[1])
    for _ in range(rounds):
        found = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (found - targets) + ridge * weights
        curve = (rows * (found * (1 - found) + 1e-9)[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass(frozen=True)
class Model:
    """A lexicon and the classifier's weights; without a lexicon every text gets the base rate."""

    base_rate: float
    lexicon: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(counts), self.base_rate)
        odds = features(counts) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _count_entries(sample: DataFrame) -> DataFrame:
    """entry, and the number of toxic and of clean texts that use it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, label in zip(texts_of(batch), batch.column("label").to_pylist()):
                for entry in {e for word in set(_WORD.findall(text.lower())) for e in entries_of(word)}:
                    found[entry][label == 1] += 1
            clean, toxic = zip(*found.values()) if found else ((), ())
            columns = [pa.array(list(found), pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["entry", "toxic", "clean"])

    partial = sample.select("text", "label").mapInArrow(count, "entry string, toxic bigint, clean bigint")
    return partial.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lexicon(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """The entries that speak most clearly for toxic texts; of one word's beginnings with equal counts, the longest."""
    rate, other = (F.col("toxic") - 1) / F.lit(toxic), (F.col("clean") + 1) / F.lit(clean)
    # The evidence a text with the entry gives, times how many texts it reaches.
    evidence = F.col("toxic") * F.log(rate / other)
    speaking = _count_entries(sample).where(F.col("toxic") >= MIN_TOXIC_TEXTS).where(rate / other >= MIN_RATIO)
    alike = speaking.groupBy(F.substring("entry", 1, 4).alias("stem"), "toxic", "clean").agg(
        F.max(F.struct(F.length("entry"), F.col("entry").alias("entry")))["entry"].alias("entry")
    )
    return [row.entry for row in alike.orderBy(evidence.desc(), F.length("entry").desc(), "entry").limit(LEXICON_SIZE).collect()]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), which must be training rows only.

    Labels without a value or id are passed over, labels of one id count once (toxic if any says so),
    and the ``sample_rows`` of them with the lowest hash are used. No labels give a model that scores 0.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        known.groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    path = fresh_path(docs.sparkSession, "toxicity-sample")
    narrow = docs.select(F.col("doc_id"), F.col("text")).where(F.col("text").isNotNull())
    # At most sample_rows ids and labels: a fixed bound on what is broadcast.
    narrow.join(F.broadcast(chosen), "doc_id").select("text", "label").write.parquet(path)
    sample = docs.sparkSession.read.parquet(path)
    sizes = {row.label: row.n for row in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(float(toxic > 0))
    lexicon = _lexicon(sample, toxic, clean)
    if not lexicon:
        return Model(toxic / (toxic + clean))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = _Matches(lexicon)
        for batch in batches:
            counts = [count_matches(text, matches) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(counts, pa.list_(pa.float64()))], ["label", "counts"]
            )

    # Equal rows are one row with a weight, as many as the sample at most.
    described = sample.mapInArrow(describe, "label int, counts array<double>").orderBy("label", "counts").toArrow()
    counts = np.array(described["counts"].to_pylist())
    posterior = label_model(votes(counts), described["label"].to_numpy().astype(float))
    return Model(toxic / (toxic + clean), lexicon, train(features(counts), posterior))


def score(docs: DataFrame, model: Model, held_out: Column, threshold: float) -> DataFrame:
    """score (0 to 1) and predicted (1 from ``threshold`` on) of every whole text, one row per row of ``docs``.

    A null text is scored as an empty one. A null ``doc_id`` stays null, repeated rows are scored each,
    other columns are ignored.
    """
    schema = "doc_id bigint, held_out boolean, score double, predicted int"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = _Matches(model.lexicon)
        for batch in batches:
            counts = [count_matches(text, matches) for text in texts_of(batch)]
            found = model.scores(np.array(counts).reshape(len(counts), -1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(found, pa.float64()),
                    pa.array((found >= threshold).astype("i4")),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col("text").alias("text")
    )
    return narrow.mapInArrow(judge, schema)
