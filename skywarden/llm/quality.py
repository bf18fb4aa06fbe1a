"""Quality classifier: a weak-label model and a hashed linear scorer."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.llm.common import ship_package, staged

BITS = 13
# Frequent function words of the four languages of the corpus.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for it with as was on be by at from this an are or of a "
    "de la le et les des en un du une est que pour dans qui sur au par avec pas "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "el que y los se del las por con no su para al lo como más".split())
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-。，、；：！？「」『』（）《》・]")
# Words longer than this are cut into parts of it, all of which count.
PART = 64
# A text with more characters than this to a word has few blanks and is judged by runs of RUN characters.
FEW_BLANKS, RUN = 20, 4
_RUNS = re.compile(r"(.)\1+", re.S)
_SHAPE = [(re.compile(r"\d"), "9"), (re.compile(r"[^\W\d_a-zß-öø-ÿ]"), "A"), (re.compile(r"[^\W\dA_]"), "a")]

LABELLERS = ("symbols", "capitals", "shouting", "variety", "stutter", "bare", "function_words", "lines")


#: The same shapes for ASCII alone.
_ASCII_SHAPE = str.maketrans({c: "9" if c.isdigit() else "A" if c.isupper() else "a"
                              for c in map(chr, range(128)) if c.isalnum()})


def _place(kind: bytes, word: str) -> int:
    return xxhash.xxh3_64_intdigest(kind + word.encode("utf-8", "surrogatepass")) >> 64 - BITS


class Words:
    """What a text's words say, from a table of the words last seen: votes of the labellers and hashed features.

    A word is looked at once and then stands for its row of the table;
    all else are sums over rows.  The table starts anew at ``keep`` words.
    Words of over 64 characters count as their parts of 64 characters.
    """

    #: Columns of the table: letters, capitals, symbols, exclamation marks, without letters and digits, function word.
    _COUNTS = 6

    def __init__(self, keep: int = 200_000):
        self.keep = keep
        self._clear()

    def _clear(self) -> None:
        self.row_of: dict[str, int] = {}
        self.lower_of: dict[str, int] = {}
        self.shape_of: dict[str, int] = {}
        self.rows = 0
        self.counts = np.zeros((1024, self._COUNTS), np.int64)
        self.places = np.zeros((1024, 3), np.int64)  # of the word, of its shape, number of its lower-cased form

    def _shape_place(self, word: str) -> int:
        if word.isascii():
            shape = word.translate(_ASCII_SHAPE)
        else:
            shape = word
            for pattern, symbol in _SHAPE:
                shape = pattern.sub(symbol, shape)
        found = self.shape_of.get(shape)
        if found is None:
            found = self.shape_of[shape] = _place(b"s", _RUNS.sub(r"\1", shape))
        return found

    def _learn(self, new: list[str]) -> None:
        counts, places = [], []
        for word in new:
            lower = word.lower()
            if word.isalpha():
                capitals = 0 if word.islower() else sum(map(str.isupper, word))
                counts.append((len(word), capitals, 0, 0, False, lower in FUNCTION_WORDS))
            else:
                counts.append((
                    sum(map(str.isalpha, word)), sum(map(str.isupper, word)), len(_SYMBOL.findall(word)), word.count("!"),
                    not any(map(str.isalnum, word)), lower in FUNCTION_WORDS))
            places.append((_place(b"w", lower), self._shape_place(word),
                           self.lower_of.setdefault(lower, len(self.lower_of))))
        end = self.rows + len(new)
        while end > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.places = np.concatenate([self.places, np.zeros_like(self.places)])
        self.counts[self.rows:end], self.places[self.rows:end] = counts, places
        self.row_of.update(zip(new, range(self.rows, end)))
        self.rows = end

    def rows_of(self, text: str) -> tuple[int, np.ndarray]:
        """The number of words, and the table's row of each word or part, in order; good until the next text."""
        words = text.split()
        n = len(words)
        new = list(set(words).difference(self.row_of))
        # The table holds no longer words: they are always new.
        if any(len(w) > PART for w in new):
            words = [w[i:i + PART] for w in words for i in range(0, len(w), PART)]
            new = list(set(words).difference(self.row_of))
        if new and self.rows + len(new) > self.keep:
            self._clear()
            new = list(set(words))
        if new:
            self._learn(new)
        return n, np.fromiter(map(self.row_of.__getitem__, words), np.int64, len(words))

    def votes(self, text: str, words: int, rows: np.ndarray) -> list[int]:
        """One vote per labeller: 1 good, -1 bad, 0 none.  Texts of under 8 words get none.

        In a text with few blanks, runs of four characters stand for the
        words, and its function words are not looked for.
        """
        n = len(rows)
        runs = None
        if len(text) > FEW_BLANKS * words:
            packed = "".join(text.split())
            if len(packed) > FEW_BLANKS * words:
                runs = [packed[i:i + RUN] for i in range(0, len(packed), RUN)]
                n = len(runs)
        if n < 8:
            return [0] * len(LABELLERS)
        letters, capitals, symbols, shouts, bare, common = self.counts[rows].sum(0).tolist()
        if runs is None:
            kinds, repeats = len(set(self.places[rows, 2].tolist())), int((rows[1:] == rows[:-1]).sum())
        else:
            kinds, repeats = len(set(map(str.lower, runs))), sum(a == b for a, b in zip(runs, runs[1:]))
            bare = sum(not any(map(str.isalnum, x)) for x in runs)

        def vote(value: float, bad: float, good: float) -> int:
            """-1 from ``bad`` on, 1 up to ``good``."""
            return -1 if value >= bad else 1 if value <= good else 0
        lines = [x for x in text.split("\n") if x.strip()] if text.count("\n") >= 4 else []
        return [
            vote(symbols / n, 0.5, 0.05),
            vote(capitals / (letters or 1), 0.4, 0.15),
            vote(shouts / n, 0.3, 0.05),
            vote(1 - kinds / n, 0.75, 0.5) if n >= 30 else 0,
            vote(repeats / n, 0.2, 0.05),
            vote(bare / n, 0.15, 0.05),
            vote(-common / n, -0.02, -0.08) if n >= 30 and runs is None else 0,
            vote(1 - len(set(lines)) / len(lines), 0.4, 0.1) if len(lines) >= 5 else 0,
        ]

    def features(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, amounts) of hashed words, their shapes and repetitions; empty for a text without words."""
        own, n = np.unique(rows, return_counts=True)
        amounts = np.bincount(self.places[own, 0], minlength=1 << BITS) \
            + np.bincount(self.places[own, 1], n, 1 << BITS).astype(np.int64)
        amounts[0] += (n - 1).sum()
        places = np.flatnonzero(amounts)
        return places, amounts[places]


def shares(amounts: np.ndarray) -> np.ndarray:
    """Roots of the amounts, of length 1 together."""
    values = np.sqrt(amounts)
    return values / (np.sqrt((values ** 2).sum()) or 1)


def label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[float, np.ndarray]:
    """(share of good texts, P(good vote | class) as [class, labeller]) by expectation-maximisation.

    ``patterns`` are vote vectors with their numbers of texts.  Each
    labeller has an accuracy of its own in either class, estimated from
    the texts on which it votes; an abstention says nothing.  The start
    takes a text with any bad vote for a bad one, as each labeller knows
    one kind of junk and the others may well like it.
    """
    seen = np.array([p for p, _ in patterns])
    weight = np.array([n for _, n in patterns], float)
    good = np.where((seen < 0).any(1), 0.1, 0.95)
    prior, table = 0.5, np.full((2, seen.shape[1]), 0.5)
    for _ in range(rounds):
        prior = float(np.clip((weight * good).sum() / weight.sum(), 0.05, 0.95))
        for c, share in ((0, 1 - good), (1, good)):
            n = (weight * share)[:, None]
            table[c] = ((n * (seen > 0)).sum(0) + 1) / ((n * (seen != 0)).sum(0) + 2)
        before, good = good, posterior(seen, prior, table)
        if np.abs(before - good).max() < 1e-6:
            break
    return prior, table


def posterior(vote_rows: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    """P(good | votes) for each row; the prior where nothing votes."""
    up, down = np.log(table[1] / table[0]), np.log((1 - table[1]) / (1 - table[0]))
    odds = np.log(prior / (1 - prior)) + (vote_rows > 0) @ up + (vote_rows < 0) @ down
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on soft labels, by gradient descent."""
    if not rows:
        return np.zeros((1 << BITS) + 1, np.float32)
    places = np.concatenate([p for p, _ in rows])
    values = np.concatenate([v for _, v in rows])
    owner = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    weights, bias, speed = np.zeros(1 << BITS), 0.0, np.zeros(1 << BITS)
    for _ in range(rounds):
        z = np.bincount(owner, values * weights[places], len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - target
        gradient = np.bincount(places, values * error[owner], 1 << BITS) / len(rows) + 1e-5 * weights
        speed = 0.9 * speed + gradient
        weights -= 10 * speed
        bias -= 5 * float(error.mean())
    return np.append(weights, bias).astype(np.float32)


def classify(docs: DataFrame, train_rows: int = 8_000, cut: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, kept, label_posterior, n_words.

    Overlapping heuristic labellers vote on every text; the counts of
    their vote vectors over all documents (at most 3^8 rows) go into the
    label model.  A linear scorer on hashed words and word shapes is then
    fitted to the posteriors of ``train_rows`` different texts, the bounded
    sample with the smallest hashes, and scores every document.  kept: the mean of score and posterior reaches ``cut``.

    Words of over 64 characters count as all their parts of 64, and texts
    with few blanks (Chinese, Thai, base64) are voted on by their letters.

    A null or empty text has no words: score and posterior 0.5, kept, as
    there is nothing to hold against it.  Rows with
    null or repeated doc_id are judged one by one.  Other columns are not
    read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            own, counts, places, amounts = [], [], [], []
            for text in (x.as_py() or "" for x in batch.column(2)):
                n_words, rows = words.rows_of(text)
                at, n = words.features(rows)
                own.append(words.votes(text, n_words, rows))
                counts.append(n_words)
                places.append(at.astype("<u2").tobytes())
                amounts.append(n.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32())), pa.array(counts, pa.int64()),
                 pa.array(places, pa.binary()), pa.array(amounts, pa.binary())], names)

    # Texts are read once: votes and features are written, and all that follows works on them.
    names = ["doc_id", "h", "votes", "n_words", "places", "amounts"]
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    measured = staged(texts.mapInArrow(
        measure, "doc_id long, h long, votes array<int>, n_words long, places binary, amounts binary"), "quality", "zstd")
    patterns = measured.groupBy("votes").count().collect()
    if not patterns:
        return measured.select("doc_id", F.lit(0.5).alias("score"), F.lit(True).alias("kept"),
                            F.lit(0.5).alias("label_posterior"), F.lit(0).cast("long").alias("n_words"))
    prior, table = label_model(sorted((tuple(r["votes"]), r["count"]) for r in patterns))

    last = measured.select("h").distinct().orderBy("h").limit(train_rows).agg(F.max("h")).first()[0]
    examples = measured.where(F.col("h") <= last).dropDuplicates(["h"]).select("votes", "places", "amounts").toArrow()
    target = posterior(np.array(examples["votes"].to_pylist()), prior, table)
    weights = fit_scorer([(np.frombuffer(p.as_py(), "<u2"), shares(np.frombuffer(n.as_py(), "<u4")))
                          for p, n in zip(examples["places"], examples["amounts"])], target)
    shared = spark.sparkContext.broadcast(weights)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            z = np.array([w[np.frombuffer(p.as_py(), "<u2")] @ shares(np.frombuffer(a.as_py(), "<u4")) + w[-1]
                          for p, a in zip(batch.column(3), batch.column(4))])
            n = batch.column(2).to_numpy()
            scores = np.where(n > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.5)
            own = np.array(batch.column(1).to_pylist()).reshape(-1, len(LABELLERS))
            label = np.where(n > 0, posterior(own, prior, table), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()),
                                              pa.array((scores + label) / 2 >= cut), pa.array(label, pa.float64()),
                                              batch.column(2)], ["doc_id", "score", "kept", "label_posterior", "n_words"])
    return measured.select("doc_id", "votes", "n_words", "places", "amounts").mapInArrow(
        judge, "doc_id long, score double, kept boolean, label_posterior double, n_words long")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that :func:`classify` rejects, all columns as they were."""
    rejected = classify(docs.withColumn("doc_id", F.xxhash64(F.coalesce("text", F.lit("")), F.lit("quality"))), **options) \
        .where("not kept").select(F.col("doc_id").alias("__text")).distinct()
    return docs.withColumn("__text", F.xxhash64(F.coalesce("text", F.lit("")), F.lit("quality"))) \
        .join(rejected, "__text", "left_anti").select(*docs.columns)
