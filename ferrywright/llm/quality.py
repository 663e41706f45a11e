"""Quality classifier from weak labels (operator 2).

Heuristic labellers vote good, bad or nothing on whole texts. Expectation-
maximisation over the counts of all vote patterns estimates each labeller's
accuracies; the posteriors of a bounded sample then train a hashed linear scorer,
which scores every whole text. No labelled row is used.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Rows whose features train the scorer, in expectation; a larger corpus is sampled by hash.
TRAIN_ROWS = 4000
#: Feature buckets, a power of two, and the score from which a document is kept.
BUCKETS = 1 << 11
KEEP_FROM = 0.5
#: So many bytes without any feature are added to each text: a very short one shows little either way.
SHORT = 100
EM_ROUNDS = 200
TRAIN_STEPS = 100
#: Prior share of good documents; prior P(nothing, good, bad) of any labeller on bad and on good
#: documents, worth this share of all rows as votes; and how much likelier a bad vote is on a bad document at least.
PRIOR_GOOD, PRIOR_BAD_ROW, PRIOR_GOOD_ROW, PRIOR_SHARE, BETTER_THAN_CHANCE = 0.7, (0.45, 0.25, 0.3), (0.6, 0.395, 0.005), 0.02, 10.0
#: Texts of fewer words get no votes on shares of words.
MIN_WORDS = 20

#: Each labeller: the measure it reads, the bound up to which it votes good (None: it never does) and from which it votes bad.
#: Fault finders know one fault each and say nothing without it; the broad ones overlap with several of them.
LABELLERS = (
    ("symbols", None, 0.04),
    ("capitals", None, 0.3),
    ("exclamations", None, 0.1),
    ("bars", None, 0.08),
    ("bar_lines", None, 0.3),
    ("repeated_words", None, 0.05),
    ("repeated_lines", None, 0.5),
    ("odd_words", 0.1, 0.5),
    ("sameness", 0.6, 0.85),
)

#: A word of prose: letters, perhaps the first one a capital, and one sign after them.
_PROSE = re.compile(rb"(?<![^\s])[\"'(\xc2\xab]*[A-Za-z\x80-\xff]?[a-z\x80-\xff'-]*[\"')]?[.,;:?!]?(?![^\s])")
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#$%&*^~<>{}[]\\_=@")] = True
# Shape classes of bytes: lower, upper, digit, space, line break, other bytes of UTF-8, each sign by itself.
_CLASS = np.arange(256, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")


def measures(text: str | None) -> dict[str, float]:
    """What the labellers read, each a share between 0 and 1; nothing for a text of few words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if len(words) < MIN_WORDS:
        return {}
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    solid = max(1, int(counts[33:].sum()))
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    # What is left of a word list once words are struck out that look like prose.
    plain = sum(map(len, _PROSE.findall(raw)))
    return {
        "symbols": counts[_SYMBOLS].sum() / solid,
        "capitals": upper / max(1, upper + lower),
        "exclamations": raw.count(b"!!") / len(words),
        "bars": words.count(b"|") / len(words),
        "bar_lines": sum(x.count(b" | ") >= 2 for x in lines) / len(lines),
        "repeated_words": same / len(words),
        "repeated_lines": 1 - len(set(lines)) / len(lines) if len(lines) >= 4 else 0.0,
        "odd_words": 1 - plain / len(raw.translate(None, b" \t\n\r\x0b\x0c")),
        "sameness": 1 - len(zlib.compress(raw, 1)) / len(raw) if len(raw) >= 200 else 0.5,
    }


def votes(text: str | None) -> int:
    """The votes as one number in base 3: 0 nothing, 1 good, 2 bad, the first labeller lowest."""
    found, pattern = measures(text), 0
    if not found:
        return 0
    for k, (name, good, bad) in enumerate(LABELLERS):
        x = found[name]
        pattern += 3**k * (2 if x >= bad else 1 if good is not None and x <= good else 0)
    return pattern


def features(text: str | None) -> np.ndarray:
    """Hashed counts of 4-grams of byte shapes and of word repeats, as square roots of shares."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    shape = _CLASS[raw]
    out = np.zeros(BUCKETS, dtype=np.float64)
    if len(shape) >= 4:
        key = ((shape[:-3] * 31 + shape[1:-2]) * 31 + shape[2:-1]) * 31 + shape[3:]
        out += np.bincount((key * 2654435761 >> 12) & (BUCKETS - 1), minlength=BUCKETS) / (len(key) + SHORT)
    words = raw.tobytes().split()
    if len(words) > 1:
        out[0] += sum(a == b for a, b in zip(words, words[1:], strict=False)) / (len(words) - 1 + SHORT / 6)
    return np.sqrt(out)


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation: posterior of good by pattern, the share of good, and P(vote | class) by labeller.

    ``patterns`` has a row per distinct pattern and a vote (0 nothing, 1 good, 2 bad) per
    labeller; the result's last part has the axes labeller, class (0 bad, 1 good), vote. That
    labellers beat chance is assumed, which tells the classes apart: a bad vote is
    always likelier on a bad document. A text that no labeller judges keeps the prior.
    """
    n, total = patterns.shape[1], max(counts.sum(), 1.0)
    belief = np.array([PRIOR_BAD_ROW, PRIOR_GOOD_ROW])
    table, prior = np.repeat(belief[None], n, axis=0), PRIOR_GOOD
    good = np.full(len(patterns), prior)
    each, silent = np.arange(n), ~patterns.any(axis=1)
    for _ in range(EM_ROUNDS):
        ratio = np.log(table[:, 1]) - np.log(table[:, 0])
        odds = np.log(prior / (1 - prior)) + ratio[each, patterns].sum(axis=1)
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        good[silent] = prior
        heard = np.where(silent, 0.0, counts)
        for c, weight in ((0, heard * (1 - good)), (1, heard * good)):
            tally = np.stack([np.bincount(patterns[:, k], weights=weight, minlength=3) for k in range(n)])
            tally += PRIOR_SHARE * total * belief[c] * (prior if c else 1 - prior)
            table[:, c] = tally / tally.sum(axis=1, keepdims=True)
        table[:, 1, 2] = np.minimum(table[:, 1, 2], table[:, 0, 2] / BETTER_THAN_CHANCE)
        prior = float(np.clip((heard * good).sum() / max(heard.sum(), 1.0), 0.05, 0.95))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return good, prior, table


def train(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights, the bias last, by accelerated gradient steps; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    scale = np.where(y >= 0.5, 0.5 / max(1e-9, y.sum()), 0.5 / max(1e-9, (1 - y).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], dtype=np.float32)
    ahead, step = w.copy(), 2.0
    for k in range(TRAIN_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        gradient = x.T @ (scale * (p - y).astype(np.float32)) + 1e-5 * ahead
        following = ahead - step * gradient
        ahead = following + k / (k + 3) * (following - w)
        w = following
    return w.astype(np.float64)


def score(text: str | None, weights: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(features(text) @ weights[:-1] + weights[-1], -30, 30))))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """The scorer's weights for ``docs``.

    Vote patterns are counted over all rows, 3 ** labellers at most reach the
    driver; features of about ``train_rows`` rows do, chosen by a hash of id and text.
    Without any row the weights are zeros, and with votes for one class only they
    still rank by what the other class would show.
    """
    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = np.zeros(3 ** len(LABELLERS), dtype=np.int64)
        for batch in batches:
            for piece in common.pieces(batch):
                for text in piece.column(0).to_pylist():
                    tally[votes(text)] += 1
        at = np.flatnonzero(tally)
        yield pa.RecordBatch.from_pydict({"pattern": pa.array(at, pa.int64()), "n": pa.array(tally[at], pa.int64())})

    rows = slim.select("text").mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    if not rows:
        return np.zeros(BUCKETS + 1)
    numbers, counts = np.array([r.pattern for r in rows]), np.array([r.n for r in rows], dtype=np.float64)
    patterns = np.stack([numbers // 3**k % 3 for k in range(len(LABELLERS))], axis=1)
    good, _, _ = estimate(patterns, counts)
    posterior = dict(zip(numbers.tolist(), good.tolist(), strict=True))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch):
                texts = piece.column(0).to_pylist()
                yield pa.RecordBatch.from_pydict({"y": pa.array([posterior[votes(t)] for t in texts], pa.float64()), "x": pa.array([features(t).astype("<f2").tobytes() for t in texts], pa.binary())})

    share = min(1.0, train_rows / counts.sum())
    buckets = 1 << 40
    chosen = slim.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)) < int(share * buckets)).select("text")
    got = chosen.mapInArrow(sample, "y double, x binary").collect()
    if not got:
        return np.zeros(BUCKETS + 1)
    # Sorted, so that weights do not hang on the order of tasks.
    got = sorted((r.y, bytes(r.x)) for r in got)
    x = np.stack([np.frombuffer(b, dtype="<f2") for _, b in got]).astype(np.float32)
    return train(x, np.array([y for y, _ in got]))


def score_documents(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, score, keep)``, one row per row of ``docs``; weights are fitted on ``docs`` if None.

    A null text is an empty one and scores as the bias says; null ids and repeated
    rows are carried; an empty table gives no row. Extra columns are ignored.
    """
    weights = fit(docs) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch):
                found = np.array([score(t, shared.value) for t in piece.column(1).to_pylist()], dtype=np.float64)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found), pa.array(found >= KEEP_FROM)], ["doc_id", "score", "keep"])

    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, score double, keep boolean")


def keep_good(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they are; nothing is shuffled.

    A null text counts as an empty one; equal texts, and so repeated rows, stay or go together; very long texts are
    read whole; null ids and any other columns are carried; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs) if weights is None else weights)
    return common.filter_rows(docs, ["text"], lambda: lambda batch: [score(t, shared.value) >= KEEP_FROM for t in batch.column(0).to_pylist()])


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document of ``documents``."""
    return score_documents(common.table(spark, sf_dir, "documents"))
