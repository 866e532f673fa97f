"""Document quality from a linear-chain conditional random field over lines.

Every line that is not blank is a node with two labels, good and bad.  Its features describe the line and its
neighbours; a 2 x 2 table of weights joins neighbouring labels.  Training maximises the conditional
likelihood of a labelled sample, each line carrying its document's label.  Scoring runs forward-backward
over all lines of a text and averages the marginals of "good", weighted by line length.

The sample is bounded: ``TRAIN_DOCS`` labelled documents, drawn by a hash of their id, and of each a block of at
most ``TRAIN_LINES`` neighbouring lines around its middle.  Only the sample's features come to the driver.
Scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_DOCS = 3000
TRAIN_LINES = 64
ROUNDS = 150
L2 = 1e-3
THRESHOLD = 0.7
#: Share of the documents whose labels are never learned from: remainder of crc32(doc_id as text) by 4.
HELD_OUT = 2

_OF = lambda test: bytes(b for b in range(256) if test(b))
_UPPER = _OF(lambda b: 65 <= b <= 90)
_DIGIT = _OF(lambda b: 48 <= b <= 57)
_STOP = b".,;:?!"
_QUIET = _OF(lambda b: b >= 128 or chr(b).isalnum() or b in b" \t\r\f\v.,;:?!'\"()-")
_SPACE = b" \t\r\f\v"

OWN = [
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "symbol", "stop", "distinct", "short", "long", "ends",
    "starts_upper", "repeated", "bigrams",
]
NEIGHBOUR = ["upper", "digit", "symbol", "stop", "distinct", "log_bytes"]
WIDTH = len(OWN) + 2 * len(NEIGHBOUR) + 4


def lines_of(text: str | None) -> list[bytes]:
    """Lines that are not blank; one empty line for a text without any."""
    data = (text or "").encode("utf-8", "surrogatepass").replace(b"\r", b"\n")
    return [x for x in data.split(b"\n") if x.strip()] or [b""]


def _line(line: bytes, seen: dict[bytes, int]) -> tuple[list[float], frozenset]:
    words = line.split()
    n, bytes_in = max(1, len(words)), max(1, len(line) - line.count(b" "))
    unlike = lambda drop: len(line) - len(line.translate(None, drop))
    kinds = frozenset(words)
    last = line.rstrip()[-1:]
    row = [
        np.log1p(len(line)),
        np.log1p(len(words)),
        bytes_in / n,
        unlike(_UPPER) / bytes_in,
        unlike(_DIGIT) / bytes_in,
        len(line.translate(None, _QUIET)) / bytes_in,
        unlike(_STOP) / bytes_in,
        len(kinds) / n,
        sum(len(w) <= 2 for w in words) / n,
        sum(len(w) >= 14 for w in words) / n,
        float(last in b".?!" and last != b""),
        float(line.lstrip()[:1].isupper()),
        float(seen[line] > 1),
        len(set(zip(words, words[1:]))) / max(1, n - 1),
    ]
    return row, kinds


def features(lines: list[bytes]) -> np.ndarray:
    """One row per line: its own features, those of the lines before and after, and the words shared with them."""
    seen: dict[bytes, int] = {}
    for x in lines:
        seen[x] = seen.get(x, 0) + 1
    rows, words = zip(*(_line(x, seen) for x in lines))
    own = np.array(rows, dtype=np.float64)
    at = [OWN.index(n) for n in NEIGHBOUR]
    before, after = np.zeros((len(own), len(at))), np.zeros((len(own), len(at)))
    before[1:], after[:-1] = own[:-1, at], own[1:, at]
    shared = np.zeros(len(own))
    shared[1:] = [len(a & b) / max(1, min(len(a), len(b))) for a, b in zip(words, words[1:])]
    edge = np.zeros((len(own), 4))
    edge[:, 0], edge[:-1, 1] = shared, shared[1:]
    edge[0, 2], edge[-1, 3] = 1.0, 1.0
    return np.hstack([own, before, after, edge])


def _chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of chains by falling length, where each starts, and how many are alive at each step."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))[order]
    alive = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right")
    return order, starts, alive


def forward_backward(score: np.ndarray, lengths: np.ndarray, link: np.ndarray):
    """Marginals of label 1, expected neighbour pairs (2 x 2, summed) and log partition summed, for all chains at once.

    ``score``: log weight of label 1 over label 0 of each line, chains one after another.
    """
    order, starts, alive = _chains(lengths)
    local = np.stack([np.zeros_like(score), score], axis=1)
    local = np.exp(local - local.max(axis=1, keepdims=True))
    step = np.exp(link)
    forward, scale = np.empty_like(local), np.empty(len(score))
    for t, m in enumerate(alive):
        at = starts[:m] + t
        a = local[at] if t == 0 else (forward[at - 1] @ step) * local[at]
        scale[at] = a.sum(axis=1)
        forward[at] = a / scale[at][:, None]
    back = np.ones_like(local)
    pairs = np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        at = starts[: alive[t]] + t
        right = local[at] * back[at] / scale[at][:, None]
        pairs += step * (forward[at - 1].T @ right)
        back[at - 1] = right @ step.T
    both = forward * back
    total = np.log(scale).sum() + np.maximum(score, 0).sum()
    return both[:, 1] / both.sum(axis=1), pairs, total


def fit(xs: list[np.ndarray], ys: list[int], rounds: int = ROUNDS) -> dict:
    """Weights by gradient ascent (Adam) on the conditional likelihood.  Both labels must occur."""
    lengths = np.array([len(x) for x in xs])
    x = np.vstack(xs)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.hstack([np.clip((x - mean) / spread, -8, 8), np.ones((len(x), 1))])
    y = np.repeat(np.array(ys, dtype=np.float64), lengths)
    inner = np.ones(len(y), dtype=bool)
    inner[np.cumsum(lengths) - 1] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inner[:-1]].astype(int), y[1:][inner[:-1]].astype(int)), 1)
    weights = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for k in range(1, rounds + 1):
        marginal, pairs, _ = forward_backward(x @ weights[:-4], lengths, weights[-4:].reshape(2, 2))
        slope = np.concatenate([x.T @ (y - marginal), (seen - pairs).ravel()]) / len(lengths) - L2 * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights += 0.05 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return {"mean": mean, "spread": spread, "emit": weights[:-4], "link": weights[-4:].reshape(2, 2)}


def score_texts(texts: list[str | None], model: dict | None) -> list[float]:
    """Length-weighted mean marginal of "good" of each text; 0.5 without a model."""
    if model is None or not texts:
        return [0.5] * len(texts)
    split = [lines_of(t) for t in texts]
    lengths = np.array([len(s) for s in split])
    x = np.vstack([features(s) for s in split])
    x = np.clip((x - model["mean"]) / model["spread"], -8, 8)
    marginal, _, _ = forward_backward(x @ model["emit"][:-1] + model["emit"][-1], lengths, model["link"])
    weight = np.array([len(line) + 1.0 for s in split for line in s])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return (np.add.reduceat(marginal * weight, starts) / np.add.reduceat(weight, starts)).clip(0, 1).tolist()


def sample(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[np.ndarray], list[int]]:
    """Line features and labels of the bounded training sample.  Held-out ids and contradictory labels are left out."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    known = (
        labels.filter("doc_id is not null and quality in (0, 1)").filter(fold != HELD_OUT)
        .groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .filter("quality = _most").orderBy(F.xxhash64("l_id"), "l_id").limit(train_docs).select("l_id", "quality")
    )

    def run(batches):
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                lines = lines_of(t.as_py())
                at = max(0, (len(lines) - TRAIN_LINES) // 2)
                rows.append(features(lines)[at : at + TRAIN_LINES].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(rows, pa.binary())], ["quality", "x"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), F.col("doc_id") == F.col("l_id"))
    # An id on many rows may exceed the sample's size: the bound holds for rows too.
    rows = picked.select(F.col("quality").cast("int"), "text").limit(2 * train_docs).mapInArrow(run, "quality int, x binary").collect()
    return [np.frombuffer(r.x, dtype=np.float32).reshape(-1, WIDTH).astype(np.float64) for r in rows], [r.quality for r in rows]


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> dict | None:
    """A model, or None if the sample does not hold both labels."""
    xs, ys = sample(docs, labels, train_docs)
    return fit(xs, ys) if len(set(ys)) == 2 else None


def _scored(docs: DataFrame, model: dict | None, schema: str, column: str, columns: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(column).to_pylist()
            scores = []
            for at in range(0, len(texts), 256):
                scores += score_texts(texts[at : at + 256], sent.value)
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], [*columns, "score"])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null and empty texts are scored as one empty line; without labels of both kinds every score is 0.5.
    A null doc_id is not held out.  Repeated rows stay; further columns are ignored.
    """
    model = train(docs, labels, train_docs)
    scored = _scored(docs.select(F.col("doc_id").cast("long"), "text"), model, "doc_id long, score double", "text", ["doc_id"])
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    return scored.select(
        "doc_id",
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns; all of them if no model can be trained."""
    model = train(docs, labels, train_docs)
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            scores = []
            for at in range(0, len(texts), 256):
                scores += score_texts(texts[at : at + 256], sent.value)
            yield batch.filter(pa.array([s >= THRESHOLD for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
