"""Secret scan: candidates by form, false positives removed by a random forest.

A candidate is a run of at least ``LONG`` token characters, or a value assigned to a name such as "token" or "password".
The forest sees its length and make-up, how usual its character transitions are (a table counted over all documents),
how much of it dictionary words cover (the words of at least ``WORD_SHARE`` of all documents), its path and the words
before it.  It is trained on labelled findings: by default a seeded set of made-up secrets and harmless strings and a
bounded sample of corpus findings with clear labels.  Other labelled findings can be passed in.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import same, settled
from .imatch import document_frequencies

LONG = 16
WORD_SHARE = 0.002
TRAIN_FINDINGS = 4000
TREES, DEPTH, SEED = 25, 6, 42
SECRET = 0.5
MASK = "<SECRET>"

NAMES = r"(?:api[_-]?key|access[_-]?key|secret|token|passwd|password|pwd|credential|auth[_-]?key|private[_-]?key)"
CANDIDATE = re.compile(
    rf"(?i:{NAMES})[\"']?[ \t]{{0,4}}[:=][ \t]{{0,4}}[\"']?(?P<value>[^\s\"'<>]{{6,}})|(?<![A-Za-z0-9+/_=-])(?P<run>[A-Za-z0-9+/_=-]{{{LONG},}})"
)
_NAMED = re.compile(rf"(?i){NAMES}")
_PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|your|example|changeme|placeholder|dummy|sample|redacted|<|\$\{")
_TESTS = re.compile(r"(?i)test|example|sample|doc|fixture|mock")
FEATURES = (
    "length", "digits", "upper", "lower", "hex", "entropy", "class_changes", "transitions", "dictionary", "named", "quoted",
    "placeholder", "path_depth", "path_test", "words_secret", "words_plain",
)

#: Characters for the transition table: letters without case, digits, and all others as one.
_CODE = np.full(256, 36, dtype=np.int64)
for _i in range(26):
    _CODE[65 + _i] = _CODE[97 + _i] = _i
for _i in range(10):
    _CODE[48 + _i] = 26 + _i
CODES = 37


def transitions(docs: DataFrame) -> np.ndarray:
    """Log probability of each character after each other one, counted over all documents; at most CODES**2 rows come back."""

    def run(batches):
        total = np.zeros(CODES * CODES, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                code = _CODE[np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
                total += np.bincount(code[:-1] * CODES + code[1:], minlength=CODES * CODES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    rows = docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.ones((CODES, CODES))
    for r in rows:
        counts[divmod(r.pair, CODES)] += r.n
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def dictionary(docs: DataFrame) -> frozenset[str]:
    """Words of 3 to 12 characters in at least WORD_SHARE of the documents: a set bounded by the mean text, not by the corpus."""
    least = max(2, math.ceil(WORD_SHARE * docs.count()))
    found = document_frequencies(docs, 3, 12).filter(F.col("df") >= least).filter(F.col("word").rlike("^[a-z]+$"))
    return frozenset(r.word for r in found.select("word").toLocalIterator())


def covered(value: str, words: frozenset[str]) -> float:
    """Largest share of the value that dictionary words can cover without overlap."""
    low, n = value.lower(), len(value)
    best = [0] * (n + 1)
    for end in range(1, n + 1):
        best[end] = best[end - 1]
        for start in range(max(0, end - 12), end - 2):
            if best[start] + end - start > best[end] and low[start:end] in words:
                best[end] = best[start] + end - start
    return best[n] / max(1, n)


def features(value: str, before: str, path: str, table: np.ndarray, words: frozenset[str]) -> list[float]:
    n = len(value)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in value]
    code = _CODE[np.frombuffer(value.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    moves = float(table[code[:-1], code[1:]].mean()) if len(code) > 1 else 0.0
    near = [w for w in re.split(r"[^A-Za-z_-]+", before)[-6:] if w]
    share = lambda test: sum(test(c) for c in value) / n
    return [
        math.log(n), share(str.isdigit), share(str.isupper), share(str.islower), share(lambda c: c in "0123456789abcdefABCDEF"),
        entropy, sum(a != b for a, b in zip(kinds, kinds[1:])) / n, moves, covered(value, words),
        float(bool(re.search(rf"(?i){NAMES}[\"']?\s*[:=]\s*[\"']?$", before))), float(before[-1:] in ("'", '"')),
        float(bool(_PLACEHOLDER.search(value))), float(path.count("/")), float(bool(_TESTS.search(path))),
        float(sum(bool(_NAMED.search(w)) for w in near)), float(sum(w.lower() in words for w in near)),
    ]


def candidates(docs: DataFrame, table: np.ndarray, words: frozenset[str], path: str = "source") -> DataFrame:
    """(doc_id, copy, start, end, value_sha256, features) of every candidate; code points, end exclusive."""
    known = docs.sparkSession.sparkContext.broadcast((table, words))
    names = ["doc_id", "copy", "start", "end", "value_sha256", "features"]

    def run(batches):
        table, words = known.value
        for batch in batches:
            at, rows = [], []
            for i, (text, place) in enumerate(zip(batch.column("text"), batch.column("path"))):
                text, place = text.as_py(), place.as_py()
                for m in CANDIDATE.finditer(text):
                    start, end = m.span("value" if m["value"] else "run")
                    value = text[start:end]
                    at.append(i)
                    digest = hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((start, end, digest, features(value, text[max(0, start - 80) : start], place, table, words)))
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()))
            keys = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("doc_id", "copy")]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    source = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("copy"), F.coalesce("text", F.lit("")).alias("text"), place.alias("path")
    )
    return source.mapInArrow(
        run, "doc_id long, copy long, start long, end long, value_sha256 string, features array<double>"
    )


def seeded(table: np.ndarray, words: frozenset[str], count: int = 150) -> list[tuple[list[float], float]]:
    """Made-up labelled findings from a fixed rule: digests as secrets; placeholders, numbers and word chains as harmless."""
    usual = sorted(words)[:: max(1, len(words) // 97)] or ["value", "number", "letter"]
    out = []
    for i in range(count):
        raw = hashlib.sha256(f"finding {i}".encode()).digest()
        secret = (raw.hex()[: 24 + i % 40], base64.b64encode(raw).decode()[: 20 + i % 24], "Pw" + base64.b32encode(raw).decode()[: 10 + i % 12])[i % 3]
        before = ('token = "', "api_key: '", "password=", "the key is ", "run with ")[i % 5]
        out.append((features(secret, before, f"src/part{i}", table, words), 1.0))
        chain = "-_"[i % 2].join(usual[(i * 7 + k * 3) % len(usual)] for k in range(4)).ljust(LONG, "e")
        plain = (chain, str(10**15 + i * 7919), "xxxxxxxxxxxxxxxxxxxx", "your-api-key-here", "".join(usual[(i + k) % len(usual)] for k in range(5)).ljust(LONG, "n"))[i % 5]
        before = ("see ", "number ", 'token = "', "password: ", "and the ")[i % 5]
        out.append((features(plain, before, ("docs/example", f"src/part{i}")[i % 2], table, words), 0.0))
    return out


def clear_labels(found: DataFrame, most: int = TRAIN_FINDINGS) -> DataFrame:
    """(features, label) of a bounded sample of corpus findings whose label is clear.

    Secret: assigned to a name, mostly letters and digits mixed, hardly any of it words.  Harmless: digits only or mostly words, and
    no such name before it.
    """
    f = {n: F.col("features")[i] for i, n in enumerate(FEATURES)}
    secret = (f["named"] == 1) & (f["digits"] > 0.1) & (f["digits"] < 0.9) & (f["dictionary"] < 0.5) & (f["placeholder"] == 0)
    harmless = (f["named"] == 0) & (f["words_secret"] == 0) & ((f["digits"] == 1) | (f["dictionary"] > 0.6))
    label = F.when(secret, 1.0).when(harmless, 0.0)
    clear = found.withColumn("label", label).filter("label is not null").select("features", "label", "value_sha256")
    return clear.dropDuplicates(["value_sha256"]).orderBy(F.xxhash64("value_sha256"), "value_sha256").limit(most).select("features", "label")


def findings(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source", most: int = TRAIN_FINDINGS) -> DataFrame:
    """(doc_id, copy, start, end, value_sha256, score, secret) of every candidate in every row of ``docs``.

    ``labelled``: (features, label) to train on instead of the defaults, at most ``most`` rows of it in the order of a hash.  Null and empty texts have no candidates; null ids and
    repeated rows stay; a missing or null path counts as empty; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    table, words = transitions(docs), dictionary(docs)
    found = settled(candidates(docs, table, words, path), "secret-candidates")
    if labelled is None:
        made = spark.createDataFrame(seeded(table, words), "features array<double>, label double")
        labelled = made.unionByName(clear_labels(found))
    else:
        labelled = labelled.select("features", "label").orderBy(F.xxhash64("features"), "label").limit(most)
    # The sample is bounded; one partition in a fixed order makes the forest repeatable.
    sample = settled(labelled.select(array_to_vector("features").alias("x"), "label", F.xxhash64("features").alias("k")).repartition(1).sortWithinPartitions("k", "label"), "secret-sample")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(sample.coalesce(1))
    scored = forest.transform(found.withColumn("x", array_to_vector("features")))
    score = F.round(vector_to_array("probability")[1], 6)
    return scored.select("doc_id", "copy", "start", "end", "value_sha256", score.alias("score"), (score >= SECRET).alias("secret"))


def redacted(docs: DataFrame, path: str = "source") -> DataFrame:
    """All rows and columns of ``docs``, secrets in ``text`` replaced by MASK; ``n_chars``, if there, follows the text."""
    secrets = settled(findings(docs, path=path).filter("secret"), "secret-spans")
    # Longer than any name of ``docs``, so that none clashes.
    own = "_" * (1 + max(len(c) for c in docs.columns))
    doc, copy, place = f"{own}id", f"{own}copy", f"{own}spans"
    spans = secrets.groupBy(F.col("doc_id").alias(doc), F.col("copy").alias(copy)).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(place))
    joined = docs.join(spans, same(docs["doc_id"].cast("long"), F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(copy)), "left")
    # Candidates of a text do not overlap: what stays lies between them.
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col(f"{place}.end"))
    starts = F.concat(F.col(f"{place}.start"), F.array(F.length("text").cast("long")))
    between = F.zip_with(ends, starts, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.col(place).isNull(), F.col("text")).otherwise(F.array_join(between, MASK))
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    out = joined.select(*columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def report(docs: DataFrame) -> DataFrame:
    """One row per finding: doc_id, start, end, value_sha256, score, secret."""
    return findings(docs).drop("copy")
