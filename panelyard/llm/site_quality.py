"""Document quality by hierarchical empirical Bayes.

A text classifier gives evidence on each document, as a likelihood ratio. Labels, counted
by host and by path, give a prior for it: the share of good documents of a path is
shrunk toward that of its host, and that toward the global share, the more so the
fewer labels there are. How strongly is estimated from the spread between hosts and
between paths (method of moments for a beta-binomial). A labelled document's own
label is taken off the counts that make its prior.

Texts are read once, for features. The classifier, a logistic regression, is fitted on
at most ``TRAIN_ROWS`` labelled documents chosen by hash of their id; counts by host
and path are over all labels.

Defined results: a null text counts as empty; documents without a host have the global
prior, those without a path the one of their host; an id that has several labels
counts with their mean, rounded up; null labels and labels of unknown documents do not
count; with labels of one class only (or none) the classifier is silent, and without
labels the global share is 1/2; repeated rows are judged one by one; an empty table
gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.llm.frames import pick
from panelyard.llm.quality_rules import STOP_WORDS
from panelyard.llm.units import chunks
from panelyard.llm.wordhash import windows, word_hashes
from panelyard.session import staged

FEATURES = ["words", "word_length", "symbols", "bars", "exclamations", "digits", "capitals", "lines",
            "stop_words", "distinct_words", "repeated_windows"]
TRAIN_ROWS = 50_000
PART_BYTES = 1 << 20  # of text looked at at a time
SEED_STRENGTH = 1e6  # prior weight where groups do not differ at all
LEAST_STRENGTH = 1.0

_CLASSES = {"symbols": b"#*$%&<>", "bars": b"|", "exclamations": b"!", "digits": b"0123456789",
            "capitals": bytes(range(65, 91)), "lines": b"\n"}


def features_of(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    hashes, counts = word_hashes(column)
    size = np.maximum(np.diff(ends), 1)
    words = np.maximum(counts, 1)

    def share(mask: np.ndarray, bounds: np.ndarray, whole: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(sums[bounds]) / whole

    by_byte = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        by_byte[name] = share(table[raw], ends, words if name != "capitals" else size)
    stops = word_hashes(pa.array([" ".join(STOP_WORDS)]))[0]
    word_ends = np.concatenate([[0], np.cumsum(counts)])
    triples, numbers = windows(hashes, counts, 3)
    triple_ends = np.concatenate([[0], np.cumsum(numbers)])
    distinct = [len(np.unique(hashes[a:b])) for a, b in zip(word_ends, word_ends[1:])]
    windows_left = [len(np.unique(triples[a:b])) for a, b in zip(triple_ends, triple_ends[1:])]
    columns = {
        "words": np.log1p(counts), "word_length": np.minimum(size / words, 30.0), **by_byte,
        "stop_words": share(np.isin(hashes, stops), word_ends, words),
        "distinct_words": np.array(distinct) / words,
        "repeated_windows": 1 - np.array(windows_left) / np.maximum(numbers, 1),
    }
    return np.stack([columns[f] for f in FEATURES], axis=1)


def with_features(documents: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str) -> DataFrame:
    """``id``, ``host``, ``path`` and one column per feature."""
    rows = pick(documents, id_col, host_col, path_col, text_col).toDF("id", "host", "path", "text")
    rows = rows.select("id", F.col("host").cast("string"), F.col("path").cast("string"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for part in chunks(batch.column(3), PART_BYTES):
                found = features_of(part)
                yield pa.record_batch([c.slice(start, len(part)) for c in batch.columns[:3]]
                                      + [pa.array(x, pa.float64()) for x in found.T],
                                      names=["id", "host", "path", *FEATURES])
                start += len(part)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, host string, path string, " + ", ".join(f"{f} double" for f in FEATURES))


def _logit(p: Column) -> Column:
    safe = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(safe / (1 - safe))


def strength(groups: DataFrame, toward: Column) -> float:
    """Prior weight, in labels, of the share that groups (good, n) are shrunk toward.

    If groups had no spread of their own, a group's squared distance from ``toward``
    would be p(1-p)/n; what goes beyond that is spread between groups.
    """
    distance = F.pow(F.col("good") / F.col("n") - toward, 2)
    chance = toward * (1 - toward)
    found = groups.where("n > 0").agg(
        F.sum(F.col("n") * distance).alias("d"), F.sum(chance).alias("c"), F.sum("n").alias("n"),
        F.sum(F.col("n") * chance).alias("w")).first()
    if not found["n"] or not found["w"]:
        return SEED_STRENGTH
    spread = (found["d"] - found["c"]) / found["n"]
    mean_chance = found["w"] / found["n"]
    if spread <= 0:
        return SEED_STRENGTH
    return min(SEED_STRENGTH, max(LEAST_STRENGTH, mean_chance / spread - 1))


def _evidence(rows: DataFrame) -> DataFrame:
    """``rows`` with ``evidence``: the logarithm of the likelihood ratio of good to bad."""
    sample = staged(rows.where("label is not null").withColumn("h", F.xxhash64("id"))
                    .select("label", "h", *FEATURES).orderBy("h", *FEATURES).limit(TRAIN_ROWS)
                    .repartition(1).sortWithinPartitions("h", *FEATURES), "labelled")
    found = sample.agg(F.count("*").alias("n"), F.sum("label").alias("good")).first()
    if not found["n"] or found["good"] in (0, found["n"]):
        return rows.withColumn("evidence", F.lit(0.0))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = LogisticRegression(regParam=1e-3, maxIter=60).fit(assembler.transform(sample))
    share = found["good"] / found["n"]
    p = vector_to_array("probability")[1]
    scored = model.transform(assembler.transform(rows)).withColumn(
        "evidence", _logit(p) - F.lit(float(np.log(share / (1 - share)))))
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def scored(documents: DataFrame, labels: DataFrame, host_col: str, path_col: str, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "quality", threshold: float = 0.5) -> DataFrame:
    """The id, ``evidence``, ``host_share``, ``path_share`` (priors), ``p_quality`` and ``kept``."""
    known = pick(labels, id_col, label_col).toDF("id", "label").where("id is not null and label is not null") \
        .groupBy("id").agg(F.ceil(F.avg("label")).cast("double").alias("label"))
    rows = staged(with_features(documents, id_col, text_col, host_col, path_col).join(known, "id", "left"), "features")

    own = F.col("label").isNotNull()
    counted = [F.coalesce(F.sum("label"), F.lit(0.0)).alias("good"), F.sum(own.cast("double")).alias("n")]
    total = rows.agg(*counted).first()
    share = float(total["good"] / total["n"]) if total["n"] else 0.5

    hosts = rows.where("host is not null").groupBy("host").agg(*counted)
    host_weight = strength(hosts, F.lit(share))
    shrunk = (F.col("good") + host_weight * share) / (F.col("n") + host_weight)
    hosts = staged(hosts.select("host", F.col("good").alias("host_good"), F.col("n").alias("host_n"),
                                shrunk.alias("host_mean")), "hosts")
    paths = rows.where("host is not null and path is not null").groupBy("host", "path").agg(*counted)
    path_weight = strength(paths.join(hosts, "host"), F.col("host_mean"))
    paths = paths.select("host", "path", F.col("good").alias("path_good"), F.col("n").alias("path_n"))

    judged = _evidence(rows).join(hosts, "host", "left").join(paths, ["host", "path"], "left")
    mine, is_mine = F.coalesce("label", F.lit(0.0)), own.cast("double")

    def prior(good: str, n: str, weight: float, toward: Column) -> Column:
        value = (F.col(good) - mine + weight * toward) / (F.col(n) - is_mine + weight)
        return F.when(F.col(n).isNull(), toward).otherwise(value)

    judged = judged.withColumn("host_share", prior("host_good", "host_n", host_weight, F.lit(share)))
    judged = judged.withColumn("path_share", prior("path_good", "path_n", path_weight, F.col("host_share")))
    judged = judged.withColumn("p_quality", 1 / (1 + F.exp(-(_logit(F.col("path_share")) + F.col("evidence")))))
    return judged.select(F.col("id").alias(id_col), "evidence", "host_share", "path_share", "p_quality",
                         (F.col("p_quality") >= threshold).alias("kept"))
