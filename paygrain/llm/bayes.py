"""Document quality by hierarchical empirical Bayes.

A sparse logistic model on words and shape marks gives each text's evidence for a label (good
quality, toxic) as a log Bayes factor. Over all documents the expected labels are summed by host
and by path within the host. Beta posteriors shrink the rate of a path to that of its host and
the rate of a host to the global one; how strongly is estimated from the spread between hosts and
between paths. A document's probability is its evidence on top of the posterior rate of its path,
from which its own part is taken out first.

The model is fitted on the driver, on at most ``most_per_class`` labelled documents of each
combination of labels, those whose ids have the smallest hashes; of near copies among them, told
by a sketch of four hashes, one is used. Every other figure covers all
documents and labels: sums are combined in the tasks, and hosts and paths are a small table.

Defined cases: a null text is an empty one; null hosts and paths are groups of their own; of
several labels of one ``doc_id`` the mean counts; without labels the evidence is zero and the
rates are a half; rows that repeat a ``doc_id`` are scored each; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from paygrain.llm.common import lookup, text_of
from paygrain.session import materialise

MOST_PER_CLASS = 1500
SKETCH = 4  # smallest hashes that tell near copies in the sample
LEAST_TEXTS = 5  # a word's least number of different training texts
EPOCHS = 8
L1, L2, RATE = 4.0, 1.0, 0.5
MOST_STRENGTH = 1e6
BROADCAST_ROWS = 100_000
LETTERS = re.compile(r"[^\W\d_]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
STEPS = (0.01, 0.03, 0.05, 0.1, 0.2, 0.3, 0.5)
PREFIXES = (5, 7)
LENGTHS = (5, 20, 50, 100, 1000)


def marks(text: str) -> set[str]:
    """The words of a text and their beginnings, in lower case, and marks for its shape."""
    words = LETTERS.findall(text)
    found = {w.lower() for w in words}
    found.update([w[:n] + "…" for n in PREFIXES for w in found if len(w) > n])
    tokens = text.split()
    chars = sum(map(len, tokens)) or 1
    n = len(tokens) or 1
    shares = {
        "symbols": len(SYMBOLS.findall(text)) / chars,
        "capitals": sum(map(str.isupper, text)) / chars,
        "digits": sum(map(str.isdigit, text)) / chars,
        "exclamations": text.count("!") / n,
        "repeats": 1 - len(set(tokens)) / n,
        "lines": 1 - len(set(lines)) / len(lines) if (lines := [x for x in text.split("\n") if x]) else 0.0,
    }
    found.update(f" {name} over {step}" for name, share in shares.items() for step in STEPS if share > step)
    found.update(f" under {length} words" for length in LENGTHS if len(tokens) < length)
    return found


@dataclass(frozen=True)
class Model:
    """Weights of the marks that have one; the evidence is their sum and ``bias``."""

    weights: dict[str, float]
    bias: float

    def evidence(self, found: Iterable[str]) -> float:
        return self.bias + sum(self.weights[m] for m in self.weights.keys() & found)


def fit(rows: Sequence[np.ndarray], vocabulary: Sequence[str], labels: np.ndarray) -> Model:
    """Sparse logistic regression by follow-the-regularised-leader, in a fixed order.

    ``rows`` has the indexes into ``vocabulary`` of each text's marks.
    """
    positives = float(labels.sum())
    if not 0 < positives < len(labels):
        return Model({}, 0.0)
    z, n = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
    prior = float(np.log(positives / (len(labels) - positives)))
    order = np.random.default_rng(0)

    def weight(ids: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[ids]) * np.maximum(np.abs(z[ids]) - L1, 0)
        return -shrunk / (L2 + np.sqrt(n[ids]) / RATE)

    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            ids = rows[i]
            w = weight(ids)
            gap = 1 / (1 + np.exp(-np.clip(prior + w.sum(), -30, 30))) - labels[i]
            sigma = (np.sqrt(n[ids] + gap * gap) - np.sqrt(n[ids])) / RATE
            z[ids] += gap - sigma * w
            n[ids] += gap * gap
    final = weight(slice(None))
    return Model({m: float(w) for m, w in zip(vocabulary, final, strict=True) if w}, 0.0)


def training_sample(
    docs: DataFrame, labels: DataFrame, names: Sequence[str], most_per_class: int
) -> tuple[pd.DataFrame, list[str]]:
    """Marks, as indexes into the vocabulary that is returned too, and labels of a bounded sample.

    ``labels`` has ``doc_id`` and ``names``; of ``docs`` only the id and the text are read.

    Per class the rows with the smallest hashed ids are taken. The driver gets sketches, the
    vocabulary and indexes, no texts.
    """
    classes = [row.asDict() for row in labels.select(*names).distinct().limit(1 << len(names)).collect()]
    chosen = None
    for kind in classes:
        rows = labels.where(_all([F.col(k) == F.lit(v) for k, v in kind.items()]))
        rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_class)
        chosen = rows if chosen is None else chosen.unionByName(rows)
    if chosen is None:
        return pd.DataFrame(columns=["at", *names]), []

    @pandas_udf("marks array<string>, sketch array<long>")
    def found(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"marks": texts.map(lambda t: sorted(marks(t))), "sketch": texts.map(sketch)})

    texts = docs.select("doc_id", text_of(F.col("text")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id")
    sample = sample.select("doc_id", F.xxhash64("text").alias("hash"), found("text").alias("found"), *names)
    sample = materialise(sample.select("doc_id", "hash", "found.*", *names))
    seen: set[tuple[int, int]] = set()
    first: dict[int, int] = {}
    for doc, text, own in sample.select("doc_id", "hash", "sketch").orderBy("hash", "doc_id").collect():
        own = set(enumerate(own))
        if 2 * len(own & seen) < SKETCH:
            first.setdefault(text, doc)
        seen |= own
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kept = docs.sparkSession.createDataFrame(list(first.items()), f"hash long, doc_id {id_type}")
    sample = materialise(sample.join(F.broadcast(kept), ["hash", "doc_id"]).dropDuplicates(["hash"]))
    frequent = sample.select(F.explode("marks").alias("mark")).groupBy("mark").count().where(F.col("count") >= LEAST_TEXTS)
    vocabulary = [row.mark for row in frequent.orderBy("mark").collect()]

    @pandas_udf("array<int>")
    def indexes(lists: pd.Series) -> pd.Series:
        index = {m: i for i, m in enumerate(vocabulary)}
        return lists.map(lambda own: [index[m] for m in own if m in index])

    return sample.select("hash", indexes("marks").alias("at"), *names).toPandas().sort_values("hash"), vocabulary


def sketch(text: str) -> list[int]:
    """Smallest hashes of the three-word windows: near copies share most of them."""
    words = text.encode().split()
    hashes = np.array([zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(len(words) - 2, 1))], dtype=np.uint64)
    mixers = np.random.default_rng(1).integers(1, 1 << 32, size=SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return [int(((hashes * m) >> np.uint64(16) & np.uint64(0xFFFFFFFF)).min()) for m in mixers]


def _all(conditions: Sequence[Column]) -> Column:
    met = conditions[0]
    for condition in conditions[1:]:
        met = met & condition
    return met


def logit(rate: Column) -> Column:
    return F.log(rate) - F.log(1 - rate)


def logistic(value: Column) -> Column:
    return 1 / (1 + F.exp(-value))


def strength(groups: DataFrame, within: Column) -> float:
    """How many documents the prior of a group's rate counts for, by the method of moments.

    ``groups`` has the columns n and total; ``within`` is the rate each is compared with.
    """
    rate = F.col("total") / F.col("n")
    row = groups.select("n", rate.alias("rate"), within.alias("within")).agg(
        F.sum("n"), F.count("*"), F.sum(F.col("n") * (F.col("rate") - F.col("within")) ** 2),
        F.sum(F.col("n") * F.col("within") * (1 - F.col("within"))), F.sum(F.col("n") ** 2),
    ).first()
    n, count, spread, noise, squares = (float(x or 0) for x in row)
    if count < 2 or not noise:
        return MOST_STRENGTH
    noise /= n
    between = max(spread - (count - 1) * noise, 0) / max(n - squares / n, 1e-9)
    share = between / noise
    return MOST_STRENGTH if share <= 1 / MOST_STRENGTH else max(1 / share - 1, 1.0)


def scored(
    docs: DataFrame, labels: DataFrame, names: Sequence[str] = ("quality", "toxic"),
    host: str = "source", path: str = "lang", most_per_class: int = MOST_PER_CLASS,
) -> DataFrame:
    """One row per document: doc_id, host, path, and per label its evidence, the posterior rates
    of host and path, and its probability.
    """
    means = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *(F.avg(F.col(name).cast("double")).alias(name) for name in names)
    )
    means = materialise(means)
    models = []
    for name in names:
        # Every label is learned from all rows that carry it, whatever other labels they have.
        carried = means.where(F.col(name).isin(0.0, 1.0)).select("doc_id", name)
        sample, vocabulary = training_sample(docs, carried, [name], most_per_class)
        found = [np.asarray(at, dtype=np.int64) for at in sample["at"]]
        models.append(fit(found, vocabulary, sample[name].to_numpy(dtype=float)))

    @pandas_udf("array<double>")
    def evidence(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [m.evidence(found) for found in [marks(t)] for m in models])

    rows = docs.select(
        "doc_id", F.col(host).alias("host"), F.col(path).alias("path"), evidence(text_of(F.col("text"))).alias("e")
    )
    rows = materialise(
        rows.select("doc_id", "host", "path", *(F.get("e", F.lit(i)).alias(f"{n}_evidence") for i, n in enumerate(names)))
    )
    labelled = rows.join(means.withColumnsRenamed({n: f"{n}_label" for n in names}), "doc_id", "left")
    for name in names:
        labelled = with_rates(labelled, name)
    out = ["doc_id", "host", "path"]
    for name in names:
        out += [f"{name}_evidence", f"{name}_host_rate", f"{name}_path_rate", f"{name}_probability"]
    return labelled.select(*out)


def with_rates(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the posterior rates of host and path and the document's probability."""
    seen = rows.agg(F.sum(f"{name}_label"), F.count(f"{name}_label")).first()
    base = float(((seen[0] or 0) + 1) / (seen[1] + 2))
    expected = F.coalesce(F.col(f"{name}_label"), logistic(F.col(f"{name}_evidence") + logit(F.lit(base))))
    rows = materialise(rows.withColumn("expected", expected))
    paths = materialise(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("expected").alias("total")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    overall = paths.agg(F.sum("n"), F.sum("total")).first()
    rate = float((overall[1] or 0) + base * 2) / float((overall[0] or 0) + 2)
    host_strength = strength(hosts, F.lit(rate))
    host_rate = (F.col("total") + host_strength * rate) / (F.col("n") + host_strength)
    hosts = hosts.select(F.col("host").alias("of_host"), host_rate.alias("host_rate"))
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    sites = materialise(sites)
    path_strength = strength(sites, F.col("host_rate"))
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "n", "total", "host_rate")
    if sites.count() <= BROADCAST_ROWS:
        on = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))
        joined = rows.join(F.broadcast(sites), on)
    else:
        keyed = rows.withColumns({"h": site_key("host"), "p": site_key("path")})
        joined = lookup(keyed, sites.withColumns({"h": site_key("h"), "p": site_key("p")}), ["h", "p"], ["doc_id"])
    others = F.col("total") - F.col("expected") + path_strength * F.col("host_rate")
    path_rate = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), others / (F.col("n") - 1 + path_strength)))
    return joined.withColumns({f"{name}_host_rate": F.col("host_rate"), f"{name}_path_rate": path_rate}).withColumn(
        f"{name}_probability", logistic(F.col(f"{name}_evidence") + logit(F.col(f"{name}_path_rate")))
    ).drop("h", "p", "n", "total", "host_rate", "expected")


def site_key(name: str) -> Column:
    """A name that is never null, for joins by plain equality."""
    return F.concat(F.when(F.col(name).isNull(), "0").otherwise("1"), F.coalesce(F.col(name).cast("string"), F.lit("")))


def judged(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``scored`` and ``kept``: likely of good quality and not likely toxic."""
    rows = scored(docs, labels, **how)
    return rows.withColumn("kept", (F.col("quality_probability") >= 0.5) & (F.col("toxic_probability") <= 0.5))
