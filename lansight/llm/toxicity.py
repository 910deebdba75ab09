"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary text, with absolute discounting.  A bigram's discounted
probability backs off to the class's continuation probability of the word, and that to continuation
counts shared by both classes, so an expression seen too rarely to tell the classes apart gets the
same probability in both.  A document's features are differences of length-normalised
log-likelihoods, toxic less ordinary: of the whole text by bigrams, of the whole text by words in
any context, and of its most toxic expressions, a few words that a long text would drown (a word
counts as seen by its occurrences, not by the words it follows); a logistic function fitted on
labelled rows that the models did not see turns them into a score.

All counts cover all labelled rows that may be learnt from; only the logistic fit uses a bounded
sample (``calibration_rows``).  Words are told apart by 64-bit hashes and bigrams by the hashes of
both words, so no two share counts.  The model is sorted keys with their values: words, contexts
and bigrams seen ``min_count`` times.  It grows with the vocabulary of the labelled rows, is gathered
on the driver and held by every scoring task.

Defined results: a null or empty text scores as the features 0 say; a null doc_id counts as the
empty text in the split; documents with several labels count with the largest; without labels
every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lansight.llm.common import Memo, mix64, ship
from lansight.llm.labelled import fit_logistic, labelled, remainder, sample_labels

ship(__name__)


@dataclass(frozen=True)
class ToxicityRules:
    folds: int = 5
    held_out_fold: int = 0
    calibration_fold: int = 4
    calibration_rows: int = 20_000
    discount: float = 1.5
    min_count: int = 5
    expressions: int = 3


PUNCTUATION = b".,;:!?\"'()[]{}<>|#*$%&@+=~^_/\\-`"  # fixed value: read as white space
_TABLE = bytes(32 if bytes([i]) in PUNCTUATION or i in b"\t\n\x0b\x0c\r" else i for i in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(_TABLE).split()


def _numbering() -> Memo:
    import xxhash

    return Memo(xxhash.xxh64_intdigest)


START = b""  # the context of a text's first word; no word is empty


def pair_keys(v, w):
    """A number per bigram, as the SQL function xxhash64(v, w) gives it (int64 arrays in and out)."""
    import numpy as np

    return spark_xxhash64_long(w.view(np.uint64), spark_xxhash64_long(v.view(np.uint64)).view(np.uint64))


def _count_batches(rules: ToxicityRules):
    """(v, w, toxic, ordinary): bigram counts, summed per chunk before they leave the task."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids = _numbering()
        start = np.array([ids[START]], dtype=np.uint64).view(np.int64)
        held = []  # (contexts, words, label) per text
        size = 0

        def flush():
            none = np.empty(0, np.int64)
            v, w = (np.concatenate([x[k] for x in held] or [none]) for k in (0, 1))
            label = np.repeat(np.array([x[2] for x in held], dtype=bool), [len(x[1]) for x in held])
            held.clear()
            _, one, at = np.unique(pair_keys(v, w), return_index=True, return_inverse=True)
            n = [np.bincount(at[m], minlength=len(one)).astype(np.int64) for m in (label, ~label)]
            return pa.RecordBatch.from_arrays([pa.array(v[one]), pa.array(w[one]), *map(pa.array, n)],
                                              names=["v", "w", "toxic", "ordinary"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = words_of(text)
                w = np.fromiter(map(ids.__getitem__, words), dtype=np.uint64, count=len(words)).view(np.int64)
                v = np.concatenate([start, w[:-1]]) if len(w) else w
                held.append((v, w, bool(label)))
                size += len(w)
                if size > 4_000_000:
                    yield flush()
                    size = 0
        yield flush()
    return run


def train(docs: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()):
    """The two models: per kind of entry its sorted keys and their values."""
    import numpy as np

    fold = remainder(rules.folds)
    rows = labelled(docs, labels, "toxic", ~fold.isin(rules.held_out_fold, rules.calibration_fold))
    pairs = rows.select(F.col("text").cast("binary").alias("text"), "label") \
        .mapInArrow(_count_batches(rules), "v long, w long, toxic long, ordinary long") \
        .groupBy("v", "w").agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"))
    d, frequent = F.lit(rules.discount), F.col("t") + F.col("o") >= rules.min_count
    disc = lambda c: F.when(frequent, F.greatest(F.col(c) - d, F.lit(0.0))).otherwise(0.0)
    seen = lambda c: (F.col(c) > 0).cast("double")
    fields = lambda kind, at, *x: F.struct(F.lit(kind).cast("byte").alias("kind"), at.cast("long").alias("at"),
                                           *[F.lit(v).cast("double").alias(n) for n, v in zip("pqrs", x)])
    none = F.lit(0.0)
    parts = pairs.select(F.explode(F.array(
        # continuation counts of the word, by class and shared, and its occurrences
        fields(0, F.col("w"), seen("t"), seen("o"), F.lit(1.0), F.col("t") + F.col("o")),
        # totals and kept mass of the context
        fields(1, F.col("v"), F.col("t"), F.col("o"), disc("t"), disc("o")),
        # discounted counts of a frequent bigram
        fields(F.when(frequent, 2).otherwise(-1), F.xxhash64("v", "w"), disc("t"), disc("o"), none, none),
        fields(3, F.lit(0), seen("t"), seen("o"), F.lit(1.0), none))).alias("x")).select("x.*") \
        .where("kind >= 0").groupBy("kind", "at").agg(*[F.sum(c).alias(c) for c in "pqrs"])
    # words and contexts seen too rarely say nothing, and stay on the executors
    keep = (F.col("kind") >= 2) | ((F.col("kind") == 0) & (F.col("s") >= rules.min_count)) \
        | ((F.col("kind") == 1) & (F.col("r") + F.col("s") > 0))
    got = parts.where(keep).select("kind", "at", *[F.col(c).cast("float") for c in "pqrs"]) \
        .toArrow()  # grows with the vocabulary: 25 bytes an entry
    got = {c: got.column(c).to_numpy() for c in ("kind", "at", *"pqrs")}

    def take(kind):
        own = np.flatnonzero(got["kind"] == kind)
        own = own[np.argsort(got["at"][own], kind="stable")]
        return {c: x[own] if c == "at" else x[own].astype(np.float64) for c, x in got.items() if c != "kind"}

    total = [float(x.sum()) for x in map(take(3).__getitem__, "pqr")]
    w, out = take(0), {}
    values = []
    for c, col in enumerate("pq"):
        discounted = np.maximum(w[col] - rules.discount, 0.0)
        rest = max(total[c] - discounted.sum(), 1.0)
        values.append((discounted + rest * w["r"] / max(total[2], 1.0)) / max(total[c], 1.0))
    out["word"] = w["at"], np.array(values, dtype=np.float32)
    v = take(1)
    left, per = np.ones((2, len(v["at"])), np.float32), np.zeros((2, len(v["at"])), np.float32)
    for c, (count, kept) in enumerate((("p", "r"), ("q", "s"))):
        has = v[count] > 0
        left[c, has] = 1.0 - v[kept][has] / v[count][has]
        per[c, has] = 1.0 / v[count][has]
    out["context"] = v["at"], np.concatenate([left, per])
    b = take(2)
    out["pair"] = b["at"], np.array([b["p"], b["q"]], dtype=np.float32)
    return out


def look_up(entries, at, other):
    """Values (kinds of value x numbers) of the keys ``at``, ``other`` where there is no entry."""
    import numpy as np

    keys, values = entries
    out = np.repeat(np.array(other, dtype=np.float32)[:, None], len(at), axis=1)
    if len(keys):
        place = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
        has = keys[place] == at
        out[:, has] = values[:, place[has]]
    return out


def spark_xxhash64_long(x, seed=42):
    """xxhash64 of 8-byte numbers, as the SQL function gives it (numpy uint64 in, int64 out); ``seed`` may be
    the hashes (uint64) of the columns before."""
    import numpy as np

    u = np.uint64
    p1, p2, p3, p4, p5 = (u(0x9E3779B185EBCA87), u(0xC2B2AE3D27D4EB4F), u(0x165667B19E3779F9),
                          u(0x85EBCA77C2B2AE63), u(0x27D4EB2F165667C5))
    turn = lambda v, k: (v << u(k)) | (v >> u(64 - k))
    h = (seed if isinstance(seed, np.ndarray) else u(seed)) + p5 + u(8)
    k = turn(x * p2, 31) * p1
    h = turn(h ^ k, 27) * p1 + p4
    h = (h ^ (h >> u(33))) * p2
    h = (h ^ (h >> u(29))) * p3
    return (h ^ (h >> u(32))).view(np.int64)


FEATURES = ("bigrams", "words", "expressions", "size")


def features(texts: list, ids: Memo, model: dict, rules: ToxicityRules):
    """Per text: toxic less ordinary log-likelihood per word, of bigrams, of words, and of the most
    toxic expressions; and the logarithm of its length."""
    import numpy as np

    words = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    out = np.zeros((len(texts), len(FEATURES)))
    n = int(lengths.sum())
    if not n:
        return out
    w = np.fromiter((ids[x] for ws in words for x in ws), dtype=np.uint64, count=n).view(np.int64)
    first = np.cumsum(lengths) - lengths
    v = np.concatenate([w[:1], w[:-1]])
    v[first[lengths > 0]] = np.array([ids[START]], dtype=np.uint64).view(np.int64)
    lower = look_up(model["word"], w, (0, 0)).astype(np.float64)
    left, per = np.split(look_up(model["context"], v, (1, 1, 0, 0)).astype(np.float64), 2)
    higher = left * lower
    may = np.flatnonzero((lower[0] > 0) & (per.sum(0) > 0))  # a frequent bigram's words both have entries
    higher[:, may] += look_up(model["pair"], pair_keys(v[may], w[may]), (0, 0)) * per[:, may]

    def gain(p):
        known = (p[0] > 0) & (p[1] > 0) & (lower[0] > 0)  # other words have their shared counts in both
        g = np.zeros(n)
        g[known] = np.log(p[0][known]) - np.log(p[1][known])
        return g

    some = lengths > 0
    by_words = gain(lower)
    out[some, 0] = np.add.reduceat(gain(higher), first[some]) / lengths[some]
    out[some, 1] = np.add.reduceat(by_words, first[some]) / lengths[some]
    k = rules.expressions
    for i in np.flatnonzero(some):
        own = by_words[first[i]:first[i] + lengths[i]]
        out[i, 2] = (own if len(own) <= k else np.partition(own, len(own) - k)[-k:]).sum() / k
    out[:, 3] = np.log1p(lengths)
    return out


def _chunks(texts: list, most: int = 4_000_000):
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _feature_batches(shared, rules: ToxicityRules, carry: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        model, ids = shared.value, _numbering()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [features(texts[a:b], ids, model, rules) for a, b in _chunks(texts)]
            x = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(carry)] + [pa.array(c) for c in x.T.copy()],
                                             names=[carry, *FEATURES])
    return run


def score_documents(docs: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(train(docs, labels, rules))
    slim = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    fold = remainder(rules.folds)
    columns = ", ".join(f"{c} double" for c in FEATURES)
    chosen = sample_labels(labels, "toxic", fold == rules.calibration_fold, rules.calibration_rows) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    # of rows that repeat an id one is learnt from: features leave the tasks, texts stay there
    cases = slim.join(F.broadcast(chosen), "doc_id") \
        .select("text", "label", F.struct("doc_id", F.xxhash64("text").alias("hash"), "label").alias("case")) \
        .mapInArrow(_feature_batches(shared, rules, "case"), f"case struct<doc_id: {kind}, hash: long, label: int>, {columns}") \
        .groupBy("case.doc_id").agg(F.min(F.struct("case.hash", "case.label", *FEATURES)).alias("x")).select("x.*") \
        .toArrow().to_pandas()  # at most calibration_rows
    cases = cases.drop(columns="hash")
    cases = cases.sort_values(list(cases.columns))
    weights = [float(w) for w in fit_logistic(
        cases[list(FEATURES)].to_numpy(), cases["label"].to_numpy() > 0)]
    line = sum((F.col(c) * w for c, w in zip(FEATURES, weights)), F.lit(weights[-1]))
    return slim.mapInArrow(_feature_batches(shared, rules, "doc_id"), f"doc_id {kind}, {columns}") \
        .select("doc_id", (fold == rules.held_out_fold).alias("held_out"),
                (1.0 / (1.0 + F.exp(-line))).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, labels)
