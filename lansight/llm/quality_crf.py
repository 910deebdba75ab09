"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad.  A line's potential comes from binned features of the line itself, of
the line before and of the line after; neighbouring labels are tied by a two-by-two transition
table.  In training all lines of a labelled document carry its label.  Forward-backward gives each
line's marginal probability of being good; weighted by line length they make the document's
quality, and a logistic function fitted on the training documents turns that into the score.

The field is fitted on a bounded sample of labelled documents (``sample_docs``, those with the
smallest id hashes) that may be learnt from, one row of each.  Of a long one it takes a window of
neighbouring lines, as long as ``sample_lines`` allows for all; scoring covers every line of every text.

Defined results: rows that share a chosen doc_id count once in the fit, with the text of the smallest
hash; a null or empty text is one empty line and gets that line's score; a null doc_id counts as the
empty text in the split; a document with several labels is learnt with each of them;
without labels every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lansight.llm.common import ship
from lansight.llm.labelled import fit_logistic, logistic, remainder, sample_labels

ship(__name__)


@dataclass(frozen=True)
class QualityRules:
    folds: int = 3
    held_out_fold: int = 1
    sample_docs: int = 6_000
    #: Lines of the sample; longer documents give windows of equal length, every document a line at least.
    sample_lines: int = 150_000
    steps: int = 120
    ridge: float = 1e-4


#: Bin edges of each line feature.
EDGES = (
    ("words", (1, 2, 4, 8, 20, 50, 200)),
    ("chars_per_word", (2.5, 3.5, 4.5, 5.5, 6.5, 8, 12)),
    ("upper_share", (0.005, 0.015, 0.03, 0.06, 0.12, 0.3, 0.7)),
    ("symbols_per_word", (0.01, 0.05, 0.2, 0.5, 1, 2)),
    ("bars_per_word", (0.01, 0.1, 0.3, 0.6)),
    ("exclaims_per_word", (0.01, 0.1, 0.5, 1)),
    ("digits_per_char", (0.001, 0.01, 0.05, 0.2)),
    ("distinct_share", (0.05, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95)),
    ("stops_per_word", (0.02, 0.05, 0.1, 0.2, 0.4)),
    ("short_share", (0.1, 0.25, 0.4, 0.55, 0.7, 0.85)),
    ("ends_sentence", (0.5,)),
    ("seen_before", (0.5,)),
)
BINS = 9  # of a feature, the last for a neighbour that is not there
WIDTH = len(EDGES)
SYMBOLS, STOPS, UPPER, LOWER, DIGITS = (  # fixed values
    b"#*$%&<>{}[]=_~^@+\\/", b".,;:?", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789")


def line_features(text: bytes | None):
    """(lines x WIDTH bin numbers, line lengths)."""
    import numpy as np

    lines = (text or b"").split(b"\n")
    x = np.zeros((len(lines), WIDTH))
    seen = set()
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if n:
            size = len(line)
            less = lambda chars: size - len(line.translate(None, chars))
            upper = less(UPPER)
            short = sum(len(w) <= 3 for w in words)
            x[i] = (n, sum(map(len, words)) / n, upper / max(1, upper + less(LOWER)), less(SYMBOLS) / n,
                    line.count(b"|") / n, line.count(b"!") / n, less(DIGITS) / size, len(set(words)) / n,
                    less(STOPS) / n, short / n, words[-1][-1:] in b".!?", line in seen)
            seen.add(line)
    bins = np.column_stack([np.searchsorted(edges, x[:, k], side="right") for k, (_, edges) in enumerate(EDGES)])
    return bins.astype(np.int64), np.array([len(x) + 1.0 for x in lines])


def potentials_of(bins, first):
    """Feature numbers of each line: its own bins, those of the line before and of the line after.
    ``first`` marks the first lines of documents; all lines are in one array."""
    import numpy as np

    at = np.arange(WIDTH) * BINS
    none = np.full((1, WIDTH), BINS - 1)
    before = np.concatenate([none, bins[:-1]])
    before[first] = BINS - 1
    after = np.concatenate([bins[1:], none])
    last = np.concatenate([first[1:], [True]])
    after[last] = BINS - 1
    span = WIDTH * BINS
    return np.concatenate([bins + at, before + at + span, after + at + 2 * span], axis=1)


class Chains:
    """Documents' lines, stepped through together: position t of every document long enough."""

    def __init__(self, lengths):
        import numpy as np

        self.lengths = np.asarray(lengths, dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        order = np.argsort(-self.lengths, kind="stable")
        self.sorted_offsets = self.offsets[order]
        down = -self.lengths[order]
        longest = int(self.lengths.max()) if len(self.lengths) else 0
        self.active = np.searchsorted(down, -np.arange(longest), side="left")  # documents longer than t
        self.last = self.offsets + self.lengths - 1
        inner = np.ones(int(self.lengths.sum()), dtype=bool)
        inner[self.last] = False
        self.pairs = np.flatnonzero(inner)  # lines that have a next one

    def run(self, phi, trans):
        """(forward, backward) log messages of log potentials ``phi`` (lines x 2)."""
        import numpy as np

        fwd, bwd = phi.copy(), np.zeros_like(phi)
        for t in range(1, len(self.active)):
            now = self.sorted_offsets[:self.active[t]] + t
            before = fwd[now - 1]
            fwd[now] += np.logaddexp(before[:, :1] + trans[0], before[:, 1:] + trans[1])
        for t in range(len(self.active) - 1, 0, -1):
            now = self.sorted_offsets[:self.active[t]] + t
            after = phi[now] + bwd[now]
            bwd[now - 1] = np.logaddexp(after[:, :1] + trans[:, 0], after[:, 1:] + trans[:, 1])
        return fwd, bwd


def marginals(phi, trans, chains: Chains):
    """Probability that each line is good."""
    import numpy as np

    fwd, bwd = chains.run(phi, trans)
    both = fwd + bwd
    return 1.0 / (1.0 + np.exp(np.clip(both[:, 0] - both[:, 1], -50, 50)))


def fit_field(index, labels, lengths, rules: QualityRules):
    """Weights and transitions that maximise the penalised conditional likelihood of the line labels."""
    import numpy as np

    chains, n = Chains(lengths), len(index)
    theta, trans = np.zeros(3 * WIDTH * BINS), np.zeros((2, 2))
    y = labels.astype(np.int64)
    p, q = chains.pairs, chains.pairs + 1
    told = np.zeros((2, 2))
    np.add.at(told, (y[p], y[q]), 1.0)
    m = [np.zeros_like(theta), np.zeros_like(trans)]
    v = [np.zeros_like(theta), np.zeros_like(trans)]
    flat = index.ravel()
    for step in range(1, rules.steps + 1):
        phi = np.zeros((n, 2))
        phi[:, 1] = theta[index].sum(1)
        fwd, bwd = chains.run(phi, trans)
        both = fwd + bwd
        total = np.logaddexp(both[:, 0], both[:, 1])
        good = np.exp(both[:, 1] - total)
        off = np.repeat(good - y, index.shape[1])
        g_theta = np.bincount(flat, weights=off, minlength=len(theta)) / n + rules.ridge * theta
        joint = np.exp(fwd[p][:, :, None] + trans[None] + (phi[q] + bwd[q])[:, None, :] - total[p][:, None, None])
        g_trans = (joint.sum(0) - told) / n + rules.ridge * trans
        for k, (w, g) in enumerate(((theta, g_theta), (trans, g_trans))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            w -= 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return theta, trans


def document_quality(index, weight, chains: Chains, model) -> list:
    """Length-weighted mean of the marginals per document."""
    import numpy as np

    theta, trans = model
    phi = np.zeros((len(index), 2))
    phi[:, 1] = theta[index].sum(1)
    good = marginals(phi, trans, chains)
    return np.add.reduceat(good * weight, chains.offsets) / np.add.reduceat(weight, chains.offsets)


def prepare(texts: list):
    """(feature numbers, weights, line counts) of the lines of some documents."""
    import numpy as np

    parts = [line_features(t) for t in texts]
    lengths = np.array([len(b) for b, _ in parts])
    first = np.zeros(int(lengths.sum()), dtype=bool)
    first[np.cumsum(lengths) - lengths] = True
    return potentials_of(np.concatenate([b for b, _ in parts]), first), np.concatenate([w for _, w in parts]), lengths


def window_lines(lengths, most: int) -> int:
    """The longest window that keeps the sum of the documents' windows within ``most``, at least 1."""
    import numpy as np

    low, high = 1, max(1, int(np.max(lengths, initial=1)))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if np.minimum(lengths, mid).sum() <= most else (low, mid - 1)
    return low


def fit(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()):
    """(field, calibration) from the sample, or None without labels."""
    import numpy as np

    learn = remainder(rules.folds) != rules.held_out_fold
    chosen = sample_labels(labels, "quality", learn, rules.sample_docs)
    ids = chosen.select("doc_id").distinct()
    text = F.col("text").cast("binary")
    breaks = F.length(F.col("text")) - F.length(F.translate("text", "\n", ""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(breaks + 1, F.lit(1)).cast("long").alias("lines"),
                       F.xxhash64(text).alias("hash"))
    own = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id") \
        .agg(F.min(F.struct("hash", "lines")).alias("x")).select("doc_id", "x.hash", "x.lines")
    own = own.toArrow()  # at most sample_docs rows of a few bytes
    width = window_lines(own.column("lines").to_numpy(), rules.sample_lines)
    picked = docs.sparkSession.createDataFrame(own).select("doc_id", "hash")
    rows = rows.join(F.broadcast(picked), ["doc_id", "hash"]).select("doc_id", "hash", "text")

    def shape(batches):
        import pyarrow as pa

        seen = set()  # at most sample_docs ids: repeated rows leave a task once
        for batch in batches:
            out = []
            for doc_id, at, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "hash", "text"))):
                if doc_id in seen:
                    continue
                seen.add(doc_id)
                bins, weight = line_features(text)
                start = at % max(1, len(bins) - width + 1)
                end = min(len(bins), start + width)
                low, high = max(0, start - 1), min(len(bins), end + 1)  # with the lines that it neighbours
                out.append((doc_id, high - low, start - low, high - end, bins[low:high].astype("u1").tobytes(),
                            weight[low:high].tobytes()))
            kinds = (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                                             names=["doc_id", "lines", "before", "after", "bins", "weights"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = ("lines", "before", "after", "bins", "weights")
    shaped = rows.mapInArrow(shape, f"doc_id {kind}, lines long, before long, after long, bins binary, weights binary") \
        .groupBy("doc_id").agg(F.min(F.struct(*parts)).alias("x")).select("doc_id", "x.*") \
        .join(F.broadcast(chosen), "doc_id").toArrow().to_pandas()  # a document once per label
    shaped = shaped.sort_values(["doc_id", "quality"])
    if not len(shaped):
        return None
    lengths = shaped["lines"].to_numpy()
    bins = np.frombuffer(b"".join(shaped["bins"]), np.uint8).reshape(-1, WIDTH).astype(np.int64)
    weight = np.frombuffer(b"".join(shaped["weights"]), np.float64)
    start = np.cumsum(lengths) - lengths
    first = np.zeros(len(bins), dtype=bool)
    first[start] = True
    inner = np.ones(len(bins), dtype=bool)  # neighbours of a window are features, not lines of the fit
    inner[start[shaped["before"].to_numpy() > 0]] = False
    inner[(start + lengths - 1)[shaped["after"].to_numpy() > 0]] = False
    index, weight = potentials_of(bins, first)[inner], weight[inner]
    lengths = lengths - shaped["before"].to_numpy() - shaped["after"].to_numpy()
    good = (shaped["quality"].to_numpy() > 0).astype(int)
    model = fit_field(index, np.repeat(good, lengths), lengths, rules)
    quality = document_quality(index, weight, Chains(lengths), model)
    return model, fit_logistic(quality[:, None], good, ridge=0.01)


def chunks_of(texts: list, most_lines: int = 20_000):
    """Runs of texts of about ``most_lines`` lines, so that memory follows the lines and not the texts."""
    at, lines = 0, 0
    for i, text in enumerate(texts):
        lines += 1 + (text or b"").count(b"\n")
        if lines >= most_lines:
            yield texts[at:i + 1]
            at, lines = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def score_documents(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    fitted = fit(docs, labels, rules)

    def score(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = [np.full(0, 0.5)]
            for part in chunks_of(texts):
                if fitted is None:
                    out.append(np.full(len(part), 0.5))
                    continue
                index, weight, lengths = prepare(part)
                quality = document_quality(index, weight, Chains(lengths), fitted[0])
                out.append(logistic(quality[:, None], fitted[1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out))],
                                             names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")) \
        .mapInArrow(score, f"doc_id {kind}, score double") \
        .select("doc_id", (remainder(rules.folds) == rules.held_out_fold).alias("held_out"), "score",
                (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality_crf(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, labels)
