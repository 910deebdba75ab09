"""Near-duplicate detection with SetSketch registers.

A document's set is its distinct five-word shingles (A-Z lower-cased).  Its sketch has ``m``
registers: every shingle is a Poisson process whose arrivals fall on registers, a register keeps
its first arrival, and stores it on an exponential scale of base ``b``, truncated to 16 bits.
Registers of a union are the maxima of the parts' registers, so sketches merge; equal registers
grow with the Jaccard similarity, so bands of register values find candidates.  A pair's similarity
is then estimated by maximum likelihood from how many registers are larger, smaller and equal
together with the two known set sizes; pairs with a fair estimate are confirmed on full sets.

Steps:
1. documents with equal sets fall into one class (order-free 128-bit digest of the full set);
2. in each band bucket every class is paired with the smallest one; pairs with a fair estimate make
   first clusters.  Buckets that still hold several clusters compare their classes tile by tile and
   send on a spanning forest of the fair pairs.  So any two classes that share a bucket and look
   similar end in one cluster, and a bucket of any size sends on fewer edges than it has members;
3. a cluster's full sets are intersected exactly, tile by tile, each class's text being sent once per
   tile of its cluster; again a spanning forest of the links leaves a task;
4. components of the links give the groups.

The chance to miss a link at similarity 0.75: no equal band (1 - 0.75**3)**32 < 3e-8, or an
estimate under ``estimate_floor``, over four standard deviations away.

Defined results: a null or empty text has no shingles and is linked with nothing; a text with fewer
than five words has one shingle, all its words; rows that repeat a doc_id are one node, whose
texts all count, a row without words keeping its own id; a null doc_id is linked with nothing, has
component null and is kept; an empty table gives an empty result.

Skew: buckets are counted with map-side sums; large buckets and clusters are split into tiles of
bounded size, and no task holds more than two tiles at a time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lansight.llm.common import Memo, materialize, mix64, ship
from lansight.llm.components import connected_components
from lansight.session import scratch_path

ship(__name__)


@dataclass(frozen=True)
class SketchRules:
    words: int = 5
    percent: int = 75
    m: int = 96
    band_rows: int = 3
    b: float = 1.001
    rate: float = 20.0
    estimate_floor: float = 0.55
    #: Classes of a tile, and shingles of a tile where full sets are compared.
    tile: int = 1024
    tile_shingles: int = 2_000_000


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def shingle_set(words: list[bytes], ids: Memo, width: int):
    """Sorted distinct 64-bit hashes of the shingles."""
    import numpy as np

    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(ids.__getitem__, words), dtype=np.uint64, count=n)
    size = min(width, n)
    odd = mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    total = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total += w[k:n - size + 1 + k] * odd[k]
    return np.unique(mix64(total))


def registers(shingles, rules: SketchRules):
    """The sketch of a non-empty set."""
    import numpy as np

    m, n = rules.m, len(shingles)
    horizon = (math.log(m) + 4.0) / n
    while True:
        first = np.full(m, np.inf)
        at, base, step = shingles, np.zeros(n), 0
        width = int(m * horizon) + 3
        while at.size:
            t = np.arange(step + 1, step + width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            r = mix64(at[:, None] + t[None, :])
            x = base[:, None] + np.cumsum(-np.log1p(-((r >> np.uint64(11)) * 2.0**-53)), axis=1) / m
            here = x < horizon
            where = (mix64(r[here] ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(m)).astype(np.int64)
            when = x[here]
            order = np.argsort(-when, kind="stable")
            fresh = np.full(m, np.inf)
            fresh[where[order]] = when[order]  # the last write is the earliest arrival
            first = np.minimum(first, fresh)
            alive = here[:, -1]
            at, base, step = at[alive], x[alive, -1], step + width
        if np.isfinite(first).all():
            break
        horizon *= 2
    k = np.floor(1.0 - np.log(first / rules.rate) / math.log(rules.b))
    return np.clip(k, 0, 65535).astype(np.uint16)


def band_hashes(regs, rules: SketchRules):
    import numpy as np

    rows = regs.reshape(-1, rules.band_rows).astype(np.uint64)
    h = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rules.band_rows):
        h = mix64(h + (rows[:, k] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    return h.view(np.int64)


def estimate(larger, smaller, equal, n_a, n_b, b: float):
    """Maximum-likelihood Jaccard similarity of pairs, from their register comparisons and set sizes."""
    import numpy as np

    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 0.0, 1.0) * (b - 1.0) / b) / math.log(b)

    def score(j):
        up, down = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        same = np.maximum(1.0 - up - down, 1e-12)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(same)

    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(24):  # the likelihood has one peak
        third = (high - low) / 3.0
        left, right = low + third, high - third
        rising = score(left) < score(right)
        low, high = np.where(rising, left, low), np.where(rising, high, right)
    return (low + high) / 2.0


def fair(larger, smaller, equal, n_a, n_b, rules: SketchRules):
    """Whether the estimate is at least the floor: the likelihood has one peak, so it rises there."""
    import numpy as np

    u, v, j, b = n_a / (n_a + n_b), n_b / (n_a + n_b), rules.estimate_floor, rules.b
    scale = (b - 1.0) / b
    x, y = np.maximum(u - v * j, 1e-9), np.maximum(v - u * j, 1e-9)
    up, down = -np.log1p(-x * scale) / math.log(b), -np.log1p(-y * scale) / math.log(b)
    # derivatives of the two probabilities by the similarity
    d_up, d_down = -v * scale / (1.0 - x * scale) / math.log(b), -u * scale / (1.0 - y * scale) / math.log(b)
    slope = larger * d_up / up + smaller * d_down / down - equal * (d_up + d_down) / np.maximum(1.0 - up - down, 1e-9)
    return slope >= 0.0


def _sketch_batches(rules: SketchRules):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids = Memo(word_hash, 200_000)
        for batch in batches:
            n, s1, s2, regs = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set((text or b"").lower().split(), ids, rules.words)
                n.append(len(s))
                s1.append(int(mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(mix64(s ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).view(np.int64)))
                regs.append(registers(s, rules).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(regs, pa.binary())], names=["doc_id", "n", "s1", "s2", "regs"])
    return run


def sketches(docs: DataFrame, rules: SketchRules = SketchRules()) -> DataFrame:
    """(doc_id, n, s1, s2, regs): set size, digest and registers of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(_sketch_batches(rules), "doc_id long, n long, s1 long, s2 long, regs binary")


def _band_batches(rules: SketchRules):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                rows = [band_hashes(np.frombuffer(r, np.uint16), rules) for r in batch.column("regs").to_pylist()]
                cid = np.repeat(batch.column("cid").to_numpy(zero_copy_only=False), len(rows[0]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(cid)], names=["band", "cid"])
    return run


def _estimate_batches(rules: SketchRules):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, rules.m)
                    for c in ("regs_a", "regs_b"))
            keep = pa.array(fair((x > y).sum(1), (x < y).sum(1), (x == y).sum(1), get("n_a").astype(float),
                                 get("n_b").astype(float), rules))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])
    return run


def join_up(label, i: int, found):
    """Merge the labels of ``found`` into that of ``i``; one of ``found`` per label that was another one."""
    import numpy as np

    own = label[i]
    other, at = np.unique(label[found], return_index=True)
    new = other != own
    if new.any():
        label[np.isin(label, other[new])] = own
    return found[at[new]]


def fair_forest(cid, cluster, n, regs, tile, rules: SketchRules) -> list[tuple[int, int]]:
    """A spanning forest of the fair pairs between clusters: of two tiles, or within one."""
    import numpy as np

    label, edges = np.unique(cluster, return_inverse=True)[1], []
    several = tile.min() != tile.max()
    for i in range(len(cid) - 1):
        ok = label[i + 1:] != label[i]
        if several:
            ok &= tile[i + 1:] != tile[i]
        others = np.flatnonzero(ok) + i + 1
        if not others.size:
            continue
        low, high = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
        others = others[100 * low >= rules.percent * high]
        equal = (regs[others] == regs[i]).sum(1)
        some = equal >= 0.3 * rules.m  # far under what the floor needs
        others, equal = others[some], equal[some]
        if others.size:
            larger = (regs[i] > regs[others]).sum(1)
            good = fair(larger, rules.m - larger - equal, equal, np.full(len(others), n[i]), n[others], rules)
            if good.any():
                edges += [(int(cid[i]), int(cid[o])) for o in join_up(label, i, others[good])]
    return edges


def link_forest(cid, sets: list, tile, rules: SketchRules) -> list[tuple[int, int]]:
    """A spanning forest of the links of two tiles, or within one, by exact intersections."""
    import numpy as np

    size = np.array([len(s) for s in sets], dtype=np.int64)
    several, docs = tile.min() != tile.max(), len(sets)
    owner = np.repeat(np.arange(docs), size)
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[number] > 1  # shingles of one set only meet nothing
    number, owner = number[shared], owner[shared]
    _, number, count = np.unique(number, return_inverse=True, return_counts=True)
    width = len(count)
    label, edges = np.arange(docs), []
    if 2.0 * docs * docs * width / 1.5e10 < 5e-9 * float((count.astype(float)**2).sum()):
        common = np.zeros((docs, docs), dtype=np.float32)  # counts under 2**24 are exact
        for at in range(0, width, 4096):
            here = (number >= at) & (number < at + 4096)
            held = np.zeros((docs, min(4096, width - at)), dtype=np.float32)
            held[owner[here], number[here] - at] = 1.0
            common += held @ held.T
        row = common.__getitem__
    else:
        by = np.argsort(number, kind="stable")
        holders, start = owner[by], np.cumsum(count) - count
        first = np.searchsorted(owner, np.arange(docs + 1))

        def row(i):
            own = number[first[i]:first[i + 1]]
            ends = np.cumsum(count[own])
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[own] - (ends - count[own]), count[own])
            return np.bincount(holders[at], minlength=docs)

    for i in range(docs - 1):
        ok = label != label[i]
        ok[:i] = False
        if several:
            ok &= tile != tile[i]
        if ok.any():
            both = row(i)
            found = np.flatnonzero(ok & (100 * both >= rules.percent * (size[i] + size - both)))
            if found.size:
                edges += [(int(cid[i]), int(cid[o])) for o in join_up(label, i, found)]
    return edges


def _by_group(columns: list[str], make):
    """Rows sorted by (g, ti, tj): ``make`` turns the rows of each pair of tiles into edges."""
    def run(batches):
        import pyarrow as pa

        key, group = None, []

        def edges():
            return make(group) if len(group) > 1 else []

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([min(e) for e in found], pa.int64()),
                                               pa.array([max(e) for e in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            found = []
            for row in zip(*(batch.column(c).to_pylist() for c in ["g", "ti", "tj", *columns])):
                if row[:3] != key:
                    found += edges()
                    key, group = row[:3], []
                group.append(row[3:])
            if found:
                yield out(found)
        yield out(edges())
    return run


def _fair_batches(rules: SketchRules):
    def make(group):
        import numpy as np

        cid, cluster, n, regs, tile = zip(*group)
        return fair_forest(np.array(cid), np.array(cluster), np.array(n, dtype=float),
                           np.frombuffer(b"".join(regs), np.uint16).reshape(len(group), -1), np.array(tile), rules)
    return _by_group(["cid", "cluster", "n", "regs", "tile"], make)


def _link_batches(rules: SketchRules):
    ids = Memo(word_hash, 200_000)

    def make(group):
        import numpy as np

        cid, sets, tile = [], [], []
        for c, s1, s2, t, text in group:
            s = shingle_set((text or b"").lower().split(), ids, rules.words)
            if mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64) == s1 and \
                    mix64(s ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).view(np.int64) == s2:
                cid.append(c)  # else another text under a repeated doc_id
                sets.append(s)
                tile.append(t)
        return link_forest(np.array(cid), sets, np.array(tile), rules) if len(cid) > 1 else []
    return _by_group(["cid", "s1", "s2", "tile", "text"], make)


class NearDuplicates:
    """Links and components of the documents (doc_id, text)."""

    def __init__(self, docs: DataFrame, rules: SketchRules = SketchRules()):
        self.spark, self.rules = docs.sparkSession, rules
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.here = scratch_path(self.spark, "near")
        self.rows = materialize(sketches(self.docs, rules), f"{self.here}/sketches")
        classes = self.rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s1", "s2").agg(
            F.min("doc_id").alias("rep"), F.first("regs").alias("regs"))
        # the written id is fixed from here on
        self.classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), f"{self.here}/classes")
        self.bands = self.classes.select("cid", "regs").mapInArrow(_band_batches(rules), "band long, cid long")

    def _candidates_of_stars(self) -> DataFrame:
        centers = self.bands.groupBy("band").agg(F.min("cid").alias("a"), F.count("*").alias("size")) \
            .where("size > 1").select("band", "a")
        return self.bands.join(centers, "band").where(F.col("cid") != F.col("a")) \
            .select("a", F.col("cid").alias("b")).distinct()

    def _estimated(self, pairs: DataFrame) -> DataFrame:
        side = lambda c: self.classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"),
                                             F.col("regs").alias(f"regs_{c}"))
        low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        return pairs.join(side("b"), "b").join(side("a"), "a").where(100 * low >= self.rules.percent * high) \
            .mapInArrow(_estimate_batches(self.rules), "a long, b long")

    def _tiled(self, rows: DataFrame, tiles: DataFrame) -> DataFrame:
        """``rows`` (g, cid, ...) once per tile that their own meets; ``tiles`` has the number per g."""
        dealt = rows.join(tiles, "g").withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles"))) \
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        return dealt.withColumn("ti", F.least("tile", "other")).withColumn("tj", F.greatest("tile", "other")) \
            .drop("tiles", "other")

    def _fair_between(self, labels: DataFrame) -> DataFrame:
        """Edges that join the clusters of buckets that hold several."""
        labelled = self.bands.join(labels, F.col("cid") == F.col("node"), "left") \
            .select(F.col("band").alias("g"), "cid", F.coalesce("component", "cid").alias("cluster"))
        mixed = labelled.groupBy("g").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"),
                                          F.count("*").alias("size")) \
            .where("low < high").select("g", F.ceil(F.col("size") / self.rules.tile).alias("tiles"))
        return self._tiled(labelled, mixed).join(self.classes.select("cid", "n", "regs"), "cid") \
            .repartition("g", "ti", "tj").sortWithinPartitions("g", "ti", "tj") \
            .select("g", "ti", "tj", "cid", "cluster", "n", "regs", "tile") \
            .mapInArrow(_fair_batches(self.rules), "a long, b long").distinct()

    def _links_within(self, clusters: DataFrame) -> DataFrame:
        """A spanning forest of the exact links of each cluster; ``clusters`` is (cid, g)."""
        rows = clusters.join(self.classes.select("cid", "n", "s1", "s2", F.col("rep").alias("doc_id")), "cid")
        tiles = rows.groupBy("g").agg(F.greatest(
            F.ceil(F.count("*") / self.rules.tile), F.ceil(F.sum("n") / self.rules.tile_shingles)).alias("tiles"))
        return self._tiled(rows.drop("n"), tiles).join(self.docs, "doc_id") \
            .select("g", "ti", "tj", "cid", "s1", "s2", "tile", F.col("text").cast("binary").alias("text")) \
            .repartition("g", "ti", "tj").sortWithinPartitions("g", "ti", "tj") \
            .mapInArrow(_link_batches(self.rules), "a long, b long").distinct()

    def _shared_ids(self) -> DataFrame:
        """Edges between the classes of one repeated doc_id."""
        own = self.rows.where("n > 0 AND doc_id IS NOT NULL").join(self.classes.select("n", "s1", "s2", "cid"),
                                                                   ["n", "s1", "s2"]).select("doc_id", "cid")
        several = own.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a < b")
        return own.join(several, "doc_id").where(F.col("cid") != F.col("a")) \
            .select("a", F.col("cid").alias("b")).distinct()

    def components(self) -> DataFrame:
        """(cid, comp) of every class that is linked with another."""
        write = lambda df, name: materialize(df, f"{self.here}/{name}")
        stars = write(self._estimated(self._candidates_of_stars()), "stars")
        first = write(connected_components(stars), "first")
        of = first.select(F.col("node").alias("cid"), "component")
        joins = write(self._fair_between(first), "joins").join(of.toDF("a", "ca"), "a", "left") \
            .join(of.toDF("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        merged = connected_components(joins).toDF("first", "g")
        every = first.select(F.col("node").alias("cid"), F.col("component").alias("first")) \
            .unionByName(merged.select(F.col("first").alias("cid"), "first")).distinct() \
            .groupBy("cid").agg(F.min("first").alias("first"))  # a cluster's smallest class is labelled with itself
        clusters = write(every.join(merged, "first", "left").select("cid", F.coalesce("g", "first").alias("g")), "clusters")
        links = write(self._links_within(clusters).unionByName(self._shared_ids()), "links")
        return connected_components(links).toDF("cid", "comp")

    def result(self) -> DataFrame:
        """Per document row: doc_id, n_shingles, component_id, kept."""
        comp = materialize(self.components(), f"{self.here}/components")
        named = self.classes.select("n", "s1", "s2", "cid", "rep").join(comp, "cid", "left") \
            .withColumn("comp", F.coalesce("comp", "cid"))
        smallest = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
        ids = named.join(smallest, "comp").select("n", "s1", "s2", "component_id")
        return self.rows.select("doc_id", "n", "s1", "s2").join(ids, ["n", "s1", "s2"], "left") \
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
                    .alias("component_id")) \
            .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def near_duplicates(docs: DataFrame, rules: SketchRules = SketchRules()) -> DataFrame:
    return NearDuplicates(docs, rules).result()


def keep_one(docs: DataFrame, rules: SketchRules = SketchRules()) -> DataFrame:
    """One document of each group of near-duplicates, the smallest doc_id; of rows that repeat that id
    the one with the smallest text hash.  Rows without an id stay.  Columns as they came."""
    kept = near_duplicates(docs, rules).where("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("kept_id")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    chosen = docs.join(kept, F.col("doc_id").cast("long") == F.col("kept_id")) \
        .groupBy("kept_id").agg(F.min_by(row, F.xxhash64("text")).alias("row")).select("row.*")
    return chosen.unionByName(docs.where(F.col("doc_id").isNull()))


def op5_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
