"""MinHash near-duplicates by an inverted join on signature coordinates.

1. A text's set is its distinct shingles of ``shingle`` words (A-Z lower-cased); texts with
   one set form one class, and only a class's smallest id goes on.
2. The signature has ``coordinates`` minima. A pair at the similarity bound has at least
   ``T = match_threshold(...)`` equal coordinates but for one time in a million.
3. Prefix: two signatures with T equal values share one among the ``coordinates - T + 1``
   rarest values of either, so only those are posted under (coordinate, value). Values that
   occur once are not posted, and a value that many texts share comes last in the order:
   it is posted only by texts that are mostly made of such values.
4. Of the posted texts the shingles that no other posted text has are counted. They bound the
   overlap of any pair, so texts with too many of them leave the lists, and pairs out of reach
   are skipped.
5. Skip merging: every list is first merged with one pivot, its member whose values
   are the most common, and each text keeps one pivot and what sets it apart from that one.
   Pairs whose texts are then connected are skipped. All other pairs of the lists are
   counted: two texts of one pivot exactly, from their differences to it, within the join.
6. Pairs with T collisions or more are confirmed on the full shingle sets (64-bit hashes).
   So only links leave a list of n near copies, and no pair that could join two components
   is left out.

Defined cases: null and empty texts, and texts without words, have the empty set and are
linked with nothing. Rows of one id count as one document, compared by one of its sets where
its texts differ; their classes are tied. A null id is linked with nothing and is its own
component. Ties in the value order go by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.components import components
from aislewise.llm.scratch import Scratch
from aislewise.llm.ship import map_batches
from aislewise.llm.textbatch import distinct, find_words, mix, shingle_hashes, slices

COORDINATES = 40
MISS = 1e-6


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Largest count of equal coordinates that a pair at ``percent`` similarity reaches with
    probability 1 - ``miss``."""
    p, below, count = percent / 100, 0.0, 0
    while below <= miss:
        below += comb(coordinates, count) * p**count * (1 - p) ** (coordinates - count)
        count += 1
    return max(1, count - 1)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, _, texts in slices(column):
        texts = texts.lowered()
        words = find_words(texts)
        hashes = texts.span_hashes(words.starts, words.ends)
        for low, high in zip(words.rows[:-1], words.rows[1:]):
            yield distinct(shingle_hashes(hashes[low:high], size))


def _multipliers(coordinates: int) -> np.ndarray:
    return np.random.default_rng(85).integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    best = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), 4096):
        best = np.minimum(best, (shingles[low:low + 4096, None] * multipliers).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, coordinates: int) -> DataFrame:
    """(id, n_shingles, key_1, key_2, sig): the keys are equal for equal sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers(coordinates)
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for own in shingle_sets(batch.column(1), shingle):
                sizes.append(len(own))
                keys.append((own.sum(), mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()))
                sigs.append(signature(own, multipliers))
            both = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
            flat = np.concatenate(sigs) if sigs else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]),
                pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * coordinates, flat),
            ], ["id", "n_shingles", "key_1", "key_2", "sig"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), sign, f"id {kind}, n_shingles bigint, key_1 bigint, key_2 bigint, sig array<int>")


def full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles) of ``texts`` (id, text, key_1): all distinct shingle hashes, of the
    texts whose set has that key."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                own = list(shingle_sets(part.column(1), shingle))
                same = [k for k, s in enumerate(own) if int(s.sum().view(np.int64)) == part.column(2)[k].as_py()]
                own = [own[k].view(np.int64) for k in same]
                ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
                flat = np.concatenate(own) if own else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(same, pa.int64())), pa.ListArray.from_arrays(ends, flat)], ["id", "shingles"])

    kind = texts.schema["id"].dataType.simpleString()
    return map_batches(texts.select("id", "text", "key_1"), collect, f"id {kind}, shingles array<bigint>")


def prefix_postings(sigs: DataFrame, coordinates: int, threshold: int) -> DataFrame:
    """(token, id, common): each signature under its rarest values, those that occur once left
    out; ``common`` is how often its values occur in all."""
    tokens = sigs.select("id", F.posexplode("sig").alias("at", "value")).select(
        "id", F.xxhash64("at", "value").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = tokens.join(counts, "token")
    ranked = shared.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("values"))
    single = F.lit(coordinates) - F.size("values")
    room = F.greatest(F.lit(coordinates - threshold + 1) - single, F.lit(0))
    common = F.aggregate("values", F.lit(0).cast("bigint"), lambda s, v: s + v["n"])
    return ranked.select("id", common.alias("common"), F.explode(F.slice("values", F.lit(1), room)).alias("v")).select(
        "v.token", "id", "common")


def _reachable(percent: int, overlap: Column, n_a: Column, n_b: Column) -> Column:
    """Whether sets of these sizes with that many common shingles reach the similarity."""
    return 100 * overlap >= percent * (n_a + n_b - overlap)


class _Join:
    def __init__(self, docs, id_col, text_col, shingle, percent, coordinates):
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.shingle, self.percent = shingle, percent
        self.threshold = match_threshold(percent, coordinates)
        self.coordinates = coordinates
        self.scratch = Scratch(docs.sparkSession, "minhash")

    def collisions(self, pairs: DataFrame, sigs: DataFrame) -> DataFrame:
        """(a, b, matches) of pairs with as many collisions as the threshold."""
        one = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
        other = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
        equal = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        counted = pairs.join(one, "a").join(other, "b").select("a", "b", equal.alias("matches"))
        return counted.where(F.col("matches") >= self.threshold)

    def with_sets(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs (a, b) with set_a, set_b and their ``overlap``."""
        one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
        other = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
        return pairs.join(other, "b").join(one, "a").withColumn("overlap", F.size(F.array_intersect("set_a", "set_b")))

    def unshared(self, sets: DataFrame) -> DataFrame:
        """(id, n, own): size of each set and how many of its shingles no other set has."""
        alone = sets.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
            F.count(F.lit(1)).alias("texts"), F.min("id").alias("id")).where("texts = 1")
        own = alone.groupBy("id").agg(F.count(F.lit(1)).alias("own"))
        return sets.select("id", F.size("shingles").cast("bigint").alias("n")).join(own, "id", "left").select(
            "id", "n", F.coalesce("own", F.lit(0)).alias("own"))

    def best_pivots(self, postings: DataFrame, sigs: DataFrame, sets: DataFrame) -> DataFrame:
        """(id, pivot, overlap, missing, extra): each text's best pivot and its differences."""
        rank = F.struct((-F.col("common")).alias("rank"), F.col("id").alias("pivot"),
                        F.col("n").alias("n_pivot"), F.col("own").alias("own_pivot"))
        chosen = postings.groupBy("token").agg(F.min(rank).alias("p")).select("token", "p.*")
        most = F.least(F.col("n") - F.col("own"), F.col("n_pivot") - F.col("own_pivot"))
        pairs = postings.join(chosen, "token").where(
            (F.col("id") != F.col("pivot")) & _reachable(self.percent, most, F.col("n"), F.col("n_pivot")))
        pairs = pairs.select(F.col("id").alias("a"), F.col("pivot").alias("b"), "rank").distinct()
        near = self.collisions(pairs.select("a", "b"), sigs)
        # The same pivot for all texts around it: that of the most common values.
        best = pairs.join(near, ["a", "b"]).groupBy("a").agg(F.min(F.struct("rank", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
        return self.scratch.save(self.with_sets(best, sets).select(
            F.col("a").alias("id"), F.col("b").alias("pivot"), "overlap", F.size("set_b").alias("n_pivot"),
            F.array_except("set_b", "set_a").alias("missing"), F.array_except("set_a", "set_b").alias("extra")))

    def relabel(self, labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """Labels (node, label) after more links between nodes of different labels."""
        if labels is None:
            return components(links, self.scratch)
        named = self.labelled(self.labelled(links, labels, "a"), labels, "b")
        merged = components(named.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).where("a != b").distinct(), self.scratch)
        onto = merged.select(F.col("node").alias("label"), F.col("label").alias("onto"))
        moved = labels.join(onto, "label", "left").select("node", F.coalesce("onto", "label").alias("label"))
        return self.scratch.save(moved.unionByName(merged.join(labels, "node", "left_anti")))

    def labelled(self, rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
        named = labels.select(F.col("node").alias(column), F.col("label").alias(f"label_{column}"))
        return rows.join(named, column, "left").withColumn(
            f"label_{column}", F.coalesce(f"label_{column}", F.col(column)))

    def rest(self, postings: DataFrame, labels: DataFrame, pivots: DataFrame) -> DataFrame:
        """(a, b, linked) of all reachable pairs of one list and different labels; ``linked`` is
        true where the pair is a link, null where that is still to be confirmed."""
        named = self.labelled(postings, labels, "id").withColumnRenamed("label_id", "label")
        mixed = named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        none = F.array().cast("array<bigint>")
        rows = named.join(mixed.select("token"), "token", "left_semi").join(pivots, "id", "left").select(
            "token", "id", "n", "own", "label", F.coalesce("pivot", "id").alias("pivot"),
            F.coalesce("n_pivot", "n").alias("n_pivot"), F.coalesce("missing", none).alias("missing"),
            F.coalesce("extra", none).alias("extra"))
        rows = self.scratch.save(rows)
        one, other = (rows.select("token", *[F.col(c).alias(f"{c}_{s}") for c in rows.columns if c != "token"]) for s in "ab")
        most = F.least(F.col("n_a") - F.col("own_a"), F.col("n_b") - F.col("own_b"))
        # Texts of one pivot: what both keep of it, and what both have beyond it.
        exact = (F.col("n_pivot_a") - F.size(F.array_union("missing_a", "missing_b"))
                 + F.size(F.array_intersect("extra_a", "extra_b")))
        sizes = F.col("n_a"), F.col("n_b")
        met = one.join(other, (one["token"] == other["token"]) & (F.col("id_a") < F.col("id_b"))
                       & (F.col("label_a") != F.col("label_b")) & _reachable(self.percent, most, *sizes)
                       & F.when(F.col("pivot_a") == F.col("pivot_b"), _reachable(self.percent, exact, *sizes)).otherwise(True))
        return self.scratch.save(met.select(
            F.col("id_a").alias("a"), F.col("id_b").alias("b"),
            F.when(F.col("pivot_a") == F.col("pivot_b"), True).alias("linked")).distinct())

    def run(self) -> tuple[DataFrame, DataFrame]:
        scratch = self.scratch
        signed = scratch.save(signatures(self.docs, "id", "text", self.shingle, self.coordinates))
        key = ["n_shingles", "key_1", "key_2"]
        classes = scratch.save(signed.where("n_shingles > 0").groupBy(*key).agg(F.min("id").alias("class_id")))
        # An id stands for one set: that of the smallest key, where its rows differ.
        first = classes.groupBy(F.col("class_id").alias("id")).agg(F.min(F.struct(*key)).alias("k")).select("id", "k.*")
        sigs = scratch.save(signed.join(first, ["id", *key]).select("id", "key_1", "sig").dropDuplicates(["id"]))
        members = signed.join(classes, key, "left").select(
            "id", "n_shingles", F.coalesce("class_id", "id").alias("class_id"))
        posted = scratch.save(prefix_postings(sigs, self.coordinates, self.threshold))
        wanted = sigs.select("id", "key_1").join(posted.select("id").distinct(), "id", "left_semi")
        sets = scratch.save(full_sets(self.docs.join(wanted, "id"), self.shingle).dropDuplicates(["id"]))
        rest = F.col("n") - F.col("own")
        sizes = self.unshared(sets).where(_reachable(self.percent, rest, F.col("n"), rest))
        postings = scratch.save(posted.join(sizes, "id"))

        pivots = self.best_pivots(postings, sigs, sets)
        size = F.col("n_pivot") - F.size("missing") + F.size("extra")
        links = pivots.where(_reachable(self.percent, F.col("overlap"), size, F.col("n_pivot"))).select(
            F.col("id").alias("a"), F.col("pivot").alias("b"))
        # Rows of one id with different sets tie their classes together.
        tied = members.groupBy("id").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
        tied = members.join(tied.where("low < high"), "id").where("class_id > low").select(
            F.col("low").alias("a"), F.col("class_id").alias("b"))
        labels = self.relabel(None, links.unionByName(tied).distinct())

        met = self.rest(postings, labels, pivots)
        likely = self.collisions(met.where("linked is null").select("a", "b"), sigs).select("a", "b")
        confirmed = self.with_sets(likely, sets).where(
            _reachable(self.percent, F.col("overlap"), F.size("set_a"), F.size("set_b"))).select("a", "b")
        labels = self.relabel(labels, scratch.save(met.where("linked").select("a", "b").unionByName(confirmed).distinct()))
        scratch.drop(sets, posted, postings)
        return members, labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
                    shingle: int = 5, coordinates: int = COORDINATES) -> DataFrame:
    """(id, n_shingles, class_id, component_id, kept): one row per document row.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id
    reachable over links of ``percent`` similarity or more, ``kept`` marks that id itself.
    """
    members, labels = _Join(docs, id_col, text_col, shingle, percent, coordinates).run()
    named = labels.select(F.col("node").alias("class_id"), F.col("label").alias("component_id"))
    return members.join(named, "class_id", "left").select(
        F.col("id").alias(id_col), "n_shingles", "class_id",
        F.coalesce("component_id", "class_id").alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
