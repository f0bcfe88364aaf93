"""Near duplicates by circulant MinHash, banding, and exact Jaccard similarity on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import components, forest, pick, table, written

SHINGLE = 5
#: link at a similarity of so many hundredths
LEAST = 75
#: rows of a band and bands: of pairs at the least similarity, one in 1.4 million shares no band
ROWS, BANDS = 6, 72
#: classes of a block that is compared with others
TILE = 512
#: words whose hashes a task remembers
REMEMBERED = 1_000_000

_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, words_of: _Words) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of five words of the whole text, sorted; with fewer words, of all of them.

    Words are runs of anything but space and the control characters 9 to 13, with A-Z lowered.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(words_of.__getitem__, words), np.uint64, len(words))
    if len(hashed) < SHINGLE:
        whole = (hashed * _WEIGHTS[: len(hashed)]).sum(dtype=np.uint64) + np.uint64(len(hashed))
        return _mix(np.array([whole], np.uint64))
    n = len(hashed) - SHINGLE + 1
    runs = hashed[:n] * _WEIGHTS[0]
    for i in range(1, SHINGLE):
        runs += hashed[i : i + n] * _WEIGHTS[i]
    return np.unique(_mix(runs))


def signature(sets: list[np.ndarray], rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """A row of band hashes for each set, by circulant MinHash.

    A first permutation puts every shingle at a place of a circle of 2 ** 32. Coordinate k is the least value under a
    second permutation, shifted by k around the circle: one permutation serves for all coordinates.
    """
    coordinates = np.empty((len(sets), rows * bands), np.uint32)
    borders = np.cumsum([0] + [len(s) for s in sets])
    # the first permutation: a bijection of 64 bits, of which the upper half is the place
    places = (_mix(np.concatenate(sets) * np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(rows * bands, dtype=np.uint32)[:, None]
    spread = np.uint32(0x9E3779B1)
    for first in range(0, rows * bands, 48):
        for start, end, of in _together(borders, 4096):
            # the second permutation, of (place + shift): multiply, fold, multiply, fold
            value = places[start:end] * spread + shifts[first : first + 48] * spread
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x85EBCA77)
            value ^= value >> np.uint32(13)
            for i in of:
                low, high = max(borders[i], start) - start, min(borders[i + 1], end) - start
                least = value[:, low:high].min(axis=1)
                if borders[i] < start:
                    least = np.minimum(least, coordinates[i, first : first + 48])
                coordinates[i, first : first + 48] = least
    weights = np.random.default_rng(5).integers(1, 1 << 63, (bands, rows)).astype(np.uint64) | np.uint64(1)
    banded = coordinates.reshape(len(sets), bands, rows).astype(np.uint64)
    return _mix((banded * weights).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _together(borders: np.ndarray, most: int) -> Iterator[tuple[int, int, range]]:
    """Slices of at most `most` elements, and the sets that each has a part of."""
    for start in range(0, int(borders[-1]), most):
        end = min(start + most, int(borders[-1]))
        first = int(np.searchsorted(borders, start, "right")) - 1
        yield start, end, range(first, int(np.searchsorted(borders, end, "left")))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n (distinct shingles), key (a hash of the set), bands: the last two null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = _Words()
        for batch in batches:
            for start in range(0, len(batch), 200):
                ids = batch.column("doc_id").slice(start, 200)
                sets = [shingles(t or "", words_of) for t in batch.column("text").slice(start, 200).to_pylist()]
                full = [s for s in sets if len(s)]
                found = iter(signature(full) if full else ())
                bands = [next(found) if len(s) else None for s in sets]
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    schema=_SIGNED,
                )

    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(sign, "doc_id long, n long, key binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, words): the full sets, for the documents whose ids are in `wanted`."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = _Words()
        for batch in batches:
            for start in range(0, len(batch), 500):
                sets = [shingles(t, words_of).view(np.int64) for t in batch.column("text").slice(start, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, 500), pa.array(sets, pa.list_(pa.int64()))], names=["id", "words"]
                )

    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).where("text is not null")
    chosen = rows.join(wanted, rows["doc_id"] == wanted["id"], "left_semi")
    return chosen.mapInArrow(build, "id long, words array<long>")


def _alike(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * LEAST


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("words").alias("a_words")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("words").alias("b_words")), "b")
    common = F.size(F.array_intersect("a_words", "b_words"))
    union = F.size("a_words") + F.size("b_words") - common
    return both.where((common * 100 >= union * LEAST) & (F.size("a_words") > 0)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document; documents of a component are linked directly or by others.

    Documents with equal sets form a class, which goes on as its least doc_id; copies are never paired. Classes that
    share a band hash are candidates, and every link is confirmed on full sets. Which class to compare with which is
    chosen so that large groups cost one comparison a class: in each of `rounds`, a class meets one centre of one of
    its buckets, and links found join components. Pairs within a component need no comparison. Of the other classes,
    those go that have too few shingles in common with all classes left, taken together, to be linked with any. Pairs
    that are left in the end, in one bucket but of different components, are all compared, so no link between
    components is lost: classes that share buckets with many others in tiles, which give forests, the rest as pairs.

    Null or empty text, or one of white space alone: no shingles, linked with nothing. Null doc_id: likewise, with a
    null component, kept. Rows with one doc_id are one document when it comes to links. No documents: no rows. Only
    doc_id and text are looked at.
    """
    every = written(signed(docs), "signed")
    having = every.where("doc_id is not null and n > 0")
    classes = written(
        having.groupBy("key").agg(
            F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands")
        ),
        "classes",
    )
    banded = classes.select("id", "n", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("centre")).where("size > 1")
    members = written(banded.join(buckets.select("bucket", "centre"), "bucket"), "members")
    sets = written(_sets(docs, members.select("id").distinct()), "sets")

    size_of = members.select(F.col("id").alias("centre"), F.col("n").alias("centre_n")).distinct()
    first = members.where("id <> centre").select("id", "n", "centre").distinct().join(size_of, "centre")
    pairs = first.where(_alike(F.col("n"), F.col("centre_n"))).groupBy(F.col("id").alias("b")).agg(F.min("centre").alias("a"))
    links = written(_links(pairs, sets), "links")
    labels = written(components(links), "labels")
    for number in range(1, rounds + 1):
        open_members = _linkable(_unresolved(members, labels), sets)
        if number < rounds:
            place = F.xxhash64(F.lit(number), "id")
            centres = written(
                open_members.groupBy("bucket").agg(F.min_by(F.struct("id", "n", "label"), place).alias("c")).select("bucket", "c.*")
                .toDF("bucket", "a", "a_n", "a_label"),
                "centres",
            )
            met = open_members.join(centres, "bucket").where((F.col("label") != F.col("a_label")) & _alike(F.col("n"), F.col("a_n")))
            pairs = met.groupBy(F.col("id").alias("b")).agg(F.min_by("a", F.xxhash64("a", F.lit(number))).alias("a"))
        else:
            dense, open_members = _dense(open_members)
            links = links.union(written(_tile_links(dense, sets), "links"))
            other = open_members.select("bucket", F.col("id").alias("a"), F.col("n").alias("a_n"), F.col("label").alias("a_label"))
            met = open_members.join(other, "bucket").where(
                (F.col("a") < F.col("id")) & (F.col("label") != F.col("a_label")) & _alike(F.col("n"), F.col("a_n"))
            )
            pairs = met.select("a", F.col("id").alias("b")).distinct()
        new = written(_links(pairs, sets), "links")
        links = links.union(new)
        labels = written(components(links), "labels")

    of_class = classes.select("key", F.col("id").alias("class_id"))
    found = every.select("doc_id", "n", "key").join(of_class, "key", "left").join(
        labels.withColumnRenamed("node", "class_id"), "class_id", "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component so far, with their component as `label`."""
    labelled = members.select("bucket", "id", "n").join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "id", "n", F.coalesce("component", "id").alias("label")
    )
    return _mixed(written(labelled, "labelled"))


def _mixed(labelled: DataFrame) -> DataFrame:
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return written(labelled.join(mixed.select("bucket"), "bucket", "left_semi"), "unresolved")


def _linkable(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Without the members that cannot be linked with any other, and buckets that hold one component then.

    What a class has in common with one other is at most what it has in common with all the others. A link of sets of
    sizes a and b needs LEAST / (100 + LEAST) of a + b; b is at least the smallest size in the class's buckets, and
    LEAST hundredths of a.
    """
    smallest = written(members.groupBy("bucket").agg(F.min("n").alias("low")), "smallest")
    classes = written(
        members.join(smallest, "bucket").groupBy("id").agg(F.first("n").alias("n"), F.min("low").alias("low")), "open"
    )
    words = sets.join(classes.select("id"), "id", "left_semi").select("id", F.explode("words").alias("word"))
    shared = words.groupBy("word").agg(F.count("*").alias("times")).where("times > 1").select("word")
    common = written(words.join(shared, "word", "left_semi").groupBy("id").agg(F.count("*").alias("common")), "common")
    other = F.greatest(F.col("low"), F.ceil(F.col("n") * LEAST / 100))
    able = classes.join(common, "id").where(F.col("common") * (100 + LEAST) >= (F.col("n") + other) * LEAST).select("id")
    return _mixed(written(members.join(able, "id", "left_semi"), "able"))


def _dense(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes (id, n, label, cluster, blocks) of clusters dense enough for tiles, and the members of all other clusters.

    Buckets that share a class are of one cluster. Pairs within buckets, counted once a bucket, are few if there are at
    most 32 for each class; where there are more, and one for 64 pairs of the cluster or more, tiles cost less.
    """
    buckets = written(members.groupBy("bucket").agg(F.min("id").alias("centre"), (F.count("*") * F.count("*")).alias("pairs")), "buckets")
    edges = members.join(buckets, "bucket").where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    of = written(components(edges).withColumnRenamed("node", "id").withColumnRenamed("component", "cluster"), "clusters")
    size = of.groupBy("cluster").agg(F.count("*").alias("size"))
    pairs = buckets.join(of, buckets["centre"] == of["id"]).groupBy("cluster").agg(F.sum("pairs").alias("pairs"))
    dense = written(
        size.join(pairs, "cluster").where("pairs > 32 * size and size * size <= 64 * pairs")
        .select("cluster", F.ceil(F.col("size") / TILE).cast("int").alias("blocks")),
        "dense",
    )
    inside = written(of.join(dense, "cluster"), "inside")
    classes = members.select("id", "n", "label").distinct().join(inside, "id")
    return classes, written(members.join(inside.select("id"), "id", "left_anti"), "sparse")


def _tile_links(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): a forest of each tile's links between classes of different labels.

    A cluster's classes are dealt into blocks by a hash; each two blocks, and each block with itself, make a tile.
    """

    def compare(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        _, left, right = key
        block, ids, labels, n = (f[c].to_numpy() for c in ("block", "id", "label", "n"))
        rows, columns = np.flatnonzero(block == left), np.flatnonzero(block == right)
        words = [np.asarray(w) for w in f["words"]]
        # places of each word among the columns' sets
        known, at = np.unique(np.concatenate([words[c] for c in columns]), return_inverse=True)
        owner = np.repeat(np.arange(len(columns)), [len(words[c]) for c in columns])[np.argsort(at, kind="stable")]
        first = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(known)))])
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in rows:
            place = np.searchsorted(known, words[r])
            place = place[(place < len(known)) & (known[np.minimum(place, len(known) - 1)] == words[r])]
            starts, lengths = first[place], first[place + 1] - first[place]
            within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            common = np.bincount(owner[np.repeat(starts, lengths) + within], minlength=len(columns))
            union = n[r] + n[columns] - common
            hit = columns[(common * 100 >= union * LEAST) & (labels[columns] != labels[r])]
            found_a.append(np.full(len(hit), ids[r]))
            found_b.append(ids[hit])
        nodes, roots = forest(np.concatenate(found_a), np.concatenate(found_b))
        return pd.DataFrame({"a": nodes, "b": roots})[nodes != roots]

    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(F.col("block"), o).alias("left"), F.greatest(F.col("block"), o).alias("right")),
    )
    sent = classes.withColumn("block", block).join(sets, "id").select("cluster", "id", "n", "label", "block", "words", F.explode(others).alias("t"))
    tiles = sent.select("cluster", "t.left", "t.right", "id", "n", "label", "block", "words").groupBy("cluster", "left", "right")
    return tiles.applyInPandas(compare, "a long, b long")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
