"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming check, components.

A text is lower-cased (A-Z only), cut at ASCII white space and turned into word shingles, repeats included. Every shingle
has a 64-bit hash; a fingerprint bit is set if it is set in over half of them. Fewer words than a shingle give one
shingle of all words; no words (null or empty text) give fingerprint zero, which is compared like any other.

Fingerprints at most ``distance`` bits apart are linked. Cut into ``distance + 2`` blocks, a close pair agrees in two of
them at least, so rows meet under every pair of blocks (the join key) and their distance is then checked. Only distinct
fingerprints take part: copies, however many, are one row. A key with more fingerprints than ``GROUP`` is not compared
pair by pair; its fingerprints meet under every fingerprint one bit away, where at most 65 can meet. Two that are at most
two bits apart always share such a midpoint, and two that share one are at most two bits apart, so this finds the same
links exactly, in work proportional to the rows. For a distance of one bit they are joined with their 64 neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import ddl, id_and_text, per_slice, stored, tidy
from rowtide.llm.components import components

BITS = 64
# Fixed value: seed of the shingle hash.
SEED = 42
# Fingerprints under one key that are compared pair by pair; more go over midpoints.
GROUP = 256


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends[:-1])]
    grams = [joined[a:b] for a, b in zip(starts, ends[size - 1 :])]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), np.uint64, len(grams))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, fp`` of every row; ``fp`` is the fingerprint as a signed long."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        values = pa.array(np.array(found, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), values], ["id", "fp"])

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(per_slice(work), f"id {ddl(rows, 'id')}, fp long")


def block_keys(fp: Column, distance: int) -> list[Column]:
    """The keys under which fingerprints meet: every pair of the ``distance + 2`` blocks, numbered."""
    count = distance + 2
    cuts = [BITS * i // count for i in range(count + 1)]
    keys = []
    for number, kept in enumerate(combinations(range(count), 2)):
        mask = sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in kept)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("block"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return keys


def _close_in_group(distance: int):
    """From arrays of fingerprints to (a, b): every member and the smallest one it is linked to inside the array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column(0):
                fps = np.sort(np.array(members.values.to_numpy(), np.int64))
                unsigned = fps.view(np.uint64)
                near = np.bitwise_count(unsigned[:, None] ^ unsigned[None, :]) <= distance
                if near.sum() == len(fps):
                    continue
                label = np.arange(len(fps))
                while True:  # smallest reachable member
                    least = np.where(near, label[None, :], len(fps)).min(1)
                    if (least == label).all():
                        break
                    label = least
                other = label != np.arange(len(fps))
                left.append(fps[other])
                right.append(fps[label[other]])
            if left:
                columns = [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def links(distinct: DataFrame, distance: int = 2) -> DataFrame:
    """``a, b``: enough links between fingerprints (column ``fp``, distinct) to connect all that are ``distance`` bits
    apart or less, directly or over others."""
    if not 0 <= distance <= 2:
        raise ValueError("the midpoint rule holds for at most two differing bits")
    met = distinct.select("fp", F.explode(F.array(*block_keys(F.col("fp"), distance))).alias("key"))
    sizes = met.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = stored(met.join(sizes, "key"), "simhash-blocks")
    groups = met.filter(F.col("size") <= GROUP).groupBy("key").agg(F.collect_list("fp").alias("fps")).select("fps")
    close = groups.mapInArrow(tidy(_close_in_group(distance)), "a long, b long")
    crowded = met.filter(F.col("size") > GROUP).select("fp").distinct()
    flips = [F.lit((1 << i) - (1 << BITS) if i == BITS - 1 else 1 << i).cast("long") for i in range(BITS)]
    neighbours = F.array(*(F.col("fp").bitwiseXOR(f) for f in flips))
    if distance < 2:
        # fingerprints are distinct, so at distance 0 there is nothing to link
        near = crowded.select(F.col("fp").alias("a"), F.explode(neighbours).alias("b")).filter(F.lit(distance == 1) & (F.col("a") > F.col("b")))
        return close.unionByName(near.join(crowded.withColumnRenamed("fp", "b"), "b", "left_semi").select("a", "b"))
    at_midpoint = crowded.select("fp", F.explode(F.concat(F.array("fp"), neighbours)).alias("mid")).groupBy("mid")
    stars = at_midpoint.agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = stars.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).filter("a <> b")
    return close.unionByName(stars)


def _rooted(fps: DataFrame, distance: int) -> DataFrame:
    """``fp, root``: the smallest fingerprint that each can reach."""
    distinct = fps.select("fp").distinct()
    linked = components(links(distinct, distance))
    joined = distinct.join(linked, distinct["fp"] == linked["vertex"], "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """``<id_col>, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits, ``component_id`` the smallest id that can be reached over links, the
    row's own included. A null id has its fingerprint and takes the component of its links, and never names one: a
    component of null ids alone has a null ``component_id``. Repeated rows are kept. An empty table gives no rows.
    Other columns of ``docs`` are not looked at.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    rooted = _rooted(fps, distance).join(fps.groupBy("fp").agg(F.min("id").alias("least")), "fp")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(named, "root").select("fp", "component_id")
    return fps.join(of_class, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """The rows of ``docs`` that stay when one of each group of near duplicates does: that with the smallest id.

    A row is known by its id and its text: of rows alike in both one stays, rows that share only the id are judged by
    their own texts, so one may stay while the other goes, or both may stay. Rows without id link others, stay and
    stand for no group.
    """
    digest = F.xxhash64(docs[text_col].cast("string"))
    known = docs.withColumns({"__id": docs[id_col], "__digest": digest})
    rows = known.select(F.struct("__id", "__digest").alias("__row"), text_col)
    fps = stored(fingerprints(rows, "__row", text_col, shingle), "simhash-rows")
    # one row per fingerprint before it is joined, however many copies there are
    least = fps.filter("id.__id is not null").groupBy("fp").agg(F.min("id").alias("row"))
    grouped = least.join(_rooted(fps, distance), "fp").groupBy("root")
    kept = grouped.agg(F.min(F.struct("row.__id", "fp", "row.__digest")).alias("first")).select("first.__id", "first.__digest")
    # plain columns, so that repeats of a row are found where the join has dealt them
    named = known.join(kept, ["__id", "__digest"], "left_semi").dropDuplicates(["__id", "__digest"])
    return named.select(*docs.columns).unionByName(docs.filter(docs[id_col].isNull()))
