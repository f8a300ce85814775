"""Near-duplicates by an LSH forest, confirmed on full shingle sets.

1. A document's set of word shingles gets a digest; documents with equal sets are one class, and
   only its smallest id goes on. A group of exact copies is one row from here.
2. Each class has a MinHash signature, read in several orders (trees). In each tree the classes
   are sorted by signature; neighbours there whose common prefix is long enough are candidates. The least
   depth follows from the similarity and a chance of missing a pair below 1e-4 over all trees. Beyond it the depth adapts:
   sorting goes on by further values, so that within a dense region the closest stand together. The sort is a range
   partitioning, which splits a region of any size; what is cut at the edge of a partition is tied together by its
   first and last region.
3. Candidates form candidate groups (connected components). A group's full sets meet in one task, which
   finds all links in it: from any document it walks along links, so each document is compared, by counts of
   shared shingles, with those not reached yet. Nothing is emitted but one edge per document. A group above a
   fixed size is dealt into blocks, and a few of its members, the pivots, visit every block, so that near
   copies of one text are one component after this. What is left are the strays, those outside the main component
   of their group: they are compared with each other and with the main one, in blocks again; the main component is
   never compared with itself. Where strays would fill many blocks, this is done region by region of the trees,
   each with its own main component, so that only what shares a region meets. So the work on a hot group
   grows with its members, and with pairs only as far as they are unlike and yet share a region.
4. Components of the links are the result.

Defined cases: a text without words, or NULL, has an empty set and links with nothing; ids are taken to
be unique and a NULL id never names a component; repeated rows are equal documents; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import kept, shipped
from salesloom.llm.components import connected
from salesloom.llm.words import SPACED, Words, find_words, mix, slices

MISSED = 1e-4


@dataclass(frozen=True)
class Likeness:
    """Shingles of `words` words; a link is percent * union <= 100 * intersection. `beyond`: values
    that go on ordering a region below the least depth. `block`: documents that meet in one task, twice at most.
    `pivots`: about so many documents of a large group visit each of its blocks. `stray_blocks`: up to so many
    blocks of strays a group is compared as a whole, beyond that region by region."""

    words: int = 5
    percent: int = 80
    trees: int = 32
    beyond: int = 4
    block: int = 1500
    pivots: int = 48
    stray_blocks: int = 8

    @property
    def depth(self) -> int:
        """Values that two documents must share in a tree: chance s^depth, missed (1 - s^depth)^trees."""
        return max(1, floor(log(1 - MISSED ** (1 / self.trees)) / log(self.percent / 100)))


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted; all its words as one if they are fewer than k."""
    runs, inside = words.runs(k)
    for first, n in zip(words.first.tolist(), words.counts.tolist(), strict=True):
        if n >= k:
            yield np.unique(runs[first : first + n - k + 1])
        elif n:
            short = Words(words.data, words.start, words.end, words.hashes[first : first + n], np.array([n]))
            yield short.runs(n)[0]
        else:
            yield np.zeros(0, np.uint64)


def _signatures(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over each set."""
    out = np.full((len(sets), len(factors)), np.iinfo(np.uint32).max, np.uint32)
    for i, own in enumerate(sets):
        values = (own >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(values), 1024):
            out[i] = np.minimum(out[i], (values[at : at + 1024, None] * factors).min(0))
    return out


def _forest(like: Likeness):
    depth, beyond = like.depth, like.beyond

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(11)
        factors = (random.integers(0, 2**31, like.trees * (depth + beyond), np.uint32) << 1) | 1
        for batch in batches:
            for part in slices(batch, "text"):
                words = find_words(part.column("text"), SPACED, lower=True)
                sets = list(shingle_sets(words, like.words))
                values = _signatures(sets, factors).reshape(len(sets), like.trees, depth + beyond).astype(np.uint64)
                region = np.broadcast_to(np.arange(1, like.trees + 1, dtype=np.uint64), values.shape[:2])
                for j in range(depth):
                    region = mix(region * np.uint64(0xD6E8FEB86659FD93) + values[:, :, j])
                order = np.zeros(values.shape[:2], np.uint64)
                for j in range(depth, depth + beyond):
                    order = order << np.uint64(8) | values[:, :, j] & np.uint64(0xFF)
                none = [len(s) == 0 for s in sets]
                both = lambda x: pa.array([None if n else r for n, r in zip(none, list(x.view(np.int64)), strict=True)], pa.list_(pa.int64()))
                digests = [
                    pa.array(np.array([f(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64))
                    for f in (mix, lambda s: mix(s ^ np.uint64(0x9E3779B97F4A7C15)))
                ]
                sizes = pa.array(np.array([len(s) for s in sets], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), sizes, *digests, both(region), both(order)],
                    names=["id", "n", "digest", "digest2", "regions", "orders"],
                )

    return sign


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (region, order, id): an edge from each row to the first of its region here. Besides, marked with a
    region, the head of the first and of the last region, which may go on in another partition."""
    region_before, head, edges_of = None, None, None
    for batch in batches:
        region, ids = batch.column("region").to_numpy(), batch.column("id").to_numpy()
        if not len(ids):
            continue
        starts = np.r_[True, region[1:] != region[:-1]]
        starts[0] = region[0] != region_before
        heads = ids[np.maximum.accumulate(np.where(starts, np.arange(len(ids)), -1))]
        if not starts[0]:
            heads[: int(np.argmax(starts)) if starts.any() else len(ids)] = head
        if region_before is None:
            yield _edges(np.array([region[0]]), heads[:1], heads[:1])
        more = heads != ids
        yield _edges(None, heads[more], ids[more])
        region_before, head = region[-1], heads[-1]
    if region_before is not None:
        yield _edges(np.array([region_before]), np.array([head]), np.array([head]))


def _edges(region: np.ndarray | None, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    marks = pa.array([None] * len(a), pa.int64()) if region is None else pa.array(region)
    return pa.RecordBatch.from_arrays([marks, pa.array(a), pa.array(b)], names=["region", "a", "b"])


def _candidates(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that tie the classes of each region together."""
    rows = classes.select("id", F.explode(F.arrays_zip("regions", "orders")).alias("r")).select(
        F.col("r.regions").alias("region"), F.col("r.orders").alias("order"), "id"
    )
    ordered = rows.repartitionByRange("region", "order", "id").sortWithinPartitions("region", "order", "id")
    found = kept(ordered.mapInArrow(_neighbours, "region bigint, a bigint, b bigint"), "neighbours")
    # Two rows a partition: regions that go on from one to the next.
    cut = found.filter("region IS NOT NULL").groupBy("region").agg(F.min("a").alias("a"), F.collect_set("a").alias("b"))
    return found.filter("region IS NULL").select("a", "b").unionByName(cut.select("a", F.explode("b").alias("b")))


def walk_links(sets: list[np.ndarray], percent: int, settled: np.ndarray | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The component of each set under links of at least that similarity, as the place of one of its members.
    `settled` sets are known to be one component: no walk starts or goes on from them, and each walk
    that meets them tells so by one pair (where it met them first, one of them)."""
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(len(sets)), sizes)
    _, shingles, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[shingles] > 1
    owners, shingles = owners[shared], shingles[shared]
    starts_of = np.searchsorted(owners, np.arange(len(sets) + 1))
    order = np.argsort(shingles, kind="stable")
    holders, ends = owners[order], np.cumsum(np.bincount(shingles, minlength=len(times)))
    begins = np.r_[0, ends[:-1]]
    waiting, component = np.ones(len(sets), bool), np.arange(len(sets))
    settled, met = np.zeros(len(sets), bool) if settled is None else settled, []
    in_lists = len(sets)
    for root in range(len(sets)):
        if not waiting[root] or settled[root]:
            continue
        waiting[root], alone = False, True
        queue = [root]
        while queue:
            i = queue.pop()
            own = shingles[starts_of[i] : starts_of[i + 1]]
            lengths = ends[own] - begins[own]
            total = int(lengths.sum())
            if not total or not waiting.any():
                continue
            at = np.repeat(begins[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
            common = np.bincount(holders[at], minlength=len(sets))
            linked = np.flatnonzero(waiting & (common > 0) & (100 * common >= percent * (sizes[i] + sizes - common)))
            if settled[linked].any():
                if alone:
                    met.append((root, int(linked[settled[linked]][0])))
                alone, linked = False, linked[~settled[linked]]
            waiting[linked], component[linked] = False, root
            queue += linked.tolist()
            left = int(waiting.sum())
            if left * 2 < in_lists:  # forget those that are done
                still = waiting[holders]
                names = np.repeat(np.arange(len(ends)), ends - begins)[still]
                holders, in_lists = holders[still], left
                ends = np.cumsum(np.bincount(names, minlength=len(ends)))
                begins = np.r_[0, ends[:-1]]
    return component, met


def _walk(table: pa.Table, percent: int, settled: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that tie the rows of a task into their components."""
    ids = table.column("id").to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    component, met = walk_links(sets, percent, settled)
    more = component != np.arange(len(ids))
    met = np.array(met, np.int64).reshape(-1, 2)
    return np.r_[ids[component[more]], ids[met[:, 0]]], np.r_[ids[more], ids[met[:, 1]]]


def _block_links(percent: int):
    def links(table: pa.Table) -> pa.Table:
        """Links of a block as (id, other); of groups of several blocks also (group, id, set) of those at home here."""
        a, b = _walk(table, percent)
        names = ["group", "id", "other", "shingles"]
        found = pa.table([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), pa.nulls(len(a), pa.binary())], names=names)
        if table.column("blocks")[0].as_py() == 1:
            return found
        home = table.filter(table.column("home"))
        sets = [home.column("component"), home.column("id"), pa.nulls(home.num_rows, pa.int64()), home.column("shingles")]
        return pa.concat_tables([found, pa.table(sets, names=names)])

    return links


def _pair_links(percent: int):
    def links(table: pa.Table) -> pa.Table:
        a, b = _walk(table, percent, table.column("settled").to_numpy())
        return pa.table([pa.array(a), pa.array(b)], names=["a", "b"])

    return links


def _full_sets(k: int):
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = find_words(part.column("text"), SPACED, lower=True)
                sets = pa.array([s.tobytes() for s in shingle_sets(words, k)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "component", "blocks")), sets], names=["id", "component", "blocks", "shingles"])

    return full


def _mains(labelled: DataFrame, key: str, block: int) -> DataFrame:
    """For each key that holds several components the largest one, and the blocks of its members and of all others."""
    return (
        labelled.groupBy(key, "label")
        .agg(F.count("*").alias("n"))
        .groupBy(key)
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"))
        .filter("n > most.n")
        .select(
            key, F.col("most.label").alias("main"), F.ceil((F.col("n") - F.col("most.n")) / block).cast("int").alias("strays"),
            F.ceil(F.col("most.n") / block).cast("int").alias("mains"),
        )
    )


def _across(large: DataFrame, first: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """Links (a, b) within large groups between members that are not in one component yet."""
    labelled = large.select("group", "id").join(first, F.col("id") == F.col("node"), "left")
    labelled = kept(labelled.select("group", "id", F.coalesce("component", "id").alias("label")), "labelled")
    mixed = labelled.join(_mains(labelled, "group", like.block), "group")
    many = kept(mixed.filter(F.col("strays") > like.stray_blocks).select("id", "label"), "many")
    spots = many.join(classes.select("id", "regions"), "id").select(F.explode("regions").alias("region"), "id", "label")
    few = mixed.filter(F.col("strays") <= like.stray_blocks).withColumnRenamed("group", "region")
    meeting = few.unionByName(spots.join(_mains(spots, "region", like.block), "region"))
    # A stray block meets every other one and every main block; a main block meets the strays only.
    stray = F.col("label") != F.col("main")
    own = F.pmod(F.xxhash64("id"), F.when(stray, F.col("strays")).otherwise(F.col("mains"))).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    with_strays = F.transform(numbers("strays"), lambda x: pair(F.least(x, own), F.greatest(x, own)))
    of_stray = F.concat(F.filter(with_strays, lambda p: p["i"] < p["j"]), F.transform(numbers("mains"), lambda x: pair(own, -1 - x)))
    of_main = F.transform(numbers("strays"), lambda x: pair(x, -1 - own))
    tasks = meeting.select("region", "id", (~stray).alias("settled"), F.explode(F.when(stray, of_stray).otherwise(of_main)).alias("pair"))
    return (
        tasks.join(large.select("id", "shingles"), "id")
        .select("region", "pair.i", "pair.j", "id", "settled", "shingles")
        .groupBy("region", "i", "j")
        .applyInArrow(_pair_links(like.percent), "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, like: Likeness | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    like = like or Likeness()
    source = shipped(docs).select(F.col(id_column).cast("long").alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    schema = "id bigint, n bigint, digest bigint, digest2 bigint, regions array<bigint>, orders array<bigint>"
    signed = kept(source.mapInArrow(_forest(like), schema), "signed")
    # Documents with equal sets have equal signatures: any of them stands for all.
    classes = kept(
        signed.filter("n > 0 AND id IS NOT NULL")
        .groupBy("digest", "digest2", "n")
        .agg(F.min("id").alias("id"), F.any_value("regions").alias("regions"), F.any_value("orders").alias("orders")),
        "classes",
    )
    grouped = kept(connected(_candidates(classes)), "grouped")
    sizes = grouped.groupBy("component").agg(F.ceil(F.count("*") / like.block).cast("int").alias("blocks"))
    members = grouped.join(sizes, "component").select(F.col("node").alias("id"), "component", "blocks")
    sets = (
        # Dealt out by id at every size: whether the members could be broadcast says nothing about a larger corpus.
        source.join(members.hint("shuffle_hash"), "id")
        .dropDuplicates(["id"])
        .mapInArrow(_full_sets(like.words), "id bigint, component bigint, blocks int, shingles binary")
    )
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks") * (like.block // like.pivots + 1)) == 0)
    visits = F.when(pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = sets.select("component", "blocks", "id", "shingles", F.explode(visits).alias("block"), own.alias("own"))
    found = kept(
        dealt.withColumn("home", F.col("block") == F.col("own"))
        .groupBy("component", "block")
        .applyInArrow(_block_links(like.percent), "group bigint, id bigint, other bigint, shingles binary"),
        "links",
    )
    first = kept(connected(found.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))), "linked")
    across = _across(found.filter("shingles IS NOT NULL"), first, classes, like)
    components = connected(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(across))
    named = classes.join(components, classes["id"] == components["node"], "left").select(
        "digest", "digest2", F.col("n").alias("size"), F.coalesce("component", "id").alias("component")
    )
    same = (signed["digest"] == named["digest"]) & (signed["digest2"] == named["digest2"]) & (signed["n"] == named["size"])
    component = F.coalesce(F.col("component"), F.col("id"))
    return signed.join(named, same, "left").select(
        F.col("id").cast(docs.schema[id_column].dataType).alias(id_column), F.col("n").alias("n_shingles"),
        component.cast(docs.schema[id_column].dataType).alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, like: Likeness | None = None) -> DataFrame:
    """One document of each group, the one with the smallest id; documents without words or id stay."""
    dropped = near_duplicates(docs, like).filter("NOT kept").select("doc_id")
    return docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
