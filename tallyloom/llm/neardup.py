"""Near-duplicate documents: b-bit MinHash signatures, a multi-index Hamming join, exact confirmation.

A document's set is its distinct shingles of five words (all its words, if fewer).
Equal sets are one class from the start. A class has a signature of 126 slots of
8 bits, laid out as 18 chunks of 7 slots. Two signatures that differ in at most
35 slots have, by the pigeonhole principle, a chunk with at most one differing
slot. Every chunk is therefore listed 7 times, each time with one slot left out:
chunks with at most one error meet under such a key, so the join misses no pair
within the distance. At a similarity of 0.85 the distance has mean 19 and
standard deviation 4, so that 35 is four deviations away.

No table of pairs is written. Classes that share a key are first compared with one
member of it, its hub; what is linked gets one label. Then the members of a key that have different labels are
compared by signature inside a task, which only writes a spanning forest of the pairs within the distance. The components of these
forests hold all candidate pairs; each component meets once more, with the full sets, in a task or in pairs of blocks,
where every candidate pair with different labels is confirmed exactly, and again only a forest of the links is
written. So every link between two components is found, and what is written grows with the members.

Defined cases: a null or wordless text has the empty set and is linked with
nothing; a row without doc_id is linked with nothing, is kept and has no
component; rows that repeat a doc_id each get a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.components import components
from tallyloom.llm.frames import byte_blocks, small, written
from tallyloom.llm.shingles import BLOCK_BYTES, mixed, shingles_of

SIMILAR_PERCENT = 85
CHUNKS = 18
CHUNK_SLOTS = 7
SLOTS = CHUNKS * CHUNK_SLOTS
MAX_DISTANCE = 35  # 2 * CHUNKS - 1: some chunk then has at most one error
BLOCK = 4_000  # members of a key or component that meet in one task: two blocks
BLOCK_SHINGLES = 4_000_000  # of a component's sets in one block
BROADCAST_IDS = 16_000_000  # bytes of ids; more are joined by a shuffle

_U = np.uint64
_SEED = mixed(np.arange(1000, 1000 + 2 * SLOTS, dtype=np.uint64))
_TIMES = (_SEED[:SLOTS] >> _U(32)).astype(np.uint32) | np.uint32(1)
_PLUS = (_SEED[SLOTS:] >> _U(32)).astype(np.uint32)
# The bits of seven bytes, for counting bytes that are not zero.
_LOW7 = _U(0x007F7F7F7F7F7F7F)
_HIGH7 = _U(0x0080808080808080)

SIGNED = "doc_id long, n_shingles long, hi long, lo long, signature array<long>"


def _signatures(rows: np.ndarray, shingles: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Per row: size, two 64-bit sums that name the set, and the chunks as integers of 56 bits."""
    sizes = np.bincount(rows, minlength=n)
    some = np.flatnonzero(sizes)
    hi, lo, chunks = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros((n, CHUNKS), np.uint64)
    if len(some):
        firsts = (np.cumsum(sizes) - sizes)[some]
        hi[some] = np.add.reduceat(shingles, firsts)
        lo[some] = np.add.reduceat(mixed(shingles ^ _U(0xA5A5A5A5A5A5A5A5)), firsts)
        half = (shingles >> _U(32)).astype(np.uint32)
        for k in range(SLOTS):
            low = np.minimum.reduceat(half * _TIMES[k] + _PLUS[k], firsts)
            byte = (low * np.uint32(0x9E3779B1)) >> np.uint32(24)
            chunks[some, k // CHUNK_SLOTS] |= byte.astype(np.uint64) << _U(8 * (k % CHUNK_SLOTS))
    return sizes, hi, lo, chunks


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, raw, bounds in byte_blocks(batch.column(1), BLOCK_BYTES):
            n = len(bounds) - 1
            sizes, hi, lo, chunks = _signatures(*shingles_of(raw, bounds), n)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * CHUNKS),
                                             pa.array(chunks.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, n), pa.array(sizes), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), lists],
                ["doc_id", "n_shingles", "hi", "lo", "signature"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, signature) of each row."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sign, SIGNED)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, raw, bounds in byte_blocks(batch.column(1), BLOCK_BYTES):
            n = len(bounds) - 1
            rows, shingles = shingles_of(raw, bounds)
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, n), pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles.view(np.int64)))],
                ["doc_id", "shingles"])


def _deletion_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk with each slot left out: 7 bits of place above 48 bits of slots."""
    for batch in batches:
        reps = batch.column(0).to_numpy()
        chunks = batch.column(1).flatten().to_numpy().view(np.uint64).reshape(-1, CHUNKS)
        for start in range(0, len(reps), 2048):
            part = chunks[start:start + 2048]
            keys = np.empty((len(part), CHUNKS, CHUNK_SLOTS), np.uint64)
            for slot in range(CHUNK_SLOTS):
                below = part & _U((1 << 8 * slot) - 1)
                above = (part >> _U(8 * slot + 8)) << _U(8 * slot)
                place = np.arange(CHUNKS, dtype=np.uint64) * _U(CHUNK_SLOTS) + _U(slot)
                keys[:, :, slot] = below | above | (place << _U(48))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)),
                 pa.array(np.repeat(reps[start:start + 2048], SLOTS))], ["key", "rep"])


def _errors(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing slots, chunk by chunk."""
    d = x ^ y
    return np.bitwise_count((((d & _LOW7) + _LOW7) | d) & _HIGH7)


def _merged(comp: np.ndarray, rep: np.ndarray, k: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins the parts of `others` with that of k; one edge for each part that is new to k's."""
    parts, first = np.unique(comp[others], return_index=True)
    first = others[first[parts != comp[k]]]
    comp[np.isin(comp, parts)] = comp[k]
    return np.minimum(rep[first], rep[k]), np.maximum(rep[first], rep[k])


def _fits(group: dict[str, np.ndarray], comp: np.ndarray, k: int) -> np.ndarray:
    """Rows that k is to be compared with: of another label and part, of fitting size, each pair from one side only."""
    minor, label, n = group["minor"], group["label"], group["n"]
    ok = (comp != comp[k]) & (label != label[k])
    ok &= ~minor | (np.arange(len(n)) > k)
    ok &= 100 * np.minimum(n, n[k]) >= SIMILAR_PERCENT * np.maximum(n, n[k])
    if group["i"][0] != group["j"][0]:
        ok &= group["block"] != group["block"][k]
    return np.flatnonzero(ok)


def _candidate_forest(group: dict[str, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(a, b) edges that connect the pairs within the distance among the rows of one key, or of two blocks of it."""
    rep, sig, comp = group["rep"], group["signature"], np.arange(len(group["rep"]))
    place = (int(group["key"][0]) >> 48) & 0x7F
    chunk, slot = place // CHUNK_SLOTS, place % CHUNK_SLOTS
    found = []
    for k in np.flatnonzero(group["minor"]):
        others = _fits(group, comp, k)
        if not len(others):
            continue
        errors = _errors(sig[others], sig[k])
        near = errors.sum(axis=1) <= MAX_DISTANCE
        errors, others = errors[near], others[near]
        # of the keys that the two share, this one counts: the first fitting chunk, its first slot left out
        first = (errors <= 1).argmax(axis=1) == chunk
        first &= (errors[:, chunk] == 1) | (slot == 0)
        found.append(_merged(comp, rep, k, others[first]))
    return found


def _link_forest(group: dict[str, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(a, b) edges that connect the linked rows of one component, or of two blocks of it: full sets decide."""
    rep, n, sig = group["rep"], group["n"], group["signature"]
    comp = np.unique(group["label"], return_inverse=True)[1]
    sizes = np.array([len(x) for x in group["shingles"]])
    starts = np.cumsum(sizes) - sizes
    codes = np.unique(np.concatenate(list(group["shingles"])), return_inverse=True)[1]
    mark = np.zeros(len(codes), bool)
    found = []
    for k in np.flatnonzero(group["minor"]):
        others = _fits(group, comp, k)
        if len(others):
            others = others[_errors(sig[others], sig[k]).sum(axis=1) <= MAX_DISTANCE]
        if not len(others):
            continue
        own = codes[starts[k]:starts[k] + sizes[k]]
        mark[own] = True
        if 2 * sizes[others].sum() > len(codes):
            common = np.add.reduceat(mark[codes], starts, dtype=np.int64)[others]
        else:
            common = np.array([np.count_nonzero(mark[codes[starts[o]:starts[o] + sizes[o]]]) for o in others])
        mark[own] = False
        linked = others[100 * common >= SIMILAR_PERCENT * (n[k] + n[others] - common)]
        if len(linked):
            found.append(_merged(comp, rep, k, linked))
    return found


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c not in ("signature", "shingles")}
    rows["signature"] = batch.column("signature").flatten().to_numpy().view(np.uint64).reshape(-1, CHUNKS)
    if "shingles" in batch.schema.names:
        lists = batch.column("shingles")
        flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        rows["shingles"] = np.empty(len(lists), object)
        for row, (start, end) in enumerate(zip(ends[:-1] - ends[0], ends[1:] - ends[0])):
            rows["shingles"][row] = flat[start:end]
    return rows


def _forests(forest: Callable[[dict[str, np.ndarray]], list], by: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The forest of each group; groups (`by`, i, j) stand together and fit in memory, as large ones come in blocks."""
    def edges(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        found = forest({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})
        if found:
            a, b = (np.concatenate(side).astype(np.int64) for side in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            if not len(batch):
                continue
            rows = _columns(batch)
            name = [rows[c] for c in (by, "i", "j")]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in name], axis=0)) + 1
            for start, end in zip(np.r_[0, new], np.r_[new, len(batch)]):
                if held and any(held[0][c][0] != rows[c][start] for c in (by, "i", "j")):
                    yield from edges(held)
                    held = []
                held.append({c: v[start:end] for c, v in rows.items()})
        if held:
            yield from edges(held)

    return run


class _Exact:
    """The full sets of named documents, and the exact comparison of pairs."""

    def __init__(self, docs: DataFrame):
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sets(self, ids: DataFrame) -> DataFrame:
        """(doc_id, shingles) of the documents named by the distinct ids of a written table."""
        ids = small(ids.select("doc_id"), BROADCAST_IDS, F.lit(8))
        return written(self.texts.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, shingles array<long>"), "sets")

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) of doc_ids whose full sets reach the similarity."""
        ids = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "doc_id")
        sets = self.sets(written(ids, "wanted"))
        both = (pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
                .select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"),
                        (F.size("sa").cast("long") + F.size("sb")).alias("total")))
        return both.where(100 * F.col("common") >= SIMILAR_PERCENT * (F.col("total") - F.col("common"))).select("a", "b").distinct()


def _labelled(rows: DataFrame, labels: DataFrame, col: str, label: str) -> DataFrame:
    """`label`: the root of `col`, or `col` itself while it is linked with nothing."""
    roots = labels.select(F.col("node").alias(col), F.col("root").alias(label))
    return rows.join(roots, col, "left").withColumn(label, F.coalesce(label, col))


def _members(classes: DataFrame) -> DataFrame:
    """(key, rep, hub) for every key under which at least two classes stand."""
    keys = classes.select("rep", "signature").mapInArrow(_deletion_keys, "key long, rep long")
    shared = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub < top")
    return written(keys.join(shared.select("key", "hub"), "key"), "members")


def _nearest_hubs(members: DataFrame) -> DataFrame:
    """One pair per class: the hub with which it shares most keys."""
    counts = members.where("rep <> hub").groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("keys"))
    best = counts.groupBy("rep").agg(F.max_by("hub", F.struct("keys", -F.col("hub"))).alias("hub"))
    return best.select(F.col("hub").alias("a"), F.col("rep").alias("b"))


def _dealt(rows: DataFrame, by: str) -> DataFrame:
    """Rows as pairs of blocks (i, j) of their group, those outside its most frequent label marked as minor.

    `rows` has columns `by`, rep, label, n, signature. Groups with one label are left out.
    """
    counts = rows.groupBy(by, "label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    mixed_groups = (counts.groupBy(by).agg(
        F.max_by("label", F.struct("rows", "label")).alias("major"), F.count(F.lit(1)).alias("labels"),
        F.greatest(F.ceil(F.sum("rows") / BLOCK), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")).where("labels > 1"))
    rows = rows.join(mixed_groups.select(by, "major", "blocks"), by).withColumn("block", F.expr("int(pmod(xxhash64(rep), blocks))"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner"))
    rest = [c for c in rows.columns if c not in (by, "label", "major", "blocks", "partner")]
    return rows.select(by, F.least("block", "partner").alias("i"), F.greatest("block", "partner").alias("j"), "label",
                       (F.col("label") != F.col("major")).alias("minor"), *rest)


def _forest_of(dealt: DataFrame, by: str, forest: Callable[[dict[str, np.ndarray]], list]) -> DataFrame:
    return dealt.repartition(by, "i", "j").sortWithinPartitions(by, "i", "j").mapInArrow(_forests(forest, by), "a long, b long")


def _labels_of_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, root) of all classes that are linked with another."""
    exact = _Exact(docs)
    members = _members(classes)
    links = written(exact.similar(_nearest_hubs(members)), "links")
    labels = written(components(links), "labels")
    described = classes.select("rep", "n", "signature")
    named = written(_labelled(members.select("key", "rep"), labels, "rep", "label"), "labelled")
    mixed_keys = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    candidates = written(_forest_of(_dealt(named.join(mixed_keys, "key").join(described, "rep"), "key"), "key", _candidate_forest), "candidates")
    if candidates.isEmpty():
        return labels
    blobs = written(components(candidates).select(F.col("node").alias("rep"), F.col("root").alias("blob")), "blobs")
    sets = exact.sets(blobs.select(F.col("rep").alias("doc_id"))).withColumnRenamed("doc_id", "rep")
    rows = _dealt(_labelled(blobs, labels, "rep", "label").join(described, "rep"), "blob").join(sets, "rep")
    found = written(links.union(_forest_of(rows, "blob", _link_forest)), "links")
    return written(components(found), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept."""
    signed = written(signatures(docs), "signed")
    classes = written(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("hi", "lo", "n_shingles", "signature")
        .agg(F.min("doc_id").alias("rep")).select("rep", "hi", "lo", F.col("n_shingles").alias("n"), "signature"), "classes")
    labels = _labels_of_classes(docs, classes)
    named = _labelled(classes.select("rep", "hi", "lo"), labels, "rep", "label").select("hi", "lo", "label")
    out = signed.select("doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of the kept documents, one for each doc_id and text; rows without doc_id stay."""
    kept = written(near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    named = docs.join(kept, docs["doc_id"].cast("long") == kept["doc_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return named.union(docs.where("doc_id is null"))
