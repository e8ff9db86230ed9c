"""Prefix trie of conversations by a van Emde Boas recursion over the depths.

A band of depths is cut in half: the prefixes at the cut get names, the upper half is a trie of its own, and every
named prefix is the root of a trie in the lower half. The halves are cut in the same way, all bands of one
size at once, so a trie of depth D takes log D rounds. The name of a prefix at a cut is the hash of the name at the
band's top and of the turns between; the hashes of such runs are combined pairwise, two halves to a whole. After
naming, totals are grafted upward in the opposite order: when the two halves of a band are finished, the total of every
root at the cut is added to its ancestors in the upper half.

One row is one turn all the way: no conversation, node or subtree is collected. Turns are numbered by a range sort
that splits a long conversation, sums over hot nodes are combined before the shuffle, look-ups of hot keys are
broadcast behind a size check, and the ids that end in one node are put into text blocks before they are hashed in order.

Defined cases: rows without conv_id are ignored; a null role or text is empty; turns are ordered by number, null
first, and equal numbers by the SHA-256 of role and text, repeated rows counting as turns of their own; extra
columns are ignored; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.frames import small, written

SHARING = 20  # conversations that share the beginning of one
SHARED_TURNS = 4  # fewer than so many turns are shared
HOT = 1_000  # rows of a key beyond which it is looked up by a broadcast
BROADCAST_HOT = 64_000_000  # bytes of hot keys; more are joined by a shuffle
ID_BLOCK_BITS = 10  # ids in one text block

_NODE = ["depth", "name"]


def _hash(*parts: Column) -> Column:
    """128 bits of the parts, which are hashes of that size."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _root() -> Column:
    return F.substring(F.unhex(F.sha2(F.lit(b""), 256)), 1, 16)


def _looked_up(rows: DataFrame, table: DataFrame, on: list[str], load: str) -> DataFrame:
    """`rows` joined with `table`, which has one row per key and in `load` the number of rows with it."""
    heavy = written(table.where(F.col(load) > HOT), "hot-keys")
    if heavy.isEmpty():
        return rows.join(table.drop(load), on)
    heavy = small(heavy.drop(load), BROADCAST_HOT, F.lit(64))
    light = table.where(F.col(load) <= HOT).drop(load)
    rest = rows.join(heavy.select(*on), on, "left_anti").join(light, on)
    return rows.join(heavy, on).unionByName(rest)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_no, digest, words): the turns of each conversation from 0 on, however many it has."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _hash(name).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
    ordered = written(ordered.withColumn("part", F.shiftright("row", 33)).drop("turn"), "turns")
    runs = ordered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("conv_id", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), "n")
    found = _looked_up(ordered, starts, ["conv_id", "part"], "n")
    return found.select("conv_id", (F.col("row") + F.col("shift")).alias("turn_no"), "digest", "words")


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the one it shares its beginning with."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % SHARED_TURNS).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, place, digest, words), and conversations (conv_id, length).

    A conversation takes its first turns from the first one of its twenty, and goes on with its own turns after as many.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % SHARING).alias("base"), shared_turns(F.col("conv_id")).alias("h"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "n", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("m"))
    convs = written(convs.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    kept = turns.where(F.col("turn_no") >= shared_turns(F.col("conv_id")))
    kept = _looked_up(kept, convs.select("conv_id", (F.col("m") - F.col("h")).alias("shift"), "n"), ["conv_id"], "n")
    kept = kept.select("conv_id", (F.col("turn_no") + F.col("shift")).alias("place"), "digest", "words")
    first = turns.where((F.col("turn_no") < SHARED_TURNS - 1) & (F.col("conv_id") % SHARING == 0)).withColumnRenamed("conv_id", "base")
    taken = first.join(convs.select("conv_id", "base", "h"), "base").where("turn_no < h").select("conv_id", F.col("turn_no").alias("place"), "digest", "words")
    return written(kept.union(taken), "rebuilt"), convs.select("conv_id", "length")


def _runs(turns: DataFrame, rounds: int) -> list[DataFrame]:
    """For each round the hashes of whole runs of 2^round turns: (conv_id, k, run), run k starting at turn k * 2^round."""
    out = [turns.select("conv_id", F.col("place").alias("k"), F.col("digest").alias("run"))]
    for _ in range(1, rounds):
        half = out[-1].groupBy("conv_id", F.shiftright("k", 1).alias("pair")).agg(
            F.max(F.when(F.col("k") % 2 == 0, F.col("run"))).alias("a"), F.max(F.when(F.col("k") % 2 == 1, F.col("run"))).alias("b"))
        out.append(written(half.where("a is not null and b is not null").select("conv_id", F.col("pair").alias("k"), _hash(F.col("a"), F.col("b")).alias("run")), "runs"))
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _names(turns: DataFrame, convs: DataFrame, rounds: int) -> DataFrame:
    """(conv_id, depth, name) of every prefix of every conversation, the bands cut from the largest to the smallest."""
    named = [convs.select("conv_id", F.lit(0).cast("long").alias("depth"), _root().alias("name"))]
    runs = _runs(turns, rounds)
    for j in range(rounds - 1, -1, -1):
        upper = runs[j].where("k % 2 = 0").select("conv_id", F.shiftleft("k", j).alias("depth"), "run")
        cut = upper.join(_union(named), ["conv_id", "depth"])
        named.append(written(cut.select("conv_id", (F.col("depth") + (1 << j)).alias("depth"), _hash(F.col("name"), F.col("run")).alias("name")), "names"))
    return _union(named)


def _nodes(names: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: its smallest member, members, children, parent, and its own share of the totals."""
    nodes = written(names.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "nodes")
    above = nodes.where("depth > 0").select("conv_id", "depth", "name", "n_convs", (F.col("depth") - 1).alias("up"))
    parents = names.select("conv_id", F.col("depth").alias("up"), F.col("name").alias("parent"))
    last = turns.select("conv_id", F.col("place").alias("up"), "words")
    rows = written(above.join(parents, ["conv_id", "up"]).join(last, ["conv_id", "up"]), "edges")
    children = rows.groupBy(F.col("up").alias("depth"), F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    tops = written(nodes.join(children, _NODE), "parents")
    known = _looked_up(rows, tops.select(F.col("depth").alias("up"), F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"),
                       ["up", "parent"], "n_children").select(*_NODE, "parent_conv_id", "words")
    out = nodes.join(known, _NODE, "left").join(tops.select(*_NODE, "n_children"), _NODE, "left")
    out = out.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return written(out.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
                   .withColumn("saved", (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))).drop("words"), "nodes")


def _grafted(nodes: DataFrame, names: DataFrame, rounds: int) -> DataFrame:
    """(depth, name, leaves, saved) summed over subtrees, the bands put together from the smallest to the largest."""
    totals = nodes.select(*_NODE, "conv_id", "leaves", "saved")
    for j in range(rounds):
        roots = totals.where((F.shiftright("depth", j) % 2 == 1) & (F.col("depth") % (1 << j) == 0))
        roots = roots.select("conv_id", (F.shiftright("depth", j) - 1).alias("band"), "leaves", "saved")
        upper = names.select("conv_id", F.shiftright("depth", j).alias("band"), *_NODE)
        added = roots.join(upper, ["conv_id", "band"]).groupBy(*_NODE).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        totals = written(totals.join(added, _NODE, "left").select(
            *_NODE, "conv_id", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "totals")
    return totals.drop("conv_id")


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one node stand together and in order; only a running hash is held."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.binary()), pa.array([state.hexdigest()])],
                                          ["depth", "name", "ends_sha256"])

    for batch in batches:
        for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids"))):
            if (depth, name) == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                yield done()
            key, state = (depth, name), hashlib.sha256(ids.encode())
    if key is not None:
        yield done()


def _ends(names: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256) of the nodes in which conversations end."""
    last = names.join(convs.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    blocks = last.groupBy(*_NODE, F.shiftright("conv_id", ID_BLOCK_BITS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return blocks.repartition(*_NODE).sortWithinPartitions(*_NODE, "block").mapInArrow(_hash_lists, "depth long, name binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie over (conv_id, place, digest, words), places from 0 on without gaps, and (conv_id, length).

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    deepest = convs.agg(F.max("length")).first()[0] or 0
    rounds = int(deepest).bit_length()
    names = _names(turns, convs, rounds)
    nodes = _nodes(names, turns)
    totals = _grafted(nodes, names, rounds)
    ends = _ends(names, convs)
    out = nodes.drop("leaves", "saved").join(totals, _NODE).join(ends, _NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt(written(numbered_turns(conversations), "numbered")))
