"""The trie of conversation prefixes, by peeling turns off from the deepest level up.

Every distinct sequence of first turns is a node. A prefix is known by two sums
modulo 2**62 of hashes of (position, turn), which running sums give for all
prefixes at once, also where one conversation is most of the table. Then

1. one aggregate over all prefixes tells which nodes belong to one sequence of
   turns only (its copies included). Such a tail cannot meet another one, so it
   is stripped in one step: its nodes follow from running sums;
2. the levels that sequences share are peeled one by one, deepest first. At each
   depth the conversations that end there and the tails cut off there join the
   surviving nodes from below, are grouped by their prefix, and so become this
   depth's nodes with all that lies below them added up. The last turn is
   stripped and the parents are grouped at the next depth, up to the root.

The number of steps is the depth to which *different* sequences agree. Each step
is one aggregate, merged map-side, whose result is written; a hot first turn
sends one row per task to it. Conversations that end at a node are listed only as
a digest of their ids in ascending order: ids are sorted by a range shuffle, put
into pieces of ``PIECE_BYTES`` there, and a node's pieces are hashed as a stream.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: a NULL role or text is empty; a
row without a conversation id belongs to no conversation and is left out; turns
are ordered by number, NULL first, then role, then text; repeated rows are
repeated turns; an empty table has no nodes, not even a root; other columns are
ignored. Rows with the same id and number stay in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import map_batches, plain, written
from fundflow.llm.running import MODULUS, running
from fundflow.sources.workspace import new_folder

#: Bytes of ids in one piece of a node's list.
PIECE_BYTES = 1 << 20
_NOTHING = hashlib.sha256(b"").hexdigest()
_KEY = ["k1", "k2"]


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position, turn, words)``: a digest of each turn and its words, by position from 1."""
    names = ["conv_id", "turn", "role", "text"]
    ident, number, role, text = plain(conversations, names)
    rows = conversations.select(
        ident.cast("long").alias("conv_id"),
        number.alias("number"),
        F.coalesce(role.cast("string"), F.lit("")).alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.withColumn("digest", F.unhex(F.sha2(said, 256))).withColumn(
        "words", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    )
    order = ["number", "role", "text"]
    return running(rows, "conv_id", ["number"], order, [], ["digest", "words"], "position").select(
        "conv_id", "position", F.col("digest").alias("turn"), "words"
    )


def _prefixes(sequences: DataFrame) -> DataFrame:
    """Every turn with the key of the prefix it ends, that of the prefix before, and words so far."""
    hashed = sequences.select(
        "*",
        *[
            F.xxhash64(F.lit(k), "position", "turn").bitwiseAND(F.lit(MODULUS - 1)).alias(f"k{k}")
            for k in (1, 2)
        ],
    )
    own = hashed.select(
        "conv_id", "position", "words", *_KEY, *[F.col(k).alias(f"own_{k}") for k in _KEY],
        F.col("words").alias("upto"),
    )
    keep = ["position", "words", "own_k1", "own_k2"]
    sums = running(own, "conv_id", ["position"], ["position"], [*_KEY, "upto"], keep)
    before = [
        ((F.col(k) - F.col(f"own_{k}") + F.lit(MODULUS)) % F.lit(MODULUS)).alias(f"p{k[1]}")
        for k in _KEY
    ]
    return sums.select("conv_id", F.col("position").alias("depth"), "words", "upto", *_KEY, *before)


def _ends(prefixes: DataFrame, members: DataFrame) -> DataFrame:
    """Each conversation with its length, the key of all its turns, and all its words."""
    last = prefixes.join(
        members.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"]
    )
    none = members.filter("length = 0").select("conv_id", F.lit(0).cast("long").alias("length"))
    zero = F.lit(0).cast("long")
    return last.select(
        "conv_id",
        F.col("depth").alias("length"),
        F.col("k1").alias("f1"),
        F.col("k2").alias("f2"),
        F.col("upto").alias("total"),
    ).unionByName(none.select("*", zero.alias("f1"), zero.alias("f2"), zero.alias("total")))


def _discovered(prefixes: DataFrame, ends: DataFrame) -> DataFrame:
    """All nodes but the root; ``alone`` where all members are one sequence of turns."""
    whole = F.struct("length", "f1", "f2")
    return (
        prefixes.join(ends, "conv_id")
        .groupBy("depth", *_KEY)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            *[F.min(c).alias(c) for c in ("p1", "p2", "words", "upto", "total")],
            F.min(whole).alias("whole"),
            F.max(whole).alias("other"),
        )
        .withColumn("alone", F.col("whole") == F.col("other"))
        .drop("other")
    )


_RESULT = ["depth", *_KEY, "p1", "p2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def _tails(nodes: DataFrame) -> DataFrame:
    """Nodes of one sequence only, whose subtree is the rest of that sequence."""
    rest = F.col("total") - F.col("upto") + F.col("words")
    return nodes.filter("alone").select(
        *_RESULT[:7],
        (F.col("depth") < F.col("whole.length")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * rest).alias("saved_tokens"),
        "whole",
    )


def _arrivals(nodes: DataFrame, tails: DataFrame, ends: DataFrame) -> DataFrame:
    """What meets the survivors at each depth: tails cut off, conversations ended, links to parents."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    tops = tails.groupBy("whole").agg(
        F.min(F.struct("depth", "p1", "p2", "conv_id", "n_convs", "saved_tokens")).alias("top")
    )
    cut = tops.select(
        (F.col("top.depth") - 1).alias("depth"),
        F.col("top.p1").alias("k1"),
        F.col("top.p2").alias("k2"),
        "top.conv_id",
        "top.n_convs",
        F.lit(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        "top.saved_tokens",
        none.alias("p1"),
        none.alias("p2"),
        zero.alias("words"),
    )
    shared = nodes.filter("not alone")
    classes = ends.groupBy(
        F.col("length").alias("depth"), F.col("f1").alias("k1"), F.col("f2").alias("k2")
    ).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    at_shared = classes.join(shared.select("depth", *_KEY), ["depth", *_KEY], "left_semi")
    ended = at_shared.unionByName(classes.filter("depth = 0")).select(
        "depth", *_KEY, "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"),
        zero.alias("saved_tokens"), none.alias("p1"), none.alias("p2"), zero.alias("words"),
    )
    links = shared.select(
        "depth", *_KEY, none.alias("conv_id"), zero.alias("n_convs"), zero.alias("n_children"),
        zero.alias("n_leaves"), zero.alias("saved_tokens"), "p1", "p2", "words",
    )
    return cut.unionByName(ended).unionByName(links)


def _peeled(arrivals: DataFrame, deepest: int, path: str) -> DataFrame:
    """The shared nodes and the root, each level written once its children are complete."""
    spark = arrivals.sparkSession
    placed, levels = f"{path}/arrivals", f"{path}/levels"
    arrivals.hint("rebalance", "depth").write.partitionBy("depth").parquet(placed)
    # Columns in the order of the files, with depth last as the folders give it.
    fields = [f for f in arrivals.schema.fields if f.name != "depth"]
    schema = T.StructType([*fields, T.StructField("depth", T.LongType())])
    waiting = spark.read.schema(schema).parquet(placed)
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves")]
    own = (F.sum("n_convs") - 1) * F.max("words")
    survivors = None
    for depth in range(deepest, -1, -1):
        met = waiting.filter(F.col("depth") == depth).drop("depth")
        met = met if survivors is None else met.unionByName(survivors)
        level = met.groupBy(*_KEY).agg(
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
            F.min("conv_id").alias("conv_id"),
            *total,
            (F.sum("saved_tokens") + own).alias("saved_tokens"),
        )
        out = f"{levels}/depth={depth}"
        level.write.parquet(out)
        done = spark.read.schema(level.schema).parquet(out)
        none = F.lit(None).cast("long")
        # The last turn goes: a node is now a child of its parent.
        survivors = done.select(
            F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv_id", "n_convs",
            F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
            none.alias("p1"), none.alias("p2"), F.lit(0).cast("long").alias("words"),
        )
    found = T.StructType([*level.schema.fields, T.StructField("depth", T.LongType())])
    peeled = spark.read.schema(found).parquet(levels)
    # A root that nothing but turnless conversations reach is a leaf.
    leaf = F.greatest(F.col("n_leaves"), F.lit(1).cast("long"))
    return peeled.withColumn("n_leaves", leaf).select(*_RESULT)


def _digests(ends: DataFrame) -> DataFrame:
    """For each sequence the digest of the ids of its conversations, ascending, with commas."""
    key = ["length", "f1", "f2"]
    ids = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id")
    ids = ids.sortWithinPartitions(*key, "conv_id")
    schema = "length long, f1 long, f2 long, first long, ids binary"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, size = None, 0, [], 0
        out: list[tuple] = []
        for batch in batches:
            for *where, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (where != now or size >= PIECE_BYTES):
                    out.append((*now, first, ",".join(held).encode()))
                    held, size = [], 0
                if not held:
                    now, first = where, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield _rows(out, names)
            out = []
        if held:
            yield _rows([(*now, first, ",".join(held).encode())], names)

    names = pa.schema([(n, pa.int64()) for n in (*key, "first")] + [("ids", pa.binary())])
    cut = map_batches(ids, pieces, schema, rows=10_000)
    streams = cut.repartition("f1", "f2").sortWithinPartitions(*key, "first")
    hashed = pa.schema([(n, pa.int64()) for n in key] + [("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            out: list[tuple] = []
            for *where, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if where == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = where, hashlib.sha256()
                sha.update(text)
            yield _rows(out, hashed)
        if now is not None:
            yield _rows([(*now, sha.hexdigest())], hashed)

    # Few pieces at a time, as each may be of PIECE_BYTES.
    done = "length long, f1 long, f2 long, ends_sha256 string"
    return map_batches(streams, digest, done, rows=100)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def trie(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of all prefixes.

    ``sequences`` are the rows of ``turns``, positions from 1 without gaps;
    ``members`` is ``(conv_id, length)`` for every conversation, also those
    without turns. Returns, per node: ``depth``; ``conv_id``, its smallest member;
    ``parent_conv_id``, that of its parent; ``n_convs``, members; ``n_children``;
    ``n_leaves`` and ``saved_tokens`` of its subtree; ``ends_sha256``, the digest
    of the members that end there. ``(conv_id, depth)`` leads to a node's turns.
    """
    spark = sequences.sparkSession
    members = written(members.select("conv_id", "length"), "members")
    prefixes = _prefixes(sequences)
    prefixes = written(prefixes, "prefixes")
    ends = written(_ends(prefixes, members), "ends")
    nodes = written(_discovered(prefixes, ends), "nodes")
    tails = _tails(nodes)
    deepest = nodes.filter("not alone").agg(F.max("depth")).first()[0] or 0
    shared = _peeled(_arrivals(nodes, tails, ends), deepest, new_folder(spark, "trie"))
    found = tails.drop("whole").unionByName(shared)
    parents = found.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    digests = _digests(ends).select(
        F.col("length").alias("depth"), F.col("f1").alias("k1"), F.col("f2").alias("k2"), "ends_sha256"
    )
    return (
        found.join(parents, ["depth", "p1", "p2"], "left")
        .join(digests, ["depth", *_KEY], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table of conversations as they are."""
    ordered = written(turns(conversations), "turns")
    members = ordered.groupBy("conv_id").agg(F.max("position").alias("length"))
    return trie(ordered, members)

