"""Conversation prefix trie by fixed-length block hashing.

Conversations are rebuilt from shared heads (``rebuilt``) and cut into blocks of
``block`` turns.  A path is the XOR of a 128-bit digest of each (block number, block), so
the paths before all blocks of a conversation are prefix sums, taken in two levels.

1. Conversations are grouped by successive block digests: rows (path before, block).
2. A path whose members all go on with the same block has one node a turn there, with the
   members of the block; its turns are listed once.
3. Only where siblings diverge, that is where a path goes on with several blocks, the
   members' rows are refined to turns and grouped by the digest of the block's first
   turns.

Sums over a subtree need no walk.  Every node is counted for its smallest member; a member
is that from some depth on to its end.  With ``reach``, the bytes before that depth, the
tokens saved below a node are the sum over members of max(0, reach - bytes before the
node), and its leaves are the members that are the smallest of a leaf.

Turns are placed by ``with_ordinal`` (ranges over conversation and turn), blocks bound
what is gathered, and per-conversation values reach rows by a join that treats hot
conversations apart, so one conversation or one common head may hold any share of the
rows.  The ids that end at a node are joined in chunks of ``CHUNK`` ids and hashed as a
stream, as SHA-256 needs them in order.

Rows without ``conv_id`` belong to no conversation.  A null turn comes first; turns that
are equal are ordered by role and text; null role or text is ''.  Repeated rows are turns
of their own.  Other columns of the input are not read.  An empty table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import checkpoint, lookup
from corpusmill.operators.joins import MAX_BROADCAST_BYTES
from corpusmill.operators.ordinals import with_ordinal

#: Conversation ids whose ends are written into one chunk of text.
CHUNK = 4096
#: Blocks in one part of a conversation's prefix sums.
PART = 1024
FAMILY = 5


def _halves(text: Column) -> tuple[Column, Column]:
    """The MD5 of ``text`` as two signed 64-bit numbers."""
    digest = F.md5(text)
    return tuple(F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, own, n) per conversation: its original and rebuilt number of turns; and
    (c, d, turn, size) per rebuilt turn: its place from 1, digest and UTF-8 bytes.

    The first h turns of conversation c - c % 5 (all if it has fewer, none if it is
    absent), then c's own turns after its first h; h is crc32 of the decimal c, modulo 9."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    source = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("t"), role.alias("role"), text.alias("text"))
    order = [F.col("c"), F.col("t").asc_nulls_first(), F.col("role"), F.col("text")]
    turn = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    turns = with_ordinal(source, order, "at", ["c", turn.alias("turn"), F.octet_length("text").cast("long").alias("size")])
    starts = checkpoint(turns.groupBy("c").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("own")))
    h = F.pmod(F.crc32(F.encode(F.col("c").cast("string"), "UTF-8")), F.lit(9))
    convs = starts.withColumn("h", h).withColumn("base", F.expr(f"c - c % {FAMILY}"))
    bases = starts.select(F.col("c").alias("base"), F.col("own").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("there", F.lit(0))))
    convs = checkpoint(convs.withColumn("n", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    placed = lookup(turns, convs.select("c", F.col("own").alias("w"), "start", "h", "head"), "c", "w", small_bytes=MAX_BROADCAST_BYTES)
    placed = placed.withColumn("pos", F.col("at") - F.col("start"))
    tails = placed.where("pos >= h").select("c", (F.col("head") + F.col("pos") - F.col("h") + 1).alias("d"), "turn", "size")
    firsts = placed.where(f"c % {FAMILY} = 0 and pos < 8").select(F.col("c").alias("base"), "pos", "turn", "size")
    # a base has at most 8 such turns and serves at most 9 conversations
    heads = convs.select("c", "base", "h").join(firsts, "base").where("pos < h").select("c", (F.col("pos") + 1).alias("d"), "turn", "size")
    return convs.select("c", "own", "n"), heads.unionByName(tails)


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """(c, k, turns, hi, lo, before): a conversation's blocks with the path and the bytes
    before them; ``hi`` and ``lo`` are the path's halves."""
    rows = turns.groupBy("c", F.expr(f"(d - 1) div {block}").alias("k")).agg(F.array_sort(F.collect_list(F.struct("d", "turn", "size"))).alias("turns"))
    own_hi, own_lo = _halves(_block_text(F.size("turns")))
    size = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["size"])
    rows = checkpoint(rows.withColumn("part", F.expr(f"k div {PART}")).withColumns({"own_hi": own_hi, "own_lo": own_lo, "bytes": size}))

    def running(keys: list[str], order: str, cols: tuple[str, str, str]) -> list[Column]:
        over = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sums = (F.bit_xor(cols[0]).over(over), F.bit_xor(cols[1]).over(over), F.sum(cols[2]).over(over))
        return [F.coalesce(s, F.lit(0).cast("long")) for s in sums]

    parts = rows.groupBy("c", "part").agg(F.bit_xor("own_hi").alias("own_hi"), F.bit_xor("own_lo").alias("own_lo"), F.sum("bytes").alias("bytes"))
    base = parts.select("c", "part", *(x.alias(n) for x, n in zip(running(["c"], "part", ("own_hi", "own_lo", "bytes")), ("base_hi", "base_lo", "base_bytes"))))
    inner = rows.select("c", "part", "k", "turns", *(x.alias(n) for x, n in zip(running(["c", "part"], "k", ("own_hi", "own_lo", "bytes")), ("hi", "lo", "before"))))
    full = inner.join(base, ["c", "part"])
    return full.select(
        "c", "k", "turns", F.col("hi").bitwiseXOR(F.col("base_hi")).alias("hi"), F.col("lo").bitwiseXOR(F.col("base_lo")).alias("lo"), (F.col("before") + F.col("base_bytes")).alias("before")
    )


def _block_text(upto: Column) -> Column:
    """What a block's digest covers: its number and the digests of its first turns."""
    return F.concat(F.col("k").cast("string"), F.lit(":"), F.array_join(F.slice(F.transform("turns", lambda t: t["turn"]), F.lit(1), upto), ""))


def _per_turn(rows: DataFrame, block: int) -> DataFrame:
    """A row per turn of each block: depth, the paths to it and to its parent, the bytes
    before it and of it."""
    upto = F.explode(F.sequence(F.lit(1), F.size("turns"))).alias("j")
    rows = rows.select("*", upto)
    here, above = _halves(_block_text(F.col("j"))), _halves(_block_text(F.col("j") - 1))
    ups = [F.when(F.col("j") == 1, F.col(c)).otherwise(F.col(c).bitwiseXOR(a)) for c, a in zip(("hi", "lo"), above)]
    prior = F.aggregate(F.slice("turns", F.lit(1), F.col("j") - 1), F.lit(0).cast("long"), lambda a, t: a + t["size"])
    return rows.withColumns(
        {
            "depth": F.col("k") * block + F.col("j"),
            "up_hi": ups[0],
            "up_lo": ups[1],
            "inner": prior,
            "size": F.element_at(F.col("turns"), F.col("j"))["size"],
            "node_hi": F.col("hi").bitwiseXOR(here[0]),
            "node_lo": F.col("lo").bitwiseXOR(here[1]),
        }
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """(depth, node_hi, node_lo, ends_sha256) of rows (depth, node_hi, node_lo, c)."""
    node = ["depth", "node_hi", "node_lo"]
    chunks = ends.groupBy(*node, F.expr(f"c div {CHUNK}").alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))
    ordered = chunks.repartition(*node).sortWithinPartitions(*node, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            done = []
            for key, ids in zip(zip(*(b.column(c).to_pylist() for c in node)), b.column("ids")):
                if key == at:
                    state.update(b",")
                else:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                state.update(ids.as_buffer())
            yield _rows(done)
        if at is not None:
            yield _rows([(*at, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=[*node, "ends_sha256"])

    return ordered.mapInArrow(run, "depth long, node_hi long, node_lo long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = 4) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, from the root."""
    if block < 1:
        raise ValueError("block must be at least 1")
    convs, turns = rebuilt(conversations)
    rows = checkpoint(_blocks(turns, block))
    node, up = ["depth", "node_hi", "node_lo"], ["up_hi", "up_lo"]

    # 1. by successive block digests
    path = ["k", "hi", "lo"]
    own = _halves(_block_text(F.size("turns")))
    marked = rows.withColumns({"own_hi": own[0], "own_lo": own[1]})
    groups = marked.groupBy(*path, "own_hi", "own_lo").agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("low"))
    forks = checkpoint(groups.groupBy(*path).agg(F.count(F.lit(1)).alias("kids"), F.sum("n_convs").alias("n_convs"), F.min("low").alias("low")))
    # 2. one way on: the smallest member's turns stand for all
    straight = forks.where("kids = 1").select(*path, F.col("low").alias("c"), "n_convs")
    lone = _per_turn(rows.join(straight, [*path, "c"]), block).withColumn("low", F.col("c"))
    # 3. several: all members' turns
    split = forks.where("kids > 1").select(*path, F.col("n_convs").alias("w"), F.lit(True).alias("forked"))
    id_ = F.concat_ws(":", *path)
    fan = lookup(rows.withColumn("path", id_), split.select(id_.alias("path"), "w", "forked"), "path", "w", small_bytes=MAX_BROADCAST_BYTES).where("forked")
    fan = checkpoint(_per_turn(fan, block).select(*path, "c", *node, *up, "size", (F.col("before") + F.col("inner")).alias("before")))
    fanned = fan.groupBy(*node).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("low"), *(F.min(c).alias(c) for c in (*up, "size", "before"))
    )
    lone = lone.select(*node, "n_convs", "low", *up, "size", (F.col("before") + F.col("inner")).alias("before"), *path, "inner")
    nodes = checkpoint(lone.unionByName(fanned, allowMissingColumns=True))

    # the tree's links
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("node_hi"), F.col("up_lo").alias("node_lo")).agg(F.count(F.lit(1)).alias("n_children"))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("low")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.withColumns({c: zero for c in (*node, "size", "before")})
    tree = checkpoint(nodes.unionByName(root, allowMissingColumns=True).join(kids, node, "left").fillna(0, ["n_children"]))
    above = tree.where("n_children > 0").select(F.concat_ws(":", "depth", "node_hi", "node_lo").alias("up"), F.col("n_children").alias("w"), F.col("low").alias("parent_conv_id"))
    # per conversation: the bytes before the nodes whose smallest member it is; is one a leaf
    firsts = tree.groupBy(F.col("low").alias("c")).agg(F.min("before").alias("first"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    whole = rows.groupBy("c").agg(F.max(F.col("before") + F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["size"])).alias("whole"))
    reach = convs.join(whole, "c", "left").join(firsts, "c", "left")
    reach = checkpoint(reach.select("c", F.col("n").alias("w"), F.coalesce("first", "whole", zero).alias("reach"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")))

    def below(before: str) -> list[Column]:
        return [F.sum(F.greatest(F.col("reach") - F.col(before), zero)).alias("below"), F.sum("leaf").alias("n_leaves")]

    slim = lookup(rows.select(*path, "c", "before"), reach, "c", "w", small_bytes=MAX_BROADCAST_BYTES)
    by_path = slim.groupBy(*path).agg(*below("before"))
    by_turn = lookup(fan.select(*node, "c", "before"), reach, "c", "w", small_bytes=MAX_BROADCAST_BYTES).groupBy(*node).agg(*below("before"))
    at_root = reach.agg(F.sum("reach").alias("below"), F.sum("leaf").alias("n_leaves")).withColumns({c: zero for c in node})
    alone = tree.where("depth > 0 and k is not null").join(by_path, path)
    alone = alone.withColumn("below", F.col("below") - (F.col("n_convs") - 1) * F.col("inner"))
    forked = tree.where("depth > 0 and k is null").join(by_turn, node)
    top = tree.where("depth = 0").join(at_root, node)
    whole_tree = alone.unionByName(forked).unionByName(top).withColumn("up", F.concat_ws(":", F.col("depth") - 1, *up))
    whole_tree = lookup(whole_tree, above, "up", "w", small_bytes=MAX_BROADCAST_BYTES)

    # where conversations end
    last = convs.where("n > 0").select("c", F.expr(f"(n - 1) div {block}").alias("k"))
    tips = marked.join(last, ["c", "k"]).select(
        "c", (F.col("k") * block + F.size("turns")).alias("depth"), F.col("hi").bitwiseXOR(F.col("own_hi")).alias("node_hi"), F.col("lo").bitwiseXOR(F.col("own_lo")).alias("node_lo")
    )
    turnless = convs.where("n = 0").select("c", *(zero.alias(c) for c in node))
    ends = _end_digests(tips.unionByName(turnless))
    out = whole_tree.join(ends, node, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    return out.select(
        F.col("low").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("below").alias("saved_tokens"), "ends_sha256"
    )


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
