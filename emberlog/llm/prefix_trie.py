"""A trie of conversations' common beginnings: nodes in preorder, subtrees as intervals, sums over them as differences of prefix sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.llm import common
from emberlog.llm.prefix import ranked

#: Conversations are rebuilt in groups of so many ids, with fewer than SHARED turns of the group's first one.
GROUP, SHARED = 100, 6
#: Turns of a conversation that are ranked as one, so that no row holds a whole long one.
SEGMENT = 64
#: Ids whose text stands in one row before it is hashed.
IDS = 4096


def turns_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, d, digest, chars): turns numbered from 1 by turn (null first, equal ones by their digest); null roles and texts are empty. Rows without conv_id belong to none."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # The role's length keeps role and text apart.
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = df.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("d"), "digest", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): every conversation c begins with the first crc32(c) % 6 turns of conversation c - c % 100 (rounded down for negative ids; fewer if that has fewer) and goes on with its own turns after as many.

    ids has a row per conversation, those left without a turn too.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    first = sizes.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("has"))
    ids = sizes.select("conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % SHARED).alias("h"))
    ids = common.checkpoint(ids.join(first, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("lent")))
    own = turns.join(ids, "conv_id").where("d > h").select("conv_id", (F.col("d") - F.col("h") + F.col("lent")).alias("d"), "digest", "chars")
    beginnings = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("d") < SHARED)).withColumnRenamed("conv_id", "base")
    lent = ids.join(beginnings, "base").where("d <= lent").select("conv_id", "d", "digest", "chars")
    return common.checkpoint(own.unionByName(lent)), ids.select("conv_id")


def sequences(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, r, len): r is the rank of the conversation's sequence of turns among all different ones, shorter before longer of one beginning.

    Runs of SEGMENT turns are ranked by their digests, then conversations by their runs' ranks, which gives the order of
    whole sequences.
    """
    runs = turns.groupBy("conv_id", F.floor((F.col("d") - 1) / SEGMENT).alias("run")).agg(F.expr("listagg(digest) WITHIN GROUP (ORDER BY d)").alias("run_key"), F.count("*").alias("n"))
    runs = common.checkpoint(runs)
    places = ranked(runs.select("run_key").distinct(), ["run_key"])
    keyed = runs.join(places.select("run_key", F.unhex(F.lpad(F.hex("pos"), 16, "0")).alias("place")), "run_key").groupBy("conv_id").agg(F.expr("listagg(place) WITHIN GROUP (ORDER BY run)").alias("key"), F.sum("n").alias("len"))
    keyed = common.checkpoint(ids.join(keyed, "conv_id", "left").select("conv_id", F.coalesce("key", F.unhex(F.lit(""))).alias("key"), F.coalesce("len", F.lit(0)).alias("len")))
    ranks = ranked(keyed.select("key").distinct(), ["key"], position="r")
    return common.checkpoint(keyed.join(ranks, "key").select("conv_id", "r", "len"))


def ends(convs: DataFrame) -> DataFrame:
    """(r, ends_sha256): SHA-256 of the ids of each sequence's conversations, ascending, comma-joined.

    Ids are joined up in ranges of (r, conv_id), IDS at a time, so a sequence with very many is dealt out; the hash,
    which has to take them one after the other, only sees the joined texts, and keeps its state alone.
    """

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        now, held = None, []
        out: tuple[list, list, list] = ([], [], [])

        def close() -> None:
            if held:
                for column, value in zip(out, (now, held[0], ",".join(map(str, held))), strict=True):
                    column.append(value)

        for batch in batches:
            for r, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if r != now or len(held) >= IDS:
                    close()
                    now, held = r, []
                held.append(c)
            if len(out[0]) >= common.BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["r", "at", "ids"])
                out = ([], [], [])
        close()
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["r", "at", "ids"])

    def digest(batches: Iterator) -> Iterator:
        import pyarrow as pa

        now, state = None, None
        for batch in batches:
            rs, hashes = [], []
            for r, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if r == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    rs.append(now)
                    hashes.append(state.hexdigest())
                now, state = r, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(rs, pa.int64()), pa.array(hashes, pa.string())], ["r", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["r", "ends_sha256"])

    joined = convs.select("r", "conv_id").repartitionByRange("r", "conv_id").sortWithinPartitions("r", "conv_id").mapInArrow(join, "r long, at long, ids string")
    return joined.repartition("r").sortWithinPartitions("r", "at").mapInArrow(digest, "r long, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A row per different beginning of conversations (turns: conv_id, d, digest, chars; ids: conv_id), the empty one too.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and first and
    last: the node's place in preorder and that of its subtree's end. A node is told by its depth and 128 bits of a running
    hash. In the order of sequences a node stands with the first sequence that has it, by depth: that is preorder, and its
    subtree ends with the last node of its last sequence. Sums over subtrees are differences of running sums at these
    two. Without conversations there are no rows.
    """
    common.prepare(turns.sparkSession)
    convs = sequences(turns, ids)
    along = W.partitionBy("conv_id").orderBy("d")
    mixed = {f"x{k}": F.xxhash64(F.lit(k), "d", "digest") for k in (1, 2)}
    rows = turns.withColumns(mixed).withColumns({f"p{k}": F.bit_xor(f"x{k}").over(along) for k in (1, 2)}).join(convs, "conv_id")
    zero = F.lit(0).cast("long")
    rows = rows.select("conv_id", "r", "len", "d", "chars", "p1", "p2", *[F.col(f"p{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"q{k}") for k in (1, 2)])
    root = convs.select("conv_id", "r", "len", zero.alias("d"), zero.alias("chars"), *[zero.alias(c) for c in ("p1", "p2", "q1", "q2")])
    nodes = rows.unionByName(root).groupBy("d", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min(F.struct("r", "len")).alias("one"), F.max("r").alias("r_last"), F.max("len").alias("deepest"), F.max("chars").alias("chars"), F.max("q1").alias("q1"), F.max("q2").alias("q2"),
    )
    leaf = (F.col("deepest") == F.col("d")).cast("long")
    nodes = nodes.select("d", "p1", "p2", "q1", "q2", "conv_id", "n_convs", F.col("one.r").alias("r"), "r_last", (F.col("one.len") == F.col("d")).alias("end"), leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    placed = common.checkpoint(ranked(nodes, ["r", "d"], ("leaf", "saved")))
    stops = placed.groupBy(F.col("r").alias("r_last")).agg(F.max("pos").alias("last"), F.max("sum_leaf").alias("to_leaf"), F.max("sum_saved").alias("to_saved"))
    above = placed.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    below = placed.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    out = placed.join(stops, "r_last").join(above, ["d", "q1", "q2"], "left").join(below, ["d", "p1", "p2"], "left")
    out = out.join(ends(convs).withColumn("end", F.lit(True)), ["r", "end"], "left")
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), (F.col("to_leaf") - F.col("sum_leaf") + F.col("leaf")).alias("n_leaves"),
        (F.col("to_saved") - F.col("sum_saved") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), F.col("pos").alias("first"), "last",
    )
