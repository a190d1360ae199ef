"""Prefix trie of conversations, screened by a count-min sketch.

Conversations are rebuilt on a shared beginning (see ``rebuild``) and every
prefix gets a 128-bit digest: a running exclusive-or of its turns' hashes,
each hashed with its place.  Most prefixes belong to one conversation only:

1. A count-min sketch counts all prefix digests.  It never counts too low, so
   an estimate of one proves a prefix to be a singleton.  Kept is one bit a
   cell: more than one, or not.
2. Singletons are emitted where they stand, without a shuffle: one member, at
   most one child, one leaf, nothing saved.
3. Possibly shared prefixes are shuffled and grouped exactly.

Sums over subtrees need no walk over levels: a node belongs to its smallest
member, who then also owns that node's continuation on its own path.  What a
conversation owns below a prefix is a suffix sum along the conversation, and a
subtree's sum is one aggregate of its members' suffix sums.

A conversation, a prefix or a turn may hold any share of the rows: numbers and
running values inside a conversation are found in two levels (``_running``),
groups are combining aggregates, and the digest of a node's ended members is
streamed over sorted chunks of ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm import common

#: Cells of each sketch row: four for every prefix, within these bounds; one bit a cell is broadcast, 8 MB a row at most.
MIN_CELLS, MAX_CELLS = 1 << 12, 1 << 26
ROWS = 2
#: Conversation c begins with up to crc32(c) % HEADS turns of conversation c - c % SHARED.
HEADS, SHARED = 4, 20
CHUNK = 1 << 16
_SEGMENT = 10
_NO_IDS = hashlib.sha256(b"").hexdigest()


def _running(df: DataFrame, key: list[str], at: str, part: str, into: dict[str, Column], last_first: bool = False) -> DataFrame:
    """Add running aggregates along ``at`` within ``key``, in two levels.

    ``part`` numbers bounded stretches of ``at`` within the key; no task sees
    more than a stretch's rows, or one row a stretch, together.
    """
    order = (lambda c: F.col(c).desc()) if last_first else F.col
    inner = Window.partitionBy(*key, part).orderBy(order(at)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outer = Window.partitionBy(*key).orderBy(order(part)).rowsBetween(Window.unboundedPreceding, -1)
    names = list(into)
    before = df.groupBy(*key, part).agg(*[f(c).alias(f"_{n}") for n, (f, c, _) in into.items()])
    before = before.select(*key, part, *[F.coalesce(into[n][0](f"_{n}").over(outer), F.lit(0).cast("long")).alias(f"_{n}") for n in names])
    local = df.select("*", *[f(c).over(inner).alias(f"__{n}") for n, (f, c, _) in into.items()])
    joined = local.join(before, [*key, part])
    return joined.select(*df.columns, *[into[n][2](F.col(f"__{n}"), F.col(f"_{n}")).alias(n) for n in names])


def _add(c: Column | str):
    return F.sum, c, lambda a, b: a + b


def _xor(c: Column | str):
    return F.bit_xor, c, lambda a, b: a.bitwiseXOR(b)


def _hash(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def rebuild(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(prefixes, conversations) of the rebuilt conversations.

    Conversation c becomes the first h turns of conversation c - c % 20 (all
    if it has fewer, none if it is absent) and then its own turns after its
    first h; h is crc32(decimal c) % 4.  Turns are ordered by turn (nulls
    first), ties by role and text; a null role or text is empty.  Rows without
    a conversation id belong to no conversation.

    prefixes: conv_id, depth, d1, d2 (digest), p1, p2 (parent's digest), words
    (of its last text), ended (the conversation has no more turns); one row
    for every conversation and depth from 1.  conversations: conv_id, length.
    """
    spark = df.sparkSession
    own = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    # The range is taken on short beginnings, which agree with the order; a sample of it goes to the driver.
    begins = [F.col("conv_id"), F.col("turn"), F.left("role", F.lit(64)), F.when(F.length("role") <= 64, F.left("text", F.lit(64))).otherwise("")]
    ordered = own.repartitionByRange(common.partitions(spark), *begins).sortWithinPartitions(*order)
    turns = common.stored(
        ordered.select("conv_id", F.monotonically_increasing_id().alias("place"), _hash(1, "role", "text").alias("x1"), _hash(2, "text", "role").alias("x2"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")), "turns"
    ).withColumn("part", F.shiftright("place", _SEGMENT))
    numbered = common.stored(_running(turns, ["conv_id"], "place", "part", {"pos": _add(F.lit(1))}).drop("place"), "numbered")
    lengths = numbered.groupBy("conv_id").agg(F.max("pos").alias("n"))
    heads = numbered.where(F.col("pos") < HEADS).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "x1", "x2", "words"))).alias("heads"))
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    based = lengths.withColumn("h", crc).withColumn("base", F.expr(f"conv_id - conv_id % {SHARED}"))
    based = based.join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
    head = F.coalesce(F.slice("heads", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<pos:bigint,x1:bigint,x2:bigint,words:bigint>>"))
    based = based.select("conv_id", "n", "h", head.alias("head")).withColumn("k", F.size("head").cast("long"))
    based = common.stored(based.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))), "based")
    copied = based.select("conv_id", "length", F.explode("head").alias("t")).select("conv_id", "length", F.col("t.pos").alias("depth"), "t.x1", "t.x2", "t.words", F.lit(-1).cast("long").alias("part"))
    kept = numbered.join(based.select("conv_id", "h", "k", "length"), "conv_id").where(F.col("pos") > F.col("h"))
    kept = kept.select("conv_id", "length", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "x1", "x2", "words", "part")
    terms = copied.unionAll(kept).select("conv_id", "length", "depth", "words", "part", _hash(3, "depth", "x1", "x2").alias("t1"), _hash(4, "x2", "depth", "x1").alias("t2"))
    digested = _running(terms, ["conv_id"], "depth", "part", {"d1": _xor("t1"), "d2": _xor("t2")})
    prefixes = digested.select("conv_id", "depth", "d1", "d2", F.col("d1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("t2")).alias("p2"), "words", (F.col("depth") == F.col("length")).alias("ended"))
    return common.stored(prefixes, "prefixes"), based.select("conv_id", "length")


def _cells(d1: Column, d2: Column, cells: int) -> list[Column]:
    """The digest's cell in each row of the sketch."""
    return [F.lit(r * cells) + _hash(10 + r, d1, d2).bitwiseAND(F.lit(cells - 1)) for r in range(ROWS)]


class Screen:
    """Which cells of a count-min sketch over all prefixes count more than one."""

    def __init__(self, prefixes: DataFrame, max_cells: int = MAX_CELLS) -> None:
        spark = prefixes.sparkSession
        n = prefixes.count()
        self.cells = MIN_CELLS
        while self.cells < min(max_cells, 4 * n):
            self.cells *= 2
        counted = prefixes.select(F.explode(F.array(*_cells(F.col("d1"), F.col("d2"), self.cells))).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        bit = F.expr("shiftleft(cast(1 as bigint), cast(cell & 63 as int))")
        words = counted.where("n > 1").groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
        table = np.zeros(ROWS * self.cells // 64, np.uint64)
        found = words.toArrow()
        table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        self.bits = spark.sparkContext.broadcast(table)

    def maybe_shared(self, df: DataFrame, digests: dict[str, tuple[str, str]]) -> DataFrame:
        """Add a boolean for each named digest: its estimate is above one."""
        shared, cells = self.bits, self.cells
        wide = df.select("*", *[c.alias(f"_{name}{r}") for name, (a, b) in digests.items() for r, c in enumerate(_cells(F.col(a), F.col(b), cells))])
        names = df.columns
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in df.schema)}, {', '.join(f'{n} boolean' for n in digests)}"

        def run(batches):
            for b in batches:
                out = [b.column(b.schema.get_field_index(n)) for n in names]
                for n in digests:
                    more = np.ones(b.num_rows, bool)
                    for r in range(ROWS):
                        cell = b.column(b.schema.get_field_index(f"_{n}{r}")).to_numpy().astype(np.uint64)
                        more &= (shared.value[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) == 1
                    out.append(pa.array(more))
                yield pa.RecordBatch.from_arrays(out, names=[*names, *digests])

        return wide.mapInArrow(run, schema)


def _flushed(rows, names: list[str], types: list[pa.DataType]):
    """Row tuples in batches of about ``CHUNK`` characters."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1]) + 24
        if size >= CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _id_chunks(batches):
    """Rows sorted by (d1, d2, conv_id) to chunks of one node's ids: d1, d2, first, ids."""

    def chunks():
        held, key, first, size = [], None, None, 0
        for columns in common.rows(batches):
            for d1, d2, conv in zip(*columns):
                if held and ((d1, d2) != key or size >= CHUNK):
                    yield *key, first, ",".join(held)
                    held, size = [], 0
                if not held:
                    key, first = (d1, d2), conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield *key, first, ",".join(held)

    return _flushed(chunks(), ["d1", "d2", "first", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.string()])


def _digest_chunks(batches):
    """Chunks sorted by (d1, d2, first) to one digest a node; a node's chunks pass one at a time."""

    def nodes():
        key = state = None
        for columns in common.rows(batches):
            for d1, d2, ids in zip(*columns):
                if (d1, d2) != key:
                    if state:
                        yield *key, state.hexdigest()
                    key, state = (d1, d2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if state:
            yield *key, state.hexdigest()

    return _flushed(nodes(), ["d1", "d2", "ends_sha256"], [pa.int64(), pa.int64(), pa.string()])


def _ends(members: DataFrame) -> DataFrame:
    """ends_sha256 of every (d1, d2) of ``members`` (d1, d2, conv_id)."""
    n = common.partitions(members.sparkSession)
    order = ["d1", "d2", "conv_id"]
    chunks = members.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*order).mapInArrow(_id_chunks, "d1 long, d2 long, first long, ids string")
    return chunks.repartition(n, "d1", "d2").sortWithinPartitions("d1", "d2", "first").select("d1", "d2", "ids").mapInArrow(_digest_chunks, "d1 long, d2 long, ends_sha256 string")


_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(df: DataFrame, max_cells: int = MAX_CELLS, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node of the rebuilt conversations' prefix trie, root (depth 0) included.

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs,
    n_children, n_leaves (childless nodes of the subtree), saved_tokens (over
    the subtree, members but one times the words of a node's last text),
    ends_sha256 (decimal ids of the members that end here).  No conversation,
    no node.  Repeated rows are turns of their own; rows with a null
    conversation id are in no conversation; extra columns are left behind.
    """
    prefixes, convs = rebuild(df, conv_col, turn_col, role_col, text_col)
    screen = Screen(prefixes, max_cells)
    seen = common.stored(screen.maybe_shared(prefixes, {"maybe": ("d1", "d2"), "parent_maybe": ("p1", "p2")}), "screened")
    single, maybe = seen.where("not maybe"), seen.where("maybe")
    low = convs.agg(F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n")).first()
    root_id = F.lit(low["low"]).cast("long")

    groups = common.stored(
        maybe.groupBy("d1", "d2").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.first("depth").alias("depth"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("words").alias("words"), F.min("ended").alias("leaf")), "groups"
    )
    # Children of possibly shared nodes: exact nodes, and singletons whose parent is no proven singleton.
    below = groups.where("depth > 1").select("p1", "p2").unionAll(single.where("depth > 1 and parent_maybe").select("p1", "p2"))
    children = below.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count(F.lit(1)).alias("n_children"))
    # Every member's share: what it owns of the subtree.
    member = maybe.select("conv_id", "depth", "d1", "d2").join(groups.select("d1", "d2", "owner", "n_convs", "words", "leaf"), ["d1", "d2"])
    owns = F.col("owner") == F.col("conv_id")
    member = member.select(
        "conv_id", "depth", "d1", "d2", F.shiftright("depth", _SEGMENT).alias("part"),
        F.when(owns, (F.col("n_convs") - 1) * F.col("words")).otherwise(0).alias("saves"), F.when(owns & F.col("leaf"), 1).otherwise(0).cast("long").alias("leaves"))
    # Singletons end in one leaf that no exact group has: it counts at the conversation's deepest possibly shared prefix.
    lone = single.where("ended").select("conv_id", F.lit(1).cast("long").alias("lone"))
    deepest = maybe.groupBy("conv_id").agg(F.max("depth").alias("depth")).join(lone, "conv_id")
    member = member.join(deepest, ["conv_id", "depth"], "left").withColumn("leaves", F.col("leaves") + F.coalesce("lone", F.lit(0))).drop("lone")
    shares = _running(member, ["conv_id"], "depth", "part", {"saved": _add("saves"), "under": _add("leaves")}, last_first=True)
    sums = shares.where("saved <> 0 or under <> 0").groupBy("d1", "d2").agg(F.sum("saved").alias("saved_tokens"), F.sum("under").alias("n_leaves"))
    ends = _ends(maybe.where("ended").select("d1", "d2", "conv_id").unionAll(convs.where("length = 0").select(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), "conv_id")))
    ends = common.stored(ends, "ends")

    zero = F.lit(0).cast("long")
    nodes = groups.join(children, ["d1", "d2"], "left").join(sums, ["d1", "d2"], "left").join(ends, ["d1", "d2"], "left")
    nodes = common.stored(nodes.select("d1", "d2", "p1", "p2", F.col("owner").alias("conv_id"), "depth", "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.coalesce("n_leaves", zero).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256"), "words"), "nodes")

    lonely = single.select(
        "p1", "p2", "conv_id", "depth", F.lit(1).cast("long").alias("n_convs"), F.when(F.col("ended"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("ended"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(_NO_IDS)).alias("ends_sha256"), "parent_maybe")
    tails = lonely.where("depth > 1 and not parent_maybe").withColumn("parent_conv_id", F.col("conv_id")).select(*_OUT)
    tops = lonely.where("depth = 1").drop("parent_maybe").unionByName(nodes.where("depth = 1").drop("d1", "d2", "words")).withColumn("parent_conv_id", root_id).select(*_OUT)
    hung = lonely.where("depth > 1 and parent_maybe").drop("parent_maybe").unionByName(nodes.where("depth > 1").drop("d1", "d2", "words"))
    parents = groups.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    # A node without an exact parent hangs on a proven singleton: its own conversation.
    inner = hung.join(parents, ["p1", "p2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv_id")).select(*_OUT)

    first = tops.select(F.lit(1).cast("long").alias("c"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("e"))
    first = first.unionAll(ends.where("d1 = 0 and d2 = 0").select(zero.alias("c"), zero, zero, "ends_sha256"))
    root = first.agg(F.coalesce(F.sum("c"), zero).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens"), F.coalesce(F.max("e"), F.lit(_NO_IDS)).alias("ends_sha256"))
    root = root.where(F.lit(low["n"] > 0)).select(
        root_id.alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(low["n"]).cast("long").alias("n_convs"), "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"), "saved_tokens", "ends_sha256")
    return root.select(*_OUT).unionAll(tops).unionAll(tails).unionAll(inner)
