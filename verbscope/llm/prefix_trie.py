"""Prefix trie of conversations, built as a z-fast trie of tables.

A conversation is a sequence of turns; a node of the trie is a distinct prefix, told by its depth
and a 128-bit fingerprint: the exclusive-or of its turns' fingerprints, each keyed by its place.
So prefixes are had by partial aggregates, and long conversations in blocks of ``BLOCK`` turns.

What is stored is the compacted trie: one row per node where conversations branch or end (and at
every full block), with its parent and the edge between as a label of at most ``BLOCK`` prefixes. A node is
found by its handle: its prefix at the two-fattest depth of its edge, the one divisible by the
highest power of two. Insertion goes in batches:

1. locate: each waiting conversation finds its deepest node by fat binary search: one equi-join of
   its prefix at the two-fattest depth of what is left of its range with the handles per step,
   and log2(BLOCK) steps at most; then the edge it goes on along, and where it leaves it (its exit).
2. insert: conversations that leave at different places, or by different turns, don't meet, so
   one of each (exit, next turn), chosen by hash, forms the batch. Edges are split at exits.
3. those left wait for the next batch. They share at least one turn more with the trie then.

Counts of subtrees are summed on the compacted trie by doubling the reach of parent links, and
edges are expanded to nodes at the end. Nothing but row counts reaches the driver.

Defined results: turns go by ``turn`` (null first), then role and text; null role or text is
empty; rows with a null conversation id form a conversation whose id is null; repeated rows are turns
of their own; ``conversations`` may name further ones without turns, which end at the root; other
columns aren't read; without any conversation there is no node, the root neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbscope.llm.common import join_same, quoted, staged
from verbscope.llm.turn_order import with_position

BLOCK = 256
ROOT_P = bytearray(16)  # prefix of no turns


def turn_rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """Narrow rows: conv, at (0, 1, ... in the conversation), digest of role and text, chars (code
    points of the text)."""
    role, text = (F.coalesce(quoted(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.select(quoted(conv_col).alias("conv"), quoted(turn_col).alias("turn"), role.alias("role"),
                        digest.alias("digest"), F.char_length(text).cast("long").alias("chars"))
    return with_position(rows, "conv", ["turn", "role", "digest"]).select("conv", "at", "digest", "chars")


def _bytes(a: str, b: str) -> Column:
    """Two 64-bit numbers as 16 bytes."""
    return F.unhex(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def path_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation and block of turns: conv, base (turns before it), base_p (their
    prefix), base_cum (their characters), path: an array of (p, cum) of the prefixes that end in the block."""
    marked = rows.select(
        "conv", "at", "chars", F.floor(F.col("at") / block).cast("long").alias("block"),
        F.xxhash64(F.lit(1), "at", "digest").alias("a"), F.xxhash64(F.lit(2), "digest", "at").alias("b"))
    sums = [F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.sum("chars").alias("xc")]
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = marked.groupBy("conv", "block").agg(*sums)
    bases = bases.select("conv", "block", *[F.coalesce(f(c).over(earlier), F.lit(0).cast("long")).alias(c)
                                            for f, c in ((F.bit_xor, "xa"), (F.bit_xor, "xb"), (F.sum, "xc"))])
    inside = Window.partitionBy("conv", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = marked.select("conv", "block", "at", F.bit_xor("a").over(inside).alias("a"), F.bit_xor("b").over(inside).alias("b"),
                            F.sum("chars").over(inside).alias("c"))
    joined = join_same(running, bases, ["conv", "block"]).select(
        "conv", "block", "at", "xa", "xb", "xc", F.col("a").bitwiseXOR(F.col("xa")).alias("a"),
        F.col("b").bitwiseXOR(F.col("xb")).alias("b"), (F.col("c") + F.col("xc")).alias("cum"))
    whole = joined.groupBy("conv", "block", "xa", "xb", "xc").agg(F.sort_array(F.collect_list(
        F.struct("at", _bytes("a", "b").alias("p"), "cum"))).alias("path"))
    return whole.select("conv", (F.col("block") * block).alias("base"), _bytes("xa", "xb").alias("base_p"),
                        F.col("xc").alias("base_cum"), F.transform("path", lambda x: F.struct(x["p"].alias("p"), x["cum"].alias("cum"))).alias("path"))


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    width = (F.length(F.bin(low.bitwiseXOR(high))) - 1).cast("int")
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), width))


def _at(path: str, depth: Column) -> Column:
    """Prefix of a key or edge at a depth, by its base."""
    return F.get(F.col(path), (depth - F.col("base") - 1).cast("int"))["p"]


def _with_handle(nodes: DataFrame) -> DataFrame:
    """Nodes: depth, p, up (parent's depth), up_p, up_cum, label (prefixes up+1 .. depth); adds the handle
    and the edge's first prefix."""
    depth = two_fattest(F.col("up"), F.col("depth"))
    return nodes.withColumn("handle_depth", depth).withColumn(
        "handle", F.get("label", (depth - F.col("up") - 1).cast("int"))["p"]).withColumn("first_p", F.get("label", F.lit(0))["p"])


def locate(keys: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """Deepest node of each key on its path: ``low`` by fat binary search from the ``low`` known so far."""
    table = nodes.select("handle_depth", "handle", F.col("depth").alias("node_depth"), F.col("p").alias("node_p"))
    found = keys.withColumn("high", F.col("stop"))
    for _ in range(steps):
        probe = F.when(F.col("low") < F.col("high"), two_fattest(F.col("low"), F.col("high")))
        found = found.withColumn("probe", probe).withColumn("probe_p", _at("path", F.col("probe")))
        joined = found.join(table, (F.col("probe") == F.col("handle_depth")) & (F.col("probe_p") == F.col("handle")), "left")
        whole = F.coalesce((F.col("node_depth") <= F.col("stop")) & (_at("path", F.col("node_depth")) == F.col("node_p")), F.lit(False))
        low = F.when(whole, F.greatest("low", "node_depth")).otherwise(F.col("low"))
        high = F.when(F.col("probe").isNull() | whole, F.greatest("high", low)).otherwise(F.col("probe") - 1)
        found = joined.select(*keys.drop("low").columns, low.alias("low"), high.alias("high"))
    return found.drop("high")


def exits(keys: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """Where each key leaves the trie: ``exit`` (depth), ``exit_p``, and the node whose edge is to
    be split there (edge_p; null if the exit is a node)."""
    placed = locate(keys, nodes, steps).withColumn("next_p", _at("path", F.col("low") + 1))
    edges = nodes.select(F.col("first_p").alias("edge_first"), F.col("up").alias("edge_up"), F.col("p").alias("edge_p"),
                         "label")
    joined = placed.join(edges, (F.col("next_p") == F.col("edge_first")) & (F.col("low") == F.col("edge_up")), "left")
    rest = F.slice("path", (F.col("low") - F.col("base") + 1).cast("int"), F.greatest(F.size("label"), F.lit(1)))
    shared = F.size(F.filter(F.arrays_zip(rest.alias("x"), F.col("label").alias("y")), lambda z: z["x"]["p"] == z["y"]["p"]))
    exit_ = F.col("low") + F.when(F.col("edge_p").isNull(), 0).otherwise(shared)
    return joined.withColumn("exit", exit_.cast("long")).withColumn(
        "exit_p", F.when(F.col("exit") == F.col("base"), F.col("base_p")).otherwise(_at("path", F.col("exit")))).drop(
        "edge_first", "edge_up", "label", "next_p").withColumn("next_p", _at("path", F.col("exit") + 1))


def split(nodes: DataFrame, cuts: DataFrame) -> DataFrame:
    """Nodes with their edges cut at the depths of ``cuts`` (edge_p, exit)."""
    at = cuts.groupBy("edge_p").agg(F.sort_array(F.collect_set("exit")).alias("cuts"))  # at most BLOCK depths
    joined = nodes.join(at, F.col("p") == F.col("edge_p"), "left")
    stops = F.concat(F.coalesce("cuts", F.array().cast("array<bigint>")), F.array("depth"))
    starts = F.concat(F.array("up"), F.coalesce("cuts", F.array().cast("array<bigint>")))
    pieces = joined.select("up", "up_p", "up_cum", "label", F.explode(F.arrays_zip(starts.alias("from"), stops.alias("to"))).alias("z"))
    last = lambda d: F.get("label", (d - F.col("up") - 1).cast("int"))
    low, high = F.col("z.from"), F.col("z.to")
    cut = pieces.select(
        high.alias("depth"), last(high)["p"].alias("p"), low.alias("new_up"),
        F.when(low == F.col("up"), F.col("up_p")).otherwise(last(low)["p"]).alias("new_up_p"),
        F.when(low == F.col("up"), F.col("up_cum")).otherwise(last(low)["cum"]).alias("new_up_cum"),
        F.slice("label", (low - F.col("up") + 1).cast("int"), (high - low).cast("int")).alias("label"))
    return _with_handle(cut.withColumnsRenamed({"new_up": "up", "new_up_p": "up_p", "new_up_cum": "up_cum"}))


def new_leaves(batch: DataFrame) -> DataFrame:
    up = (F.col("exit") - F.col("base")).cast("int")
    at_exit = F.when(up == 0, F.col("base_cum")).otherwise(F.get("path", up - 1)["cum"])
    return _with_handle(batch.select(
        F.col("stop").alias("depth"), F.col("stop_p").alias("p"), F.col("exit").alias("up"), F.col("exit_p").alias("up_p"),
        at_exit.alias("up_cum"), F.slice("path", up + 1, F.size("path")).alias("label")))


def build(blocks: DataFrame) -> DataFrame:
    """The compacted trie of ``path_blocks``: depth, p, up, up_p, up_cum, label, handle_depth, handle,
    first_p. The root has no row."""
    keys = blocks.select("base", "base_p", "base_cum", "path", (F.col("base") + F.size("path")).alias("stop"),
                         F.element_at("path", -1)["p"].alias("stop_p"))
    keys = staged(keys.dropDuplicates(["stop", "stop_p"]).withColumn("low", F.col("base")), "keys")
    steps = int(keys.agg(F.max(F.size("path"))).first()[0] or 0).bit_length()
    nodes = None
    while True:
        if nodes is None:  # nothing is there yet: every key leaves at its base
            left = keys.select(*keys.columns, F.lit(None).cast("binary").alias("edge_p"), F.col("base").alias("exit"),
                               F.col("base_p").alias("exit_p"), _at("path", F.col("base") + 1).alias("next_p"))
        else:
            left = staged(exits(keys, nodes, steps), "exits")
        chosen = left.where("exit < stop").groupBy("next_p").agg(F.min("stop_p").alias("chosen"))
        batch = left.join(chosen.select("chosen"), F.col("stop_p") == F.col("chosen"), "left_semi").where("exit < stop")
        leaves = new_leaves(batch)
        cuts = left.where("edge_p is not null").select("edge_p", "exit")
        nodes = staged(leaves if nodes is None else split(nodes, cuts).unionByName(leaves), "nodes")
        waiting = left.where("exit < stop").join(chosen.select("chosen"), F.col("stop_p") == F.col("chosen"), "left_anti")
        keys = staged(waiting.select(*[F.col("exit").alias("low") if c == "low" else c for c in keys.columns]), "waiting")
        if keys.isEmpty():
            return nodes


def subtree_sums(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Adds to each node: n (conversations below or at it), least (their smallest id), leaves, cums (the
    characters of their whole prefixes), chars (characters of the distinct texts below, own edge
    included), children. ``ends``: p, m (conversations that end there), least."""
    kids = nodes.groupBy(F.col("up_p").alias("kid_p")).agg(F.count("*").alias("children"))
    cum = F.element_at("label", -1)["cum"]
    state = (nodes.join(ends, "p", "left").join(kids, F.col("p") == F.col("kid_p"), "left")
             .select("p", F.when(F.col("up") > 0, F.col("up_p")).alias("anc"), F.coalesce("m", F.lit(0)).cast("long").alias("n"),
                     "least", F.coalesce("children", F.lit(0)).cast("long").alias("children"),
                     F.col("children").isNull().cast("long").alias("leaves"),
                     (F.coalesce("m", F.lit(0)) * cum).cast("long").alias("cums"), (cum - F.col("up_cum")).alias("chars")))
    state = staged(state, "sums")
    while not state.where("anc is not null").isEmpty():
        below = state.where("anc is not null").groupBy(F.col("anc").alias("to")).agg(
            *[F.sum(c).alias(f"more_{c}") for c in ("n", "leaves", "cums", "chars")], F.min("least").alias("more_least"))
        links = state.select(F.col("p").alias("via"), F.col("anc").alias("next"))
        joined = state.join(below, F.col("p") == F.col("to"), "left").join(links, F.col("anc") == F.col("via"), "left")
        state = staged(joined.select(
            "p", F.col("next").alias("anc"), F.least("least", "more_least").alias("least"), "children",
            *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("n", "leaves", "cums", "chars")]), "sums")
    return state.drop("anc")


def prefix_trie(rows: DataFrame, conversations: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(nodes, members). ``rows``: conv, at, digest, chars as ``turn_rows`` gives them;
    ``conversations``: conv, every conversation once.

    nodes, one row per distinct prefix: depth, p, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens. members: p, conv: the prefix that each conversation ends at.
    """
    blocks = staged(path_blocks(rows, block), "blocks")
    last = Window.partitionBy("conv").orderBy(F.col("base").desc())
    tops = (blocks.select("conv", "base", F.element_at("path", -1).alias("e")).withColumn("k", F.row_number().over(last))
            .where("k = 1").select("conv", F.col("e.p").alias("p"), F.col("e.cum").alias("cum")))
    members = join_same(conversations.select("conv"), tops, ["conv"], "left").select(
        "conv", F.coalesce("p", F.lit(ROOT_P)).alias("p"), F.coalesce("cum", F.lit(0)).alias("cum"))
    members = staged(members, "members")
    ends = members.groupBy("p").agg(F.count("*").alias("m"), F.min("conv").alias("least"))
    trie = build(blocks)
    sums = subtree_sums(trie, ends)
    whole = staged(trie.select("depth", "p", "up", "up_p", "up_cum", "label").join(sums, "p"), "trie")

    top = whole.where("up = 0").agg(F.count("*").alias("children"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
        "leaves", "cums", "chars")])
    all_ = members.agg(F.count("*").alias("n"), F.min("conv").alias("least"), F.sum("cum").alias("all_cums"))
    root = all_.crossJoin(top).where("n > 0").select(  # one row by one row
        F.lit(0).cast("long").alias("depth"), F.lit(ROOT_P).alias("p"), F.col("least").alias("conv_id"),
        F.lit(None).cast(members.schema["conv"].dataType).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        (F.col("cums") - F.col("chars")).cast("long").alias("saved_tokens"))

    ups = whole.select(F.col("p").alias("over_p"), F.col("least").alias("over")).union(
        all_.where("n > 0").select(F.lit(ROOT_P).alias("over_p"), "least"))
    edges = whole.join(ups, F.col("up_p") == F.col("over_p"), "left")
    # characters of the distinct texts from here downwards: all of the subtree's but the edge's part above
    nodes = edges.select("*", F.posexplode("label").alias("i", "x")).select(
        "*", F.when(F.col("i") == 0, F.col("up_cum")).otherwise(F.get("label", F.col("i") - 1)["cum"]).alias("above"),
        (F.col("i") == F.size("label") - 1).alias("bottom")).select(
        (F.col("up") + F.col("i") + 1).alias("depth"), F.col("x.p").alias("p"), F.col("least").alias("conv_id"),
        F.when(F.col("i") == 0, F.col("over")).otherwise(F.col("least")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(F.col("bottom"), F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("cums") - F.col("n") * F.col("above") - (F.col("chars") - (F.col("above") - F.col("up_cum")))).alias("saved_tokens"))
    return root.union(nodes.select(*root.columns)), members.select("p", "conv")
