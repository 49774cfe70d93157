"""Forest operators over events with (stream_id, event_id, parent_id): paths by pointer doubling, checks and ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import scratch

KEY = ["stream_id", "event_id"]


def paths(events: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(stream_id, event_id, root_id, depth, path): ids from the root to the event, for events whose chain of parents ends in a root; a
    missing parent ends the chain as a root would. Each round doubles the steps. Without max_depth, rounds go on until
    no pointer moves, or have reached as many steps as the largest stream has events, which no chain exceeds; an event on or below a cycle never arrives and is left out. With it, events deeper than the
    steps of the rounds that reach max_depth are left out too."""
    known = events.select("stream_id", F.col("event_id").alias("parent_id")).withColumn("there", F.lit(True))
    state = events.select("stream_id", "event_id", "parent_id").join(known, ["stream_id", "parent_id"], "left")
    state = state.select("stream_id", "event_id", F.when(F.col("there"), F.col("parent_id")).alias("up"), F.array("event_id").alias("path"))
    if max_depth is not None:
        for _ in range(max(1, max_depth).bit_length()):
            state = _doubled(state)
    else:
        most = events.groupBy("stream_id").count().agg(F.max("count")).first()[0] or 1
        for _ in range(int(most).bit_length()):
            state = _kept(_doubled(state))  # each round reads the one before twice
            if state.where("up is not null").isEmpty():
                break
    done = state.where("up is null")
    return done.select("stream_id", "event_id", F.col("path")[0].alias("root_id"), (F.size("path") - 1).alias("depth"), "path")


def _doubled(state: DataFrame) -> DataFrame:
    above = state.select("stream_id", F.col("event_id").alias("up"), F.col("up").alias("up2"), F.col("path").alias("path2"))
    return state.join(above, ["stream_id", "up"], "left").select("stream_id", "event_id", F.col("up2").alias("up"), F.when(F.col("up").isNull(), F.col("path")).otherwise(F.concat("path2", "path")).alias("path"))


def _kept(state: DataFrame) -> DataFrame:
    return scratch.kept(state, "paths")


def parent_cycles(events: DataFrame) -> DataFrame:
    """(stream_id, event_id) of causal events on or below a cycle of parents: those whose chain reaches no root."""
    causal = events.where("not is_background")
    return causal.select(*KEY).distinct().join(paths(causal.dropDuplicates(KEY)).select(*KEY), KEY, "left_anti")


def dag_check(edges: DataFrame, nodes: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Per stream: is_dag, whether every target has one source and no node lies on a cycle. edges: (stream_id, source, target), nodes: (stream_id, node)."""
    ins = edges.groupBy("stream_id").agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct("target").alias("n_targets"))
    rows = nodes.join(edges.select("stream_id", F.col("target").alias("node"), "source"), ["stream_id", "node"], "left")
    reached = paths(rows.select("stream_id", F.col("node").alias("event_id"), F.col("source").alias("parent_id")).dropDuplicates(KEY), max_depth).groupBy("stream_id").agg(F.count(F.lit(1)).alias("n_reached"))
    n = nodes.groupBy("stream_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    out = n.join(ins, "stream_id", "left").join(reached, "stream_id", "left")
    one = F.coalesce(F.col("n_edges") == F.col("n_targets"), F.lit(True))
    return out.select("stream_id", (one & (F.coalesce("n_reached", F.lit(0)) == F.col("n_nodes"))).alias("is_dag"))


def ground_truth(events: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Per causal event: parent_id, root_id and path; events: (stream_id, event_id, parent_id, is_background)."""
    causal = events.where(~F.col("is_background"))
    return paths(causal, max_depth).join(causal.select(*KEY, "parent_id"), KEY).select(*KEY, "parent_id", "root_id", F.array_join("path", ",").alias("path"))


def ground_truth_maps(events: DataFrame, max_depth: int | None = None) -> DataFrame:
    """The nested form: parents, roots and paths as maps, root and background ids sorted."""
    t = ground_truth(events, max_depth)
    entry = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col("event_id").cast("string").alias("k"), F.col(c).alias("v"))))))
    maps = t.withColumn("path", F.split("path", ",").cast("array<bigint>")).groupBy("stream_id").agg(entry("parent_id").alias("parents"), entry("root_id").alias("roots"), entry("path").alias("paths"), F.array_sort(F.collect_set("root_id")).alias("root_event_ids"))
    back = events.where("is_background").groupBy("stream_id").agg(F.array_sort(F.collect_list("event_id")).alias("background_event_ids"))
    return maps.join(back, "stream_id", "full_outer").withColumn("background_event_ids", F.coalesce("background_event_ids", F.array().cast("array<bigint>")))


def ground_truth_check(events: DataFrame, claimed: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Claimed (stream_id, event_id, root_id, path) against what the events say: the rows that differ or are missing on either side."""
    mine = ground_truth(events, max_depth).select(*KEY, F.col("root_id").alias("expected_root"), F.col("path").alias("expected_path"))
    both = mine.join(claimed.select(*KEY, "root_id", "path"), KEY, "full_outer")
    return both.where(~(F.col("root_id").eqNullSafe(F.col("expected_root")) & F.col("path").eqNullSafe(F.col("expected_path"))))


def sibling_groups(edges: DataFrame) -> DataFrame:
    n = F.count(F.lit(1)).over(Window.partitionBy("stream_id", "source"))
    return edges.withColumn("n", n).where("n > 1").select("stream_id", "target", F.concat(F.lit("children_of_"), F.col("source").cast("string")).alias("sibling_group"))


def edge_order(edges: DataFrame, depth: DataFrame) -> DataFrame:
    """(stream_id, ordinal, source, target): edges by the source's depth, then source and target as strings. depth: (stream_id, node, depth)."""
    e = edges.join(depth.select("stream_id", F.col("node").alias("source"), "depth"), ["stream_id", "source"])
    own = Window.partitionBy("stream_id").orderBy("depth", F.col("source").cast("string"), F.col("target").cast("string"))
    return e.select("stream_id", F.row_number().over(own).cast("bigint").alias("ordinal"), "source", "target")


def build_chain(streams: DataFrame, length: Column) -> DataFrame:
    """Nodes E0 .. En-1 of a chain for each stream; at least two."""
    n = F.greatest(length.cast("int"), F.lit(2))
    nodes = streams.select("stream_id", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    role = F.when(F.col("i") == 0, "root").when(F.col("i") == F.col("n") - 1, "target").otherwise("intermediate")
    return nodes.select("stream_id", F.concat(F.lit("E"), F.col("i").cast("string")).alias("node_id"), role.alias("role"), F.when(F.col("i") > 0, F.concat(F.lit("E"), (F.col("i") - 1).cast("string"))).alias("parent_node"))


def build_tree(streams: DataFrame, n_nodes: Column, max_depth: int = 6, max_children: int = 3, seed: str = "tree") -> DataFrame:
    """Nodes of a random tree for each stream: node i hangs from a node drawn evenly among those with room above max_depth; stops when there
    is none. The draw is keyed by stream and node, so a stream's tree doesn't depend on partitions."""
    from ..functions.randomness import uniform

    grown = streams.select("stream_id", F.greatest(n_nodes.cast("int"), F.lit(2)).alias("n"))
    draws = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: uniform(F.lit(seed), F.col("stream_id"), i))
    first = F.array(F.struct(F.lit(-1).alias("p"), F.lit(0).alias("d"), F.lit(0).alias("k")))

    def grow(acc: Column, u: Column) -> Column:
        room = F.filter(F.sequence(F.lit(0), F.size(acc) - 1), lambda j: (F.get(acc, j)["d"] < max_depth) & (F.get(acc, j)["k"] < max_children))
        pick = F.get(room, F.floor(u * F.size(room)).cast("int"))
        more = F.concat(F.transform(acc, lambda x, j: F.struct(x["p"].alias("p"), x["d"].alias("d"), (x["k"] + F.when(j == pick, 1).otherwise(0)).alias("k"))), F.array(F.struct(pick.alias("p"), (F.get(acc, pick)["d"] + 1).alias("d"), F.lit(0).alias("k"))))
        return F.when(F.size(room) > 0, more).otherwise(acc)

    tree = grown.select("stream_id", F.posexplode(F.aggregate(draws, first.cast("array<struct<p:int,d:int,k:int>>"), lambda a, u: grow(a, u).cast("array<struct<p:int,d:int,k:int>>"))).alias("i", "x"))
    return tree.select("stream_id", F.concat(F.lit("E"), F.col("i").cast("string")).alias("node_id"), F.when(F.col("i") > 0, F.concat(F.lit("E"), F.col("x.p").cast("string"))).alias("parent_node"), F.col("x.d").alias("depth"))
