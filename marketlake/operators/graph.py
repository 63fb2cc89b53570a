"""Graph features on typed bipartite edge tables ``(kind, src, dst, valid_from, valid_to)`` - entity to shared
infrastructure (device, IP, bank, owner, mandate).

Edges are facts with a validity: a mandate ends, an account changes its bank, a device that was not seen for some days is
given up. What a decision at a time T may know are the edges valid at T; ``as_of`` filters for one T, ``risky_at`` answers
every row's own T in one pass, as running counts of edges that begin and end.

No pair enumeration: "how many others share my hub" is computed from hub degrees, distinct counts over several hubs from
small sets and mergeable sketches, never by a self-join through the hub, so a hub shared by a third of
all customers costs one row, not n^2 pairs. Iterative algorithms (components, BFS) run one
equi-join + partial aggregate per round, cut lineage each round by writing the round's table into
the shared checkpoint folder, and stop on a one-row convergence aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.windows import micros, prior
from marketlake.session import discard, materialize


_NEVER = "9999-12-31 00:00:00"


def sighted(df: DataFrame, specs: Sequence[tuple[str, str, str, int | None]], ts: str = "ts") -> DataFrame:
    """Edges observed in rows, from one scan: ``specs`` = ``[(kind, src_col, dst_col, days)]``. A sighting makes the edge
    valid for ``days`` (None: from then on); validity at a time rests on earlier sightings alone. Reduced to a row per
    edge and day before anything is put in order."""
    array = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"),
                               F.lit(days).cast("int").alias("days")) for kind, src, dst, days in specs])
    seen = df.select(F.col(ts).alias("_ts"), F.inline(array)).where("src is not null and dst is not null")
    daily = seen.groupBy("kind", "src", "dst", "days", F.to_date("_ts")).agg(F.min("_ts").alias("valid_from"), F.max("_ts").alias("_last"))
    until = F.when(F.col("days").isNotNull(), F.col("_last") + F.make_dt_interval(F.col("days")))
    return merged(daily.select("kind", "src", "dst", "valid_from", until.alias("valid_to")))


def recorded(df: DataFrame, kind: str, src: str, dst: str, valid_from: str, valid_to: Column | None = None) -> DataFrame:
    """Edges stated by records with a validity of their own (NULL end: open)."""
    end = F.lit(None).cast("timestamp_ntz") if valid_to is None else valid_to
    rows = df.select(F.lit(kind).alias("kind"), F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"),
                     F.col(valid_from).alias("valid_from"), end.alias("valid_to"))
    return merged(rows.where("src is not null and dst is not null and (valid_to is null or valid_from < valid_to)"))


def merged(e: DataFrame) -> DataFrame:
    """Overlapping and touching validities of the same edge joined into one: at any time an edge is valid once at most."""
    end = F.coalesce("valid_to", F.lit(_NEVER).cast("timestamp_ntz"))
    edge = Window.partitionBy("kind", "src", "dst").orderBy("valid_from", "_end")
    reach = F.max("_end").over(edge.rowsBetween(Window.unboundedPreceding, -1))
    parts = e.withColumn("_end", end).withColumn("_gap", F.coalesce((F.col("valid_from") > reach).cast("int"), F.lit(0)))
    parts = parts.withColumn("_part", F.sum("_gap").over(edge.rowsBetween(Window.unboundedPreceding, 0)))
    out = parts.groupBy("kind", "src", "dst", "_part").agg(F.min("valid_from").alias("valid_from"), F.max("_end").alias("_end"))
    return out.select("kind", "src", "dst", "valid_from", F.when(F.col("_end") < F.lit(_NEVER).cast("timestamp_ntz"), F.col("_end")).alias("valid_to"))


def edge_tables(txns: DataFrame, ips: DataFrame, accounts: DataFrame, mandates: DataFrame, device_days: int = 3) -> DataFrame:
    """All eight kinds: devices while they are in use, business relations from their first transaction on, addresses as
    recorded, banks and owners by account version, delegations while the mandate holds."""
    seen = sighted(txns, [("customer_device", "customer_id", "device_id", device_days), ("agent_device", "agent_id", "device_id", device_days),
                          ("customer_merchant", "customer_id", "merchant_id", None), ("agent_merchant", "agent_id", "merchant_id", None)])
    held = F.least("expires_at", F.coalesce("revoked_at", "expires_at"))
    return (seen.unionByName(recorded(ips, "customer_ip", "src", "dst", "valid_from"))
            .unionByName(recorded(accounts, "merchant_bank", "merchant_id", "bank_id", "valid_from", F.col("valid_to")))
            .unionByName(recorded(accounts, "merchant_owner", "merchant_id", "owner_id", "valid_from", F.col("valid_to")))
            .unionByName(recorded(mandates, "customer_mandate_agent", "customer_id", "agent_id", "issued_at", held)))


def valid_at(e: DataFrame, at: str) -> DataFrame:
    """Edges that a decision at ``at`` may know of: begun before it and not ended before it."""
    t = F.lit(at).cast("timestamp_ntz")
    return e.where((F.col("valid_from") < t) & (F.col("valid_to").isNull() | (F.col("valid_to") >= t)))


def shared_distinct(e: DataFrame, exact: int = 128, log2: int = 12) -> DataFrame:
    """Per kind and source: ``shared`` = number of distinct other sources on its hubs (one that shares two hubs counts once),
    ``hubs``, and ``estimated`` (whether ``shared`` is a sketch's estimate).

    With one hub the answer is its degree. Sources of several hubs whose degrees add up to at most ``exact`` unite the hubs'
    sets; the others unite the hubs' sketches (``hll_union_agg``, relative error about 1.04 / 2^(log2/2)), which are of
    bounded size however many sources a hub has. No pair of sources is ever formed beyond ``exact`` for a source."""
    k = e.select("kind", "src", "dst").distinct()
    sizes = k.groupBy("kind", "dst").agg(F.count("*").alias("_deg"), F.hll_sketch_agg("src", log2).alias("_sketch"))
    placed = k.join(sizes.select("kind", "dst", "_deg"), ["kind", "dst"])
    own = placed.groupBy("kind", "src").agg(F.count("*").alias("hubs"), F.sum("_deg").alias("_all"), F.max("_deg").alias("_deg"))
    single = own.where("hubs = 1").select("kind", "src", (F.col("_deg") - 1).alias("shared"), "hubs", F.lit(False).alias("estimated"))
    several = placed.join(own.where("hubs > 1").select("kind", "src", "hubs", "_all"), ["kind", "src"])
    few, many = several.where(F.col("_all") <= exact), several.where(F.col("_all") > exact)
    # sets only of hubs that some source unites by sets: no larger than `exact` each
    asked = few.select("kind", "dst").distinct()
    sets = k.join(asked, ["kind", "dst"]).groupBy("kind", "dst").agg(F.collect_list("src").alias("_set"))
    united = (few.join(sets, ["kind", "dst"]).groupBy("kind", "src")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("_set")))).cast("long").alias("_n"), F.max("hubs").alias("hubs"))
              .select("kind", "src", (F.col("_n") - 1).alias("shared"), "hubs", F.lit(False).alias("estimated")))
    sketched = (many.join(sizes.select("kind", "dst", "_sketch"), ["kind", "dst"]).groupBy("kind", "src")
                .agg(F.hll_sketch_estimate(F.hll_union_agg("_sketch")).alias("_n"), F.max("hubs").alias("hubs"))
                .select("kind", "src", F.greatest(F.col("_n") - 1, F.lit(0)).alias("shared"), "hubs", F.lit(True).alias("estimated")))
    return single.unionByName(united).unionByName(sketched)


def risky_at(rows: DataFrame, e: DataFrame, risky: DataFrame, key: str, src: str, ts: str = "ts", kinds: Sequence[str] = ()) -> DataFrame:
    """For every row's own time: how many other sources share a hub with its ``src`` (with multiplicity), how many of them
    were risky by then, and the ratio. ``e``: edges of one kind, or of the ``kinds``, which then get counts of their own
    (``<kind>_risky``). ``risky``: (src, risky_from).

    One pass for all times: a hub's count changes by one when an edge begins or ends, or when a source turns risky; what a
    row sees is the sum of the hub's earlier changes (``windows.prior``: hot hubs are cut). Only a row's own hubs are
    joined, by source and validity."""
    marked = e.select("kind", "src", "dst", "valid_from", "valid_to").join(risky.select("src", "risky_from"), "src", "left")
    turned = F.greatest("valid_from", "risky_from")
    counts = F.col("risky_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("risky_from") < F.col("valid_to")))

    def change(at: Column, n: int, bad: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(n).cast("long").alias("n"), bad.cast("long").alias("r"))

    changes = marked.select("kind", "dst", F.inline(F.array(
        change(F.col("valid_from"), 1, F.lit(0)), change(F.col("valid_to"), -1, F.when(counts, -1).otherwise(0)),
        change(F.when(counts, turned), 0, F.lit(1))))).where("at is not null")
    asked = (rows.select(F.col(key).alias("_row"), F.col(src).cast("long").alias("src"), F.col(ts).alias("at")).join(marked, "src")
             .where((F.col("valid_from") < F.col("at")) & (F.col("valid_to").isNull() | (F.col("at") <= F.col("valid_to"))))
             .select("kind", "dst", "at", "_row", F.coalesce(F.col("risky_from") < F.col("at"), F.lit(False)).cast("long").alias("_own")))
    nothing = F.lit(0).cast("long")
    both = asked.select("kind", "dst", "at", nothing.alias("n"), nothing.alias("r"), "_row", "_own").unionByName(
        changes.select("kind", "dst", "at", "n", "r", F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"), nothing.alias("_own")))
    seen = prior(both.withColumn("_t", micros(both, "at")), ["kind", "dst"], "_t", {"_n": F.col("n"), "_r": F.col("r")}).where("_row is not null")
    bad = F.col("_r") - F.col("_own")
    names = ["neighbours", "risky_neighbours", *[f"{k}_risky" for k in kinds]]
    found = seen.groupBy("_row").agg(F.sum(F.col("_n") - 1).alias("neighbours"), F.sum(bad).alias("risky_neighbours"),
                                     *[F.sum(F.when(F.col("kind") == k, bad).otherwise(0)).alias(f"{k}_risky") for k in kinds])
    return (rows.join(found, F.col(key) == F.col("_row"), "left").drop("_row").na.fill(0, names)
            .withColumn("risky_neighbor_ratio", F.try_divide(F.col("risky_neighbours"), F.col("neighbours"))))


def _undirected(e: DataFrame) -> DataFrame:
    a = e.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    return a.unionByName(a.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def components(e: DataFrame, max_iter: int = 100) -> DataFrame:
    """Connected components: ``(node, component)`` for every node, where ``component`` is the
    smallest node id reachable.

    Each round (1) propagates labels across edges and keeps each node's minimum (equi-join + partial
    aggregate) and (2) short-cuts every label to its label's label (pointer jumping, one more
    equi-join), which halves long chains, so the number of rounds grows with the log of the
    diameter rather than the diameter. Each round is written as a table in the shared checkpoint
    folder; the loop stops when no label changed (one-row count). ``max_iter`` only guards (raises)."""
    und = materialize(_undirected(e), "cc_edges")
    labels = materialize(und.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")),
                         "cc_labels")
    for _ in range(max_iter):
        cand = (und.join(labels, und.a == labels.node)
                   .select(F.col("b").alias("node"), F.col("component").alias("cand")))
        prop = (labels.join(cand.groupBy("node").agg(F.min("cand").alias("cand")), "node", "left")
                      .select("node", "component",
                              F.least("component", F.coalesce("cand", "component")).alias("_c1")))
        hop = labels.select(F.col("node").alias("_n2"), F.col("component").alias("_c2"))
        new = (prop.join(hop, prop._c1 == hop._n2, "left")
                   .select("node", F.least("_c1", F.coalesce("_c2", "_c1")).alias("_new"), "component")
                   .select("node", F.col("_new").alias("component"),
                           (F.col("_new") < F.col("component")).alias("_changed")))
        new = materialize(new, "cc_labels")
        changed = not new.where("_changed").isEmpty()   # a scan of the small written table
        discard(labels)
        labels = new.drop("_changed")
        if not changed:
            discard(und)
            return labels
    raise RuntimeError(f"components did not converge in {max_iter} rounds")


def component_sizes(labels: DataFrame, nodes: DataFrame, node_col: str = "node") -> DataFrame:
    """``(node, component, component_size)`` for the nodes of interest (e.g. customers only); size
    counts nodes of interest in the component."""
    n = nodes.select(F.col(node_col).alias("node")).distinct().join(labels, "node")
    size = n.groupBy("component").agg(F.count("*").alias("component_size"))
    return n.join(size, "component").select("node", "component", "component_size")


def risky_neighbours(e: DataFrame, flags: DataFrame, key: str = "src") -> DataFrame:
    """Share of a source's hub neighbours (other sources on its hubs, with multiplicity) that are
    flagged. ``flags``: ``(src, risky boolean)`` - build it as of T (e.g. dispute created < T).
    Per hub: neighbours and flagged neighbours (aggregate), joined back to the source's edges."""
    k = e.select("src", "dst").distinct().join(flags.select(F.col(key).alias("src"), "risky"), "src", "left") \
        .withColumn("_r", F.coalesce(F.col("risky"), F.lit(False)).cast("int"))
    hub = k.groupBy("dst").agg(F.count("*").alias("_n"), F.sum("_r").alias("_nr"))
    return (k.join(hub, "dst").groupBy("src")
             .agg(F.sum(F.col("_n") - 1).alias("neighbours"), F.sum(F.col("_nr") - F.col("_r")).alias("risky_neighbours"))
             .withColumn("risky_neighbor_ratio", F.try_divide(F.col("risky_neighbours"), F.col("neighbours"))))


def as_of(e: DataFrame, at: str) -> DataFrame:
    """Edges first seen strictly before ``at``: what a decision at that time could know."""
    return e.where(F.col("valid_from") < F.lit(at).cast("timestamp_ntz"))


def distance(e: DataFrame, seeds: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Source-to-source hops (through one hub per hop) to the nearest seed, for every source; NULL if no
    seed is reachable (or none within ``max_hops``, where the feature is defined with a bound).

    Frontier expansion: each round joins the new frontier to edges twice (src -> hub -> src) and keeps
    sources not seen before (anti-join); it ends when a round finds none. Every round is a written
    table; those of earlier rounds are read once more, together, at the end."""
    k = materialize(e.select("src", "dst").distinct(), "bfs_edges")
    frontier = materialize(seeds.select(F.col("src").cast("long")).distinct().withColumn("hops", F.lit(0)), "bfs_round")
    reached, hop = [frontier], 0
    while (max_hops is None or hop < max_hops) and not frontier.isEmpty():
        hop += 1
        near = frontier.join(k, "src").select("dst").distinct().join(k, "dst").select("src").distinct()
        # a source two rounds back can't be a neighbour of the frontier without having been reached since
        for earlier in reached[-2:]:
            near = near.join(earlier, "src", "left_anti")
        frontier = materialize(near.withColumn("hops", F.lit(hop)), "bfs_round")
        reached.append(frontier)
    found = reduce(DataFrame.unionByName, reached)
    everyone = k.select(F.col("src").cast("long")).unionByName(reached[0].select("src")).distinct()
    return everyone.join(found, "src", "left").withColumnRenamed("hops", "distance_to_confirmed_fraud")
