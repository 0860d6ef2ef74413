"""Co-change graph: decayed Jaccard edges, communities, labels, cohesion.

All repositories are one plan; only the community search is a grouped map, on the edges of one connected component at a time.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.graph import components, dealt_join, skew_join
from millrace.staging import pieces, stage

# Fixed values.
DECAY_DAYS = 180.0
MIN_PAIR = 3
MIN_JACCARD = 0.15
MIN_CLUSTER = 2
DAY = 86400.0


def edges(touches: DataFrame, min_pair: int = MIN_PAIR, min_jaccard: float = MIN_JACCARD, max_files: int | None = None) -> DataFrame:
    """Touches (repo, sha, ts in seconds, file) to edges repo, a, b, n, jaccard with a < b.

    A commit weighs exp(-age in days / DECAY_DAYS), its age measured from the newest commit of all repositories.
    """
    touches = touches.distinct()
    newest = touches.agg(F.max("ts").alias("_now"))
    rows = touches.join(F.broadcast(newest))  # one row
    rows = rows.withColumn("w", F.exp(-F.greatest(F.lit(0.0), (F.col("_now") - F.col("ts")) / DAY) / DECAY_DAYS)).drop("_now", "ts")
    if max_files is not None:
        rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy("repo", "sha"))).where(F.col("_n") <= max_files).drop("_n")
    weight = rows.groupBy("repo", "file").agg(F.sum("w").alias("fw"))
    lists = rows.groupBy("repo", "sha", "w").agg(F.array_sort(F.collect_list("file")).alias("fs")).where(F.size("fs") >= 2)
    # Files of a commit are few (capped upstream), so pairs come from its sorted list without a join.
    heads = lists.select("repo", "w", "fs", F.posexplode("fs").alias("_i", "a"))
    pairs = heads.select("repo", "w", "a", F.explode(F.slice("fs", F.col("_i") + 2, F.size("fs"))).alias("b"))
    tally = pairs.groupBy("repo", "a", "b").agg(F.count("*").alias("n"), F.sum("w").alias("pw")).where(F.col("n") >= min_pair)
    side = lambda x: weight.select("repo", F.col("file").alias(x), F.col("fw").alias(f"w_{x}"))
    joined = tally.join(side("a"), ["repo", "a"]).join(side("b"), ["repo", "b"])
    denominator = F.col("w_a") + F.col("w_b") - F.col("pw")
    joined = joined.where(denominator > 0).withColumn("jaccard", F.col("pw") / denominator)
    return joined.where(F.col("jaccard") >= min_jaccard).select("repo", "a", "b", "n", "jaccard")


def _local_moves(neighbours: list[dict[int, float]], loops: list[float], total: float) -> list[int]:
    """One level of modularity optimisation: nodes in order move to the neighbouring community of the largest gain."""
    n = len(neighbours)
    degree = [sum(x.values()) + 2 * loops[k] for k, x in enumerate(neighbours)]
    group = list(range(n))
    mass = degree[:]
    moved = True
    while moved:
        moved = False
        for v in range(n):
            links: dict[int, float] = {}
            for u, w in neighbours[v].items():
                links[group[u]] = links.get(group[u], 0.0) + w
            old = group[v]
            mass[old] -= degree[v]
            gain = lambda g: links.get(g, 0.0) - degree[v] * mass[g] / (2 * total)  # noqa: B023, E731
            best = min(links, key=lambda g: (-gain(g), g), default=old)
            if gain(best) <= gain(old) + 1e-12:
                best = old
            mass[best] += degree[v]
            if best != old:
                group[v], moved = best, True
    return group


def louvain(pairs: list[tuple[str, str, float]], total: float | None = None) -> dict[str, int]:
    """Communities of a weighted graph, or of a part of one whose edges weigh ``total``; nodes are visited in sorted order, so the result is determined. Community 0 holds the first node."""
    names = sorted({x for a, b, _ in pairs for x in (a, b)})
    place = {x: k for k, x in enumerate(names)}
    neighbours: list[dict[int, float]] = [{} for _ in names]
    for a, b, w in pairs:
        i, j = place[a], place[b]
        neighbours[i][j] = neighbours[i].get(j, 0.0) + w
        neighbours[j][i] = neighbours[j].get(i, 0.0) + w
    loops = [0.0] * len(names)
    total = total or sum(w for _, _, w in pairs)
    member = list(range(len(names)))
    while True:
        group = _local_moves(neighbours, loops, total)
        ids = {g: k for k, g in enumerate(dict.fromkeys(group))}
        if len(ids) == len(group):
            break
        merged: list[dict[int, float]] = [{} for _ in ids]
        inner = [0.0] * len(ids)
        for v, x in enumerate(neighbours):
            a = ids[group[v]]
            inner[a] += loops[v]
            for u, w in x.items():
                b = ids[group[u]]
                if a == b:
                    inner[a] += w / 2
                else:
                    merged[a][b] = merged[a].get(b, 0.0) + w
        member = [ids[group[m]] for m in member]
        neighbours, loops = merged, inner
    return {x: member[k] for x, k in place.items()}


def communities(edge_table: DataFrame) -> DataFrame:
    """repo, cluster_id (``repo:index``, in the order of the clusters' first files) and file, by modularity within each repository.

    No community goes over components, and what a move gains depends on the rest of the graph by its weight only. So components are searched apart, in
    parallel; the largest component of all repositories bounds a task.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        found = louvain(list(zip(pdf["a"], pdf["b"], pdf["jaccard"], strict=True)), float(pdf["total"].iloc[0]))
        return pd.DataFrame({"repo": pdf["repo"].iloc[0], "root": pdf["root"].iloc[0], "local": list(found.values()), "file": list(found)})

    text = stage(edge_table.select(F.col("repo").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"), "jaccard"), "cochange-edges")
    node = lambda x: F.xxhash64("repo", x)
    roots = components(text.select(node("a").alias("a"), node("b").alias("b")))
    total = text.groupBy("repo").agg(F.sum("jaccard").alias("total"))
    parts = text.withColumn("node", node("a")).join(roots, "node").join(total, "repo").select("repo", "root", "a", "b", "jaccard", "total")
    found = stage(parts.groupBy("repo", "root").applyInPandas(one, "repo string, root long, local long, file string"), "cochange-members")
    heads = found.groupBy("repo", "root", "local").agg(F.min("file").alias("_first"))
    index = (F.row_number().over(Window.partitionBy("repo").orderBy("_first")) - 1).cast("string")
    named = heads.select("repo", "root", "local", F.concat("repo", F.lit(":"), index).alias("cluster_id"))
    return found.join(named, ["repo", "root", "local"]).select("repo", "cluster_id", "file")


def cohesion(edge_table: DataFrame, members: DataFrame, min_cluster: int = MIN_CLUSTER) -> DataFrame:
    """repo, cluster_id, n_files and cohesion (the mean weight of edges inside), of clusters with enough files."""
    side = lambda x: members.select("repo", F.col("file").alias(x), F.col("cluster_id").alias(f"c_{x}"))
    inside = edge_table.join(side("a"), ["repo", "a"]).join(side("b"), ["repo", "b"]).where("c_a = c_b")
    mean = inside.groupBy("repo", F.col("c_a").alias("cluster_id")).agg(F.round(F.avg("jaccard"), 4).alias("cohesion"))
    sizes = members.groupBy("repo", "cluster_id").agg(F.count("*").alias("n_files")).where(F.col("n_files") >= min_cluster)
    return sizes.join(mean, ["repo", "cluster_id"], "left").withColumn("cohesion", F.coalesce("cohesion", F.lit(0.0)))


def common_directory(files: Column) -> Column:
    """The longest directory prefix of all paths: that of the smallest and the largest list of directories."""
    dirs = F.array_sort(F.transform(files, lambda f: F.slice(F.split(f, "/"), F.lit(1), F.size(F.split(f, "/")) - 1)))
    low, high = F.element_at(dirs, 1), F.element_at(dirs, -1)
    same = F.transform(low, lambda x, i: x == F.get(high, i))
    cut = F.array_position(F.transform(same, lambda x: F.coalesce(x, F.lit(False)).cast("int")), 0)
    return F.array_join(F.when(cut > 0, F.slice(low, F.lit(1), (cut - 1).cast("int"))).otherwise(low), "/")


def label(scope_counts: DataFrame, members: DataFrame) -> DataFrame:
    """repo, cluster_id and label: the modal scope if it occurs twice or more, else the common directory's last part, else the first file's stem.

    ``scope_counts``: repo, cluster_id, scope, n. Of equal counts the first scope by name wins.
    """
    modal = scope_counts.where("scope is not null and scope <> ''").groupBy("repo", "cluster_id").agg(F.max("n").alias("_top"))
    best = scope_counts.join(modal, ["repo", "cluster_id"]).where("n = _top and scope <> ''").groupBy("repo", "cluster_id", "_top").agg(F.min("scope").alias("_scope"))
    files = members.groupBy("repo", "cluster_id").agg(F.array_sort(F.collect_list("file")).alias("files"))
    stem = F.regexp_replace(F.element_at(F.split(F.element_at("files", 1), "/"), -1), r"\.[^.]+$", "")
    folder = F.element_at(F.split(common_directory(F.col("files")), "/"), -1)
    out = files.join(best, ["repo", "cluster_id"], "left")
    return out.select("repo", "cluster_id", F.when(F.col("_top") >= 2, F.col("_scope")).otherwise(F.coalesce(F.nullif(folder, F.lit("")), stem)).alias("label"))


def size_quantiles(sizes: DataFrame, column: str) -> DataFrame:
    """n, p50, p90 and max by rank, without interpolation."""
    w = Window.orderBy(column)
    ranked = sizes.groupBy(column).agg(F.count("*").alias("c"))  # the ranking sees one row per distinct size
    ranked = ranked.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy()))
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col(column))).cast("long")
    return ranked.groupBy("n").agg(at(F.floor(F.col("n") / 2)).alias("p50"), at(F.floor(F.col("n") * 0.9)).alias("p90"), F.max(column).cast("long").alias("max"))


def clusters_document(members: DataFrame, named: DataFrame) -> DataFrame:
    """One row per repository with its clusters nested, largest first."""
    files = members.groupBy("repo", "cluster_id").agg(F.array_sort(F.collect_list("file")).alias("files"))
    rows = named.join(files, ["repo", "cluster_id"])
    item = F.struct((-F.size("files")).alias("o"), "cluster_id", "label", "files", "n_files", "cohesion")
    return rows.groupBy("repo").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("o")).alias("clusters"))


def coherent(commits: DataFrame, clusters: DataFrame) -> DataFrame:
    """Commits (repo, sha, file) whose clustered files all lie in one cluster: repo, sha, cluster_id. Files without a cluster are tolerated."""
    n = pieces(commits, clusters)
    known = dealt_join(commits.select("repo", "sha", "file"), clusters.select("repo", "file", "cluster_id"), ["repo", "file"], n).select("repo", "sha", "cluster_id")
    # Dealt by commit before it is grouped: no task sorts what it read for all commits.
    out = known.repartition(n, "sha").groupBy("repo", "sha").agg(F.min("cluster_id").alias("cluster_id"), F.max("cluster_id").alias("_high"))
    return out.where("cluster_id = _high").drop("_high")


def ranked_members(clusters: DataFrame) -> DataFrame:
    """cluster_id, file and its place ``_k`` (from 1) among the cluster's files. Ranks are those of ranges of the order, so no task sees a whole cluster."""
    files = clusters.select("cluster_id", "file").where("cluster_id is not null and file is not null").distinct()
    parts = stage(files.repartitionByRange(pieces(clusters), "cluster_id", "file").withColumn("_p", F.spark_partition_id()), "members")
    counts = parts.groupBy("cluster_id", "_p").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("cluster_id").orderBy("_p")) - F.col("_n")
    inside = F.row_number().over(Window.partitionBy("cluster_id", "_p").orderBy("file"))
    return parts.withColumn("_in", inside).join(counts.select("cluster_id", "_p", before.alias("_before")), ["cluster_id", "_p"]).select("cluster_id", "file", (F.col("_before") + F.col("_in")).alias("_k"))


def siblings(touched: DataFrame, clusters: DataFrame, most: int = 6) -> DataFrame:
    """For each (sha, cluster_id) the first ``most`` cluster members, in order, that it doesn't touch.

    These are the first ``most`` places that the touched ones leave free, all within the first ``most`` + touched: no commit meets its whole cluster.
    """
    n = pieces(touched, clusters)
    ranks = stage(ranked_members(clusters), "member-ranks")
    own = dealt_join(touched.select("sha", "cluster_id", "file"), ranks, ["cluster_id", "file"], n, "left")
    own = own.select("sha", "cluster_id", "_k").repartition(n, "sha", "cluster_id").groupBy("sha", "cluster_id").agg(F.collect_set("_k").alias("_own"))
    free = F.slice(F.array_except(F.sequence(F.lit(1).cast("long"), F.size("_own") + F.lit(most).cast("long")), "_own"), 1, most)
    free = stage(own.select("sha", "cluster_id", (F.size("_own") > 0).alias("_any"), F.explode(free).alias("_k")), "free-places")
    # Every commit of a cluster asks for the same few places, so these are hot keys.
    asked = free.groupBy("cluster_id", "_k").agg(F.count("*").alias("_n"))
    found = skew_join(free, ranks.join(asked, ["cluster_id", "_k"]), ["cluster_id", "_k"], "_n", free.count())
    found = found.repartition(n, "sha", "cluster_id").groupBy("sha", "cluster_id").agg(F.first("_any").alias("_any"), F.array_sort(F.collect_list(F.when(F.col("file").isNotNull(), F.struct("_k", "file")))).alias("_l"))
    return found.where(F.col("_any") | (F.size("_l") > 0)).select("sha", "cluster_id", F.transform("_l", lambda x: x["file"]).alias("siblings"))
