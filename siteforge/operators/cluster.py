"""Connected components and greedy per-group geometry."""
from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteforge.functions import geo
from siteforge.operators import joins
from siteforge.storage import stored


#: Edges of which one task finds the components: 100,000 take it a tenth of a second and a few MB.
FEW = 100_000
#: Places of a group that one task chains.
MANY = 100_000


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label, where those of a and b that meet at an edge have become the smaller one, through chains of edges too."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        a, b, low, high = (x[low < high] for x in (a, b, low, high))
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def _solved(edges: DataFrame, by: list[str]) -> DataFrame:
    """(by, node, label) of the nodes of a few edges (by, a, b) without nulls, in one task."""
    kinds = dict(edges.dtypes)

    def run(batches):
        e = pd.concat(list(batches) or [pd.DataFrame(columns=[*by, "a", "b"])])
        e = {c: e[c].to_numpy() if e[c].dtype.kind in "iu" else e[c].to_numpy(dtype=object) for c in e}
        n = len(e["a"])
        at = np.zeros(n, dtype=np.int64)
        for c in by:
            at = at * (n + 1) + pd.factorize(e[c])[0]
            at = np.unique(at, return_inverse=True)[1]
        names, ids = np.unique(np.concatenate([e["a"], e["b"]]), return_inverse=True)
        ends, v = np.unique(np.concatenate([at, at]) * len(names) + ids, return_inverse=True)  # in the order of a group's names
        label = _joined(np.arange(len(ends)), v[:n], v[n:])
        first = np.unique(v, return_index=True)[1] % max(n, 1)
        made = {c: e[c][first] for c in by} | {"node": names[ends % max(len(names), 1)], "label": names[ends[label] % max(len(names), 1)]}
        yield pd.DataFrame({c: pd.Series(x, dtype=x.dtype) for c, x in made.items()})

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), f"node {kinds['a']}, label {kinds['a']}"])
    return edges.repartition(1).mapInPandas(run, schema)


def components(nodes: DataFrame, edges: DataFrame, group: str | None = None) -> DataFrame:
    """(group, node, label): smallest node of each component; nodes (group, node), edges (group, a, b) in any orientation.

    At most FEW edges are solved in one task. Of more, each node points at its smallest neighbour, if that is smaller; pointers jump to
    the ends of their chains, edges are drawn between these ends, and what is left goes round again: of the ends that still have an edge
    at least each second one goes, so the rounds follow the logarithm of the nodes. Edges join nodes of one group only; without a group,
    of one graph. Nodes without an edge are their own label, and an edge with a null joins nothing.
    """
    by = [group] if group else []
    between = lambda e: stored(e.where(F.col("a") != F.col("b")).select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    left = between(edges.dropna("any", subset=[*by, "a", "b"]))
    levels = []
    while left.count() > FEW:
        both = left.unionByName(left.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        label = stored(both.groupBy(*by, F.col("a").alias("node")).agg(F.min("b").alias("near")).select(*by, "node", F.least("node", "near").alias("label")))
        moved = True
        while moved:
            up = label.select(*by, F.col("node").alias("label"), F.col("label").alias("up"))
            label = stored(label.join(up, [*by, "label"]).select(*by, "node", F.col("up").alias("label"), (F.col("up") < F.col("label")).alias("moved")))
            moved = not label.where("moved").isEmpty()
            label = label.drop("moved")
        levels.append(label)
        end = lambda x: label.select(*by, F.col("node").alias(x), F.col("label").alias(f"l{x}"))  # noqa: E731, B023
        left = between(left.join(end("a"), [*by, "a"]).join(end("b"), [*by, "b"]).select(*by, F.col("la").alias("a"), F.col("lb").alias("b")))
    out = stored(_solved(left, by))
    for label in reversed(levels):
        up = out.select(*by, F.col("node").alias("label"), F.col("label").alias("up"))
        out = stored(label.join(up, [*by, "label"], "left").select(*by, "node", F.coalesce("up", "label").alias("label")))
    return nodes.join(out, [*by, "node"], "left").select(*by, "node", F.coalesce("label", "node").alias("label"))


def _chain(lat: np.ndarray, lon: np.ndarray, metres: float) -> np.ndarray:
    """First place of each place's cluster, chained by steps of at most metres.

    Places of a cube so small that any two are within a step are one. Two cubes are joined if their first places are within a step, and
    never if their boxes are too far apart; of other pairs that no chain joins, each box is split at its middle and the parts are paired.
    """
    reach = 2 * math.sin(min(math.pi / 2, metres / (2 * geo.EARTH_M)))  # a step's chord on the unit sphere
    y, x = np.radians(lat), np.radians(lon)
    at = np.stack([np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)])
    side = 0.99 * reach / math.sqrt(3)
    n = int(2 / side) + 6
    cube = np.floor((at + 1) / side).astype(np.int64) + 2
    ids, root = np.unique((cube[0] * n + cube[1]) * n + cube[2], return_inverse=True)
    a, b = [], []
    for i, j, k in itertools.product(range(-2, 3), repeat=3):  # a step is 1.75 sides
        beside = ids + (i * n + j) * n + k
        to = np.minimum(np.searchsorted(ids, beside), len(ids) - 1)
        a.append(np.flatnonzero((ids[to] == beside) & (beside > ids)))
        b.append(to[a[-1]])
    a, b = np.concatenate(a), np.concatenate(b)
    label, place, node = np.arange(len(ids)), np.arange(len(lat)), root
    while len(a):
        order = np.argsort(node, kind="stable")
        start = np.searchsorted(node[order], np.arange(node.max() + 1))
        low, high = (f.reduceat(at[:, place[order]], start, axis=1) for f in (np.minimum, np.maximum))
        gap = np.maximum(0, np.maximum(low[:, a] - high[:, b], low[:, b] - high[:, a]))
        kept = (gap * gap).sum(axis=0) <= (reach * (1 + 1e-9)) ** 2
        a, b = a[kept], b[kept]
        first = place[order[start]]
        p, q = first[a], first[b]
        h = np.sin(np.radians(lat[q] - lat[p]) / 2) ** 2 + np.cos(y[p]) * np.cos(y[q]) * np.sin(np.radians(lon[q] - lon[p]) / 2) ** 2
        near = 2 * geo.EARTH_M * np.arcsin(np.sqrt(np.minimum(1.0, h))) <= metres
        label = _joined(label, root[p[near]], root[q[near]])
        wide = (high - low).max(axis=0) > 1e-12
        kept = (label[root[p]] != label[root[q]]) & (wide[a] | wide[b])
        a, b = a[kept], b[kept]
        used = np.zeros(len(first), dtype=bool)
        used[a] = used[b] = True
        place, node = place[used[node]], node[used[node]]
        part = (at[:, place] > (low + (high - low) / 2)[:, node]).T @ np.array([4, 2, 1])
        ids, node = np.unique(node * 8 + part, return_inverse=True)
        (ia, na), (ib, nb) = ((np.searchsorted(ids, 8 * v), np.searchsorted(ids, 8 * v + 8) - np.searchsorted(ids, 8 * v)) for v in (a, b))
        pair = np.repeat(np.arange(len(a)), na * nb)
        at_pair = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
        a, b = ia[pair] + at_pair // nb[pair], ib[pair] + at_pair % nb[pair]
    best = np.full(len(label), len(lat))
    np.minimum.at(best, label[root], np.arange(len(lat)))
    return best[label[root]]


def chained(points: DataFrame, group: str, key: str, metres: float) -> DataFrame:
    """points with the label of each: the smallest key of its cluster, chained by steps of at most metres within a group.

    points (group, key, lat, lon, others...; a key once). Points of a group at one place are one, and a group is one task's work. If a
    group has over MANY places, or a step is under 20 metres, all groups are chained by joins. A point without place or group stays alone.
    """
    places = stored(points.groupBy(group, "lat", "lon").agg(F.min(key).alias("p")).dropna("any", subset=[group, "lat", "lon", "p"]))
    if metres >= 20 and places.groupBy(group).count().where(F.col("count") > MANY).isEmpty():
        kinds = dict(places.dtypes)

        def run(d: pd.DataFrame) -> pd.DataFrame:
            d = d.sort_values("p", ignore_index=True)
            first = _chain(d["lat"].to_numpy(dtype=float), d["lon"].to_numpy(dtype=float), metres)
            return d.drop(columns="p").assign(label=d["p"].to_numpy()[first])

        named = places.groupBy(group).applyInPandas(run, f"`{group}` {kinds[group]}, lat {kinds['lat']}, lon {kinds['lon']}, label {kinds['p']}")
    else:
        named = _chained_places(places, group, metres)
    return points.join(named, [group, "lat", "lon"], "left").withColumn("label", F.coalesce("label", key))


def _chained_places(places: DataFrame, group: str, metres: float) -> DataFrame:
    """(group, lat, lon, label) of places (group, lat, lon, p), by joins.

    Places of a grid cell so small that any two are within a step are one. Cells are first joined by their outermost places alone; then
    all places of the groups that are not yet one cluster are compared.
    """
    side = 0.7 * metres / 112000.0  # degrees; both sides make a diagonal of 0.99 metres
    row = F.floor(F.col("lat") / side)
    width = side / F.greatest(F.cos(F.radians(F.least(F.abs(row), F.abs(row + 1)) * side)), F.lit(1e-9))
    places = stored(places.withColumns({"r_": row, "c_": F.floor(F.col("lon") / width)}))
    far = [end(F.struct("lat", "lon"), F.col(c)) for c in ("lat", "lon") for end in (F.min_by, F.max_by)]
    cells = stored(places.groupBy(group, "r_", "c_").agg(F.min("p").alias("cell"), F.array_distinct(F.array(*far)).alias("far")))

    def near(df: DataFrame, more: list[str]) -> DataFrame:
        """Pairs of df (group, cell, lat, lon, more...) at most metres apart; the other's columns begin with r."""
        other = df.select(group, *[F.col(c).alias(f"r{c}") for c in ("cell", "lat", "lon", *more)])
        return joins.within_distance(df, other, metres, [group])

    edge = lambda df, a, b: stored(df.where(F.col(a) < F.col(b)).select(group, F.col(a).alias("a"), F.col(b).alias("b")).distinct())
    ends = cells.select(group, "cell", F.explode("far").alias("f")).select(group, "cell", "f.*")
    first = stored(components(cells.select(group, F.col("cell").alias("node")), edge(near(ends, []), "cell", "rcell"), group))
    held = stored(places.join(cells.drop("far"), [group, "r_", "c_"]).join(first.withColumnRenamed("node", "cell"), [group, "cell"]).select(group, "lat", "lon", "cell", "label"))
    several = first.groupBy(group).agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select(group)
    again = edge(near(held.join(several, group, "left_semi"), ["label"]), "label", "rlabel")
    last = components(first.select(group, F.col("label").alias("node")).distinct(), again, group)
    return held.join(last.select(group, F.col("node").alias("label"), F.col("label").alias("last")), [group, "label"]).select(group, "lat", "lon", F.col("last").alias("label"))


def by_group(df: DataFrame, keys: list[str], solve, schema) -> DataFrame:
    """Rows solve(list of row dicts) of each group: sorted partitions are streamed, so a small group costs no frame of its own."""

    def run(batches):
        names = schema_names
        held: list[dict] = []
        for b in batches:
            out: list = []
            for r in b.to_dict("records"):
                if held and any(held[0][k] != r[k] for k in keys):
                    out += solve(held)
                    held = []
                held.append(r)
            yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame(solve(held), columns=names)

    schema_names = [f.split()[0] for f in schema.split(",")] if isinstance(schema, str) else schema.names
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _metres(lat1, lon1, lat2, lon2) -> float:
    dx = (lon2 - lon1) * 111320 * math.cos(math.radians((lat1 + lat2) / 2))
    return math.hypot(dx, (lat2 - lat1) * 111320)


def nms(df: DataFrame, group: list[str], metres: float) -> DataFrame:
    """Greedy merge by group: the most confident object takes all within metres of itself (not of its members); their
    confidence-weighted mean is the merged point. df (group..., id, lat, lon, conf) -> (group..., id, lat, lon, n_merged)."""
    schema = ", ".join([*(f"{c} {dict(df.dtypes)[c]}" for c in group), f"id {dict(df.dtypes)['id']}", "lat double, lon double, n_merged int"])

    def merge(rows: list[dict]) -> list:
        rows = sorted(rows, key=lambda r: (-r["conf"], r["id"]))
        out = []
        while rows:
            seed = rows[0]
            near = [r for r in rows if _metres(seed["lat"], seed["lon"], r["lat"], r["lon"]) <= metres]
            ids = {r["id"] for r in near}
            rows = [r for r in rows if r["id"] not in ids]
            w = sum(r["conf"] for r in near)
            out.append([*(seed[c] for c in group), seed["id"], sum(r["lat"] * r["conf"] for r in near) / w, sum(r["lon"] * r["conf"] for r in near) / w, len(near)])
        return out

    return by_group(df, group, merge, schema)


def keep_apart(df: DataFrame, group: list[str], metres: float) -> DataFrame:
    """Greedy deduplication by group: the most confident object stays, others of the group within metres of a kept one go."""
    def keep(rows: list[dict]) -> list:
        kept: list[dict] = []
        for r in sorted(rows, key=lambda r: (-r["conf"], r["id"])):
            if all(_metres(k["lat"], k["lon"], r["lat"], r["lon"]) > metres for k in kept):
                kept.append(r)
        return [list(k.values()) for k in kept]

    return by_group(df, group, keep, df.schema)


def grow_sites(df: DataFrame, gap: float, most: int = 4, least_score: float = 0.5) -> DataFrame:
    """Per plant: grow from the seed parcel; a parcel joins if its box is within gap metres of the current union and it holds a
    detection, or has the seed's non-empty owner and a score of at least least_score or none. Parcels are tried in pool order until nothing
    changes. df (plant, parcel, seed, owner, detected, score, x0, y0, x1, y1, pool) in metres -> (plant, parcel, step)."""
    def grow(rows: list[dict]) -> list:
        pool = sorted(rows, key=lambda r: (r["pool"], r["parcel"]))
        site = [r for r in pool if r["seed"]][:1]
        moved = bool(site)
        while moved and len(site) < most:
            moved = False
            for r in pool:
                if len(site) >= most or any(r["parcel"] == s["parcel"] for s in site):
                    continue
                near = any(math.hypot(max(s["x0"] - r["x1"], r["x0"] - s["x1"], 0), max(s["y0"] - r["y1"], r["y0"] - s["y1"], 0)) <= gap for s in site)
                fits = r["detected"] or (bool(site[0]["owner"]) and r["owner"] == site[0]["owner"] and (pd.isna(r["score"]) or r["score"] >= least_score))
                if near and fits:
                    site.append(r)
                    moved = True
        return [(r["plant"], r["parcel"], i) for i, r in enumerate(site)]

    t = dict(df.dtypes)
    return by_group(df, ["plant"], grow, f"plant {t['plant']}, parcel {t['parcel']}, step int")
