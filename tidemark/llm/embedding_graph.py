"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one per shard."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, stored
from tidemark.llm.simhash import components, rooted

LEAST = 0.93
#: Vectors of a shard, on average; the pairs that a task compares are a table of this size squared.
SHARD = 1 << 13
#: Neighbours on the upper layers; the lowest has twice as many.
NEIGHBOURS = 16
BUILD_BEAM, FIRST_BEAM = 64, 48
#: Queries of each task that are also answered exactly, and the share of links that must be found.
AUDITED, RECALL = 256, 0.99
AT_ONCE = 512
#: A step looks at the neighbours of this share of a beam's entries, of four at least.
OPENED = 16
NEAR = 1e-4  # how far single precision may be off
PAIRS_AT_ONCE = 1 << 17
SEED = 13

_FOUND = "nodes array<long>, counts array<long>, roots array<long>"


class Graph:
    """Unit vectors linked to near and diverse neighbours on layers of falling height.

    Vectors are inserted in batches that are never larger than what is there already: a batch
    is searched for as a whole, each vector is linked to the neighbours found, and those link
    back. Of many candidates a vector keeps those that are nearer to it than to any it keeps.
    """

    def __init__(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM):
        exact = vectors.astype(np.float64)
        # Values near the ends of the range of doubles would overflow when squared.
        exact = exact / np.abs(exact).max(axis=1, keepdims=True)
        self.exact, self.norms = exact, np.sqrt(np.einsum("nd,nd->n", exact, exact))
        self.unit = (exact / self.norms[:, None]).astype(np.float32)
        self.beam, n = beam, len(vectors)
        draw = np.random.default_rng(SEED).random(n)
        height = (-np.log(1 - draw) / np.log(neighbours)).astype(np.int64)
        height[:1] = height.max(initial=0)  # the entry point
        self.top = int(height[0]) if n else 0
        self.links = [
            np.full((n, neighbours if layer else 2 * neighbours), -1, np.int32)
            for layer in range(self.top + 1)
        ]
        done = 1
        while done < n:
            new = np.arange(done, min(n, 2 * done, done + AT_ONCE))
            self._insert(new, height)
            done = int(new[-1]) + 1

    def near(self, queries: np.ndarray, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Block after block, (query, member) of all that beams find above the least similarity."""
        for start in range(0, len(queries), AT_ONCE):
            block = queries[start : start + AT_ONCE]
            entry = self._descend(block, self.top, np.zeros(len(block), np.int64), 0)
            rows, width, begin, floor = np.arange(len(block)), beam, entry[:, None], -np.inf
            while len(rows):
                ids, sims = self._search(block[rows], begin, width, 0, floor)
                full = (sims[:, -1] >= LEAST - NEAR) & (width < len(self.unit))
                at, place = np.nonzero((sims >= LEAST - NEAR) & ~full[:, None])
                yield start + rows[at], ids[at, place]
                # More may lie beyond a beam full of links; from there on only links lead further.
                rows, begin, floor = rows[full], ids[full], LEAST - NEAR
                width = min(4 * width, len(self.unit))

    def _descend(self, queries: np.ndarray, top: int, entry: np.ndarray, to: int) -> np.ndarray:
        for layer in range(top, to, -1):
            entry = self._search(queries, entry[:, None], 1, layer)[0][:, 0]
        return entry

    def _search(self, queries: np.ndarray, entry: np.ndarray, beam: int, layer: int,
                floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` members that each query reaches from its entries, best first.

        Members below ``floor`` lead to no others.
        """
        n, links, rows = len(queries), self.links[layer], np.arange(len(queries))
        seen = np.zeros((n, len(self.unit) + 1), bool)  # the last column stands for "no neighbour"
        seen[:, -1] = True
        np.put_along_axis(seen, entry, True, 1)
        ids, sims = entry, self._similar(queries, entry)
        closed = np.zeros(ids.shape, bool)
        ids, sims, closed = self._best(ids, sims, closed, beam)
        while len(rows):
            score = np.where(closed[rows], -np.inf, sims[rows])
            width = min(max(4, beam // OPENED), score.shape[1])
            chosen = np.argpartition(-score, width - 1, axis=1)[:, :width]
            going = np.take_along_axis(score, chosen, 1) > -np.inf
            alive = going.any(axis=1)
            rows, chosen, going = rows[alive], chosen[alive], going[alive]
            if not len(rows):
                break
            closed[rows[:, None], chosen] = True
            found = np.where(going[:, :, None], links[ids[rows[:, None], chosen]], -1).reshape(len(rows), -1)
            new = ~seen[rows[:, None], found]
            new &= _firsts(found)
            seen[rows[:, None], found] = True
            at, place = np.nonzero(new)
            more = np.full(found.shape, -np.inf, np.float32)
            more[at, place] = np.einsum("pd,pd->p", self.unit[found[at, place]], queries[rows[at]])
            wider = self._best(
                np.concatenate([ids[rows], found], axis=1), np.concatenate([sims[rows], more], axis=1),
                np.concatenate([closed[rows], ~new | (more < floor)], axis=1), beam)
            if wider[0].shape[1] > ids.shape[1]:
                ids, sims, closed = (
                    np.concatenate([x, np.full((n, wider[0].shape[1] - x.shape[1]), fill, x.dtype)], axis=1)
                    for x, fill in ((ids, 0), (sims, -np.inf), (closed, True)))
            ids[rows], sims[rows], closed[rows] = wider
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def _similar(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.einsum("qmd,qd->qm", self.unit[ids], queries)

    @staticmethod
    def _best(ids: np.ndarray, sims: np.ndarray, closed: np.ndarray, beam: int) -> tuple[np.ndarray, ...]:
        if ids.shape[1] <= beam:
            return ids, sims, closed
        keep = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
        return tuple(np.take_along_axis(x, keep, 1) for x in (ids, sims, closed))

    def _insert(self, new: np.ndarray, height: np.ndarray) -> None:
        entry = np.zeros(len(new), np.int64)
        for layer in range(self.top, -1, -1):
            queries = self.unit[new]
            own = height[new] >= layer
            above = ~own
            if above.any():
                entry[above] = self._search(queries[above], entry[above, None], 1, layer)[0][:, 0]
            if own.any():
                ids, sims = self._search(queries[own], entry[own, None], self.beam, layer)
                entry[own] = ids[:, 0]
                chosen = self._diverse(ids, sims, self.links[layer].shape[1] // (1 if layer else 2))
                self.links[layer][new[own], : chosen.shape[1]] = chosen
                self._link_back(layer, new[own], chosen)

    def _link_back(self, layer: int, new: np.ndarray, chosen: np.ndarray) -> None:
        links = self.links[layer]
        at, place = np.nonzero(chosen >= 0)
        target, source = chosen[at, place].astype(np.int64), new[at]
        sims = np.einsum("pd,pd->p", self.unit[target], self.unit[source])
        order = np.lexsort((-sims, target))
        target, source = target[order], source[order]
        begin = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        nth = np.arange(len(target)) - np.repeat(begin, np.diff(np.r_[begin, len(target)]))
        near = nth < links.shape[1]  # of very many only the nearest can matter
        who = target[begin]
        wanted = np.full((len(who), 2 * links.shape[1]), -1, np.int64)
        wanted[:, : links.shape[1]] = links[who]
        wanted[np.searchsorted(who, target[near]), links.shape[1] + nth[near]] = source[near]
        for start in range(0, len(who), AT_ONCE):
            ids = wanted[start : start + AT_ONCE]
            sims = np.where(ids < 0, -np.inf, self._similar(self.unit[who[start : start + AT_ONCE]], ids))
            order = np.argsort(-sims, axis=1, kind="stable")
            kept = self._diverse(np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1), links.shape[1])
            links[who[start : start + AT_ONCE]] = kept

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` candidates (best first), diverse ones before others; -1 where there are fewer."""
        real = sims > -np.inf
        vectors = self.unit[ids]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        kept = np.zeros(ids.shape, bool)
        closest = np.full(ids.shape, -np.inf, np.float32)  # to one that is kept
        for i in range(ids.shape[1]):
            kept[:, i] = real[:, i] & (sims[:, i] > closest[:, i]) & (kept.sum(axis=1) < most)
            closest = np.where(kept[:, i : i + 1], np.maximum(closest, between[:, :, i]), closest)
        order = np.argsort(np.where(real, np.where(kept, 0, 1), 2), axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(real, order, 1), np.take_along_axis(ids, order, 1), -1)


def linked(one: Graph, two: Graph, first_beam: int = FIRST_BEAM, recall: float = RECALL) -> np.ndarray:
    """Which members of ``one`` (rows) and ``two`` have a cosine of ``LEAST`` or more, as far as beams find.

    Every member queries the other graph. Some queries are answered exactly too; while beams miss more
    than ``1 - recall`` of their links, all beams widen. A beam as wide as the shard that still
    misses some gives way to the exact comparison.
    """
    out = np.zeros((len(one.unit), len(two.unit)), bool)
    some = np.unique(np.linspace(0, len(one.unit) - 1, AUDITED).astype(np.int64))
    truth = one.unit[some] @ two.unit.T >= LEAST + NEAR
    beam = first_beam
    while True:
        for rows, found in two.near(one.unit, beam):
            for start in range(0, len(rows), PAIRS_AT_ONCE):
                a, b = rows[start : start + PAIRS_AT_ONCE], found[start : start + PAIRS_AT_ONCE]
                out[a, b] = _cosines(one, two, a, b) >= LEAST
        if (out[some] & truth).sum() >= recall * truth.sum():
            return out
        if beam >= len(two.unit):
            break
        beam *= 2
    for start in range(0, len(one.unit), AT_ONCE):
        a, b = np.nonzero(one.unit[start : start + AT_ONCE] @ two.unit.T >= LEAST - NEAR)
        for at in range(0, len(a), PAIRS_AT_ONCE):
            rows, found = start + a[at : at + PAIRS_AT_ONCE], b[at : at + PAIRS_AT_ONCE]
            out[rows, found] = _cosines(one, two, rows, found) >= LEAST
    return out


def embedding_links(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                    label_column: str = "label", shard: int = SHARD) -> DataFrame:
    """``id``, ``n_links``, ``component_id``, ``kept``: one row per row of ``vectors``.

    Two vectors link if their labels are equal and not null, they have as many components, and
    their cosine in double precision is 0.93 or more. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable (a null one only where there is no
    other), and a row is kept if its id is that. A vector that is null, empty, zero or has null or
    non-finite components links with nothing, and neither do null labels. Rows may repeat an id.

    Equal vectors of a label are one class and are counted, not compared. The classes of a label
    are dealt by hash into shards of about ``shard``, each with its graph. Every class queries its own
    graph and, two shards at a time, every other one of its label; so the work grows with
    the square of a label's number of shards, and no task holds more than two of them. A task gives
    counts and one link per member, not its pairs. Which links are found is the same in every run;
    audits hold the share missed under 1 % of each task's sample.
    """
    rows = vectors.select(
        named(id_column).alias("id"), named(vector_column).alias("vec"), named(label_column).alias("label"))
    usable = F.col("label").isNotNull() & F.coalesce(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", F.col("vec").isNotNull() & usable)
    classes = stored(rows.where("usable").groupBy("label", "vec").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")
    ).withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    sized = classes.withColumn("d", F.size("vec"))
    kind = classes.schema["label"].dataType.simpleString()
    many = sized.groupBy("label", "d").agg(F.ceil(F.count(F.lit(1)) / shard).alias("shards"))
    place = F.pmod(F.xxhash64("vec"), F.col("shards")).alias("shard")
    graphs = stored(
        sized.join(many, ["label", "d"]).select("label", "d", "shards", place, "node", "copies", "vec")
        .repartition("label", "d", "shard")  # else the join's dealing by label would do for the groups
        .groupBy("label", "d", "shard").applyInPandas(_within, f"label {kind}, d int, shard long, shards long, graph binary, {_FOUND}"),
        "vector-graphs")
    keys = ["label", "d"]
    pairs = graphs.where("shards > 1").select(*keys, "shard", "graph", F.explode(F.filter(
        F.sequence(F.lit(0), F.col("shards") - 1), lambda x: x != F.col("shard"))).alias("other"))
    across = pairs.withColumns({"a": F.least("shard", "other"), "b": F.greatest("shard", "other")}).groupBy(
        *keys, "a", "b").applyInPandas(_across, _FOUND)
    found = stored(graphs.select("nodes", "counts", "roots").union(across), "vector-links").select(
        F.explode(F.arrays_zip("nodes", "counts", "roots")).alias("x")).select("x.*")
    counts = found.groupBy("nodes").agg(F.sum("counts").alias("links"))
    roots = components(found.where("nodes <> roots").select(
        F.col("nodes").alias("a"), F.col("roots").alias("b")), "vector-components")
    reached = rooted(classes.select(F.col("least").alias("id"), F.col("node").alias("fp")), roots)
    done = stored(
        classes.join(counts, classes["node"] == counts["nodes"]).join(reached, F.col("node") == F.col("fp"))
        .select("label", "vec", "least", "copies", "component_id",
                (F.col("links") + F.col("copies") - 1).alias("n_links")), "vectors-done")
    # A vector that occurs once is its class; of copies, adaptive execution splits a hot one.
    single = done.where("copies = 1").select(F.col("least").alias("id"), "n_links", "component_id")
    copies = rows.where("usable").join(done.where("copies > 1"), ["label", "vec"]).select(
        "id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return single.union(copies).union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _cosines(one: Graph, two: Graph, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("pd,pd->p", one.exact[a], two.exact[b]) / (one.norms[a] * two.norms[b])


def _firsts(found: np.ndarray) -> np.ndarray:
    """The first of equal values in each row."""
    order = np.argsort(found, axis=1, kind="stable")
    put = np.take_along_axis(found, order, 1)
    out = np.empty(found.shape, bool)
    np.put_along_axis(out, order, np.c_[np.ones(len(found), bool), put[:, 1:] != put[:, :-1]], 1)
    return out


def _roots(links: np.ndarray, mirrored: np.ndarray) -> np.ndarray:
    """For rows, then columns of a table of links, one of the members that they are connected to."""
    n = len(links)
    root = np.full(n + links.shape[1], -1)
    has = np.r_[links.any(axis=1), links.any(axis=0)]
    root[~has] = np.flatnonzero(~has)
    for first in np.flatnonzero(has[:n]):
        if root[first] >= 0:
            continue
        root[first] = first
        front = np.array([first])
        while len(front):
            right = np.flatnonzero(links[front].any(axis=0) & (root[n:] < 0))
            root[n + right] = first
            front = np.flatnonzero(mirrored[right].any(axis=0) & (root[:n] < 0))
            root[front] = first
    return root


def _weighed(links: np.ndarray, copies: np.ndarray) -> np.ndarray:
    out = np.zeros(len(links), np.int64)
    for start in range(0, len(links), AT_ONCE):
        at, place = np.nonzero(links[start : start + AT_ONCE])
        out[start : start + AT_ONCE] = np.bincount(
            at, copies[place].astype(np.float64), min(AT_ONCE, len(links) - start)).astype(np.int64)
    return out


def _within(members: pd.DataFrame) -> pd.DataFrame:
    """A shard's graph and the links among its own members."""
    members = members.sort_values("node")
    nodes, copies = members["node"].to_numpy(np.int64), members["copies"].to_numpy(np.int64)
    graph = Graph(np.stack(members["vec"].to_numpy()))
    links = linked(graph, graph)
    links |= links.T
    np.fill_diagonal(links, False)
    counts = _weighed(links, copies)
    np.fill_diagonal(links, links.any(axis=1))  # a row and its column are the same member
    root = _roots(links, links)[: len(nodes)]
    several = members["shards"].iloc[0] > 1
    return members.iloc[:1][["label", "d", "shard", "shards"]].assign(
        graph=[pickle.dumps((graph, nodes, copies)) if several else None],
        nodes=[nodes], counts=[counts], roots=[nodes[root]])


def _across(shards: pd.DataFrame) -> pd.DataFrame:
    """Links between the members of two shards, sought from both sides."""
    (one, nodes, copies), (two, others, times) = (pickle.loads(x) for x in shards.sort_values("shard")["graph"])
    links = linked(one, two)
    back = linked(two, one)
    links |= back.T
    mirrored = np.ascontiguousarray(links.T)
    every = np.r_[nodes, others]
    counts = np.r_[_weighed(links, times), _weighed(mirrored, copies)]
    return pd.DataFrame({"nodes": [every], "counts": [counts], "roots": [every[_roots(links, mirrored)]]})
