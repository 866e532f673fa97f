"""Edges of a partition replaced by fewer that connect the same nodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Edges that are taken at once, and nodes whose roots a task keeps while it reads on.
EDGES, NODES = 1 << 21, 1 << 20


def roots(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node that each of the nodes 0.. reaches over the edges (u, v)."""
    root = np.arange(nodes)
    while True:
        a, b = root[u], root[v]
        open_ = a != b
        if not open_.any():
            return root
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def starred(u: pa.Array, v: pa.Array) -> list[pa.Array]:
    """Each node with the smallest one of its component; that one only if it is alone."""
    coded = pa.concat_arrays([u, v]).dictionary_encode()
    nodes = len(coded.dictionary)
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(nodes, np.int64)
    place[order] = np.arange(nodes)
    ends = place[coded.indices.to_numpy()]
    root = roots(ends[: len(u)], ends[len(u) :], nodes)
    kept = np.flatnonzero((root != np.arange(nodes)) | (np.bincount(root, minlength=nodes) == 1))
    return [coded.dictionary.take(pa.array(order[x])) for x in (kept, root[kept])]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    new = 0

    def taken() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        u, v = (table.column(i).combine_chunks() for i in range(2))
        return pa.RecordBatch.from_arrays(starred(u, v), names=table.schema.names)

    for batch in batches:
        known = pc.and_(batch.column(0).is_valid(), batch.column(1).is_valid())
        if batch.num_rows and not pc.all(known).as_py():
            yield batch.filter(pc.invert(known))  # an edge with a null end stays as it is
            batch = batch.filter(known)
        if not batch.num_rows:
            continue
        held.append(batch)
        new += batch.num_rows
        if new >= EDGES:
            held, new = [taken()], 0
            if held[0].num_rows > NODES:
                yield held.pop()
    if held:
        yield taken()


def contracted(edges: DataFrame) -> DataFrame:
    """The two columns of ``edges``, one row for each node of a partition: with the smallest node that it reaches inside the partition.

    Nothing is moved and no connection is lost or made, so components of the result are those of the edges.  A node that reaches no other one
    keeps its edge with itself.  A task that meets more than NODES nodes lets go of them and begins anew.
    """
    return edges.mapInArrow(_contract, edges.schema)
