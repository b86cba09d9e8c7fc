"""Connected components of links, which tasks contract to stars before the distributed rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators.graph import components


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (a[i], b[i]) as (member, smallest member) of each component, without the smallest ones."""
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    label, x, y = np.arange(len(ids)), flat[: len(a)], flat[len(a) :]
    while True:
        low = np.minimum(label[x], label[y])
        was = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label != label[label]).any():
            label = label[label]
        if (was == label).all():
            break
    member = np.flatnonzero(label != np.arange(len(ids)))
    return ids[member], ids[label[member]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = stars(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def connected_components(links: DataFrame, contract: bool = True) -> DataFrame:
    """(node, component) for every node that has a link to another; component is the smallest reachable node.

    ``contract`` first joins the links of each batch in Python; leave it out for links that come from a
    Python operator in the same stage, which would hold a second worker for each task.

    ``links`` has two long columns; nulls and self-links are ignored, repeats and either direction
    are fine. An empty table gives an empty table.
    """
    if contract:
        a, b = links.columns
        links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("long"), F.col(b).cast("long")).mapInArrow(_contract, "u long, v long")
    return components(links)
