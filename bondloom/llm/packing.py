"""Filling containers of fixed capacity with neighbours along a space-filling curve."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondloom.llm.tokens import FOLDER, VOCABULARY, token_ids
from bondloom.session import checkpointed

#: Dimensions of the projection, bits of each on the curve, and hashing buckets of tokens.
DIMS, BITS, BUCKETS = 4, 8, 1 << 16
#: Containers that are filled at a time from neighbouring documents, and documents at least.
WINDOW, WINDOW_ITEMS = 64, 2048
#: A container so full is closed; the documents of others meet the next neighbours.
FULL = 0.97


def projection() -> np.ndarray:
    """Signs that project hashed token counts to DIMS dimensions."""
    return np.random.default_rng(7).choice(np.array([-1.0, 1.0], dtype=np.float32), size=(BUCKETS, DIMS))


def vectors(documents: DataFrame, doc_id: str, text: str, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, v0...): size and projected vector of each document."""
    names = [f"v{i}" for i in range(DIMS)]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signs = projection()
        for batch in batches:
            sizes, rows = [], []
            for t in batch["t"]:
                ids = token_ids(t, folder, vocabulary)
                kinds = np.unique(ids) * 2654435761 % BUCKETS
                sizes.append(len(ids))
                rows.append(signs[kinds].sum(axis=0) / np.sqrt(max(1, len(kinds))))
            out = pd.DataFrame(np.array(rows, dtype=np.float64).reshape(-1, DIMS), columns=names)
            out.insert(0, "n_tokens", np.array(sizes, dtype=np.int64))
            out.insert(0, "doc_id", batch["i"].to_numpy())
            yield out

    slim = documents.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).where("i is not null")
    return slim.mapInPandas(measure, f"doc_id long, n_tokens long, {', '.join(f'{n} double' for n in names)}")


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) with whole coordinates under 2**bits."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    # Coordinates are turned into the curve's own from the coarsest bit down, then into a
    # Gray code whose bits, taken crosswise, are the place.
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in range(dims):
            high = (x[axis] >> bit) & 1 == 1
            swap = (x[0] ^ x[axis]) & low
            x[0] ^= np.where(high, low, swap)
            if axis:
                x[axis] ^= np.where(high, 0, swap)
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[dims - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flips
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(dims):
            place = (place << 1) | ((x[axis] >> bit) & 1)
    return place


def curve_keys(measured: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, curve) from ``vectors``. Coordinates are spread evenly over the
    grid by the corpus' mean and deviation, one small row for all documents."""
    names = [f"v{i}" for i in range(DIMS)]
    row = measured.agg(*[f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([row[f"avg_{n}"] or 0.0 for n in names])
    deviation = np.array([row[f"stddev_pop_{n}"] or 1.0 for n in names])

    @F.pandas_udf("long")
    def key(*columns: pd.Series) -> pd.Series:
        z = (np.column_stack([c.to_numpy() for c in columns]) - mean) / deviation
        even = 1 / (1 + np.exp(-1.702 * z))  # close to the normal distribution's share
        return pd.Series(hilbert(np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)))

    return measured.select("doc_id", "n_tokens", key(*names).alias("curve"))


def fill(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Positions of ``sizes`` by container: the largest first, each where it fits best."""
    rooms: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = bisect_left(rooms, (sizes[k], -1))
        if at == len(rooms):
            bins.append([])
            room, b = capacity, len(bins) - 1
        else:
            room, b = rooms.pop(at)
        bins[b].append(k)
        if room > sizes[k]:
            insort(rooms, (room - sizes[k], b))
    return bins


class Packer:
    """Fills containers of one capacity from a stream of documents in curve order."""

    def __init__(self, kind: str, capacity: int, label: str) -> None:
        self.kind, self.capacity, self.label, self.made = kind, capacity, label, 0
        self.waiting: list[tuple[int, int, int]] = []
        self.held = 0

    def _close(self, items: list[tuple[int, int, int]]) -> list[tuple]:
        name = f"{self.kind}-{self.label}-{self.made:07d}"
        self.made += 1
        return [(self.kind, name, doc, piece, size) for doc, piece, size in items]

    def add(self, doc: int, size: int) -> list[tuple]:
        rows, piece = [], 0
        while size > self.capacity:
            rows += self._close([(doc, piece, self.capacity)])
            piece, size = piece + 1, size - self.capacity
        if size:
            self.waiting.append((doc, piece, size))
            self.held += size
        if self.held >= WINDOW * self.capacity and len(self.waiting) >= WINDOW_ITEMS:
            rows += self.flush(FULL)
        return rows

    def flush(self, least: float = 0.0) -> list[tuple]:
        """Closes the containers that are ``least`` full; their rows."""
        rows, kept, again = [], [], []
        for chosen in fill([size for _, _, size in self.waiting], self.capacity):
            items = [self.waiting[k] for k in chosen]
            full = sum(size for _, _, size in items) >= least * self.capacity
            if full:
                rows += self._close(items)
            else:
                again.append(items)
        # Documents that keep finding no partners must not pile up: of the open containers
        # only the last half window waits on.
        again.sort(key=lambda items: sum(size for _, _, size in items))
        spare = max(1, WINDOW // 2)
        for items in again[spare:]:
            rows += self._close(items)
        for items in again[:spare]:
            kept += items
        self.waiting, self.held = kept, sum(size for _, _, size in kept)
        return rows


PACKED = "container_kind string, container_id string, doc_id long, piece int, n_tokens long"


def pack_along_curve(keyed: DataFrame, capacities: dict[str, int], partitions: int | None = None) -> DataFrame:
    """(container_kind, container_id, doc_id, piece, n_tokens): a row for each document, or
    piece of one longer than the capacity, in each kind of container.

    ``keyed`` is from ``curve_keys``. It is range-sorted by curve and id, so equal texts too
    are spread over tasks, and each task fills containers from its stretch of the curve,
    at most a window of documents in memory. Every token is placed exactly once per kind.
    Documents without tokens take no room and are left out; repeated ids are separate
    documents; an empty table gives no rows.
    """
    if partitions is None:
        partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.where("n_tokens > 0").repartitionByRange(partitions, "curve", "doc_id", "n_tokens").sortWithinPartitions("curve", "doc_id", "n_tokens")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        label = f"{TaskContext.get().partitionId():05d}"
        packers = [Packer(kind, capacity, label) for kind, capacity in sorted(capacities.items())]
        columns = [c.split()[0] for c in PACKED.split(", ")]
        for batch in batches:
            pairs = list(zip(batch["doc_id"].tolist(), batch["n_tokens"].tolist()))
            yield pd.DataFrame([row for p in packers for doc, size in pairs for row in p.add(doc, size)], columns=columns)
        rows = []
        for p in packers:
            while p.waiting:
                rows += p.flush()
        yield pd.DataFrame(rows, columns=columns)

    return ordered.mapInPandas(pack, PACKED)


def packed(documents: DataFrame, containers: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """``documents`` packed into every kind of ``containers`` (kind, capacity; a short list).

    Texts are measured once; their sizes and vectors are written and read again, as both
    the curve's scale and its range boundaries need them.
    """
    capacities = {r["container_kind"]: r["capacity_tokens"] for r in containers.select("container_kind", "capacity_tokens").dropna().collect()}
    measured = checkpointed(vectors(documents, doc_id, text, folder, vocabulary))
    return pack_along_curve(curve_keys(measured), capacities)
