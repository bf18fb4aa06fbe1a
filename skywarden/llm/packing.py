"""Best-fit packing by minimum bin slack over the lengths of the pieces."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.llm.common import ranked, ship_package, staged
from skywarden.llm.tokens import encoded


def document_pieces(docs: DataFrame, vocab_path: str, end_id: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents as pieces of up to ``capacity`` ids.

    Only a document of more than ``capacity`` ids is cut, into pieces of
    that size; its first piece holds what is left over.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoded(part, 1, vocab_path, end_id)):
                    n, start, k = len(ids) // 4, 0, 0
                    while start < n:
                        end = start + ((n - start) % capacity or capacity)
                        cut = ids[4 * start:4 * end]
                        rows.append((doc_id, k, start, end - start, zlib.crc32(cut), cut))
                        start, k = end, k + 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(list(zip(*rows))[:5] if rows else [[]] * 5, kinds)]
                if keep_ids:
                    columns.append(pa.array([np.frombuffer(r[5], "<u4").astype(np.int32) for r in rows],
                                            pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names[:len(columns)])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths out of ``counts`` whose sum comes as near to ``room`` as any can.

    Subset sums are bits of one integer; longer lengths are added first
    and the search ends as soon as ``room`` itself is reached.
    """
    sums, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, sums))
            sums = (sums | sums << (length * take)) & full
            left, take = left - take, 2 * take
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen += [length] * take
            at -= length * take
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, how many such bins), for all pieces of the histogram.

    Minimum bin slack: each bin takes the longest length left and the
    fullest combination that goes with it; the same combination is used
    for as many bins as the counts allow.  The work depends on the number
    of different lengths, at most ``capacity``, and not on that of pieces.
    """
    left, plan = {k: v for k, v in histogram.items() if v}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = [longest, *fullest({k: v for k, v in left.items() if v}, capacity - longest)]
        left[longest] += 1
        uses = Counter(chosen)
        times = min(left[k] // n for k, n in uses.items())
        plan.append((chosen, times))
        for k, n in uses.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _places(plan: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first bin, uses in a bin and first offset of its runs of bins."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: Counter = Counter()
    first_bin = 0
    for chosen, times in plan:
        offset = 0
        for length, uses in sorted(Counter(chosen).items(), reverse=True):
            runs.setdefault(length, []).append((taken[length], first_bin, uses, offset))
            taken[length] += uses * times
            offset += uses * length
        first_bin += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def pack(docs: DataFrame, vocab_path: str, end_id: int = 2, capacity: int = 1024, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Pieces go into sequences of at most ``capacity`` ids.  Only the
    histogram of lengths, at most ``capacity`` numbers, comes to the
    driver; the plan made of it goes back to the tasks, which find the
    place of each piece from its rank among the pieces of its length.

    A null or empty text is a document of the end id alone.  Rows are
    packed one by one, whether or not doc_id is null or repeated.  Other
    columns are not read.  An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    found = document_pieces(docs, vocab_path, end_id, capacity, keep_ids)
    # The ids stay where they are written; only the narrow rows, under a number of their own, are ranked and placed.
    found = staged(found.withColumn("__row", F.monotonically_increasing_id()) if keep_ids else found, "pack-pieces")
    narrow = found.drop("ids")
    histogram = {r["length"]: r["n"] for r in narrow.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(plan_bins(histogram, capacity))
    placed = ranked(narrow, ["length"], ["doc_id", "piece", "start"], "__rank")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            bins, offsets = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            lengths, ranks = rows["length"].to_numpy(), rows.pop("__rank").to_numpy()
            order = np.argsort(lengths, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(rows) else []:
                length = lengths[group[0]]
                first_rank, first_bin, uses, offset = places[int(length)]
                at = np.searchsorted(first_rank, ranks[group], "right") - 1
                nth = ranks[group] - first_rank[at]
                bins[group] = first_bin[at] + nth // uses[at]
                offsets[group] = offset[at] + nth % uses[at] * length
            yield rows.assign(sequence_id=bins, offset=offsets)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", __row long" * keep_ids
    out = placed.mapInPandas(run, schema + ", sequence_id long, offset long")
    if keep_ids:
        out = out.join(found.select("__row", "ids"), "__row").select(
            "doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")
    return out
