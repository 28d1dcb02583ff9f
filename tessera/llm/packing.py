"""Operator 2: packing documents into sequences by Karmarkar-Karp multiway differencing.

Whole windows of a document are sequences of their own; the rest of each document (shorter
than a window) is packed in blocks of about ``block_tokens`` tokens inside each task: the
differencing method merges partial partitions with opposing imbalances until one partition
into near-equal windows is left. The window count is the least that holds the block's tokens
and rises when a window exceeds the capacity; what still stands over in a window is cut off
and fills the rooms of the others, so padding stays within one or two windows a block.
A task holds one Arrow batch and one block; nothing is shuffled.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.pretokens import encoder, tokenizer_spec


def karmarkar_karp(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Items (positive sizes) dealt to ``windows`` windows with near-equal sums; lists of items.

    A partial partition is (sums, nodes), largest first, without its empty windows. The two
    with the widest spread are merged: the fullest window of one meets the emptiest of the
    other. Nodes are leaves (items) or pairs of nodes.
    """
    n, m = len(sizes), windows
    left, right = [-1] * n, [-1] * n
    heap = [(-int(s), i, np.array([s], "int64"), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, sa, na = heapq.heappop(heap)
        _, _, sb, nb = heapq.heappop(heap)
        if len(sa) + len(sb) <= m:
            s, nodes = np.concatenate([sa, sb]), np.concatenate([na, nb])
        else:
            both = len(sa) + len(sb) - m  # windows that aren't empty on either side
            ka, kb = len(sa) - both, len(sb) - both
            new = np.arange(len(left), len(left) + both)
            left.extend(na[ka:].tolist())
            right.extend(nb[kb:][::-1].tolist())
            s = np.concatenate([sa[:ka], sa[ka:] + sb[kb:][::-1], sb[:kb]])
            nodes = np.concatenate([na[:ka], new, nb[:kb]])
        order = np.argsort(-s, kind="stable")
        s, nodes = s[order], nodes[order]
        heapq.heappush(heap, (-int(s[0] - (s[-1] if len(s) == m else 0)), tie, s, nodes))
        tie += 1
    out = []
    for root in heap[0][3].tolist() if heap else []:
        items, stack = [], [root]
        while stack:
            x = stack.pop()
            if left[x] < 0:
                items.append(x)
            else:
                stack += [left[x], right[x]]
        out.append(sorted(items))
    return out


def pack_sizes(sizes: list[int], capacity: int, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, start, length) of at most ``capacity`` in sum.

    With ``cut=False`` no item is cut and the window count rises until all fit (each size must
    be within the capacity). With ``cut`` it rises once, and what is still over is cut off and
    put into the rooms, the largest room first.
    """
    items = np.asarray(sizes, "int64")
    if not len(items):
        return []
    if not cut and items.max() > capacity:
        raise ValueError("an item exceeds the capacity")
    m = max(1, -(-int(items.sum()) // capacity))
    rises = 0
    while True:
        dealt = karmarkar_karp(items, m)
        over = max(int(items[w].sum()) for w in dealt) > capacity
        if not over or (cut and rises):
            break
        m, rises = m + 1, rises + 1
    windows = [[(i, 0, int(items[i])) for i in w] for w in dealt] + [[] for _ in range(m - len(dealt))]
    if not over:
        return windows
    spare: list[tuple[int, int, int]] = []
    for w in windows:
        excess = sum(p[2] for p in w) - capacity
        while excess > 0:
            i, start, length = w.pop()
            off = min(excess, length)
            if off < length:
                w.append((i, start, length - off))
            spare.append((i, start + length - off, off))
            excess -= off
    rooms = [(sum(p[2] for p in w) - capacity, k) for k, w in enumerate(windows)]
    rooms = [r for r in rooms if r[0] < 0]
    heapq.heapify(rooms)
    for i, start, length in sorted(spare, key=lambda p: -p[2]):
        while length:
            room, k = heapq.heappop(rooms)
            put = min(-room, length)
            windows[k].append((i, start, put))
            if room + put < 0:
                heapq.heappush(rooms, (room + put, k))
            start, length = start + put, length - put
    return windows


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         end_id: int = 0, block_tokens: int = 262_144, with_ids: bool = False,
         cache_entries: int = 1_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` the piece's ids.

    A document is its ids and ``end_id``; each id lies in one piece. Null and empty texts are
    the end id alone; repeated rows are packed each; other columns are ignored; an empty table
    gives no piece. Sequence ids are unique: the task's number and a count within it. A worker
    keeps at most ``cache_entries`` encoded pre-tokens.
    """
    types = dict(docs.dtypes)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((uuid.uuid4().hex, tokenizer_spec(tokenizer)))
    end = int(end_id).to_bytes(4, "little")
    schema = (f"doc_id {types[id_col]}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids binary" if with_ids else ""))
    names = [x.split()[0] for x in schema.split(", ")]

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(*shared.value, cache_entries=cache_entries)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        rest: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        held = 0

        def piece(doc, start, ids, n, seq, offset):
            rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), n, seq, offset) + ((ids,) if with_ids else ()))

        def flush():
            nonlocal sequence, held
            for w in pack_sizes([len(r[2]) // 4 for r in rest], capacity):
                offset = 0
                for i, start, length in w:
                    doc, at, ids, n = rest[i]
                    piece(doc, at + start, ids[4 * start : 4 * (start + length)], n, sequence, offset)
                    offset += length
                sequence += bool(w)
            rest.clear()
            held = 0

        for b in batches:
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = (bpe.ids(text) if text else b"") + end
                n = len(ids) // 4
                whole = n // capacity * capacity
                for start in range(0, whole, capacity):
                    piece(doc, start, ids[4 * start : 4 * (start + capacity)], n, sequence, 0)
                    sequence += 1
                if whole < n:
                    rest.append((doc, whole, ids[4 * whole :], n))
                    held += n - whole
                if held >= block_tokens:
                    flush()
            if rows:
                yield pd.DataFrame(rows, columns=names, dtype=object)
                rows.clear()
        flush()
        if rows:
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(per_task, schema)
