"""SimHash near-duplicates by pigeonhole blocks (operator 12).

A text's fingerprint takes bit b if more than half of its word shingles' hashes
have it. Two fingerprints of at most ``NEAR`` differing bits, cut into
``m > NEAR`` blocks, agree on ``m - NEAR`` of them, so every choice of that many
blocks is one table in which close fingerprints share a cell. ``m`` grows with
the logarithm of the number of distinct fingerprints, so that cells stay small.

Cells, not documents, are the unit of work: copies of a fingerprint are one row.
A crowded cell is cut again by the same pigeonhole over its free bits, until it
has at most ``CELL`` members (a cell with 11 free bits cannot have more); so no
task meets an unbounded group, and no pair is lost. Inside a cell, tests are
numpy passes; only links that join something new leave it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigcast.llm.common import HOT_SHARE, components, hot_join, stage, table, text_batches
from rigcast.llm.textnum import Flat, chunks, runs

NEAR = 3                # differing bits of a link
SHINGLE = 3             # words
SEED = 42
CELL = 2048             # most fingerprints compared within one cell
PIECE = 1 << 20         # bytes of a long text that are hashed at once
_LANES = np.uint64(0x0101010101010101)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ------------------------------------------------------------- fingerprints

def shingle_hashes(texts: list, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every ``k``-word shingle, repeats included, and each text's first
    one (n + 1 entries). Fewer words: the whole sequence; none: no hash."""
    flat = Flat(texts, lower=True)
    lo, hi, first = flat.words()
    n = np.diff(first)
    gap = (flat.buf == 32) | ((flat.buf >= 9) & (flat.buf <= 13))
    keep = ~gap
    keep[hi] = True                                    # one separator after every word
    raw = np.where(gap, np.uint8(32), flat.buf)[keep].tobytes()
    ends = np.cumsum(hi - lo + 1) - 1
    starts = ends - (hi - lo)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    upto = np.r_[0, np.cumsum(count)]
    at = np.repeat(first[:-1] - upto[:-1], count) + np.arange(int(upto[-1]))
    last = at + np.repeat(np.minimum(n, k), count) - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(raw[a:b], SEED) for a, b in zip(starts[at].tolist(), ends[last].tolist())), np.uint64, len(at)), upto


def bit_counts(h: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, per text (rows)."""
    out = np.zeros((len(upto) - 1, 64), np.int64)
    size = np.diff(upto)
    full = np.flatnonzero(size)
    if not len(full):
        return out
    parts = -(-size[full] // 255)                      # a byte lane counts to 255
    begin = np.r_[0, np.cumsum(parts)]
    within = np.arange(int(begin[-1])) - np.repeat(begin[:-1], parts)
    cuts = np.repeat(upto[:-1][full], parts) + 255 * within
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & _LANES, cuts)
        out[np.ix_(full, np.arange(j, 64, 8))] = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), begin[:-1], axis=0)
    return out


def _long_counts(text: str) -> tuple[np.ndarray, int]:
    """Bit counts and number of shingles of one long text, worked through in pieces."""
    raw = text.encode("utf-8", "surrogatepass")
    counts, total, carry, at, short = np.zeros(64, np.int64), 0, b"", 0, b""
    while at < len(raw):
        cut = _SPACE.search(raw, min(at + PIECE, len(raw)))
        stop = cut.end() if cut else len(raw)
        words = (carry + raw[at:stop]).split()
        if len(words) >= SHINGLE:
            h, upto = shingle_hashes([(carry + raw[at:stop]).decode("utf-8", "surrogatepass")])
            counts += bit_counts(h, upto)[0]
            total += len(h)
        carry = b"".join(w + b" " for w in words[-(SHINGLE - 1):])
        short = carry
        at = stop
    if not total and short:                            # one or two very long words
        h, upto = shingle_hashes([short.decode("utf-8", "surrogatepass")])
        return bit_counts(h, upto)[0], len(h)
    return counts, total


def fingerprints(texts: list) -> np.ndarray:
    """The 64-bit fingerprint of every text (no word: zero)."""
    small = [t if t is None or len(t) <= PIECE else None for t in texts]
    h, upto = shingle_hashes(small)
    counts, total = bit_counts(h, upto), np.diff(upto)
    for i, t in enumerate(texts):
        if t is not None and len(t) > PIECE:
            counts[i], total[i] = _long_counts(t)
    bits = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches, "text"):
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fingerprints(b.column("text").to_pylist()).view(np.int64))],
                                         names=["doc_id", "fp"])


# -------------------------------------------------------------------- cells

def cut_bits(free: int, blocks: int) -> list[int]:
    """The set bits of ``free`` in ``blocks`` masks of nearly equal size."""
    places = [i for i in range(64) if free >> i & 1]
    edges = [len(places) * j // blocks for j in range(blocks + 1)]
    return [sum(1 << p for p in places[a:b]) for a, b in zip(edges, edges[1:])]


def tables(distinct: int) -> list[int]:
    """Masks of the first cells: the fewest blocks whose shared bits number the fingerprints."""
    blocks = NEAR + 1
    while blocks < 12 and distinct > 4 << (64 // blocks * (blocks - NEAR)):
        blocks += 1
    return [sum(c) for c in combinations(cut_bits((1 << 64) - 1, blocks), blocks - NEAR)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Links:
    """Collects links between the rows of a batch; only those that join two classes are kept."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.a, self.b = [], []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            x, y = self.label[i], self.label[j]
            on = x != y
            i, j, x, y = i[on], j[on], x[on], y[on]
            if not len(i):
                return
            big, at = np.unique(np.maximum(x, y), return_index=True)     # every class hooks to one smaller class
            self.a.append(i[at])
            self.b.append(j[at])
            up = np.arange(len(self.label))
            up[big] = np.minimum(x, y)[at]
            while True:
                higher = up[up]
                if (higher == up).all():
                    break
                up = higher
            self.label = up[self.label]


def cell_links(fp: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside cells; row i's cell ends before row ``stop[i]``."""
    links = Links(len(fp))
    at, step, held, pending = np.arange(len(fp)), 1, 0, []
    while True:
        at = at[at + step < stop[at]]
        if not len(at):
            break
        close = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= NEAR]
        if len(close):
            pending.append((close, close + step))
            held += len(close)
        if held > 1 << 20:
            links.add(*map(np.concatenate, zip(*pending)))
            held, pending = 0, []
        step += 1
    if pending:
        links.add(*map(np.concatenate, zip(*pending)))
    if not links.a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return fp[np.concatenate(links.a)], fp[np.concatenate(links.b)]


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("mask", pa.int64())])


def _found(a: np.ndarray, b: np.ndarray | None, mask: np.ndarray | None) -> pa.RecordBatch:
    empty = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), empty if b is None else pa.array(b.view(np.int64)),
                                       empty if mask is None else pa.array(mask)], schema=_FOUND)


def _work_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``mask, value, fp`` in the order of their cells. Gives links, and the members of crowded cells with their mask."""
    held = (np.empty(0, np.int64),) * 3
    crowded = None                                     # the cell whose members pass through
    def finish(mask, value, fp):
        edge = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]) if len(mask) else np.empty(0, np.int64)
        size = np.diff(np.r_[edge, len(mask)])
        on = np.repeat((size > 1) & (size <= CELL), size)
        much = np.repeat(size > CELL, size)
        if much.any():
            yield _found(fp[much], None, mask[much])
        if on.any():
            size = size[(size > 1) & (size <= CELL)]
            a, b = cell_links(fp[on].view(np.uint64), np.repeat(np.cumsum(size), size))
            if len(a):
                yield _found(a, b, None)

    for batch in batches:
        mask, value, fp = (np.r_[h, batch.column(c).to_numpy()] for h, c in zip(held, ("mask", "value", "fp")))
        if not len(mask):
            continue
        if crowded is not None:
            same = (mask == crowded[0]) & (value == crowded[1])
            if same.any():
                yield _found(fp[same], None, mask[same])
                mask, value, fp = mask[~same], value[~same], fp[~same]
            if not len(mask):
                held = (mask, value, fp)
                continue
            crowded = None
        last = int(np.flatnonzero((mask == mask[-1]) & (value == value[-1]))[0])
        yield from finish(mask[:last], value[:last], fp[:last])
        held = (mask[last:], value[last:], fp[last:])
        if len(held[0]) > CELL:
            crowded = (held[0][0], held[1][0])
            yield _found(held[2], None, held[0])
            held = (np.empty(0, np.int64),) * 3
    yield from finish(*held)


def _cut_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members ``a`` of crowded cells with their ``mask``: one row for each block of free bits added to the mask."""
    children: dict[int, list[int]] = {}
    for b in batches:
        fp, mask = b.column("a").to_numpy(), b.column("mask").to_numpy()
        for m in np.unique(mask).tolist():
            wide = m & ((1 << 64) - 1)
            children.setdefault(m, [signed(wide | x) for x in cut_bits(~wide & ((1 << 64) - 1), NEAR + 1)])
        for j in range(NEAR + 1):
            new = np.array([children[m][j] for m in mask.tolist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(new), pa.array(fp)], names=["mask", "fp"])


def close_links(prints: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that connect all pairs of at most ``NEAR`` differing bits."""
    total = prints.count()
    masks = F.array(*[F.lit(signed(m)).cast("long") for m in tables(total)])
    rows = prints.select(F.explode(masks).alias("mask"), "fp")
    links = None
    while True:
        cells = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        # cells with more than a thousandth of all fingerprints: bounded in number, cut at once and never in one task
        hot = stage(cells.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("c"))
                    .where((F.col("c") > CELL) & (F.col("c") * HOT_SHARE > total)).select("mask", "value"), "hot_cells")
        warm = F.broadcast(hot)
        tried = cells.join(warm, ["mask", "value"], "left_anti").repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
        found = stage(tried.mapInArrow(_work_cells, "a long, b long, mask long"), "cells")
        new = found.where("mask is null").select("a", "b")
        links = new if links is None else links.union(new)
        left = found.where("mask is not null").select("a", "mask") \
            .union(cells.join(warm, ["mask", "value"]).select(F.col("fp").alias("a"), "mask"))
        if left.isEmpty():
            return links
        rows = stage(left.mapInArrow(_cut_cells, "mask long, fp long"), "cut_cells")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    Shingles are of three words (A-Z lower-cased; fewer words: the whole
    sequence). Null, empty and wordless texts have the fingerprint zero, which
    links like any other. ``component_id`` is the smallest id reachable by
    links of at most three bits. Repeated ids are separate rows. Rows without
    an id take part in links and get their component's id (null if no row of it
    has one). Extra columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with text_batches(spark):
        known = stage(base.mapInArrow(_fingerprint_rows, "doc_id long, fp long"), "fingerprints")
    prints = stage(known.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("c")), "prints")
    parts = stage(components(close_links(prints.select("fp"))), "parts")
    named = prints.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    named = stage(named, "named")
    least = stage(named.groupBy("comp").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members")), "least")
    whole = hot_join(named.select("fp", "c", "comp"), least, "comp", "members", named.count()).select("fp", "c", "component_id")
    return hot_join(known, stage(whole, "whole"), "fp", "c", known.count()) \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash_components(table(spark, sf_dir, "documents"))
