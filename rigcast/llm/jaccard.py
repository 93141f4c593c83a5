"""N-gram Jaccard join with signature trees (operator 5).

A document's set holds the hashes of its distinct word shingles. Two
documents link when the Jaccard similarity of their sets reaches the
threshold (exact integer test on whole sets); the result is the connected
components of all links.

Plan, every step a Spark job over bounded blocks:

1. **Top of the tree.** One pass over the texts builds the sets. The corpus
   node is the OR over all documents of their tokens, kept as exact token
   lists dealt by hash range instead of one bitmap, with a mark "in two sets
   or more". A document whose tokens outside this mark leave a maximum
   possible overlap below the threshold cannot link and leaves here. A token
   is sent at most once per block of documents, however common it is.
2. **Equal sets** become one node (128-bit set digest).
3. **Signature trees.** Nodes that share a min-hash meet in blocks of bounded
   size; inside a block, leaves carry token bitmaps, inner nodes the OR of
   their children's bitmaps, the size range and the largest surplus of tokens
   over bits. Dual traversal from (root, root) drops a pair of nodes when
   ``popcount(or_p & or_q) + min(surplus)`` or the size ranges cannot reach
   the needed overlap, or when both are already one component. Surviving
   leaf pairs are tested on the whole sets. The found links collapse groups
   of near copies.
4. **Completion.** A set can only link with another component when enough of
   its tokens are in a set of another one: a second pass over the tokens, dealt
   like those of the first, leaves out all others, however many tokens long
   documents share by chance. Of the rest, two linked sets share one of the
   ``n - ceil(t n) + 1`` smallest tokens of each. Where such a token still joins different
   components, its holders meet again under the smallest of them (in pairs of
   bounded blocks where they are many) for the same traversal and the same
   test on the whole sets. So no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigcast.llm.common import components, id_bits, id_hits, id_place, shuffle_width, small_batches, stage, table
from rigcast.llm.textnum import chunks, give_back, mix64, runs, shingles

BITS = 1024          # bitmap of a leaf
WIDE = 4096          # bitmap that decides which pairs of leaves are compared in full
FANOUT = 8           # children of an inner node
BLOCK = 1024         # rows that meet in one task's tree
PART = 1 << 25       # code points of text whose tokens meet in one task of the first pass
RANGES = 256         # hash ranges of the first pass while a task's tokens are fewer; each block sends a message to each
MEET = 1 << 22       # tokens that meet in one task of the second pass
LEVELS = 2           # rounds of gathering, each by its own min-hash: members, then representatives
MULT = [np.uint64(x) for x in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


# ------------------------------------------------------------ signature tree

def bitmaps(first: np.ndarray, tokens: np.ndarray, bits: int = BITS) -> np.ndarray:
    """One row of ``bits`` packed bits per set."""
    n = len(first) - 1
    out = np.zeros((n, bits), np.uint8)
    rows = np.repeat(np.arange(n), np.diff(first))
    out[rows, (mix64(tokens) % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(out, axis=1).view(np.uint64)


class SignatureTree:
    """Leaves in the given order; level 0 are the leaves, the last one the root."""

    def __init__(self, sig: np.ndarray, size: np.ndarray, comp: np.ndarray):
        extra = size - np.bitwise_count(sig).sum(axis=1).astype(np.int64)
        self.levels = [(sig, size, size, extra, comp)]
        while len(self.levels[-1][0]) > 1:
            s, lo, hi, ex, c = self.levels[-1]
            at = np.arange(0, len(s), FANOUT)
            same = np.minimum.reduceat(c, at)
            same = np.where(same == np.maximum.reduceat(c, at), same, -1)
            self.levels.append((np.bitwise_or.reduceat(s, at, axis=0), np.minimum.reduceat(lo, at),
                                np.maximum.reduceat(hi, at), np.maximum.reduceat(ex, at), same))

    def pairs(self, other: SignatureTree, num: int, den: int, step: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Leaf pairs (own, other) that no bound excludes, in bounded batches.
        With itself, each unordered pair appears once."""
        alone = self is other
        top = max(len(self.levels), len(other.levels)) - 1
        zero = np.zeros(1, np.int64)
        stack = [(top, zero, zero)]
        while stack:
            level, p, q = stack.pop()
            a = self.levels[min(level, len(self.levels) - 1)]
            b = other.levels[min(level, len(other.levels) - 1)]
            need = -(-num * (a[1][p] + b[1][q]) // (num + den))
            ok = (den * a[2][p] >= num * b[1][q]) & (den * b[2][q] >= num * a[1][p])
            ok &= (a[4][p] < 0) | (a[4][p] != b[4][q])
            if alone:
                ok &= (p < q) if level == 0 else (p <= q)
            p, q, need = p[ok], q[ok], need[ok]
            most = np.bitwise_count(a[0][p] & b[0][q]).sum(axis=1).astype(np.int64)
            ok = most + np.minimum(a[3][p], b[3][q]) >= need
            p, q = p[ok], q[ok]
            if not len(p):
                continue
            if level == 0:
                yield p, q
                continue
            na = len(self.levels[min(level - 1, len(self.levels) - 1)][0])
            nb = len(other.levels[min(level - 1, len(other.levels) - 1)][0])
            grow_a, grow_b = level < len(self.levels), level < len(other.levels)
            ka = np.arange(FANOUT if grow_a else 1)
            kb = np.arange(FANOUT if grow_b else 1)
            for i in range(0, len(p), step // (FANOUT * FANOUT)):
                pp, qq = p[i:i + step // (FANOUT * FANOUT)], q[i:i + step // (FANOUT * FANOUT)]
                cp = (pp * (FANOUT if grow_a else 1))[:, None, None] + ka[None, :, None]
                cq = (qq * (FANOUT if grow_b else 1))[:, None, None] + kb[None, None, :]
                cp, cq = np.broadcast_arrays(cp, cq)
                cp, cq = cp.ravel(), cq.ravel()
                ok = (cp < na) & (cq < nb)
                stack.append((level - 1, cp[ok], cq[ok]))


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Jaccard(a, b) >= num/den for ascending distinct token arrays."""
    small, big = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(big, small)
    at[at == len(big)] = 0
    both = int((big[at] == small).sum()) if len(big) else 0
    return both > 0 and den * both >= num * (len(a) + len(b) - both)


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def block_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning set of links of one block: neighbours in size order first,
    then dual traversal of the block's signature tree between components."""
    n = len(sets)
    if n < 2:
        return []
    size = np.array([len(s) for s in sets], np.int64)
    out, forest = [], Forest(n)

    def test(i: int, j: int) -> None:
        if forest.find(i) != forest.find(j) and linked(sets[i], sets[j], num, den):
            forest.union(i, j)
            out.append((i, j))

    order = np.argsort(size, kind="stable")
    mid = int(order[n // 2])
    for x, y in zip(order[:-1], order[1:]):
        test(int(x), int(y))
        test(mid, int(y))
    comp = np.array([forest.find(i) for i in range(n)], np.int64)
    if (comp == comp[0]).all():
        return out
    order = np.lexsort((size, comp))
    first = np.r_[0, np.cumsum(size[order])]
    sig = bitmaps(first, np.concatenate([sets[i] for i in order]))
    tree = SignatureTree(sig, size[order], comp[order])
    for p, q in tree.pairs(tree, num, den):
        for i, j in zip(order[p].tolist(), order[q].tolist()):
            test(i, j)
    return out


# ------------------------------------------------------------------ step 1

_DEALT = "pid int, block string, n_docs int, counts binary, tokens binary, comps binary, ids binary, sizes binary, keys binary, local binary"
_EMPTY = dict.fromkeys(("counts", "tokens", "comps", "ids", "sizes", "keys", "local"))


def _packed(x: np.ndarray) -> bytes:
    """Counts in the fewest bytes each."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0)))).tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}")


def _messages(send: np.ndarray, whose: np.ndarray, n: int, parts: int, head: dict) -> list[dict]:
    """One message to each hash range: the low parts of its tokens and how many each of the ``n``
    documents sends; tokens of document ``n`` are known to be shared."""
    part = (send % np.uint64(parts)).astype(np.int64)
    low = (send // np.uint64(parts)).astype(np.uint32)
    order = np.lexsort((low, whose, part))
    part, low, whose = part[order], low[order], whose[order]
    return [_EMPTY | head | {"pid": int(part[s]), "tokens": low[s:e].tobytes(), "counts": _packed(np.bincount(whose[s:e], minlength=n + 1))}
            for s, e in zip(*runs(part))]


def _profile(id_col: str, text_col: str, k: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        for b in chunks(batches, text_col):
            tok, first = shingles(b.column(text_col).to_pylist(), k)
            ids = np.asarray(b.column(id_col).to_numpy(zero_copy_only=False), np.int64)
            size = np.diff(first)
            keys = [hashlib.blake2b(tok[s:e].tobytes(), digest_size=16).digest()
                    for s, e in zip(first[:-1].tolist(), first[1:].tolist())]
            block = f"{task}:{serial}:" + hashlib.blake2b(b"".join(keys), digest_size=8).hexdigest()
            serial += 1
            # one document per distinct set speaks for all its copies in this block
            _, rep, inv = np.unique(np.array([x.hex() for x in keys]), return_index=True, return_inverse=True)
            speaks = np.zeros(len(keys), bool)
            speaks[rep] = True
            doc = np.repeat(np.arange(len(keys)), size)
            on = speaks[doc]
            t, d = tok[on], doc[on]
            order = np.argsort(t, kind="stable")
            t, d = t[order], d[order]
            lo, hi = runs(t)
            many = hi - lo > 1
            holders = np.repeat(many, hi - lo)
            local = np.bincount(d[holders], minlength=len(keys))[rep][inv]
            once = ~many
            send = np.r_[t[lo[once]], t[lo[many]]]
            whose = np.r_[d[lo[once]], np.full(int(many.sum()), len(keys))]     # n_docs: "known to be shared"
            head = {"block": block, "n_docs": len(keys)}
            rows = _messages(send, whose, len(keys), parts, head)
            rows.append(_EMPTY | head | {"pid": serial % parts, "ids": ids.tobytes(), "sizes": size.astype(np.int64).tobytes(),
                                         "keys": b"".join(keys), "local": local.astype(np.int64).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_DEALT)
    return run


_ARROW_DEALT = pa.schema([("pid", pa.int32()), ("block", pa.string()), ("n_docs", pa.int32())]
                         + [(c, pa.binary()) for c in _EMPTY])
_ARROW_SHARED = pa.schema([("block", pa.string()), ("n_docs", pa.int32())]
                          + [(c, pa.binary()) for c in ("shared", "ids", "sizes", "keys", "local")])
_SHARED = "block string, n_docs int, shared binary, ids binary, sizes binary, keys binary, local binary"


def _meet(t: pa.Table) -> pa.Table:
    """Tokens of one hash range, from all blocks: how many of each document's are in another set,
    or, where the messages name components, in a set of another component."""
    rows = t.to_pylist()
    sent = [r for r in rows if r["tokens"] is not None]
    out = [{c: r[c] for c in ("block", "n_docs", "ids", "sizes", "keys", "local")} | {"shared": None}
           for r in rows if r["ids"] is not None]
    if sent:
        low = np.concatenate([np.frombuffer(r["tokens"], np.uint32) for r in sent])
        counts = [_unpacked(r["counts"], r["n_docs"] + 1) for r in sent]
        order = np.argsort(low, kind="stable")
        known = np.concatenate([np.repeat(np.arange(len(c)) == len(c) - 1, c) for c in counts])
        lo, hi = runs(low[order])
        twice = hi - lo > 1
        if sent[0]["comps"] is not None:
            comp = np.concatenate([np.repeat(np.r_[np.frombuffer(r["comps"], np.int64), 0], c) for r, c in zip(sent, counts)])[order]
            twice = np.minimum.reduceat(comp, lo) != np.maximum.reduceat(comp, lo)
        twice |= np.maximum.reduceat(known[order].astype(np.int8), lo).astype(bool)
        mark = np.empty(len(low), bool)
        mark[order] = np.repeat(twice, hi - lo)
        at = 0
        for r, c in zip(sent, counts):
            n = int(c.sum())
            who = np.repeat(np.arange(len(c)), c)[mark[at:at + n]]
            at += n
            got = np.bincount(who, minlength=len(c))[:-1]
            if got.any():
                out.append({"block": r["block"], "n_docs": r["n_docs"], "shared": _packed(got),
                            "ids": None, "sizes": None, "keys": None, "local": None})
    del rows, sent
    give_back()
    return pa.Table.from_pylist(out, schema=_ARROW_SHARED)


def _sum_block(num: int, den: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("alive", pa.bool_())])

    def run(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        info = next(r for r in rows if r["ids"] is not None)
        total = np.frombuffer(info["local"], np.int64).copy()
        keys = [info["keys"][i:i + 16] for i in range(0, len(info["keys"]), 16)]
        ids, size = np.frombuffer(info["ids"], np.int64), np.frombuffer(info["sizes"], np.int64)
        heard = np.zeros(len(keys), np.int64)
        for r in rows:
            if r["shared"] is not None:
                heard += _unpacked(r["shared"], len(keys))
        _, rep, inv = np.unique(np.array([x.hex() for x in keys]), return_index=True, return_inverse=True)
        speaker = np.zeros(len(rep), np.int64)
        np.add.at(speaker, inv, heard)          # only one copy in the block spoke
        total = total + speaker[inv]
        return pa.table({"doc_id": ids, "n": size, "key": pa.array(keys, pa.binary()),
                         "alive": (size > 0) & (den * total >= num * size)}, schema=schema)
    return run


def profile(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """``(doc_id, n, key, alive)`` per document: set size, set digest, and
    whether enough of its tokens occur in another set (or block copy) to link."""
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    # so neither a task's tokens nor the messages for each token grow with the corpus
    parts = max(min(2 * shuffle_width(docs.sparkSession), RANGES), -(-chars // PART))
    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_profile("id", "text", k, parts), _DEALT)
    met = dealt.groupBy("pid").applyInArrow(_meet, _SHARED)
    return met.groupBy("block").applyInArrow(_sum_block(num, den), "doc_id long, n long, key binary, alive boolean")


# ---------------------------------------------------------------- steps 3, 4

def wide_bits(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``WIDE`` packed bits per set."""
    out = np.zeros((len(sets), WIDE), np.uint8)
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    out[rows, (np.concatenate(sets) >> np.uint64(52)).astype(np.int64)] = 1
    return np.packbits(out, axis=1).view(np.uint64)


def _token_sets(k: int, bits):
    schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("tokens", pa.binary()), ("wide", pa.binary()),
                        *[(f"mh{j}", pa.int64()) for j in range(LEVELS)]])

    def run(batches):
        for b in batches:
            for c in chunks([b.filter(pa.array(id_hits(bits.value, b.column("at").to_numpy())))], "text"):
                tok, first = shingles(c.column("text").to_pylist(), k)
                rows = []
                for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
                    if e > s:
                        t = tok[s:e]
                        raw = t.tobytes()
                        rows.append({"key": hashlib.blake2b(raw, digest_size=16).digest(), "n": e - s, "tokens": raw, "wide": wide_bits([t])[0].tobytes()}
                                    | {f"mh{j}": int((t * MULT[j]).min().view(np.int64)) for j in range(LEVELS)})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _gather(num: int, den: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        keys = t.column("key").to_pylist()
        found = block_links([np.frombuffer(x, np.uint64) for x in t.column("tokens").to_pylist()], num, den)
        return pa.table({"a": pa.array([keys[i] for i, _ in found], pa.binary()),
                         "b": pa.array([keys[j] for _, j in found], pa.binary())}, schema=_LINKS)
    return run


def _gather_links(sets: DataFrame, chosen: DataFrame, level: int, num: int, den: int) -> DataFrame:
    """Links inside blocks of chosen sets that share a min-hash; a large group is split into blocks by key."""
    mh = sets.select("key", F.col(f"mh{level}").alias("mh")).join(chosen, "key", "left_semi")
    count = mh.groupBy("mh").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    place = mh.join(count, "mh").select("key", "mh", F.pmod(F.xxhash64("key"), F.ceil(F.col("c") / F.lit(BLOCK)).cast("long")).alias("salt"))
    return place.join(sets.select("key", "tokens"), "key").repartition("mh", "salt") \
        .groupBy("mh", "salt").applyInArrow(_gather(num, den), "a binary, b binary")


def _prefix(num: int, den: int):
    schema = pa.schema([("token", pa.int64()), ("key", pa.binary()), ("comp", pa.int64())])

    def run(batches):
        for b in batches:
            keys, comps, tokens, at, rows = b.column("key"), b.column("comp").to_numpy(), [], [], b.column("tokens").to_pylist()
            for i, raw in enumerate(rows):
                n = len(raw) // 8
                p = n - -(-num * n // den) + 1
                tokens.append(np.frombuffer(raw, np.int64, p))
                at.append(np.full(p, i))
            at = np.concatenate(at)
            for lo in range(0, len(at), 20_000):
                part = at[lo:lo + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)[lo:lo + 20_000]), keys.take(pa.array(part)),
                                                  pa.array(comps[part])], schema=schema)
    return run


class _Side:
    """One block of a meeting: its rows in tree order, and the tree over them."""

    def __init__(self, rows: list[dict], code: dict):
        self.rows = sorted(rows, key=lambda r: (code.setdefault(r["comp"], len(code)), r["n"], r["key"]))
        self.size = np.array([r["n"] for r in self.rows], np.int64)
        self.comp = np.array([code[r["comp"]] for r in self.rows], np.int64)
        self.wide = np.frombuffer(b"".join(r["wide"] for r in self.rows), np.uint64).reshape(len(self.rows), -1)
        self.spare = self.size - np.bitwise_count(self.wide).sum(axis=1)
        narrow = np.bitwise_or.reduce(self.wide.reshape(len(self.rows), WIDE // BITS, BITS // 64), axis=1)
        self.tree = SignatureTree(narrow, self.size, self.comp)


def _possible(t: pa.Table, num: int, den: int) -> Iterator[tuple[_Side, _Side, np.ndarray, np.ndarray, int]]:
    """Leaf pairs of a meeting that neither the trees nor the wide bitmaps exclude."""
    rows, code = t.to_pylist(), {}
    sides = sorted({r["side"] for r in rows})
    left = _Side([r for r in rows if r["side"] == sides[0]], code)
    right = left if len(sides) == 1 else _Side([r for r in rows if r["side"] == sides[1]], code)
    for p, q in left.tree.pairs(right.tree, num, den):
        need = -(-num * (left.size[p] + right.size[q]) // (num + den))
        most = np.bitwise_count(left.wide[p] & right.wide[q]).sum(axis=1).astype(np.int64) + np.minimum(left.spare[p], right.spare[q])
        on = most >= need
        if on.any():
            yield left, right, p[on], q[on], len(code)


_MEMBER = pa.schema([("meet", pa.binary()), ("p", pa.int64()), ("q", pa.int64()), ("side", pa.int64()), ("key", pa.binary()),
                     ("comp", pa.int64()), ("n", pa.int64()), ("wide", pa.binary())])


def _hopeful(num: int, den: int):
    """The rows of a meeting that are in any possible pair: only their whole sets have to move."""
    def run(t: pa.Table) -> pa.Table:
        out: dict = {}
        for left, right, p, q, _ in _possible(t, num, den):
            for side, at in ((left, p), (right, q)):
                out.update((side.rows[i]["key"], side.rows[i]) for i in np.unique(at).tolist())
        return pa.Table.from_pylist([out[k] for k in sorted(out)], schema=_MEMBER)
    return run


def _meet_links(num: int, den: int):
    """Links that connect the components of one meeting. Pairs whose components are connected are passed over."""
    def run(t: pa.Table) -> pa.Table:
        forest, a, b = None, [], []
        for left, right, p, q, n in _possible(t, num, den):
            forest = forest or Forest(n)
            for i, j, x, y in zip(p.tolist(), q.tolist(), left.comp[p].tolist(), right.comp[q].tolist()):
                u, v = left.rows[i], right.rows[j]
                if forest.find(x) != forest.find(y) and linked(np.frombuffer(u["tokens"], np.uint64), np.frombuffer(v["tokens"], np.uint64), num, den):
                    forest.union(x, y)
                    a.append(u["key"])
                    b.append(v["key"])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())}, schema=_LINKS)
    return run


def _spoken(parts: int):
    """The tokens of labelled sets for the second pass. A token that sets of two components in the block
    hold is counted here and sent once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        for b in chunks(batches, "tokens"):
            keys, raw = b.column("key").to_pylist(), b.column("tokens").to_pylist()
            comp = np.asarray(b.column("comp").to_numpy(zero_copy_only=False), np.int64)
            size = np.array([len(x) // 8 for x in raw], np.int64)
            t, d = np.frombuffer(b"".join(raw), np.uint64), np.repeat(np.arange(len(raw)), size)
            order = np.argsort(t, kind="stable")
            t, d = t[order], d[order]
            lo, hi = runs(t)
            many = np.minimum.reduceat(comp[d], lo) != np.maximum.reduceat(comp[d], lo)
            shared = np.repeat(many, hi - lo)
            send = np.r_[t[~shared], t[lo[many]]]
            whose = np.r_[d[~shared], np.full(int(many.sum()), len(keys))]
            head = {"block": f"{task}:{serial}:" + hashlib.blake2b(b"".join(keys), digest_size=8).hexdigest(), "n_docs": len(keys)}
            rows = _messages(send, whose, len(keys), parts, head | {"comps": comp.tobytes()})
            rows.append(_EMPTY | head | {"pid": serial % parts, "ids": bytes(8 * len(keys)), "sizes": size.tobytes(), "keys": b"".join(keys),
                                         "local": np.bincount(d[shared], minlength=len(keys)).astype(np.int64).tobytes()})
            serial += 1
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_DEALT)
    return run


def reachable(labelled: DataFrame, num: int, den: int) -> DataFrame:
    """``key`` of the sets of ``labelled(key, comp, n, tokens)`` with enough tokens in sets of other components for a link."""
    total = labelled.agg(F.sum("n")).first()[0] or 0
    parts = max(min(shuffle_width(labelled.sparkSession), RANGES // 4), -(-total // MEET))
    met = labelled.select("key", "comp", "tokens").mapInArrow(_spoken(parts), _DEALT).groupBy("pid").applyInArrow(_meet, _SHARED)
    return met.groupBy("block").applyInArrow(_sum_block(num, den), "doc_id long, n long, key binary, alive boolean").where("alive").select("key")


def _cross_links(sets: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Links that connect different components, complete by the prefix rule."""
    labelled = sets.join(labels.select("key", F.xxhash64("comp").alias("comp")), "key").select("key", "comp", "n", "tokens", "wide")
    sets = stage(labelled.join(stage(reachable(labelled, num, den), "reachable"), "key", "left_semi"), "near")
    pre = stage(sets.select("key", "comp", "tokens").mapInArrow(_prefix(num, den), "token long, key binary, comp long"), "prefix")
    # holders of a token meet under the smallest of them, so that the many tokens of similar sets make few meetings
    shared = pre.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("key").alias("meet")) \
        .where("lo <> hi").select("token", "meet")
    met = stage(pre.join(shared, "token").select("meet", "key", "comp").distinct(), "met")
    split = met.groupBy("meet").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("parts"))
    dealt = met.join(split, "meet").withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))) \
        .select("meet", "key", "comp", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                F.col("own").alias("side")) \
        .join(sets.select("key", "n", "wide"), "key").select(*_MEMBER.names)
    meeting = ["meet", "p", "q"]
    kept = dealt.groupBy(*meeting).applyInArrow(_hopeful(num, den), dealt.schema)
    return kept.join(sets.select("key", "tokens"), "key").groupBy(*meeting).applyInArrow(_meet_links(num, den), "a binary, b binary")


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the links are added: only components and their distinct links are walked, not their members."""
    for end in ("a", "b"):
        links = links.join(labels.select(F.col("key").alias(end), F.col("comp").alias("c" + end)), end)
    merged = components(links.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")))
    return stage(labels.join(merged.withColumnRenamed("comp", "into"), labels.comp == merged.node, "left")
                 .select("key", F.coalesce("into", "comp").alias("comp")), "labels")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       num: int = 75, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Two documents link when ``den * |A & B| >= num * |A | B|`` for their sets
    of distinct ``k``-word shingles (A-Z lower-cased; fewer words: the whole
    sequence; null or wordless texts: empty set, linked with nothing).
    ``component_id`` is the smallest id reachable by links. Repeated ids are
    separate rows whose sets link as usual; a row without an id gets size and
    a null component and passes on no link. Extra columns are ignored.
    ``docs`` must be rereadable in the same order (a file scan or a staged
    table), as the blocks of the first pass are recomputed after a loss.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = base.where("id is not null")
    prof = stage(profile(known, "id", "text", k, num, den), "profile")
    nodes = prof.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("min_id"), F.max("alive").alias("alive"))
    alive = nodes.where("alive").select(F.col("min_id").alias("id"), "key")
    bits = spark.sparkContext.broadcast(id_bits(alive))
    again = known.select("id", "text", id_place("id"))
    columns = "key binary, n long, tokens binary, wide binary" + "".join(f", mh{j} long" for j in range(LEVELS))
    sets = stage(again.mapInArrow(_token_sets(k, bits), columns).join(alive.select("key"), "key", "left_semi")
                 .dropDuplicates(["key"]), "sets")
    labels = sets.select("key", F.col("key").alias("comp"))
    for level in range(LEVELS):
        labels = _relabel(labels, _gather_links(sets, labels.where("key = comp").select("key"), level, num, den))
    labels = _relabel(labels, _cross_links(sets, labels, num, den))
    comp = labels.select(F.col("key").alias("node"), "comp")
    ids = nodes.select("key", "min_id")
    labelled = ids.join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    lowest = labelled.groupBy("comp").agg(F.min("min_id").alias("low"))
    by_key = labelled.join(lowest, "comp").select("key", "low")
    out = prof.join(by_key.where("low is not null"), "key", "left") \
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"))
    nameless = base.where("id is null").select("text").mapInArrow(_sizes(k), "n_shingles long") \
        .select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.union(nameless)


def _sizes(k: int):
    def run(batches):
        for b in chunks(batches, "text"):
            _, first = shingles(b.column("text").to_pylist(), k)
            yield pa.RecordBatch.from_pydict({"n_shingles": np.diff(first).astype(np.int64)})
    return run


def op5_jaccard_join(spark, sf_dir):
    """Components of documents with five-word shingle similarity of at least 0.75."""
    return jaccard_components(table(spark, sf_dir, "documents"))
