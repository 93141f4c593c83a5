"""Conversation structure repair by a grammar-compressed DP (operator 11).

A conversation is a string over nine symbols: the role's initial (s, u, a, or o
for any other; upper case where the text is truncated), or X for a blank or
duplicate row. Its cheapest repair is a shortest path through a four-state
automaton of the legal role orders, and every symbol is a min-plus matrix of
(cost, audit) over these states. The symbol strings of all conversations are
compressed by one Re-Pair grammar; the matrix of a rule is the product of the
matrices of its two sides, so a phrase that many conversations share is solved
once. Audits are ropes: a product only links two ropes.

Equal costs are decided by the least audit. Strings of different lengths do not
keep their order when something is appended ("D" < "DI", but "DK" > "DIK"), so a
cell keeps every audit that could still win: a chain in which each is a prefix
of the next.

Conversations of up to ``PIECE`` rows are one row each after one shuffle. Longer
ones are ordered by range over many tasks and folded from their compressed
pieces; only the hash of the repaired text, which is sequential, is read in one
stream, with no more than a batch of rows and the audit in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigcast.llm.common import stage, table, text_batches

PIECE = 4096             # rows of a conversation that is handled as one row
LONG = 1 << 20           # and its code points
MAX_RULES = 64           # size of the grammar: decides speed, not results
RARE = 1000              # a pair needs more than this part of all symbols
KEEP_TRUNCATED, REROLE, DELETE, INSERT = 1, 2, 3, 2
LEGAL = ("su", "ua", "au")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_SPACE = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]")


# ---------------------------------------------------------- ropes and matrices

_PRIME, _BASE = (1 << 61) - 1, 911382323


class Rope:
    """An immutable string as a tree; ``code`` is a hash of its characters."""

    __slots__ = ("size", "code", "power", "left", "right", "char")

    def __init__(self, char: str = "", left: Rope | None = None, right: Rope | None = None):
        self.char, self.left, self.right = char, left, right
        if left is None:
            self.size, self.code, self.power = len(char), ord(char) if char else 0, _BASE if char else 1
        else:
            self.size = left.size + right.size
            self.code = (left.code * right.power + right.code) % _PRIME
            self.power = left.power * right.power % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        return Rope("", self, other) if self.size else other

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.left is None:
                out.append(r.char)
            else:
                todo += (r.right, r.left)
        return "".join(out)


def common(a: Rope, b: Rope) -> tuple[int, int]:
    """Length of the common prefix, and the order of the first characters that differ (0: one is a prefix)."""
    x, y, n = ([a] if a.size else []), ([b] if b.size else []), 0
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q or (p.size == q.size and p.code == q.code):
            n += p.size
        elif p.size == q.size == 1:
            return n, -1 if p.char < q.char else 1
        elif p.size >= q.size:
            x += (p.right, p.left)
            y.append(q)
        else:
            y += (q.right, q.left)
            x.append(p)
    return n, 0


def chain(ropes: list[Rope]) -> list[Rope]:
    """The audits that can still be the least after anything is appended, each a prefix of the next."""
    out = [ropes[0]]
    for r in ropes[1:]:
        n, order = common(r, out[-1])
        if order < 0:
            out = [x for x in out if x.size <= n] + [r]
        elif order == 0 and all(x.size != r.size for x in out):
            out = sorted([*out, r], key=lambda x: x.size)
    return out


def cheapest(options: list[tuple[int, list[Rope]]]) -> tuple[int, list[Rope]] | None:
    if not options:
        return None
    low = min(c for c, _ in options)
    return low, chain([r for c, ropes in options if c == low for r in ropes])


def product(a: list, b: list) -> list:
    """Min-plus product; works for whole matrices and for single rows of states."""
    out = []
    for row in a:
        new = []
        for j in STATES:
            ways = [(row[k][0] + b[k][j][0], k) for k in STATES if row[k] and b[k][j]]
            low = min(ways)[0] if ways else 0
            new.append((low, chain([x + y for c, k in ways if c == low for x in row[k][1] for y in b[k][j][1]])) if ways else None)
        out.append(new)
    return out


def _insertions() -> list:
    own = [[(0, [Rope()]) if i == j else None for j in STATES] for i in STATES]
    one, two = (INSERT, [Rope("I")]), (2 * INSERT, [Rope("I") + Rope("I")])
    for state in (START, SYSTEM):
        own[state][USER], own[state][ASSISTANT] = one, two
    own[USER][ASSISTANT] = own[ASSISTANT][USER] = one
    return own


INSERTIONS = _insertions()


def _symbol(sign: str) -> list:
    """Any insertions, then one row kept, given another role or deleted."""
    cells = [[[] for _ in STATES] for _ in STATES]
    for i in STATES:
        cells[i][i].append((DELETE, [Rope("D")]))
    if sign != "X":
        extra = KEEP_TRUNCATED if sign.isupper() else 0
        for i, j in MOVES.get(sign.lower(), {}).items():
            cells[i][j].append((extra, [Rope("K")]))
        for role in "ua":
            for i, j in MOVES[role].items():
                cells[i][j].append((REROLE + extra, [Rope("R")]))
    return product(INSERTIONS, [[cheapest(c) for c in row] for row in cells])


class Grammar:
    """Rules ``chr(256 + i) -> pair``, and the matrix of every symbol."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrix = {c: _symbol(c) for c in "suaoSUAOX"}
        for i, pair in enumerate(rules):
            self.matrix[chr(256 + i)] = product(self.matrix[pair[0]], self.matrix[pair[1]])
        self.known: dict[str, tuple[int, str]] = {}

    def shrink(self, symbols: str) -> str:
        for i, pair in enumerate(self.rules):
            if pair[0] in symbols:
                symbols = symbols.replace(pair, chr(256 + i))
        return symbols

    def solve(self, shrunk: str) -> tuple[int, str]:
        """Cost and audit of one compressed conversation."""
        if shrunk not in self.known:
            if len(self.known) > 50_000:               # a memory of solved strings only
                self.known.clear()
            fold = Fold(self)
            fold.add(shrunk)
            self.known[shrunk] = fold.end()
        return self.known[shrunk]


class Fold:
    """Products of a long symbol string, merged like the digits of a binary counter, so that ropes stay shallow."""

    def __init__(self, grammar: Grammar):
        self.grammar, self.done = grammar, []

    def add(self, shrunk: str) -> None:
        for c in shrunk:
            level, m = 0, self.grammar.matrix[c]
            while self.done and self.done[-1][0] == level:
                m = product(self.done.pop()[1], m)
                level += 1
            self.done.append((level, m))

    def end(self) -> tuple[int, str]:
        at = [[(0, [Rope()]), None, None, None]]
        for _, m in self.done:
            at = product(at, m)
        at = product(at, INSERTIONS)[0]
        cost, audits = cheapest([x for x in (at[START], at[ASSISTANT]) if x])
        return cost, str(audits[0])                    # nothing follows: the shortest of the chain is the least


def next_rules(pairs: list[tuple[str, int]], count: int, least: int) -> list[str]:
    """The most frequent pairs that share no symbol, so that replacing them together is replacing them in turn."""
    out, used = [], set()
    for pair, n in pairs:
        if n >= max(least, 2) and not used & set(pair) and len(out) < count:
            out.append(pair)
            used |= set(pair)
    return out


def fit_grammar(symbols: DataFrame) -> list[str]:
    """Re-Pair over ``(symbols, n)``: in every round the pairs of all strings are
    counted by Spark and the most frequent ones become rules."""
    rules: list[str] = []
    total = symbols.agg(F.sum(F.length("symbols") * F.col("n"))).first()[0] or 0

    def pairs_of(rules):
        def run(batches):
            grammar, count = Grammar(rules), Counter()
            for b in batches:
                for s, n in zip(b.column("symbols").to_pylist(), b.column("n").to_pylist()):
                    s = grammar.shrink(s)
                    for pair in {s[i:i + 2] for i in range(len(s) - 1)}:
                        count[pair] += n * s.count(pair)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(list(count), pa.string()), "c": pa.array(list(count.values()), pa.int64())})
        return run

    while len(rules) < MAX_RULES:
        found = symbols.mapInArrow(pairs_of(list(rules)), "pair string, c long").groupBy("pair").agg(F.sum("c").alias("c")) \
            .orderBy(F.desc("c"), "pair").collect()    # at most (9 + MAX_RULES) squared rows
        new = next_rules([(r.pair, r.c) for r in found], MAX_RULES - len(rules), total // RARE)
        if not new:
            break
        rules += new
    return rules


# ------------------------------------------------------------- damage and rows

def damage(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that crc32 of ``conv_id:turn`` mod 20 orders. Nulls count as one space."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *said)
    word = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(word[0], F.lit(":"), word[1])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                                        text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def symbol(role: str, text: str, seen: bool) -> str:
    """The row's symbol; its first fault counts."""
    if seen or not _WORD.search(text):
        return "X"
    sign = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return sign if text.rstrip(_SPACE)[-1] in ".!?" else sign.upper()


def row_faults(text: str, seen: bool) -> tuple[int, int, int]:
    """Blank, duplicate, truncated: at most one of them."""
    if not _WORD.search(text):
        return 1, 0, 0
    return (0, 1, 0) if seen else (0, 0, int(text.rstrip(_SPACE)[-1] not in ".!?"))


def read_rows(turns: list[dict]) -> dict:
    """Symbols and fault counts of one conversation's rows in order."""
    seen, signs, faults, illegal, before = set(), [], [0, 0, 0], 0, None
    for t in turns:
        role, text = t["role"], t["text"]
        again = (role, text) in seen
        seen.add((role, text))
        signs.append(symbol(role, text, again))
        faults = [a + b for a, b in zip(faults, row_faults(text, again))]
        illegal += before is not None and before + role[:1] not in LEGAL
        before = role[:1]
    numbers = {t["turn"] for t in turns if t["turn"] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return {"symbols": "".join(signs), "gaps": gaps, "blank": faults[0], "duplicate": faults[1], "truncated": faults[2], "illegal": illegal}


class Repair:
    """Applies an audit to rows that come one after another and hashes the repaired text."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.count, self.hash = audit, 0, START, 0, hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.hash.update((line if not self.count else "\n" + line).encode("utf-8", "surrogatepass"))
        self.count += 1
        self.state = MOVES[role[0]][self.state]

    def _due(self) -> str:
        return "assistant" if self.state == USER else "user"

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(self._due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(role if edit == "K" else self._due(), text)

    def end(self) -> str:
        self._insert()
        return self.hash.hexdigest()


_FAULTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_RESULT = "conv_id long, " + ", ".join(f"{c} long" for c in _FAULTS) + ", cost long, audit string, repaired_sha256 string"


def _read_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [read_rows(t) for t in b.column("turns").to_pylist()]
        made = [pa.array([g["symbols"] for g in got], pa.string()), *[pa.array([g[c] for g in got], pa.int64()) for c in _FAULTS]]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turns"), *made], names=["conv_id", "turns", "symbols", *_FAULTS])


def _repair_short(rules: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for b in batches:
            costs, audits, hashes = [], [], []
            for symbols, turns in zip(b.column("symbols").to_pylist(), b.column("turns").to_pylist()):
                cost, audit = grammar.solve(grammar.shrink(symbols))
                repair = Repair(audit)
                for t in turns:
                    repair.row(t["role"], t["text"])
                costs.append(cost)
                audits.append(audit)
                hashes.append(repair.end())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), *[b.column(c) for c in _FAULTS], pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
                 pa.array(hashes, pa.string())], names=["conv_id", *_FAULTS, "cost", "audit", "repaired_sha256"])
    return run


# --------------------------------------------------------- long conversations

def _order(*columns: str) -> list:
    return [F.asc_nulls_first(c) for c in columns]


_IN_TURN = ("turn", "role", "text", "seen")
_PIECES = "conv_id long, part int, piece long, symbols string, n long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
_PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), ("symbols", pa.string()),
                           *[(c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal")], ("head", pa.string()), ("tail", pa.string())])


def _read_pieces(piece_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, now = TaskContext.get().partitionId(), 0, None

        def close(piece):
            return pa.RecordBatch.from_pylist([piece | {"symbols": "".join(piece["symbols"])}], schema=_PIECE_SCHEMA)

        for b in batches:
            for conv, role, text, seen in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "seen"))):
                if now is not None and (now["conv_id"] != conv or now["n"] >= piece_rows):
                    yield close(now)
                    now = None
                if now is None:
                    now = {"conv_id": conv, "part": part, "piece": at, "symbols": [], "n": 0, "blank": 0, "duplicate": 0, "truncated": 0,
                           "illegal": 0, "head": role[:1], "tail": None}
                    at += 1
                elif now["tail"] + role[:1] not in LEGAL:
                    now["illegal"] += 1
                now["symbols"].append(symbol(role, text, seen))
                now["n"] += 1
                now["tail"] = role[:1]
                for c, x in zip(("blank", "duplicate", "truncated"), row_faults(text, seen)):
                    now[c] += x
        if now is not None:
            yield close(now)
    return run


_FOLDED = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_FOLDED_SCHEMA = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def _fold_pieces(rules: list[str]):
    """Pieces in order; only compressed symbols and ropes are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, now, fold = Grammar(rules), None, None

        def close():
            cost, audit = fold.end()
            return pa.RecordBatch.from_pylist([{k: v for k, v in now.items() if k != "tail"} | {"cost": cost, "audit": audit}], schema=_FOLDED_SCHEMA)

        for b in batches:
            for p in b.to_pylist():
                if now is not None and now["conv_id"] != p["conv_id"]:
                    yield close()
                    now = None
                if now is None:
                    now, fold = {"conv_id": p["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "tail": None}, Fold(grammar)
                now["illegal"] += now["tail"] is not None and now["tail"] + p["head"] not in LEGAL
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    now[c] += p[c]
                now["tail"] = p["tail"]
                fold.add(grammar.shrink(p["symbols"]))
        if now is not None:
            yield close()
    return run


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit, then its rows in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    conv, repair = None, None
    for b in batches:
        for at, audit, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
            if audit is not None:
                if repair is not None:
                    yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": repair.end()}], schema=schema)
                conv, repair = at, Repair(audit)
            else:
                repair.row(role, text)
    if repair is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": repair.end()}], schema=schema)


def _long_pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of long conversations marked ``seen``, and their symbol pieces, ordered by range over all tasks."""
    same = Window.partitionBy("conv_id", "role", F.md5("text")).orderBy(F.asc_nulls_first("turn"))
    marked = stage(rows.withColumn("seen", F.row_number().over(same) > 1), "long_rows")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = _order("conv_id", *_IN_TURN)
    ordered = marked.repartitionByRange(width, *order).sortWithinPartitions(*order)
    return marked, stage(ordered.mapInArrow(_read_pieces(PIECE), _PIECES), "pieces")


def _repair_long(marked: DataFrame, pieces: DataFrame, rules: list[str]) -> DataFrame:
    folded = stage(pieces.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "piece")
                   .mapInArrow(_fold_pieces(rules), _FOLDED), "folded")
    turns = marked.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    none = F.lit(None)
    stream = marked.withColumn("audit", none.cast("string")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "seen", "audit") \
        .union(folded.select("conv_id", F.lit(0).alias("kind"), none.cast("long"), none.cast("string"), none.cast("string"), none.cast("boolean"), "audit"))
    hashed = stream.repartition("conv_id").sortWithinPartitions(*_order("conv_id", "kind", *_IN_TURN)) \
        .mapInArrow(_hash_stream, "conv_id long, repaired_sha256 string")
    same = [F.col("f.conv_id").eqNullSafe(F.col(f"{x}.conv_id")) for x in "th"]
    return folded.alias("f").join(turns.alias("t"), same[0]).join(stage(hashed, "hashed").alias("h"), same[1]) \
        .select("f.conv_id", "t.gaps", *[f"f.{c}" for c in _FAULTS[1:]], "f.cost", "f.audit", "h.repaired_sha256")


# ------------------------------------------------------------------- operator

def repair(conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations(conv_id, turn, role, text)``: faults after the damage and the cheapest repair.

    Rows follow one another by turn (nulls first); rows of one turn by role,
    then by text. Null roles and texts, and null ids and turns in the damage
    key, are one space; rows without a conv_id are one conversation. A role
    whose initial is not s, u or a, or that is empty, cannot be kept as it is.
    Repeated rows are duplicates. A conversation without rows after the damage
    has zeros, an empty audit and the hash of the empty string. Texts are read
    whole, extra columns are ignored, an empty table gives no rows.
    """
    spark = conversations.sparkSession
    rows = damage(conversations)
    size = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    large = stage(size.where((F.col("n") > PIECE) | (F.col("chars") > LONG)).select("conv_id"), "large")
    there = rows.conv_id.eqNullSafe(large.conv_id)
    any_large = not large.isEmpty()
    short = rows.join(large, there, "left_anti") if any_large else rows
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    with text_batches(spark):
        read = "conv_id long, turns array<struct<turn: long, role: string, text: string>>, symbols string, " + ", ".join(f"{c} long" for c in _FAULTS)
        known = stage(short.groupBy("conv_id").agg(turns).mapInArrow(_read_short, read), "turns")
        strings = known.select("symbols")
        if any_large:
            marked, pieces = _long_pieces(rows.join(large, there, "left_semi"))
            strings = strings.union(pieces.select("symbols"))
        rules = fit_grammar(stage(strings.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "symbols"))
        done = known.mapInArrow(_repair_short(rules), _RESULT)
        if any_large:
            done = done.union(_repair_long(marked, pieces, rules).select(*done.columns))
        done = stage(done, "repaired")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = hashlib.sha256().hexdigest()
    return every.alias("e").join(done.alias("d"), F.col("e.conv_id").eqNullSafe(F.col("d.conv_id")), "left").select(
        "e.conv_id", *[F.coalesce(f"d.{c}", F.lit(0).cast("long")).alias(c) for c in (*_FAULTS, "cost")],
        F.coalesce("d.audit", F.lit("")).alias("audit"), F.coalesce("d.repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def op11_chat_repair(spark, sf_dir):
    """Faults and cheapest repair of every damaged conversation."""
    return repair(table(spark, sf_dir, "conversations"))
