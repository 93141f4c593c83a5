"""Mixture-controlled packing (operator 10).

Every source is a queue of tokens. Deficit round-robin serves the queues: in
each round a source's deficit grows by its quantum (sequence length times its
target share) and whole granules of it are served while the deficit covers
them; what is left is carried to the next round, so also across windows and
partitions. The served granules form one stream that is cut into sequences of
exactly ``seq_len`` tokens; only the last one can be shorter.

Served amounts have a closed form (after round r: the whole granules within
``r * quantum``), so no task has to replay the rounds before it: positions in
a source come from two-level running sums (over hash buckets, then inside
one), positions in the stream from block starts by that formula and a running
sum inside a block of rounds.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigcast.llm.common import stage, table, text_batches
from rigcast.llm.textnum import chunks, held, let_go
from rigcast.llm.wordcache import PieceTable

SEQ_LEN = 4096
GRANULE = 256        # tokens that a queue serves at once; pieces of one sequence are at least this long but at cuts
BUCKET_TOKENS = 1 << 24   # expected size of a part of the corpus: a source holding most rows is summed by many tasks
LEAST_BUCKETS = 256
LEAST_ROUNDS, MOST_BLOCKS = 512, 1 << 16   # rounds in a block of the stream, unless there would be more blocks than this
TEXT_ROWS, TEXT_BYTES = 2000, 8 << 20      # texts whose distinct words are looked up at once
WORDS = 600_000      # pieces that a worker remembers; results do not depend on it
END_ID = 2           # closes every document

# White space beyond ASCII, which the vocabulary's split drops as well
_OTHER_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Latin words without marks for special tokens: lower-casing and composition leave their split unchanged
_PLAIN = re.compile("(?!.*<\\|)[\x21-\x7e\u00c0-\u012f\u0131-\u024f]+").fullmatch
# Fixed value: the split pattern of word_bpe_49k.json
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


class WhiteSpaceTokenizer:
    """Ids by the ``tokenizers`` library for lower-casing vocabularies with word
    ends that drop white space: no token crosses it, so a worker asks the
    library once for each distinct word. Plain Latin words are first cut into
    their lower-cased parts, of which there are fewer; the ends of words in the
    library's answer tell the parts apart."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # for parts, which are cut and lower-cased already
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        suffix = spec["model"]["end_of_word_suffix"]
        self.split = next((s["pattern"].get("Regex") for s in spec["pre_tokenizer"].get("pretokenizers", []) if s["type"] == "Split"), None)
        for token, i in spec["model"]["vocab"].items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        self.parts = PieceTable(self._encode_parts, WORDS)
        self.words = PieceTable(self._encode_words, WORDS)

    def _by_word(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, n = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(words), 2000):
            part = words[i:i + 2000]
            e = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(e.ids, np.uint32))
            n.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(n)

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        batch = ["\n".join(parts[i:i + 2000]) for i in range(0, len(parts), 2000)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.plain.encode_batch_fast(batch, add_special_tokens=False)])
        at = np.flatnonzero(self.ends[ids])
        if len(at) != len(parts) or at[-1] != len(ids) - 1:
            return self._by_word(parts)
        return ids, np.diff(np.r_[-1, at])

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((_PLAIN(w) is not None for w in words), bool, len(words)) & (self.split == _PARTS.__self__.pattern)
        ids, n = self.parts.lookup([_PARTS(w.lower()) if p else [] for w, p in zip(words, plain.tolist())])
        if plain.all():
            return ids, n
        other, m = self._by_word([w for w, p in zip(words, plain.tolist()) if not p])
        n[~plain] = m
        owner = np.repeat(np.arange(len(words)), n)
        out = np.empty(len(owner), np.uint32)
        out[plain[owner]], out[~plain[owner]] = ids, other
        return out, n

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each (null: none)."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = pc.replace_substring_regex(pc.fill_null(texts, ""), pattern=_OTHER_SPACE, replacement=" ")
        return self.words.lookup_arrow(pc.ascii_split_whitespace(texts))


def load(path: str) -> WhiteSpaceTokenizer:
    """A worker's tokenizer, held until another step's task runs there. Its library
    gets no threads of its own: a task has one core, and each thread holds memory."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return held(f"packing {path}", lambda: WhiteSpaceTokenizer(path))


def _tokenize(path: str, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("q", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        tok = load(path)
        for b in chunks(batches, "text", TEXT_BYTES, keep=True):
            flat, n = tok.encode(b.column("text"))
            ends = np.cumsum(n)
            flat = np.insert(flat, ends, end_id)             # after each document
            n = n + 1
            ends = np.cumsum(n)
            kind = "<u2" if not len(flat) or int(flat.max()) < 1 << 16 else "<u4"
            raw = flat.astype(kind).tobytes()
            w = np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("q"), pa.array(n, pa.int64()),
                 pa.array([raw[w * s:w * e] for s, e in zip((ends - n).tolist(), ends.tolist())], pa.binary())], schema=schema)
    return run


def _pieces(seq_len: int, with_ids: bool):
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("source", pa.string())]
    schema = pa.schema(fields + ([("ids", pa.binary())] if with_ids else []))

    def run(batches):
        let_go()                                             # the tokenizer has done its work
        for b in batches:
            cuts = b.column("cuts")
            flat = cuts.flatten()
            doc = np.repeat(np.arange(b.num_rows), np.asarray(cuts.value_lengths()))
            start, length, pos = (np.asarray(flat.field(c), np.int64) for c in ("start", "length", "pos"))
            order = np.lexsort((start, doc))
            doc, start, length, pos = doc[order], start[order], length[order], pos[order]
            # cut at the ends of sequences
            times = (pos + length - 1) // seq_len - pos // seq_len + 1
            at = np.repeat(np.arange(len(doc)), times)
            turn = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            lo = np.maximum(pos[at], (pos[at] // seq_len + turn) * seq_len)
            hi = np.minimum(pos[at] + length[at], (pos[at] // seq_len + turn + 1) * seq_len)
            doc, start, length, pos = doc[at], start[at] + lo - pos[at], hi - lo, lo
            # join what goes on where the piece before stopped
            new = np.r_[True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + length[:-1]) | (pos[1:] % seq_len == 0)]
            first = np.flatnonzero(new)
            doc, start, pos, length = doc[first], start[first], pos[first], np.add.reduceat(length, first)
            n = np.asarray(b.column("n"), np.int64)
            raw = [r if len(r) == 4 * k else np.frombuffer(r, "<u2").astype("<u4").tobytes() for r, k in zip(b.column("ids").to_pylist(), n.tolist())]
            parts = [raw[d][4 * s:4 * (s + k)] for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist())]
            rows = pa.array(doc)
            cols = [b.column("doc_id").take(rows), pa.array(start), pa.array(length), pa.array(list(map(zlib.crc32, parts)), pa.int64()),
                    pa.array(n[doc]), pa.array(pos // seq_len), pa.array(pos % seq_len), pc.utf8_slice_codeunits(b.column("q"), 1).take(rows)]
            null = pc.equal(b.column("q"), "").take(rows)
            cols[-1] = pc.if_else(null, pa.scalar(None, pa.string()), cols[-1])
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(parts, pa.binary())] if with_ids else []), schema=schema)
    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seq_len: int = SEQ_LEN, granule: int = GRANULE, end_id: int = END_ID,
         targets: dict[str, float] | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source`` (and ``ids``, unsigned 32-bit, with ``with_ids``).

    ``targets`` maps sources to weights; without it a source's target is its
    share of the corpus, so all queues run dry together. A source that has
    documents but no positive weight is an error, since its documents could not
    be placed. When a queue is empty the others fill the windows on.
    Null and empty texts are documents of the closing id alone; null and
    repeated ids and equal rows are documents of their own; null sources are
    one queue. No documents: no rows. Sequences are gapless; all but the last
    hold exactly ``seq_len`` ids.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")).alias("q"))
    with text_batches(spark, TEXT_ROWS):
        ids = stage(base.mapInArrow(_tokenize(path, end_id), "doc_id long, q string, n long, ids binary")
                    .withColumn("rid", F.monotonically_increasing_id()), "ids")
    tokens = ids.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-tokens // BUCKET_TOKENS))
    sized = ids.select("rid", "q", "n", F.pmod(F.xxhash64("rid"), F.lit(buckets)).alias("bucket"))
    parts = stage(sized.groupBy("q", "bucket").agg(F.sum("n").alias("held")), "parts")
    queues = parts.groupBy("q").agg(F.sum("held").alias("total"))
    if targets is None:
        queues = queues.withColumn("w", F.col("total"))
    else:
        weights = spark.createDataFrame([("s" + s, max(0, round(w * 1_000_000))) for s, w in targets.items()], "q string, w long")
        queues = queues.join(weights, "q", "left").withColumn("w", F.coalesce("w", F.lit(0)))
        if queues.where("w = 0").limit(1).count():
            raise ValueError("a source with documents has no target weight")
    all_w = queues.agg(F.sum("w")).first()[0] or 1
    # r * quantum as an exact fraction, r * seq_len * w / all_w, by whole numbers: `/` would round to six places
    big = "decimal(19,0)"

    def up(a: str, b: str) -> str:
        return f"({a} + {b} - 1) div ({b})"

    quantum = f"cast(w as {big}) * {seq_len}"
    queues = stage(queues.withColumn("last", F.expr(up(f"cast(total as {big}) * {all_w}", quantum))), "queues")
    end = queues.agg(F.max("last")).first()[0] or 0
    rounds = max(LEAST_ROUNDS, -(-end // MOST_BLOCKS))

    along = Window.partitionBy("q").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("base", F.coalesce(F.sum("held").over(along), F.lit(0)))
    inside = Window.partitionBy("q", "bucket").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))) \
        .join(starts.select("q", "bucket", "base"), ["q", "bucket"]) \
        .select("rid", "q", "n", (F.col("base") + F.col("before")).alias("p"))

    # granules of each queue, the round that serves each, and its place in the stream
    grains = starts.join(queues, "q").select(
        "q", "total", "w", "last", F.explode(F.expr(
            f"if((base + held - 1) div {granule} >= (base + {granule - 1}) div {granule}, "
            f"sequence((base + {granule - 1}) div {granule}, (base + held - 1) div {granule}), array())")).alias("k")) \
        .withColumn("size", F.least(F.lit(granule), F.col("total") - F.col("k") * granule)) \
        .withColumn("r", F.expr(f"least(last, {up(f'cast((k + 1) * {granule} as {big}) * {all_w}', quantum)})")) \
        .withColumn("block", F.expr(f"(r - 1) div {rounds}"))
    served = F.expr(f"if(block * {rounds} >= last, total, "
                    f"{granule} * (cast(block * {rounds} as {big}) * ({quantum}) div (cast({all_w} as {big}) * {granule})))")
    block_start = queues.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((end - 1) // rounds if end else 0).cast("long")))) \
        .groupBy("block").agg(F.sum(served).alias("block_start"))
    order = Window.partitionBy("block").orderBy("r", "q", "k").rowsBetween(Window.unboundedPreceding, -1)
    grains = grains.withColumn("ahead", F.coalesce(F.sum("size").over(order), F.lit(0))).join(block_start, "block") \
        .select("q", "k", (F.col("block_start") + F.col("ahead")).alias("at"))

    cuts = placed.withColumn("k", F.explode(F.expr(f"sequence(p div {granule}, (p + n - 1) div {granule})"))) \
        .join(grains, ["q", "k"]) \
        .withColumn("lo", F.greatest("p", F.col("k") * granule)) \
        .withColumn("hi", F.least(F.col("p") + F.col("n"), (F.col("k") + 1) * granule)) \
        .groupBy("rid").agg(F.collect_list(F.struct(
            (F.col("lo") - F.col("p")).alias("start"), (F.col("hi") - F.col("lo")).alias("length"),
            (F.col("at") + F.col("lo") - F.col("k") * granule).alias("pos"))).alias("cuts"))
    columns = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
               + (", ids binary" if with_ids else ""))
    with text_batches(spark):
        return stage(ids.join(cuts, "rid").select("doc_id", "q", "n", "ids", "cuts").mapInArrow(_pieces(seq_len, with_ids), columns), "pieces")


def assemble(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences from pieces made ``with_ids``."""
    return pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p")) \
        .select("sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))


def op10_packing(spark, sf_dir, path: str | None = None):
    """Pieces of all documents, packed into sequences of 4096 ids in the corpus mixture of sources."""
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))
