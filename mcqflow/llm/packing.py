"""Packing examples into training sequences by vector bin packing.

A sequence has room for ``tokens`` tokens, ``segments`` pieces and ``loss``
loss-bearing tokens, all at once.  The dot-product heuristic fills one sequence
at a time: of the examples that still fit in every dimension it takes the one
whose demand vector has the greatest dot product with what is left, dimensions
weighted by the mean demand of the examples not yet placed.

Examples with equal demand are interchangeable, so the heuristic runs on
demands with their counts, not on examples:

1. One pass measures (and, for documents, encodes) the rows and writes them.
   Each row gets its number among the rows of its demand in its task.
2. Counts by (task, demand) give by prefix sums each row's number among all
   rows of its demand; the counts by demand, one row for each demand that
   occurs, are all the planner gets: its work and size depend on the limits,
   not on the number of rows.  Loss counts are rounded up to ``LOSS_STEP``.
3. The planner fills a sequence, and repeats it as often as the counts allow.
   Its plan says which numbers of a demand go to which sequences and places.
4. Rows look their number up in the plan, in the tasks that hold them.

Documents may be cut.  Each is cut into full sequences and a rest; the rests
are packed.  A loss-bearing token is one that another token of its piece
precedes, so here only two limits can bind (loss does for instruction data, see
``pack_examples``).  If a sequence has more than ``slack`` tokens left and
nothing fits, the head of the example with the greatest dot product fills it,
and the tail is an example again.  A sequence that can't be filled that way
(pieces used up, or nothing left) is shortened to a power of two, where no
padding is due, and what it held above that is an example again.

Defined cases: a null text is an empty text, its one id is the end id; null
doc_id stays null; equal rows are packed each; an empty table gives no rows;
only doc_id and text are read.  Examples over a limit get a null sequence and
the limit's name in ``oversize``; null counts are 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.llm import words as W
from mcqflow.llm.tokenids import CHUNK_BYTES, Encoder, _with_end
from mcqflow.session import materialize

TOKENS, SEGMENTS, END_ID = 2048, 64, 1
SLACK = 8
LOSS_STEP = 32
_RANK = 44  # bits of a row's number in a look-up key


class Plan:
    """Places by (demand, piece): numbers lo..hi-1 of ``demand`` put the tokens
    from ``start`` on, ``length`` of them, at ``offset`` of the sequences from ``sequence`` on."""

    FIELDS = ("demand", "piece", "lo", "hi", "start", "length", "sequence", "offset")

    def __init__(self, codes, rows, n_sequences):
        a = np.array(rows, np.int64).reshape(-1, len(self.FIELDS))
        self.codes, self.n_sequences = np.asarray(codes, np.int64), n_sequences
        self.pieces = []
        for k in range(int(a[:, 1].max()) + 1 if len(a) else 0):
            own = a[a[:, 1] == k]
            key = (own[:, 0] << _RANK) + own[:, 2]
            order = np.argsort(key)
            self.pieces.append((key[order], own[order]))

    def find(self, code: np.ndarray, rank: np.ndarray):
        """Places of rows by their demand's code and number: (row, start, length, sequence, offset)."""
        out = [np.zeros((0, 5), np.int64)]
        if len(self.codes):
            demand = np.searchsorted(self.codes, code)
            want = (demand << _RANK) + rank
            for key, own in self.pieces:
                at = np.searchsorted(key, want, "right") - 1
                p = own[at]
                ok = np.flatnonzero((at >= 0) & (p[:, 0] == demand) & (rank < p[:, 3]))
                out.append(np.stack([ok, p[ok, 4], p[ok, 5], p[ok, 6] + rank[ok] - p[ok, 2], p[ok, 7]], 1))
        return np.concatenate(out)


class _Stock:
    """Examples of each demand that are not placed: numbers (origin, lo, hi, start, piece)."""

    def __init__(self, counts):
        self.own = [[(t, 0, int(c), 0, 0)] if c else [] for t, c in enumerate(counts)]
        self.count = np.asarray(counts, np.int64).copy()

    def take(self, t, m):
        self.count[t] -= m
        out = []
        while m:
            origin, lo, hi, start, piece = self.own[t].pop()
            n = min(m, hi - lo)
            out.append((origin, lo, lo + n, start, piece))
            if lo + n < hi:
                self.own[t].append((origin, lo + n, hi, start, piece))
            m -= n
        return out

    def put(self, t, parts):
        self.own[t].extend(parts)
        self.count[t] += sum(hi - lo for _, lo, hi, _, _ in parts)


def make_plan(tokens, loss, counts, codes, room=TOKENS, segments=SEGMENTS, max_loss=TOKENS, cut=False, slack=SLACK) -> Plan:
    """Fill sequences with examples of demands (tokens, loss), ``counts`` of each.

    With ``cut`` the demands are 1, 2, ... room - 1 tokens (index + 1), and a
    piece's loss is its tokens but the first."""
    tokens, loss = np.asarray(tokens, np.int64), np.asarray(loss, np.int64)
    if (tokens > room).any() or (loss > max_loss).any() or segments < 1:
        raise ValueError("a demand exceeds a limit alone")
    stock, rows, n_sequences = _Stock(counts), [], 0
    size = np.array([room, segments, max(1, max_loss)], float)
    need = np.stack([tokens, np.ones(len(tokens)), loss], 1) / size
    while True:
        live = np.flatnonzero(stock.count)
        if not len(live):
            return Plan(codes, rows, n_sequences)
        weight = stock.count[live] @ need[live] / stock.count[live].sum()
        t, x, d, free = tokens[live], loss[live], need[live] * weight, stock.count[live].copy()
        left = np.array([room, segments, max_loss])
        slots = []  # (demand, tokens taken of it)
        while left[1]:
            fits = (t <= left[0]) & (x <= left[2]) & (free > 0)
            if not fits.any():
                break
            k = int(np.where(fits, d @ (left / size), -1).argmax())
            many = 1
            if len(live) == 1:  # nothing else to choose from
                many = int(min(free[k], left[1], left[0] // t[k], left[2] // x[k] if x[k] else left[1]))
            slots += [(int(live[k]), int(t[k]))] * many
            free[k] -= many
            left -= many * np.array([t[k], 1, x[k]])
        if cut and left[0] > slack:
            head = (t > left[0]) & (free > 0) & (left[0] - 1 <= left[2])
            if left[1] and head.any():
                k = int(np.where(head, d @ (left / size), -1).argmax())
                slots.append((int(live[k]), int(left[0])))
            else:  # shorten to a power of two
                over = (room - int(left[0])) - (1 << (room - int(left[0])).bit_length() - 1)
                while over:
                    k, n = slots.pop()
                    if n > over:
                        slots.append((k, n - over))
                    over -= min(n, over)
        used: dict = {}
        for k, _ in slots:
            used[k] = used.get(k, 0) + 1
        copies = min(int(stock.count[k]) // u for k, u in used.items())
        at = 0
        for k, n in slots:
            done, tails = 0, []
            for origin, lo, hi, start, piece in stock.take(k, copies):
                rows.append((origin, piece, lo, hi, start, n, n_sequences + done, at))
                done += hi - lo
                if n < tokens[k]:
                    tails.append((origin, lo, hi, start + n, piece + 1))
            at += n
            if tails:
                stock.put(int(tokens[k]) - n - 1, tails)
        n_sequences += copies


def _numbered(code: np.ndarray, seen: dict) -> np.ndarray:
    """Each row's number among the rows of its code that the task has met; ``seen`` goes on."""
    order = np.argsort(code, kind="stable")
    s = code[order]
    lead = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    n = np.diff(np.append(lead, len(s)))
    base = np.array([seen.get(c, 0) for c in s[lead].tolist()], np.int64)
    for c, b, m in zip(s[lead].tolist(), base.tolist(), n.tolist()):
        seen[c] = b + m
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(len(s)) - np.repeat(lead - base, n)
    return out


def _bases(rows: DataFrame) -> tuple[DataFrame, list]:
    """Of rows (pid, code, blocks): per (pid, code) the rows of the code and the
    blocks in earlier tasks; and the counts by code (at most as many as demands)."""
    counts = materialize(rows.groupBy("pid", "code").agg(F.count(F.lit(1)).alias("n"), F.sum("blocks").alias("b")), "packing-counts")
    hist = sorted((r.code, r.n) for r in counts.where("code > 0").groupBy("code").agg(F.sum("n").alias("n")).collect())
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    blocks = counts.groupBy("pid").agg(F.sum("b").alias("b")).select(F.col("pid").alias("p"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("block_base"))
    earlier = Window.partitionBy("code").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = (counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .join(blocks, F.col("pid") == F.col("p")).select(F.col("pid").alias("bpid"), F.col("code").alias("bcode"), "base", "block_base"))
    return bases, hist


def _with_bases(rows: DataFrame, bases: DataFrame) -> DataFrame:
    return rows.join(bases, (F.col("pid") == F.col("bpid")) & (F.col("code") == F.col("bcode"))).drop("bpid", "bcode")


def _encode_task(path, end_id, room):
    def run(batches):
        pid, enc, seen, blocks = TaskContext.get().partitionId(), Encoder(path), {}, 0
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            for lo, hi in W.slabs(W.text_bytes(text)[1], CHUNK_BYTES):
                ids, n = _with_end(*enc.encode_rows(text.slice(lo, hi - lo)), end_id)
                ids = ids.astype("<u4")
                raw, ends = memoryview(ids).cast("B"), np.cumsum(n) * 4
                full = n // room
                before = blocks + np.cumsum(full) - full
                blocks += int(full.sum())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").slice(lo, hi - lo), "pid": pa.array(np.full(hi - lo, pid), pa.int32()),
                    "code": pa.array(n % room, pa.int64()), "local": pa.array(_numbered(n % room, seen)), "blocks": pa.array(full, pa.int64()),
                    "block_local": pa.array(before, pa.int64()), "doc_tokens": pa.array(n, pa.int64()),
                    # ids of the vocabularies used are below 2^16 mostly; as bytes both widths are read back alike
                    "ids": pa.array([_bytes(raw[e - 4 * k:e]) for e, k in zip(ends.tolist(), n.tolist())], pa.binary())})
    return run


def _bytes(raw) -> bytes:
    """Ids as 16-bit integers where they all fit, else as 32-bit ones; the first byte tells the width."""
    a = np.frombuffer(raw, "<u4")
    return b"\2" + a.astype("<u2").tobytes() if int(a.max()) < 1 << 16 else b"\4" + a.tobytes()


def _ids(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, f"<u{stored[0]}", offset=1)


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<long>")


def _piece_task(plan, room, with_ids):
    def run(batches):
        p = plan.value
        for b in batches:
            num = {c: b.column(c).to_numpy() for c in ("code", "local", "base", "blocks", "block_local", "block_base", "doc_tokens")}
            rest = np.flatnonzero(num["code"] > 0)
            row, start, length, seq, offset = p.find(num["code"][rest], (num["base"] + num["local"])[rest]).T
            row = rest[row]
            start = start + num["blocks"][row] * room
            # full sequences are numbered after the packed ones
            n = num["blocks"]
            brow = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(brow)) - np.repeat(np.cumsum(n) - n, n)
            row = np.concatenate((brow, row))
            start = np.concatenate((k * room, start))
            length = np.concatenate((np.full(len(brow), room), length))
            seq = np.concatenate((p.n_sequences + (num["block_base"] + num["block_local"])[brow] + k, seq))
            offset = np.concatenate((np.zeros(len(brow), np.int64), offset))
            order = np.lexsort((start, row))
            row, start, length, seq, offset = (x[order] for x in (row, start, length, seq, offset))
            ids, crc, lists, last = b.column("ids"), [], [], -1
            for r, s, m in zip(row.tolist(), start.tolist(), length.tolist()):
                if r != last:
                    own, last = _ids(ids[r].as_py()).astype("<u4"), r
                crc.append(zlib.crc32(own[s:s + m].tobytes()))
                if with_ids:
                    lists.append(own[s:s + m].astype(np.int64))
            cols = {"doc_id": b.column("doc_id").take(pa.array(row)), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(num["doc_tokens"][row], pa.int64()),
                    "sequence_id": pa.array(seq, pa.int64()), "offset": pa.array(offset, pa.int64()),
                    "ids": pa.array(lists, pa.list_(pa.int64())) if with_ids else pa.nulls(len(row), pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(cols)
    return run


def pack_documents(docs: DataFrame, tokenizer: str, room: int = TOKENS, segments: int = SEGMENTS, end_id: int = END_ID,
                   slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    coded = materialize(rows.mapInArrow(_encode_task(tokenizer, end_id, room),
                                        "doc_id long, pid int, code long, local long, blocks long, block_local long, doc_tokens long, ids binary"), "packing-ids")
    bases, hist = _bases(coded)
    counts = np.zeros(room - 1, np.int64)
    for code, n in hist:
        counts[code - 1] = n
    tokens = np.arange(1, room)
    plan = make_plan(tokens, tokens - 1, counts, tokens, room, segments, room, cut=True, slack=slack)
    held = spark.sparkContext.broadcast(plan)  # a few rows a demand, fewer than ``room`` demands
    return _with_bases(coded, bases).mapInArrow(_piece_task(held, room, with_ids), _PIECES)


def _measure_task(schema):
    def run(batches):
        pid, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            code = b.column("code").to_numpy()
            made = {"pid": pa.array(np.full(len(code), pid), pa.int32()), "local": pa.array(_numbered(code, seen))}
            yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else b.column(f.name).cast(f.type) for f in schema], schema=schema)
    return run


def _example_task(plan, schema):
    def run(batches):
        for b in batches:
            code = b.column("code").to_numpy()
            rank = (b.column("base").to_numpy() + b.column("local").to_numpy())
            seq, offset, has = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64), np.zeros(len(code), bool)
            ask = np.flatnonzero(code > 0)
            row, _, _, s, o = plan.value.find(code[ask], rank[ask]).T
            row = ask[row]
            seq[row], offset[row], has[row] = s, o, True
            made = {"sequence_id": pa.array(seq, mask=~has), "offset": pa.array(offset, mask=~has)}
            yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else b.column(f.name).cast(f.type) for f in schema], schema=schema)
    return run


def pack_examples(examples: DataFrame, tokens_col: str = "n_tokens", loss_col: str = "n_loss", room: int = TOKENS,
                  segments: int = SEGMENTS, max_loss: int = TOKENS, loss_step: int = LOSS_STEP) -> DataFrame:
    """Whole examples (instruction data) into sequences: ``examples`` plus
    ``sequence_id``, ``offset`` and ``oversize`` (the limit that an example
    exceeds alone, else null).  Examples without tokens have no place."""
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = examples.sparkSession
    examples = examples.drop("sequence_id", "offset", "oversize")
    t, x = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in (tokens_col, loss_col))
    over = F.when(t > room, "tokens").when(x > max_loss, "loss")
    up = F.least(F.ceil(x / loss_step) * loss_step, F.lit(max_loss)).cast("long")  # loss never above the limit by rounding
    rows = examples.select(F.struct(*examples.columns).alias("row"), over.alias("oversize"), F.lit(0).cast("long").alias("blocks"),
                           F.when(over.isNotNull() | (t <= 0), 0).otherwise(t * (max_loss + 1) + up).cast("long").alias("code"))
    schema = T.StructType([*rows.schema.fields, T.StructField("pid", T.IntegerType()), T.StructField("local", T.LongType())])
    rows = materialize(rows.mapInArrow(_measure_task(to_arrow_schema(schema)), schema), "packing-examples")
    bases, hist = _bases(rows)
    codes = np.array([c for c, _ in hist], np.int64)
    plan = make_plan(codes // (max_loss + 1), codes % (max_loss + 1), [n for _, n in hist], codes, room, segments, max_loss)
    held = spark.sparkContext.broadcast(plan)
    placed = _with_bases(rows, bases)
    schema = T.StructType([*placed.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return placed.mapInArrow(_example_task(held, to_arrow_schema(schema)), schema).select("row.*", "sequence_id", "offset", "oversize")


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    return pack_documents(docs, tokenizer, with_ids=False).drop("ids")
