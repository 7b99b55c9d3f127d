"""N-gram Jaccard join with Bayesian candidate pruning.

Two documents are linked if the Jaccard similarity of their sets of five-word
shingles is at least 0.8.  A document's shingles are those of its word
sequence; a text of one to four words has its whole word sequence as its only
shingle.

1. One pass computes each row's shingle-set hash (128 bits) and 160 MinHash
   values and writes them.  Rows with equal sets form a class; all later steps
   see one member of a class, with the number of its rows.
2. The values form 32 bands of 5.  Classes that agree on a band are candidates;
   a band value is represented by its least class (a partial aggregate), so a
   value shared by m classes makes m edges, not m * m pairs.  A pair at
   similarity 0.8 misses all bands with probability 3e-6.
3. The connected components of these edges are the candidate groups.  A group
   meets as a whole, or by its shared band values, whichever copies fewer
   shingle sets: a cluster of near copies shares most bands and meets once,
   a group that only chains of shared bands hold together (pages of one
   template) meets band value by band value.  What meets is cut into blocks of
   ``BLOCK`` classes by hash, and every pair of blocks is one unit of work, so
   a large group spreads over many tasks.
4. In a unit, the pairs that agree on a band are compared on their MinHash
   values, ``STEP`` at a time; a pair that meets by band values counts only in
   the first band where it agrees.  A pair is dropped as soon as the posterior
   probability (uniform prior) that its similarity reaches the threshold falls
   below ``TOLERANCE``.  The rest is verified exactly on the shingle sets.  A
   unit emits, for each class, how many rows it links to, and the edges of a
   spanning forest of its links; pairs are never emitted.
5. Link counts add up; the components of the forest edges are the groups.

Defined cases: null, empty and blank texts have no words and link to nothing;
null doc_id rows take part, the least non-null doc_id of a group is its class
id (null if it has none); repeated rows link to each other; very long texts
are whole; an empty table gives no rows; extra columns pass through ``keep_one``.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mcqflow.llm import words as W
from mcqflow.llm.components import components
from mcqflow.session import materialize

N = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
STEP = 16
TOLERANCE = 1e-6
BLOCK = 256
BIN_BYTES = 16 << 20  # shingle sets of small units that one Arrow table holds, about
DENSE = 4096  # pairs of a unit that are matched on all bands in one product
_rng = np.random.RandomState(977)
_MULT = (_rng.randint(1, 1 << 31, BANDS * ROWS, dtype=np.int64).astype(np.uint64) << np.uint64(32)) | \
    (_rng.randint(0, 1 << 31, BANDS * ROWS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1))
_ADD = _rng.randint(0, 1 << 62, BANDS * ROWS, dtype=np.int64).astype(np.uint64)


def shingle_sets(buf, off, n=N):
    """Sorted distinct shingle hashes of all rows: (hashes, row offsets)."""
    _, _, h, first = W.scan(buf, off)
    w = np.zeros(len(h), np.uint64)
    full = W.windows(h, n)
    w[:len(full)] = full
    ok = W.within(first, len(h), n)
    counts = np.diff(first)
    for k in range(1, n):  # short texts: the whole sequence
        rows = np.flatnonzero(counts == k)
        if len(rows):
            at = first[:-1][rows]
            acc = h[at].copy()
            for j in range(1, k):
                acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[at + j]
            w[at] = W.mix(acc ^ np.uint64(k))
            ok[at] = True
    pos = np.flatnonzero(ok)
    row = np.searchsorted(first, pos, "right") - 1
    v = w[pos]
    order = np.lexsort((v, row))
    v, row = v[order], row[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (row[1:] != row[:-1])
    v, row = v[keep], row[keep]
    return v, np.searchsorted(row, np.arange(len(off)))


def signatures(v, so):
    """MinHash values (uint32) and two set hashes of the rows with shingles."""
    rows = np.flatnonzero(np.diff(so) > 0)
    lead = so[:-1][rows]
    sig = np.zeros((len(rows), BANDS * ROWS), np.uint32)
    h1, h2 = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
    if len(rows):
        for k in range(BANDS * ROWS):
            sig[:, k] = np.minimum.reduceat(((v * _MULT[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32), lead)
        h1 = W.mix(np.add.reduceat(W.mix(v), lead))
        h2 = W.mix(np.add.reduceat(W.mix(v ^ np.uint64(0x5851F42D4C957F2D)), lead))
    return rows, sig, h1, h2


def _sid(h1, h2):
    return [a + b for a, b in zip((x.tobytes() for x in h1.astype(">u8")), (x.tobytes() for x in h2.astype(">u8")))]


def _sign_task(batches):
    for b in batches:
        buf, off = W.text_bytes(b.column("text"))
        for lo, hi in W.slabs(off):
            v, so = shingle_sets(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            rows, sig, h1, h2 = signatures(v, so)
            n = hi - lo
            sid, raw, bands = [None] * n, [None] * n, [None] * n
            keys = W.windows_rows(sig, BANDS, ROWS) if len(rows) else np.zeros((0, BANDS), np.int64)
            for r, s, g, k in zip(rows.tolist(), _sid(h1, h2), sig, keys):
                sid[r], raw[r], bands[r] = s, g.tobytes(), k
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").slice(lo, n).cast(pa.int64()), "rk": b.column("rk").slice(lo, n),
                "sid": pa.array(sid, pa.binary()), "n_shingles": pa.array(np.diff(so), pa.int64()),
                "sig": pa.array(raw, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))})


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    """128 bits that name a (doc_id, text), NULLs apart from values."""
    named = lambda c: F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(c).cast("string")))
    return F.unhex(F.md5(F.concat(named(id_col), F.lit("\n"), named(text_col))))


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row a document: doc_id, rk, sid, n_shingles, sig, bands (written once)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rk"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(_sign_task, "doc_id long, rk binary, sid binary, n_shingles long, sig binary, bands array<long>"), "shingle-signatures")


def least_matches(threshold=THRESHOLD, tolerance=TOLERANCE, total=BANDS * ROWS, step=STEP):
    """For n = step, 2 step, ... compared values: the least number of equal ones
    at which P(similarity >= threshold | equal ones) is at least the tolerance."""
    out = []
    for n in range(step, total + 1, step):
        # P(J >= t | m of n) under a uniform prior is P(Binomial(n + 1, t) <= m)
        cum, m = 0.0, 0
        while m <= n:
            cum += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if cum >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def _prune(sa, sb, pa_, pb):
    """Pairs that survive the incremental comparison of their MinHash values."""
    eq = np.zeros(len(pa_), np.int32)
    for k, least in enumerate(least_matches()):
        eq += (sa[pa_, k * STEP:(k + 1) * STEP] == sb[pb, k * STEP:(k + 1) * STEP]).sum(1, dtype=np.int32)
        keep = eq >= least
        pa_, pb, eq = pa_[keep], pb[keep], eq[keep]
        if not len(pa_):
            break
    return pa_, pb


def _agreeing(ka, kb, same, band):
    """Pairs (i, j) of two blocks that agree on a band value; in a unit of band
    ``band`` (not -1) those that agree on no earlier band.  ka, kb: keys by band."""
    if band >= 0:
        hit = np.ones((len(ka), len(kb)), bool)
        for k in range(band):
            hit &= ka[:, k][:, None] != kb[:, k][None, :]
    elif len(ka) * len(kb) <= DENSE:
        hit = (ka[:, None, :] == kb[None, :, :]).any(2)
    else:
        hit = np.zeros((len(ka), len(kb)), bool)
        for k in range(ka.shape[1]):
            order = np.argsort(kb[:, k], kind="stable")
            lo, hi = (np.searchsorted(kb[order, k], ka[:, k], side) for side in ("left", "right"))
            n = hi - lo
            i = np.repeat(np.arange(len(ka)), n)
            hit[i, order[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + lo[i]]] = True
    if same:
        hit = np.triu(hit, 1)
    return np.nonzero(hit)


def _verify(seta, setb, i, j, threshold):
    """Exact test of candidate pairs on their shingle sets."""
    na, nb = np.array([len(s) for s in seta]), np.array([len(s) for s in setb])
    small = np.minimum(na[i], nb[j]) >= threshold * np.maximum(na[i], nb[j])  # no smaller ratio can reach it
    i, j = i[small], j[small]
    if not len(i):
        return i, j
    if len(i) <= 32:
        both = np.array([len(np.intersect1d(seta[x], setb[y], assume_unique=True)) for x, y in zip(i, j)])
    else:
        both = _intersections(seta, setb, np.unique(i), np.unique(j))[np.searchsorted(np.unique(i), i), np.searchsorted(np.unique(j), j)]
    # both / (na + nb - both) >= threshold, in whole numbers of thousandths
    t = round(threshold * 1000)
    ok = both * 1000 >= t * (na[i] + nb[j] - both)
    return i[ok], j[ok]


def _intersections(seta, setb, ui, uj):
    """Sizes of all intersections of two lists of sets, by products of 0/1 matrices."""
    allv = np.concatenate([*(seta[x] for x in ui), *(setb[y] for y in uj)])
    vocab, inv, count = np.unique(allv, return_inverse=True, return_counts=True)
    lens = [len(seta[x]) for x in ui] + [len(setb[y]) for y in uj]
    row = np.repeat(np.arange(len(lens)), lens)
    col = np.cumsum(count > 1) - 1  # shingles of one set only add nothing
    shared = count[inv] > 1
    row, at = row[shared], col[inv[shared]]
    total = np.zeros((len(ui), len(uj)), np.int64)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    for c0 in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
        lo, hi = np.searchsorted(at, [c0, c0 + 4096])
        m = np.zeros((len(lens), 4096), np.float32)
        m[row[lo:hi], at[lo:hi] - c0] = 1
        total += np.rint(m[:len(ui)] @ m[len(ui):].T).astype(np.int64)
    return total


def _forest(n, i, j):
    """Edges of a spanning forest of the links among n nodes."""
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        a, b = top(x), top(y)
        if a != b:
            up[b] = a
            out.append((x, y))
    return out


def _unit_task(threshold):
    def run(t: pa.Table) -> pa.Table:
        group = t.column("grp").to_pylist()
        sid, rows = t.column("sid").to_pylist(), t.column("n_rows").to_numpy()
        band, key, blk, bi, bj = (t.column(c).to_numpy() for c in ("band", "key", "blk", "bi", "bj"))
        units: dict = {}
        for r in range(len(sid)):
            own = units.setdefault((group[r], int(band[r]), int(key[r]), int(bi[r]), int(bj[r])), ({}, {}))
            own[0 if blk[r] == bi[r] else 1].setdefault(sid[r], r)
        sig_col, set_col = t.column("sig"), t.column("shingles")
        out = {"u": [], "v": [], "n": []}
        for (_, at, _, a, b), (left, right) in units.items():
            la, lb = sorted(left.values()), sorted(right.values()) if a != b else sorted(left.values())
            if not la or not lb or (a == b and len(la) < 2):
                continue
            load = lambda ids: (np.stack([np.frombuffer(sig_col[r].as_py(), np.uint32) for r in ids]),
                                [np.frombuffer(set_col[r].as_py(), np.uint64) for r in ids])
            sa, xa = load(la)
            sb, xb = (sa, xa) if a == b else load(lb)
            ka = W.windows_rows(sa, BANDS, ROWS)
            kb = ka if a == b else W.windows_rows(sb, BANDS, ROWS)
            i, j = _prune(sa, sb, *_agreeing(ka, kb, a == b, at))
            i, j = _verify(xa, xb, i, j, threshold)
            if not len(i):
                continue
            ra, rb = rows[la], rows[lb]
            for ids, n in ((la, np.bincount(i, rb[j], len(la))), (lb, np.bincount(j, ra[i], len(lb)))):
                for x in np.flatnonzero(n):
                    out["u"].append(sid[ids[x]])
                    out["v"].append(None)
                    out["n"].append(int(n[x]))
            shift = 0 if a == b else len(la)
            names = [sid[x] for x in la] + ([] if a == b else [sid[x] for x in lb])
            for x, y in _forest(len(names), i, j + shift):
                out["u"].append(names[x])
                out["v"].append(names[y])
                out["n"].append(0)
        return pa.table({"u": pa.array(out["u"], pa.binary()), "v": pa.array(out["v"], pa.binary()), "n": pa.array(out["n"], pa.int64())})
    return run


def _set_task(batches):
    seen: set = set()
    for b in batches:
        # copies of a repeated row come close together: one a task is enough, the units drop the rest
        sid = b.column("sid").to_pylist()
        new = []
        for r, x in enumerate(sid):
            if x not in seen:
                seen.add(x)
                new.append(r)
        if len(seen) > 100_000:
            seen.clear()
        if len(new) < len(sid):
            b = b.take(pa.array(new, pa.int64()))
        buf, off = W.text_bytes(b.column("text"))
        for lo, hi in W.slabs(off):
            v, so = shingle_sets(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            sets = pa.array([v[x:y].tobytes() for x, y in zip(so[:-1], so[1:])], pa.binary())
            cols = [b.column(n).slice(lo, hi - lo) for n in ("grp", "sid", "sig", "n_rows", "spots")]
            yield pa.RecordBatch.from_arrays([*cols, sets], names=["grp", "sid", "sig", "n_rows", "spots", "shingles"])


def _spots(groups: DataFrame, keyed: DataFrame, block: int) -> DataFrame:
    """(sid, spots): the band values by which the classes of a group meet, with the
    number of blocks of each, for the groups where this copies fewer sets."""
    wide = groups.where(F.col("n_grp") > block).select("sid", "grp", "n_grp")
    own = materialize(keyed.join(wide, "sid").select("sid", "grp", "n_grp", "band", "key"), "candidate-bands")
    values = (own.groupBy("grp", "n_grp", "band", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
              .withColumn("nb", F.ceil(F.col("m") / F.lit(block)).cast("int")))
    values = materialize(values, "candidate-band-values")
    split = (values.groupBy("grp", "n_grp").agg(F.sum(F.col("m") * F.col("nb")).alias("copies"))
             .where(F.col("copies") < F.col("n_grp") * F.ceil(F.col("n_grp") / F.lit(block))).select("grp"))
    meet = values.join(split, "grp").select("band", "key", "nb")
    return (own.join(meet, ["band", "key"]).groupBy("sid")
            .agg(F.collect_list(F.struct("band", "key", "nb")).alias("spots")))  # at most BANDS


def links(docs: DataFrame, sign: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK):
    """(classes, link rows): classes (sid, n_rows, first_id, rk); link rows (u, v, n)
    hold spanning-forest edges (v set) and partial link counts (v null)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    has = sign.where(F.col("sid").isNotNull())
    classes = materialize(has.groupBy("sid").agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_id"), F.min("rk").alias("rk")), "shingle-classes")
    # one row of each class names its bands; equal sets have equal bands
    keyed = (has.join(classes.select("sid", "rk"), ["sid", "rk"]).dropDuplicates(["sid"])
             .select("sid", F.posexplode("bands").alias("band", "key")))
    keyed = materialize(keyed, "shingle-bands")
    shared = keyed.groupBy("band", "key").agg(F.min("sid").alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    # a class has at most BANDS hubs: tie it to the least, and the others to that one
    hubs = (keyed.join(shared, ["band", "key"]).groupBy("sid").agg(F.min("hub").alias("v"), F.collect_set("hub").alias("hubs"))
            .select("v", F.explode(F.array_union("hubs", F.array("sid"))).alias("u")).where("u <> v").distinct())
    groups = components(hubs).select(F.col("node").alias("sid"), F.col("label").alias("grp"))
    size = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("n_grp"))
    groups = materialize(groups.join(size, "grp"), "candidate-groups")
    members = (groups.join(classes.select("sid", "n_rows", "rk"), "sid")
               .join(has.select("sid", "rk", "sig", "n_shingles"), ["sid", "rk"]).dropDuplicates(["sid"]))
    whole = F.array(F.struct(F.lit(-1).alias("band"), F.lit(0).cast("long").alias("key"), F.ceil(F.col("n_grp") / F.lit(block)).cast("int").alias("nb")))
    members = members.join(_spots(groups, keyed, block), "sid", "left").withColumn("spots", F.coalesce("spots", whole))
    members = materialize(members, "candidate-members")
    # bins of small units: their number grows with the bytes they hold
    small = F.size(F.filter("spots", lambda s: s["nb"] == 1))
    held = members.agg(F.sum((F.col("n_shingles") * 8 + 4 * BANDS * ROWS) * small).alias("b")).first()["b"] or 0
    n_bins = max(4 * parts, -(-held // BIN_BYTES))
    texts = docs.select(row_key(id_col, text_col).alias("rk"), F.col(text_col).alias("text"))
    schema = "grp binary, sid binary, sig binary, n_rows long, spots array<struct<band:int,key:bigint,nb:int>>, shingles binary"
    sets = (members.select("grp", "sid", "sig", "n_rows", "spots", "rk").join(texts, "rk").mapInArrow(_set_task, schema)
            .select("*", F.explode("spots").alias("s")).select("grp", "sid", "sig", "n_rows", "shingles", "s.*"))
    # every pair of blocks of what meets is one unit
    sets = sets.withColumn("blk", F.pmod(F.xxhash64("sid"), F.col("nb")).cast("int"))
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    sets = sets.withColumn("bi", F.least("blk", "other")).withColumn("bj", F.greatest("blk", "other"))
    bins = sets.withColumn("bin", F.when(F.col("nb") == 1, F.pmod(F.xxhash64("grp", "band", "key"), F.lit(n_bins)))
                           .otherwise(F.xxhash64("grp", "band", "key", "bi", "bj"))).drop("nb", "other")
    if n_bins > 4 * parts:
        bins = bins.repartition(n_bins // 4, "bin")
    found = materialize(bins.groupBy("bin").applyInArrow(_unit_task(threshold), "u binary, v binary, n long"), "jaccard-links")
    return classes, found


def join(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, rk, class_id (least doc_id of its linked group),
    n_links (other rows at the threshold or above), copy_of (least doc_id with the same shingles)."""
    sign = signed(docs, id_col, text_col)
    classes, found = links(docs, sign, threshold, id_col, text_col, block)
    counts = found.where("v is null").groupBy(F.col("u").alias("sid")).agg(F.sum("n").alias("n"))
    comp = components(found.where("v is not null")).select(F.col("node").alias("sid"), F.col("label").alias("grp"))
    named = classes.join(comp, "sid", "left").withColumn("grp", F.coalesce("grp", "sid"))
    heads = named.groupBy("grp").agg(F.min("first_id").alias("class_id"))
    info = (named.join(heads, "grp").join(counts, "sid", "left")
            .select("sid", "class_id", F.col("first_id").alias("copy_of"), (F.col("n_rows") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "grp"))
    alone = F.col("sid").isNull()
    return (sign.select("doc_id", "rk", "sid", "n_shingles").join(info, "sid", "left")
            .select("doc_id", "rk", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"), "n_shingles", "grp"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but one document of each linked group: the least
    doc_id stays (null last; of rows with equal doc_id the one with the least
    text hash, once).  Documents without words stay."""
    j = join(docs, threshold, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("rk").alias("c"))
    grouped = j.where("grp is not null")
    best = grouped.groupBy("grp").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("m"))
    gone = (grouped.join(best.where("m > 1"), "grp").where(F.col("rk") != F.col("best.c")).select("rk").distinct())
    again = grouped.groupBy("rk").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("rk"))
    rows = docs.withColumn("__rk", row_key(id_col, text_col))
    rows = rows.join(gone.withColumnRenamed("rk", "__rk"), "__rk", "left_anti")
    # identical rows share a key: one of them stays
    twice = rows.join(again.withColumnRenamed("rk", "__rk"), "__rk", "left_semi").dropDuplicates(["__rk"])
    once = rows.join(again.withColumnRenamed("rk", "__rk"), "__rk", "left_anti")
    return once.unionByName(twice).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    return join(docs.select("doc_id", "text")).select("doc_id", "class_id", "n_links", "copy_of", "n_shingles")
