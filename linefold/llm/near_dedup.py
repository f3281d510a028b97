"""Near-duplicate groups with SetSketch registers.

A document's set holds its distinct 3-word shingles (words
``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased); fewer words are one shingle.

1. Each document gets a digest of its set and a SetSketch: register i is the
   minimum of an exponential hash over the set, truncated to exponentially
   spaced levels (base ``BASE``), so registers of two parts merge by maximum
   of the level and agree about as often as the sets are similar.
2. Documents with equal sets are one node, represented by the smallest id.
3. Runs of ``ROWS`` registers are band keys.  Every node of a bucket is paired
   with the bucket's centre, the node that meets most others in all its
   buckets; pairs are dropped if the joint likelihood of their registers
   (equal, higher, lower, given both set sizes) peaks below ``LEAST_ESTIMATE``,
   and confirmed on the full sets otherwise.
4. Confirmed links give components.  A bucket that holds more than one stays
   open: each of its nodes outside its largest component is compared with all
   nodes of other components, in cells of at most ``BLOCK`` by ``BLOCK`` nodes
   that are dealt over the tasks.  A cell first compares registers (a pair that
   shares several bands belongs to the first of them); only nodes with a likely
   partner get their full set, which decides.  A cell returns at most one link
   fewer than it has nodes, so no group emits all its pairs or goes to one task.
5. Components of all confirmed links; copies take their node's component.

A pair that is linked but not implied by the links of step 3 shares a bucket
that is open, so step 4 meets it: steps 3 and 4 lose no pair that shares a band
key.  With ``BANDS`` x ``ROWS`` registers a pair at the threshold shares none
with probability below 1e-6.

Documents without words link with nothing.  Rows with a null id come out with
a null component and kept = true.  Rows of the same id are one document and
share its component; if their texts differ, the set with the smallest digest
stands for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import map_texts, slices, written
from linefold.session import Workspace

SHINGLE = 3
NUM, DEN = 85, 100
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BASE = 1.05
#: Five standard errors of the estimate below the threshold.
LEAST_ESTIMATE = NUM / DEN - 5 * (0.85 * 0.15 / REGISTERS) ** 0.5
#: Nodes on either side of a cell.
BLOCK = 512
#: Links for each task of a round of ``components``.
LINKS_A_TASK = 200_000
MAX_ROUNDS = 60
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RNG = np.random.default_rng(20240607)
_XOR = _RNG.integers(0, 2**64, REGISTERS, np.uint64)
_MUL = _RNG.integers(0, 2**64, REGISTERS, np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(texts: list[str], n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted 64-bit shingle hashes of each text."""
    docs = [t.encode("utf-8", "surrogatepass").translate(_LOWER).split() for t in texts]
    flat = [w for d in docs for w in d]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    grams = np.zeros(max(0, len(flat) - n + 1), np.uint64)
    for k in range(n):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(grams)]
    grams = _mix(grams)
    out, at = [], 0
    for d in docs:
        if len(d) >= n:
            out.append(np.unique(grams[at : at + len(d) - n + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(d), seed=1)] if d else [], np.uint64))
        at += len(d)
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch levels, one row a set (of at least one element each)."""
    if not sets:
        return np.zeros((0, REGISTERS), np.uint16)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low = np.empty((len(sets), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        low[:, i] = np.minimum.reduceat((flat ^ _XOR[i]) * _MUL[i], starts)
    u = (low.astype(np.float64) + 0.5) / 2.0**64
    return np.clip(np.floor(-np.log(-np.log1p(-u)) / np.log(BASE)) + 16, 0, 65535).astype(np.uint16)


def _slope(j, equal, higher, lower, size_a, size_b):
    """Slope of the joint log-likelihood of the register comparison at similarity ``j``.

    With u and v the shares of both sizes in their sum, a register of the first
    set is the higher one with probability p(u - v j) and the lower one with
    p(v - u j), where p(x) = -log_b(1 - x (b - 1) / b).  The likelihood is concave in j.
    """
    c = (BASE - 1) / BASE
    u = size_a / (size_a + size_b)
    v = 1 - u
    x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
    p, q = -np.log1p(-x * c) / np.log(BASE), -np.log1p(-y * c) / np.log(BASE)
    dp, dq = -v * c / (1 - x * c) / np.log(BASE), -u * c / (1 - y * c) / np.log(BASE)
    return higher * dp / p + lower * dq / q - equal * (dp + dq) / np.maximum(1 - p - q, 1e-12)


def _most(size_a, size_b):
    """The highest similarity that two sizes allow."""
    return np.minimum(size_a, size_b) / np.maximum(np.maximum(size_a, size_b), 1)


def likelihood_estimate(equal, higher, lower, size_a, size_b) -> np.ndarray:
    """The similarity at which the joint likelihood of equal, higher and lower registers peaks, by bisection."""
    equal, higher, lower, size_a, size_b = (np.asarray(x, np.float64) for x in (equal, higher, lower, size_a, size_b))
    lo, hi = np.zeros(np.broadcast(equal, size_a, size_b).shape), _most(size_a, size_b) + np.zeros(np.broadcast(equal, size_a, size_b).shape)
    for _ in range(40):
        mid = (lo + hi) / 2
        up = _slope(mid, equal, higher, lower, size_a, size_b) >= 0
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    return (lo + hi) / 2


def likely(equal, higher, lower, size_a, size_b, least: float = LEAST_ESTIMATE) -> np.ndarray:
    """Whether ``likelihood_estimate`` is at least ``least``: the slope there has not turned yet."""
    return (_most(size_a, size_b) >= NUM / DEN - 1e-9) & (_slope(least, equal, higher, lower, size_a, size_b) >= 0)


def sketch(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_shingles, digest of the set, registers and band keys of each document; keys only for non-empty sets."""

    def make():
        def fn(texts):
            sets = shingles(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            regs = registers([sets[i] for i in full])
            row = dict(zip(full, range(len(full))))
            keys = [None if i not in row else [xxhash.xxh3_64_intdigest(regs[row[i], b * ROWS : (b + 1) * ROWS].tobytes(), seed=b) - 2**63 for b in range(BANDS)] for i in range(len(sets))]
            return (
                [len(s) for s in sets],
                [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                [regs[row[i]].tobytes() if i in row else None for i in range(len(sets))],
                keys,
            )

        return fn

    docs = docs.select(F.col(id_col).alias("id"), "text")
    return map_texts(docs, "n_shingles long, digest binary, regs binary, keys array<long>", make, keep=["id"])


def digested(docs: DataFrame) -> DataFrame:
    """Append the ``digest`` of each text's set, null if it is empty."""
    return map_texts(docs, "digest binary", lambda: lambda texts: [[xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in shingles(texts)]])


def _sets(docs: DataFrame) -> DataFrame:
    """id and full set of rows whose text has the wanted set ``digest``."""

    def make():
        def fn(texts):
            own = [s.tobytes() for s in shingles(texts)]
            return own, list(map(xxhash.xxh3_128_digest, own))

        return fn

    made = map_texts(docs, "`set` binary, own binary", make, keep=["id", "digest"])
    return made.where("digest = own").select("id", "set").dropDuplicates(["id"])


def _estimate_pairs(batches):
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("regs_a", "regs_b"))
        size = [b.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b")]
        equal, higher = (x == y).sum(1), (x > y).sum(1)
        ok = pa.array(likely(equal, higher, REGISTERS - equal - higher, *size))
        yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], ["a", "b"])


def _confirm_pairs(batches):
    for batch in batches:
        for b in slices(batch, "set_a", 8_000_000):
            keep = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(DEN * both >= NUM * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(keep)), b.column("b").filter(pa.array(keep))], ["a", "b"])


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    n = nodes.select("id", "n_shingles", "regs")
    a = n.toDF("a", "n_a", "regs_a")
    b = n.toDF("b", "n_b", "regs_b")
    return pairs.join(a, "a").join(b, "b").mapInArrow(_estimate_pairs, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a, b = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    return pairs.join(a, "a").join(b, "b").mapInArrow(_confirm_pairs, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links`` (a, b): component is the smallest id reachable.

    Each round sends every node to its first neighbour, or itself, and links
    what they became; a round is two narrow tables, and their count comes with
    the write.  First in the first round is the smallest id, so that stars
    around it are done at once; later it is the first by a hash that changes
    with the round, so that no chain of ids takes more than a logarithm of rounds.
    """
    spark = links.sparkSession
    with Workspace(spark, "components") as work:
        edges, n = work.counted(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
        steps = []
        while n:
            if len(steps) == MAX_ROUNDS:
                raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
            k, tasks = len(steps), -(-n // LINKS_A_TASK)
            low = edges.union(edges.select("v", "u")).groupBy("u")
            if k:
                low = low.agg(F.min_by("v", F.xxhash64(F.lit(k), "v")).alias("v")).where(F.xxhash64(F.lit(k), "v") < F.xxhash64(F.lit(k), "u"))
            else:  # all nodes, so that each has its row in the result
                low = low.agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("v"))
            low = work.written(low.select(F.col("u").alias("from"), F.col("v").alias("to")), "low", tasks)
            steps.append(low)
            moved = edges
            for c in ("u", "v"):
                moved = moved.join(low, moved[c] == low["from"], "left").withColumn(c, F.coalesce("to", c)).drop("from", "to")
            moved = moved.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
            edges, n = work.counted(moved, "links", tasks)
        if not steps:
            return spark.createDataFrame([], "id long, component long")
        # a node may lend its name to others after it has moved itself, so every name is followed through all later rounds
        root = steps[0].select(F.col("from").alias("id"), F.col("to").alias("root"))
        for low in steps[1:]:
            root = root.join(low, root["root"] == low["from"], "left").select("id", F.coalesce("to", "root").alias("root"))
        root = work.written(root, "roots")
        least = work.written(root.groupBy("root").agg(F.min("id").alias("component")), "least")
        return written(root.join(least, "root").select("id", "component"), "components")


def _cells(member: DataFrame) -> DataFrame:
    """Rows of open buckets, sent to the cells that they are part of.

    ``out`` marks the nodes outside the bucket's largest component; ``n`` and
    ``n_out`` count the bucket's nodes and those.  Cell (i, j) holds the i-th
    block of the outside nodes (``left``) and the j-th block of all nodes.
    """
    at = F.xxhash64("id")
    blocks_out, blocks = F.ceil(F.col("n_out") / BLOCK), F.ceil(F.col("n") / BLOCK)
    member = member.withColumn("bi", F.pmod(at, blocks_out)).withColumn("bj", F.pmod(F.xxhash64(F.lit(1), "id"), blocks))
    right = member.select("*", F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0).cast("long"), blocks_out - 1)).alias("i"), F.col("bj").alias("j"))
    left = member.where("out").select("*", F.lit(True).alias("left"), F.col("bi").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("j"))
    return right.union(left).drop("n", "n_out", "bi", "bj")


def _by_cell(batches):
    """The rows of each cell, of batches that are sorted by (key, i, j)."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        table = rows if held is None else pa.concat_tables([held, rows])
        if not table.num_rows:
            continue
        k, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
        cut = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        edges = [0, *cut.tolist()]
        for a, b in zip(edges, edges[1:]):
            yield table.slice(a, b - a)
        held = table.slice(edges[-1])
    if held is not None and held.num_rows:
        yield held


def _likely_in(cell: pa.Table):
    """For each left row of a cell (by position) the positions of its likely partners, as far as this band is their first common one."""
    regs = np.frombuffer(b"".join(cell.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    ids, comp, size, left, out = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("id", "component", "n_shingles", "left", "out"))
    band = cell.column("band")[0].as_py()
    right = np.flatnonzero(~left)
    theirs, bands = regs[right], regs[right].reshape(-1, BANDS, ROWS)
    for x in np.flatnonzero(left):
        equal = theirs == regs[x]
        n, higher = equal.sum(1), (theirs < regs[x]).sum(1)
        ok = (comp[right] != comp[x]) & (~out[right] | (ids[right] < ids[x])) & likely(n, higher, REGISTERS - n - higher, size[x], size[right])
        ok = np.flatnonzero(ok)
        if len(ok):
            ok = ok[(bands[ok] == regs[x].reshape(BANDS, ROWS)).all(2).argmax(1) == band]
        if len(ok):
            yield int(x), right[ok]


def _likely_rows(batches):
    """The rows of each cell that have a likely partner in it."""
    for cell in _by_cell(batches):
        own = sorted({r for x, near in _likely_in(cell) for r in (x, *near.tolist())})
        if own:
            yield from cell.take(pa.array(own)).combine_chunks().to_batches()


def _linked_rows(batches):
    """Links between components in each cell, by exact comparison; none that others imply."""
    for cell in _by_cell(batches):
        ids, comp, size = (cell.column(c).to_numpy() for c in ("id", "component", "n_shingles"))
        comp = comp.copy()
        _, local = np.unique(np.frombuffer(b"".join(cell.column("set").to_pylist()), np.uint64), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        mark = np.zeros(int(local.max(initial=0)) + 1, np.int64)
        out: tuple[list, list] = ([], [])
        for x, near in _likely_in(cell):
            near = near[comp[near] != comp[x]]
            if not len(near):
                continue
            own = local[starts[x] : starts[x] + size[x]]
            mark[own] = 1
            flat = np.concatenate([local[starts[r] : starts[r] + size[r]] for r in near])
            both = np.add.reduceat(mark[flat], np.concatenate([[0], np.cumsum(size[near])[:-1]]))
            mark[own] = 0
            for r in near[DEN * both >= NUM * (size[x] + size[near] - both)]:
                if comp[r] != comp[x]:
                    out[0].append(ids[x])
                    out[1].append(ids[r])
                    comp[comp == comp[r]] = comp[x]
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["a", "b"])


def _in_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")


def _open_links(shared: DataFrame, comp: DataFrame, nodes: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """Links between components that share a bucket."""
    member = shared.join(comp, "id", "left").select("band", "key", "id", F.coalesce("component", "id").alias("component"))
    part = member.groupBy("key", "component").agg(F.count("*").alias("n"))
    # the largest component of each bucket, the first among equals
    most = part.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("component", F.struct("n", -F.col("component"))).alias("largest")).where("n > most")
    most = most.select("key", "n", (F.col("n") - F.col("most")).alias("n_out"), "largest")
    member = work.written(member.join(most, "key").withColumn("out", F.col("component") != F.col("largest")).drop("largest"), "open")
    cells = _cells(member.join(nodes.select("id", "n_shingles", "regs"), "id"))
    found = _in_cells(cells).mapInArrow(_likely_rows, cells.schema)
    return _in_cells(found.join(sets, "id")).mapInArrow(_linked_rows, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for each input row."""
    docs = docs.select(F.col(id_col).alias("id"), "text")
    sk = written(sketch(docs, "id"), "sketch")
    full = sk.where("digest is not null and id is not null")
    repeated = full.groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least != most")
    repeated_ids = bool(repeated.take(1))
    with Workspace(docs.sparkSession, "near-dedup") as work:
        if repeated_ids:
            full = written(full.join(repeated, "id", "left").where("least is null or digest = least").drop("least", "most"), "sketch")
        nodes = full.groupBy("digest").agg(F.min(F.struct("id", "n_shingles", "regs", "keys")).alias("x")).select("digest", "x.*")
        nodes = written(nodes, "nodes")
        bands = nodes.select("id", F.posexplode("keys").alias("band", "key"))
        sizes = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        shared = work.written(bands.join(sizes, "key"), "bands")  # only keys with more than one node
        weight = shared.groupBy("id").agg(F.sum("n").alias("weight"))
        weighed = shared.join(weight, "id")
        centres = weighed.groupBy("key").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("centre"))
        pairs = shared.join(centres, "key").where("id != centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
        likely_pairs = work.written(_estimated(pairs, nodes), "pairs")

        wanted = weight.select("id").join(nodes.select("id", "digest"), "id")
        sets = work.written(_sets(docs.join(wanted, "id")), "sets")
        links = work.written(_confirmed(likely_pairs, sets), "links")
        comp = components(links)
        found, n = work.counted(_open_links(shared, comp, nodes, sets, work), "links")
        if n:
            comp = components(links.union(found))
        of_node = nodes.select("digest", "id").join(comp, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
        of_node = written(of_node, "of_node")  # as a table, so that the join may split the copies of one text
    of_id = full.select("id", "digest").distinct().join(of_node, "digest").select("id", "component") if repeated_ids else None
    out = sk.join(of_id, "id", "left") if repeated_ids else sk.join(of_node, "digest", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.col("id").isNull() | (component == F.col("id"))).alias("kept"))
