"""Near-duplicate components by min-max hashing.

Every permutation is evaluated once over a document's word shingles and gives
two signature values, its minimum and its maximum; each agrees between two
documents with probability equal to their Jaccard similarity. Bands of
``rows`` values bucket the documents. Buckets only propose: documents that
share buckets, directly or through others, form a candidate cluster. Clusters of
more than one block are taken apart first: two sets at the wanted similarity must
share a shingle among each one's first few in any common order of the shingles, so
with the common ones last, documents that only share common text fall apart. Every
pair inside a cluster is then compared on its full shingle sets, in blocks, and
the exact links give the components.

With the defaults (128 permutations, 256 values, 51 bands of 5) a pair at
similarity 0.75 shares no bucket with probability 1e-6.

Scale: equal sets collapse to one representative first (a grouped minimum).
Buckets are grouped to their smallest member, never collected; clusters above
``block_docs`` documents or ``block_bytes`` of text are cut into blocks by a
hash of the id, and each pair of blocks is one task's group, so no group is
larger than two blocks (or two single documents, where those are longer).
Only texts of clusters are shuffled; a bitmap of fixed size tells most others.
Nothing is capped: a larger cluster only has more blocks. At most ``COMMON`` common
shingles are broadcast; any choice of them gives the same links.

Cases: null or wordless texts have no shingle and are linked with nothing; a
null id is never linked and has a null component; repeated rows share a
component and all repeat its verdict; input columns other than the two named
ones are ignored, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm import shingles as S
from fieldcraft.llm.graph import components
from fieldcraft.llm.membership import bound_batches, rows_of
from fieldcraft.session import drop_scratch, materialize

PERMUTATIONS, ROWS, SEED = 128, 5, 20240501
BLOCK_DOCS, BLOCK_BYTES = 256, 4 << 20
#: shingles that count as common at most
COMMON = 1 << 17
SIGNATURE = "id long, n long, fp binary, size long, bands array<bigint>"


def _multipliers(k: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_max(hashes: np.ndarray, at: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """Signatures of the non-empty runs of ``hashes`` that begin at ``at``:
    the minima under all permutations, then the maxima."""
    k = len(mult)
    sig = np.empty((len(at), 2 * k), np.uint64)
    for j in range(k):
        h = hashes * mult[j]
        sig[:, j] = np.minimum.reduceat(h, at)
        sig[:, k + j] = np.maximum.reduceat(h, at)
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` signature values."""
    n = sig.shape[1] // rows
    out = np.empty((len(sig), n), np.uint64)
    for b in range(n):
        key = np.full(len(sig), b + 1, np.uint64)
        for j in range(rows):
            key = S.mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * rows + j])
        out[:, b] = key
    return out


def signatures(docs: DataFrame, permutations: int = PERMUTATIONS, rows: int = ROWS,
               seed: int = SEED) -> DataFrame:
    """``docs(id, text)`` -> id, set size, fingerprint of the set (null if
    empty), UTF-8 bytes, band keys (empty if no shingle)."""

    def run(batches):
        import pyarrow as pa
        mult = _multipliers(permutations, seed)
        n_bands = 2 * permutations // rows
        for batch in batches:
            ids = batch.column("id")
            for row, data, starts in S.blocks(batch.column("text")):
                s, per = S.shingle_hashes(*S.word_hashes(data, starts))
                end = np.cumsum(per)
                full = np.flatnonzero(per)
                keys = np.zeros((len(per), n_bands), np.uint64)
                if len(full):
                    keys[full] = band_keys(min_max(s, (end - per)[full], mult), rows)
                ns, fps = [], []
                for d in range(len(per)):
                    u = np.unique(s[end[d] - per[d]:end[d]])
                    ns.append(len(u))
                    fps.append(hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None)
                offs = np.concatenate(([0], np.cumsum((per > 0) * n_bands))).astype(np.int32)
                yield pa.record_batch([
                    ids.slice(row, len(per)), pa.array(ns, pa.int64()), pa.array(fps, pa.binary()),
                    pa.array(np.diff(np.append(starts, len(data)))),
                    pa.ListArray.from_arrays(pa.array(offs), pa.array(keys[full].ravel().view(np.int64))),
                ], ["id", "n", "fp", "size", "bands"])

    return docs.select("id", "text").mapInArrow(run, SIGNATURE)


def overlaps(left: list[np.ndarray], right: list[np.ndarray], limit: int = 1 << 18):
    """Yield (first left row, matrix) of exact intersection sizes between
    sorted distinct sets; ``limit`` bounds the matches held at once."""
    post = np.concatenate(right) if right else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(right)), [len(x) for x in right])
    order = np.argsort(post, kind="stable")
    post, owner = post[order], owner[order]
    found = []
    for x in left:
        lo = np.searchsorted(post, x, "left")
        found.append((lo, np.searchsorted(post, x, "right") - lo))
    i = 0
    while i < len(left):
        j, total = i, 0
        while j < len(left) and (j == i or total + int(found[j][1].sum()) <= limit):
            total += int(found[j][1].sum())
            j += 1
        lo = np.concatenate([f[0] for f in found[i:j]])
        cnt = np.concatenate([f[1] for f in found[i:j]])
        row = np.repeat(np.arange(j - i), [len(x) for x in left[i:j]])
        at = np.repeat(lo - np.cumsum(cnt) + cnt, cnt) + np.arange(int(cnt.sum()))
        flat = np.repeat(row, cnt) * len(right) + owner[at]
        yield i, np.bincount(flat, minlength=(j - i) * len(right)).reshape(j - i, len(right))
        i = j


def linked_pairs(left, right, percent: int, same: bool):
    """Index pairs with 100 * intersection >= percent * union."""
    nl, nr = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    out = []
    for i, inter in overlaps(left, right):
        union = nl[i:i + len(inter), None] + nr[None, :] - inter
        a, b = np.nonzero((100 * inter >= percent * union) & (union > 0))
        a = a + i
        out.append(np.stack([a, b], 1)[a < b] if same else np.stack([a, b], 1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def spanning(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over ``pairs``."""
    lab = np.arange(n)
    while len(pairs):
        new = lab.copy()
        np.minimum.at(new, pairs[:, 0], lab[pairs[:, 1]])
        np.minimum.at(new, pairs[:, 1], lab[pairs[:, 0]])
        new = np.minimum(new, new[new])
        if (new == lab).all():
            break
        lab = new
    return lab


def _confirm(percent: int):
    def run(key, table):
        import pyarrow as pa
        side = np.asarray(table.column("side"))
        ids = np.asarray(table.column("id"))
        sets = list(S.sets(table.column("text")))
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if len(second):
            p = linked_pairs([sets[i] for i in first], [sets[i] for i in second], percent, False)
            p = np.stack([first[p[:, 0]], second[p[:, 1]]], 1)
        else:
            p = linked_pairs(sets, sets, percent, True)
        lab = spanning(len(ids), p)
        moved = np.flatnonzero(lab != np.arange(len(ids)))
        return pa.table({"a": ids[moved], "b": ids[lab[moved]]})
    return run


def prefix_length(n: int, percent: int) -> int:
    """How many of its first shingles a set of ``n`` needs, so that two sets at the
    similarity share one of them."""
    return n + 1 - -(-percent * n // 100)


def common_shingles(sets: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles of ``sets(shingle)``, at most ``most``, and their
    counts; a cut on the counts, by eight steps a doubling."""
    counts = materialize(sets.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1"), "shingle-counts")
    level = F.floor(F.log2("n") * 8).cast("int")
    cut, room = 1 << 30, most
    # a few hundred levels
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("k")).orderBy(F.desc("level")).collect():
        if r["k"] > room:
            break
        cut, room = r["level"], room - r["k"]
    got = counts.filter(level >= cut).toArrow()  # at most ``most`` rows
    drop_scratch(counts)
    order = np.argsort(np.asarray(got.column("shingle")).view(np.uint64))
    return (np.asarray(got.column("shingle")).view(np.uint64)[order], np.asarray(got.column("n"))[order])


def split_clusters(texts: DataFrame, percent: int, most: int = COMMON) -> DataFrame:
    """``texts(id, component, text)`` of large clusters -> ``node, part``: documents of a
    cluster that may be linked, directly or through others, share a part; documents
    without a row share a first shingle with none."""
    def record(batch, sets):
        """One row per document and shingle."""
        import pyarrow as pa
        n = [len(one) for one in sets]
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        return pa.record_batch([*[pa.array(np.repeat(np.asarray(batch.column(c)), n)) for c in ("id", "component")],
                                pa.array(flat.view(np.int64))], ["id", "component", "shingle"])

    def explode(batches):
        for batch in batches:
            if batch.num_rows:
                yield record(batch, list(S.sets(batch.column("text"))))

    every = texts.select("id", "component", "text").mapInArrow(explode, "id long, component long, shingle long")
    known = texts.sparkSession.sparkContext.broadcast(common_shingles(every.select("shingle"), most))

    def first(batches):
        common, times = known.value
        for batch in batches:
            out = []
            for one in S.sets(batch.column("text")):
                at = np.minimum(np.searchsorted(common, one), max(len(common) - 1, 0))
                n = np.where(common[at] == one, times[at], 0) if len(common) else np.zeros(len(one), np.int64)
                out.append(one[np.lexsort((one, n))][:prefix_length(len(one), percent)])
            if out:
                yield record(batch, out)

    rows = materialize(texts.select("id", "component", "text")
                       .mapInArrow(first, "id long, component long, shingle long"), "prefixes")
    lead = (rows.groupBy("component", "shingle").agg(F.min("id").alias("lead"), F.count("*").alias("n"))
            .filter("n > 1").drop("n"))
    # a document and all its leads join its smallest lead: near copies share their
    # leads, so a group of them leaves one edge each and a few between the leads
    hub = (rows.join(lead, ["component", "shingle"]).groupBy("id")
           .agg(F.min("lead").alias("b"), F.collect_set("lead").alias("leads")))
    star = hub.select(F.explode(F.array_union("leads", F.array("id"))).alias("a"), "b").filter("a <> b").distinct()
    out = materialize(components(star).withColumnRenamed("component", "part"), "parts")
    drop_scratch(rows)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 75, permutations: int = PERMUTATIONS, rows: int = ROWS,
                    seed: int = SEED, block_docs: int = BLOCK_DOCS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``."""
    bound_batches(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sig = materialize(signatures(docs, permutations, rows, seed), "signatures")

    reps = (sig.filter("fp IS NOT NULL AND id IS NOT NULL").groupBy("fp")
            .agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands"),
                 F.min_by("size", "id").alias("size"), F.count("*").alias("copies")))
    reps = materialize(reps, "representatives")

    in_band = reps.select("rep", F.explode("bands").alias("band"))
    lead = (in_band.groupBy("band").agg(F.min("rep").alias("lead"), F.count("*").alias("n"))
            .filter("n > 1").select("band", "lead"))
    star = in_band.join(lead, "band").filter("rep <> lead").select(F.col("rep").alias("a"),
                                                                    F.col("lead").alias("b"))
    cluster = materialize(components(star), "clusters")
    sizes = reps.groupBy(F.col("rep").alias("node")).agg(F.sum("size").alias("size"))
    member = cluster.join(sizes, "node")
    def in_blocks(some: DataFrame) -> DataFrame:
        """Members of clusters with their number of blocks and their block."""
        span = (some.groupBy("component").agg(F.count("*").alias("m"), F.sum("size").alias("bytes"))
                .filter("m > 1")
                .select("component", F.greatest(F.ceil(F.col("m") / block_docs),
                                                F.ceil(F.col("bytes") / block_bytes),
                                                F.lit(1)).cast("int").alias("nb")))
        return some.join(span, "component").select(
            F.col("node").alias("id"), "component", "size", "nb",
            F.pmod(F.xxhash64("node"), F.col("nb")).cast("int").alias("blk"))

    member = materialize(in_blocks(member), "members")
    scratch = [member]
    large = member.filter("nb > 1").select(F.col("id").alias("node"), "component", "size")
    if not large.isEmpty():
        parts = split_clusters(rows_of(docs, "id", large.select("node", "component"), "node")
                               .select("id", "component", "text"), percent)
        smaller = in_blocks(large.drop("component").join(parts, "node").withColumnRenamed("part", "component"))
        member = materialize(member.filter("nb = 1").unionByName(smaller), "members")
        scratch += [parts, member]
    member = member.drop("size")
    texts = rows_of(docs, "id", member.withColumnRenamed("id", "node"), "node").drop("node")
    texts = texts.dropDuplicates(["id", "text"]) if _repeats(sig) else texts
    spread = (texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("component", F.least("blk", "other").alias("bi"),
                      F.greatest("blk", "other").alias("bj"),
                      (F.col("blk") > F.col("other")).cast("int").alias("side"), "id", "text"))
    links = materialize(spread.groupBy("component", "bi", "bj")
                        .applyInArrow(_confirm(percent), "a long, b long"), "links")
    comp = components(links)

    copies = reps.filter("copies > 1").select(F.col("fp").alias("cfp"), "rep")
    out = (sig.select("id", "n", "fp").join(copies, F.col("fp") == F.col("cfp"), "left")
           .withColumn("node", F.coalesce("rep", F.when(F.col("fp").isNotNull(), F.col("id"))))
           .join(comp, "node", "left")
           .withColumn("component", F.coalesce("component", "node", "id")))
    out = materialize(out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                 F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"),
                                 F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept")),
                      "near")
    for t in (sig, reps, cluster, links, *scratch):
        drop_scratch(t)
    return out


def _repeats(sig: DataFrame) -> bool:
    """Does any id occur on more than one row?"""
    return bool(sig.groupBy("id").count().filter("count > 1").limit(1).count())
