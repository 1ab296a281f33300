"""Self-join of documents by the Jaccard similarity of their word n-grams, with set-relation skipping.

The join is exact up to collisions of 64-bit shingle hashes.  Two relations
between sets keep it far from all pairs:

* Position blocks.  A set's prefix, under one order of all shingles, must meet
  the prefix of any set that it links with.  Each inverted list is cut into
  blocks of equal (set size, position, family); whether two blocks can hold a
  link follows from their sizes and positions alone, so that whole blocks are
  skipped; of the pairs that are left, the shared prefix shingles are counted and
  bounded before the whole sets are looked at.
* Families.  A set joins the family of the set that it shares most prefix
  shingles with (at least one in FAMILY_SHARE of its own), or, if its prefix
  has frequent ones, that of the first set in its longest list.  Within a family the overlaps of the
  first member, the pivot, with all others are computed once; those of any other
  member are derived from them by the few shingles in which it differs from the
  pivot.  Pairs within a family never become rows: each task hands on link
  counts and a spanning forest.

Equal sets are one class before anything is compared.  The order of shingles is
"frequent ones last, else by hash".  What counts as frequent comes from counts
over all documents and reaches the tasks as a bitmap of fixed size; any bitmap
gives the same links, a good one gives short lists.  A list or family that is
large all the same is cut into blocks, and each task has two of them.

Defined results: a null text, an empty one or one without words has no shingles
and is linked with nothing, not even its like; fewer words than ``width`` make
one shingle of the whole sequence; repeated rows are copies and link; a null id
counts for nothing in a component's smallest id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, fresh, small_batches, table
from .components import connected_components
from .shingles import release_memory, shingle_sets, slices

#: Size of the bitmap of frequent shingles, in bits, and the number of them that it is meant for.
HOT_BITS, HOT_MOST = 1 << 24, 1 << 20
#: A shingle in more sets than this is frequent (more, if there are over HOT_MOST such shingles).
HOT_FROM = 16
#: A set joins a family if it shares one in so many of its prefix shingles with the family's first set.
FAMILY_SHARE = 2
#: Members of a block of a list, and members and shingles of a block of a family.
LIST_BLOCK, FAMILY_BLOCK, FAMILY_SHINGLES = 2048, 512, 1 << 21


def _prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _sql_prefix(n: str, percent: int) -> str:
    return f"({n} - cast(ceil({percent} * {n} / 100) as int) + 1)"


def _count_shingles(width: int, percent: int):
    """(token, n): those in several sets of a batch with their counts, and the first of each set's others, once each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            sets = list({s.tobytes(): s for s in shingle_sets(batch.column("text"), width) if len(s)}.values())
            if not sets:
                continue
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            tokens = np.concatenate(sets)
            distinct, inverse, n = np.unique(tokens, return_inverse=True, return_counts=True)
            shared = n >= 3
            cold = ~shared[inverse]
            seen = np.concatenate([[0], np.cumsum(cold)])
            begins = np.concatenate([[0], np.cumsum(sizes)])
            most = _prefix_length(sizes, percent) * 3 // 2 + 8
            rank = seen[:-1] - np.repeat(seen[begins[:-1]], sizes)
            first = tokens[cold & (rank < np.repeat(most, sizes))]
            for t, k in ((distinct[shared], n[shared]), (first, np.ones(len(first), np.int64))):
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(k.astype(np.int64))], names=["token", "n"])
        release_memory()

    return count


def frequent_bitmap(docs: DataFrame, scratch: Scratch, width: int, percent: int) -> np.ndarray:
    """The bitmap of frequent shingles, by the low bits of their hashes; HOT_BITS / 8 bytes."""
    counts = docs.select("text").mapInArrow(_count_shingles(width, percent), "token long, n long")
    counts = scratch.table(counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > HOT_FROM), "frequent")
    # the least threshold that keeps the collected list within HOT_MOST shingles
    steps = counts.groupBy(F.floor(F.log2("n") * 4).alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in steps:
        total += r["count"]
        if total > HOT_MOST:
            break
        least = r["step"]
    bits = np.zeros(HOT_BITS // 8, np.uint8)
    if least is not None:
        kept = counts.where(F.floor(F.log2("n") * 4) >= least).select("token").toArrow().column("token").to_numpy()
        at = kept.view(np.uint64) & np.uint64(HOT_BITS - 1)
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (np.uint64(1) << (at & np.uint64(7))).astype(np.uint8))
    scratch.drop("frequent")
    return bits


def _is_hot(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = tokens & np.uint64(HOT_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _prefixes(width: int, percent: int, shared):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in (part for whole in batches for part in slices(whole, "text")):
            sets = shingle_sets(batch.column("text"), width)
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
            hot = _is_hot(bits, tokens)
            heads, digests = [], []
            begin = 0
            for s, n in zip(sets, sizes.tolist()):
                h = hot[begin : begin + n]
                begin += n
                p = _prefix_length(n, percent) if n else 0
                cold = s[~h]
                heads.append((cold[:p] if len(cold) >= p else np.concatenate([cold, s[h][: p - len(cold)]])).view(np.int64))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            edges = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate([*heads, np.zeros(0, np.int64)]))),
                ],
                names=["doc_id", "text_key", "n_shingles", "digest", "prefix"],
            )
        release_memory()

    return prefixes


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows, and the number of rows at the end."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


def grouped_batches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups, of batches sorted by ``keys``; each has all groups that a batch completes."""
    carried: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _runs(*(batch.column(k).to_numpy(zero_copy_only=False) for k in keys))[:-1]
        last = int(starts[-1])
        same = bool(carried) and all(carried[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
        if same and last == 0:
            carried.append(batch)
            continue
        if not same and carried and last == 0:
            yield pa.Table.from_batches(carried)
            carried = [batch]
            continue
        if carried or last:
            yield pa.Table.from_batches([*carried, batch.slice(0, last)])
        carried = [batch.slice(last)]
    if carried:
        yield pa.Table.from_batches(carried)


#: Member pairs that are expanded at a time.
EXPAND = 1 << 20


def _expand(first, first_len, second, second_len):
    """All pairs of two runs, for many pairs of runs: indices of members."""
    n = first_len * second_len
    total = int(n.sum())
    which = np.repeat(np.arange(len(n)), n)
    at = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    return first[which] + at // second_len[which], second[which] + at % second_len[which]


def _candidates(percent: int):
    """(a, b) for every list in which two sets of different families meet and their positions allow a link."""

    def need(x, y):
        return -(-percent * (x + y) // (100 + percent))

    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        token, bi, bj, n, pos, family, cls, side = (t.column(c).to_numpy() for c in ("token", "bi", "bj", "n", "pos", "family", "cls", "side"))
        n, pos = n.astype(np.int64), pos.astype(np.int64)
        edge = _runs(token, bi, bj, n, pos, family, side)
        s, length = edge[:-1], np.diff(edge)
        group = np.cumsum(np.isin(s, _runs(token, bi, bj)[:-1]))
        bn, bp, bf, bs = n[s], pos[s], family[s], side[s]
        split = bi[s] != bj[s]
        out = []
        # blocks of a list are in order of size, so that a block whose next is too large is done with the list
        live, shift = np.arange(len(s)), 0
        while True:
            shift += 1
            live = live[live + shift < len(s)]
            other = live + shift
            keep = (group[live] == group[other]) & (100 * bn[live] >= percent * bn[other])
            live, other = live[keep], other[keep]
            if not len(live):
                break
            # as if the list's shingle were the first that the two share; the list of the one that is keeps the pair
            bound = np.minimum(bn[live] - bp[live], bn[other] - bp[other])
            hit = (bf[live] != bf[other]) & (bound >= need(bn[live], bn[other])) & ~(split[live] & (bs[live] == bs[other]))
            if hit.any():
                out.append((live[hit], other[hit]))
        if not out:
            return
        x, y = (np.concatenate(z) for z in zip(*out))
        cost = np.cumsum(length[x] * length[y])
        for part in np.split(np.arange(len(x)), np.searchsorted(cost, np.arange(EXPAND, int(cost[-1]) + 1, EXPAND))):
            if len(part):
                i, j = _expand(s[x[part]], length[x[part]], s[y[part]], length[y[part]])
                swap = cls[i] > cls[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cls[i], cls[j])], names=["a", "b"])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_batches(batches, ["token", "bi", "bj"]):
            yield from of(t)

    return candidates


def _sets_of(width: int):
    """(cls, set) of the texts whose set is the class's."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            sets = shingle_sets(batch.column("text"), width)
            raw = [s.tobytes() for s in sets]
            same = [hashlib.blake2b(r, digest_size=16).digest() == d for r, d in zip(raw, batch.column("digest").to_pylist())]
            out = pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(raw, pa.binary())], names=["cls", "shingles"])
            yield out.filter(pa.array(same, pa.bool_()))
        release_memory()

    return of


def _family_links(percent: int):
    """(cls, root, links): of each member of a block pair that has links in it."""

    def evaluate(cls, copies, sides, split, sets):
        g = len(cls)
        sizes = np.fromiter(map(len, sets), np.int64, g)
        distinct, inverse = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(g), sizes)
        order = np.argsort(inverse, kind="stable")
        holders, ends = owner[order], np.cumsum(np.bincount(inverse, minlength=len(distinct)))
        starts = np.concatenate([[0], ends[:-1]])
        begins = np.concatenate([[0], np.cumsum(sizes)])
        mine = [inverse[begins[i] : begins[i + 1]] for i in range(g)]

        def answers(tokens):
            """How many of the tokens each member holds."""
            if not len(tokens):
                return np.zeros(g, np.int64)
            n = ends[tokens] - starts[tokens]
            at = np.repeat(starts[tokens] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            return np.bincount(holders[at], minlength=g)

        pivot = np.zeros(len(distinct), bool)
        pivot[mine[0]] = True
        base = answers(mine[0])
        parent, links = list(range(g)), np.zeros(g, np.int64)

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in range(g):
            shared = pivot[mine[i]]
            if 2 * int(shared.sum()) > len(mine[0]) and i:
                # derived from the pivot's answers by the shingles in which the two differ
                kept = np.zeros(len(distinct), bool)
                kept[mine[i][shared]] = True
                gone = mine[0][~kept[mine[0]]]
                overlap = base - answers(gone) + answers(mine[i][~shared])
            else:
                overlap = base if not i else answers(mine[i])
            later = np.arange(i + 1, g)
            if split:
                later = later[sides[later] != sides[i]]
            hit = later[100 * overlap[later] >= percent * (sizes[i] + sizes[later] - overlap[later])]
            if len(hit):
                links[i] += int(copies[hit].sum())
                links[hit] += copies[i]
                for j in hit.tolist():
                    a, b = root(i), root(j)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
        has = np.flatnonzero(links)
        return cls[has], cls[[root(i) for i in has.tolist()]] if len(has) else cls[has], links[has]

    def family_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_batches(batches, ["family", "bi", "bj"]):
            family, bi, bj, cls, copies, side = (t.column(c).to_numpy() for c in ("family", "bi", "bj", "cls", "copies", "side"))
            raw = t.column("shingles")
            edge = _runs(family, bi, bj)
            found = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if b - a > 1:
                    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in raw[a:b]]
                    found.append(evaluate(cls[a:b], copies[a:b], side[a:b], bool(bi[a] != bj[a]), sets))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)], names=["cls", "root", "links"])
        release_memory()

    return family_links


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b", "ca", "cb"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _block_pairs(df: DataFrame, blocks: str, keys: list[str]) -> DataFrame:
    """Each row once for every pair of blocks that has its block: columns bi <= bj and side (the row's own block)."""
    return (
        df.withColumn("side", F.pmod(F.xxhash64("cls"), F.expr(f"cast({blocks} as long)")).cast("int"))
        .withColumn("other", F.explode(F.expr(f"sequence(0, cast({blocks} as int) - 1)")))
        .withColumn("bi", F.least("side", "other"))
        .withColumn("bj", F.greatest("side", "other"))
    )


def jaccard_join(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """Links documents whose sets of ``width``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.

    ``docs`` needs doc_id and text.  Returns, per row of ``docs``: doc_id,
    text_key (hash of the text), n_shingles, component_id (smallest id reachable
    by links), component (a key of the component; null without shingles) and
    n_links (number of rows it links with).
    """
    with small_batches(docs.sparkSession):
        return _jaccard_join(docs, width, percent)


def _jaccard_join(docs: DataFrame, width: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = spark.sparkContext.broadcast(frequent_bitmap(texts, scratch, width, percent))
    base = texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _prefixes(width, percent, bits), "doc_id long, text_key long, n_shingles long, digest binary, prefix array<long>"
    )
    base = scratch.table(base, "base")
    classes = (
        base.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").cast("int").alias("n"), F.first("prefix").alias("prefix"))
        .withColumn("cls", F.monotonically_increasing_id())
    )
    classes = scratch.table(classes, "classes")

    # inverted lists of prefixes that have two members or more
    postings = classes.select("cls", "n", F.posexplode("prefix").alias("pos", "token"))
    # counted before the shuffle; a list that is hot is split where its rows meet its count, as both are written or read anew
    counts = postings.groupBy(F.col("token").alias("t")).agg(F.min("cls").alias("low"), F.count(F.lit(1)).alias("df")).where("df > 1")
    counts = scratch.table(counts, "counts")
    lists = scratch.table(postings.join(counts, F.col("token") == F.col("t")).drop("t"), "lists")

    # families: a set with frequent shingles in its prefix has little else; it goes with its longest list's first set,
    # any other with the set that it shares most with
    votes = lists.groupBy("cls", "low").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n"), F.max("df").alias("df"))
    families = votes.groupBy("cls").agg(F.max(F.struct("k", (-F.col("low")).alias("low"), "n")).alias("x"), F.max(F.struct("df", (-F.col("low")).alias("low"))).alias("y"))
    families = families.selectExpr("cls", f"if(y.df > {HOT_FROM}, -y.low, if({FAMILY_SHARE} * x.k >= {_sql_prefix('x.n', percent)}, -x.low, cls)) family")
    families = scratch.table(families, "families1")
    for i in (2, 3):  # a head that is in a family itself hands on its own
        up = families.select(F.col("cls").alias("head"), F.col("family").alias("up"))
        families = scratch.table(families.join(up, F.col("family") == F.col("head"), "left").select("cls", F.coalesce("up", "family").alias("family")), f"families{i}")

    # pairs of different families
    met = _block_pairs(lists.drop("low").join(families, "cls"), f"ceil(df / {LIST_BLOCK})", ["token"])
    met = met.select("token", "bi", "bj", "n", "pos", "family", "side", "cls").repartition("token", "bi", "bj")
    met = met.sortWithinPartitions("token", "bi", "bj", "n", "pos", "family", "side")
    pairs = scratch.table(met.mapInArrow(_candidates(percent), "a long, b long").distinct(), "met")
    heads = classes.select("cls", "n", "prefix")
    pairs = pairs.join(heads.toDF("a", "na", "pa"), "a").join(heads.toDF("b", "nb", "pb"), "b")
    # the shared shingles of the prefixes, and at most what stands behind them
    bound = f"size(array_intersect(pa, pb)) + greatest(na - {_sql_prefix('na', percent)}, nb - {_sql_prefix('nb', percent)})"
    pairs = scratch.table(pairs.where(f"{bound} >= ceil({percent} * (na + nb) / {100 + percent})").select("a", "b"), "pairs")

    sizes = families.join(classes.select("cls", "n"), "cls").groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")).where("members > 1")
    # written, so that the join by family reads two shuffles and a hot family can be split
    sizes = scratch.table(sizes, "sizes")
    members = families.join(sizes, "family").selectExpr("cls", "family", f"greatest(ceil(members / {FAMILY_BLOCK}), ceil(shingles / {FAMILY_SHINGLES})) blocks")
    members = scratch.table(members, "members")

    # the whole sets of all classes that are still in question, once more from their texts
    asked = members.select("cls").union(pairs.select("a")).union(pairs.select("b")).distinct()
    asked = classes.select("cls", "digest", "rep", "copies").join(asked, "cls")
    found = texts.withColumn("text_key", F.xxhash64("text")).join(asked.drop("copies"), F.col("doc_id").eqNullSafe(F.col("rep")))
    found = found.dropDuplicates(["doc_id", "cls", "text_key"]).select("cls", "digest", "text")
    sets = scratch.table(found.mapInArrow(_sets_of(width), "cls long, shingles binary"), "sets").join(classes.select("cls", "copies"), "cls")

    inside = _block_pairs(members.join(sets, "cls"), "blocks", ["family"]).select("family", "bi", "bj", "cls", "copies", "side", "shingles")
    inside = inside.repartition("family", "bi", "bj").sortWithinPartitions("family", "bi", "bj", "cls")
    inside = scratch.table(inside.mapInArrow(_family_links(percent), "cls long, root long, links long"), "inside")
    across = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"), F.col("copies").alias("ca")), "a")
    across = across.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"), F.col("copies").alias("cb")), "b")
    across = scratch.table(across.select("a", "b", "ca", "cb", "sa", "sb").mapInArrow(_verify(percent), "a long, b long, ca long, cb long"), "across")

    labels = connected_components(inside.selectExpr("cls u", "root v").union(across.selectExpr("a u", "b v")), scratch)
    links = inside.selectExpr("cls", "links").union(across.selectExpr("a", "cb")).union(across.selectExpr("b", "ca")).groupBy("cls").agg(F.sum("links").alias("links"))
    known = classes.select("cls", "digest", "rep", "copies").join(labels.withColumnRenamed("node", "cls"), "cls", "left").join(links, "cls", "left")
    known = scratch.table(known.selectExpr("digest", "rep", "copies", "coalesce(label, cls) component", "coalesce(links, 0) links"), "known")
    least = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = scratch.table(known.join(least, "component").drop("rep"), "classified")
    scratch.drop("counts", "lists", "sizes", "sets", "families1", "families2", "families3", "members", "inside", "across", "met", "pairs", "known", "classes", "edges")
    own = base.select("doc_id", "text_key", "n_shingles", "digest")
    result = own.join(known, "digest", "left").selectExpr(
        "doc_id", "text_key", "n_shingles",
        "if(n_shingles > 0, component_id, doc_id) component_id",
        "if(n_shingles > 0, component, null) component",
        "if(n_shingles > 0, copies - 1 + links, 0) n_links",
    )
    result = scratch.table(result, "result")
    scratch.drop("base", "classified")
    bits.unpersist()
    return result


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` without all but one row of each component: the row of the smallest id; rows without shingles stay."""
    joined = jaccard_join(docs, **how)
    kept = joined.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("x"))
    kept_id, kept_key, key = fresh(docs, "kept_id", "kept_key", "text_key")
    kept = kept.select(F.col("x.doc_id").alias(kept_id), F.col("x.text_key").alias(kept_key))
    keyed = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    single = keyed.where(has_words).join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key)), "left_semi")
    single = single.dropDuplicates(["doc_id", key])
    return single.unionByName(keyed.where(~has_words)).select(*docs.columns)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_links")


#: Pairs are compared with all others by their shared shingles; the components by a recursive walk.
OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END)) AS g FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (SELECT o.a, o.b FROM o JOIN n AS x ON x.doc_id = o.a JOIN n AS y ON y.doc_id = o.b WHERE 100 * k >= 85 * (x.n + y.n - k)
), r AS (SELECT doc_id AS node, doc_id AS reached FROM d UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(reached) FROM r WHERE node = d.doc_id) AS component_id,
  (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""
