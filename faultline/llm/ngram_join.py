"""Near copies by T-occurrence search over word n-grams.

Two texts link when ``100 * common >= percent * union`` of their sets of word n-grams. The result is the class of each
text under these links: the smallest id that links lead to.

1. Rows are numbered once and written. Texts with one and the same set are one node from the start, named by its first row.
2. Of each set, the ``p`` grams of smallest hash are posted. A text may miss at most ``a = n - ceil(percent * n)`` grams of a
   partner, so with ``p = a + T`` posted grams any partner shares at least ``T`` of them. Grams posted once are dropped, then
   texts with fewer than ``T`` shared grams; of the others only the rarest ``shared - T + 1`` grams are kept,
   as at least one of ``T`` common grams is among them. A passage that many texts share is thus skipped as
   long as the text has enough of its own.
   A map task passes on at most ``RARE`` rows of a gram to be counted with others; more than that many are known to be
   frequent, and need not meet.
3. Texts that share a kept gram form a cluster, by connected components; the rows of a gram are chained within each map task
   first, so only ranges of sizes that no chain spans are shuffled. Their whole sets meet in one task, or, if the cluster is
   larger than a block, each pair of blocks does.
4. In a task every text is searched by DivideSkip: the ``L`` longest of its inverted lists are set aside, the short ones are
   merged by counting, texts found on at least ``T - L`` of them are looked up in the long lists by binary search (or these
   are merged too, if that takes fewer steps), and those that reach the overlap link. First, texts are searched among leaders (texts that found no leader before them); texts
   of the largest class need no further search, all others are searched among all texts.
5. The links found, a forest per task, are merged by connected components, every copy gets the class of its node, and classes
   get the smallest id of their rows.

Nothing is capped: bounds only size blocks. Pairs are never emitted.

Defined cases: null, empty and blank texts have no grams, link with nothing and are their own class; a text with fewer words than a gram
is one gram; rows of one id are one document for the class (``near_copies``), each with its own number of grams, and texts of
their own when one of a class is kept (``one_of_each``); rows without an id take part by their text and get the smallest id of
their class, null if there is none; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline.llm.batches import slices
from faultline.llm.components import components
from faultline.llm.skew import attach
from faultline.llm.words import BY_SPACE, mixed, word_hashes
from faultline.plans.durable import durable, shared_path
from faultline.plans.sizing import MAX_BROADCAST_ROWS, measured_side

SHINGLE = 4
PERCENT = 85
SHARED_PERCENT = 6  # T grows with this share of a set,
SHARED_LEAST = 24  # and small sets must share most of their grams
RARE = 64  # lists are ordered by length up to this
POSTING_BYTES = 8 << 20  # postings that a map task looks at together
CHAIN_ROWS = 1 << 20
MAX_HOT = 1 << 20  # grams that a map task remembers as frequent
BLOCK_TEXTS = 1_024
BLOCK_GRAMS = 1_000_000
_STEP = np.uint64(0xD6E8FEB86659FD93)


def gram_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct gram hashes of each text."""
    counts, hashes = word_hashes(texts, BY_SPACE)
    grams = hashes.copy()
    for i in range(1, size):
        grams[:-i or None] = grams[:-i or None] * _STEP + hashes[i:]
    grams = mixed(grams)
    out = []
    ends = np.cumsum(counts)
    for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if count >= size:
            out.append(np.unique(grams[end - count : end - size + 1]))
        elif count:
            whole = np.uint64(count)
            for word in hashes[end - count : end]:
                whole = np.array([whole], np.uint64) * _STEP + word
            out.append(mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def ceil_percent(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def shared_needed(n: int, percent: int) -> int:
    """``T`` of a set of ``n``; it never falls as ``n`` grows."""
    return max(1 + n * SHARED_PERCENT // 100, min(ceil_percent(n, percent), SHARED_LEAST))


def posted(n: int, percent: int) -> int:
    """How many grams of a set of ``n`` are posted: those it may miss, and those it must share."""
    return min(n, n - ceil_percent(n, percent) + shared_needed(n, percent))


def _staged(docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """``row, doc, n, fp`` (null without grams) and the posted grams, packed; written, so that a row keeps its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(0), batch.column(0).field(text)], ["doc", "text"])
            for part in slices(texts, 1):
                sets = gram_sets(part.column(1), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                        pa.array([s[: posted(len(s), percent)].tobytes() for s in sets], pa.binary()),
                    ],
                    ["doc", "n", "fp", "grams"],
                )

    spark, folder = docs.sparkSession, shared_path(docs.sparkSession, "gram-sets")
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    schema = StructType(list(rows.schema.fields)).add("n", "long").add("fp", "string").add("grams", "binary")
    sets = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    sets.write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, n, grams`` to one row per posted gram; ``sure`` ones are of a gram that this task has sent ``RARE`` times."""
    hot = np.zeros(0, np.int64)
    for batch in batches:
        for part in slices(batch, 2, POSTING_BYTES):
            packed = part.column(2).to_pylist()
            counts = [len(p) // 8 for p in packed]
            gram = np.frombuffer(b"".join(packed), np.int64)
            node = np.repeat(part.column(0).to_numpy(), counts)
            n = np.repeat(part.column(1).to_numpy(), counts)
            order = np.argsort(gram, kind="stable")
            gram, node, n = gram[order], node[order], n[order]
            starts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))[: len(gram)]
            lengths = np.diff(np.append(starts, len(gram)))
            sure = np.arange(len(gram)) - np.repeat(starts, lengths) >= RARE
            if len(hot):
                at = np.minimum(np.searchsorted(hot, gram), len(hot) - 1)
                sure |= hot[at] == gram
            if len(hot) < MAX_HOT:
                hot = np.union1d(hot, gram[starts[lengths >= RARE]])
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(node), pa.array(n), pa.array(sure)], ["gram", "node", "n", "sure"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by gram, those of grams with several rows, with the length of the list up to ``RARE``.

    A list is held back until it ends or reaches ``RARE`` rows, so any list length is read in bounded memory.
    Sure rows pass without being counted; their gram has sent ``RARE`` others.
    """
    held = [np.zeros(0, np.int64)] * 3
    last, passed = None, 0  # rows of the last gram that have been passed on already

    def emit(gram: np.ndarray, node: np.ndarray, n: np.ndarray, ended: bool):
        nonlocal held, last, passed
        if not len(gram):
            return None
        starts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        lengths = np.diff(np.append(starts, len(gram)))
        real = lengths.copy()
        if last is not None and gram[0] == last:
            real[0] += passed
        keep = np.repeat(real >= 2, lengths)
        df = np.repeat(np.minimum(real, RARE), lengths)
        final = starts[-1]
        passed_here = 0
        if not ended and real[-1] < RARE:
            held = [gram[final:], node[final:], n[final:]]
            keep[final:] = False
            if len(starts) == 1 and last is not None and gram[0] == last:
                passed_here = passed
        else:
            held = [gram[:0], node[:0], n[:0]]
            passed_here = int(real[-1])
        last, passed = gram[-1], passed_here
        return pa.RecordBatch.from_arrays(
            [pa.array(gram[keep]), pa.array(node[keep]), pa.array(n[keep]), pa.array(df[keep])], ["gram", "node", "n", "df"]
        )

    for batch in batches:
        sure = batch.column(3).to_numpy(zero_copy_only=False)
        passing = [batch.column(i).to_numpy()[sure] for i in range(3)]
        if sure.any():
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, passing), pa.array(np.full(len(passing[0]), RARE))], ["gram", "node", "n", "df"]
            )
        columns = [np.concatenate([h, batch.column(i).to_numpy()[~sure]]) for i, h in enumerate(held)]
        out = emit(*columns, ended=False)
        if out is not None:
            yield out
    out = emit(*held, ended=True)
    if out is not None:
        yield out


def _roots(node: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the smallest node that groups lead to; groups are runs of one number."""
    nodes, v = np.unique(node, return_inverse=True)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(group))))
    root = np.arange(len(nodes))
    while True:
        least = np.minimum.reduceat(root[v], starts)
        new = root.copy()
        np.minimum.at(new, v, least[group])
        new = np.minimum(new, new[root])  # follow the pointer of the former root
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def chained(gram: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ranges sorted by gram and ``low``: the number of the chain each belongs to, and how far its chain reaches by then.

    A gram joins nodes only as far as their sizes allow links: a chain breaks where the next set is too large for all before.
    """
    new = np.append(True, gram[1:] != gram[:-1])[: len(gram)]
    base = np.cumsum(new) << 40
    reach = np.maximum.accumulate(base + high) - base
    breaks = new.copy()
    breaks[1:] |= 100 * reach[:-1] < percent * low[1:]
    return np.cumsum(breaks), reach


def _chains(percent: int, final: bool):
    """Rows ``gram, low, high, node`` to links ``a, b`` and, but for the ``final`` pass, one such row per chain.

    Before the final pass rows may be in any order; then they are sorted by gram and ``low``, and a chain may go on in the next chunk.
    """
    names = ["gram", "low", "high", "node", "a", "b"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in range(4)])
            size += batch.num_rows
            if size >= CHAIN_ROWS:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held, size = [], 0
        if size:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [np.zeros(0, np.int64)] * 4
        for chunk in chunks(batches):
            gram, low, high, node = (np.concatenate(c) for c in zip(last, chunk, strict=True))
            if not final:
                order = np.lexsort((low, gram))
                gram, low, high, node = gram[order], low[order], high[order], node[order]
            chain, reach = chained(gram, low, high, percent)
            nodes, roots = _roots(node, chain)
            far = nodes != roots
            a, b = nodes[far], roots[far]
            if final:
                last = [gram[-1:], low[-1:], reach[-1:], node[-1:]]
                rest = [np.zeros(0, np.int64)] * 4
            else:
                ends = np.flatnonzero(np.append(chain[1:] != chain[:-1], True))
                starts = np.append(0, ends[:-1] + 1)
                rest = [gram[starts], low[starts], reach[ends], node[starts]]
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([none] * 4 + [pa.array(a), pa.array(b)], names)
            if len(rest[0]):
                none = pa.nulls(len(rest[0]), pa.int64())
                yield pa.RecordBatch.from_arrays([*map(pa.array, rest), none, none], names)

    return run


class Lists:
    """Inverted lists of gram sets, whose grams are numbered from 0; positions rise as sets are added."""

    def __init__(self, grams: int) -> None:
        self.of: list[array | None] = [None] * grams
        self.sets = 0

    def add(self, grams: list[int]) -> None:
        of = self.of
        for gram in grams:
            found = of[gram]
            if found is None:
                of[gram] = array("i", (self.sets,))
            else:
                found.append(self.sets)
        self.sets += 1

    def search(self, grams: list[int], needed: int) -> tuple[np.ndarray, np.ndarray]:
        """DivideSkip: positions and numbers of common grams of all sets that share at least ``needed`` grams."""
        of = self.of
        lists = [found for g in grams if (found := of[g]) is not None]
        if len(lists) < needed:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists.sort(key=len)
        longest = len(lists[-1]).bit_length()
        aside = min(needed - 1, int(needed / (0.02 * longest + 1)))
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        counts = self._merged(short)
        positions = np.flatnonzero(counts >= needed - aside)
        # Where look-ups would take more steps than the long lists are long, these are merged as well.
        if len(positions) * aside * longest > sum(map(len, long)):
            counts += self._merged(long)
        else:
            for left in range(aside, 0, -1):
                if not len(positions):
                    break
                found = np.frombuffer(long[aside - left], np.int32)
                at = np.minimum(np.searchsorted(found, positions), len(found) - 1)
                counts[positions] += found[at] == positions
                positions = positions[counts[positions] + left - 1 >= needed]
        positions = positions[counts[positions] >= needed]
        return positions, counts[positions]

    def _merged(self, lists: list[array]) -> np.ndarray:
        """On how many of the lists each position is."""
        return np.bincount(np.frombuffer(b"".join(lists), np.int32), minlength=self.sets)


class Forest:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)


def link(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the position of the root of its class."""
    forest = Forest(len(sets))
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable").tolist()
    # Grams of one set alone are on no list, so only the others get numbers.
    _, number, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)[number]
    grams = [part[part >= 0].tolist() for part in np.split(shared, np.cumsum(sizes)[:-1])]

    def hits(lists: Lists, ranked: np.ndarray, i: int) -> list[int]:
        n = int(sizes[i])
        found, common = lists.search(grams[i], ceil_percent(n, percent))
        found = ranked[found]
        return found[100 * common >= percent * (n + sizes[found] - common)].tolist()

    count = int((seen > 1).sum())
    leaders = Lists(count)
    ranked = np.zeros(len(sets), np.int64)  # lists hold places in this order, so that they stay sorted
    for i in order:
        found = hits(leaders, ranked, i)
        for j in found:
            forest.join(i, j)
        if not found:
            ranked[leaders.sets] = i
            leaders.add(grams[i])
    roots = [forest.root(i) for i in range(len(sets))]
    members = Counter(roots)
    if len(members) > 1:
        largest = max(members, key=members.__getitem__)
        every, ranked = Lists(count), np.arange(len(sets))
        for i in range(len(sets)):
            every.add(grams[i])
        for i in range(len(sets)):
            if roots[i] != largest:
                for j in hits(every, ranked, i):
                    forest.join(i, j)
    return [forest.root(i) for i in range(len(sets))]


def _linked(size: int, percent: int):
    """Rows of ``cell, node, text`` sorted by cell to edges between each node and the root of its class."""

    def solve(rows: list[tuple[int, str]]) -> pa.RecordBatch:
        nodes, sets = [], []
        for start in range(0, len(rows), 256):
            part = rows[start : start + 256]
            nodes += [node for node, _ in part]
            sets += gram_sets(pa.array([t for _, t in part], pa.string()), size)
        roots = link(sets, percent)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([nodes[r] for r in roots], pa.int64())], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for c, node, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if c != cell:
                    if len(rows) > 1:
                        yield solve(rows)
                    cell, rows = c, []
                rows.append((node, text))
        if len(rows) > 1:
            yield solve(rows)

    return run


def _clusters(nodes: DataFrame, percent: int) -> DataFrame:
    """``node, n, cluster`` of the nodes that may link with another; one link lies within one cluster."""
    postings = nodes.select("node", "n", "grams").mapInArrow(_postings, "gram long, node long, n long, sure boolean")
    # Sure rows go anywhere.
    dealt = postings.repartition(F.when(F.col("sure"), F.xxhash64("node")).otherwise(F.col("gram")))
    sorted_lists = dealt.sortWithinPartitions("gram")
    repeated = sorted_lists.mapInArrow(_repeated, "gram long, node long, n long, df long")
    shared = repeated.groupBy("node").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("shared")
    )
    # The smaller of the two partners decides how many grams they must share.
    smallest = F.ceil(F.col("n") * percent / 100).cast("long")
    needed = F.greatest(
        F.floor(smallest * SHARED_PERCENT / 100) + 1, F.least(F.ceil(smallest * percent / 100), F.lit(SHARED_LEAST))
    )
    rarest = F.slice("shared", F.lit(1), (F.size("shared") - needed + 1).cast("int"))
    kept = shared.where(F.size("shared") >= needed).select("node", "n", rarest.alias("rarest"))
    kept = durable(kept)
    lists = kept.select(F.explode("rarest.gram").alias("gram"), F.col("n").alias("low"), F.col("n").alias("high"), "node")
    schema = "gram long, low long, high long, node long, a long, b long"
    local = durable(lists.mapInArrow(_chains(percent, final=False), schema))
    ranges = local.where("gram is not null").select("gram", "low", "high", "node")
    met = ranges.repartition("gram").sortWithinPartitions("gram", "low").mapInArrow(_chains(percent, final=True), schema)
    edges = local.where("a is not null").unionByName(met).select("a", "b")
    found = components(edges).withColumnRenamed("component", "cluster")
    return found.join(kept.select("node", "n"), "node")


def _cells(clusters: DataFrame) -> DataFrame:
    """``node, cells``: the groups a node takes part in: its cluster, or all pairs of its block with another."""
    sizes = durable(clusters.groupBy("cluster").agg(F.count("*").alias("texts"), F.sum("n").alias("grams")))
    large = sizes.withColumn(
        "blocks", F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("grams") / BLOCK_GRAMS))
    ).select("cluster", "texts", "blocks")
    total = clusters.count()
    sized = attach(clusters, durable(large), "cluster", "texts", total, "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: b != own)
    pairs = F.transform(
        others, lambda b: F.concat_ws("/", F.col("cluster"), F.least(own, b).cast("string"), F.greatest(own, b).cast("string"))
    )
    return sized.select("node", F.when(F.col("blocks") > 1, pairs).otherwise(F.array(F.col("cluster").cast("string"))).alias("cells"))


def _classes(staged: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """``row, doc_id, n, fp, component``: a row number that stands for the class, null for rows without grams."""
    same = staged.where("fp is not null").groupBy("fp").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    same = durable(same)
    named = staged.select(F.col("row").alias("node"), "n", "grams")
    clusters = durable(_clusters(named.join(same.select("node"), "node", "left_semi"), percent))
    cells = durable(_cells(clusters))
    texts = staged.select(F.col("row").alias("node"), F.col(f"doc.{text}").alias("text"))
    met = texts.join(measured_side(cells, MAX_BROADCAST_ROWS), "node").select(F.explode("cells").alias("cell"), "node", "text")
    edges = met.repartition("cell").sortWithinPartitions("cell").mapInArrow(_linked(size, percent), "a long, b long")
    classes = components(edges)
    groups = same.join(classes, "node", "left").select("fp", "copies", F.coalesce("component", "node").alias("component"))
    rows = staged.select("row", F.col(f"doc.{key}").cast("long").alias("doc_id"), "n", "fp")
    return durable(attach(rows, durable(groups), "fp", "copies", staged.count(), "row"))


def _merged_by_id(rows: DataFrame) -> DataFrame:
    """Classes that meet in rows of one id become one, and rows without grams join the class of their id."""
    known = rows.where("doc_id is not null").groupBy("doc_id")
    ids = known.agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count_if(F.isnull("component")).alias("bare"))
    joint = durable(ids.where("least is not null and (least != most or bare > 0)").select("doc_id", "least", "most"))
    if not joint.head(1):
        return rows
    taken = rows.join(measured_side(joint.select("doc_id", "least")), "doc_id", "left")
    taken = durable(taken.withColumn("component", F.coalesce("component", "least")))
    edges = taken.where("least is not null").select(F.col("component").alias("a"), F.col("least").alias("b"))
    moved = components(edges).select(F.col("node").alias("component"), F.col("component").alias("to"))
    placed = taken.join(measured_side(durable(moved)), "component", "left")
    return durable(placed.select("row", "doc_id", "n", F.coalesce("to", "component").alias("component")))


def near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id``."""
    staged = _staged(docs.select(key, text), text, size, percent)
    rows = _merged_by_id(_classes(staged, key, text, size, percent))
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    joined = attach(rows, durable(least), "component", "rows", rows.count(), "row")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of each class, with all columns: that of the smallest id (rows without one come last), then of the smallest
    fingerprint and row number. Rows without grams all stay."""
    staged = _staged(docs, text, size, percent)
    classes = _classes(staged, key, text, size, percent).where("component is not null")
    order = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "fp", "row")
    chosen = classes.groupBy("component").agg(F.min(order)["row"].alias("row"))
    dropped = durable(classes.select("row").join(chosen.select("row"), "row", "left_anti"))
    return staged.join(measured_side(dropped), "row", "left_anti").select("doc.*")
