"""Near-duplicate documents by chosen-path set similarity join (operator 10).

A document's set holds its distinct word shingles as 64-bit hashes. Documents
with equal sets are one *class*; the join runs over classes.

Every class has ``coordinates`` minwise tokens (the smallest image of its set
under fixed hash functions). A *node* of a tree holds the classes that agree
on the minwise tokens chosen along its path; which tokens a node branches on
depends on its path alone. Each of the independent trees goes ``path`` tokens
deep before its nodes are looked at, so that a common passage alone brings few
documents together; nodes that are still large branch on two tokens, and their
children on two more, a round. Two classes of similarity s meet in no tree with
probability (1 - s ** path) ** trees; the number of trees follows from the
``recall`` asked for at the threshold.

* Before full sets are read, the members of a group are compared by how many
  minwise tokens they share: a pair at the threshold shares fewer than the
  count asked for with probability ``miss``. Members without a partner leave,
  and the others fall into smaller groups.
* Small nodes (at most ``leaf`` classes and ``leaf_shingles`` shingles) are
  compared exhaustively inside one task, on full sets, by one matrix product
  of their incidence; groups with the same members are compared once.
* A larger node is cut into chunks of that size by a hash, and each chunk is
  compared exhaustively together with a few pivots that all chunks of the node
  see; then the pivots leave. Classes found connected carry one label. A child
  node whose members all carry one label can teach nothing and ends; so a
  large group of copies costs comparisons in proportion to its size, never its
  square. Rounds go on while each leaves half the rows in large nodes at most,
  ``depth`` at most. Nodes that are large then (unlike classes which no token
  tells apart) end by exhaustive work in one go: classes of one label share
  chunks, and every two chunks of different labels are compared.
  So the rounds are at most ``depth`` and one more, and nothing is dropped.

Links are joined to components on the executors.

Defined results: null, empty or blank text has the empty set, links with
nothing and is its own component; a text with fewer words than a shingle is
one shingle; repeated rows link with each other (equal sets), unless empty.
Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.common import U64, WordHasher, lists, mix, rows_of, seeds, text_steps, written
from stockledger.llm.graph import components
from stockledger.operators.joins import fits_broadcast, maybe_broadcast


class Shingler:
    """Distinct shingles of texts: flat sorted hashes and each text's end."""

    def __init__(self, words: int):
        self.n, self.hasher, self.by_place = words, WordHasher(), seeds(words, 3)

    def sets(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        word, _, _, first = self.hasher.words(data, bounds)
        long = len(word) - self.n + 1
        shingle = np.zeros(max(long, 0), U64)
        for i, seed in enumerate(self.by_place[: max(long, 0) and self.n]):
            shingle += (word[i: i + long] * seed) ^ seed
        shingle = mix(shingle)
        for lo, hi in zip(first[:-1], first[1:], strict=True):
            count = hi - lo
            if count >= self.n:
                yield np.unique(shingle[lo: hi - self.n + 1])
            elif count:
                short = U64(count)
                for i in range(count):
                    short = short * U64(0x9E3779B97F4A7C15) + word[lo + i]
                yield mix(np.array([short], U64))
            else:
                yield np.zeros(0, U64)


def set_key(values: np.ndarray) -> bytes:
    """128-bit name of a set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """id, version, n_shingles, cls (the set's name, null if empty) and the minwise tokens of each row."""
    multipliers = seeds(coordinates, 11)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        with np.errstate(over="ignore"):
            for batch in batches:
                for lo, hi, data, bounds in text_steps(batch.column(1)):
                    sizes, keys, sets = [], [], []
                    for values in shingler.sets(data, bounds):
                        sizes.append(len(values))
                        keys.append(set_key(values) if len(values) else None)
                        if len(values):
                            sets.append(values)
                    ends = np.cumsum([0, *sizes])
                    tokens = np.zeros((len(sets), coordinates), U64)
                    if sets:
                        flat = np.concatenate(sets)
                        starts = ends[:-1][np.array(sizes) > 0]
                        for j, m in enumerate(multipliers):
                            tokens[:, j] = np.minimum.reduceat(flat * m, starts)
                    held = np.cumsum(np.concatenate([[0], (np.array(sizes) > 0) * coordinates]))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists(tokens.reshape(-1).view(np.int64), held)],
                        names=["id", "version", "n_shingles", "cls", "tokens"],
                    )

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, version long, n_shingles long, cls binary, tokens array<long>")


def class_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cls and its whole set, for the rows of ``docs`` in ``wanted(id, cls)``; one row a class."""
    named = docs.select("id", "text").join(maybe_broadcast(wanted.select("id", "cls"), fits_broadcast(wanted)), "id").select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        with np.errstate(over="ignore"):
            for batch in batches:
                for lo, _, data, bounds in text_steps(batch.column(1)):
                    names, sets = [], []
                    for i, values in enumerate(shingler.sets(data, bounds)):
                        name = batch.column(0)[lo + i].as_py()
                        if len(values) and set_key(values) == name:  # not another text of the same id
                            names.append(name)
                            sets.append(values)
                    ends = np.cumsum([0, *map(len, sets)])
                    flat = np.concatenate(sets) if sets else np.zeros(0, U64)
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), lists(flat.view(np.int64), ends)], names=["cls", "shingles"])

    found = written(named.mapInArrow(run, "cls binary, shingles array<long>"), "sets")
    if rows_of(found) > rows_of(wanted):  # rows that repeat an id and its text
        found = written(found.dropDuplicates(["cls"]), "distinct-sets")
    return found


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b| for sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def least_shared(coordinates: int, similarity: float, miss: float) -> int:
    """Largest count of common minwise tokens that a pair of that similarity misses with probability ``miss`` at most."""
    below = 0.0
    for n in range(coordinates + 1):
        below += math.comb(coordinates, n) * similarity**n * (1 - similarity) ** (coordinates - n)
        if below > miss:
            return n
    return coordinates


def _roots(link: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each member's root under the relation ``link``: its component's member of least ``first``."""
    order = np.argsort(first, kind="stable")
    label = np.argsort(order)
    np.fill_diagonal(link, True)
    while True:
        least = np.where(link, label[None, :], len(label)).min(axis=1)
        if (least == label).all():
            return order[label]
        label = least


def stars(sets: list[np.ndarray], first: np.ndarray, percent: int) -> np.ndarray:
    """Each member's root: the component's member of least ``first``, over all pairs that are linked."""
    n = len(sets)
    link = np.zeros((n, n), bool)
    if n <= 6:
        for i in range(n):
            for j in range(i):
                link[i, j] = link[j, i] = linked(sets[i], sets[j], percent)
    else:
        sizes = np.fromiter(map(len, sets), np.int64, n)
        row = np.repeat(np.arange(n), sizes)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        number = np.cumsum(count > 1) - 1  # a shingle of one set alone is common to none
        shared = count[column] > 1
        row, column = row[shared], number[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((n, n), np.float32)
        step = 4096
        cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + step, step))
        for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            block = np.zeros((n, step), np.float32)
            block[row[lo:hi], column[lo:hi] - i * step] = 1
            common += block @ block.T
        common = common.astype(np.int64)
        link = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    return _roots(link, first)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[bool], list[np.ndarray]]]:
    """(group, names, pivot flags, value arrays) of each run of rows (grp, cls, pivot, values) with one group."""
    group, names, pivot, held = None, [], [], []
    for batch in batches:
        groups, cls, pivots = (batch.column(i).to_pylist() for i in range(3))
        values = batch.column(3)
        flat, ends = values.flatten().to_numpy(zero_copy_only=False).view(U64), np.cumsum([0, *values.value_lengths().to_pylist()])
        for i in range(batch.num_rows):
            if groups[i] != group:
                if len(names) > 1:
                    yield group, names, pivot, held
                group, names, pivot, held = groups[i], [], [], []
            names.append(cls[i])
            pivot.append(pivots[i])
            held.append(flat[ends[i]: ends[i + 1]])
    if len(names) > 1:
        yield group, names, pivot, held


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size: int = 4096) -> Iterator[pa.RecordBatch]:
    out = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds.values())], names=list(kinds))

    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield made()
            out = []
    if out:
        yield made()


def promising(members: DataFrame, classes: DataFrame, shared: int) -> DataFrame:
    """``members(grp, cls, pivot)`` that share ``shared`` minwise tokens with another of their group, in groups so connected."""
    rows = members.join(classes.select("cls", "tokens"), "cls").select("grp", "cls", "pivot", "tokens").repartition("grp").sortWithinPartitions("grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for group, names, pivot, tokens in _grouped(batches):
                token = np.stack(tokens)
                same = np.zeros((len(names), len(names)), np.int32)
                for j in range(token.shape[1]):
                    same += token[:, j, None] == token[None, :, j]
                root = _roots(same >= shared, np.arange(len(names)))
                size = np.bincount(root, minlength=len(names))
                for i, r in enumerate(root):
                    if size[r] > 1:
                        yield group, int(r), names[i], pivot[i]

        yield from _batches(found(), {"grp": pa.int64(), "part": pa.int32(), "cls": pa.binary(), "pivot": pa.bool_()})

    return rows.mapInArrow(run, "grp long, part int, cls binary, pivot boolean")


def compare(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(grp, cls, root) of the members of ``members(grp, cls, pivot)`` linked to others of their group, roots included.

    A root is a pivot if its component holds one. Groups are bounded; their rows
    come sorted, so a task holds one group at a time.
    """
    rows = members.join(sets, "cls").select("grp", "cls", "pivot", "shingles").repartition("grp").sortWithinPartitions("grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for group, names, pivot, sets_ in _grouped(batches):
                order = sorted(range(len(names)), key=lambda i: (not pivot[i], names[i]))
                first = np.empty(len(names), np.int64)
                first[order] = np.arange(len(names))
                root = stars([np.sort(x) for x in sets_], first, percent)
                joined = np.bincount(root, minlength=len(names)) > 1
                for i, r in enumerate(root):
                    if joined[r]:
                        yield group, names[i], names[r]

        yield from _batches(found(), {"grp": pa.int64(), "cls": pa.binary(), "root": pa.binary()})

    return rows.mapInArrow(run, "grp long, cls binary, root binary")


def _distinct_groups(groups: DataFrame) -> DataFrame:
    """``groups(grp, cls)`` with every set of members once."""
    members = groups.groupBy("grp").agg(F.sort_array(F.collect_list("cls")).alias("members")).select("members").dropDuplicates(["members"])
    return members.select(F.xxhash64("members").alias("grp"), F.explode("members").alias("cls"), F.lit(False).alias("pivot"))


def _branch(nodes: DataFrame, tokens: DataFrame, level: int, choices: int, coordinates: int) -> DataFrame:
    """Grandchildren of ``nodes(node, cls, size, label)``: the path decides which ``choices`` tokens a node, and then each child, branches on."""
    pick = lambda *path: F.pmod(F.xxhash64("node", F.lit(level), *map(F.lit, path)), F.lit(coordinates)).cast("int")
    paths = F.array(*(
        F.struct(F.lit(choices * i + j).alias("i"), pick(i).alias("c"), pick(i, j).alias("d")) for i in range(choices) for j in range(choices)
    ))
    token = lambda c: F.element_at("tokens", F.col(c) + 1)
    return (
        nodes.join(tokens.select("cls", "tokens"), "cls")
        .select("node", "cls", "size", "label", "tokens", F.explode(paths).alias("p"))
        .select(F.xxhash64("node", "p.i", "p.c", token("p.c"), "p.d", token("p.d")).alias("node"), "cls", "size", "label")
    )


def _sized(nodes: DataFrame, leaf: int, leaf_shingles: int, blocks: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(groups of nodes that are compared exhaustively, larger nodes with ``chunks``) among nodes of two labels at least."""
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("all"), F.min("label").alias("a"), F.max("label").alias("z"))
    chunks = F.ceil(F.greatest(F.col("n") / F.lit(leaf), F.col("all") / F.lit(leaf_shingles))).cast("long")
    sizes = sizes.where("n > 1 and a <> z").select("node", chunks.alias("chunks"))
    live = written(nodes.join(sizes, "node"), name)
    chunk = F.pmod(F.xxhash64("cls"), "chunks")
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda o: (o != chunk) | (F.col("chunks") == 1))
    small = live.where(F.col("chunks") <= blocks).select("node", "cls", chunk.alias("chunk"), F.explode(others).alias("other"))
    groups = small.select(F.xxhash64("node", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("grp"), "cls")
    return _distinct_groups(groups), live.where(F.col("chunks") > blocks)


def _between_labels(nodes: DataFrame, leaf: int, leaf_shingles: int) -> DataFrame:
    """Groups (grp, cls, pivot) in which every two classes of a node with different labels meet.

    A label with more classes than fit a leaf has chunks of its own, which are
    not compared with each other; smaller labels share chunks.
    """
    fits = lambda n, size: F.ceil(F.greatest(n / F.lit(leaf), size / F.lit(leaf_shingles))).cast("long")
    labels = nodes.groupBy("node", "label").agg(fits(F.count(F.lit(1)), F.sum("size")).alias("parts"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("all"))
    large = F.col("parts") > 1
    rest = labels.where(~large).groupBy("node").agg(fits(F.sum("n"), F.sum("all")).alias("shared"))
    labels = labels.select("node", "label", "parts").join(rest, "node", "left")
    mine = F.when(large, F.col("label"))
    number = F.when(large, F.pmod(F.xxhash64("cls"), "parts")).otherwise(F.pmod(F.xxhash64("label"), "shared"))
    placed = written(
        nodes.select("node", "cls", "label").join(labels, ["node", "label"]).select("node", "cls", mine.alias("mine"), F.xxhash64("node", mine, number).alias("chunk")), "last-nodes"
    )
    chunks = placed.select("node", "chunk", "mine").distinct().groupBy("node").agg(F.collect_list(F.struct("chunk", "mine")).alias("others"))
    other = F.filter("others", lambda o: (o["chunk"] != F.col("chunk")) & ~F.coalesce(o["mine"] == F.col("mine"), F.lit(False)))
    alone = F.array(F.struct(F.col("chunk").alias("chunk"), F.col("mine").alias("mine")))
    paired = placed.join(chunks, "node").select("node", "cls", "chunk", F.explode(F.when(F.size(other) > 0, other).otherwise(alone)).alias("o"))
    groups = paired.select(F.xxhash64("node", F.least("chunk", "o.chunk"), F.greatest("chunk", "o.chunk")).alias("grp"), "cls")
    return _distinct_groups(groups)


def _pivots(nodes: DataFrame, pivots: int, level: int) -> DataFrame:
    """Up to ``pivots`` members of each node, one a label; any label is as likely as another."""
    one = nodes.groupBy("node", "label").agg(F.min("cls").alias("cls"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("label", F.lit(level)), "label"))
    return one.withColumn("rank", rank).where(F.col("rank") <= pivots).select("node", "label", "cls")


def resolve(
    docs: DataFrame, *, words: int = 3, percent: int = 85, recall: float = 0.9999, path: int = 2, coordinates: int = 32,
    miss: float = 1e-6, leaf: int = 512, leaf_shingles: int = 2_000_000, blocks: int = 1, depth: int = 6, pivots: int = 32, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: id, version (hash of the text), n_shingles, root (its component; null if the set is empty) and component_id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("version"))
    trees = math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** path)) if percent < 100 else 1
    signed = written(signatures(rows, words, coordinates), "signatures")
    classes = written(
        signed.where("cls is not null").groupBy("cls")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("size"), F.first("tokens").alias("tokens")),
        "classes",
    )
    first = F.array(*(
        F.xxhash64(F.lit(t), *(F.element_at("tokens", (t * path + i) % coordinates + 1) for i in range(path))) for t in range(trees)
    ))
    roots = classes.select(F.explode(first).alias("node"), "cls", "size", F.col("cls").alias("label"))
    leaves, large = _sized(roots, leaf, leaf_shingles, blocks, "nodes")
    shared = least_shared(coordinates, percent / 100, miss)

    def split(members: DataFrame) -> DataFrame:
        return promising(members, classes, shared).select(F.xxhash64("grp", "part").alias("grp"), "cls", "pivot")

    leaves = written(_distinct_groups(split(leaves)), "leaves")
    wanted = leaves.select("cls").union(large.select("cls")).distinct()
    wanted = written(classes.select("id", "cls").join(wanted, "cls"), "wanted")
    sets = class_sets(rows, wanted, words)

    every, links, level = leaves, [], 0
    left, stalled = rows_of(large), False
    while left:
        level += 1
        if level > depth or stalled:
            every = every.union(split(_between_labels(large, leaf, leaf_shingles)))
            break
        pivot = written(_pivots(large, pivots, level), "pivots")
        seen = large.join(pivot.select("node", "cls", F.lit(True).alias("is_pivot")), ["node", "cls"], "left")
        chunk = F.pmod(F.xxhash64("cls", F.lit(level)), "chunks")
        members = seen.where("is_pivot is null").select(F.xxhash64("node", chunk).alias("grp"), "node", "cls", F.lit(False).alias("pivot"))
        every_chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
        shown = seen.where("is_pivot").select("node", "cls", every_chunk.alias("chunk")).select(
            F.xxhash64("node", "chunk").alias("grp"), "node", "cls", F.lit(True).alias("pivot")
        )
        parts = promising(members.union(shown).select("grp", "cls", "pivot"), classes, shared)
        parts = written(parts.select("grp", F.xxhash64("grp", "part").alias("part"), "cls", "pivot"), "chunk-parts")
        found = compare(parts.select(F.col("part").alias("grp"), "cls", "pivot"), sets, percent)
        found = written(found.withColumnRenamed("grp", "part").join(parts.select("part", "grp").distinct(), "part").select("grp", "cls", "root"), "chunk-links")
        links.append(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
        to = found.join(members.select("grp", "node", "cls"), ["grp", "cls"]).select("node", "cls", F.col("root").alias("to"))
        # of classes connected before, one may now hang on another root: the label stays a class they are connected with
        rest = seen.where("is_pivot is null").join(to, ["node", "cls"], "left").select("node", "cls", "size", F.coalesce("to", "label").alias("label"))
        leaves, large = _sized(_branch(rest, classes, level, 2, coordinates), leaf, leaf_shingles, blocks, "nodes")
        every = every.union(split(leaves))
        before, left = left, rows_of(large)
        stalled = 2 * left > before

    found = compare(every, sets, percent).select(F.col("cls").alias("u"), F.col("root").alias("v"))
    for more in links:
        found = found.union(more)
    member = components(found)
    by_class = classes.select("cls", "id").join(member.withColumnRenamed("v", "cls"), "cls", "left").select("cls", "id", F.coalesce("root", "cls").alias("root"))
    named = written(by_class, "members")
    named = named.join(named.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("cls", "root", "component_id")
    columns = ["id", "version", "n_shingles", "root", "component_id"]
    full = signed.where("cls is not null").join(named, "cls").select(*columns)
    empty = signed.where("cls is null").select("id", "version", "n_shingles", F.col("cls").alias("root"), F.col("id").alias("component_id"))
    return full.union(empty)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **how) -> DataFrame:
    """Per row: its id, n_shingles, component_id (smallest id reachable over links) and kept."""
    return resolve(docs, id_col=id_col, **how).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows and columns of ``docs``, one row of each component: the smallest (id, text hash).

    Rows without shingles stay. The rows that go are joined away, so texts are
    moved only if those are too many to broadcast.
    """
    found = written(resolve(docs, id_col=id_col, text_col=text_col, **how).where("root is not null").select("id", "version", "root"), "resolved")
    first = found.groupBy("root").agg(F.min(F.struct("id", "version")).alias("first"))
    gone = written(found.join(first, "root").where(F.struct("id", "version") != F.col("first")).select("id", "version").distinct(), "near-copies")
    version = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))

    def place(side: DataFrame, how_: str, of: DataFrame) -> DataFrame:
        side = side.select(F.col("id").alias("__id"), F.col("version").alias("__version"))
        return of.join(maybe_broadcast(side, fits_broadcast(side)), (F.col(id_col) == F.col("__id")) & (version == F.col("__version")), how_)

    left = place(gone, "left_anti", docs)
    repeated = written(found.groupBy("id", "version").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-rows")
    if rows_of(repeated) == 0:
        return left
    once = place(repeated, "left_semi", left).withColumn("__v", version).dropDuplicates([id_col, "__v"]).drop("__v")
    return place(repeated, "left_anti", left).union(once)
