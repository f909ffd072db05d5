"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of distinct word shingles, embedded as ``SIGNATURE`` minwise
values. Documents with equal sets are one class, and one of them stands for it.
Several independent trees are descended: a node picks one or two places of the
signature from its own path (1.25 on average, one over the similarity, so that a
pair at the bound is expected to stay together), and a document goes to the child
that its value there names. Paths follow from the signature alone, so a level
costs a count of its paths; only members of nodes above ``LIMIT`` go on to the
next one.

In a small node all pairs are held against each other by signature (and by size:
sets of similarity s differ at most by that factor). A large node compares its
members with one of them, drawn at random in each node; where many levels have not
parted a node, members that are nearly equal to the drawn one go no further down, and
are held in blocks against all members that turn out to lie in other components; so
is what the last level has not parted. Pairs that may be similar
are then confirmed on full sets. Links between documents that are known to hang
together need no confirmation, so there are two rounds: spanning trees of the
nodes of the first trees, and then all pairs of all trees that run between
different components. These are confirmed inside their node, to which the texts
are sent, and at most as many links as members come back: a group of many near copies
never becomes a table of its pairs.

For a pair at similarity 0.8 in small nodes the chance to share none of the ten
places of eight trees is 0.2**10; the signature test loses about 2 in 10,000 of such
pairs, and less above.

Defined cases: texts that are null, empty or blank have no words, and their set is
empty and linked with nothing. With fewer words than a shingle has, the whole
sequence is the one shingle. Very long texts are compared whole. Rows without an id are
kept, without a component. Rows are told apart by id and text: those with equal ids and
different texts have their own sets and links, and a component is named by the smallest id
in it. Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import LOWER, annotate, byte_slices, mixed, prepare, saved, word_table, words
from eventide.llm.components import components

SIMILARITY = 80  # in hundredths
SHINGLE = 4
SIGNATURE = 64
TREES = 8
FIRST_TREES = 2
LIMIT = 2000  # members of a node that are compared in one task,
LIMIT_SHINGLES = 4 << 20  # and shingles of all of them
PATIENCE = 5  # levels after which a large node's copies of its center are settled with it
SETTLED = 0.9
DEPTH = 48
IS_WORD = word_table([(0x20, 0x20), (0x09, 0x0D)])

_rng = np.random.default_rng(20_11)
_FACTORS = _rng.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, SIGNATURE, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their bounds."""
    _, _, hashes, firsts = words(LOWER[data], offsets, IS_WORD)
    n_words = np.diff(firsts)
    text = np.repeat(np.arange(len(n_words)), n_words)
    # Hash of the words from each place on, as far as the shingle and the text go.
    h = np.zeros(len(hashes), np.uint64)
    place = np.arange(len(hashes))
    for k in range(size):
        inside = place + k < firsts[1:][text]
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
        h[inside] += hashes[place[inside] + k]
    h = mixed(h)
    whole = place + size <= firsts[1:][text]
    # A text of fewer words has one shingle, from its first word on.
    whole |= (place == firsts[:-1][text]) & (n_words[text] < size)
    h, text = h[whole], text[whole]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(n_words) + 1))


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minwise values of each set; zeros for an empty one."""
    out = np.zeros((len(bounds) - 1, SIGNATURE), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        starts = bounds[some]
        for k in range(SIGNATURE):
            out[some, k] = np.minimum.reduceat((h * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32), starts)
    return out


class _Describe:
    """Size, 128-bit name and signature of each text's set."""

    fields = [
        T.StructField("n", T.LongType()),
        T.StructField("cls", T.BinaryType()),
        T.StructField("sig", T.BinaryType()),
    ]

    def __init__(self, shingle: int):
        self.shingle = shingle

    def __call__(self, data, offsets):
        h, bounds = shingle_sets(data, offsets, self.shingle)
        n = np.diff(bounds)
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(h ^ np.uint64(k)))]) for k in (0x51, 0xA7)]
        names = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], 1)
        sigs = signatures(h, bounds)
        return [n, [row.tobytes() for row in names], [row.tobytes() for row in sigs]]


# --- paths -----------------------------------------------------------------------


def _children(path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Paths of the next level and the rows they belong to. A node's places depend on its path alone."""
    rows, paths = [], []
    seed = mixed(path)
    for k in range(2):
        place = (mixed(seed + np.uint64(k + 1)) % np.uint64(SIGNATURE)).astype(np.int64)
        at = np.arange(len(path))
        if k:  # a second place in one of four nodes
            at = at[(seed >> np.uint64(62)) == 0]
        value = sig[at, place[at]].astype(np.uint64) | (place[at].astype(np.uint64) << np.uint64(32))
        paths.append(mixed(seed[at] * np.uint64(0xD6E8FEB86659FD93) + value))
        rows.append(at)
    return np.concatenate(rows), np.concatenate(paths)


def _sig_matrix(column: pa.Array, dtype=np.uint32) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype).reshape(len(column), -1)


def _descend(batches):
    """Children (tree, path, id, n) of rows (tree, path, id, n, sig)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column("path").to_numpy().view(np.uint64)
        rows, paths = _children(path, _sig_matrix(batch.column("sig")))
        at = pa.array(rows)
        yield pa.record_batch(
            [
                batch.column("tree").take(at),
                pa.array(paths.view(np.int64)),
                batch.column("id").take(at),
                batch.column("n").take(at),
            ],
            ["tree", "path", "id", "n"],
        )


def _similar(sig: np.ndarray, n: np.ndarray, row: np.ndarray, other: np.ndarray, percent: int):
    """Share of equal places of row and other, -1 where sizes or signatures rule out a link."""
    share = (sig[row] == sig[other]).mean(-1)
    low, high = np.minimum(n[row], n[other]), np.maximum(n[row], n[other])
    return np.where((share >= _least_share(percent)) & (100 * low >= percent * high), share, -1)


def _least_share(percent: int) -> float:
    """3.5 standard errors below the bound."""
    s = percent / 100
    return s - 3.5 * (s * (1 - s) / SIGNATURE) ** 0.5


def _spanning(sig, n, percent):
    """Edges of a forest of greatest similarity among the pairs that may be linked."""
    size = len(n)
    best, via = np.full(size, -1.0), np.full(size, -1)
    done = np.zeros(size, bool)
    everyone = np.arange(size)
    edges = []
    for _ in range(size):
        at = int(np.where(done, -2, best).argmax())
        done[at] = True
        if via[at] >= 0:
            edges.append((int(via[at]), at))
        share = _similar(sig, n, np.full(size, at), everyone, percent)
        better = ~done & (share > best)
        best[better], via[better] = share[better], at
    return edges


def _crossing(sig, n, comp, percent):
    """For each row the later rows that may be linked with it and lie in another component."""
    for i in range(len(n) - 1):
        other = np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1
        if len(other):
            share = _similar(sig, n, np.full(len(other), i), other, percent)
            if (share >= 0).any():
                yield i, other[share >= 0]


class _Nodes:
    """Nodes of rows that come sorted by path, as many at a time as a batch holds."""

    def __call__(self, batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            path = table.column("path").to_numpy()
            # The last node may go on in the next batch.
            cut = int(np.searchsorted(path, path[-1])) if len(path) else 0
            kept = table.slice(cut)
            if cut:
                yield self.found(table.slice(0, cut))
        if kept is not None and len(kept):
            yield self.found(kept)

    def found(self, table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        path = table.column("path").to_numpy()
        bounds = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1], [True]])) if len(path) else []
        comp = table.column("comp").to_numpy()
        parts = [
            slice(a, b)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            if b - a > 1 and (comp[a:b] != comp[a]).any()
        ]
        n, sig = table.column("n").to_numpy(), _sig_matrix(table.column("sig"), np.uint16)
        return self.result(table, n, comp, sig, parts)


class _Leaves(_Nodes):
    """Candidate pairs (a, b) of nodes: a spanning forest each."""

    def __init__(self, percent: int):
        self.percent = percent

    def result(self, table, n, comp, sig, parts):
        ids, found = table.column("id").to_numpy(), []
        for part in parts:
            found += [(part.start + i, part.start + j) for i, j in _spanning(sig[part], n[part], self.percent)]
        at = np.array(found, np.int64).reshape(-1, 2)
        x, y = ids[at[:, 0]], ids[at[:, 1]]
        return pa.record_batch([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


class _Involved(_Nodes):
    """Members (path, id) that may be linked with one of another component."""

    def __init__(self, percent: int):
        self.percent = percent

    def result(self, table, n, comp, sig, parts):
        mark = np.zeros(len(n), bool)
        for part in parts:
            for i, other in _crossing(sig[part], n[part], comp[part], self.percent):
                mark[part.start + i] = True
                mark[part.start + other] = True
        at = pa.array(np.flatnonzero(mark))
        return pa.record_batch([table.column(c).combine_chunks().take(at) for c in ("path", "id")], ["path", "id"])


class _Settle(_Nodes):
    """Confirmed links between components of each node, on full sets of its texts; as many as connect them."""

    def __init__(self, percent: int, shingle: int):
        self.percent, self.shingle = percent, shingle

    def result(self, table, n, comp, sig, parts):
        ids, sets = table.column("id").to_numpy(), []
        for _, _, data, offsets in byte_slices(table.column("text")):
            h, bounds = shingle_sets(data, offsets, self.shingle)
            sets += [h[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        found = []
        for part in parts:
            first, own = part.start, comp[part].copy()
            for i, other in _crossing(sig[part], n[part], comp[part], self.percent):
                other = other[own[other] != own[i]]  # what has met meanwhile
                if not len(other):
                    continue
                mine, theirs = sets[first + i], [sets[first + j] for j in other.tolist()]
                sizes = np.array([len(x) for x in theirs])
                all_theirs = np.concatenate(theirs)
                place = np.minimum(np.searchsorted(mine, all_theirs), len(mine) - 1)
                both = np.add.reduceat((mine[place] == all_theirs).astype(np.int64), np.cumsum(sizes) - sizes)
                for j in other[100 * both >= self.percent * (len(mine) + sizes - both)].tolist():
                    if own[j] != own[i]:
                        found.append((ids[first + i], ids[first + j]))
                        own[own == own[j]] = own[i]
        at = np.array(found, np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(at.min(1, initial=1 << 62)), pa.array(at.max(1, initial=-(1 << 62)))], ["a", "b"])


class _Confirm:
    """Whether the sets of two texts are similar enough, on full sets."""

    def __init__(self, percent: int, shingle: int):
        self.percent, self.shingle = percent, shingle

    def __call__(self, batches):
        for batch in batches:
            sets = []
            for name in ("text_a", "text_b"):
                mine = []
                for _, _, data, offsets in byte_slices(batch.column(name)):
                    h, bounds = shingle_sets(data, offsets, self.shingle)
                    mine += [h[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                sets.append(mine)
            linked = []
            for x, y in zip(*sets, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= self.percent * (len(x) + len(y) - both) and both > 0)
            yield pa.record_batch(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )


# --- the join ------------------------------------------------------------------------


def _nodes(classes: DataFrame, trees: int, limit: int, depth: int) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Members (tree, path, id) of small nodes, (id, center) pairs of large ones, and members of those that go no further.

    The last ones (path, id, center, n, settled) are whole nodes: what is not settled goes down on its own as well.
    """
    members = classes.select(F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"), "id", "n", "sig")
    members = members.withColumn("path", F.xxhash64(F.lit("root"), F.col("tree")))
    small, stars, stayed = None, [], []
    for level in range(depth):
        reached = saved(
            members.select("tree", "path", "id", "n", "sig").mapInArrow(_descend, "tree int, path long, id long, n long"),
            "paths",
        )
        sizes = reached.groupBy("path").agg(
            F.count("*").alias("members"),
            F.sum("n").alias("n"),
            F.min(F.struct(F.xxhash64("path", "id").alias("h"), "id")).alias("drawn"),
        )
        # Size in members; a node of long texts counts as larger.
        size = F.greatest("members", F.ceil(F.col("n") * limit / LIMIT_SHINGLES))
        sizes = saved(sizes.where("members > 1").select("path", size.alias("size"), "drawn"), "sizes")
        part = reached.join(sizes.where(F.col("size") <= limit).select("path"), "path", "left_semi").drop("n")
        small = part if small is None else small.unionByName(part)
        large = sizes.where(F.col("size") > limit).select("path", F.col("drawn.id").alias("center"))
        if large.isEmpty():
            break
        going = saved(reached.drop("n").join(large, "path"), "large")
        stars.append(going.where("id <> center").select("id", "center").distinct())
        members = going.join(classes.select("id", "n", "sig"), "id")
        if level >= PATIENCE:
            members = saved(_settled(members, classes), "settled")
            # Hardly reached: all that still shares its places at the last level.
            settled = F.col("settled") | F.lit(level == depth - 1)
            stayed.append(members.select("path", "id", "center", "n", settled.alias("settled")))
            members = members.where("NOT settled")
    return small, stars, stayed


def _settled(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members, and whether they share nearly all of their signature with the node's center."""
    other = classes.select(F.col("id").alias("center"), F.col("sig").alias("sig_b"))

    def near(batches):
        for batch in batches:
            if batch.num_rows:
                share = (_sig_matrix(batch.column("sig")) == _sig_matrix(batch.column("sig_b"))).mean(1)
                rows = batch.select(["tree", "path", "id", "center", "n", "sig"])
                yield rows.append_column("settled", pa.array(share >= SETTLED))

    rows = members.join(other, "center").select("tree", "path", "id", "center", "n", "sig", "sig_b")
    return rows.mapInArrow(near, T.StructType([*rows.drop("sig_b").schema, T.StructField("settled", T.BooleanType())]))


def _blocks(stayed: list[DataFrame], comps: DataFrame, limit: int) -> DataFrame:
    """Nodes (path, id) that hold the settled members of large nodes against all of other components, part by part.

    Members in the component of the node's center hang together already. Any other one meets
    them and all that is settled; two that are not settled meet further down.
    """
    rows = stayed[0]
    for more in stayed[1:]:
        rows = rows.unionByName(more)
    named = comps.withColumnRenamed("node", "id")
    own = rows.groupBy("path").agg(F.first("center").alias("id")).join(named, "id", "left")
    own = own.select("path", F.coalesce("component", "id").alias("main"))
    rows = rows.join(named, "id", "left").withColumn("comp", F.coalesce("component", "id")).join(own, "path")
    rows = rows.withColumn("apart", F.col("comp") != F.col("main")).withColumn("stays", F.col("settled") | ~F.col("apart"))
    rows = saved(rows.select("path", "id", "n", "apart", "stays"), "stayed")

    def parts(mark):
        # Half of a node's size each; long texts count as larger.
        count, n = (F.sum(F.when(F.col(mark), x)) for x in (F.lit(1), F.col("n")))
        return F.ceil(2 * F.greatest(count / limit, n / LIMIT_SHINGLES)).cast("int").alias(f"{mark}_parts")

    sizes = rows.groupBy("path").agg(parts("apart"), parts("stays")).where("apart_parts > 0 AND stays_parts > 0")
    rows = rows.join(sizes, "path")

    def dealt(mark, i, j, others):
        mine = F.pmod(F.xxhash64("id"), F.col(f"{mark}_parts")).cast("int")
        part = rows.where(mark).withColumns({i: mine, j: F.explode(F.sequence(F.lit(0), F.col(f"{others}_parts") - 1))})
        return part.select(F.xxhash64("path", "i", "j").alias("path"), "id")

    return dealt("stays", "i", "j", "apart").unionByName(dealt("apart", "j", "i", "stays")).distinct()


def _star_pairs(stars: list[DataFrame], classes: DataFrame, percent: int) -> DataFrame | None:
    """Star pairs whose signatures and sizes allow a link."""
    if not stars:
        return None
    pairs = stars[0]
    for more in stars[1:]:
        pairs = pairs.unionByName(more)
    mine = classes.select("id", "n", "sig")
    other = classes.select(F.col("id").alias("center"), F.col("n").alias("m"), F.col("sig").alias("sig_b"))
    pairs = pairs.distinct().join(mine, "id").join(other, "center")

    def fits(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            both = np.concatenate([_sig_matrix(batch.column("sig")), _sig_matrix(batch.column("sig_b"))])
            n = np.concatenate([batch.column("n").to_numpy(), batch.column("m").to_numpy()])
            rows = np.arange(batch.num_rows)
            good = np.flatnonzero(_similar(both, n, rows, rows + batch.num_rows, percent) >= 0)
            x = batch.column("id").to_numpy()[good]
            y = batch.column("center").to_numpy()[good]
            yield pa.record_batch([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return pairs.mapInArrow(fits, "a long, b long")


def _by_node(rows: DataFrame) -> DataFrame:
    """Rows with short signatures, sorted by path."""

    def shorten(batches):  # half of each value's bits are enough to compare
        for batch in batches:
            if batch.num_rows:
                sig = _sig_matrix(batch.column("sig")).astype(np.uint16)
                k = batch.schema.get_field_index("sig")
                yield batch.set_column(k, "sig", pa.array([row.tobytes() for row in sig], pa.binary()))

    return rows.mapInArrow(shorten, rows.schema).repartition("path").sortWithinPartitions("path")


def _members(members: DataFrame, classes: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Members (path, id) with size, signature and component; without components each is one of its own."""
    rows = members.select("path", "id").join(classes.select("id", "n", "sig"), "id")
    if comps is None:
        return rows.select("path", "id", "n", F.col("id").alias("comp"), "sig")
    rows = rows.join(comps.withColumnRenamed("node", "id"), "id", "left")
    return rows.select("path", "id", "n", F.coalesce("component", "id").alias("comp"), "sig")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    rows = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    rows = rows.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_Confirm(percent, shingle), "a long, b long, linked boolean")


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Text of each class in the pairs, from the row that stands for it."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = classes.join(ids, "id", "left_semi").select("id", F.col("first.id").alias("doc"), "first.row")
    rows = docs.select(F.col("id").alias("doc"), "row", "text").join(wanted, ["doc", "row"])
    return rows.dropDuplicates(["id"]).select("id", "text")


def near_duplicates(
    docs: DataFrame,
    similarity: int = SIMILARITY,
    shingle: int = SHINGLE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``; the smallest id of a component stays."""
    placed = _placed(docs, similarity, shingle, doc_id, text)
    component = F.col("first.id")
    return placed.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _placed(docs: DataFrame, similarity: int, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, text hash and set size, and the ``first`` (id, row) of its component; none without an id."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    sets = saved(annotate(rows, ["id", "row"], _Describe(shingle), _Describe.fields), "sets")
    classes = (
        sets.where("id IS NOT NULL AND n > 0")
        .groupBy("cls")
        .agg(
            F.min(F.struct("id", "row")).alias("first"),
            F.first("sig").alias("sig"),
            F.first("n").alias("n"),
            F.count("*").alias("size"),
        )
    )
    # Classes are named by a number, because an id may stand for several of them.
    classes = classes.withColumn("id", F.monotonically_increasing_id())
    classes = saved(classes.select("cls", "id", "first", "sig", "n", "size"), "classes")
    links = saved(_links(rows.where("id IS NOT NULL"), classes, similarity, shingle), "found")
    comps = saved(components(links), "components")
    # A document belongs to its class, and the class to its component.
    named = classes.join(comps, classes.id == comps.node, "left").where("size > 1 OR component IS NOT NULL")
    named = saved(named.select("cls", "first", F.coalesce("component", "id").alias("component")), "named")
    lows = named.groupBy("component").agg(F.min("first").alias("low"))
    named = saved(named.join(lows, "component").select("cls", "low"), "lows")
    out = sets.select("id", "row", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")).join(named, "cls", "left")
    first = F.when(F.col("id").isNotNull(), F.coalesce("low", F.struct("id", "row")))
    return out.select("id", "row", "n", first.alias("first"))


def _links(docs: DataFrame, classes: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Confirmed links (a, b) between classes, enough to connect what hangs together."""
    small, stars, stayed = _nodes(classes, TREES, LIMIT, DEPTH)
    small = saved(small, "small")
    first = _by_node(_members(small.where(F.col("tree") < FIRST_TREES), classes, None))
    pairs = first.mapInArrow(_Leaves(percent).__call__, "a long, b long")
    star_pairs = _star_pairs(stars, classes, percent)
    if star_pairs is not None:
        pairs = pairs.unionByName(star_pairs)
    pairs = saved(pairs.distinct(), "pairs")
    tried = _confirmed(pairs, saved(_texts(docs, classes, pairs), "texts1"), percent, shingle)
    links = saved(tried.where("linked").select("a", "b"), "links1")
    comps = saved(components(links), "components1")
    # Texts go to the nodes where components may still meet, and links come back, not pairs.
    nodes = small.select("path", "id")
    if stayed:
        nodes = nodes.unionByName(saved(_blocks(stayed, comps, LIMIT), "blocks"))
    rest = _by_node(_members(nodes, classes, comps)).mapInArrow(_Involved(percent).__call__, "path long, id long")
    rest = saved(rest, "involved")
    if rest.isEmpty():
        return links
    texts = saved(_texts(docs, classes, rest.select(F.col("id").alias("a"), F.col("id").alias("b"))), "texts2")
    rows = _by_node(_members(rest, classes, comps).join(texts, "id").select("path", "id", "n", "comp", "sig", "text"))
    return links.unionByName(rows.mapInArrow(_Settle(percent, shingle).__call__, "a long, b long"))


def clean_documents(docs: DataFrame, similarity: int = SIMILARITY, shingle: int = 5) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one of smallest id.

    Of rows with equal ids and different texts that of smallest text hash stays. Rows that are equal
    in both are one document and stay as they are, as do rows without an id or without a word.
    """
    columns = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    at = f"c{columns.index('doc_id')}"
    plain = plain.withColumn("_row", F.xxhash64(f"c{columns.index('text')}"))
    placed = _placed(docs, similarity, shingle).where("id IS NOT NULL AND n > 0")
    gone = placed.where(F.struct("id", "row") != F.col("first"))
    gone = gone.select(F.col("id").alias("_id"), F.col("row").alias("_same")).distinct()
    left = plain.join(gone, (F.col(at) == F.col("_id")) & (F.col("_row") == F.col("_same")), "left_anti")
    return left.drop("_row").toDF(*columns)
