"""N-gram Jaccard join with signature trees.

A document's set holds the hashes of its distinct word shingles. Two documents
link when den * |A and B| >= num * |A or B|.

1. Keys. Sets of like size (classes) are cut by hash into as many buckets as
   two linked sets can differ in elements, and some more: linked sets agree in
   whole buckets. The content of a bucket is a key; sets that share no key are
   not linked. A key with a single shingle is left out where the count of
   agreeing buckets shows that a fuller one agrees (see ``keys_of_sets``).
2. Only sets go on that share as many keys with other sets as a link takes;
   they are found with a fixed-size bit filter of shared keys and then exactly.
   Of their shared keys, in order, the last are left out that a link can spare
   (see ``first_keys``).
3. Signature trees. The sets of a key (a group) are put in a tree: leaves hold
   few sets of like size, a node holds the OR of their token bitmaps, the range
   of their sizes and the components its sets belong to. Two nodes are
   traversed together and left when the highest possible overlap of their
   bitmaps cannot reach the link's bound for their sizes, or when all their
   sets are in one component already. Sets that remain are compared exactly.
   Sets in one component are not compared again, however many of them link.
4. Every set first meets the largest of its groups, in cells of at most
   ``CELL`` sets that share ``PIVOTS`` sets of the group, so a group of any
   size is spread over tasks. Components are merged, and sets of groups of
   several cells that hold more than one of them meet another of those groups,
   ``ROUNDS`` times in all (a group of one cell is met whole below).
   Memberships get the components of a turn only where the next one reads them:
   those of groups of several cells each turn, all others once, after the last.
   Then all groups that are still open are traversed fully, cell against cell
   and by bitmaps alone, but for cell pairs that are in one component; the
   pairs of different components that remain are compared exactly.

No pair of linked documents is lost; equal sets are one set throughout (a set
is named by a 64-bit hash of its content).

Defined results: null and empty text, or text without words, give the empty
set, linked with nothing; a text of fewer words than the shingle is one shingle
of all its words; rows that repeat a doc_id and its text are the same document;
a row with a null doc_id is its own row of the result, and names its component
only if no row of it has a doc_id; an empty table gives an empty table; further
columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as T
from .components import components
from .staging import release
from .staging import stage_lean as stage

U = np.uint64
CELL = 512
PIVOTS = 8
ROUNDS = 3
LEAF = 8
FANOUT = 4
FILTER_BITS = 27
LARGEST_SET = 1 << 40


# ---- keys ------------------------------------------------------------------

class Classes:
    """Size classes of a similarity, with their bucket counts."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        first, low = [], 1
        while low < LARGEST_SET:
            first.append(low)
            low = max(low, low * den * den // (num * num)) + 1
        self.first = np.array(first)
        self.last = np.append(self.first[1:] - 1, LARGEST_SET)
        #: most elements that two linked sets of the class can differ in, and
        #: agreeing buckets that they have at least: more than a set has empty
        #: buckets, but for rare ones, so that empty buckets are seldom keys
        self.differ = 2 * self.last * (den - num) // (den + num)
        self.agree = 3 + (self.differ + 4) // 5
        self.buckets = self.differ + self.agree

    def of(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, class): the classes in which sets of sizes ``n`` look for
        partners: their own, then the next where a partner can be that large."""
        k = np.searchsorted(self.first, n, "right") - 1
        more = np.flatnonzero(n * self.den // self.num > self.last[k])
        return np.concatenate([np.arange(len(n)), more]), np.concatenate([k, k[more] + 1])


def keys_of_sets(elements: np.ndarray, edge: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, owner, least): the keys of sets that are not empty
    (elements[edge[i]:edge[i + 1]], sorted and distinct) for each of their
    classes; a key's ``place`` is its set and class, of which ``owner`` is the
    set and ``least`` how many of the keys it shares with any set it links to.

    Linked sets agree in at least ``agree`` buckets of their class. A set with
    fewer than that many light buckets (of at most one element) agrees in
    ``agree`` less those fuller ones, which every set sends; else it sends its
    light ones too, and the empty ones only if even those could be all that
    agree (then one shared key is all that is sure)."""
    size = np.diff(edge)
    owner, k = classes.of(size)
    m, agree = classes.buckets[k], classes.agree[k]
    base = np.cumsum(m) - m
    spread, value = T.mix(elements ^ U(0x8CB92BA72F3D8DD7)), T.mix(elements + U(0xA24BAED4963EE407))
    n = size[owner]
    at = np.arange(int(n.sum())) + np.repeat(edge[owner] - (np.cumsum(n) - n), n)
    slot = np.repeat(base, n) + (spread[at] % np.repeat(m, n).astype(np.uint64)).astype(np.int64)
    fill = np.bincount(slot, minlength=int(m.sum()))
    content = np.zeros(len(fill), np.uint64)
    np.add.at(content, slot, value[at])
    content += fill.astype(np.uint64) * U(0x9FB21C651E98DF25)
    if not len(m):
        return content, k, owner, k
    empty = np.add.reduceat((fill == 0).astype(np.int64), base)
    light = empty + np.add.reduceat((fill == 1).astype(np.int64), base)
    lowest = np.where(light < agree, 2, np.where(empty >= agree, 0, 1))
    sent = np.flatnonzero(fill >= np.repeat(lowest, m))
    place = np.repeat(np.arange(len(m)), m)[sent]
    key = T.mix(T.mix(content[sent]) + (sent - base[place] + 1).astype(np.uint64) * U(0xE7037ED1A0B428DB)
                + k[place].astype(np.uint64) * U(0x589965CC75374CC3))
    return key, place, owner, np.where(light < agree, agree - light, 1)


def keys_by_class(s: np.ndarray, classes: Classes) -> list[tuple[np.ndarray, int]]:
    """The keys of one set for each of its classes, and how many of them it
    shares with any set it links to."""
    key, place, _, least = keys_of_sets(s, np.array([0, len(s)]), classes)
    return [(key[place == i], int(n)) for i, n in enumerate(least)]


def set_keys(s: np.ndarray, classes: Classes) -> np.ndarray:
    return keys_of_sets(s, np.array([0, len(s)]), classes)[0]


def first_keys(key: np.ndarray, place: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keys that other sets have too, those that must be looked at, and
    their places. Two linked sets share ``least`` keys of a class, of each
    one's count: so the smallest key that they share has at least that many
    less one behind it in both, and the last ``least`` - 1 keys of a set can be
    left out. Nothing is left of a class with fewer keys."""
    by = np.lexsort((key, place))
    key, place = key[by], place[by]
    count = np.bincount(place, minlength=len(least))
    rank = np.arange(len(key)) - (np.cumsum(count) - count)[place]
    keep = rank <= (count - least)[place]
    return key[keep], place[keep]


def set_names(elements: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Signed 64-bit names of the sets' contents (of empty sets 0)."""
    size = np.diff(edge)
    out, some = np.zeros(len(size), np.int64), np.flatnonzero(size)
    if len(some):
        total = np.add.reduceat(T.mix(elements + U(0x2127599BF4325C37)), edge[some])
        out[some] = T.mix(total + T.mix(size[some])).view(np.int64)
    return out


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, elements, edge): the sets of the texts i to j."""
    raw, offsets = T.byte_view(T.string_array(column))
    raw = T.lower(raw)
    for i, j in T.slices(offsets):
        part, off = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, row = T.words(part, off)
        yield i, j, *T.shingle_arrays(T.word_hashes(part, starts, ends), row, j - i, width)


def _fresh(names: np.ndarray, edge: np.ndarray, seen: set) -> np.ndarray:
    """The places of sets with elements whose names weren't seen before."""
    return np.array([i for i, (x, n) in enumerate(zip(names.tolist(), np.diff(edge).tolist(), strict=True))
                     if n and x not in seen and not seen.add(x)], np.int64)


def _chosen(elements: np.ndarray, edge: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of the places ``which``, as elements and edges."""
    size = np.diff(edge)
    if len(which) == len(size):
        return elements, edge
    n = size[which]
    to = np.concatenate([[0], np.cumsum(n)])
    return elements[np.arange(int(to[-1])) + np.repeat(edge[which] - to[:-1], n)], to


def _signed(x) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def key_table(rows: DataFrame, width: int, classes: Classes) -> DataFrame:
    """(name, key) of all sets; a batch sends equal sets once."""
    def run(batches):
        for b in batches:
            seen = set()
            for _, _, elements, edge in _sets(b.column(1), width):
                names = set_names(elements, edge)
                fresh = _fresh(names, edge, seen)
                key, place, owner, _ = keys_of_sets(*_chosen(elements, edge, fresh), classes)
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array(names[fresh][owner[place]]), _signed(key)], ["name", "key"])

    return rows.mapInArrow(run, "name bigint, key bigint")


# ---- bit filter ------------------------------------------------------------

def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [keys >> U(64 - bits), keys & U((1 << bits) - 1), T.mix(keys) >> U(64 - bits)]


def bit_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2^bits bits, three per key, gathered as 64-bit words."""
    def run(batches):
        for b in batches:
            k = b.column(0).to_numpy().view(np.uint64)
            at = np.concatenate(_places(k, bits))
            word, bit = at >> U(6), U(1) << (at & U(63))
            by = np.argsort(word, kind="stable")
            head = np.flatnonzero(np.diff(word[by].astype(np.int64), prepend=-1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[by][head].astype(np.int32)), _signed(np.bitwise_or.reduceat(bit[by], head))] if len(k)
                else [pa.array([], pa.int32()), pa.array([], pa.int64())], ["w", "v"])

    words = keys.select("key").mapInArrow(run, "w int, v bigint").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["w"].to_numpy()] = words["v"].to_numpy().view(np.uint64)
    return out


def set_table(rows: DataFrame, width: int, classes: Classes, shared: DataFrame, bits: int) -> DataFrame:
    """(doc_id, tie, n, name, elements, keys) of all rows (doc_id, text, tie): name is
    null for the empty set; elements and keys are there for sets with as many
    keys in the filter of ``shared`` keys as a link takes (once per batch and
    set), and of the keys those that must be looked at (``first_keys``)."""
    words = rows.sparkSession.sparkContext.broadcast(bit_filter(shared, bits))

    def found(k):
        ok = np.ones(len(k), bool)
        for p in _places(k, bits):
            ok &= (words.value[(p >> U(6)).astype(np.int64)] >> (p & U(63)) & U(1)).astype(bool)
        return ok

    def run(batches):
        for b in batches:
            seen = set()
            for i, j, elements, edge in _sets(b.column(1), width):
                names = set_names(elements, edge)
                fresh = _fresh(names, edge, seen)
                key, place, owner, least = keys_of_sets(*_chosen(elements, edge, fresh), classes)
                ok = found(key)
                key, place = first_keys(key[ok], place[ok], least)
                of = fresh[owner[place]]
                by = np.argsort(of, kind="stable")
                key, of = key[by].view(np.int64), of[by]
                head = np.flatnonzero(np.diff(of, prepend=-1))
                raw, own = [None] * (j - i), [None] * (j - i)
                for x, a, z in zip(of[head].tolist(), head.tolist(), [*head[1:].tolist(), len(of)], strict=False):
                    raw[x], own[x] = elements[edge[x]:edge[x + 1]].tobytes(), key[a:z]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(np.diff(edge), pa.int64()),
                     pa.array(names, pa.int64(), mask=np.diff(edge) == 0), pa.array(raw, pa.binary()), pa.array(own, pa.list_(pa.int64()))],
                    ["doc_id", "tie", "n", "name", "elements", "keys"])

    return rows.mapInArrow(run, "doc_id bigint, tie bigint, n bigint, name bigint, elements binary, keys array<bigint>")


def bitmap_of(s: np.ndarray) -> np.ndarray:
    """Token bitmap of a set: about eight bits per element, a power of two of
    64-bit words, so that bitmaps of other sizes fold onto each other."""
    bits = max(64, 1 << (8 * len(s) - 1).bit_length())
    at = np.unique(s & U(bits - 1))
    out = np.zeros(bits >> 6, np.uint64)
    word = (at >> U(6)).astype(np.int64)
    head = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[head]] = np.bitwise_or.reduceat(U(1) << (at & U(63)), head)
    return out


def bitmap_table(found: DataFrame) -> DataFrame:
    """(name, size, bitmap) of the sets of ``found`` (name, elements)."""
    def run(batches):
        for b in batches:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([bitmap_of(s).tobytes() for s in sets], pa.binary())], ["name", "size", "bitmap"])

    return found.select("name", "elements").mapInArrow(run, "name bigint, size bigint, bitmap binary")


# ---- trees -----------------------------------------------------------------

class SignatureTree:
    """Levels of nodes over some sets, given by size, bitmap and a value that
    puts like sets side by side; level 0 holds the leaves. All bitmaps are
    folded to ``words`` words. Nodes of a level, and the sets, are arrays of
    bitmaps, smallest sizes, largest sizes and most hidden elements."""

    def __init__(self, size: np.ndarray, bitmaps: list[np.ndarray], words: int, near: np.ndarray):
        size = np.asarray(size, np.int64)
        bitmap = np.array([np.bitwise_or.reduce(x.reshape(-1, words), axis=0) for x in bitmaps])
        #: elements that share a bit with another one of the same set
        hidden = size - np.bitwise_count(bitmap).sum(axis=1, dtype=np.int64)
        self.sets = bitmap, size, size, hidden
        self.order = np.lexsort((near, size))
        self.levels, level, step = [], tuple(x[self.order] for x in self.sets), LEAF
        while not self.levels or len(level[1]) > 1:
            at = np.arange(0, len(level[1]), step)
            level = tuple(f.reduceat(x, at, axis=0) for f, x in zip((np.bitwise_or, np.minimum, np.maximum, np.maximum), level, strict=True))
            self.levels.append(level)
            step = FANOUT

    def members(self, level: int, node: int) -> np.ndarray:
        step = LEAF * FANOUT ** level
        return self.order[node * step:(node + 1) * step]

    def below(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][1])))


def _reachable(x: tuple, a: np.ndarray, y: tuple, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """For nodes ``a`` of x by nodes ``b`` of y, whether some sets under them
    can link: they overlap in at most the common bits and the elements hidden
    behind them."""
    low, other = x[1][a][:, None], y[1][b]
    need = -(-num * (low + other) // (num + den))
    most = np.minimum(x[2][a][:, None], y[2][b])
    ok = (most >= need) & (den * most >= num * np.maximum(low, other))
    common = np.bitwise_count(x[0][a][:, None] & y[0][b]).sum(axis=2, dtype=np.int64)
    return ok & (common + np.minimum(x[3][a][:, None], y[3][b]) >= need)


def traverse(left: SignatureTree, right: SignatureTree, root: np.ndarray, at_left: np.ndarray, at_right: np.ndarray,
             num: int, den: int, linked) -> list[tuple[int, int]]:
    """Dual traversal of two trees (or one with itself). ``root`` names the
    component of each set of the cell by its first set; ``at_left`` and
    ``at_right`` are the places of the trees' sets in it. ``linked(i, j, need)``
    decides a pair that cannot be ruled out: True joins its components in
    place, None leaves it open; the open pairs are returned."""
    same, still = left is right, []
    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        la, a, lb, b = stack.pop()
        i, j = left.members(la, a), right.members(lb, b)
        x, y = root[at_left[i]], root[at_right[j]]
        if (x == x[0]).all() and (y == x[0]).all():
            continue
        if la == lb == 0:
            ok = _reachable(left.sets, i, right.sets, j, num, den) & (x[:, None] != y)
            if same and a == b:
                ok &= i[:, None] < j
            for p, q in zip(*(k.tolist() for k in np.nonzero(ok)), strict=True):
                s, t = at_left[i[p]], at_right[j[q]]
                u, v = root[s], root[t]
                if u == v:
                    continue
                need = -(-num * int(left.sets[1][i[p]] + right.sets[1][j[q]]) // (num + den))
                answer = linked(s, t, need)
                if answer is None:
                    still.append((s, t))
                elif answer:
                    root[root == max(u, v)] = min(u, v)
            continue
        # the higher node, or both at once
        down, over = la >= lb, lb >= la
        i = left.below(la, a) if down else np.array([a])
        j = right.below(lb, b) if over else np.array([b])
        la, lb = la - down, lb - over
        ok = _reachable(left.levels[la], i, right.levels[lb], j, num, den)
        if same and a == b:     # an unordered pair of nodes of one tree
            ok &= i[:, None] <= j
        stack.extend((la, int(i[p]), lb, int(j[q])) for p, q in np.argwhere(ok)[::-1])
    return still


def overlap_reaches(a: np.ndarray, b: np.ndarray, need: int) -> bool:
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def _first_of(label: np.ndarray) -> np.ndarray:
    """Components of equal labels, each named by its first place."""
    _, group = np.unique(label, return_inverse=True)
    first = np.full(int(group.max(initial=-1)) + 1, len(group))
    np.minimum.at(first, group, np.arange(len(group)))
    return first[group]


def _cell_edges(num: int, den: int):
    """For applyInArrow: the sets of a cell (name, label, elements) to (a, b)
    edges between sets of different labels, one per set at most."""
    def run(t: pa.Table) -> pa.Table:
        names = t["name"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["elements"]]
        bitmaps = [bitmap_of(s) for s in sets]
        root, at = _first_of(t["label"].to_numpy()), np.arange(len(sets))
        before = root.copy()
        tree = SignatureTree(np.array([len(s) for s in sets]), bitmaps, min(map(len, bitmaps)), np.array([s[0] for s in sets]))
        traverse(tree, tree, root, at, at, num, den, lambda i, j, need: overlap_reaches(sets[i], sets[j], need))
        child = np.flatnonzero((root != at) & (before == at))
        return pa.table({"a": pa.array(names[root[child]], pa.int64()), "b": pa.array(names[child], pa.int64())})

    return run


def _cell_pairs(num: int, den: int):
    """For applyInArrow: the sets of one cell (side 0) or of two of a group
    (sides 0 and 1), with bitmaps and components only, to the pairs (a, b) of
    different components that may link."""
    def run(t: pa.Table) -> pa.Table:
        names, side, size = t["name"].to_numpy(), t["side"].to_numpy(), t["size"].to_numpy()
        bitmaps = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["bitmap"]]
        words, root = min(map(len, bitmaps)), _first_of(t["label"].to_numpy())
        halves = [np.flatnonzero(side == s) for s in np.unique(side)]
        near = np.array([x[0] for x in bitmaps])
        trees = [SignatureTree(size[h], [bitmaps[i] for i in h], words, near[h]) for h in halves]
        pairs = traverse(trees[0], trees[-1], root, halves[0], halves[-1], num, den, lambda i, j, need: None)
        a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(np.minimum(names[a], names[b]), pa.int64()), "b": pa.array(np.maximum(names[a], names[b]), pa.int64())})

    return run


def exact_links(pairs: DataFrame, elements: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose sets link."""
    def run(batches):
        for t in batches:
            keep = []
            for x, y in zip(t.column(2), t.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep.append(overlap_reaches(p, q, -(-num * (len(p) + len(q)) // (num + den))))
            yield pa.RecordBatch.from_arrays([t.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    both = (pairs.join(elements.withColumnsRenamed({"name": "a", "elements": "x"}), "a")
            .join(elements.withColumnsRenamed({"name": "b", "elements": "y"}), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


# ---- join ------------------------------------------------------------------

def _connected(docs: DataFrame, num: int, den: int, width: int, doc_id: str, text: str, filter_bits: int) -> DataFrame:
    """(doc_id, tie, n, root) of every row: ``tie`` is a hash of the text,
    ``root`` names the component of its set (null for the empty set)."""
    classes = Classes(num, den)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("tie"))
    shared = (key_table(rows, width, classes).groupBy("key").agg(F.min("name").alias("low"), F.max("name").alias("high"))
              .where("low < high").select("key"))
    shared = stage(shared, "shared-keys")
    sets = stage(set_table(rows, width, classes, shared, filter_bits), "shingle-sets")
    named = stage(sets.select("doc_id", "tie", "n", "name"), "set-names")
    found = stage(sets.where("elements IS NOT NULL").groupBy("name")
                  .agg(F.first("elements").alias("elements"), F.first("keys").alias("keys")), "candidate-sets")
    release(sets)       # the elements are kept once
    edges = set_links(found, shared, num, den)
    release(found, shared)
    roots = stage(components(edges, name="set-components"), "set-roots")
    return (named.join(roots, named["name"] == roots["node"], "left")
            .select("doc_id", "tie", "n", F.coalesce("root", "name").alias("root")))


def jaccard_components(docs: DataFrame, num: int = 80, den: int = 100, width: int = 5, doc_id: str = "doc_id",
                       text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links
    reach) of every row of ``docs``."""
    named = _connected(docs, num, den, width, doc_id, text, filter_bits)
    smallest = stage(named.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return (named.join(smallest.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def open_members(members: DataFrame, label: DataFrame) -> DataFrame:
    """``members`` (key, n, name, label) with the components of ``label``
    (name, label), those of groups that still hold more than one."""
    now = stage(members.drop("label").join(label, "name", "left").withColumn("label", F.coalesce("label", "name")), "labelled-members")
    still = now.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("key")
    out = stage(now.join(still, "key", "left_semi").select("key", "n", "name", "label"), "open-members")
    release(now)
    return out


def set_links(found: DataFrame, shared: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) edges between set names that connect all linked sets of
    ``found`` (name, elements, keys)."""
    elements = found.select("name", "elements")
    member = stage(found.select("name", F.explode("keys").alias("key")).join(shared, "key", "left_semi"), "set-groups")
    # groups of one membership are one; ``own`` has the members of open groups,
    # which hold more than one component
    groups = (member.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("name")).alias("mark"), F.min("name").alias("low"))
              .where("n > 1").groupBy("n", "mark", "low").agg(F.min("key").alias("key")).select("key", "n"))
    own = stage(member.join(groups, "key").select("key", "n", "name", F.col("name").alias("label")), "group-members")
    release(member)

    large, label, one_cell = own, None, own.where(F.col("n") <= CELL)
    cells = F.ceil(F.col("n") / CELL).cast("int")
    links: list[DataFrame] = []
    for turn in range(ROUNDS):
        # each set in one of its open groups: first the largest, then one of
        # several cells by hash of the key, on which sets with like groups agree
        rank = F.struct("n", "key") if turn == 0 else F.struct(F.xxhash64("key", F.lit(turn)), "n", "key")
        if turn and large.isEmpty():
            break
        best = large.groupBy("name").agg(F.max(rank).alias("g"), F.first("label").alias("label")).select("name", "label", "g.key", "g.n")
        spread = best.withColumn("cell", F.pmod(F.xxhash64("name"), cells).cast("int")).select("key", "cell", "name", "label")
        pivots = (large.where(F.col("n") > CELL).groupBy("key", F.pmod(F.xxhash64("name", F.lit(1 + turn)), F.lit(PIVOTS)).alias("p"))
                  .agg(F.min(F.struct("name", "label")).alias("s"), F.first("n").alias("n"))
                  .select("key", F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell"), "s.name", "s.label"))
        dealt = stage(spread.unionByName(pivots), "tree-cells")
        # a cell of one set or of one component has nothing to add
        mixed = (dealt.groupBy("key", "cell").agg(F.min("label").alias("a"), F.max("label").alias("b"))
                 .where("a < b").select("key", "cell"))
        rows = dealt.join(mixed, ["key", "cell"], "left_semi")
        new = rows.join(elements, "name").groupBy("key", "cell").applyInArrow(_cell_edges(num, den), "a bigint, b bigint")
        links.append(stage(new, "tree-edges"))
        edges = reduce(DataFrame.unionByName, links)
        passed = [dealt] if label is None else [dealt, label, large]
        label = stage(components(edges, name="tree-components").withColumnsRenamed({"node": "name", "root": "label"}), "tree-labels")
        large = open_members(large.where(F.col("n") > CELL), label)
        release(*passed)

    few = open_members(one_cell, label)
    release(own, label)
    rest = large.unionByName(few).withColumn("cell", F.pmod(F.xxhash64("name"), cells).cast("int"))
    span = rest.groupBy("key", "cell").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    x, y = span.alias("x"), span.alias("y")
    pairs = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cell") <= F.col("y.cell")))
             .where((F.least("x.a", "y.a") < F.greatest("x.b", "y.b")))
             .select(F.col("x.key").alias("key"), F.col("x.cell").alias("i"), F.col("y.cell").alias("j")))
    pairs = stage(pairs, "cell-pairs")
    sides = pairs.select("key", "i", "j", F.col("i").alias("cell"), F.lit(0).alias("side")).unionByName(
        pairs.where("i < j").select("key", "i", "j", F.col("j").alias("cell"), F.lit(1).alias("side")))
    bitmaps = stage(bitmap_table(found), "set-bitmaps")
    full = sides.join(rest.select("key", "cell", "name", "label"), ["key", "cell"]).drop("cell").join(bitmaps, "name")
    may = full.groupBy("key", "i", "j").applyInArrow(_cell_pairs(num, den), "a bigint, b bigint").distinct()
    may = stage(may, "open-pairs")
    release(large, few, pairs, bitmaps)
    wanted = may.select(F.col("a").alias("name")).unionByName(may.select(F.col("b").alias("name"))).distinct()
    compared = stage(elements.join(wanted, "name", "left_semi"), "open-sets")
    out = stage(edges.unionByName(exact_links(may, compared, num, den)).distinct(), "set-edges")
    release(may, compared, *links)
    return out


def op3_signature_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, num=85, den=100, width=4)


def keep_one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of documents that links connect (five-word shingles,
    similarity 0.8) one row stays, that of the smallest doc_id (a null one
    last), then of the smallest hash of the text, and of rows that agree in
    both one. Decided row by row, so another text of the same doc_id has its
    own fate; rows without words stay."""
    rows = (_connected(docs, 80, 100, 5, "doc_id", "text", FILTER_BITS).where("root IS NOT NULL")
            .groupBy("doc_id", "tie").agg(F.first("root").alias("root"), F.count(F.lit(1)).alias("n")))
    rows = stage(rows, "near-rows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    first = rows.groupBy("root").agg(F.min(place).alias("first"))
    marks = (rows.join(first, "root").withColumn("gone", place != F.col("first")).where("gone OR n > 1")
             .select(F.col("doc_id").alias("_doc"), F.col("tie").alias("_tie"), "gone"))
    marks = stage(marks, "near-marks")
    tie = F.xxhash64("text")
    marked = docs.join(marks, F.col("doc_id").eqNullSafe(F.col("_doc")) & (tie == F.col("_tie")), "left")
    stay = marked.where("gone IS NULL").select(*docs.columns)
    if marks.where("NOT gone").isEmpty():
        return stay
    return stay.unionByName(marked.where("NOT gone").dropDuplicates(["_doc", "_tie"]).select(*docs.columns))
