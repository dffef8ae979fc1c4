"""Near-duplicate documents by a chosen-path set similarity join, and their components.

1. Each document becomes its set of word shingles; equal sets are one class. A class has
   128 minwise values (and 2 bits of each as a sketch).
2. Trees: a node draws ``BRANCH`` of the 128 places, by its own name, and a class goes to
   the child named by the place and its value there. Nodes up to ``SMALL`` classes are
   leaves. Of a larger one, those alike to its members on average (a similarity of a half,
   by some members' sketches) are its core and stop there, a group of copies; the others
   branch again until nodes are small, or few rows are left in large ones, so unlike classes
   that share values are parted however many there are. A pair of similarity s meets in one tree with probability p,
   p = 1 - (1 - s p)^2: 0.94 at s = 0.8, so six independent trees miss 6 pairs in 10^8,
   fewer above 0.8.
3. In a leaf all classes are compared by sketch (a pair of 0.8 passes but for 1 in 10^7);
   classes without a partner are left out. What passes is confirmed on full sets, counted
   from the texts.
4. Only components are asked for, so pairs are emitted sparingly: first a forest per leaf,
   best pairs first; then, between classes not yet connected, every pair that is left. A
   leaf whose classes are all connected is done. Nodes with a core are groups of copies;
   those that share a core class are taken together, once. One core class of a group is
   compared with the rest; what that leaves apart is compared by sketch, core classes with
   all, block against block; those with a partner are compared on full sets, and each task
   returns only links that connect.

So a group of n near copies makes about n rows, not n^2, and no group meets in one task.

Defined cases: without words or with null text a document is linked with nothing and is its
own component; a text of fewer words than a shingle is one shingle; a component's id is its
smallest doc_id that is not null; rows that repeat are one class; equal doc_ids with
different texts are separate; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import as_binary, by_size, map_arrow, matrix, record, rows_of, saved, texts_of
from .words import Words, mix

PLACES, TREES, BRANCH, SMALL = 128, 6, 2, 100
#: Rows of large nodes that are compared as they are rather than branch again. Nodes halve by level at least, on average, so at ``DEPTH`` few are left; they are groups whatever they hold.
FEW_ROWS, DEPTH = 20_000, 16
#: Of 128 sketch places, 19 differ on average at similarity 0.8, with a deviation of 4.
MOST_DIFFERENT = 40
#: Members of a large node that each of its members is held against; a core one differs from them in at most so many places on average, a similarity of a half.
SAMPLE, CORE_DIFFERS = 8, 48
#: Bytes of full sets and number of sets in a block; two blocks meet in a task, which compares ``AT_ONCE`` sets with as many at a time.
BLOCK_BYTES, BLOCK_SETS, AT_ONCE = 4 << 20, 4096, 1024
PIVOT_ROUNDS = 1
#: So many pairs of sets are compared one by one, more by a product of matrices.
FEW_PAIRS = 1 << 14
_U = np.uint64
_random = np.random.default_rng(8)
_FACTORS = _random.integers(0, 1 << 63, PLACES, dtype=np.uint64) * _U(2) + _U(1)
_SHIFTS = _random.integers(0, 1 << 63, PLACES, dtype=np.uint64)
_LANES = _U(0x5555555555555555)

_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("signature", pa.binary())]
)
_ROWS = pa.schema([("node", pa.int64()), ("cid", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])
_ROWS_DDL = "node long, cid long, n long, sketch binary"
_RATED = pa.schema([*_ROWS, ("core", pa.bool_())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle codes of each text."""
    code, bounds = Words(texts, lower=True).shingles(size)
    return [np.unique(code[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _key(codes: np.ndarray) -> bytes:
    return blake2b(codes.tobytes(), digest_size=16).digest()


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """128 minwise values of each set that is not empty."""
    sizes = np.array([len(s) for s in sets])
    flat, begin = np.concatenate(sets), np.cumsum(sizes) - sizes
    out = np.empty((len(sets), PLACES), np.uint32)
    for j in range(PLACES):
        out[:, j] = mix(np.minimum.reduceat(flat * _FACTORS[j] + _SHIFTS[j], begin)) >> _U(32)
    return out


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each minwise value, in four words a row."""
    bits = (signatures & 3).astype(np.uint64).reshape(len(signatures), 4, 32)
    return (bits << np.arange(0, 64, 2, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, limit=1 << 19):
            sets = shingle_sets(part.column("text"), size)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, signed = np.zeros((len(sets), 2), np.int64), [None] * len(sets)
            if full:
                values = minwise([sets[i] for i in full])
                for i, value in zip(full, values):
                    signed[i] = value.tobytes()
                    keys[i] = np.frombuffer(_key(sets[i]), np.int64)
            none = np.array([not len(s) for s in sets])
            yield record(
                _SIGNED, doc_id=part.column("doc_id"), text_hash=part.column("text_hash"), n_shingles=[len(s) for s in sets],
                k1=pa.array(keys[:, 0], mask=none), k2=pa.array(keys[:, 1], mask=none), signature=signed,
            )

    return sign


def _children(node: np.ndarray, signature: np.ndarray) -> np.ndarray:
    """(rows, BRANCH) names of the children that each row goes to from its node."""
    rows, out = np.arange(len(node)), np.empty((len(node), BRANCH), np.uint64)
    for b in range(BRANCH):
        place = (mix(node + _U(b + 1)) % _U(PLACES)).astype(np.int64)
        out[:, b] = mix(node ^ mix((place.astype(np.uint64) << _U(32)) + signature[rows, place] + _U(1)))
    return out


def _emit(node, cid, n, sketch, times):
    again = np.repeat(np.arange(len(cid)), times)
    return record(_ROWS, node=node.view(np.int64), cid=cid[again], n=n[again], sketch=as_binary(sketch[again]))


def _from_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            batch = whole.slice(at, 2000)
            signature = matrix(batch.column("signature"), PLACES, np.uint32)
            roots = mix(np.arange(1, TREES + 1, dtype=np.uint64))
            node = np.concatenate([_children(np.full(len(signature), root), signature) for root in roots], axis=1).ravel()
            yield _emit(node, batch.column("cid").to_numpy(), batch.column("n").to_numpy(), sketches(signature), TREES * BRANCH)


def _from_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 4000):
            batch = whole.slice(at, 4000)
            signature = matrix(batch.column("signature"), PLACES, np.uint32)
            node = _children(batch.column("node").to_numpy().view(np.uint64), signature).ravel()
            yield _emit(node, batch.column("cid").to_numpy(), batch.column("n").to_numpy(), sketches(signature), BRANCH)


# -- comparing in leaves -------------------------------------------------
def _differing(x, y) -> np.ndarray:
    """In how many places of their sketches two rows differ."""
    differ = x ^ y
    return np.bitwise_count((differ | (differ >> _U(1))) & _LANES).sum(axis=1, dtype=np.int64)


def _alike(x, y, nx, ny, percent) -> np.ndarray:
    """Whether two rows may be similar enough, by size and sketch."""
    return (_differing(x, y) <= MOST_DIFFERENT) & (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))


def _signs(sketch: np.ndarray) -> np.ndarray:
    """Three signs for each place of a sketch; the products of two rows' signs add up to 3 for a place they agree in, else to -1."""
    two = (sketch[:, :, None] >> np.arange(0, 64, 2, dtype=np.uint64)) & _U(3)
    signs = np.array([[1, 1, 1], [1, -1, -1], [-1, 1, -1], [-1, -1, 1]], np.float32)
    return signs[two.reshape(len(sketch), PLACES).astype(np.int64)].reshape(len(sketch), 3 * PLACES)


def _all_alike(x, y, nx, ny, percent) -> np.ndarray:
    """``_alike`` of each row with each of the others, by their signs."""
    near = x @ y.T >= 3 * PLACES - 4 * MOST_DIFFERENT
    return near & (100 * np.minimum(nx[:, None], ny) >= percent * np.maximum(nx[:, None], ny))


def _rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 4000):
            batch = whole.slice(at, 4000)
            sample = batch.column("sample")
            bounds = np.asarray(sample.offsets, dtype=np.int64)
            others = matrix(sample.values.slice(bounds[0], bounds[-1] - bounds[0]), 4, np.uint64)
            count = np.diff(bounds)
            differ = _differing(np.repeat(matrix(batch.column("sketch"), 4, np.uint64), count, axis=0), others)
            core = np.add.reduceat(differ, bounds[:-1] - bounds[0]) <= CORE_DIFFERS * count
            yield record(_RATED, **{c: batch.column(c) for c in ("node", "cid", "n", "sketch")}, core=core)


class Leaves:
    """Members of leaves collected in lists: flat arrays and the leaf of each."""

    def __init__(self, members: pa.Array):
        bounds = np.asarray(members.offsets, dtype=np.int64)
        values = members.values.slice(bounds[0], bounds[-1] - bounds[0])
        self.sizes = np.diff(bounds)
        self.leaf = np.repeat(np.arange(len(self.sizes)), self.sizes)
        field = {f.name: values.field(i) for i, f in enumerate(values.type)}
        self.cid, self.n = field["cid"].to_numpy(), field["n"].to_numpy()
        self.comp = field["comp"].to_numpy() if "comp" in field else self.cid
        self.sketch = matrix(field["sketch"], 4, np.uint64)

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of members of one leaf that are not connected yet and may be similar."""
        left, right = [], []
        for d in range(1, int(self.sizes.max(initial=1))):
            keep = (self.leaf[:-d] == self.leaf[d:]) & (self.comp[:-d] != self.comp[d:])
            i = np.flatnonzero(keep)
            for at in range(0, len(i), 1 << 17):
                a = i[at : at + (1 << 17)]
                b = a + d
                good = _alike(self.sketch[a], self.sketch[b], self.n[a], self.n[b], percent)
                left.append(a[good])
                right.append(b[good])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(left), np.concatenate(right)

    def forest(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """As many of the pairs as connect what all of them connect, the most similar first."""
        a, b = self.pairs(percent)
        order = np.lexsort((self.cid[b], self.cid[a], _differing(self.sketch[a], self.sketch[b])))
        a, b = a[order], b[order]
        leaf = self.leaf[a].tolist()
        keep, _ = _spanning(list(zip(leaf, self.comp[a].tolist())), list(zip(leaf, self.comp[b].tolist())))
        return a[keep], b[keep]


def _partnered(percent: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                leaves = Leaves(batch.column("members"))
                some = np.unique(np.concatenate(leaves.pairs(percent)))
                node = batch.column("node").to_numpy()[leaves.leaf[some]]
                yield record(_ROWS, node=node, cid=leaves.cid[some], n=leaves.n[some], sketch=as_binary(leaves.sketch[some]))

    return mark


def _pairing(percent: int, forest: bool):
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                leaves = Leaves(whole.slice(at, 500).column("members"))
                a, b = (leaves.forest if forest else leaves.pairs)(percent)
                x, y = leaves.cid[a], leaves.cid[b]
                yield record(_PAIRS, a=np.minimum(x, y), b=np.maximum(x, y))

    return pair


def _to_pivot(percent: int):
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch, pivot = (matrix(batch.column(c), 4, np.uint64) for c in ("sketch", "p_sketch"))
            x, y, n, m = (batch.column(c).to_numpy() for c in ("cid", "p_cid", "n", "p_n"))
            good = _alike(sketch, pivot, n, m, percent)
            yield record(_PAIRS, a=np.minimum(x, y)[good], b=np.maximum(x, y)[good])

    return pair


def _apart(percent: int):
    schema = pa.schema([("node", pa.int64()), ("cid", pa.int64())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, i, j, members in zip(*(batch.column(c) for c in ("node", "i", "j", "members"))):
                value = {f.name: members.values.field(k) for k, f in enumerate(members.values.type)}
                cid, own, n, comp = (value[c].to_numpy() for c in ("cid", "own", "n", "comp"))
                core, signs = value["core"].to_numpy(zero_copy_only=False), _signs(matrix(value["sketch"], 4, np.uint64))
                some, order = np.zeros(len(cid), bool), np.argsort(comp, kind="stable")  # connected ones side by side
                left, right = order[own[order] == i.as_py()], order[own[order] == j.as_py()]
                for a in range(0, len(left), AT_ONCE):
                    for b in range(a if i == j else 0, len(right), AT_ONCE):
                        x, y = left[a : a + AT_ONCE], right[b : b + AT_ONCE]
                        if comp[x].min() == comp[x].max() == comp[y].min() == comp[y].max() or not (core[x].any() or core[y].any()):
                            continue
                        near = _all_alike(signs[x], signs[y], n[x], n[y], percent)
                        near &= (comp[x, None] != comp[y]) & (core[x, None] | core[y])
                        some[x] |= near.any(axis=1)
                        some[y] |= near.any(axis=0)
                yield record(schema, node=np.full(some.sum(), node.as_py()), cid=cid[some])

    return mark


# -- full sets -----------------------------------------------------------
def _set_maker(size: int):
    schema = pa.schema([("cid", pa.int64()), ("codes", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            sets = shingle_sets(part.column("text"), size)
            k1, k2 = part.column("k1").to_pylist(), part.column("k2").to_pylist()
            same = [i for i, s in enumerate(sets) if np.frombuffer(_key(s), np.int64).tolist() == [k1[i], k2[i]]]
            yield record(schema, cid=part.column("cid").take(pa.array(same, pa.int64())), codes=[sets[i].tobytes() for i in same])

    return make


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many codes two sorted sets share."""
    place = np.searchsorted(x, y)
    return int((x[np.minimum(place, len(x) - 1)] == y).sum())


def _confirmer(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = _common(x, y)
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield record(schema, a=batch.column("a"), b=batch.column("b"), linked=linked)

    return confirm


def common_counts(sets: list[np.ndarray], others: list[np.ndarray], width=4096) -> np.ndarray:
    """How many codes each of the sets shares with each of the others, by products of their presence matrices, some columns at a time."""
    own, code = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    other, code2 = np.repeat(np.arange(len(others)), [len(s) for s in others]), np.concatenate(others)
    both = np.intersect1d(code, code2)

    def placed(row, code):
        column = np.searchsorted(both, code)
        keep = np.flatnonzero(np.concatenate([both, both[:1]])[column] == code) if len(both) else np.zeros(0, np.int64)
        keep = keep[np.argsort(column[keep], kind="stable")]
        return row[keep], column[keep]

    (x, left), (y, right) = placed(own, code), placed(other, code2)
    out = np.zeros((len(sets), len(others)), np.float32)
    for at in range(0, len(both), width):
        parts = []
        for row, column, n in ((x, left, len(sets)), (y, right, len(others))):
            a, b = np.searchsorted(column, (at, at + width))
            present = np.zeros((n, min(width, len(both) - at)), np.float32)
            present[row[a:b], column[a:b] - at] = 1
            parts.append(present)
        out += parts[0] @ parts[1].T
    return np.rint(out).astype(np.int64)


def _linked(sets: list[np.ndarray], comp: np.ndarray, percent: int, sketch: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Places of linked sets that connect what is not connected yet; ``AT_ONCE`` sets against as many in turn, or those alike by sketch."""
    size, out = np.array([len(s) for s in sets]), []
    signs = None if sketch is None else _signs(sketch)
    _, comp = np.unique(comp, return_inverse=True)
    for i in range(0, len(sets), AT_ONCE):
        for j in range(i, len(sets), AT_ONCE):
            x, y = slice(i, i + AT_ONCE), slice(j, j + AT_ONCE)
            if len(np.unique(np.concatenate([comp[x], comp[y]]))) < 2:
                continue
            near = comp[x, None] != comp[y]
            if signs is not None:
                near &= _all_alike(signs[x], signs[y], size[x], size[y], percent)
            a, b = np.nonzero(np.triu(near, 1) if i == j else near)
            if signs is not None and len(a) <= FEW_PAIRS:
                both = np.array([_common(sets[s], sets[t]) for s, t in zip((a + i).tolist(), (b + j).tolist())], np.int64)
            else:
                both = common_counts(sets[x], sets[y])[a, b]
            a, b = a + i, b + j
            linked = 100 * both >= percent * (size[a] + size[b] - both)
            a, b = a[linked], b[linked]
            keep, root = _spanning(comp[a].tolist(), comp[b].tolist())
            out += zip(a[keep].tolist(), b[keep].tolist())
            if keep:
                comp = np.array([root(c) for c in range(comp.max() + 1)])[comp]
    return out


def _linker(percent: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column("members"):
                values = members.values
                cid, comp = values.field("cid").to_numpy(), values.field("comp").to_numpy()
                sets = [np.frombuffer(c.as_buffer(), np.uint64) for c in values.field("codes")]
                named = [f.name for f in values.type]
                sketch = matrix(values.field("sketch"), 4, np.uint64) if "sketch" in named else None
                places = np.array(_linked(sets, comp, percent, sketch), np.int64).reshape(-1, 2)
                x, y = cid[places[:, 0]], cid[places[:, 1]]
                yield record(_PAIRS, a=np.minimum(x, y), b=np.maximum(x, y))

    return link


def _spanning(left: list, right: list):
    """Places of pairs, in order, that connect what those before them do not; and what names a connected part."""
    root, keep = {}, []

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for k, (x, y) in enumerate(zip(left, right)):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            keep.append(k)
    return keep, find


# -- the join ------------------------------------------------------------
def _grouped(rows: DataFrame, *more: str) -> DataFrame:
    return rows.groupBy("node", *more).agg(F.collect_list(F.struct(*[c for c in rows.columns if c not in ("node", "size", *more)])).alias("members"))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes that hold more than one class, with the node's size."""
    return rows.join(rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), "node")


def _with_core(large: DataFrame) -> DataFrame:
    """Rows of large nodes, and whether each is alike to what its node holds, by some of its members."""
    order = Window.partitionBy("node").orderBy(F.xxhash64("cid", "node"), "cid")
    some = large.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE)
    samples = some.groupBy("node").agg(F.collect_list("sketch").alias("sample"))
    return map_arrow(large.join(samples, "node").select("node", "cid", "n", "sketch", "sample"), _rated, f"{_ROWS_DDL}, core boolean")


def _leaves(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Members of small leaves that may have a partner there; members of large nodes that have a core, if there are any."""
    seeds, large = None, None

    def compared(rows):
        found = saved(map_arrow(_grouped(rows), _partnered(percent), _ROWS_DDL), "seeds")
        return found if seeds is None else seeds.unionByName(found)

    rows = saved(map_arrow(classes.select("cid", "n", "signature"), _from_roots, _ROWS_DDL), "nodes")
    for depth in range(1, DEPTH + 1):
        sized = _sized(rows)
        seeds = compared(sized.where(F.col("size") <= SMALL))
        wide = saved(sized.where(F.col("size") > SMALL).drop("size"), "wide")
        if wide.isEmpty():
            break
        rated = wide.withColumn("core", F.lit(True)) if depth == DEPTH else saved(_with_core(wide), "rated")
        dense = rated.join(rated.where("core").select("node").distinct(), "node", "left_semi")
        large = dense if large is None else large.unionByName(dense)
        if depth == DEPTH:
            break
        others = rated.where("NOT core")
        if others.count() <= FEW_ROWS:
            seeds = compared(others.drop("core"))
            break
        again = others.select("node", "cid").join(classes.select("cid", "n", "signature"), "cid")
        rows = saved(map_arrow(again, _from_nodes, _ROWS_DDL), "nodes")
    if large is not None:
        large = saved(large, "large")
    return seeds, None if large is None or large.isEmpty() else large


def _blobs(large: DataFrame) -> DataFrame:
    """Classes of large nodes, once in each group: nodes that share a core class are one group, its name in ``node``."""
    least = large.where("core").groupBy("node").agg(F.min("cid").alias("v"))
    stars = large.where("core").select("node", F.col("cid").alias("u")).join(least, "node").select("u", "v").distinct()
    roots = components(stars).select(F.col("node").alias("v"), "root")
    names = least.join(roots, "v", "left").select("node", F.coalesce("root", "v").alias("name"))
    members = large.join(names, "node").groupBy(F.col("name").alias("node"), "cid")
    return saved(members.agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.bool_or("core").alias("core")), "groups")


def _open(rows: DataFrame, labels: DataFrame, *more: str) -> DataFrame:
    """Rows with their component, of nodes whose classes are not all connected."""
    rows = rows.join(labels, "cid")
    ends = rows.groupBy("node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("node")
    return rows.join(ends, "node").select("node", "cid", "comp", "n", "sketch", *more)


def _candidates(seeds: DataFrame, groups: DataFrame | None, labels: DataFrame, percent: int, step: int, last: bool) -> DataFrame:
    """Pairs to confirm: a forest of each leaf and one class of each group against the rest; at last all pairs of leaves."""
    pairs = map_arrow(_grouped(_open(seeds, labels)), _pairing(percent, not last), "a long, b long")
    if groups is not None and not last:
        rows = _open(groups, labels, "core")
        pivots = rows.where("core").groupBy("node").agg(F.min_by(F.struct("cid", "comp", "n", "sketch"), F.xxhash64("cid", F.lit(step))).alias("p"))
        beside = rows.join(pivots, "node").where(F.col("p.comp") != F.col("comp"))
        beside = beside.select("cid", "n", "sketch", F.col("p.cid").alias("p_cid"), F.col("p.n").alias("p_n"), F.col("p.sketch").alias("p_sketch"))
        pairs = pairs.unionByName(map_arrow(beside, _to_pivot(percent), "a long, b long"))
    return pairs.distinct()


def _block_pairs(rows: DataFrame, count, *columns: str) -> DataFrame:
    """(node, i, j, members): each two blocks of a node, and each block by itself, unless its classes are all connected."""
    blocks = rows.groupBy("node").agg(F.ceil(count).cast("int").alias("count"))
    spread = (
        rows.join(blocks, "node")
        .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("count")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    )
    members = spread.select("node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *columns)
    pairs = members.groupBy("node", "i", "j").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.collect_list(F.struct("own", *columns)).alias("members")
    )
    return pairs.where("lo <> hi").select("node", "i", "j", "members")


def _within_groups(groups: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is not connected yet in each group: by sketch what may have a link, by full sets what has one, block against block."""
    rows = saved(_open(groups, labels, "core"), "open")
    blocks = _block_pairs(rows, F.count("*") / BLOCK_SETS, "cid", "comp", "n", "sketch", "core")
    apart = saved(map_arrow(blocks, _apart(percent), "node long, cid long").distinct(), "apart")
    left = rows.join(apart, ["node", "cid"]).join(sets, "cid")
    blocks = _block_pairs(left, F.greatest(F.sum("n") * 8 / BLOCK_BYTES, F.count("*") / BLOCK_SETS), "cid", "comp", "sketch", "codes")
    return map_arrow(blocks.select("members"), _linker(percent), "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x = sets.select(F.col("cid").alias("a"), F.col("codes").alias("x"))
    y = sets.select(F.col("cid").alias("b"), F.col("codes").alias("y"))
    return map_arrow(pairs.join(x, "a").join(y, "b"), _confirmer(percent), "a long, b long, linked boolean")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    ends = links.join(labels.select(F.col("cid").alias("a"), F.col("comp").alias("u")), "a").join(labels.select(F.col("cid").alias("b"), F.col("comp").alias("v")), "b")
    roots = components(ends.select("u", "v"))
    new = labels.join(roots.withColumnRenamed("node", "comp"), "comp", "left").select("cid", F.coalesce("root", "comp").alias("comp"))
    return saved(new, "labels")


def classes_of(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, n_shingles, k1, k2), and one row per distinct shingle set."""
    rows = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    signed = saved(map_arrow(rows, _signer(size), "doc_id long, text_hash long, n_shingles long, k1 long, k2 long, signature binary"), "signed")
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("k1", "k2")
        .agg(
            F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("of"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
        )
        .withColumn("cid", F.monotonically_increasing_id())  # fixed by the write
    )
    return signed.drop("signature"), saved(classes, "classes")


def near_duplicates(docs: DataFrame, size=5, percent=80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; also text_hash, by which a row is known."""
    signed, classes = classes_of(docs, size)
    seeds, large = _leaves(classes, percent)
    active = (seeds if large is None else seeds.unionByName(large.drop("core"))).select("cid").distinct()
    labels = saved(active.withColumn("comp", F.col("cid")), "labels")
    found = labels
    if not labels.isEmpty():
        owners = classes.join(active, "cid").select("cid", "k1", "k2", F.col("of.doc_id").alias("of_id"), F.col("of.text_hash").alias("of_hash"))
        texts = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
        owned = texts.join(owners, F.col("text_hash").eqNullSafe(F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of_id")))
        sets = map_arrow(owned.select("cid", "text", "k1", "k2"), _set_maker(size), "cid long, codes binary")
        sets = saved(sets.dropDuplicates(["cid"]), "sets")
        tried = docs.sparkSession.createDataFrame([], "a long, b long, linked boolean")
        groups = None if large is None else _blobs(large)
        rounds = 1 if groups is None else PIVOT_ROUNDS
        for step in range(rounds + 1):
            last = step == rounds
            pairs = _candidates(seeds, groups, found, percent, step, last).join(tried, ["a", "b"], "left_anti")
            seen = saved(_confirmed(pairs, sets, percent), "tried")
            links = seen.where("linked").select("a", "b")
            if last and groups is not None:
                links = saved(links.unionByName(_within_groups(groups, found, sets, percent)), "links")
            if not links.isEmpty():
                found = _relabelled(found, links)
            tried = tried.unionByName(seen)
    by_class = classes.join(found, "cid", "left").select("k1", "k2", "least_id", F.coalesce("comp", "cid").alias("comp"))
    least = by_class.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = by_class.join(least, "comp").select("k1", "k2", "component_id", "comp")
    out = signed.join(named, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash", "comp"
    )


def one_of_each(docs: DataFrame, size=5, percent=80) -> DataFrame:
    """The documents, one of each component: the smallest (doc_id, text hash), all columns kept.

    Documents without words stay, all of them.
    """
    found = saved(near_duplicates(docs, size, percent), "members")
    keep = found.where("n_shingles > 0").groupBy("comp").agg(F.min(F.struct("doc_id", "text_hash")).alias("of"))
    rows = rows_of(docs)
    match = F.col("doc_id").eqNullSafe(F.col("of.doc_id")) & F.col("text_hash").eqNullSafe(F.col("of.text_hash"))
    first = rows.join(keep.select("of"), match, "left_semi")
    kept = found.where("n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1")
    if not kept.isEmpty():  # the very same row more than once
        first = first.dropDuplicates(["doc_id", "text_hash"])
    wordless = rows.where(~F.coalesce(F.col("document.text").cast("string").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)))
    return first.unionByName(wordless).select("document.*")
