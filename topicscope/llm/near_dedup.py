"""MinHash near-dedup (1): one-permutation hashing with optimal densification,
banded buckets, star-shaped candidate edges.

A document's set are its distinct word shingles (whole text; ASCII lower case).
One pass over the set fills ``BANDS * ROWS`` bins with their minimum; an empty
bin takes the value of the first filled bin in a random order of the bins of
its own (the same order for all documents).  ``ROWS`` bins make a band, and
documents that agree on a band share a bucket: two sets of similarity 0.8 share
none of the 40 buckets with a probability of about 5e-6.

Documents of equal sets are one class from the start, so copies never meet in
buckets.  Within a bucket candidate edges form stars: all members are compared
with one centre (the member with the most company in its buckets), which bounds
the edges by the bucket's size; ``ROUNDS`` further stars per bucket, of members
that were no centre yet, follow where a bucket still holds two components.  A
star may miss a link between two members that both differ from the centre; two
such members must differ from it in the same places, so an exact join on the
members' differences from their centre finds them (:func:`_missed_by_stars`).
So every pair that shares a bucket is compared, ruled out by its sizes, or in
one component already, without making all pairs of a bucket.

Every candidate edge is confirmed on the full shingle sets.

Defined cases: a null text, or one without words, has an empty set and is
linked with nothing; a text of fewer words than a shingle is one shingle; rows
that share a doc_id are documents of their own; a row without doc_id takes part
in links but has no component id of its own (null, not kept) unless it is
linked with one that has; an empty table gives an empty result; only the id
and text columns are read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, drop_staged, mix, shingle_hashes, sliced, staged
from .components import components

SHINGLE = 5
THRESHOLD = 80  # per cent
BANDS = 40
ROWS = 6
ROUNDS = 1
#: Members of one component at one element of a star that are treated as one family.
FAMILY = 32
SEED = 11

_kept: dict = {}


def _plan(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each bin in each bin's random order; factors and salts of bands."""
    if (bands, rows) not in _kept:
        rng = np.random.default_rng(SEED)
        k = bands * rows
        rank = rng.permuted(np.tile(np.arange(k, dtype=np.uint16), (k, 1)), axis=1)
        factors = rng.integers(1, 1 << 62, rows, np.uint64) * np.uint64(2) + np.uint64(1)
        salts = rng.integers(1, 1 << 62, bands, np.uint64)
        _kept[bands, rows] = rank, factors, salts
    return _kept[bands, rows]


def shingle_set(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = text.lower().split() if text else []
    return np.unique(shingle_hashes(hashes.array(words), width))


def bins_of(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One-permutation signature of a non-empty sorted set, densified."""
    k = bands * rows
    rank, _, _ = _plan(bands, rows)
    # the bin grows with the hash, so the first of each bin is its minimum
    at = ((shingles >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    filled, first = np.unique(at, return_index=True)
    filled = filled.astype(np.int64)
    out = np.empty(k, np.uint64)
    out[filled] = shingles[first]
    if len(filled) < k:
        empty = np.ones(k, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        out[empty] = out[filled[rank[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    _, factors, salts = _plan(bands, rows)
    return mix((mix(signature.reshape(bands, rows)) * factors).sum(axis=1, dtype=np.uint64) + salts)


def _ids(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit identity of a set, as two longs."""
    h = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return tuple(int(x) for x in np.array([h >> 64, h & (1 << 64) - 1], np.uint64).view(np.int64))


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id, t (hash of the text), n_shingles, h1, h2 (null for an empty set), bands."""
    def run(batches):
        hashes = WordHashes()
        for batch in sliced(batches):
            n, h1, h2, bands = [], [], [], []
            for v in batch.column(3):
                s = shingle_set(v.as_py(), width, hashes)
                n.append(len(s))
                a, b = _ids(s) if len(s) else (None, None)
                h1.append(a)
                h2.append(b)
                bands.append(band_keys(bins_of(s)).view(np.int64) if len(s) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["row", "doc_id", "t", "n_shingles", "h1", "h2", "bands"])

    rows = bounded_batches(docs).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text_key(text_col).alias("t"),
        F.encode(F.col(text_col).cast("string"), "UTF-8").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id {kind}, t long, n_shingles long, h1 long, h2 long, "
                                "bands array<long>")


def text_key(text_col: str) -> Column:
    """Hash of a text: with its id it finds a document's text again, whatever rows share the id.
    ``text_col`` is a column's name, in backticks where it needs them."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the wanted classes, read again from a document of each."""
    def run(batches):
        hashes = WordHashes()
        for batch in sliced(batches):
            node, sets = [], []
            for k, v, h1, h2 in zip(*(batch.column(i) for i in range(4)), strict=True):
                s = shingle_set(v.as_py(), width, hashes)
                if len(s) and _ids(s) == (h1.as_py(), h2.as_py()):
                    node.append(k.as_py())
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()),
                                              pa.array(sets, pa.list_(pa.int64()))],
                                             names=["node", "shingles"])

    texts = docs.select(F.col(id_col).alias("_id"), text_key(text_col).alias("_t"),
                        F.encode(F.col(text_col).cast("string"), "UTF-8").alias("_text"))
    some = texts.join(wanted, F.col("_id").eqNullSafe(F.col("rep_id")) & (F.col("_t") == F.col("rep_t"))) \
        .select("node", "_text", "h1", "h2")
    return some.mapInArrow(run, "node long, shingles array<long>")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with both full sets (sa, sb)."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(right, "b").join(left, "a")


def _similar(threshold: int) -> Column:
    """100 * intersection >= threshold * union, from the sizes and ``both``."""
    return 100 * F.col("both") >= threshold * (F.size("sa") + F.size("sb") - F.col("both"))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    return _with_sets(pairs, sets).withColumn("both", F.size(F.array_intersect("sa", "sb"))) \
        .where(_similar(threshold)).select("a", "b")


def _centres(members: DataFrame) -> DataFrame:
    """The member of most company in each bucket (the smallest of equals)."""
    best = F.min(F.struct((-F.col("company")).alias("c"), F.col("node").alias("node"),
                          F.col("n").alias("n"), F.col("component").alias("component")))
    return members.groupBy("bucket").agg(best.alias("m")).select("bucket", "m.node", "m.n", "m.component")


def _relabelled(rows: DataFrame, comp: DataFrame, node: str, label: str) -> DataFrame:
    """``label``: the component of ``node`` (itself if it has no link)."""
    c = comp.select(F.col("node").alias(node), F.col("component").alias(label))
    return rows.drop(label).join(c, node, "left").withColumn(label, F.coalesce(label, node))


def _candidates(members: DataFrame, centres: DataFrame, threshold: int) -> DataFrame:
    """Pairs of a bucket's members and its centres in other components."""
    c = centres.select("bucket", F.col("node").alias("centre"), F.col("n").alias("cn"),
                       F.col("component").alias("cc"))
    return members.join(c, "bucket").where(
        (F.col("component") != F.col("cc"))
        & (100 * F.least("n", "cn") >= threshold * F.greatest("n", "cn"))) \
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def classes(sigs: DataFrame) -> DataFrame:
    """h1, h2, node (one row id per distinct set), rep_id, rep_t, n, min_id."""
    one = F.min(F.struct("row", "doc_id", "t", "n_shingles"))
    return sigs.where(F.col("h1").isNotNull()).groupBy("h1", "h2").agg(
        one.alias("r"), F.min("doc_id").alias("min_id")).select(
        "h1", "h2", F.col("r.row").alias("node"), F.col("r.doc_id").alias("rep_id"), F.col("r.t").alias("rep_t"),
        F.col("r.n_shingles").alias("n"), "min_id")


def _missed_by_stars(star: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Candidate pairs (a, b) of members of one star that lie in two components.

    Let D be the symmetric difference of a member's set with the centre's.  Two
    members are similar only if the symmetric difference of their D is at most
    a share q = (100 - threshold) / (100 + threshold) of their sets' summed
    sizes.  A member that is not linked with the centre has a D of more than q
    times (its size + the centre's), and it follows that it shares at least
    one element of D with any similar member; more exactly (n: sizes, c: the
    centre's), at least

        s = (|D| + q * (c - n)) / 2   if the partner is not linked either,
        l = (|D| - q * (c + n)) / 2   if the partner is linked.

    So pairs are found by an equi-join on elements of D, each member with only
    its rarest |D| - s + 1 (or l) elements of the star: of two sets that share
    t elements, the |D| - t + 1 first ones in a common order meet.
    """
    q = (100 - threshold) / (100 + threshold)
    both = F.concat(F.array_except("sb", "sa"), F.array_except("sa", "sb"))
    rows = _with_sets(star, sets).select(
        "a", "b", "linked", "component", F.size("sb").alias("n"), F.size("sa").alias("c"),
        both.alias("d"))
    rows = staged(rows.withColumn("size", F.size("d")), "differences")
    elements = rows.select("a", "b", F.explode("d").alias("e"))
    several = elements.groupBy("a", "e").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # elements of one member alone come first in the order and meet nobody
    ranked = elements.join(several, ["a", "e"]).groupBy("a", "b").agg(
        F.sort_array(F.collect_list(F.struct("f", "e"))).alias("met"))
    tiny = 1e-6  # rounding never shortens a prefix
    s = (F.col("size") + q * (F.col("c") - F.col("n"))) / 2 - tiny
    low = (F.col("size") - q * (F.col("c") + F.col("n"))) / 2 - tiny
    alone = F.col("size") - F.size("met")
    prefix = lambda t: F.greatest(F.col("size") - F.greatest(F.ceil(t), F.lit(1)) + 1 - alone,
                                  F.lit(0)).cast("int")
    lean = rows.drop("d").join(ranked, ["a", "b"]).select(
        "a", "b", "linked", "component", "n", "size", alone.alias("alone"), prefix(s).alias("short"),
        F.when(F.col("linked"), prefix(s)).otherwise(F.greatest(prefix(s), prefix(low))).alias("long"), "met")
    lean = staged(lean.withColumn("met", F.slice("met", F.lit(1), F.col("long"))), "prefixes")
    # rest: elements of D from this one on, in the common order
    terms = lean.select("a", "b", "linked", "component", "n", "size", "alone", "short",
                        F.posexplode("met").alias("at", "m")) \
        .select("a", "b", "linked", "component", "n", "size", (F.col("at") < F.col("short")).alias("early"),
                (F.col("size") - F.col("alone") - F.col("at")).alias("rest"), F.col("m.e").alias("e"))

    def side(rows: DataFrame, k: str) -> DataFrame:
        names = {"b": "", "linked": "l", "component": "c", "n": "n", "size": "s", "early": "e", "rest": "r",
                 "cls": "k", "family": "f"}
        return rows.select("a", "e", *[F.col(c).alias(k + v) for c, v in names.items()])

    # an element that one component has alone leads to nobody
    several = terms.groupBy("a", "e").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo != hi").select("a", "e")
    # the sizes of two D differ by at most q times the sets' summed sizes: classes of that width per star
    widest = lean.groupBy("a").agg(F.max("n").alias("widest"))
    size_class = F.floor(F.col("size") / F.greatest(2 * q * F.col("widest"), F.lit(1.0)))
    terms = staged(terms.join(several, ["a", "e"]).join(widest, "a").withColumn("cls", size_class).drop("widest"),
                   "elements")
    # members of a family (many of one component at an element) are never paired with each other
    families = terms.groupBy("a", "e", "cls", "component").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= FAMILY) \
        .select("a", "e", "cls", "component", F.lit(True).alias("family"))
    families = staged(families, "families")
    near = F.explode(F.array(F.col("xk") - 1, F.col("xk"), F.col("xk") + 1)).alias("yk")
    if families.limit(1).count():
        terms = staged(terms.join(families, ["a", "e", "cls", "component"], "left")
                       .withColumn("family", F.coalesce("family", F.lit(False))), "elements")
        free, early = terms.where(~F.col("linked")), terms.where("early")
        x, y = side(free, "x").select("*", near), side(early, "y")
        one = x.where(~F.col("xf")).join(y, ["a", "e", "yk"])
        two = x.where("xf").join(y.where(~F.col("yf")), ["a", "e", "yk"])
        # two families: their components meet first, then the members of each two
        heads = x.where("xf").select("a", "e", "xk", "xc", "yk").distinct()
        apart = heads.join(y.where("yf").select("a", "e", "yk", "yc").distinct(), ["a", "e", "yk"]).where("xc != yc")
        three = side(free.where("family"), "x").join(apart, ["a", "e", "xk", "xc"]) \
            .join(y.where("yf"), ["a", "e", "yk", "yc"])
        met = [one, two, three]
    else:
        terms = terms.withColumn("family", F.lit(False))
        met = [side(terms.where(~F.col("linked")), "x").select("*", near)
               .join(side(terms.where("early"), "y"), ["a", "e", "yk"])]
    # at the first element they share, both must have as many left as they need to share
    need = (F.col("xs") + F.col("ys") - q * (F.col("xn") + F.col("yn"))) / 2 - tiny
    pairs = [p.where((F.col("xc") != F.col("yc")) & (F.col("yl") | F.col("xe")) & (F.least("xr", "yr") >= need))
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")) for p in met]
    return functools.reduce(DataFrame.unionByName, pairs).distinct()


def linked_components(docs: DataFrame, sigs: DataFrame, cls: DataFrame, width: int, threshold: int,
                      id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the classes that are linked: verified links enough to connect all
    that are similar, and their components."""
    node_rows = sigs.select(F.col("row").alias("node"), "bands").join(cls.select("node", "n"), "node")
    entries = node_rows.select("node", "n", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    first = staged(entries.join(shared, "bucket"), "buckets")
    company = first.groupBy("node").agg(F.sum("size").alias("company"))
    members = staged(first.join(company, "node").select(
        "bucket", "node", "n", "company", F.col("node").alias("component")), "members")
    wanted = cls.join(company.select("node"), "node", "left_semi").select("node", "rep_id", "rep_t", "h1", "h2")
    # several rows of one id and text would give a class several times
    sets = staged(_sets(docs, wanted, width, id_col, text_col), "sets")
    if sets.groupBy("node").count().where("count > 1").limit(1).count():
        sets = staged(sets.dropDuplicates(["node"]), "sets")
    drop_staged(first)

    # the first stars: every member of a bucket against its centre
    centres = staged(_centres(members), "centres")
    star = members.join(centres.select("bucket", F.col("node").alias("a")), "bucket") \
        .where("node != a").select("a", F.col("node").alias("b")).distinct()
    star = staged(_with_sets(star, sets).withColumn("both", F.size(F.array_intersect("sa", "sb")))
                  .select("a", "b", _similar(threshold).alias("linked")), "star")
    found = staged(star.where("linked").select("a", "b"), "found")
    comp = staged(components(found), "components")
    # further stars join families that lie in one bucket; what they miss is found below
    for _ in range(ROUNDS):
        rest = _relabelled(members.join(centres.select("bucket", "node"), ["bucket", "node"], "left_anti"),
                           comp, "node", "component")
        rest = staged(rest, "members")
        mixed = rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
            .where("lo != hi").select("bucket")
        members = staged(rest.join(mixed, "bucket", "left_semi"), "members")
        drop_staged(rest)
        centres = staged(_centres(members), "centres")
        new = staged(_verified(_candidates(members, centres, threshold), sets, threshold), "links")
        if not new.limit(1).count():
            break
        found = staged(found.unionByName(new), "found")
        comp = staged(components(found), "components")
    # stars whose members (the centre included) lie in several components; those the further stars
    # have joined meet no more
    labelled = staged(_relabelled(star.withColumn("component", F.col("b")), comp, "b", "component"), "star")
    open_stars = staged(labelled.groupBy("a").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                        .where("lo != hi").select("a"), "open-stars")
    if not open_stars.limit(1).count():
        return comp
    missed = _missed_by_stars(labelled.join(open_stars, "a", "left_semi"), sets, threshold)
    new = staged(_verified(missed, sets, threshold), "links")
    return components(found.unionByName(new)) if new.limit(1).count() else comp


def _with_component(docs: DataFrame, width: int, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, t, n_shingles, node (null without words), component
    (a node) and component_id (the smallest doc_id of the component)."""
    sigs = staged(signatures(docs, width, id_col, text_col), "signatures")
    cls = staged(classes(sigs), "classes")
    comp = linked_components(docs, sigs, cls, width, threshold, id_col, text_col)
    of_class = staged(cls.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")),
                      "of-class")
    lowest = of_class.groupBy("component").agg(F.min("min_id").alias("component_id"))
    ids = of_class.join(lowest, "component").select("h1", "h2", "component", "component_id")
    return sigs.select("doc_id", "t", "n_shingles", "h1", "h2").join(ids, ["h1", "h2"], "left").drop("h1", "h2")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, threshold: int = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the
    smallest doc_id reachable by links, itself included), kept."""
    own = F.coalesce(F.col("component_id"), F.col("doc_id"))
    return _with_component(docs, width, threshold, id_col, text_col).select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def fates(docs: DataFrame, width: int = SHINGLE, threshold: int = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t, n, stays) of the documents -- an id and the hash of a text -- that go,
    or that stay but lie in several rows (n).  Of a component the document of the smallest
    id stays (a null one comes last; of several the smaller t)."""
    groups = _with_component(docs, width, threshold, id_col, text_col).where("component IS NOT NULL")
    document = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    first = groups.groupBy("component").agg(F.min(document).alias("d")).select("d.doc_id", "d.t")
    known = groups.groupBy("doc_id", "t").agg(F.count(F.lit(1)).alias("n"))
    stays = known.alias("a").join(first.alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.t = b.t"), "left") \
        .select("a.doc_id", "a.t", "a.n", F.col("b.t").isNotNull().alias("stays"))
    return stays.where("NOT stays OR n > 1")


def one_of_each(docs: DataFrame, fate: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, by their :func:`fates`: of several rows of
    the document that stays the least one.  Rows without words stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_r"))
    own, text = F.col(f"_r.`{id_col}`"), text_key(f"_r.`{text_col}`")

    def of(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        return rows.join(some, own.eqNullSafe(some["doc_id"]) & (text == some["t"]), how)

    left = of(rows, fate.where("NOT stays"), "left_anti")
    several = fate.where("stays")
    if several.limit(1).count():
        again = of(left, several, "left_semi").select("_r", own.alias("i"), text.alias("t"))
        one = again.groupBy("i", "t").agg(F.min("_r").alias("_r")).select("_r")
        left = of(left, several, "left_anti").unionByName(one)
    return left.select("_r.*")
