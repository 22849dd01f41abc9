"""Exact Jaccard links of word-shingle sets by a grouped prefix join.

Every set is sorted in one global order: shingles that look frequent on a
sample last, then by hash. If two sets are similar enough, the first of their
common shingles lies in both prefixes, early enough that the rest could still
reach the needed overlap. Equal sets are one vertex from the start; vertices
with the same prefix and size are one group, and the index holds a group's
prefix once. Group pairs that meet in the index pass the size and position
filters and are expanded to their members. Every set also has a bitmap of about a
bit or two a shingle, the parities of its shingles by hash: where two differ, so
do the sets, and what differs in more places than linked sets may goes without a
look at its texts. The texts of the others are compared in full.

No long list emits all its pairs: at first it compares its groups with one
leader only, and the links are merged into components. Pairs inside a component
are not needed any more, so the second round compares only what lies outside a
list's largest component with the rest of the list. That covers every pair of
different components that passes the filters, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LAST_ID, components, quoted, released, staged, staged_at, texts, unused

#: Words of a shingle; links need COMMON / UNION >= 4 / 5.
SHINGLE = 5
#: Documents that the frequency order is estimated on at least, one in so many of a larger corpus (else lists grow with it), and shingles it knows at most.
ORDER_DOCS, ORDER_SHARE, ORDER_SHINGLES = 10_000, 20, 500_000
#: Bits that tell which texts are looked for; more texts than that only let others through.
PLACES = 2**21
#: Lists up to this length compare all their groups at once; longer ones begin with a leader.
SHORT_LIST = 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Hashes of words met; each task empties it, so a worker does not keep it beside other operators' memories."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 200_000:
            self[word] = value
        return value


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the text's distinct shingles; a shorter text is one shingle, no words none."""
    words = text.encode().lower().split()  # bytes: A-Z only, and just the six ASCII spaces
    if not words:
        return np.zeros(0, np.int64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    if n < 1:
        short = np.array([len(words)], np.uint64)
        for h in hashes:
            short = _mixed(short * _MULTIPLIER + h)
        return short.view(np.int64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out = out * _MULTIPLIER + hashes[k:k + n]
    return np.unique(_mixed(out).view(np.int64))


def needed_overlap(a: Column, b: Column) -> Column:
    """Common shingles that sets of these sizes need: 100 I >= 80 (a + b - I)."""
    return F.ceil((a + b) * 4 / F.lit(9))


def _digest(x: np.ndarray) -> tuple[int, int]:
    u = x.view(np.uint64)
    return (int(np.add.reduce(_mixed(u)).view(np.int64)) if len(x) else 0,
            int(np.bitwise_xor.reduce(_mixed(u * _MULTIPLIER + np.uint64(1))).view(np.int64)) if len(x) else 0)


def parities(x: np.ndarray) -> bytes:
    """Bitmap of distinct hashes: for each place by their last bits whether an odd number falls there.

    At least a bit a shingle, a power of two. Halves laid over each other (exclusive or) give the bitmap of half the size.
    """
    if not len(x):
        return b""
    size = max(64, 1 << (len(x) - 1).bit_length())
    odd = np.bincount((x.view(np.uint64) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Places where two bitmaps differ, the larger one folded to the other's size: the sets differ in as many shingles at least."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    nx, ny = len(a) * 8, len(b) * 8
    while nx != ny:
        if nx > ny:
            nx //= 2
            x = (x >> nx) ^ (x & ((1 << nx) - 1))
        else:
            ny //= 2
            y = (y >> ny) ^ (y & ((1 << ny) - 1))
    return (x ^ y).bit_count()


def frequency_order(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles met in several of a sample's texts, with their counts.

    Only sorts the prefixes: any order gives the same links.
    """
    total = max(1, rows.count())
    picked = rows.select("text").sample(min(1.0, max(ORDER_DOCS / total, 1 / ORDER_SHARE)), 11).distinct()

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                sets = [shingle_set(t) for t in batch.column(0).slice(k, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets))], names=["shingle"])
        _HASHES.clear()

    found, path = staged_at(picked.mapInArrow(shingles, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
                            .where("n > 1").orderBy(F.desc("n"), "shingle").limit(ORDER_SHINGLES), "frequent")
    counted = found.toPandas().sort_values("shingle")
    released(rows.sparkSession, path)
    return counted["shingle"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)


def prefixes(rows: DataFrame, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Size, digests, prefix and bitmap of every text's set."""
    known = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = known.value
        # a few rows at a time: a batch may hold many megabytes of text
        for batch in (whole.slice(k, 1_000) for whole in batches for k in range(0, whole.num_rows, 1_000)):
            out: dict[str, list] = {k: [] for k in ("n", "fa", "fb", "ga", "gb", "prefix", "bits")}
            for t in batch.column(2).to_pylist():
                x = shingle_set(t)
                n = len(x)
                seen = np.zeros(n, np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)
                    seen = np.where(frequent[at] == x, counts[at], 0)
                prefix = x[np.lexsort((x, seen))][:n - (4 * n + 4) // 5 + 1] if n else x
                out["n"].append(n)
                for name, v in zip(("fa", "fb", "ga", "gb"), _digest(x) + _digest(prefix)):
                    out[name].append(v)
                out["prefix"].append(prefix)
                out["bits"].append(parities(x))
            kinds = [("n", pa.int64()), *((k, pa.int64()) for k in ("fa", "fb", "ga", "gb")), ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(out[k], t) for k, t in kinds)],
                                             names=["doc_id", "th", *(k for k, _ in kinds)])
        _HASHES.clear()

    return rows.select("doc_id", "th", "text").mapInArrow(
        run, "doc_id long, th long, n long, fa long, fb long, ga long, gb long, prefix array<long>, bits binary")


def likely_pairs(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """The (u, v) of ``pairs`` whose bitmaps differ in no more places than the shingles of linked sets may."""
    sides = pairs.select("u", "v", F.explode(F.array("u", "v")).alias("vid"))
    one = F.struct("vid", "n", "bits")
    both = sides.join(vertices.select("vid", "n", "bits"), "vid").groupBy("u", "v").agg(F.min(one).alias("a"), F.max(one).alias("b")).select(
        "u", "v", (F.col("a.n") + F.col("b.n") - 2 * needed_overlap(F.col("a.n"), F.col("b.n"))).alias("most"),
        F.col("a.bits").alias("x"), F.col("b.bits").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most, x, y = (batch.column(k).to_pylist() for k in (2, 3, 4))
            keep = pa.array([differing(p, q) <= m for p, q, m in zip(x, y, most)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def maybe_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose text hash ``th`` is none of ``wanted``; a broadcast of ``PLACES`` bits at most, in words of 64, whatever the rows."""
    at = F.pmod(F.col("th"), F.lit(PLACES))
    word, bit = F.shiftright(at, 6).alias("_word"), F.pmod(at, F.lit(64)).cast("int").alias("_bit")
    marks = wanted.select(word, bit).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_marks"))
    return rows.select("*", word, bit).join(F.broadcast(marks), "_word").where(F.getbit("_marks", "_bit") == 1).select(*rows.columns)


def linked_pairs(pairs: DataFrame, vertices: DataFrame, rows: DataFrame) -> DataFrame:
    """The (u, v) of ``pairs`` whose sets are similar enough, compared in full."""
    sides = pairs.select("u", "v", F.explode(F.array("u", "v")).alias("vid"))
    named = sides.join(vertices.select("vid", F.struct("doc_id", "th").alias("row")), "vid").select("u", "v", "row")
    asked = maybe_of(rows, vertices.join(sides.select("vid"), "vid", "left_semi"))
    both = (named.join(asked.select(F.struct("doc_id", "th").alias("row"), "text"), "row")
            .groupBy("u", "v").agg(F.min("text").alias("a"), F.max("text").alias("b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = shingle_set(a.as_py()), shingle_set(b.as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * common >= 80 * (len(x) + len(y) - common))
            keep = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])
        _HASHES.clear()

    return both.mapInArrow(run, "u long, v long")


def _close(a: str, b: str) -> Column:
    """Sizes and places of a common prefix shingle still allow the overlap."""
    return F.least(F.col(f"{a}n") - F.col(f"{a}pos"), F.col(f"{b}n") - F.col(f"{b}pos")) >= needed_overlap(F.col(f"{a}n"), F.col(f"{b}n"))


def _pairs(frame: DataFrame, a: str, b: str) -> DataFrame:
    return frame.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct()


def _side(lists: DataFrame, prefix: str, *names: str) -> DataFrame:
    return lists.select("token", *(F.col(c).alias(prefix + c) for c in names))


def _smallest() -> Column:
    """Key of the smallest row, by id and text hash; a null id comes after the largest one."""
    return F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("at"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th"))


def _linked_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Every row's set, the component of every distinct set that is not empty, and the folder of the first.

    (doc_id, n, fa, fb), and (vid, comp, doc_id, th, fa, fb, n) with the
    (doc_id, text hash) of the set's smallest row; null ids count as the largest.
    """
    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    used: list[str] = []  # staged folders that only the way to the result reads

    def kept(df: DataFrame, name: str) -> DataFrame:
        out, path = staged_at(df, name)
        used.append(path)
        return out

    whole_sets, whole_path = staged_at(prefixes(rows, frequency_order(rows)), "shingle-sets")
    key = ["fa", "fb", "n"]
    vertices, vertices_path = staged_at(
        whole_sets.where("n > 0").groupBy(*key, "ga", "gb").agg(
            _smallest().alias("rep"),
            F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
        .select(F.monotonically_increasing_id().alias("vid"), "rep.doc_id", "rep.th", *key, "ga", "gb", "prefix", "bits"), "vertices")
    # each folder goes as soon as what is read of it later lies in a smaller one
    sets, sets_path = staged_at(whole_sets.select("doc_id", *key), "set-keys")
    released(docs.sparkSession, whole_path)
    # groups: equal prefix and size
    groups = vertices.groupBy("ga", "gb", "n").agg(F.min("vid").alias("gid"), F.count(F.lit(1)).alias("members"))
    of_group = staged(vertices.drop("prefix").join(groups, ["ga", "gb", "n"])
                      .select("vid", "gid", "members", "doc_id", "th", *key, "bits"), "groups")
    index = (vertices.join(of_group.where("vid = gid").select("vid", "members"), "vid")
             .select(F.col("vid").alias("gid"), "n", "members", F.posexplode("prefix").alias("pos", "token")))
    near = Window.partitionBy("token").orderBy("gid")
    lists = kept(index.withColumn("_other", F.coalesce(F.lag("gid").over(near), F.lead("gid").over(near)))
                   .where("_other is not null").drop("_other"), "lists")
    released(docs.sparkSession, vertices_path)

    # first round: short lists whole, long lists against a leader, groups against their first member;
    # the leader has the fewest rarer shingles before the list's, so it is the least edited copy
    leaders = lists.groupBy("token").agg(F.count(F.lit(1)).alias("length"), F.min(F.struct(
        "pos", F.xxhash64("token", "gid").alias("h"), "gid", "n")).alias("lead"))
    headed = kept(lists.join(leaders, "token"), "headed-lists")
    short = headed.where(F.col("length") <= SHORT_LIST)
    whole = _side(short, "a_", "gid", "n", "pos").join(_side(short, "b_", "gid", "n", "pos"), "token").where(
        F.col("a_gid") < F.col("b_gid"))
    led = headed.where(F.col("length") > SHORT_LIST).select(
        F.col("gid").alias("a_gid"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos"),
        F.col("lead.gid").alias("b_gid"), F.col("lead.n").alias("b_n"), F.col("lead.pos").alias("b_pos")).where("a_gid <> b_gid")
    inside = of_group.where("vid <> gid").select(F.col("gid").alias("u"), F.col("vid").alias("v"))
    sides = ["a_gid", "b_gid", "a_n", "b_n", _close("a_", "b_").alias("close")]
    met = (whole.select(*sides, F.lit(1).alias("c")).unionByName(led.select(*sides, F.lit(0).alias("c")))
           .select(F.least("a_gid", "b_gid").alias("u"), F.greatest("a_gid", "b_gid").alias("v"),
                   F.least("a_n", "b_n").alias("less"), F.greatest("a_n", "b_n").alias("more"), "c", "close")
           .groupBy("u", "v").agg(F.max("close").alias("close"), F.sum("c").alias("c"), F.max("less").alias("less"), F.max("more").alias("more")))
    # what is common lies in both prefixes (counted in short lists; in long ones at most as
    # many as either has there) or behind one prefix
    many = headed.where(F.col("length") > SHORT_LIST).groupBy("gid").agg(F.count(F.lit(1)).alias("k"))
    bounded = (met.join(many.toDF("u", "ku"), "u", "left").join(many.toDF("v", "kv"), "v", "left")
               .where("close").where(F.col("c") + F.least(F.coalesce("ku", F.lit(0)), F.coalesce("kv", F.lit(0)))
                      + F.ceil(F.col("more") * 4 / F.lit(5)) - 1 >= needed_overlap(F.col("less"), F.col("more"))))
    met_first = kept(bounded.select("u", "v").unionByName(inside).distinct(), "pairs-1")
    tested = kept(likely_pairs(met_first, of_group), "likely-1")
    links = kept(linked_pairs(tested, of_group, rows), "links-1")
    merged = components(links.select(F.col("u").alias("a"), F.col("v").alias("b")), "cc-1")

    # second round: what may still join two components
    placed = kept(of_group.drop("bits").join(merged.withColumnRenamed("id", "vid"), "vid", "left")
                    .withColumn("comp", F.coalesce("component_id", "vid")).drop("component_id"), "placed")
    pure = placed.groupBy("gid").agg(F.when(F.min("comp") == F.max("comp"), F.min("comp")).alias("gcomp"))
    open_lists = (headed.where((F.col("length") > SHORT_LIST) | (F.col("members") > 1)).select("token").distinct()
                  .join(headed, "token").join(pure, "gid"))
    # (the larger component of a list need not be compared within itself)
    share = open_lists.groupBy("token", "gcomp").agg(F.count(F.lit(1)).alias("k"))
    major = share.groupBy("token").agg(F.max_by("gcomp", F.when(F.col("gcomp").isNull(), 0).otherwise(F.col("k"))).alias("major"),
                                       F.count(F.lit(1)).alias("kinds"), F.max(F.col("gcomp").isNull()).alias("unclear"))
    sides = open_lists.join(major.where("kinds > 1 or unclear"), "token")
    names = ("gid", "n", "pos", "members", "gcomp", "length")
    outside = _side(sides.where("gcomp is null or major is null or gcomp <> major"), "a_", *names)
    across = outside.join(_side(sides, "b_", "gid", "n", "pos", "members", "gcomp"), "token").where(
        (F.col("a_gid") != F.col("b_gid")) & ~F.coalesce(F.col("a_gcomp") == F.col("b_gcomp"), F.lit(False))
        & ((F.col("a_length") > SHORT_LIST) | (F.col("a_members") > 1) | (F.col("b_members") > 1)) & _close("a_", "b_"))
    met = _pairs(across, "a_gid", "b_gid")
    member = placed.select("gid", "vid", "comp")
    expanded = (met.join(member.toDF("u", "uv", "uc"), "u").join(member.toDF("v", "vv", "vc"), "v").where("uc <> vc")
                .select(F.least("uv", "vv").alias("u"), F.greatest("uv", "vv").alias("v")))
    mixed = member.join(pure.where("gcomp is null").select("gid"), "gid")
    within = (mixed.toDF("g", "u", "uc").join(mixed.toDF("g", "v", "vc"), "g").where("u < v and uc <> vc").select("u", "v"))
    met_again = kept(expanded.unionByName(within).distinct().join(met_first, ["u", "v"], "left_anti"), "pairs-2")
    again = kept(likely_pairs(met_again, of_group), "likely-2")
    if again.limit(1).count():
        more = linked_pairs(again, of_group, rows)
        stars = merged.where("id <> component_id").select(F.col("id").alias("a"), F.col("component_id").alias("b"))
        merged = components(stars.unionByName(more.select(F.col("u").alias("a"), F.col("v").alias("b"))), "cc-2")

    final = (of_group.join(merged.withColumnRenamed("id", "vid"), "vid", "left")
             .withColumn("comp", F.coalesce("component_id", "vid")).select("vid", "comp", "doc_id", "th", *key))
    for path in used:
        released(docs.sparkSession, path)
    return sets, final, sets_path


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Links join sets with 100 * common >= 80 * united. A null or empty text, or
    one without words, has an empty set and links with nothing. ``component_id``
    is the smallest doc_id reached; null ids count as the largest. Repeated
    rows each give a row; equal sets are linked, and are compared once.
    """
    sets, final, _ = _linked_sets(docs)
    key = ["fa", "fb", "n"]
    smallest = final.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_set = final.join(smallest, "comp").select(*key, "component_id")
    linked = sets.where("n > 0").join(by_set, key).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay when one document of each component is kept: the smallest (doc_id, text hash).

    A row is told by its doc_id and text, so of a doc_id that repeats with other
    texts each row goes with its own component. Null ids count as the largest.
    Rows that repeat a kept document wholly count as that document: one stays.
    Empty texts link with nothing and stay, one for each doc_id and text, all without an id.
    """
    _, final, sets_path = _linked_sets(docs)
    released(docs.sparkSession, sets_path)
    # private columns beside those of docs, whatever their names
    key, own = unused(docs.columns, "id", "th")
    kept = (final.groupBy("comp").agg(_smallest().alias("rep"))
            .select(F.struct("rep.doc_id").alias(key), F.col("rep.th").alias(own)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    empty = F.translate(text, " \t\n\r\x0b\x0c", "") == ""
    # a struct of nulls equals another in a join, a null does not
    keyed = docs.where(~empty).withColumns({key: F.struct(F.col("doc_id").cast("long").alias("doc_id")), own: F.xxhash64(text)})
    named = keyed.join(kept, [key, own], "left_semi").dropDuplicates([key, own, "text"]).select(*quoted(docs.columns))
    bare = docs.where(empty)
    return (named.unionByName(bare.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))
            .unionByName(bare.where("doc_id is null")))
