"""Divergence of sources within a language, by a frequent-pattern tree of term rows.

Each kept term of a language has a row: the sources that use it, in a fixed
order (most documents first), with their counts. A source's share of a term it
does not use is one number, so the divergence of two sources over all terms is
that of two sources without any term, corrected for the terms that one of them
uses, and again for the terms that both use.

The first correction needs the distinct counts of each source only. The second
goes over pairs of entries of a row: equal rows are one with a multiplicity, the
rows are sorted, and a task inserts its range of them into a prefix tree, where
rows that begin alike share nodes. Every node meets each of its ancestors once,
weighted by the rows that pass it. Tasks yield sums for pairs of sources; Spark
adds them. All numbers are whole, so nothing depends on order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Documents of a language that must hold a term, the unit of shares, and ranks of part ``term``.
LEAST_DOCS, UNIT, TOP_TERMS = 3, 10**9, 200
#: Distinct (source, term) that a task counts before it passes them on, and bytes of text cut at once.
HELD_TERMS, PIECE = 200_000, 1 << 20
#: Node-ancestor combinations that are computed at once.
COMBINATIONS = 500_000

#: Every byte that is no letter becomes a space; A-Z only become small.
_LETTERS = bytes(32 if c < 0x41 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if c <= 0x5A else c for c in range(256))


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, a bounded piece at a time."""
    raw = raw.translate(_LETTERS)
    at = 0
    while len(raw) - at > PIECE:
        end = raw.find(b" ", at + PIECE)
        if end < 0:
            break
        yield raw[at:end].split()
        at = end
    yield raw[at:].split() if at else raw.split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents of the source that hold the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, len(n)), pa.repeat(source, len(n)), pa.array(n.keys(), pa.binary()),
                         pa.array(n.values(), pa.int64()), pa.array([d[t] for t in n], pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])
            held.clear()

        met = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(k) for k in range(3))):
                n, d = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                met -= len(n)
                pieces = _pieces(text.as_py())
                first = next(pieces)
                n.update(first)
                own = set(first)
                for words in pieces:
                    n.update(words)
                    own.update(words)
                d.update(own)
                met += len(n)
                if met > HELD_TERMS:
                    yield from passed_on()
                    met = 0
        yield from passed_on()

    named = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    return named.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def share(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / total), exact for counts of any size."""
    wide = F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", wide, total.cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most UNIT + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return ((apart * apart).view(np.uint64) // q.view(np.uint64)).view(np.int64)  # unsigned division needs no floor


def common_starts(lang: np.ndarray, start: np.ndarray, size: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """For each sorted row, how many entries it begins with like the row before."""
    out = np.zeros(len(size), np.int64)
    alive = np.flatnonzero(lang[1:] == lang[:-1]) + 1
    depth = 0
    while len(alive):
        alive = alive[(size[alive] > depth) & (size[alive - 1] > depth)]
        here, there = start[alive] + depth, start[alive - 1] + depth
        alive = alive[np.logical_and.reduce([v[here] == v[there] for v in values])] if len(alive) else alive
        out[alive] += 1
        depth += 1
    return out


def tree_corrections(lang: np.ndarray, start: np.ndarray, size: np.ndarray, times: np.ndarray, source: np.ndarray,
                     count: np.ndarray, p: np.ndarray, base: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(lang, source, other, correction) for every node of the rows' prefix tree and each of its ancestors, both ways.

    Rows are sorted; row r has the entries start[r] to start[r] + size[r] and stands for times[r] terms.
    """
    like = common_starts(lang, start, size, source, count)
    passed = np.concatenate(([0], np.cumsum(times)))
    for depth in range(1, int(size.max(initial=0))):
        opens = np.flatnonzero(like <= depth)  # a node at this depth ends where the next row that leaves it begins
        ends = np.append(opens[1:], len(size))
        new = size[opens] > depth
        rows, weight = opens[new], passed[ends[new]] - passed[opens[new]]
        for at in range(0, len(rows), max(1, COMBINATIONS // depth)):
            r, w = rows[at:at + max(1, COMBINATIONS // depth)], weight[at:at + max(1, COMBINATIONS // depth), None]
            node, up = (start[r] + depth)[:, None], start[r][:, None] + np.arange(depth)
            a, x, b, y = p[up], base[up], p[node], base[node]
            to = (_distance(a, b) - _distance(a, y) - _distance(x, b) + _distance(x, y)) * w
            back = (_distance(b, a) - _distance(b, x) - _distance(y, a) + _distance(y, x)) * w
            g, h, of = source[up].ravel(), np.repeat(source[node[:, 0]], depth), np.repeat(lang[r], depth)
            yield of, g, h, to.ravel()
            yield of, h, g, back.ravel()


def pair_corrections(patterns: DataFrame) -> DataFrame:
    """(lang, g, h, value) sums over the terms that both sources use. ``patterns``: (lang, items, times)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            items = batch.column(1)
            size = items.value_lengths().to_numpy().astype(np.int64)
            flat = items.flatten()
            source, count, p, base = (flat.field(k).to_numpy().astype(np.int64) for k in range(4))
            wide = int(source.max(initial=0)) + 1
            keys, totals = np.zeros(0, np.int64), np.zeros(0, np.int64)  # (lang, g, h) met so far, ascending, and their sums
            for lang, g, h, value in tree_corrections(langs.indices.to_numpy().astype(np.int64), np.cumsum(size) - size, size,
                                                      batch.column(2).to_numpy(), source, count, p, base):
                key = (lang * wide + g) * wide + h
                order = np.argsort(key, kind="stable")
                key = key[order]
                first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                keys, place = np.unique(np.concatenate((keys, key[first])), return_inverse=True)
                more = np.concatenate((totals, np.add.reduceat(value[order], first)))
                totals = np.zeros(len(keys), np.int64)
                np.add.at(totals, place, more)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(keys // wide // wide)), pa.array(keys // wide % wide), pa.array(keys % wide), pa.array(totals)],
                names=["lang", "g", "h", "value"])

    return patterns.select("lang", "items", "times").mapInArrow(run, "lang string, g long, h long, value long")


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of lang and source.

    Part ``pair``: every other source of the language, all ranks; part ``term``:
    the terms that the group uses more than its language does, to ``top_terms``.
    Null text, lang and source count as ''. Groups without terms have pairs too;
    a language without kept terms has pairs of value 0. A lone source has no
    pairs. Every row counts, repeated ones too, whatever its doc_id; other
    columns are not read. An empty table gives no rows.
    """
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    # sources get a number in their language, the most frequent first: the order of the tree
    by_size = Window.partitionBy("lang").orderBy(F.desc("n"), "source")
    groups = staged(plain.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
                    .select("lang", "source", (F.row_number().over(by_size) - 1).alias("o")), "divergence-groups")
    counted = (term_counts(plain).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
               .join(groups, ["lang", "source"]))
    terms = staged(counted.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("o", "n")).alias("items"))
        .where(F.col("docs") >= least_docs)
        .select("lang", F.col("term").cast("string").alias("term"), "n", F.array_sort("items").alias("items")), "divergence-terms")

    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n"))
    used = (terms.select("lang", F.explode("items").alias("i")).groupBy("lang", F.col("i.o").alias("o")).agg(F.sum("i.n").alias("used")))
    sizes = staged(groups.join(used, ["lang", "o"], "left").join(langs, "lang", "left").select(
        "lang", "source", "o", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("n", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("all"),
        (F.coalesce("used", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("total")), "divergence-sizes")
    bases = sizes.where("v > 0").withColumn("base", share(F.lit(0), F.col("total")))
    of_lang = bases.groupBy("lang").agg(F.first("all").alias("all"), F.array_sort(F.collect_list(F.struct("o", "total", "base"))).alias("sizes"))

    # terms that both of two sources use: nodes and ancestors of the tree
    patterns = staged(terms.groupBy("lang", "items").agg(F.count(F.lit(1)).alias("times")).join(of_lang, "lang").select(
        "lang", "times", F.transform("items", lambda i: F.struct(
            i["o"].alias("o"), i["n"].alias("n"), share(i["n"], F.col("sizes")[i["o"]]["total"]).alias("p"),
            F.col("sizes")[i["o"]]["base"].alias("base"))).alias("items")), "divergence-patterns")
    # rows that begin alike come together; a hash divides those that share their first three entries
    near = patterns.repartitionByRange("lang", *[F.get("items", F.lit(k))[c] for k in range(3) for c in ("o", "n")], F.xxhash64("items"))
    both = pair_corrections(near.sortWithinPartitions("lang", "items"))

    # terms that one of two sources uses: its distinct counts against the other's base
    levels = (patterns.select("lang", "times", F.explode("items").alias("i"))
              .groupBy("lang", F.col("i.o").alias("g"), F.col("i.p").alias("p"), F.col("i.base").alias("b")).agg(F.sum("times").alias("times")))
    other = bases.select("lang", F.col("o").alias("h"), F.col("base").alias("c"))
    p, b, c, times = (F.col(x) for x in ("p", "b", "c", "times"))
    met = levels.join(other, "lang").where("g <> h").select("lang", "g", "h", F.inline(F.array(
        F.struct(F.lit(False).alias("turned"), (times * (distance(p, c) - distance(b, c))).alias("value")),
        F.struct(F.lit(True).alias("turned"), (times * (distance(c, p) - distance(c, b))).alias("value")))))
    one = met.select("lang", F.when(F.col("turned"), F.col("h")).otherwise(F.col("g")).cast("long").alias("g"),
                     F.when(F.col("turned"), F.col("g")).otherwise(F.col("h")).cast("long").alias("h"), "value")

    # and every pair as if it used no term
    ends = sizes.select("lang", F.col("o").cast("long").alias("o"), "v", "total")
    bare = ends.toDF("lang", "g", "v", "tg").join(ends.drop("v").toDF("lang", "h", "th"), "lang").where("g <> h").select(
        "lang", "g", "h", F.when(F.col("v") == 0, F.lit(0)).otherwise(
            F.col("v") * distance(share(F.lit(0), F.col("tg")), share(F.lit(0), F.col("th")))).cast("long").alias("value"))
    summed = (bare.unionByName(one).unionByName(both).groupBy("lang", "g", "h")
              .agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")))
    names = sizes.select("lang", F.col("o").cast("long").alias("o"), "source")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (summed.join(names.toDF("lang", "g", "source"), ["lang", "g"]).join(names.toDF("lang", "h", "item"), ["lang", "h"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank")))

    q, mine = F.col("q"), F.col("mine")
    shares = (terms.join(of_lang, "lang").select("lang", "term", share(F.col("n"), F.col("all")).alias("q"), F.explode(F.transform(
        "items", lambda i: F.struct(i["o"].alias("o"), share(i["n"], F.col("sizes")[i["o"]]["total"]).alias("p")))).alias("i"))
        .select("lang", "term", "q", F.col("i.o").alias("o"), F.col("i.p").alias("mine")).where("mine > q"))
    ranked = (shares.select("lang", "o", "term", distance(mine, q).alias("value"))
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "o").orderBy(F.desc("value"), "term")))
              .where(F.col("rank") <= top_terms))
    top = ranked.join(sizes.select("lang", "o", "source"), ["lang", "o"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(top)


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
vocabulary AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM kept GROUP BY lang),
used AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN kept k USING (lang, term) GROUP BY lang, source, term),
groups AS MATERIALIZED (SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(u.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN vocabulary v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS n FROM used GROUP BY lang, source) u USING (lang, source)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
    CAST(1 + (1000000000 * (coalesce(u.n, 0) + 1)::HUGEINT) // (g.n + g.v) AS BIGINT) AS p,
    CAST(1 + (1000000000 * (k.n + 1)::HUGEINT) // (o.n + o.v) AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN vocabulary o USING (lang) LEFT JOIN used u USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(f.f, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS f
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, term) AS INTEGER) AS rank
  FROM p WHERE n > 0 AND p > q) WHERE rank <= 200
"""
