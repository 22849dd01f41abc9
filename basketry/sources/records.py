"""Records of delimited files, found by many tasks at once.

A file is read in splits, line by line. Whether a line begins inside a quoted
field depends on everything before it in the file, so nothing is assumed at
first: every line is a function from the state it begins in (outside or inside
quotes) to the state it ends in. Such functions compose, and composing them is
associative. A first pass composes the lines of each split (one row a split); a
prefix over the splits of a file, in the order of their offsets, then gives each
split the state it really begins in, the records before it in its file, and, by
a prefix over the files, in the whole table. A second pass reads the lines again
and knows for each whether it begins a record, and that record's number.

Records of one line, nearly all, go on as they are. Only the lines of records
with quoted newlines are brought together, by the record's number.

A table where every line that begins outside quotes also ends there needs none of
that. One aggregate by split tells so (``one_line_splits``), and its lines are the
records: they need no tasks in Python, or for their numbers only a running count.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.errors import SourceError
from basketry.session import materialize

#: Splits whose starts are worked out on the driver and sent with the second pass; more are joined to it.
MANY_SPLITS = 20_000
#: A line's function by (state after outside) + 2 * (state after inside).
ALWAYS_OUT, SWAPS, KEEPS, ALWAYS_IN = 0, 1, 2, 3
SPLIT = ["file", "block"]
#: Encodings whose text Spark's own functions read; others are decoded in the tasks.
NATIVE = {"utf-8": None, "ascii": None, "iso8859-1": "ISO-8859-1"}


def codec(encoding: str) -> str:
    """Python's name of an encoding; one whose line ends are not single bytes is refused."""
    try:
        name = codecs.lookup(encoding).name
    except LookupError:
        raise SourceError("encoding", encoding, "unknown encoding") from None
    if "\n,\"".encode(name)[-3:] != b"\n,\"":
        raise SourceError("encoding", encoding, "line ends are not single bytes: convert the file to utf-8")
    return name


def _patterns(sep: str) -> tuple[str, str, str]:
    """Regular expressions of a field, of a line that begins and ends outside quotes, and of one that begins inside and ends outside."""
    s = "\\x{%x}" % ord(sep)
    quoted = '[^"]*+(?:""[^"]*+)*+"' + f"[^{s}]*+"
    one = f'(?:"{quoted}|(?!")[^{s}]*+)'
    return one, f"(?s)^{one}(?:{s}{one})*+$", f"(?s)^{quoted}(?:{s}{one})*+$"


def line_function(line: Column, sep: str) -> Column:
    """The code of a line's function on the state; a line without quotes keeps it."""
    _, plain, closing = _patterns(sep)
    return F.when(~line.contains('"'), F.lit(KEEPS)).otherwise(
        (~line.rlike(plain)).cast("int") + 2 * (~line.rlike(closing)).cast("int"))


def _states(codes: np.ndarray, state: int) -> np.ndarray:
    """State after each line, the first one beginning in ``state``."""
    flips = np.cumsum(codes == SWAPS)
    at = np.maximum.accumulate(np.where((codes == ALWAYS_OUT) | (codes == ALWAYS_IN), np.arange(len(codes)), -1))
    known = at >= 0
    return np.where(known, (codes[at] == ALWAYS_IN) ^ ((flips - flips[at]) & 1), state ^ (flips & 1)).astype(np.int8)


#: What a split begins with: its state, the records of its file before it, and the rows of files before.
Starts = dict[tuple[int, int], tuple[int, int, int]]


def _filled(sep: str) -> str:
    """Regular expression found in any line that is not blank."""
    return "[^" + "".join(r for c, r in ((" ", " "), ("\t", "\\t"), ("\r", "\\r")) if c != sep) + "]"


def _invalid(charset: str) -> Column:
    """Whether a line's bytes are invalid in UTF-8, or in ASCII."""
    return ~F.is_valid_utf8("value") if charset == "utf-8" else F.col("value").rlike("[^\\x00-\\x7f]")


def _split_lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Every line with its split."""
    # no line that begins with a sign beyond the blank is blank
    blank = (F.col("value") < "!") & ~F.col("value").rlike(_filled(sep))
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), blank.alias("blank"))


def one_line_splits(spark: SparkSession, path: str, sep: str, charset: str, multi_line: bool) -> tuple[list[dict], str] | None:
    """The splits' sums and the header, if no record of the table has several lines; else None.

    For bytes that are UTF-8 or ASCII, files that all begin with the same header line
    and don't repeat it, and a number of splits that the driver may hold.
    """
    if charset not in ("utf-8", "ascii"):
        return None
    lines = _split_lines(spark, path, sep)
    head = lines.where(~F.col("blank")).select("value").head()
    if head is None or head[0].startswith("\ufeff"):
        return None
    is_head = F.col("value") == head[0]
    opens = F.col("value").contains('"') & ~F.col("value").rlike(_patterns(sep)[1]) if multi_line else F.lit(False)
    # a split is read by one task, in order: the least id is that of its first line
    sums = (lines.withColumn("id", F.monotonically_increasing_id()).groupBy("path", "block").agg(
        F.count_if(~F.col("blank")).alias("n0"), F.count_if(_invalid(charset)).alias("invalid"), F.count_if(opens).alias("opens"),
        F.count_if(is_head).alias("heads"), F.min(F.when(~F.col("blank"), F.col("id"))).alias("first"), F.min(F.when(is_head, F.col("id"))).alias("head_at"))
        .select(F.xxhash64("path").alias("file"), "*").limit(MANY_SPLITS + 1).collect())
    begins = {r["file"] for r in sums if r["block"] == 0 and r["heads"] == 1 and r["first"] == r["head_at"]}
    if len(sums) > MANY_SPLITS or any(r["opens"] or r["file"] not in begins or (r["block"] and r["heads"]) for r in sums):
        return None
    return [r.asDict() | {"pieces0": 0, "to0": 0, "head": head[0]} for r in sums], head[0]


def _numbered(lines: DataFrame, starts_of: Starts) -> DataFrame:
    """Records of one line each with their numbers, without headers; ``lines`` has the splits' lines that are not blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, begun = None, 0
        for batch in batches:
            file, block = (batch.column(c).to_numpy() for c in SPLIT)
            edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(file)]):
                if b == a:
                    continue
                if split != (file[a], block[a]):
                    split, begun = (file[a], block[a]), 0
                _, past, rows = starts_of[int(file[a]), int(block[a])]
                number = np.arange(past + begun + 1, past + begun + b - a + 1)
                begun += b - a
                skip = int(number[0] == 1)
                yield pa.RecordBatch.from_arrays([batch.column("value").slice(a + skip, b - a - skip), pa.array(rows + number[skip:] - 2)],
                                                 names=["record", "_seq"])

    return lines.select(F.xxhash64("path").alias("file"), "block", F.col("value").cast("binary").alias("value")) \
        .mapInArrow(run, "record binary, _seq long").select(F.col("record").cast("string").alias("record"), "_seq")


def _tagged(spark: SparkSession, path: str, sep: str, encoding: str, multi_line: bool, with_text: bool,
            starts_of: Starts | None = None) -> DataFrame:
    """Every line with its split, place in it, and for both states that the split may begin in (0, 1):
    the state before and after the line and the records begun so far. With ``starts_of`` only the
    lines of records, under the state that their split does begin in. Without text one row for each
    batch of a split's lines: their last state and records begun, the lines of records of several
    lines, the invalid ones and the header's text."""
    charset = codec(encoding)
    native = charset in NATIVE
    raw = spark.read.option("lineSep", "\n").text(path)
    as_utf8 = F.decode(F.col("value").cast("binary"), NATIVE[charset]) if NATIVE.get(charset) else F.col("value")
    line = F.when(F.col("at_start") & as_utf8.startswith("﻿"), F.substring(as_utf8, 2, 2**31 - 1)).otherwise(as_utf8) \
        if charset == "utf-8" else as_utf8
    valid = ~_invalid(charset) if charset in ("utf-8", "ascii") else F.lit(True)
    lines = raw.select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")).select(
        F.xxhash64("path").alias("file"), "block", "path", "value", valid.alias("valid"), (~F.col("value").rlike(_filled(sep))).alias("blank"),
        (line_function(F.col("value"), sep) if multi_line else F.lit(KEEPS)).alias("code"), (F.col("block") == 0).alias("at_start"))
    lines = lines.select("file", "block", "path", (line if native else F.col("value").cast("binary")).cast("binary").alias("line"),
                         "valid", "blank", "code")

    summed = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("path", pa.string()), ("k", pa.int64()), ("to0", pa.int8()), ("to1", pa.int8()),
                        ("n0", pa.int64()), ("n1", pa.int64()), ("pieces0", pa.int64()), ("pieces1", pa.int64()), ("invalid", pa.int64()),
                        ("head", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, begun, k = None, [0, 1], [0, 0], 0
        for batch in batches:
            file, block, codes = (batch.column(c).to_numpy() for c in ("file", "block", "code"))
            blank = batch.column("blank").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            text, valid = batch.column("line"), batch.column("valid")
            if not with_text and not native:
                text, valid = _decoded(text, charset)
            before, after, count, place, of, sums = [], [], [], [], [], []
            for a, b in zip([0, *edges], [*edges, len(file)]):
                if b == a:
                    continue
                if split != (file[a], block[a]):
                    split, state, begun, k = (file[a], block[a]), [0, 1], [0, 0], 0
                ends = [_states(codes[a:b], s) for s in state]
                starts = [np.concatenate(([s], e[:-1])).astype(np.int8) for s, e in zip(state, ends)]
                counts = [n + np.cumsum((s == 0) & ~blank[a:b]) for n, s in zip(begun, starts)]
                before.append(starts)
                after.append(ends)
                count.append(counts)
                place.append(np.arange(k, k + b - a))
                if not with_text:
                    head = np.flatnonzero((counts[0] == 1) & ~(blank[a:b] & (starts[0] == 0))) if split[1] == 0 else []
                    lines_of = [text[a + int(i)].as_py() for i in head]
                    sums.append((int(file[a]), int(block[a]), batch.column("path")[a].as_py(), k + b - a - 1, int(ends[0][-1]), int(ends[1][-1]),
                                 int(counts[0][-1]), int(counts[1][-1]), *[int(((s != 0) | (e != 0)).sum()) for s, e in zip(starts, ends)],
                                 b - a - int(pa.compute.sum(valid[a:b]).as_py() or 0), b"\n".join(lines_of) if lines_of else None))
                if starts_of is not None:
                    real, past, rows = starts_of[int(file[a]), int(block[a])]
                    of.append((starts[real], ends[real], counts[real] + past, np.full(b - a, rows)))
                state, begun, k = [int(e[-1]) for e in ends], [int(c[-1]) for c in counts], k + b - a
            if not place:
                continue
            if not with_text:
                yield pa.RecordBatch.from_pylist([dict(zip(summed.names, one)) for one in sums], summed)
                continue
            if starts_of is not None:
                was, becomes, number, rows = (np.concatenate(x) for x in zip(*of))
                keep = pa.array((number > 1) & ~((was == 0) & blank))
                text = batch.column("line") if native else _decoded(batch.column("line"), charset)[0]
                out = [batch.column("file"), batch.column("block"), pa.array(np.concatenate(place)), text, pa.array(was), pa.array(becomes),
                       pa.array(number), pa.array(rows)]
                yield pa.RecordBatch.from_arrays([x.filter(keep) for x in out], names=["file", "block", "k", "line", "from", "to", "number", "earlier"])
                continue
            both = [np.concatenate([x[s] for x in group]) for group in (before, after, count) for s in (0, 1)]
            if not native:
                text, valid = _decoded(text, charset)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.nulls(len(file), pa.string()), text, valid, batch.column("blank"), pa.array(np.concatenate(place)), *map(pa.array, both)],
                names=["file", "block", "path", "line", "valid", "blank", "k", "from0", "from1", "to0", "to1", "n0", "n1"])

    if with_text:
        lines = lines.withColumn("path", F.lit(None).cast("string"))
    if starts_of is not None:
        return lines.mapInArrow(run, "file long, block long, k long, line binary, from byte, to byte, number long, earlier long")
    if not with_text:
        return lines.mapInArrow(run, "file long, block long, path string, k long, to0 byte, to1 byte, n0 long, n1 long, "
                                     "pieces0 long, pieces1 long, invalid long, head binary")
    return lines.mapInArrow(run, "file long, block long, path string, line binary, valid boolean, blank boolean, k long, "
                                 "from0 byte, from1 byte, to0 byte, to1 byte, n0 long, n1 long")


def _decoded(lines: pa.Array, charset: str) -> tuple[pa.Array, pa.Array]:
    text, valid = [], []
    for raw in lines.to_pylist():
        try:
            text.append(raw.decode(charset).encode())
            valid.append(True)
        except UnicodeDecodeError:
            text.append(b"")
            valid.append(False)
    return pa.array(text, pa.binary()), pa.array(valid, pa.bool_())


def split_starts(splits: DataFrame) -> DataFrame:
    """For each split: the state it begins in, and the records begun before it in its file and in files before.

    ``splits``: (file, block, path, to0, to1, n0, n1, pieces0, pieces1). Files are ordered by path
    with numbers as numbers, so ``orders_10.csv`` comes after ``orders_9.csv``.
    """
    padded = F.regexp_replace("path", "([0-9]+)", "0" * 20 + "$1")
    order = Window.partitionBy("file").orderBy("block")
    upto, past = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    code = F.col("to0") + 2 * F.col("to1")
    turned = (splits.withColumn("code", code).withColumn("flips", F.sum((F.col("code") == SWAPS).cast("int")).over(upto))
              .withColumn("known", F.last(F.when(F.col("code").isin(ALWAYS_OUT, ALWAYS_IN), F.struct("code", "flips")), True).over(past))
              .withColumn("flipped", F.coalesce(F.lag("flips").over(order), F.lit(0))))
    state = F.when(F.col("known").isNull(), F.col("flipped") % 2).otherwise(
        ((F.col("known.code") == ALWAYS_IN).cast("int") + F.col("flipped") - F.col("known.flips")) % 2)
    def of(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(name + "0")).otherwise(F.col(name + "1"))

    placed = (turned.withColumn("state", state).withColumn("records", of("n"))
              .withColumn("before", F.coalesce(F.sum("records").over(past), F.lit(0)))
              .withColumn("pieces", of("pieces")).withColumn("ends", of("to"))
              .withColumn("name", F.regexp_replace(padded, "0+([0-9]{20,})", "$1")))
    # rows of a file: its records without the header
    files = placed.groupBy("file").agg(F.min("name").alias("name"), (F.sum("records") - 1).alias("rows"))
    earlier = Window.orderBy("name", "file").rowsBetween(Window.unboundedPreceding, -1)
    rows = files.select("file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("earlier"))
    return placed.join(rows, "file").select(*SPLIT, "state", "before", "earlier", "records", "pieces", "ends", "head", "invalid", "path")


def _worked_out(splits: list) -> tuple[Starts, dict, list[str]]:
    """``split_starts`` for a bounded number of splits, with the facts and headers that the checks need."""
    def natural(path: str) -> str:
        return re.sub("[0-9]+", lambda m: m[0].lstrip("0").rjust(20, "0"), path)

    files: dict[int, list] = {}
    for r in sorted(splits, key=lambda r: r["block"]):
        files.setdefault(r["file"], []).append(r)
    starts: Starts = {}
    facts = {"files": len(files), "open": None, "invalid": 0, "pieces": 0}
    earlier, heads = 0, set()
    for file, own in sorted(files.items(), key=lambda f: (natural(f[1][0]["path"]), f[0])):
        state = before = 0
        for r in own:
            starts[file, r["block"]] = (state, before, earlier)
            before += r[f"n{state}"]
            facts["pieces"] += r[f"pieces{state}"]
            facts["invalid"] += r["invalid"]
            state = r[f"to{state}"]
        if state:
            facts["open"] = min(filter(None, (facts["open"], own[0]["path"])))
        if own[0]["block"] == 0:
            heads.add(own[0]["head"].removesuffix("\r"))
        earlier += before - 1
    return starts, facts, sorted(heads)[:2]


@dataclass(frozen=True)
class Records:
    """Records of a table's files: ``rows`` has (record, _seq); headers apart."""

    rows: DataFrame
    names: list[str]


def column_names(header: str, sep: str) -> list[str]:
    """Names in a header record; an empty one is numbered, a repeated one gets the next free suffix, as in pandas."""
    cells = next(csv.reader(io.StringIO(header, newline=""), delimiter=sep), [])
    cells = [c if c else f"Unnamed: {k}" for k, c in enumerate(cells)]
    out: list[str] = []
    for c in cells:
        name, k = c, 0
        while name in out or (k and name in cells):
            k += 1
            name = f"{c}.{k}"
        out.append(name)
    return out


def read_records(spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8", multi_line: bool = True,
                 validate: bool = True, numbered: bool = True) -> Records:
    """Records of all files at ``path``, without headers, each with its number in the table (``numbered=False``: may be NULL).

    White-space-only lines outside quotes are no records. Raises ``SourceError``
    for no lines at all, differing headers, a quote that is never closed, and
    (with ``validate``) bytes that are invalid in the encoding.
    """
    if len(sep) != 1:
        raise ValueError("sep must be one character")
    quick = one_line_splits(spark, path, sep, codec(encoding), multi_line)
    if quick is not None:
        starts_of, facts, heads = _worked_out(quick[0])
        if validate and facts["invalid"]:
            raise SourceError("encoding", path, f"{facts['invalid']} rows are not valid {encoding}")
        lines = _split_lines(spark, path, sep).where(~F.col("blank"))
        rows = _numbered(lines, starts_of) if numbered else lines.where(F.col("value") != quick[1]).select(
            F.col("value").alias("record"), F.lit(None).cast("bigint").alias("_seq"))
        return Records(_bare(rows), column_names(heads[0], sep))
    first = _tagged(spark, path, sep, encoding, multi_line, with_text=False)
    head = F.when(F.col("head").isNotNull(), F.struct("k", "head"))
    splits = first.groupBy(*SPLIT).agg(
        F.min("path").alias("path"), F.max_by("to0", "k").alias("to0"), F.max_by("to1", "k").alias("to1"),
        F.max("n0").alias("n0"), F.max("n1").alias("n1"), F.sum("pieces0").alias("pieces0"), F.sum("pieces1").alias("pieces1"),
        F.sum("invalid").alias("invalid"),
        F.array_join(F.transform(F.array_sort(F.collect_list(head)), lambda x: x["head"].cast("string")), "\n").alias("head"))
    known = splits.limit(MANY_SPLITS + 1).collect()
    starts, starts_of = None, None
    if len(known) <= MANY_SPLITS:
        starts_of, facts, heads = _worked_out(known)
    else:
        starts = materialize(split_starts(splits))
        last = F.max_by("ends", "block")
        facts = (starts.groupBy("file").agg(last.alias("open"), F.min("path").alias("path"), F.sum("invalid").alias("invalid"), F.sum("pieces").alias("pieces"))
                 .agg(F.count(F.lit(1)).alias("files"), F.min(F.when(F.col("open") == 1, F.col("path"))).alias("open"),
                      F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid"), F.coalesce(F.sum("pieces"), F.lit(0)).alias("pieces")).first().asDict())
        heads = [r["head"] for r in starts.where("block = 0").select(F.regexp_replace("head", "\r$", "").alias("head")).distinct().limit(2).collect()]
    if not facts["files"] or not heads or heads == [""]:
        raise SourceError("layout", path, "empty file, no columns")
    if validate and facts["invalid"]:
        raise SourceError("encoding", path, f"{facts['invalid']} rows are not valid {encoding}")
    if facts["open"]:
        raise SourceError("layout", facts["open"], "a quote is never closed")
    if len(heads) > 1:
        raise SourceError("layout", path, "the files' headers differ")

    def of(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(name + "0")).otherwise(F.col(name + "1"))

    def second() -> DataFrame:
        if starts_of is not None:
            return _tagged(spark, path, sep, encoding, multi_line, True, starts_of)
        lines = _tagged(spark, path, sep, encoding, multi_line, with_text=True).join(starts.select(*SPLIT, "state", "before", "earlier"), SPLIT)
        return lines.select("file", "block", "k", "line", "blank", of("from").alias("from"), of("to").alias("to"),
                            (F.col("before") + of("n")).alias("number"), "earlier").where("number > 1 and not (`from` = 0 and blank)")

    whole = (F.col("from") == 0) & (F.col("to") == 0)
    seq = (F.col("earlier") + F.col("number") - 2).alias("_seq")
    rows = second().where(whole).select(F.col("line").cast("string").alias("record"), seq)
    if facts["pieces"]:  # lines of records with quoted newlines
        parts = (second().where(~whole).groupBy("earlier", "number")
                 .agg(F.array_sort(F.collect_list(F.struct("block", "k", "line"))).alias("lines")))
        rows = rows.unionByName(parts.select(
            F.array_join(F.transform("lines", lambda x: x["line"].cast("string")), "\n").alias("record"), seq))
    return Records(_bare(rows), column_names(heads[0], sep))


def _bare(rows: DataFrame) -> DataFrame:
    """Records without the carriage return at their end."""
    bare = F.when(F.col("record").contains("\r"), F.regexp_replace("record", "\r$", "")).otherwise(F.col("record"))
    return rows.select(bare.alias("record"), "_seq")


def fields(record: Column, sep: str) -> Column:
    """Fields of a record, unquoted; what follows a closing quote up to the separator stays, as in pandas."""
    one, _, _ = _patterns(sep)
    s = "\\x{%x}" % ord(sep)
    # a pattern of one character, escaped if need be, is split at without a regular expression
    plain = "\\" + sep if sep in ".$|()[{^?*+\\" else sep
    raw = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(f"(?s){s}({one})"), F.lit(1))
    inner = '(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'

    def unquoted(x: Column) -> Column:
        return F.when(x.startswith('"'), F.concat(F.replace(F.regexp_extract(x, inner, 1), F.lit('""'), F.lit('"')), F.regexp_extract(x, inner, 2))).otherwise(x)

    return F.when(record.contains('"'), F.transform(raw, unquoted)).otherwise(F.split(record, plain, -1))
