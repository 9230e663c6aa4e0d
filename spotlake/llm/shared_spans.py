"""Long exact spans shared between records (problem 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.session import cut, measured

#: Letters in a row that make a shared span.
LEAST = 40
#: Letters of the anchor that names a suffix's group: the least-hashed ones among the first LEAST letters.
ANCHOR = 24
#: Suffixes of heavy anchors are followed to this depth; longer repeats join from overlapping spans.
DEPTH = 64
#: Lengths of the prefixes that split the suffixes of heavy anchors, before LEAST; a group of more than GROUP suffixes is split by the next length.
PREFIXES = (12, 24)
#: Suffixes that one subtree may have (about 200 bytes each while it is built).
GROUP = 400_000
#: Letters of which anchors are looked for at a time (or one sequence).
LETTERS_AT_ONCE = 1 << 20
#: Odd multipliers of the hashes.
_STEP, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def anchor_runs(letters: np.ndarray, sizes: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of sequences one after another (code points and lengths): sequence, first, last and anchor hash of every run of windows of *least* letters with one anchor.

    A window's anchor is the least hash of *anchor* letters in it, so equal windows have equal anchors wherever they stand.
    """
    n, width = len(letters) - least + 1, least - anchor + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none, none
    h = np.zeros(len(letters) - anchor + 1, np.uint64)
    for k in range(anchor):
        h = h * _STEP + letters[k : k + len(h)].astype(np.uint64) + np.uint64(1)
    h = (h ^ (h >> np.uint64(29))) * _TURN
    h ^= h >> np.uint64(32)
    low = h[:n].copy()
    for k in range(1, width):
        np.minimum(low, h[k : k + n], out=low)
    start = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(sizes)), sizes)[:n]
    pos = np.arange(n) - start[of]
    good = pos <= sizes[of] - least
    of, pos, low = of[good], pos[good], low[good]
    if not len(of):
        return none, none, none, none
    new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (low[1:] != low[:-1])])
    last = pos[np.r_[new[1:], len(pos)] - 1]
    return of[new], pos[new], last, low[new].view(np.int64)


def _anchored(least: int, anchor: int, with_text: bool):
    """Over batches of (lo, hi, seq_id, seq): the runs of windows as (anchor, lo, hi) or with seq_id, first and the text from the first window to the end of the last."""

    def chunk(ids: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        of, first, last, h = anchor_runs(letters, np.array([len(t) for t in texts], np.int64), least, anchor)
        row = pa.array(of)
        lo, hi = ids.column("lo").take(row), ids.column("hi").take(row)
        if not with_text:
            return pa.RecordBatch.from_arrays([pa.array(h), lo, hi], ["anchor", "lo", "hi"])
        cut_out = pa.array([texts[i][a : b + least] for i, a, b in zip(of.tolist(), first.tolist(), last.tolist())], pa.string())
        return pa.RecordBatch.from_arrays([pa.array(h), lo, hi, ids.column("seq_id").take(row), pa.array(first.astype(np.int32)), cut_out], ["anchor", "lo", "hi", "seq_id", "first", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("seq").to_pylist()
            sizes = np.cumsum([len(t) for t in texts])
            group = sizes // LETTERS_AT_ONCE
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(texts)]
            for i, j in zip(cuts, cuts[1:]):
                if j > i:
                    yield chunk(b.slice(i, j - i), texts[i:j])

    return run


def _suffixes(runs: DataFrame, least: int, depth: int) -> DataFrame:
    """seq_id, lo, hi, pos, suffix: every suffix of the runs' texts with at least *least* letters, followed to *depth* letters."""
    at = F.explode(F.sequence(F.lit(0), F.length("text") - least)).alias("at")
    return runs.select("seq_id", "lo", "hi", "first", "text", at).select("seq_id", "lo", "hi", (F.col("first") + F.col("at")).alias("pos"), F.substring(F.col("text"), F.col("at") + 1, F.lit(depth)).alias("suffix"))


def _head(n: int) -> Column:
    return F.substring("suffix", 1, n)


def split_by_prefix(suffixes: DataFrame, lengths: tuple[int, ...], group: int) -> tuple[DataFrame, DataFrame | None]:
    """Suffixes with the ``prefix`` that names their group, and the groups that the longest prefix can't split.

    Each length in turn counts its groups with map-side combining; only the suffixes of too large groups go on to the next
    length, so prefixes are of varying length and no prefix begins another. The groups left over at the last length are
    returned apart as (node, lo, hi), the least and the largest id under them; their suffixes have a null prefix.
    """
    out = suffixes.withColumn("prefix", _head(lengths[0]))
    left = suffixes
    for n, longer in zip(lengths, [*lengths[1:], None]):
        heavy = cut(left.groupBy(_head(n).alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("node_lo"), F.max("hi").alias("node_hi")).filter(F.col("n") > group))
        if heavy.isEmpty():
            return out, None
        if longer is None:
            out = out.join(measured(heavy.select("node")), F.col("prefix") == F.col("node"), "left")
            return out.withColumn("prefix", F.when(F.col("node").isNull(), F.col("prefix"))).drop("node"), heavy.drop("n")
        nodes = measured(heavy.select("node"))
        left = left.join(nodes, _head(n) == F.col("node"), "left_semi")
        out = out.join(nodes, F.col("prefix") == F.col("node"), "left").withColumn("prefix", F.when(F.col("node").isNotNull(), _head(longer)).otherwise(F.col("prefix"))).drop("node")
    raise AssertionError


def _common(letters: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of a letter matrix with the row before (0 pads and never matches)."""
    same = (letters[1:] == letters[:-1]) & (letters[1:] != 0)
    return np.where(same.all(1), letters.shape[1], np.argmin(same, axis=1))


def _before(lo: np.ndarray, hi: np.ndarray, step: np.ndarray, least: int) -> np.ndarray:
    """Depth of the node of each leaf and the nearest leaf before it that another record has, 0 if it is less than *least* deep."""
    full = np.r_[0, step]
    single = lo == hi
    own = np.r_[False, single[1:] & single[:-1] & (lo[1:] == lo[:-1])]  # the leaf before is of the same record
    depth = np.where(own | (full < least), 0, full)
    for i in np.flatnonzero(own & (full >= least)):  # repeats inside one record
        depth[i] = min(depth[i - 1], full[i])
    return np.where(depth >= least, depth, 0)


def deep_leaves(lo: np.ndarray, hi: np.ndarray, letters: np.ndarray, least: int = LEAST) -> np.ndarray:
    """For sorted suffixes: the depth of each leaf's deepest inner node that also has a leaf of another record, 0 if under *least*.

    Suffixes in order, with the common prefixes of neighbours, are the leaves of the suffix tree with the depths of the inner nodes between
    them; the nearest leaf of another record on either side gives the deepest common node.
    """
    if len(lo) < 2:
        return np.zeros(len(lo), np.int32)
    step = _common(letters)
    after = _before(lo[::-1], hi[::-1], step[::-1], least)[::-1]
    return np.maximum(_before(lo, hi, step, least), after).astype(np.int32)


def _matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of texts as a matrix padded with 0 (bytes where all are ASCII, else code points), and their lengths."""
    size = np.array([len(t) for t in texts], np.int64)
    whole = "".join(texts)
    letters = np.frombuffer(whole.encode(), np.uint8) if whole.isascii() else np.frombuffer(whole.encode("utf-32-be"), ">u4")
    out = np.zeros((len(size), int(size.max(initial=1))), letters.dtype)
    out[np.arange(out.shape[1]) < size[:, None]] = letters
    return out, size


def anchor_leaves(lo: np.ndarray, hi: np.ndarray, first: np.ndarray, texts: list[str], least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Of the runs of whole anchor groups: run, begin and end of what the run shares with other records (none for runs of several records' sequences).

    The suffixes of all runs are sorted, which puts the leaves of their suffix trees side by side; the leaves of a run overlap,
    so they make one stretch.
    """
    letters, size = _matrix(texts)
    many = size - least + 1
    run = np.repeat(np.arange(len(size)), many)
    at = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    column = at[:, None] + np.arange(letters.shape[1])
    suffix = np.where(column < letters.shape[1], np.take_along_axis(letters[run], np.minimum(column, letters.shape[1] - 1), 1), 0).astype(letters.dtype)
    order = np.argsort(np.ascontiguousarray(suffix).view(f"S{suffix.dtype.itemsize * suffix.shape[1]}").ravel(), kind="stable")
    best = np.empty(len(run), np.int64)
    best[order] = deep_leaves(lo[run[order]], hi[run[order]], suffix[order], least)
    good = np.flatnonzero((best > 0) & (lo[run] == hi[run]))
    begin, end = np.full(len(size), np.iinfo(np.int64).max), np.zeros(len(size), np.int64)
    np.minimum.at(begin, run[good], at[good])
    np.maximum.at(end, run[good], at[good] + best[good])
    found = np.flatnonzero(end > 0)
    return found, begin[found] + first[found], end[found] + first[found]


def _anchor_trees(least: int, rows: int):
    """Over partitions sorted by anchor: walk the trees of whole anchor groups, a buffer at a time, and write the shared stretches."""

    def walk(t: pa.Table) -> pa.RecordBatch:
        lo, hi, first = (t.column(c).to_numpy() for c in ("lo", "hi", "first"))
        run, begin, end = anchor_leaves(lo, hi, first, t.column("text").to_pylist(), least)
        ids = pa.array(t.column("seq_id").to_numpy()[run])
        return pa.RecordBatch.from_arrays([ids, pa.array(lo[run]), pa.array(begin.astype(np.int32)), pa.array((end - begin).astype(np.int32))], ["seq_id", "lo", "pos", "len"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= rows:
                t = pa.Table.from_batches(held)
                anchor = t.column("anchor").to_numpy()
                edge = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch; light anchors are bounded
                if edge:
                    yield walk(t.slice(0, edge))
                held = t.slice(edge).to_batches()
                n = t.num_rows - edge
        if n:
            yield walk(pa.Table.from_batches(held))

    return run


def _subtrees(least: int, depth: int, rows: int):
    """Over partitions sorted by suffix: walk the deep subtrees one after another and write the shared leaves."""

    def walk(held: list[pa.RecordBatch], last: bool) -> tuple[list[pa.RecordBatch], pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        letters, _ = _matrix(t.column("suffix").to_pylist())
        end = t.num_rows
        if not last:  # the last node may go on in the next batch
            edges = np.flatnonzero(_common(letters) < least)
            end = int(edges[-1]) + 1 if len(edges) else 0
        lo, hi = (t.column(c).to_numpy()[:end] for c in ("lo", "hi"))
        best = deep_leaves(lo, hi, letters[:end], least)
        at = np.flatnonzero((best > 0) & (lo == hi))
        made = pa.RecordBatch.from_arrays([t.column("seq_id").take(pa.array(at)), t.column("lo").take(pa.array(at)), t.column("pos").take(pa.array(at)), pa.array(best[at])], ["seq_id", "lo", "pos", "len"])
        return [made], t.slice(end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, wait = [], 0, rows
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= wait:
                made, rest = walk(held, False)
                yield from made
                held, n = ([rest] if rest.num_rows else []), rest.num_rows
                wait = max(rows, 2 * n)
        if held:
            yield from walk(held, True)[0]

    return run


def shared_spans(df: DataFrame, id_column: str, sequence: str, least: int = LEAST, depth: int = DEPTH, group: int = GROUP, lengths: tuple[int, ...] = PREFIXES, anchor: int = ANCHOR) -> DataFrame:
    """id, span_start, span_len: the longest unbroken runs of positions that lie in *least* letters found in another record as well.

    Equal sequences are one class with its least and largest id, so a group of copies isn't multiplied; a class with two ids is
    shared as a whole. Suffixes are grouped by their first *least* letters, so every deep node lies in one group: first by the least-hashed *anchor* letters
    among them, where neighbouring suffixes mostly agree and travel as one run of text. Anchors that only one record has hold no shared span and are
    dropped before any suffix is made. Tasks sort the suffixes of whole anchor groups and walk their suffix trees for inner
    nodes at least *least* deep with leaves of two records. The suffixes of anchors with more than *group* of them are split by prefixes of varying
    length into groups that fit into memory. A group that even *least* letters can't split is itself one such node: its leaves are shared if the
    ids under it differ, which needs no tree. Spans of a record are joined by a window over its own positions.

    Letters compare as they stand. Null and short sequences share nothing; an id with several sequences gets the spans of each;
    rows repeated under one id are no other record. Extra columns are ignored.
    """
    if depth < least or anchor > least:
        raise ValueError("the depth must reach the least length, and anchors lie within it")
    records = df.select(F.col(id_column).alias("id"), F.col(sequence).alias("seq")).filter(F.col("id").isNotNull() & (F.length("seq") >= least))
    classes = cut(records.groupBy("seq").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).withColumn("seq_id", F.monotonically_increasing_id()))
    met = classes.mapInArrow(_anchored(least, anchor, False), "anchor bigint, lo bigint, hi bigint").groupBy("anchor").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n"))
    shared = met.filter("lo < hi").select("anchor", (F.col("n") * (least - anchor + 1) > group).alias("heavy"))
    runs = cut(classes.mapInArrow(_anchored(least, anchor, True), "anchor bigint, lo bigint, hi bigint, seq_id bigint, first int, text string").join(shared, "anchor"))
    light = runs.filter("NOT heavy").drop("heavy").repartition("anchor").sortWithinPartitions("anchor")
    leaves = light.mapInArrow(_anchor_trees(least, max(1, group // (8 * (least - anchor + 1)))), "seq_id bigint, lo bigint, pos int, len int")
    heavy = runs.filter("heavy")
    if not heavy.isEmpty():
        leaves = leaves.unionByName(_prefix_leaves(_suffixes(heavy, least, depth), least, depth, group, lengths))

    ahead = Window.partitionBy("seq_id").orderBy("pos")
    reach = F.max(F.col("pos") + F.col("len")).over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("pos") <= reach, 0).otherwise(1)
    joined = leaves.withColumn("new", begins).withColumn("run", F.sum("new").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    single = joined.groupBy("seq_id", "run").agg(F.first("lo").alias("id"), F.min("pos").alias("span_start"), F.max(F.col("pos") + F.col("len")).alias("span_end"))
    copies = records.join(classes.filter("lo < hi").select("seq"), "seq", "left_semi").select("id", F.lit(0).alias("span_start"), F.length("seq").alias("span_end"))
    both = single.select("id", "span_start", "span_end").unionByName(copies)
    return both.select("id", "span_start", (F.col("span_end") - F.col("span_start")).alias("span_len")).distinct()


def _prefix_leaves(suffixes: DataFrame, least: int, depth: int, group: int, lengths: tuple[int, ...]) -> DataFrame:
    """seq_id, lo, pos, len of the shared leaves among suffixes that are split by prefixes of varying length."""
    named, unsplit = split_by_prefix(suffixes, (*(n for n in lengths if n < least), least), group)
    grouped = named.filter(F.col("prefix").isNotNull()).repartition("prefix").select("seq_id", "lo", "hi", "pos", "suffix").sortWithinPartitions("suffix")
    leaves = grouped.mapInArrow(_subtrees(least, depth, group // 4), "seq_id bigint, lo bigint, pos int, len int")
    if unsplit is not None:
        shared = measured(unsplit.filter("node_lo < node_hi").select("node"))
        wide = suffixes.filter("lo = hi").join(shared, _head(least) == F.col("node"), "left_semi")
        leaves = leaves.unionByName(wide.select("seq_id", "lo", "pos", F.lit(least).alias("len")))
    return leaves
