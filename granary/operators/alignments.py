"""Operators on alignments: flags, errors from CIGAR and MD, accuracy, depth.

Columns: ``contig``, ``start`` (0-based), ``flag``, ``cigar``, ``md``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import cigars, gapped, sequence
from granary.operators import coverage, intervals
from granary.operators.arrow import Work, dealt, lists, with_arrays

UNMAPPED, REVERSE, FAILED, DUPLICATE = 4, 16, 512, 1024
#: Errors a base at most, as one in so many bases, for lengths at quality 7, 10, 17 and 20.
ONE_IN = {7: 5, 10: 10, 17: 50, 20: 100}


def has(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def core(df: DataFrame) -> DataFrame:
    """Alignments that are mapped, no duplicates, and passed quality control."""
    return df.filter(F.col("flag").bitwiseAND(F.lit(UNMAPPED | FAILED | DUPLICATE)) == 0)


def depth(df: DataFrame) -> DataFrame:
    """Stretches of equal depth by strand: M, N, = and X cover, a deletion breaks (see ``coverage.steps``)."""
    place = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        walk = cigars.walked(c["cigar"])
        covers = np.isin(walk.kind, list(b"MN=X"))
        owner, ref, _, size = walk.take(covers)
        low = c["start"].to_numpy(zero_copy_only=False)[owner] + ref
        return [lists(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=walk.n))]), ("lo", pa.array(low.astype(np.int64))), ("hi", pa.array((low + size).astype(np.int64))))]

    found = with_arrays(df.select("contig", "start", "flag", "cigar").filter("start is not null"), [T.StructField("blocks", T.ArrayType(place))], work)
    return coverage.steps(found.select("contig", (~has(F.col("flag"), REVERSE)).alias("forward"), F.explode("blocks").alias("b")).select("contig", "b.lo", "b.hi", "forward"))


def with_errors(df: DataFrame) -> DataFrame:
    """Adds ``bases`` (aligned ones, with what is put in) and ``errors``: array of (pos, kind, n) in the order of pos.

    ``ins`` and ``del`` come from the CIGAR, ``sub`` from the MD string; ``pos`` counts the
    aligned bases of the read before the error, clipped ones not among them.
    """
    error = T.StructType([T.StructField("pos", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("n", T.LongType())])
    names = pa.array(cigars.ERROR_KINDS)

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        walk = cigars.walked(c["cigar"])
        found = cigars.errors(walk, c["md"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(found.owner, minlength=walk.n))])
        bases = walk.total(np.isin(np.arange(256), list(b"MI=X")))
        return [pa.array(bases, pa.int32()), lists(offsets, ("pos", pa.array(found.pos)), ("kind", names.take(pa.array(found.kind))), ("n", pa.array(found.n)))]

    return with_arrays(df, [T.StructField("bases", T.IntegerType()), T.StructField("errors", T.ArrayType(error))], work)


def pileup(df: DataFrame) -> DataFrame:
    """contig, pos, coverage and counts of bases by strand, of deletions, of discounted bases and of insertions behind the place.

    A read with an insertion on either side of its base there is discounted: it counts in
    ``coverage`` and ``discounted`` alone.  A task's reads are sorted by place, so that those of a
    batch lie over few places; counts are summed in each batch and again map-side, so a place
    under any number of reads is a few rows a task.
    """
    names = [*cigars.PILED]
    schema = T.StructType([df.schema["contig"], T.StructField("pos", T.LongType()), *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                walk = cigars.walked(part.column("cigar"))
                reverse = (part.column("flag").to_numpy(zero_copy_only=False) & REVERSE) != 0
                whose, where, column = cigars.piled(walk, part.column("start").to_numpy(zero_copy_only=False).astype(np.int64), reverse, part.column("seq"))
                contigs = part.column("contig").dictionary_encode()
                which = contigs.indices.to_numpy(zero_copy_only=False)[whose]
                low_place, width = (int(where.min()), int(np.ptp(where)) + 1) if len(where) else (0, 1)
                places, at = np.unique(which.astype(np.int64) * width + where - low_place, return_inverse=True)
                contig, pos = np.divmod(places, width)
                counts = np.bincount(at.ravel() * len(names) + column, minlength=len(places) * len(names)).reshape(-1, len(names))
                yield pa.RecordBatch.from_arrays([contigs.dictionary.take(pa.array(contig)), pa.array(pos + low_place), *(pa.array(counts[:, k]) for k in range(len(names)))], schema.names)

    known = df.filter("contig is not null and start is not null and flag is not null").select("contig", "start", "flag", "cigar", "seq")
    summed = known.sortWithinPartitions("contig", "start").mapInArrow(run, schema).groupBy("contig", "pos").agg(*(F.sum(n).alias(n) for n in names))
    covered = sum((F.col(n) for n in names[1:-1]), F.col(names[0]))
    return summed.select("contig", "pos", covered.alias("coverage"), *names)


def with_md(df: DataFrame, ref: str = "ref") -> DataFrame:
    """Adds ``md`` from ``cigar``, ``seq`` and the reference bases from the alignment's start on (see ``reference.with_window``)."""
    return with_arrays(df, [T.StructField("md", T.StringType())], lambda c: [cigars.md_strings(cigars.walked(c["cigar"]), c["seq"], c[ref])])


def rebuilt(df: DataFrame) -> DataFrame:
    """Adds ``ref``, the reference under each alignment as its bases, CIGAR and MD string tell it, skips left out."""

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        found = cigars.reference(cigars.walked(c["cigar"]), c["seq"], c["md"])
        return [cigars.strings(found.base, np.diff(found.first))]

    return with_arrays(df, [T.StructField("ref", T.StringType())], work)


#: Costs of a realignment: a missing or additional base of a homopolymer costs less the longer it is.
CONTEXT = gapped.Scores(4, -6, 5, 2, "both")


#: Reads that are realigned together, and their bases at most: the more, the fewer the calls for each.
READS, BASES = 10_000, 2_000_000


def realigned(df: DataFrame, scores: gapped.Scores = CONTEXT, band: int = 10) -> DataFrame:
    """Alignments with gaps where they cost least in their context: new ``start``, ``cigar`` and ``md``, and ``changed``.

    The reference comes from the read's bases, CIGAR and MD string; all of the read between
    its clips is aligned to it anew, ``band`` places around the old path.  Reads that can't be
    (no bases or MD string, skips or pads, an MD string of another length, or errors at both ends
    of what the band reaches) stay as they are, and so do those whose new path scores no more.
    """
    return with_arrays(dealt(df), *realigning(scores, band), rows=READS)


def realigning(scores: gapped.Scores = CONTEXT, band: int = 10, ref: str | None = None) -> tuple[list[T.StructField], Work]:
    """``realigned`` as a step of ``with_arrays``.

    With ``ref``, a column of the reference bases from the alignment's start on (none fewer than
    the CIGAR string takes, or the read stays as it is), MD strings are neither read nor made.
    """

    def bounded(c: dict[str, pa.Array]) -> list[pa.Array]:
        n = len(c["seq"])
        if n < 2 or (pc.sum(pc.binary_length(c["seq"])).as_py() or 0) <= BASES:
            return work(c)
        halves = (bounded({name: c[name].slice(low, size) for name in ("cigar", "seq", ref or "md", "start")}) for low, size in ((0, n // 2), (n // 2, n - n // 2)))
        return [pa.concat_arrays(x) for x in zip(*halves, strict=True)]

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        walk = cigars.walked(c["cigar"])
        kind, size, owner, n = walk.kind, walk.size, walk.owner, walk.n
        data, begins = cigars.flat(c["seq"])
        hard, soft = kind == ord("H"), kind == ord("S")

        def many(rows: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(rows, sizes, n).astype(np.int64)

        if ref is None:
            said = cigars.letters(c["md"])
            known = cigars.reference(walk, c["seq"], c["md"], said)
            under, first, spans = known.base, known.first, np.diff(known.first)
            told = (said.lengths == spans) & (many(owner, size * (kind == ord("D"))) == many(said.owner, said.gone))
        else:
            under, first = cigars.flat(c[ref])
            spans = walk.on_ref
            told = np.diff(first) >= spans
        there = ~(c[ref or "md"].is_null().to_numpy(zero_copy_only=False) | c["start"].is_null().to_numpy(zero_copy_only=False)) & (many(owner[~hard]) > 0) & (many(owner[np.isin(kind, list(b"NP"))]) == 0)
        rows = np.flatnonzero(there & told & (np.diff(begins) == walk.total(np.isin(np.arange(256), list(b"MIS=X")))))
        m = len(rows)
        # what is clipped at both ends
        ops = np.flatnonzero(~hard)
        head, tail = (np.searchsorted(owner[ops], rows, side) for side in ("left", "right"))
        before, after = (np.where(soft[ops[x]] & ok, size[ops[x]], 0) for x, ok in ((head, True), (tail - 1, tail - head > 1)))
        # the steps between them, and where they lead: of each base the reference place behind it
        rank = np.full(n, -1)
        rank[rows] = np.arange(m)
        inner = np.flatnonzero((rank[owner] >= 0) & ~hard & ~soft)
        whose, step, long = rank[owner[inner]], kind[inner], size[inner]
        put, gone = step == ord("I"), step == ord("D")
        at_read, at_ref = cigars.before(long * ~gone, whose, m), cigars.before(long * ~put, whose, m)
        edges = np.concatenate([[0], np.cumsum(np.bincount(whose, long * ~gone, m).astype(np.int64) + 1)])
        path = np.zeros(int(edges[-1]), np.int64)
        bases = long * ~gone
        each = np.repeat(at_ref, bases)
        path[cigars.spread(edges[whose] + at_read + 1, bases)] = each + np.where(np.repeat(put, bases), 0, cigars.spread(np.ones(len(bases), np.int64), bases))
        path[(edges[whose] + at_read)[gone]] = (at_ref + long)[gone]

        def cut(data: np.ndarray, low: np.ndarray, sizes: np.ndarray) -> gapped.Flat:
            return gapped.Flat(data[cigars.spread(low, sizes)], np.concatenate([[0], np.cumsum(sizes)]))

        query, base = cut(data, begins[rows] + before, np.diff(begins)[rows] - before - after), cut(under, first[rows], spans[rows])
        found = gapped.aligned(query, base, scores, "read", gapped.Flat(path, edges), band, gapped.flat_path_scores(query, base, whose, step, long, scores))
        # those with a better path: its steps between what was clipped
        new = np.flatnonzero(np.diff(found.first))
        steps = np.diff(found.first)[new]
        first_op, last_op = (np.searchsorted(owner, rows[new], side) for side in ("left", "right"))
        begin = np.cumsum(steps + 4) - steps - 4
        sizes, letters = np.zeros(int((steps + 4).sum()), np.int64), np.full(int((steps + 4).sum()), ord("S"), np.uint8)
        own = cigars.spread(begin + 2, steps)
        sizes[own], letters[own] = found.size, found.kind
        for at, letter, clipped in ((begin, "H", size[first_op] * hard[first_op]), (begin + 1, "S", before[new]), (begin + steps + 2, "S", after[new]), (begin + steps + 3, "H", size[last_op - 1] * hard[last_op - 1])):
            sizes[at], letters[at] = clipped, ord(letter)
        some = np.flatnonzero(sizes)
        fresh = cigars.written(sizes[some], letters[some], np.ones(len(some), np.int64), np.repeat(np.arange(len(new)), steps + 4)[some], len(new))
        same = pc.equal(fresh, c["cigar"].take(pa.array(rows[new]))).to_numpy(zero_copy_only=False) & (found.r_lo[new] == 0)
        new, fresh = new[~same], fresh.filter(pa.array(~same))
        at = rows[new]
        changed, shift = np.zeros(n, bool), np.zeros(n, np.int64)
        changed[at], shift[at] = True, found.r_lo[new]
        mask = pa.array(changed)
        texts = {"cigar": fresh}
        if ref is None:
            now = cut(base.data, base.first[new] + found.r_lo[new], found.r_hi[new] - found.r_lo[new])
            texts["md"] = cigars.md_strings(cigars.walked(fresh), c["seq"].take(pa.array(at)), cigars.strings(now.data, now.sizes))
        start = pc.add(c["start"].cast(pa.int64()), pa.array(shift))
        return [start, *(pc.replace_with_mask(c[name].cast(pa.string()), mask, x) for name, x in texts.items()), mask]

    strings = ["cigar"] if ref else ["cigar", "md"]
    return [T.StructField("start", T.LongType()), *(T.StructField(name, T.StringType()) for name in strings), T.StructField("changed", T.BooleanType())], bounded


def homopolymer_errors(df: DataFrame, by: list[str], longest: int = 10) -> DataFrame:
    """Runs of the reference by ``by``, base, length and length in the read, both ``longest`` at most: ``base``, ``ref_len``, ``read_len``, ``runs``."""
    run = T.StructType([T.StructField("base", T.StringType()), T.StructField("ref_len", T.LongType()), T.StructField("read_len", T.LongType()), T.StructField("runs", T.LongType())])

    def work(c: dict[str, pa.Array]) -> list[pa.Array]:
        walk = cigars.walked(c["cigar"])
        owner, base, length, read = cigars.homopolymers(walk, c["seq"], c["md"])
        cell = ((owner * 256 + base) * (longest + 1) + np.minimum(length, longest)) * (longest + 1) + np.clip(read, 0, longest)
        cell, n = np.unique(cell, return_counts=True)
        who, cell = np.divmod(cell, 256 * (longest + 1) ** 2)
        base, cell = np.divmod(cell, (longest + 1) ** 2)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=walk.n))])
        return [lists(offsets, ("base", pa.array([chr(b) for b in base.tolist()], pa.string())), ("ref_len", pa.array(cell // (longest + 1))), ("read_len", pa.array(cell % (longest + 1))), ("runs", pa.array(n)))]

    found = with_arrays(df.select(*dict.fromkeys([*by, "cigar", "seq", "md"])), [T.StructField("found", T.ArrayType(run))], work)
    return found.select(*by, F.explode("found").alias("f")).groupBy(*by, "f.base", "f.ref_len", "f.read_len").agg(F.sum("f.runs").alias("runs"))


def length_at(errors: Column, bases: Column, one_in: int) -> Column:
    """The longest length, before an error or of all bases, at which there is one error in ``one_in`` bases at most."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("best"))

    def step(s: Column, e: Column) -> Column:
        return F.struct((s["n"] + e["n"]).alias("n"), F.when(s["n"] * one_in <= e["pos"], F.greatest(s["best"], e["pos"])).otherwise(s["best"]).alias("best"))

    return F.aggregate(errors, zero, step, lambda s: F.when(s["n"] * one_in <= bases, F.greatest(s["best"], bases.cast("long"))).otherwise(s["best"]))


def accurate(df: DataFrame, length: int, accuracy: float) -> DataFrame:
    """Alignments of at least ``length`` bases of which that share at least is without error (see ``with_errors``)."""
    wrong = F.aggregate(F.filter("errors", lambda e: e["pos"] < length), F.lit(0).cast("long"), lambda n, e: n + e["n"])
    return df.filter((F.col("bases") >= length) & (wrong <= length) & ((length - wrong) / F.lit(float(length)) >= accuracy))


def single_errors(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each base in error: ``pos`` and ``kind``; of a deletion all bases stand at one place."""
    each = df.select(*keep, F.explode("errors").alias("e")).select(*keep, "e.kind", "e.pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("e.n") - 1)).alias("k"))
    return each.select(*keep, "kind", F.when(F.col("kind") == "ins", F.col("pos") + F.col("k")).otherwise(F.col("pos")).alias("pos"))


def errors_by_position(df: DataFrame, by: list[str]) -> DataFrame:
    """``pos``, ``ins``, ``del``, ``sub`` and ``depth`` (alignments that reach the place) by place in the read."""
    counts = single_errors(df, by).groupBy(*by, "pos").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in ("ins", "del", "sub")))
    # one row a length, and reads are short, so the window is
    ends = df.groupBy(*by, (F.col("bases") - 1).cast("long").alias("last")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*by).orderBy(F.desc("last")).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("last")
    reach = ends.withColumns({"depth": F.sum("n").over(upto), "first": F.coalesce(F.lag("last").over(before) + 1, F.lit(0))})
    depths = reach.select(*by, F.explode(F.sequence("first", "last")).alias("pos"), "depth")
    return depths.join(counts, [*by, "pos"], "left").select(*by, "pos", *(F.coalesce(k, F.lit(0)).alias(k) for k in ("ins", "del", "sub")), "depth")


def consolidated(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each place with errors of an alignment: ``pos`` and ``n``, how many stand there."""
    return single_errors(df, keep).groupBy(*keep, "pos").agg(F.count("*").alias("n"))


def merged(parts: list[DataFrame]) -> DataFrame:
    """Several sets of alignments as one in the order of contig and start, by ranges of both."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.repartitionByRange("contig", "start").sortWithinPartitions("contig", "start")


def disorder(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``rows`` and ``disorder``, how many rows are less than the one before them, within partitions and at their borders.

    Looks at the rows where they lie; one row a partition is compared in the end.
    """
    kinds = [df.schema[k] for k in keys]
    ends = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("wrong", T.LongType()), *(T.StructField(f"{e}{k}", f.dataType) for e in ("low", "high") for k, f in enumerate(kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n, wrong, low, high = 0, 0, None, None
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            if rows:
                low = rows[0] if low is None else low
                wrong += sum(x > y for x, y in zip([high or rows[0], *rows], rows, strict=False))
                n, high = n + len(rows), rows[-1]
        if n:
            values = [TaskContext.get().partitionId(), n, wrong, *low, *high]
            yield pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, kept, strict=True)], ends.names)

    from pyspark.sql.pandas.types import to_arrow_type

    kept = [to_arrow_type(f.dataType) for f in ends]
    parts = df.select(*keys).mapInArrow(run, ends)
    over = Window.orderBy("part")  # one row a partition
    lows, highs = (F.struct(*(F.col(f"{e}{k}") for k in range(len(keys)))) for e in ("low", "high"))
    bad = F.coalesce(F.lag(highs).over(over) > lows.cast(T.StructType([T.StructField(f"high{k}", f.dataType) for k, f in enumerate(kinds)])), F.lit(False))
    return parts.withColumn("bad", bad.cast("long")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("wrong") + F.sum("bad"), F.lit(0)).alias("disorder"))


def selected(df: DataFrame, required: int = 0, excluded: int = 0, min_mapq: int = 0, min_length: int = 0, max_length: int | None = None, regions: DataFrame | None = None) -> DataFrame:
    """Alignments by flags, mapping quality, bases of the read, and overlap with any region (contig, lo, hi), each once.

    ``length`` counts the bases that the CIGAR string aligns or puts in.
    """
    flag = F.col("flag")
    x = df.filter((flag.bitwiseAND(F.lit(required)) == required) & (flag.bitwiseAND(F.lit(excluded)) == 0))
    if min_mapq:
        x = x.filter(F.col("mapq") >= min_mapq)
    if min_length or max_length is not None:
        x = x.filter(sequence.cigar_sum(F.col("cigar"), "MI=X", lambda n: (n >= min_length) & (n <= max_length) if max_length is not None else n >= min_length))
    if regions is None:
        return x
    # regions that touch are one, so an alignment meets its regions in the stretches of their union
    spans = x.withColumns({"__lo": F.col("start").cast("long"), "__hi": (F.col("start") + sequence.cigar_sum(F.col("cigar"), "MDN=X")).cast("long")})
    return intervals.semi_overlapping(spans, intervals.union(regions.select("contig", "lo", "hi")), "__lo", "__hi").drop("__lo", "__hi")


def cigar_span(ops: Column) -> Column:
    return sequence.cigar_length(ops, "MDN=X")


def filtered_and_merged(parts: list[DataFrame], **conditions: object) -> DataFrame:
    """Several sets of alignments, each filtered (see ``selected``), as one in the order of contig and start."""
    return merged([selected(p, **conditions) for p in parts])


def spike_counts(df: DataFrame, names: DataFrame, over_mapq: int = 50, forward_only: bool = False) -> DataFrame:
    """``contig``, ``n`` and ``mean_mapq`` of the named transcripts, from alignments of a mapping quality over ``over_mapq``; one with none is not there.

    With ``forward_only`` flags other than 0 don't count.
    """
    good = df.filter(F.col("mapq") > over_mapq)
    if forward_only:
        good = good.filter("flag = 0")
    return good.join(names.select("contig").distinct(), "contig", "left_semi").groupBy("contig").agg(F.count("*").alias("n"), F.avg("mapq").alias("mean_mapq"))
