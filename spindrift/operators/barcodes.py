"""Barcode counting operators: reads -> aggregated -> filtered -> readtable -> collapsed -> counts -> filtered counts.

Subjects (brains) are a grouping key throughout; nothing loops over them.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.functions.seq import hamming, has_repeat, n_count, neighbours, starts_like
from spindrift.operators import plain
from spindrift.operators.components import connected_components
from spindrift.plans.scratch import Scratch, dealt

#: The sites of control samples.  ``target-negative`` is none of them; it is treated like ``target``.
CONTROL_SITES = ("target-wt-control", "target-water-control", "injection-water-control", "injection-wt-control", "target-lone")


# --- reads -------------------------------------------------------------------


def aggregate_reads(df: DataFrame, columns=("sequence", "source"), min_reads: int = 1, recover: tuple[str, ...] = ()) -> DataFrame:
    """Identical reads counted as ``read_count``; rows with a null key are not counted.

    ``recover`` names other columns to keep: those of one row of the key, the smallest
    of them taken together, so a rerun keeps the same.
    """
    more = [F.min(F.struct(*recover)).alias("_one")] if recover else []
    out = df.na.drop(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("read_count"), *more)
    out = out.select(*columns, "read_count", *[F.col(f"_one.{c}").alias(c) for c in recover]) if recover else out
    return out.where(F.col("read_count") >= min_reads) if min_reads > 1 else out


def set_read_counts(df: DataFrame, column: str = "sequence") -> DataFrame:
    """Every row with ``read_count``, how many rows have its value; rows without one have none.

    Counts are made before they meet the rows, so a frequent value is summed up in parts.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("read_count"))
    return df.drop("read_count").join(counts, F.col(column) == F.col("_value"), "left").drop("_value")


def sum_counts(df: DataFrame, by: tuple[str, ...] = ("label", "sequence")) -> DataFrame:
    """Reads and molecules of collapsed sequences added up: (by, read_count, umi_count)."""
    return df.groupBy(*by).agg(F.sum("read_count").alias("read_count"), F.sum("umi_count").alias("umi_count"))


def reaggregate_reads(df: DataFrame, column: str = "sequence", ordered: bool = False) -> DataFrame:
    """Counts of already counted reads added up over all sources."""
    out = df.na.drop(subset=[column]).groupBy(column).agg(F.sum("read_count").alias("read_count"))
    return out.orderBy(F.desc("read_count"), column) if ordered else out


def filter_reads(df: DataFrame, column: str = "sequence", max_repeats: int = 7, max_n_bases: int = 0, min_reads: int = 1, remove: bool = True) -> DataFrame:
    """Drop reads with too many N or too long runs of one base; or only flag them as nb_valid and nr_valid."""
    c = F.col(column)
    out = df.where(F.col("read_count") >= min_reads) if min_reads > 1 else df
    nb, nr = n_count(c) <= max_n_bases, ~has_repeat(c, max_repeats)
    return out.where(nb & nr) if remove else out.withColumns({"nb_valid": nb, "nr_valid": nr})


def filter_fields(df: DataFrame, equal: dict[str, str] | None = None, patterns: dict[str, str] | None = None, drop_mismatch: bool = True) -> DataFrame:
    """Keep rows whose fields equal the fixed sequences and match the patterns; or flag them as ``valid``."""
    ok = F.lit(True)
    for name, want in (equal or {}).items():
        ok = ok & (F.col(name) == want)
    for name, pattern in (patterns or {}).items():
        ok = ok & starts_like(F.col(name), pattern)
    return df.where(ok) if drop_mismatch else df.withColumn("valid", F.coalesce(ok, F.lit(False)))


def dominant_value(df: DataFrame, by: str = "source", column: str = "ssi") -> DataFrame:
    """(by, column, n): the most frequent value for each key, ties to the smallest."""
    counts = df.na.drop(subset=[by, column]).groupBy(by, column).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(by).agg(F.min_by(F.struct(column, "n"), F.struct(-F.col("n"), column)).alias("x")).select(by, f"x.{column}", "x.n")


def keep_dominant(df: DataFrame, by: str = "source", column: str = "ssi", drop: bool = False) -> DataFrame:
    """Keep each key's rows with its most frequent value."""
    out = df.join(dominant_value(df, by, column).drop("n"), [by, column], "left_semi")
    return out.drop(column) if drop else out


def keep_expected(df: DataFrame, expected: DataFrame, tube: str = "ourtube", primer: str = "rtprimer") -> DataFrame:
    """Keep rows whose primer is the one that the sample sheet expects in their tube; tubes compare without case."""
    want = expected.select(F.lower(tube).alias("_t"), F.lower(primer).alias("_p")).distinct()
    return df.join(want, (F.lower(df[tube]) == F.col("_t")) & (F.lower(df[primer]) == F.col("_p")), "left_semi")


def keep_sheet_ssi(df: DataFrame, samples: DataFrame, barcodes: DataFrame, column: str = "ssi", tube: str = "ourtube") -> DataFrame:
    """Rows whose sample barcode is that of the sample which the sheet has in their tube; rows of tubes that it lacks stay.

    Tubes compare without case; of several samples in one tube the smallest label counts.
    """
    held = samples.join(barcodes.select("label", F.col("ssi").alias("_ssi")), "label", "left").groupBy(F.lower(tube).alias("_tube")).agg(F.min_by("_ssi", "label").alias("_ssi"), F.lit(True).alias("_held"))
    out = df.join(held, F.lower(tube) == F.col("_tube"), "left")  # one row a tube; Spark broadcasts it while it is small
    return out.where(F.col("_held").isNull() | (F.col(column) == F.col("_ssi"))).select(df.columns)


# --- read table --------------------------------------------------------------


def lookup_samples(df: DataFrame, barcodes: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Add label and rtprimer by ssi, then site, brain, region and ourtube by rtprimer; unmatched ssi stay null.

    Both sides are dimensions; Spark broadcasts them while they are below its threshold.
    """
    b = barcodes.select("ssi", "label", F.regexp_replace("label", "^(BC|SSI)", "").alias("rtprimer")).dropDuplicates(["ssi"])
    out = df.join(b, "ssi", "left")
    if samples is not None:
        s = samples.select("rtprimer", F.col("siteinfo").alias("site"), "brain", "region", "ourtube").dropDuplicates(["rtprimer"])
        out = out.join(s, "rtprimer", "left").na.fill("", ["brain", "region", "ourtube"])
    return out


def classify(df: DataFrame, spikeseq: str = "CGTCAGTC", real: str = "[TC][TC]$", lone: str = "[AG][AG]$", use_libtag: bool = True, default_real: bool = False) -> DataFrame:
    """Add ``type``: lone before spike before real; null for none of them."""
    spike = F.col("spikeseq") == spikeseq
    if not use_libtag:
        return df.withColumn("type", F.when(spike, "spike").otherwise("real"))
    kind = F.when(starts_like(F.col("libtag"), lone), "lone").when(spike, "spike").when(starts_like(F.col("libtag"), real), "real")
    return df.withColumn("type", F.coalesce(kind, F.lit("real")) if default_real else kind)


def rejects(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null in any of these columns."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.where(bad)


def is_template_switch():
    """L1 controls in other samples, and other molecules in L1 samples."""
    return F.col("site").startswith("target-lone") != (F.col("type") == "lone")


def split_template_switches(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, switched)."""
    switched = F.coalesce(is_template_switch(), F.lit(False))
    return df.where(~switched), df.where(switched)


def sample_threshold(df: DataFrame, samples: DataFrame, default: tuple[str, int] | None = None) -> DataFrame:
    """Keep reads with at least their sample's min_reads; samples that the sheet lacks go."""
    t = samples.select("label", "min_reads").dropDuplicates(["label"])
    return df.join(t, "label").where(F.col("read_count") >= F.col("min_reads")).select(df.columns)


def default_min_reads(target: int = 2, injection: int = 2):
    """A sample's threshold by the start of its siteinfo, else 1."""
    return F.when(F.col("siteinfo").startswith("target"), target).when(F.col("siteinfo").startswith("injection"), injection).otherwise(1)


def site_threshold(df: DataFrame, target: int = 2, injection: int = 2) -> DataFrame:
    """Read thresholds by site; rows of other sites go."""
    site, n = F.col("site"), F.col("read_count")
    return df.where((site.startswith("target") & (n >= target)) | (site.startswith("injection") & (n >= injection)))


# --- collapse ----------------------------------------------------------------


def unique_sequences(df: DataFrame, column: str = "vbc_read", group: str = "brain", parent: str = "read_count") -> DataFrame:
    """(grp, seq, n, weight): distinct sequences of each non-empty group with their rows and summed reads."""
    return df.where(F.col(group) != "").groupBy(F.col(group).alias("grp"), F.col(column).alias("seq")).agg(F.count(F.lit(1)).alias("n"), F.sum(parent).alias("weight"))


def _cells(seqs: DataFrame, blocks: int) -> DataFrame:
    """(grp, len, c0, more, raw, ...) of non-null sequences: two bits a base, 31 bases a long at most.

    ``c0`` is the first long and ``more`` the others, if any; a long holds a multiple of
    ``blocks`` bases, so a base's place in its long tells its block.  Other letters are
    coded as A; ``raw`` is then the sequence itself.
    """
    width = blocks * (31 // blocks)
    other = F.col("seq").rlike("[^ACGT]")
    digits = F.translate(F.when(other, F.regexp_replace("seq", "[^ACGT]", "A")).otherwise(F.col("seq")), "ACGT", "0123")
    rows = seqs.where("seq is not null").select("*", F.length("seq").alias("len"), digits.alias("_d"), F.when(other, F.col("seq")).alias("raw"))
    c0 = F.coalesce(F.conv(F.nullif(F.expr(f"left(_d, {width})"), F.lit("")), 4, 10).cast("long"), F.lit(0))
    more = F.expr(f"if(len > {width}, transform(sequence(1, int((len - 1) div {width})), i -> cast(conv(substring(_d, i * {width} + 1, {width}), 4, 10) as long)), null)")
    return rows.select("grp", "len", c0.cast("long").alias("c0"), more.alias("more"), "raw", *[c for c in ("id",) if c in seqs.columns])


def _decoded(side: str, width: int) -> Column:
    """The sequence of a row of :func:`_cells`."""
    text = lambda c, n: f"translate(lpad(conv({c}, 10, 4), {n}, '0'), '0123', 'ACGT')"
    n = f"int({side}.len)"
    rest = f"if({side}.more is null, '', array_join(transform({side}.more, (c, i) -> {text('c', f'least({width}, {n} - (i + 1) * {width})')}), ''))"
    return F.expr(f"coalesce({side}.raw, concat({text(f'{side}.c0', f'least({width}, {n})')}, {rest}))")


def similarity_edges(seqs: DataFrame, max_distance: int = 3, metric: str = "hamming") -> DataFrame:
    """(grp, a, b, distance) for all pairs a < b of one group at 1..max_distance; null sequences are in none.

    With ``hamming`` sequences of one length are compared.  Pigeonhole: the places of a
    sequence are dealt in turn to blocks, two more than ``max_distance`` and five at
    least; so many of them are equal that sequences meet under the hashes of equal
    blocks.  Dealt in turn, since whole stretches may be fixed, as the end of a spike is:
    as a block it would keep nothing apart.  Codes of two bits a base travel, not
    the sequences; a pair counts under its first equal blocks only.  If
    ``seqs`` has an ``id`` in the sequences' order, ``a_id`` and ``b_id`` follow.
    With ``levenshtein`` see :func:`edit_edges`.
    """
    if metric == "levenshtein":
        return edit_edges(seqs, max_distance)
    k = max(5, max_distance + 2)
    width = k * (31 // k)
    chosen = list(combinations(range(k), k - max_distance))
    mask = lambda blocks: sum(3 << 2 * (at + b) for at in range(0, width, k) for b in blocks)
    masks = [mask(blocks) for blocks in chosen]
    keys = F.array(*[F.expr(f"xxhash64({n}, len, c0 & {m}L, transform(more, x -> x & {m}L))") for n, m in enumerate(masks)])
    cells = _cells(seqs, k)
    keyed = cells.select("*", F.posexplode(keys).alias("n", "key"))
    left, right = keyed.alias("l"), keyed.alias("r")  # one plan, so one exchange
    apart = lambda x: f"bit_count(({x} | shiftrightunsigned({x}, 1)) & {sum(1 << 2 * i for i in range(31))}L)"
    first = "(l.c0 ^ r.c0)"
    least = F.expr(f"{apart(first)} <= {max_distance}")  # what the first longs tell
    folded = f"({first} | coalesce(aggregate(zip_with(l.more, r.more, (x, y) -> x ^ y), 0L, (acc, x) -> acc | x), 0L))"
    under = "case " + " ".join(f"when ({folded} & {m}L) = 0 then {n}" for n, m in enumerate(masks)) + " end"
    order = F.expr("l.c0 < r.c0 or (l.c0 = r.c0 and struct(l.more, l.raw) < struct(r.more, r.raw))")
    cond = [F.col("l.key") == F.col("r.key"), F.col("l.grp").eqNullSafe(F.col("r.grp")), F.col("l.n") == F.col("r.n"), F.col("l.len") == F.col("r.len"), least, order, F.expr(f"l.n = {under}")]
    bits = F.expr(f"{apart(first)} + coalesce(aggregate(zip_with(l.more, r.more, (x, y) -> {apart('(x ^ y)')}), 0, (acc, x) -> acc + x), 0)")
    x, y = _decoded("l", width), _decoded("r", width)
    distance = F.when(F.expr("l.raw is null and r.raw is null"), bits).otherwise(hamming(x, y)).cast("int")
    ids = [f("l.id", "r.id").alias(name) for f, name in ((F.least, "a_id"), (F.greatest, "b_id")) if "id" in seqs.columns]
    out = left.hint("merge").join(right, cond).select(F.col("l.grp").alias("grp"), F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), distance.alias("distance"), *ids)
    return out.where(F.col("distance").between(1, max_distance))


def edit_edges(seqs: DataFrame, max_distance: int = 3) -> DataFrame:
    """(grp, a, b, distance) for all pairs a < b of one group at an edit distance of 1..max_distance.

    Cut in ``max_distance + 1`` segments, the shorter sequence (the smaller, of
    equal length) has one that no edit touches: it stands in the longer one, shifted
    by at most ``max_distance``.  Segments and the longer sequence's substrings
    meet in an equi-join; each distinct pair is verified once.

    Up to two edits, sequences of one length need no such search: they differ in at most
    two places, or one deletion and one insertion lead from one to the other, and then
    they have a string in common that each becomes by one deletion.
    """
    d = max_distance
    if d > 2:
        return _segment_edges(seqs, d)
    alike = similarity_edges(seqs.select("grp", "seq"), d).select("grp", "a", "b", "distance")
    lengths = seqs.where("seq is not null").select("grp", F.length("seq").alias("len")).distinct()
    out = alike.unionByName(_segment_edges(seqs, d, lengths))
    if d < 2:
        return out
    cut = seqs.where("length(seq) > 0").select("grp", "seq", F.explode(F.expr("array_distinct(transform(sequence(1, length(seq)), i -> concat(left(seq, i - 1), substring(seq, i + 1))))")).alias("w"))
    met = cut.alias("l").hint("merge").join(cut.alias("r"), [F.col("l.w") == F.col("r.w"), F.col("l.grp").eqNullSafe(F.col("r.grp")), F.col("l.seq") < F.col("r.seq")])
    met = met.select(F.col("l.grp").alias("grp"), F.col("l.seq").alias("a"), F.col("r.seq").alias("b")).where(_more_than_two())
    return out.unionByName(met.distinct().withColumn("distance", F.lit(2)))


def _more_than_two() -> Column:
    """Whether sequences a and b of one length differ in over two places; one deletion each leaves them equal.

    Such sequences are the same but for a stretch, in which one is the other moved by a
    place.  So it is enough to count differing places; plain sequences of up to 31
    bases by their bits.
    """
    code = lambda c: F.conv(F.translate(c, "ACGT", "0123"), 4, 10).cast("long")
    plain = (F.length("a") <= 31) & ~F.col("a").rlike("[^ACGT]") & ~F.col("b").rlike("[^ACGT]")
    x = code("a").bitwiseXOR(code("b"))
    bits = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(sum(1 << 2 * i for i in range(31)))))
    return F.when(plain, bits).otherwise(hamming(F.col("a"), F.col("b"))) > 2


def _segment_edges(seqs: DataFrame, max_distance: int, lengths: DataFrame | None = None) -> DataFrame:
    """The search by segments; with ``lengths`` (grp, len), those that occur, only of sequences of different ones."""
    d, k = max_distance, max_distance + 1
    some = seqs.where("seq is not null").select("grp", "seq", F.length("seq").alias("len"))
    start = lambda size, i: f"int(({i}) * ({size}) div {k})"
    own = some.select("grp", F.col("seq").alias("s"), F.col("len").alias("n"), F.posexplode(F.expr(f"transform(sequence(0, {d}), i -> substring(seq, {start('len', 'i')} + 1, {start('len', 'i + 1')} - {start('len', 'i')}))")).alias("i", "x"))
    # one small expression over the places to try, not one for each of them
    tries = F.broadcast(seqs.sparkSession.createDataFrame([(less, i, shift) for less in range(lengths is not None, d + 1) for i in range(k) for shift in range(-d, d + 1)], "less int, i int, shift int"))  # (d + 1)^2 (2 d + 1) rows
    pairs = some.crossJoin(tries).withColumn("n", F.col("len") - F.col("less")).where("n >= 0")
    if lengths is not None:
        there = lengths.select(F.col("grp").alias("_g"), F.col("len").alias("_n"))
        pairs = pairs.join(F.broadcast(there), F.col("grp").eqNullSafe(F.col("_g")) & (F.col("n") == F.col("_n")), "left_semi")  # a few lengths a group
    placed = pairs.withColumn("_at", F.expr(f"{start('n', 'i')} + shift")).where("_at >= 0")
    other = placed.select("grp", F.col("seq").alias("t"), F.col("len").alias("m"), "n", "i", F.expr(f"substring(seq, _at + 1, {start('n', 'i + 1')} - {start('n', 'i')})").alias("x")).distinct()
    met = own.alias("l").join(other.alias("r"), [F.col("l.grp").eqNullSafe(F.col("r.grp")), F.col("l.n") == F.col("r.n"), F.col("l.i") == F.col("r.i"), F.col("l.x") == F.col("r.x"), F.expr("l.n < r.m or l.s < r.t")])
    out = met.select(F.col("l.grp").alias("grp"), F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()
    return out.withColumn("distance", F.levenshtein("a", "b", d)).where(F.col("distance").between(1, d))


def cluster(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, seq, comp): components of each group's edges; comp is the smallest sequence.

    Sequences are numbered in their order first, so that the rounds move and compare
    numbers, and the smallest number of a component is its smallest sequence.
    """
    ends = edges.select("grp", F.col("a").alias("seq")).unionByName(edges.select("grp", F.col("b").alias("seq"))).distinct()
    nodes = scratch.keep(ends.repartitionByRange("grp", "seq").sortWithinPartitions("grp", "seq").withColumn("id", F.monotonically_increasing_id()), "nodes")

    def number(df: DataFrame, column: str) -> DataFrame:
        named = nodes.select(F.col("grp").alias("_g"), F.col("seq").alias("_s"), F.col("id").alias(f"_{column}"))
        return df.join(named, F.col("grp").eqNullSafe(F.col("_g")) & (F.col(column) == F.col("_s"))).drop("_g", "_s")

    pairs = number(number(edges.select("grp", "a", "b"), "a"), "b").select("_a", "_b")
    parts = connected_components(pairs, scratch, "_a", "_b")
    names = nodes.select(F.col("id").alias("component"), F.col("seq").alias("comp"))
    return parts.join(nodes, F.col("node") == F.col("id")).join(names, "component").select("grp", "seq", "comp")


def numbered(seqs: DataFrame) -> DataFrame:
    """``seqs`` with ``id``, numbers in the order of (grp, seq); to be written before it is used."""
    return seqs.repartitionByRange("grp", "seq").sortWithinPartitions("grp", "seq").withColumn("id", F.monotonically_increasing_id())


def numbered_clusters(seqs: DataFrame, scratch: Scratch, max_distance: int = 3, seen: Callable[[str, DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sequences, edges, components) of :func:`numbered` sequences, all written; the last two have numbers in place of sequences.

    Since numbers are in the sequences' order, what is made of these tables (sizes,
    representatives, diameters) is the same as of sequences; ``grp`` is 0, for a number
    tells its group.  :func:`with_sequences` puts the sequences back.
    """
    look = seen or (lambda name, x: x)
    seqs = scratch.keep(look("sequences", numbered(seqs)), "sequences")  # looked at behind the range exchange, whose sample reads its input once more
    edges = look("edges", similarity_edges(seqs, max_distance))
    edges = scratch.keep(edges.select(F.lit(0).alias("grp"), F.col("a_id").alias("a"), F.col("b_id").alias("b"), "distance"), "edges")
    parts = connected_components(edges, scratch, once=True).select(F.col("node").alias("seq"), F.col("component").alias("comp"))
    if seen:  # which may ask for the groups
        parts = seen("components", parts.join(seqs.select(F.col("id").alias("seq"), "grp"), "seq"))
    return seqs, edges, scratch.keep(parts.select(F.lit(0).alias("grp"), "seq", "comp"), "components")


def with_sequences(df: DataFrame, seqs: DataFrame, *columns: str) -> DataFrame:
    """``df`` with sequences in place of the numbers in ``columns``, and with their group."""
    out = df
    for c in columns:
        names = seqs.select(F.col("id").alias("_id"), F.col("seq").alias("_text"), *([F.col("grp").alias("_grp")] if c == columns[-1] else []))
        out = out.join(names, F.col(c) == F.col("_id")).withColumn(c, F.col("_text")).drop("_id", "_text")
    return out.withColumn("grp", F.col("_grp")).select(df.columns)


def clusters(counts: DataFrame, scratch: Scratch, max_distance: int = 3, seen: Callable[[str, DataFrame], DataFrame] | None = None) -> plain.Clusters:
    """Similar sequences of each non-empty group of ``counts`` (see ``plain.counted``), which are written.

    Plain sequences are numbers by themselves.  If one of them is not, all are numbered
    in their order (:func:`numbered_clusters`).
    """
    some = counts.where("grp <> ''")
    if some.where("raw is not null").isEmpty():
        rows = some.where("seq is not null").drop("raw")
        return plain.plain_clusters(seen("sequences", rows) if seen else rows, scratch, max_distance, seen)
    texts = some.select("grp", F.coalesce("raw", plain.text("seq")).alias("seq"), "n", "weight")
    seqs, edges, parts = numbered_clusters(texts, scratch, max_distance, seen)
    numbers = seqs.select(F.lit(0).alias("grp"), F.col("id").alias("seq"), "n", "weight")
    return plain.Clusters(numbers, edges, parts, lambda df, *columns: with_sequences(df, seqs, *columns), None)


def collapsed_counts(df: DataFrame, column: str = "vbc_read", group: str = "brain", parent: str = "read_count", max_distance: int = 3) -> DataFrame:
    """(group, column, n, reads): rows and summed reads after :func:`align_collapse`, by what the column then holds.

    Equal rows are counted first, and a component's counts, its sequence with most rows
    among them, are added up where they meet.
    """
    scratch = Scratch(df.sparkSession, "collapsed")
    counts = scratch.keep(plain.counted(df, column, group, parent), "counts")
    found = clusters(counts, scratch, max_distance)
    if found.sequence is None:
        to = _collapse_to(found, "n")
        named = counts.select(F.col("grp").alias(group), F.coalesce("raw", plain.text("seq")).alias(column), "n", "weight")
        return _replaced(named, to, column, group).groupBy(group, column).agg(F.sum("n").alias("n"), F.sum("weight").alias("reads"))
    met = counts.join(found.components, ["grp", "seq"], "left").select("grp", F.coalesce("comp", "seq").alias("comp"), "seq", "n", "weight")
    met = met.repartition("grp", "comp")  # sorted once, for what is added up there
    out = met.groupBy("grp", "comp").agg(F.min_by("seq", F.struct(-F.col("n"), "seq")).alias("rep"), F.sum("n").alias("n"), F.sum("weight").alias("reads"))
    return out.select(F.col("grp").alias(group), plain.text("rep").alias(column), "n", "reads")


def _collapse_to(found: plain.Clusters, by: str) -> DataFrame:
    """(grp, seq, rep) of the sequences that are not their component's representative."""
    reps = representatives(found.sequences.select("grp", "seq", by), found.components, by)
    return found.names(found.components.join(reps, ["grp", "comp"]).where("seq <> rep").select("grp", "seq", "rep"), "seq", "rep")


def representatives(seqs: DataFrame, comps: DataFrame, by: str = "n") -> DataFrame:
    """(grp, comp, rep): each component's sequence with the largest ``by``, ties to the smallest sequence."""
    joined = seqs.join(comps, ["grp", "seq"]).select("grp", "comp", "seq", by).repartition("grp", "comp")  # so that rows are sorted once
    return joined.groupBy("grp", "comp").agg(F.min_by("seq", F.struct(-F.col(by), "seq")).alias("rep"))


def apply_collapse(df: DataFrame, comps: DataFrame, reps: DataFrame, column: str = "vbc_read", group: str = "brain") -> DataFrame:
    """Replace each sequence by its representative; ``<column>_orig`` keeps what was read."""
    return _replaced(df, comps.join(reps, ["grp", "comp"]), column, group)


def _replaced(df: DataFrame, to: DataFrame, column: str, group: str) -> DataFrame:
    to = to.select(F.col("grp").alias("_g"), F.col("seq").alias("_s"), "rep")
    out = df.join(to, (df[group] == F.col("_g")) & (df[column] == F.col("_s")), "left")
    return out.withColumn(f"{column}_orig", F.col(column)).withColumn(column, F.coalesce("rep", column)).drop("_g", "_s", "rep")


def align_collapse(df: DataFrame, column: str = "vbc_read", group: str | None = "brain", max_distance: int = 3, min_reads: int = 1, by: str = "n", metric: str = "hamming", seen: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The whole collapse; rows without a group pass through unchanged; ``group=None`` collapses globally.

    ``seen`` is given each table on the way ("sequences", "edges", "components") before it
    is written, and may return it with an observation attached.
    """
    scratch = Scratch(df.sparkSession, "collapse")
    work = df if group else df.withColumn("_all", F.lit("all"))
    key = group or "_all"
    work = work.where(F.col("read_count") >= min_reads) if min_reads > 1 else work
    keep = lambda name, x: scratch.keep(seen(name, x) if seen else x, name)
    if metric == "hamming":
        counts = scratch.keep(plain.counted(work.where(F.col(key) != ""), column, key), "counts")
        out = _replaced(work, _collapse_to(clusters(counts, scratch, max_distance, seen), by), column, key)
    else:
        seqs = keep("sequences", unique_sequences(work, column, key))
        comps = keep("components", cluster(keep("edges", similarity_edges(seqs, max_distance, metric)), scratch))
        out = apply_collapse(work, comps, representatives(seqs, comps, by), column, key)
    return out if group else out.drop("_all")


def component_stats(seqs: DataFrame, comps: DataFrame, edges: DataFrame) -> DataFrame:
    """Size, edges, largest degree and largest count of each component, with the sequences that have them."""
    deg = node_degree(edges).withColumnRenamed("node", "seq")
    full = comps.join(seqs, ["grp", "seq"]).join(deg, ["grp", "seq"])
    top = lambda c: F.struct(F.col(c).alias("v"), F.col("seq").alias("s"))
    agg = full.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("size"), (F.sum("degree") / 2).cast("long").alias("n_edges"), F.max(top("degree")).alias("d"), F.max(top("n")).alias("c"))
    return agg.select("grp", "comp", "size", "n_edges", F.col("d.v").alias("max_degree"), F.col("d.s").alias("max_degree_seq"), F.col("c.v").alias("max_count"), F.col("c.s").alias("max_count_seq"))


def node_degree(edges: DataFrame) -> DataFrame:
    """(grp, node, degree)."""
    ends = edges.select("grp", F.explode(F.array("a", "b")).alias("node"))  # not a union, which would find the edges twice
    return ends.groupBy("grp", "node").agg(F.count(F.lit(1)).alias("degree"))


def component_sizes(comps: DataFrame) -> DataFrame:
    """(size, n): how many components have each size."""
    return comps.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n"))


# --- counts ------------------------------------------------------------------


def vbc_table(df: DataFrame, extra=("brain", "site")) -> DataFrame:
    """Distinct molecules and reads by barcode, sample and type; attributes of the sample by their minimum.

    Rows are dealt out once and sorted once, where they are counted.
    """
    rows = dealt(df.select("vbc_read", "label", "type", "umi", "read_count", *extra), "vbc_read", "label", "type")
    return rows.groupBy("vbc_read", "label", "type").agg(F.countDistinct("umi").alias("umi_count"), F.sum("read_count").alias("read_count"), *[F.min(c).alias(c) for c in extra])


def merge_samples(df: DataFrame) -> DataFrame:
    """All samples as one, in every column that names a sample, its tube or its region."""
    return df.withColumns({"rtprimer": F.lit("100"), "label": F.lit("BC100"), "ourtube": F.lit("100"), "region": F.lit("100")})


def keep_any_above(df: DataFrame, least: int, key=("brain", "vbc_read"), value: str = "umi_count", strict: bool = False) -> DataFrame:
    """All rows of the barcodes whose largest value reaches ``least`` (exceeds it, if strict)."""
    top = F.max(value).over(Window.partitionBy(*key))
    return df.withColumn("_top", top).where(F.col("_top") > least if strict else F.col("_top") >= least).drop("_top")


def negative_threshold(df: DataFrame, site: str, base: int) -> DataFrame:
    """(brain, threshold): the largest molecule count in each brain's control samples, at least ``base``."""
    top = F.max(F.when(F.col("site") == site, F.col("umi_count")))
    return df.groupBy("brain").agg(F.greatest(F.coalesce(top, F.lit(0)), F.lit(base)).alias("threshold"))


def require(df: DataFrame, other: DataFrame, key=("brain", "vbc_read")) -> DataFrame:
    """Distinct rows whose key stands in the other table."""
    return df.join(other.select(*key), list(key), "left_semi").distinct()


def controls_of(df: DataFrame, include_lone: bool = False) -> DataFrame:
    """Rows of control samples; L1 samples only if asked for."""
    return df.where(F.col("site").isin(*[x for x in CONTROL_SITES if include_lone or x != "target-lone"]))


def copy_controls(df: DataFrame, include_lone: bool = False) -> DataFrame:
    """Every control row in every brain, each once, beside the brains' own rows; rows of no brain are left only as copies.

    L1 samples that aren't copied stay in their own brain.
    """
    own = df.where("brain <> ''")
    brains = F.broadcast(own.agg(F.collect_set("brain").alias("_brains")))  # one row: the sheet's brains
    copies = controls_of(df, include_lone).drop("brain").distinct().crossJoin(brains).withColumn("brain", F.explode("_brains")).select(df.columns)
    out = own.where(~F.col("site").isin(*CONTROL_SITES)).unionByName(copies)
    return out if include_lone else out.unionByName(own.where("site = 'target-lone'").distinct())


def control_readout(df: DataFrame, target_min: int = 2, include_lone: bool = False) -> DataFrame:
    """The control samples' spikes, and their reals of at least ``target_min`` molecules."""
    return controls_of(df, include_lone).where((F.col("type") == "spike") | ((F.col("type") == "real") & (F.col("umi_count") >= target_min)))


def barcode_levels(df: DataFrame, target_min_absolute: int = 1, include_controls: bool = True, include_lone: bool = False, use_negative: bool = False, use_water: bool = False) -> DataFrame:
    """The counts of all brains, controls copied, with what any thresholds are compared to, in one pass over written counts.

    ``_target`` and ``_injection`` tell the rows that are neither spikes nor below
    ``target_min_absolute``; ``_top`` and ``_inj`` are the barcode's largest target and
    injection counts in its brain; ``_floor`` is the largest count of the brain's
    negative or water controls, if asked for, else 0; ``_nth`` numbers equal rows.
    """
    scratch = Scratch(df.sparkSession, "levels")
    rows, site, n = scratch.keep(df, "counts"), F.col("site"), F.col("umi_count")
    if include_controls:
        brains = F.broadcast(rows.where("brain <> ''").agg(F.collect_set("brain").alias("_brains")))  # one row
        copied = site.isin(*[x for x in CONTROL_SITES if include_lone or x != "target-lone"])
        to = F.when(copied, F.col("_brains")).when(F.col("brain") != "", F.array("brain"))
        rows = rows.where(site.isNotNull()).crossJoin(brains).withColumn("brain", F.explode(to)).select(df.columns)
    else:
        rows = rows.where("brain <> ''")
    other = F.col("type") != "spike"
    flags = {"_target": other & site.startswith("target") & (n >= target_min_absolute), "_injection": other & site.startswith("injection")}
    rows = rows.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    sites = [x for on, x in ((use_negative, "target-negative"), (use_water, "target-water-control")) if on]
    if sites:
        floors = rows.where(F.col("_target") & site.isin(*sites)).groupBy("brain").agg(F.max("umi_count").alias("_floor"))
        rows = rows.join(F.broadcast(floors), "brain", "left").withColumn("_floor", F.coalesce("_floor", F.lit(0)))  # one row a brain
    else:
        rows = rows.withColumn("_floor", F.lit(0))
    barcode = Window.partitionBy("brain", "vbc_read")
    rows = rows.withColumns({"_top": F.max(F.when(F.col("_target"), n)).over(barcode), "_inj": F.max(F.when(F.col("_injection"), n)).over(barcode)})
    rest = [c for c in df.columns if c not in ("brain", "vbc_read")]
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("brain", "vbc_read", *rest).orderBy("vbc_read")))
    return rows.where((F.col("_nth") == 1) | ~site.isin(*CONTROL_SITES)) if include_controls else rows


def passing(injection_min, target_min, require_injection: bool = True, include_injection: bool = True):
    """Which rows of :func:`barcode_levels` stay at these thresholds (numbers or columns)."""
    has_target = F.col("_top") >= F.greatest(F.lit(target_min) if isinstance(target_min, int) else target_min, F.col("_floor"))
    has_injection, once = F.col("_inj") >= injection_min, F.col("_nth") == 1
    ok = F.col("_target") & has_target & (has_injection & once if require_injection else F.lit(True))
    if include_injection:
        ok = ok | (F.col("_injection") & (F.col("umi_count") >= injection_min) & has_target & once)
    return F.coalesce(ok, F.lit(False))


def vbc_filter(
    df: DataFrame,
    injection_min: int = 10,
    target_min: int = 2,
    target_min_absolute: int = 1,
    require_injection: bool = True,
    include_injection: bool = True,
    include_controls: bool = True,
    include_lone: bool = False,
    use_negative: bool = False,
    use_water: bool = False,
) -> DataFrame:
    """Per-brain thresholds in one pass for all brains.

    With ``include_controls`` every control row is copied into every brain first.
    Spikes pass without a threshold.  Of the rest, sites that start with
    ``target``, controls too, are targets: rows of at least
    ``target_min_absolute`` of barcodes whose best row reaches the brain's
    threshold (``target_min``, or the largest count of the brain's target-negative
    or water control samples if asked for).  Sites that start with ``injection``
    need ``injection_min``.  Injection rows stay if their barcode has a target, and
    targets, if ``require_injection``, if it has an injection row.  A brain that
    nothing but spikes is left of goes.
    """
    scratch = Scratch(df.sparkSession, "filter")
    levels = barcode_levels(df, target_min_absolute, include_controls, include_lone, use_negative, use_water)
    spike = F.coalesce(F.col("type") == "spike", F.lit(False))
    kept = scratch.keep(levels.where(spike | passing(injection_min, target_min, require_injection, include_injection)).select(df.columns), "passed")
    brains = kept.where("type <> 'spike'").select("brain").distinct()
    return kept.join(F.broadcast(brains), "brain", "left_semi").select(df.columns)  # one row a brain


# --- more filters ----------------------------------------------------------------


def drop_lone(df: DataFrame, include_lone: bool = False) -> DataFrame:
    """Leave out L1 molecules unless they are asked for."""
    return df if include_lone else df.where(F.col("type") != "lone")


def drop_unmatched(df: DataFrame, marker: str = "nomatch") -> DataFrame:
    """Rows without the marker of a failed lookup, and without nulls, in any column."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.na.replace(marker, None, subset=text).na.drop("any") if text else df.na.drop("any")


def read_info(df: DataFrame) -> DataFrame:
    """(stage, type, n, reads): rows and reads of each type before and after the site thresholds."""
    stages = (("before", df), ("after", site_threshold(df)))
    parts = [x.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("read_count").alias("reads")).select(F.lit(s).alias("stage"), "type", "n", "reads") for s, x in stages]
    return parts[0].unionByName(parts[1])


def demultiplex(df: DataFrame, barcodes: DataFrame, column: str = "sequence", max_mismatch: int = 0) -> DataFrame:
    """Add ``label`` by the read's end and cut it off; null for reads that match no sample barcode (label, ssi).

    Barcodes have one length.  With one mismatch allowed each barcode stands for
    its neighbours too; an exact match wins, then the smallest label.
    """
    if max_mismatch not in (0, 1):
        raise ValueError("at most one mismatch")
    length = F.length("ssi")
    want = barcodes.select("label", F.col("ssi").alias("_end"), F.lit(0).alias("_d"), length.alias("_n"))
    if max_mismatch:
        near = barcodes.select("label", F.explode(neighbours(F.col("ssi"))).alias("_end"), F.lit(1).alias("_d"), length.alias("_n"))
        want = want.unionByName(near)
    want = want.groupBy("_end").agg(F.min(F.struct("_d", "label")).alias("_w"), F.min("_n").alias("_n"))
    sizes = barcodes.agg(F.max(length).alias("_size"))
    ends = df.crossJoin(F.broadcast(sizes)).withColumn("_tail", F.expr(f"right({column}, _size)"))  # one row
    out = ends.join(want.select("_end", F.col("_w.label").alias("label")), F.col("_tail") == F.col("_end"), "left")
    cut = F.when(F.col("label").isNotNull(), F.expr(f"left({column}, length({column}) - _size)")).otherwise(F.col(column))
    return out.withColumn(column, cut).select(*df.columns, "label")


def modulo_filter(df: DataFrame, column: str, n: int, keep: int = 0) -> DataFrame:
    """Rows whose value falls in one of ``n`` hash classes."""
    return df.where(F.pmod(F.crc32(F.col(column).cast("binary")), F.lit(n)) == keep)


def without_singletons(comps: DataFrame) -> DataFrame:
    """Components of two sequences or more."""
    many = comps.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("grp", "comp")
    return comps.join(many, ["grp", "comp"], "left_semi")


def top_components(comps: DataFrame, n: int = 10, names: Callable[..., DataFrame] | None = None) -> DataFrame:
    """(grp, comp, size) of the ``n`` largest components; ties by group and name, which ``names`` puts in place of numbers."""
    sizes = comps.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("size"))
    sizes = names(sizes, "comp") if names else sizes
    return sizes.orderBy(F.desc("size"), "grp", "comp").limit(n)


def component_edges(edges: DataFrame, comps: DataFrame, comp: str) -> DataFrame:
    """The edges of one component."""
    one = comps.where(F.col("comp") == comp).select("grp", F.col("seq").alias("a"))
    return edges.join(one, ["grp", "a"], "left_semi")
