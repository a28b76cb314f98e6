"""Barcode-by-sample matrices in long form, spike-in normalisation and quality control."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrift.functions.seq import natural_key
from spindrift.operators import ranks
from spindrift.operators.barcodes import CONTROL_SITES, barcode_levels, passing
from spindrift.plans.scratch import Scratch, dealt


def label_order(df: DataFrame, column: str = "label") -> list[str]:
    """Distinct labels in natural order (a dimension: one row a sample)."""
    return [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(natural_key(F.col(column))).collect()]


def matrix_long(df: DataFrame, kind: str = "real", value: str = "umi_count") -> DataFrame:
    """(brain, vbc_read, label, value) of one type; a barcode twice in a sample is an error."""
    rows = df.where(F.col("type") == kind).select("brain", "vbc_read", "label", value)
    out = dealt(rows, "brain", "vbc_read").groupBy("brain", "vbc_read", "label").agg(F.count(F.lit(1)).alias("_n"), F.first(value).cast("double").alias("value"))
    twice = F.raise_error(F.concat(F.lit("duplicate entry for "), "vbc_read", F.lit(" in "), "label"))
    return out.select("brain", "vbc_read", "label", F.when(F.col("_n") > 1, twice.cast("double")).otherwise(F.col("value")).alias("value"))


def matrix_wide(long: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """One row a barcode, one column a label in natural order, 0 where there is nothing."""
    labels = label_order(long) if labels is None else labels
    return long.groupBy("brain", "vbc_read").pivot("label", labels).agg(F.first("value")).na.fill(0.0)


def spike_factors(spikes: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(brain, label, factor): largest spike sum of the label's group over the label's own; 0 where it has none."""
    sums = spikes.groupBy("brain", "label").agg(F.sum("value").alias("w"))
    sums = sums.join(groups, "label") if groups is not None else sums.withColumn("grp", F.lit("all"))
    top = F.max("w").over(Window.partitionBy("brain", "grp"))
    return sums.select("brain", "label", F.when(F.col("w") == 0, 0.0).otherwise(top / F.col("w")).alias("factor"))


def normalize(real: DataFrame, spikes: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Reals times their label's factor.  Labels without spikes get 0; labels in no group go."""
    out = real if groups is None else real.join(groups.select("label").distinct(), "label", "left_semi")
    out = out.join(spike_factors(spikes, groups), ["brain", "label"], "left")
    return out.select("brain", "vbc_read", "label", (F.col("value") * F.coalesce("factor", F.lit(0.0))).alias("value"))


def scale_by_ratio(long: DataFrame, ratios: DataFrame) -> DataFrame:
    """Multiply by the sample's spike-in ratio (label, si_ratio), 1 where none is given; ratios count only if one of them exceeds 1."""
    given = ratios.select("label", "si_ratio").dropDuplicates(["label"])
    used = given.crossJoin(F.broadcast(given.agg(F.max("si_ratio").alias("_most"))))  # one row
    used = used.select("label", F.when(F.col("_most") > 1, F.col("si_ratio")).otherwise(F.lit(1.0)).alias("si_ratio"))
    out = long.join(used, "label", "left")
    return out.select("brain", "vbc_read", "label", (F.col("value") * F.coalesce("si_ratio", F.lit(1.0))).alias("value"))


def make_matrices(df: DataFrame, groups: DataFrame | None = None, ratios: DataFrame | None = None) -> dict[str, DataFrame]:
    """Real, spike and normalised matrices (long) of the brains that have both reals and spikes."""
    both = df.groupBy("brain").agg(F.count_if(F.col("type") == "real").alias("r"), F.count_if(F.col("type") == "spike").alias("s")).where("r > 0 and s > 0").select("brain")
    kept = df.join(both, "brain", "left_semi")
    real, spike = matrix_long(kept, "real"), matrix_long(kept, "spike")
    normal = normalize(real, spike, groups)
    return {"real": real, "spike": spike, "normalized": scale_by_ratio(normal, ratios) if ratios is not None else normal}


# --- quality control -----------------------------------------------------------


def read_report(df: DataFrame) -> DataFrame:
    """Distinct barcodes, molecules and reads by label and type."""
    return df.groupBy("label", "type").agg(F.countDistinct("vbc_read").alias("n_vbc"), F.countDistinct("umi").alias("n_umi"), F.sum("read_count").alias("read_count"))


def spikein_qc(df: DataFrame) -> DataFrame:
    """Spikes by label: distinct barcodes, molecules, and both together; pre-aggregated to distinct pairs."""
    pairs = df.where("type = 'spike'").select("label", "vbc_read", "umi").distinct()
    return pairs.groupBy("label").agg(F.countDistinct("vbc_read").alias("n_vbc"), F.countDistinct("umi").alias("n_umi"), F.count(F.lit(1)).alias("n_vbc_umi"))


def cumulative(df: DataFrame, column: str) -> DataFrame:
    """Value counts from the most frequent down with running proportion; ties by value."""
    scratch = Scratch(df.sparkSession, "cumulative")
    counts = scratch.keep(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")), "counts")
    run = ranks.running_sums(counts, [F.desc("n"), F.asc(column)], "n", scratch)
    total = counts.agg(F.sum("n").alias("total"))
    return run.crossJoin(F.broadcast(total)).select(column, "n", ((F.col("before") + F.col("n")) / F.col("total")).alias("proportion"))  # total: one row


def rank_top(df: DataFrame, group: str, value: str, tie: str, ranks: int) -> DataFrame:
    """The ``ranks`` largest values of each group with their rank."""
    w = Window.partitionBy(group).orderBy(F.desc(value), tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= ranks).select(group, tie, value, "rank")


def read_matrix_dominant(df: DataFrame, source: str = "source") -> DataFrame:
    """For each label: its largest source and that source's percentage of the label's rows."""
    c = df.groupBy(source, "label").agg(F.count(F.lit(1)).alias("n"))
    top = c.groupBy("label").agg(F.min_by(source, F.struct(-F.col("n"), source)).alias("top"), F.max("n").alias("n_top"), F.sum("n").alias("n"))
    return top.select("label", F.col("top").alias(source), "n", (F.col("n_top") * 100 / F.col("n")).alias("percent"))


def false_positive_rate(df: DataFrame, injection_min: int = 5, negative: str = "target-negative") -> DataFrame:
    """(threshold, negative, target, rate) of reals for thresholds from 0 up to the water controls' largest count.

    Of the barcodes above ``injection_min`` in an injection sample: those above the
    threshold in a negative sample, and in any target sample, negatives included;
    the rate is 0 where there are none.  A barcode's maxima are counted once and
    the histogram summed from the top, so work doesn't grow with barcodes times
    thresholds.
    """
    df = df.where("type = 'real'")
    top = lambda cond: F.coalesce(F.max(F.when(cond, F.col("umi_count"))), F.lit(0)).cast("long")
    per = df.groupBy("vbc_read").agg(top(F.col("site") == "injection").alias("inj"), top(F.col("site") == negative).alias("neg"), top(F.col("site").isin("target", negative)).alias("tgt"))
    water = df.where("site = 'target-water-control'").agg(F.coalesce(F.max("umi_count"), F.lit(0)).cast("long").alias("m"))
    steps = water.select(F.explode(F.when(F.col("m") > 0, F.sequence(F.lit(0).cast("long"), F.col("m") - 1))).alias("threshold"))
    # a maximum of x counts at the thresholds below x, that is up to x - 1 or the last one
    some = per.where(F.col("inj") > injection_min).crossJoin(F.broadcast(water))  # one row
    ends = F.array(*[F.struct(F.least(F.col(c) - 1, F.col("m") - 1).alias("threshold"), F.lit(c == "neg").cast("long").alias("neg"), F.lit(c == "tgt").cast("long").alias("tgt")) for c in ("neg", "tgt")])
    ends = some.select(F.explode(ends).alias("e")).select("e.*")
    ends = ends.unionByName(steps.select("threshold", F.lit(0).cast("long").alias("neg"), F.lit(0).cast("long").alias("tgt")))
    counted = ends.where("threshold >= 0").groupBy("threshold").agg(F.sum("neg").alias("neg"), F.sum("tgt").alias("tgt"))
    above = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)  # one row a threshold
    out = counted.select("threshold", F.sum("neg").over(above).alias("negative"), F.sum("tgt").over(above).alias("target"))
    return out.withColumn("rate", F.when(F.col("target") > 0, F.col("negative") / F.col("target")).otherwise(F.lit(0.0)))


def template_switch_rate(df: DataFrame) -> DataFrame:
    """One row, target samples only: c = ts / (L2 * (spk1 + L1)), ratio = c * L2 / 2 + c * spk2.

    L1 and spk1 are lone molecules and spikes in L1 samples, L2 and spk2 reals and
    spikes in experimental targets, ts reals in L1 samples.
    """
    lone_site, target = F.col("site").startswith("target-lone"), F.col("site").isin("target", "target-negative")
    s = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("umi_count"))), F.lit(0)).cast("double")
    one = df.agg(
        s(lone_site & (F.col("type") == "lone")).alias("l1"),
        s(lone_site & (F.col("type") == "spike")).alias("spk1"),
        s(target & (F.col("type") == "real")).alias("l2"),
        s(target & (F.col("type") == "spike")).alias("spk2"),
        s(lone_site & (F.col("type") == "real")).alias("ts"),
    )
    c = F.when(F.col("l2") * (F.col("spk1") + F.col("l1")) > 0, F.col("ts") / (F.col("l2") * (F.col("spk1") + F.col("l1"))))
    return one.withColumn("c", c).withColumn("ratio", 0.5 * F.col("c") * F.col("l2") + F.col("c") * F.col("spk2"))


def vbc_overlap(counts: DataFrame, vbcs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Summed molecules of each listed barcode's reals in each injection sample (not its controls), 0 where it is absent.

    The samples are those whose siteinfo is ``injection`` in the sheet (label, siteinfo),
    counted or not; without a sheet, those in the counts.
    """
    injected = counts.where("site = 'injection'") if samples is None else counts
    labels = (injected if samples is None else samples.where("siteinfo = 'injection'")).select("label").distinct()
    grid = vbcs.select("vbc_read").distinct().crossJoin(F.broadcast(labels))  # labels: one row a sample
    sums = injected.where("type = 'real'").groupBy("vbc_read", "label").agg(F.sum("umi_count").alias("n"))
    return grid.join(sums, ["vbc_read", "label"], "left").select("vbc_read", "label", F.coalesce("n", F.lit(0)).alias("umi_count"))


def plot_counts(df: DataFrame, column: str = "umi_count", by: str = "brain", least: int = 1, without: str | None = None, ranks_shown: int | None = None) -> DataFrame:
    """(grp, rank, vbc_read, label, type, value): the data of a rank plot, each group's values from the largest down.

    Values below ``least``, rows with an empty group and rows of type ``without`` are left
    out; ``ranks_shown`` ends each group's list there.
    """
    rows = df.where((F.col(column) >= least) & (F.col(by) != ""))
    rows = rows if without is None else rows.where(F.col("type") != without)
    rows = rows.select(F.col(by).alias("grp"), "vbc_read", "label", "type", F.col(column).alias("value"))
    ranked = ranks.global_rank(rows, [F.desc("value"), F.asc("vbc_read"), F.asc("label"), F.asc("type")], Scratch(df.sparkSession, "plot"), by=("grp",))
    return ranked if ranks_shown is None else ranked.where(F.col("rank") <= ranks_shown)


def matrix_overlap(long: DataFrame, controls: DataFrame) -> DataFrame:
    """Matrix rows in long form, and for each of their barcodes the molecules of the control samples' reals, 0 where absent."""
    real = controls.where("type = 'real'")
    grid = long.select("brain", "vbc_read").distinct().crossJoin(F.broadcast(real.select("label").distinct()))  # one row a sample
    sums = real.groupBy("vbc_read", "label").agg(F.sum("umi_count").cast("double").alias("n"))
    more = grid.join(sums, ["vbc_read", "label"], "left").select("brain", "vbc_read", "label", F.coalesce("n", F.lit(0.0)).alias("value"))
    return long.select("brain", "vbc_read", "label", "value").unionByName(more)


def umi_report(df: DataFrame) -> DataFrame:
    """Rows of each site and type that has more than one, ranked by molecules from the largest down."""
    scratch = Scratch(df.sparkSession, "umi-report")
    ranked = ranks.global_rank(df.select("site", "type", "vbc_read", "label", "umi_count"), [F.desc("umi_count"), F.asc("vbc_read"), F.asc("label")], scratch, by=("site", "type"))
    ranked = scratch.keep(ranked, "ranked")
    many = ranked.where("rank = 2").select(F.col("site").alias("_s"), F.col("type").alias("_t"))
    return ranked.join(many, F.col("site").eqNullSafe(F.col("_s")) & F.col("type").eqNullSafe(F.col("_t"))).select("site", "type", "rank", "vbc_read", "label", "umi_count")


def source_dominant(df: DataFrame, source: str = "source") -> DataFrame:
    """For each source: its largest label and that label's percentage of the source's rows."""
    c = df.where("label is not null").groupBy(source, "label").agg(F.count(F.lit(1)).alias("n"))
    top = c.groupBy(source).agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("label"), F.max("n").alias("n_top"), F.sum("n").alias("n"))
    return top.select(source, "label", "n", (F.col("n_top") * 100 / F.col("n")).alias("percent"))


def counts_filter(df: DataFrame, injection_above: int, row_sum: int, row_max: int, control_max: int) -> DataFrame:
    """(brain, vbc_read) whose injection count exceeds the first bound, target sum and maximum the next two, and whose controls stay below the last."""
    site, n = F.col("site"), F.col("umi_count")
    best = lambda cond: F.coalesce(F.max(F.when(cond, n)), F.lit(0))
    control, target = site.isin(*CONTROL_SITES), site.isin("target", "target-negative")
    per = df.groupBy("brain", "vbc_read").agg(best(site == "injection").alias("i"), F.coalesce(F.sum(F.when(target, n)), F.lit(0)).alias("s"), best(target).alias("m"), best(control).alias("c"))
    return per.where((F.col("i") > injection_above) & (F.col("s") > row_sum) & (F.col("m") > row_max) & (F.col("c") < control_max)).select("brain", "vbc_read")


def adjacency(edges: DataFrame) -> DataFrame:
    """(grp, a, b, distance) in both directions: the long form of the adjacency matrix."""
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))  # not a union, which would find the edges twice
    return edges.select("grp", F.explode(ways).alias("e"), "distance").select("grp", "e.a", "e.b", "distance")


def parameter_sweep(df: DataFrame, params: list[tuple[int, int]]) -> DataFrame:
    """(injection_min, target_min, label, n_vbc): the reals' distinct barcodes that the whole VBC filter leaves at each pair of thresholds.

    The counts are read and compared within barcodes once, whatever the number of pairs.
    """
    pairs = F.broadcast(df.sparkSession.createDataFrame(sorted(set(params)), "injection_min long, target_min long"))  # the caller's short list
    real = barcode_levels(df).where("type = 'real' and (_target or _injection)").crossJoin(pairs)
    kept = real.where(passing(F.col("injection_min"), F.col("target_min")))
    once = kept.select("injection_min", "target_min", "label", "vbc_read").distinct()
    return once.groupBy("injection_min", "target_min", "label").agg(F.count(F.lit(1)).alias("n_vbc"))


# --- library -------------------------------------------------------------------


def library_counts(df: DataFrame) -> DataFrame:
    """(vbc_read, umi_count) of reals at target sites."""
    return df.where("type = 'real' and site = 'target'").groupBy("vbc_read").agg(F.sum("umi_count").alias("umi_count"))


def unique_fraction(counts: DataFrame, ks: list[int], min_umi: int = 1) -> DataFrame:
    """(k, p_unique): 1 - sum p (1 - (1 - p)^(k - 1)) over the library's proportions."""
    lib = counts.where(F.col("umi_count") >= min_umi)
    p = lib.crossJoin(F.broadcast(lib.agg(F.sum("umi_count").alias("_t")))).select((F.col("umi_count") / F.col("_t")).alias("p"))  # one row
    k = F.broadcast(counts.sparkSession.createDataFrame([(x,) for x in ks], "k long"))  # the caller's short list
    return p.crossJoin(k).groupBy("k").agg((1 - F.sum(F.col("p") * (1 - F.pow(1 - F.col("p"), F.col("k") - 1)))).alias("p_unique"))


def freq_threshold(df: DataFrame, fraction: float, column: str) -> DataFrame:
    """One row: the value at position int(n * fraction) from the largest down, plus 1."""
    at = ranks.value_at(df, column, fraction, Scratch(df.sparkSession, "threshold"))
    return at.select((F.col("value") + 1).alias("threshold"))


def gap_groups(df: DataFrame, value: str, key: str, span: float) -> DataFrame:
    """Greedy groups over sorted values: a new group starts when a value exceeds the group's floor by more than ``span``.

    Where a group starts depends on the one before, so one fold over the distinct values
    finds the floors, and holds only these; each row then takes the last floor not above
    its value.  Meant for calibration plates (a few hundred wells).  Rows without a value
    are in no group.
    """
    rows = df.where(F.col(value).isNotNull())
    values = rows.agg(F.sort_array(F.collect_set(F.col(value).cast("double"))).alias("_vs"))
    starts = F.aggregate("_vs", F.expr("cast(array() as array<double>)"), lambda acc, x: F.when((F.size(acc) == 0) | (x > F.element_at(acc, -1) + span), F.concat(acc, F.array(x))).otherwise(acc))
    floors = F.broadcast(values.select(starts.alias("_floors")))  # one row
    group = F.size(F.filter("_floors", lambda f: f <= F.col(value))) - 1
    return rows.crossJoin(floors).select(key, value, group.cast("int").alias("group_id"))


def qpcr_groups(wells: DataFrame, span: float = 3.0) -> DataFrame:
    """(well_id, mean, group_id, cycles_rec): wells without an error in gap groups, with the group's mean rounded up."""
    g = gap_groups(wells.where(~F.coalesce("error", F.lit(False))).select("well_id", "mean"), "mean", "well_id", span)
    mean = F.avg("mean").over(Window.partitionBy("group_id"))
    return g.select("well_id", "mean", (F.col("group_id") + 1).alias("group_id"), F.ceil(mean).cast("int").alias("cycles_rec"))


def pad_cycles(df: DataFrame, column: str = "cycle", by: str = "well_id", prepend: int = 2) -> DataFrame:
    """Add rows below each well's smallest cycle, with that row's other values."""
    first = df.groupBy(by).agg(F.min_by(F.struct(*df.columns), column).alias("r")).select("r.*")
    more = first.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(prepend)))).withColumn(column, (F.col(column) - F.col("_i")).cast(df.schema[column].dataType))
    return df.unionByName(more.drop("_i"))


def cycles_with_groups(cycles: DataFrame, groups: DataFrame) -> DataFrame:
    """Every well's cycles with its group; wells that only one side has stay."""
    return cycles.join(groups.select("well_id", "group_id", "cycles_rec"), "well_id", "full")


# --- thresholds from the distribution ------------------------------------------


def cumulative_threshold(df: DataFrame, fraction: float, by: str = "label", value: str = "read_count", least: int = 1) -> DataFrame:
    """(by, threshold): going down the values of each group, the last at which the running sum is still below ``fraction`` of the whole.

    The largest value where there is none; at least ``least``.  Equal values are
    counted before they are summed, so a window holds a group's distinct values.
    """
    counts = df.where(F.col(value) > 0).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    down = Window.partitionBy(by).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    run = counts.withColumn("_before", F.coalesce(F.sum(F.col(value) * F.col("_n")).over(down), F.lit(0)))
    run = run.withColumn("_bar", F.floor(F.sum(F.col(value) * F.col("_n")).over(Window.partitionBy(by)) * fraction))
    inside = F.min(F.when(F.col("_before") + F.col(value) < F.col("_bar"), F.col(value)))
    return run.groupBy(by).agg(F.greatest(F.coalesce(inside, F.max(value)), F.lit(least)).cast("long").alias("threshold"))


def final_thresholds(df: DataFrame, threshold: str = "threshold") -> DataFrame:
    """(site, threshold) for target and injection: the least over their samples; negatives count as targets."""
    kind = F.when(F.col("site").isin("target", "target-negative"), "target").when(F.col("site") == "injection", "injection")
    return df.select(kind.alias("site"), threshold).where("site is not null").groupBy("site").agg(F.min(threshold).alias("threshold"))


def negative_floor(df: DataFrame) -> DataFrame:
    """(brain, min_target): the largest sum of a negative sample's reals; 0 for a brain that has none."""
    real = df.where("type = 'real' and site = 'target-negative'").groupBy("brain", "label").agg(F.sum("umi_count").alias("_n"))
    top = real.groupBy("brain").agg(F.max("_n").alias("min_target"))
    return df.select("brain").distinct().join(top, "brain", "left").select("brain", F.coalesce("min_target", F.lit(0)).cast("long").alias("min_target"))


def rename_labels(long: DataFrame, samples: DataFrame) -> DataFrame:
    """Matrix columns named by the sheet's matrixcolumn under their sample's label; columns that the sheet lacks stay."""
    to = samples.where("matrixcolumn is not null").select(F.col("matrixcolumn").cast("string").alias("label"), F.concat(F.lit("BC"), F.col("rtprimer").cast("string")).alias("_to")).dropDuplicates(["label"])
    return long.join(to, "label", "left").select("brain", "vbc_read", F.coalesce("_to", "label").alias("label"), "value")


def downsample(df: DataFrame, fraction: float, columns: list[str], seed: int = 1) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of their columns, so a rerun chooses the same; equal rows stay or go together."""
    return df.where(F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 20)) < int(fraction * (1 << 20)))
